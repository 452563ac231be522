"""The registered queries in SQL (DuckDB), written on their own from the definitions."""

from __future__ import annotations

from themata.checks.queries import GREEK, LATIN, MIN_FREQ, N_BIGRAMS, N_TERMS, NEIGHBOURS, WIDE_TERMS
from themata.functions import greek as G

W = r"[\p{L}\p{N}_]"
WS = r"[\s\x{0B}\x{1C}-\x{1F}\x{85}\p{Z}]"
DECIMAL = rf"([0-9]){WS}*[.,]{WS}*([0-9])"
ACRONYM = rf"({W}+)\.({W}+)\.(?:({W}+)\.)?(?:({W}+)\.)?(?:({W}+)\.)?"


def lit(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def upper(text: str) -> str:
    # DuckDB upper-cases the sharp s to one letter, Unicode's full mapping to two
    return f"upper(replace(strip_accents({text}), 'ß', 'ss'))"


def tokenized(text: str, as_written: bool = False) -> str:
    decimal = "chr(1) || chr(3)" if as_written else r"'\1\2'"
    acronym = r"chr(2) || chr(4) || chr(6) || '\4' || chr(8)" if as_written else r"'\1\2\3\4\5'"
    merged = f"regexp_replace({upper(text)}, {lit(DECIMAL)}, {decimal}, 'g')"
    merged = f"regexp_replace({merged}, {lit(ACRONYM)}, {acronym}, 'g')"
    return f"string_split(regexp_replace({merged}, '[^\\p{{L}}\\p{{N}}_]+', ' ', 'g'), ' ')"


def numbers(tokens: str) -> str:
    return f"list_transform({tokens}, lambda t: CASE WHEN regexp_matches(t, '[0-9]') THEN 'NUMBERVALUE' ELSE t END)"


def long_enough(tokens: str) -> str:
    return f"list_filter({tokens}, lambda t: length(t) > 2)"


def processed(text: str) -> str:
    return long_enough(numbers(tokenized(text)))


def with_(*parts: str) -> str:
    return "WITH " + ",\n".join(parts)


TOK = f"tok AS MATERIALIZED (SELECT doc_id, lang AS label, {processed('text')} AS tokens FROM documents)"
PLAIN = f"plain AS MATERIALIZED (SELECT doc_id, {tokenized('text')} AS tokens FROM documents)"
TEST = f"test AS MATERIALIZED (SELECT page_id AS doc_id, {processed('html')} AS tokens FROM pages)"
BENCH = (
    f"bench AS (SELECT DISTINCT unnest({tokenized('text')}) AS term FROM benchmark),"
    "short_words AS (SELECT list(term) AS l FROM bench WHERE term <> '' AND length(term) <= 3),"
    "long_words AS (SELECT list(term) AS l FROM bench WHERE length(term) > 3)"
)


def exploded(name: str, source: str) -> str:
    return (
        f"{name} AS MATERIALIZED (SELECT doc_id, unnest(tokens) AS term, "
        f"generate_subscripts(tokens, 1) - 1 AS pos FROM {source})"
    )


WORDS = (
    "words AS MATERIALIZED (SELECT doc_id, label, unnest(tokens) AS term, "
    "generate_subscripts(tokens, 1) - 1 AS pos FROM tok)"
)
PAIRS = (
    "adjacent AS MATERIALIZED (SELECT * FROM (SELECT doc_id, label, pos, term AS w1, "
    "lead(term) OVER (PARTITION BY doc_id ORDER BY pos) AS w2 FROM words) WHERE w2 IS NOT NULL)"
)
UNI = "uni AS MATERIALIZED (SELECT term, count(*) AS n FROM words GROUP BY term)"
BI = f"bi AS MATERIALIZED (SELECT w1, w2, count(*) AS freq FROM adjacent GROUP BY ALL HAVING count(*) >= {MIN_FREQ})"
PMI = (
    "pmi AS MATERIALIZED (SELECT w1, w2, w1 || ' ' || w2 AS term, freq, "
    "log2((freq::DOUBLE * (SELECT sum(n) FROM uni)::DOUBLE) / (a.n::DOUBLE * b.n::DOUBLE)) AS pmi "
    "FROM bi JOIN uni a ON a.term = w1 JOIN uni b ON b.term = w2)"
)
KEPT = f"kept AS MATERIALIZED (SELECT * FROM pmi ORDER BY pmi DESC, w1, w2 LIMIT {N_BIGRAMS})"


def class_stats(words: str, prefix: str = "") -> str:
    p = prefix
    return f"""{p}cls AS MATERIALIZED (SELECT label, term, count(*) AS n FROM {words} GROUP BY ALL),
{p}ctf AS MATERIALIZED (SELECT label, term, n / sum(n) OVER (PARTITION BY label) AS tf FROM {p}cls),
{p}k AS (SELECT count(DISTINCT lang)::DOUBLE AS c FROM documents),
{p}mean AS (SELECT term, sum(tf) / any_value(c) AS m, count(*) AS present, any_value(c) AS c FROM {p}ctf, {p}k GROUP BY term),
{p}var AS MATERIALIZED (SELECT term, (sum((tf - m) * (tf - m)) + (any_value(c) - any_value(present)) * any_value(m) * any_value(m)) / any_value(c) AS var
  FROM {p}ctf JOIN {p}mean USING (term) GROUP BY term)"""


CLASS = class_stats("words")


def selection(n: int) -> str:
    return (
        "powers AS MATERIALIZED (SELECT term, var, CASE WHEN var > 0 THEN floor(log10(var)) END AS power FROM var),\n"
        "sel AS MATERIALIZED (SELECT term, var, row_number() OVER (ORDER BY power DESC NULLS LAST, round(var / pow(10.0, power), 10) DESC, term) - 1 AS term_id "
        f"FROM powers QUALIFY term_id < {n}),\n"
        "df AS MATERIALIZED (SELECT term_id, any_value(term) AS term, count(DISTINCT doc_id) AS df FROM words JOIN sel USING (term) GROUP BY term_id),\n"
        "idf AS MATERIALIZED (SELECT term_id, df, ln((SELECT count(*) FROM documents)::DOUBLE / df) AS idf FROM df)"
    )


def weighted(name: str, words: str) -> str:
    return (
        f"{name}_n AS MATERIALIZED (SELECT doc_id, term_id, count(*) AS n FROM {words} JOIN sel USING (term) GROUP BY ALL),\n"
        f"{name}_tf AS MATERIALIZED (SELECT doc_id, term_id, n, n / sum(n) OVER (PARTITION BY doc_id) AS tf FROM {name}_n),\n"
        f"{name} AS MATERIALIZED (SELECT doc_id, term_id, n, tf, tf * idf AS w FROM {name}_tf JOIN idf USING (term_id))"
    )


BASE = f"{TOK},\n{WORDS},\n{CLASS},\n{selection(N_TERMS)},\n{weighted('train', 'words')}"
TESTED = f"{BASE},\n{TEST},\n{exploded('test_words', 'test')},\n{weighted('tst', 'test_words')}"
ENTROPY = (
    "sums AS (SELECT term_id, sum(w) AS s FROM train GROUP BY term_id),\n"
    "ent AS MATERIALIZED (SELECT term_id, 1 + sum(CASE WHEN w > 0 THEN (w / s) * ln(w / s) ELSE 0 END) "
    "/ ln((SELECT count(*) FROM documents)::DOUBLE) AS e FROM train JOIN sums USING (term_id) GROUP BY term_id)"
)

V = "v AS MATERIALIZED (SELECT vec_id AS id, label, embedding::DOUBLE[] AS x FROM embeddings)"
DIMS = "dims AS MATERIALIZED (SELECT id, label, unnest(x) AS x, generate_subscripts(x, 1) - 1 AS dim FROM v)"
MEANS = "means AS MATERIALIZED (SELECT label, dim, avg(x) AS m FROM dims GROUP BY ALL)"
CENTRES = "centres AS MATERIALIZED (SELECT label, list(m ORDER BY dim) AS c FROM means GROUP BY label)"


def knn(distance: str) -> str:
    return f"""{with_(V)},
ranked AS (SELECT q.id, t.label, row_number() OVER (PARTITION BY q.id ORDER BY {distance}, t.id) AS rn FROM v q, v t),
votes AS (SELECT id, label, count(*) AS n FROM ranked WHERE rn <= {NEIGHBOURS} GROUP BY ALL)
SELECT id, label AS prediction FROM votes QUALIFY row_number() OVER (PARTITION BY id ORDER BY n DESC, label) = 1"""


def inverse(condition: str = "true") -> str:
    """``inv(m)``: the inverse of the vectors' covariance by Gauss-Jordan elimination, as a list of rows."""
    return f"""cov AS (SELECT a.dim AS i, b.dim AS j, covar_samp(a.x, b.x) AS c FROM dims a JOIN dims b USING (id) WHERE {condition} GROUP BY ALL),
lines AS (SELECT i, list(c ORDER BY j) AS r FROM cov GROUP BY i),
wide AS (SELECT list(list_concat(r, list_transform(range(len(r)), lambda e: (e = i)::INT::DOUBLE)) ORDER BY i) AS a FROM lines),
steps AS (
  SELECT 0 AS p, a FROM wide
  UNION ALL
  SELECT p + 1, list_transform(a, lambda line, k: CASE WHEN k = p + 1 THEN list_transform(line, lambda e: e / lead_)
    ELSE list_transform(list_zip(line, chosen), lambda z: z[1] - z[2] * line[p + 1] / lead_) END)
  FROM (SELECT p, a, a[p + 1] AS chosen, a[p + 1][p + 1] AS lead_ FROM steps WHERE p < len(a))
),
inv AS MATERIALIZED (SELECT list_transform(a, lambda line: line[len(a) + 1:]) AS m FROM steps WHERE p = len(a)),
white AS MATERIALIZED (SELECT id, label, x, list_transform(m, lambda r: list_inner_product(r, x)) AS y FROM v, inv)"""


MAHALANOBIS = "list_inner_product(q.x, q.y) - 2 * list_inner_product(q.x, t.y) + list_inner_product(t.x, t.y)"


def nearest_centre(distance: str) -> str:
    return f"""{with_(V, DIMS, MEANS, CENTRES)}
SELECT id, centres.label AS prediction FROM v, centres
QUALIFY row_number() OVER (PARTITION BY id ORDER BY {distance}, centres.label) = 1"""


GNB = f"""{V}, {DIMS},
stats AS MATERIALIZED (SELECT label, dim, avg(x) AS mean, var_pop(x) AS variance FROM dims GROUP BY ALL),
prior AS (SELECT label, count(DISTINCT id) / (SELECT count(*) FROM v) AS prior,
  sum((x > 0)::INT) / (SELECT count(*) FROM v) AS prior_positive_cells FROM dims GROUP BY label)"""

# The grid: centroids and naive Bayes fitted on four of five vectors, scored on the rest.
GRID = f"""{with_(V, DIMS)},
train AS (SELECT * FROM dims WHERE id % 5 <> 0),
test AS (SELECT * FROM dims WHERE id % 5 = 0),
st AS MATERIALIZED (SELECT label, dim, avg(x) AS m, var_pop(x) AS s2 FROM train GROUP BY ALL),
pr AS (SELECT label, count(DISTINCT id) / (SELECT count(DISTINCT id) FROM train) AS rows_,
  sum((x > 0)::INT) / (SELECT count(DISTINCT id) FROM train) AS cells_ FROM train GROUP BY label),
sc AS MATERIALIZED (SELECT test.id, any_value(test.label) AS label, st.label AS cand, sum((x - m) * (x - m)) AS d2,
  sum(x * m) / sqrt(sum(m * m)) AS cosine, sum(-0.5 * ln(2 * pi() * s2) - (x - m) * (x - m) / (2 * s2)) AS ll
  FROM test JOIN st USING (dim) GROUP BY test.id, st.label),
picks AS (
  SELECT 'MEAN' AS method, 'euclidean' AS value, id, label, arg_min(cand, d2) AS p FROM sc GROUP BY id, label
  UNION ALL SELECT 'MEAN', 'cosine', id, label, arg_max(cand, cosine) FROM sc GROUP BY id, label
  UNION ALL SELECT 'NB', 'rows', id, sc.label, arg_max(cand, ll + ln(rows_)) FROM sc JOIN pr ON pr.label = cand GROUP BY id, sc.label
  UNION ALL SELECT 'NB', 'positive_cells', id, sc.label, arg_max(cand, ll + ln(cells_)) FROM sc JOIN pr ON pr.label = cand GROUP BY id, sc.label),
grid AS (SELECT method, value, avg((p = label)::INT) AS accuracy FROM picks GROUP BY ALL)"""


def latin_to(charset: str) -> tuple[str, str]:
    """Upper-half Latin-1 characters and what their bytes mean in another charset."""
    source, target = [], []
    for byte in range(0x80, 0x100):
        text = bytes([byte]).decode(charset, errors="ignore")
        if text and text != chr(byte):
            source.append(chr(byte))
            target.append(text)
    return "".join(source), "".join(target)


def outside(charset: str) -> str:
    """A pattern for the characters that a one-byte charset cannot write."""
    inside = [bytes([b]).decode(charset, errors="ignore") for b in range(1, 0x100)]
    return "[^" + "".join(f"\\x{{{ord(c):X}}}" for c in inside if c) + "]"


# -- stemmer -----------------------------------------------------------------------------------------


def _list(words: str) -> str:
    return "(" + ", ".join(lit(w) for w in words.split()) + ")"


def _when(put: G.PutBack) -> str:
    parts = []
    if put.whole:
        parts.append(f"st IN {_list(put.whole)}")
    if put.ends:
        parts.append(f"regexp_matches(st, {lit('(' + '|'.join(put.ends.split()) + ')$')})")
    if put.vowel:
        parts.append(f"right(st, 1) IN {_list(' '.join(put.vowel))}")
    if put.shorter:
        parts.append(f"length(st) < {put.shorter}")
    out = "TRUE" if put.always else "(" + " OR ".join(parts) + ")"
    if put.not_whole:
        out += f" AND st NOT IN {_list(put.not_whole)}"
    if put.not_ends:
        out += f" AND NOT regexp_matches(st, {lit('(' + '|'.join(put.not_ends.split()) + ')$')})"
    return out


def stemmer(source: str) -> str:
    """One common table expression per rule, from ``source(word)`` to ``stems(word, stem)``."""
    irregular = "s"
    for line in G.IRREGULAR.split("\n"):
        if line:
            kept, *cut = line.split()
            pattern = lit(f"{kept}({'|'.join(cut)})$")
            irregular = f"regexp_replace({irregular}, {pattern}, {lit(kept)})"
    plain = f"length(word) < {G.MIN_CHARS} OR NOT regexp_matches(word, '^[Α-Ωα-ω]+$')"
    ctes = [f"r0 AS (SELECT word, ({plain}) AS keep, {irregular} AS s FROM (SELECT word, word AS s FROM {source}))"]
    for i, rule in enumerate(G.RULES):
        s = f"CASE WHEN word = '{G.SPECIAL_WORD}' THEN '{G.SPECIAL_STEM}' ELSE s END" if rule.step == "5a" else "s"
        cut = lit("^(.+?)(" + "|".join(rule.endings.split()) + ")$")
        cases = ["WHEN st = '' THEN s"]
        if rule.if_same_length:
            cases.append("WHEN length(s) <> length(word) THEN s")
        if rule.keep:
            cases.append(f"WHEN st IN {_list(rule.keep)} THEN s")
        cases += [f"WHEN {_when(p)} THEN st || {lit(p.text)}" for p in rule.put_back]
        ctes.append(
            f"r{i + 1} AS MATERIALIZED (SELECT word, keep, CASE {' '.join(cases)} ELSE st END AS s FROM "
            f"(SELECT word, keep, s, regexp_extract(s, {cut}, 1) AS st FROM (SELECT word, keep, {s} AS s FROM r{i})))"
        )
    ctes.append(f"stems AS (SELECT word, CASE WHEN keep THEN word ELSE s END AS stem FROM r{len(G.RULES)})")
    return ",\n".join(ctes)


def tokens_of(source: str, expression: str, *parts: str) -> str:
    return f"{with_(*parts)} SELECT doc_id, array_to_string({expression}, ' ') AS tokens FROM {source}"


def text_query(expression: str) -> str:
    return f"SELECT doc_id, {expression} AS text FROM documents"


def first_axis(entry: str) -> str:
    """Leading axis of a matrix over the vectors' columns by power iteration; ``entry`` is a cell from columns a.x, b.x."""
    return power(
        f"{V}, {DIMS}, cells AS (SELECT a.dim AS i, b.dim AS j, {entry} AS c FROM dims a JOIN dims b USING (id) GROUP BY ALL)", 4000
    ) + " SELECT (generate_subscripts(x, 1) - 1)::INT AS dim, round(abs(unnest(x)), 7) AS weight FROM axis"


def power(cells: str, steps: int) -> str:
    """``axis(x, value)``: leading unit vector and its eigenvalue, from ``cells(i, j, c)``."""
    return f"""WITH RECURSIVE {cells},
lines AS (SELECT i, list(c ORDER BY j) AS r FROM cells GROUP BY i),
m AS MATERIALIZED (SELECT list(r ORDER BY i) AS m FROM lines),
power AS (
  SELECT 0 AS step, list_transform(range(len(m)), lambda i: 1.0::DOUBLE / (1 + i)) AS x, 0::DOUBLE AS value FROM m
  UNION ALL
  SELECT step + 1, list_transform(y, lambda e: e / sqrt(list_inner_product(y, y))), sqrt(list_inner_product(y, y))
  FROM (SELECT step, list_transform(m, lambda r: list_inner_product(r, x)) AS y FROM power, m WHERE step < {steps})
),
axis AS (SELECT x, value FROM power WHERE step = {steps})"""


# The terms that the documents outside of each of five folds select.
FOLDED = f"""{TOK}, {WORDS}, folds AS (SELECT range::INT AS fold FROM range(5)),
fcls AS MATERIALIZED (SELECT fold, label, term, count(*) AS n, count(DISTINCT doc_id) AS df FROM folds JOIN words ON doc_id % 5 <> fold GROUP BY ALL),
ftf AS MATERIALIZED (SELECT *, n / sum(n) OVER (PARTITION BY fold, label) AS tf FROM fcls),
fk AS (SELECT fold, count(DISTINCT lang)::DOUBLE AS c, count(*) AS docs FROM folds JOIN documents ON doc_id % 5 <> fold GROUP BY fold),
fmean AS (SELECT fold, term, sum(tf) / any_value(c) AS m, count(*) AS present, any_value(c) AS c, sum(df)::BIGINT AS df, any_value(docs) AS docs
  FROM ftf JOIN fk USING (fold) GROUP BY fold, term),
fvar AS (SELECT fold, term, (sum((tf - m) * (tf - m)) + (any_value(c) - any_value(present)) * any_value(m) * any_value(m)) / any_value(c) AS var,
  any_value(fmean.df) AS df, any_value(docs) AS docs FROM ftf JOIN fmean USING (fold, term) GROUP BY fold, term),
fpower AS (SELECT *, CASE WHEN var > 0 THEN floor(log10(var)) END AS power FROM fvar),
fsel AS MATERIALIZED (SELECT fold, term, var, df, docs, row_number() OVER (
  PARTITION BY fold ORDER BY power DESC NULLS LAST, round(var / pow(10.0, power), 10) DESC, term) AS rank FROM fpower QUALIFY rank <= {N_TERMS})"""

LATIN1, CP1251 = latin_to("cp1251")
NGRAM = with_(TOK, WORDS, PAIRS, UNI, BI, PMI, KEPT)
APPENDED = f"""{TOK}, {WORDS}, {PAIRS}, {UNI}, {BI}, {PMI}, {KEPT},
found AS (SELECT doc_id, label, list(w1 || ' ' || w2 ORDER BY pos) AS extra FROM adjacent SEMI JOIN kept USING (w1, w2) GROUP BY ALL),
both_ AS MATERIALIZED (SELECT doc_id, tok.label, list_concat(tokens, coalesce(extra, [])) AS tokens FROM tok LEFT JOIN found USING (doc_id))"""

ORACLE = {
    "scan_raw": "SELECT doc_id, lang AS label, translate(regexp_replace(text, "
    + lit(outside("iso8859_7")) + ", '', 'g'), chr(10) || chr(150), '  ') AS text FROM documents",
    "corpus_union": "SELECT doc_id, text, 'train' AS split FROM documents UNION ALL SELECT page_id, html, 'test' FROM pages",
    "raw_articles": "SELECT doc_id, lang AS label, translate(text, chr(10) || chr(150), '  ') AS text FROM documents",
    "to_utf8": f"""SELECT doc_id, CASE WHEN latin THEN translate(text, {lit(LATIN1)}, {lit(CP1251)}) ELSE text END AS text,
CASE WHEN latin THEN 'cp1251' ELSE 'UTF-8' END AS encoding_was
FROM (SELECT doc_id, text, regexp_matches(text, '[^\\x00-\\x7F]') AND NOT regexp_matches(text, '[^\\x00-\\x{{FF}}]') AS latin FROM documents)""",
    "lexicon": f"SELECT DISTINCT {upper('w')} AS term FROM (SELECT unnest(regexp_split_to_array(text, '\\s+')) AS w FROM benchmark) WHERE w <> ''",
    "stage_roundtrip": f"{with_(TOK)} SELECT label, count(*) AS n_docs, sum(len(tokens))::BIGINT AS n_tokens FROM tok GROUP BY label",
    "head_n": "SELECT doc_id, lang AS label, text FROM documents ORDER BY doc_id LIMIT 100",
    "strip_accents": text_query("strip_accents(text)"),
    "upper_text": text_query(upper("text")),
    "merge_decimals": text_query(f"regexp_replace(text, {lit(DECIMAL)}, '\\1\\2', 'g')"),
    "collapse_acronyms": text_query(f"regexp_replace(text, {lit(ACRONYM)}, '\\1\\2\\3\\4\\5', 'g')"),
    "clean_nonword": text_query("regexp_replace(strip_accents(text), '[^\\p{L}\\p{N}_]+', ' ', 'g')"),
    "tokenize": text_query(f"array_to_string({tokenized('text')}, ' ')").replace("AS text", "AS tokens"),
    "tokenize_as_written": text_query(f"array_to_string({tokenized('text', True)}, ' ')").replace("AS text", "AS tokens"),
    "drop_stopwords": tokens_of("plain, short_words", "list_filter(tokens, lambda t: NOT list_contains(l, t))", PLAIN, BENCH),
    "stem_vocab": with_(
        TOK, f"spelt AS MATERIALIZED (SELECT DISTINCT translate(unnest(tokens), {lit(LATIN)}, {lit(GREEK)}) AS word FROM tok)",
        stemmer("spelt")) + " SELECT word, stem FROM stems",
    "mark_numbers": tokens_of("plain", numbers("tokens"), PLAIN),
    "mark_lexicon": tokens_of(
        "plain, long_words", "list_transform(tokens, lambda t: CASE WHEN list_contains(l, t) THEN 'COUNTRYVALUE' ELSE t END)",
        PLAIN, BENCH),
    "min_len": tokens_of("plain", long_enough("tokens"), PLAIN),
    "preprocess": tokens_of(
        "plain, short_words, (SELECT l AS l2 FROM long_words)",
        long_enough(
            "list_transform(" + numbers("list_filter(tokens, lambda t: NOT list_contains(l, t))")
            + ", lambda t: CASE WHEN list_contains(l2, t) THEN 'COUNTRYVALUE' ELSE t END)"),
        PLAIN, BENCH),
    "bigrams": f"{with_(TOK, WORDS, PAIRS)} SELECT doc_id, pos::INT AS pos, w1, w2 FROM adjacent",
    "ngram_counts": f"{with_(TOK, WORDS, PAIRS, UNI)} SELECT term AS w1, '' AS w2, n FROM uni "
    "UNION ALL SELECT w1, w2, count(*) FROM adjacent GROUP BY ALL",
    "bigram_min_freq": f"{with_(TOK, WORDS, PAIRS, BI)} SELECT w1, w2, freq FROM bi",
    "bigram_pmi": f"{NGRAM} SELECT term, freq, round(pmi, 9) AS pmi FROM pmi",
    "top_bigrams": f"{NGRAM} SELECT term, freq, round(pmi, 9) AS pmi FROM kept",
    "append_bigrams": f"{with_(APPENDED)} SELECT doc_id, array_to_string(tokens, ' ') AS tokens FROM both_",
    "bigram_by_variance": with_(
        APPENDED, "all_words AS MATERIALIZED (SELECT doc_id, label, unnest(tokens) AS term FROM both_)", class_stats("all_words"))
    + " SELECT term, round(var, 12) AS var FROM kept JOIN var USING (term) ORDER BY round(var, 12) DESC, term LIMIT 40",
    "dictionary": f"{with_(TOK, WORDS)}, seen AS (SELECT term, min((doc_id, pos)) AS f FROM words GROUP BY term) "
    "SELECT term, row_number() OVER (ORDER BY f) - 1 AS term_id FROM seen",
    "id_to_term": f"{with_(TOK, WORDS)} SELECT doc_id, term, count(*) AS n FROM words GROUP BY ALL",
    "term_counts": f"{with_(TOK, WORDS)}, seen AS (SELECT term, min((doc_id, pos)) AS f FROM words GROUP BY term), "
    "ids AS (SELECT term, row_number() OVER (ORDER BY f) - 1 AS term_id FROM seen) "
    "SELECT doc_id, term_id, count(*) AS n FROM words JOIN ids USING (term) GROUP BY ALL",
    "class_tf": f"{with_(TOK, WORDS, CLASS)} SELECT label, term, round(tf, 12) AS tf FROM ctf",
    "class_variance": f"{with_(TOK, WORDS, CLASS)} SELECT term, round(var, 12) AS var FROM var",
    "select_terms": f"{with_(TOK, WORDS, CLASS, selection(N_TERMS))} SELECT term, round(var, 12) AS var FROM sel",
    "tf": f"{with_(BASE)} SELECT doc_id, term_id, round(tf, 9) AS tf FROM train",
    "doc_freq": f"{with_(BASE)} SELECT term_id, df FROM df",
    "idf": f"{with_(BASE)} SELECT term_id, df, round(idf, 9) AS idf FROM idf",
    "tfidf_train": f"{with_(BASE)} SELECT doc_id, term_id, round(w, 9) AS w FROM train",
    "tfidf_test": f"{with_(TESTED)} SELECT doc_id, term_id, round(w, 9) AS w FROM tst",
    "term_pair_mi": with_(TOK, WORDS, CLASS, selection(N_TERMS)) + """,
has AS MATERIALIZED (SELECT DISTINCT doc_id, term_id FROM words JOIN sel USING (term)),
co AS (SELECT a.term_id AS i, b.term_id AS j, count(*) AS co FROM has a JOIN has b ON a.doc_id = b.doc_id AND a.term_id <> b.term_id GROUP BY ALL),
p AS (SELECT a.term AS term_a, b.term AS term_b, a.df AS df_a, b.df AS df_b,
  (SELECT count(*) FROM documents) - a.df - b.df + 2 * coalesce(co, 0) AS agree
  FROM df a JOIN df b ON (a.df, a.term) < (b.df, b.term) LEFT JOIN co ON co.i = a.term_id AND co.j = b.term_id)
SELECT term_a, term_b, agree, round(mi, 9) AS mi FROM (
  SELECT *, log2(((SELECT count(*) FROM documents)::DOUBLE * agree) / (df_a::DOUBLE * df_b)) AS mi FROM p WHERE agree > 0)
ORDER BY mi DESC, df_a, term_a, df_b, term_b LIMIT 1000""",
    "term_weights": f"{with_(TOK, WORDS, CLASS, selection(N_TERMS))} SELECT (term_id + 1)::INT AS rank, term, "
    "round(CASE WHEN term_id = 0 THEN var / 6 ELSE var END, 12) AS weight FROM sel WHERE term_id < 200",
    "label_set": "SELECT lang AS label, count(*) AS n_docs FROM documents GROUP BY lang",
    "feature_vectors": f"{with_(BASE)} SELECT doc_id, count(*) FILTER (w > 0)::INT AS n_terms, round(coalesce(sum(w), 0), 9) AS total "
    "FROM documents LEFT JOIN train USING (doc_id) GROUP BY doc_id",
    "tx_entropy": f"{with_(BASE, ENTROPY)} SELECT doc_id, term_id, round(e * ln(1 + w), 9) AS w FROM train JOIN ent USING (term_id)",
    "tx_binary": f"{with_(BASE)} SELECT doc_id, term_id, (w > 0)::INT::DOUBLE AS w FROM train",
    "tx_log": f"{with_(BASE)} SELECT doc_id, term_id, round(ln(1 + w), 9) AS w FROM train",
    "tx_none": f"{with_(BASE)} SELECT doc_id, term_id, round(w, 9) AS w FROM train",
    "tx_test": f"{with_(TESTED, ENTROPY)} SELECT doc_id, term_id, round(e * ln(1 + w), 9) AS w FROM tst JOIN ent USING (term_id)",
    "pca_first_axis": first_axis("covar_samp(a.x, b.x)"),
    "svd_first_axis": first_axis("sum(a.x * b.x)"),
    # the documents' places on the first axis are the leading vector of their centred products, times the root of its value
    "pca_wide": power(f"""{TOK}, {WORDS}, {CLASS}, {selection(WIDE_TERMS)},
has AS MATERIALIZED (SELECT DISTINCT doc_id, term_id FROM words JOIN sel USING (term)),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM has a JOIN has b USING (term_id) GROUP BY ALL),
pairs AS MATERIALIZED (SELECT a.doc_id AS i, b.doc_id AS j, coalesce(c, 0)::DOUBLE AS c
  FROM documents a CROSS JOIN documents b LEFT JOIN shared ON shared.a = a.doc_id AND shared.b = b.doc_id),
means AS (SELECT i, avg(c) AS m FROM pairs GROUP BY i),
cells AS (SELECT i, j, c - a.m - b.m + (SELECT avg(c) FROM pairs) AS c FROM pairs JOIN means a USING (i) JOIN means b ON b.i = j)""", 120)
    + ", ids AS (SELECT list(doc_id ORDER BY doc_id) AS ids FROM documents) "
    "SELECT unnest(ids) AS doc_id, round(sqrt(value) * abs(unnest(x)), 6) AS first_axis FROM axis, ids",
    "lda_scatter": f"""{with_(V, DIMS, MEANS)},
n AS (SELECT label, count(*) AS n, count(*) / (SELECT count(*) FROM v) AS p FROM v GROUP BY label),
grand AS (SELECT dim, avg(x) AS g FROM dims GROUP BY dim),
cov AS (SELECT a.label, a.dim AS i, b.dim AS j, covar_samp(a.x, b.x) AS c FROM dims a JOIN dims b ON a.id = b.id AND a.dim <= b.dim GROUP BY ALL)
SELECT 'within' AS kind, i::INT AS i, j::INT AS j, round(sum(p * c), 10) AS value FROM cov JOIN n USING (label) GROUP BY i, j
UNION ALL SELECT 'between', a.dim::INT, b.dim::INT, round(sum(p * (a.m - ga.g) * (b.m - gb.g)), 10)
FROM means a JOIN means b ON a.label = b.label AND a.dim <= b.dim JOIN grand ga ON ga.dim = a.dim JOIN grand gb ON gb.dim = b.dim
JOIN n ON n.label = a.label GROUP BY a.dim, b.dim""",
    "covariance": f"{with_(V, DIMS)} SELECT a.dim::INT AS i, b.dim::INT AS j, round(covar_samp(a.x, b.x), 10) AS value "
    "FROM dims a JOIN dims b ON a.id = b.id AND a.dim <= b.dim GROUP BY ALL",
    "encode_labels": "SELECT doc_id, lang AS label, (dense_rank() OVER (ORDER BY lang) - 1)::INT AS label_idx FROM documents",
    "argmax_decode": "SELECT vec_id AS id, (list_position(embedding, list_max(embedding)) - 1)::INT AS prediction FROM embeddings",
    "split_at": "SELECT doc_id, CASE WHEN row_number() OVER (ORDER BY doc_id) <= 700 THEN 'train' ELSE 'test' END AS split FROM documents",
    "kfold": "SELECT doc_id, (doc_id % 5)::INT AS fold FROM documents",
    "knn_euclidean": knn("list_distance(q.x, t.x)"),
    "knn_cosine": knn("1 - list_cosine_similarity(q.x, t.x)"),
    "knn_custom_metric": knn("list_sum(list_transform(list_zip(q.x, t.x), lambda p: abs(p[1] - p[2])))"),
    "knn_mahalanobis": f"""WITH RECURSIVE {V}, {DIMS}, {inverse()},
ranked AS (SELECT q.id, t.label, row_number() OVER (PARTITION BY q.id ORDER BY {MAHALANOBIS}, t.id) AS rn FROM white q, white t),
votes AS (SELECT id, label, count(*) AS n FROM ranked WHERE rn <= {NEIGHBOURS} GROUP BY ALL)
SELECT id, label AS prediction FROM votes QUALIFY row_number() OVER (PARTITION BY id ORDER BY n DESC, label) = 1""",
    "centroid_mahalanobis": f"""WITH RECURSIVE {V}, {DIMS}, {MEANS}, {CENTRES}, {inverse()},
off AS (SELECT id, centres.label, list_transform(list_zip(x, c), lambda p: p[1] - p[2]) AS d FROM v, centres)
SELECT id, label AS prediction FROM off, inv
QUALIFY row_number() OVER (PARTITION BY id ORDER BY list_inner_product(d, list_transform(m, lambda r: list_inner_product(r, d))), label) = 1""",
    "grid_knn": f"""WITH RECURSIVE {V}, {DIMS}, {inverse("id % 5 <> 0")},
found AS MATERIALIZED (SELECT q.id, q.label AS truth, t.id AS other, t.label, [list_distance(q.x, t.x), 1 - list_cosine_similarity(q.x, t.x), {MAHALANOBIS}] AS d
  FROM white q, white t WHERE q.id % 5 = 0 AND t.id % 5 <> 0),
each AS (SELECT id, truth, other, label, unnest(['euclidean', 'cosine', 'mahalanobis']) AS metric, unnest(d) AS d FROM found),
ranked AS (SELECT *, row_number() OVER (PARTITION BY metric, id ORDER BY d, other) AS rn FROM each),
votes AS (SELECT metric, n_neighbors, id, truth, label, count(*) AS n FROM ranked JOIN (SELECT unnest([5, 10, 20]) AS n_neighbors) ON rn <= n_neighbors GROUP BY ALL),
picks AS (SELECT * FROM votes QUALIFY row_number() OVER (PARTITION BY metric, n_neighbors, id ORDER BY n DESC, label) = 1)
SELECT metric, n_neighbors, round(avg((label = truth)::INT), 9) AS accuracy FROM picks GROUP BY ALL""",
    "centroids": f"{with_(V, DIMS, MEANS)} SELECT label, dim::INT AS dim, round(m, 9) AS mean FROM means",
    "centroid_euclidean": nearest_centre("list_distance(x, c)"),
    "centroid_cosine": nearest_centre("1 - list_cosine_similarity(x, c)"),
    "gnb_fit": f"{with_(GNB)} SELECT label, dim::INT AS dim, round(mean, 9) AS mean, round(variance, 9) AS variance, "
    "round(prior, 9) AS prior, round(prior_positive_cells, 9) AS prior_positive_cells FROM stats JOIN prior USING (label)",
    "gnb_predict": f"{with_(GNB)}, scored AS (SELECT d.id, s.label, "
    "sum(-0.5 * ln(2 * pi() * s.variance) - (d.x - s.mean) * (d.x - s.mean) / (2 * s.variance)) + ln(any_value(p.prior)) AS lp "
    "FROM dims d JOIN stats s USING (dim) JOIN prior p ON p.label = s.label GROUP BY d.id, s.label) "
    "SELECT id, arg_max(label, lp) AS prediction FROM scored GROUP BY id",
    "accuracy": nearest_centre("list_distance(x, c)").replace("SELECT id, centres.label AS prediction FROM v, centres", "SELECT round(avg((p = label)::INT), 9) AS accuracy FROM (SELECT v.label, centres.label AS p FROM v, centres") + ")",
    "grid_centroid": f"{GRID} SELECT method, value AS params, round(accuracy, 9) AS accuracy FROM grid",
    "kfold_centroid": f"""{with_(V, DIMS)}, folds AS (SELECT range AS fold FROM range(5)),
st AS (SELECT fold, label, dim, avg(x) AS m FROM folds JOIN dims ON id % 5 <> fold GROUP BY ALL),
sc AS (SELECT fold, id, any_value(dims.label) AS label, st.label AS cand, sum((x - m) * (x - m)) AS d2
  FROM dims JOIN st ON st.dim = dims.dim AND id % 5 = fold GROUP BY fold, id, st.label),
picks AS (SELECT fold, id, label, arg_min(cand, d2) AS p FROM sc GROUP BY fold, id, label)
SELECT fold::INT AS fold, 'MEAN' AS method, round(avg((p = label)::INT), 9) AS accuracy FROM picks GROUP BY fold""",
    "kfold_terms": f"{with_(FOLDED)} SELECT fold, rank::INT AS rank, term, round(var, 12) AS var, df, round(ln(docs::DOUBLE / df), 9) AS idf FROM fsel",
    # a binary cell x adds (2 x m - m^2 - x) / 2 s2 to the log density, so only present terms are rows
    "kfold_nb": f"""{with_(FOLDED)},
has AS MATERIALIZED (SELECT DISTINCT fold, doc_id, label, term FROM words JOIN fsel USING (term) WHERE df < docs),
sizes AS (SELECT fold, lang AS label, count(*) AS n FROM folds JOIN documents ON doc_id % 5 <> fold GROUP BY ALL),
held AS (SELECT fold, label, term, count(*) AS n FROM has WHERE doc_id % 5 <> fold GROUP BY ALL),
p AS (SELECT sizes.fold, sizes.label, term, coalesce(held.n, 0) / sizes.n AS m FROM sizes JOIN fsel USING (fold) LEFT JOIN held USING (fold, label, term)),
g AS MATERIALIZED (SELECT fold, label, term, m, greatest(m * (1 - m), 1e-9 * max(m * (1 - m)) OVER (PARTITION BY fold)) AS s2 FROM p),
base AS (SELECT fold, label, sum(-0.5 * ln(2 * pi() * s2) - m * m / (2 * s2)) AS b FROM g GROUP BY ALL),
prior AS (SELECT fold, label, ln(n / sum(n) OVER (PARTITION BY fold)) AS lp FROM sizes),
gains AS (SELECT has.fold, doc_id, g.label, sum((2 * m - 1) / (2 * s2)) AS gain FROM has JOIN g USING (fold, term) WHERE doc_id % 5 = has.fold GROUP BY ALL),
scored AS (SELECT base.fold, d.doc_id, d.lang AS truth, base.label, b + lp + coalesce(gain, 0) AS score
  FROM documents d JOIN base ON d.doc_id % 5 = base.fold JOIN prior USING (fold, label) LEFT JOIN gains ON gains.fold = base.fold AND gains.doc_id = d.doc_id AND gains.label = base.label),
picks AS (SELECT fold, doc_id, any_value(truth) AS truth, arg_max(label, score) AS pick FROM scored GROUP BY fold, doc_id)
SELECT fold, 'NB' AS method, round(avg((pick = truth)::INT), 9) AS accuracy FROM picks GROUP BY fold""",
    "score_labels": f"{GRID} SELECT method, CASE method WHEN 'MEAN' THEN 'metric=' ELSE 'prior=' END || value AS label, "
    "round(100 * accuracy, 1) AS percent FROM grid",
    "score_series": f"{GRID} SELECT method AS series, "
    + ", ".join(f"round(max(accuracy) FILTER (value = '{v}'), 9) AS {v}" for v in ("cosine", "euclidean", "positive_cells"))
    + ", round(max(accuracy) FILTER (value = 'rows'), 9) AS \"rows\" FROM grid GROUP BY method",
}
