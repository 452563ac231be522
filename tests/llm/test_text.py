"""Packing, token counts, decontamination, personal data, toxicity, quality and the pipeline."""

import math
import re
import zlib
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from themata.llm import length_histogram, packing, pii, positional_index, quality, toxicity
from themata.llm.tokens import public_tokenizer


@pytest.fixture(scope="module")
def ids(rows):
    tokenizer = Tokenizer.from_file(public_tokenizer())
    return {i: tokenizer.encode(text or "", add_special_tokens=False).ids for i, text in rows}


@pytest.mark.parametrize("capacity", [64, 2048])
def test_packing(docs, ids, capacity):
    found = packing.best_fit_packing(docs, public_tokenizer(), capacity).collect()
    want = {}
    for i, own in ids.items():
        own = np.array([*own, 0], "<u4")
        for k, start in enumerate(range(0, len(own), capacity)):
            piece = own[start : start + capacity]
            want[i, k] = (start, len(piece), zlib.crc32(piece.tobytes()))
    assert {(r["doc_id"], r["piece"]): (r["start"], r["length"], r["ids_crc32"]) for r in found} == want
    sequences = {}
    for r in found:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in sequences.values():
        places.sort()
        assert [p for p, _ in places] == [sum(n for _, n in places[:k]) for k in range(len(places))]
        assert sum(n for _, n in places) <= capacity
    assert len(sequences) <= math.ceil(1.05 * sum(n for _, n, _ in want.values()) / capacity) + 1


def test_sum_of_squares_rule():
    # gaps 6 and 4 are open; 4 tokens close the second one
    numbers, offsets = packing.sum_of_squares([4, 6, 4, 5], 10)
    assert numbers.tolist() == [0, 0, 1, 1] and offsets.tolist() == [0, 4, 0, 4]


def test_packing_of_null_ids_and_repeated_rows(spark, nothing):
    table = spark.createDataFrame([(None, "a b"), (5, "a b"), (5, "a b")], "doc_id long, text string")
    found = packing.best_fit_packing(table, public_tokenizer()).collect()
    assert sorted(str(r["doc_id"]) for r in found) == ["5", "5", "None"] and len({r["sequence_id"] for r in found}) == 1
    assert packing.best_fit_packing(nothing, public_tokenizer()).count() == 0


def test_length_histogram(docs, ids, nothing):
    sums = length_histogram.length_sums(length_histogram.histogram(docs, public_tokenizer())).cache()
    lengths = np.array([len(own) for own in ids.values()])
    for r in sums.collect():
        n = r["length"]
        assert r["n_docs"] == (lengths == n).sum() and r["docs_from"] == (lengths >= n).sum()
        assert r["tokens_from"] == lengths[lengths >= n].sum() and r["truncated_tokens"] == np.minimum(lengths, n).sum()
        assert r["share_fitting"] == pytest.approx((lengths <= n).mean())
    assert {r["limit"]: r["truncated_tokens"] for r in length_histogram.totals(sums, [7, 10**6]).collect()} == {
        7: np.minimum(lengths, 7).sum(), 10**6: lengths.sum(),
    }
    half = length_histogram.quantiles(sums, [0.5]).first()["length"]
    assert (lengths <= half).mean() >= 0.5 > (lengths < half).mean()
    assert length_histogram.length_sums(length_histogram.histogram(nothing, public_tokenizer())).count() == 0


_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def _words(text):
    return _WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


@pytest.mark.parametrize("limit", [200_000, 1])  # the second one indexes all terms
def test_positional_index(spark, docs, rows, monkeypatch, limit):
    monkeypatch.setattr(positional_index, "MAX_TERMS", limit)
    monkeypatch.setattr(positional_index, "BLOCK_WINDOWS", 40)  # several blocks of windows
    text = dict(rows)
    items = [(0, text[6]), (1, "One, TWO!"), (2, None), (3, "..."), (4, " ".join(text[30].split()[3:20])), (5, "not there at all"), (6, text[6])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    windows = {}
    for i, t in items:
        w = _words(t)
        for k in range(max(1, len(w) - 9) if w else 0):
            windows.setdefault(tuple(w[k : k + 10]), set()).add(i)
    found = {r["doc_id"]: r for r in positional_index.decontaminate(docs, bench).collect()}
    assert len(found) == len(rows)
    for i, t in rows:
        w, hit, of = _words(t), set(), set()
        for item in windows:
            for k in range(len(w) - len(item) + 1):
                if tuple(w[k : k + len(item)]) == item:
                    hit.update(range(k, k + len(item)))
                    of |= windows[item]
        got = found[i]
        assert got["n_words"] == len(w)
        assert {p for h in got["hits"] for p in range(h["position"], h["position"] + h["length"])} == hit
        assert {h["item_id"] for h in got["hits"]} == of


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "alpha x beta gamma"), (2, "alpha beta gamma"), (3, "alpha x x x x beta gamma"), (4, None)], "doc_id long, text string")
    items = positional_index.item_words(spark.createDataFrame([(7, "alpha beta gamma")], "item_id long, text string"))
    index = positional_index.build_index(docs).cache()
    hits = lambda slop: {r["doc_id"] for r in positional_index.search(index, items, slop=slop).collect() if r["hits"]}
    assert hits(0) == {2} and hits(1) == {1, 2} and hits(4) == {1, 2, 3}
    assert positional_index.search(positional_index.build_index(docs.limit(0)), items).count() == 0


_PII = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
]


def _base(text):
    out = []
    for kind, pattern in _PII:
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            luhn = sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(digits))) % 10 == 0
            ok = {"email": True, "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else False, "card": 16 <= len(digits) <= 19 and luhn, "phone": 8 <= len(digits) <= 15}
            if ok[kind]:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return ",".join(out)


def test_personal_data(spark, docs):
    texts = [
        None, "", "mail a.b@c.d_e@f.g, é x@y", "\U0001f600 call +1 (314) 555-6532 or 555-123-4567", "4111 1111 1111 1111 4111-1111-1111-1112",
        "1.2.3.4.5.6.7.8 999.1.1.1", "token = \"0cab398dc11d1a2a11dc6572c8df8bd2\" +123", "9" * 3000, "1 " * 3000, "a" * 3000 + "@", "41111111 1111 1111 1111",
    ]
    table = spark.createDataFrame([(i, t, "b", 1) for i, t in enumerate(texts * 3)], "doc_id long, text string, base string, kind int").repartition(2)
    model = pii.fit(table)
    found = pii.annotate(table, model, base="b1", spans="s1")
    assert found.columns == [*table.columns, "b1", "s1"]
    for r in found.select("text", pii.listed(F.col("b1")).alias("b"), pii.listed(F.col("s1")).alias("s"), pii.redact(F.col("text"), F.col("s1")).alias("clean")).collect():
        assert r["b"] == _base(r["text"])
        assert set(filter(None, r["b"].split(","))) <= set(filter(None, r["s"].split(",")))
        assert not r["text"] or _base(r["clean"]) == ""
    assert pii.annotate(table.limit(0), pii.fit(table.limit(0))).count() == 0


def test_reliabilities_recover_labelers():
    rng = np.random.default_rng(5)
    patterns = {}
    for _ in range(20_000):
        truth = rng.random() < 0.6
        votes = tuple(int(v) for v in np.where(rng.random(5) < [0.95, 0.8, 0.6, 0.9, 0.7], 1 if truth else -1, -1 if truth else 1))
        patterns[0, votes] = patterns.get((0, votes), 0) + 1
    right, _ = pii.reliabilities([(k, v, n) for (k, v), n in patterns.items()])
    assert [round(right[name][0], 1) for name in pii.LABELERS] == pytest.approx([0.95, 0.8, 0.6, 0.9, 0.7], abs=0.06)


def test_maximal_segments_equal_definition():
    rng = np.random.default_rng(6)
    for _ in range(200):
        n = int(rng.integers(1, 30))
        scores = np.where(rng.random(n) < 0.4, rng.integers(1, 5, n) / 2, toxicity.QUIET)
        marked = np.flatnonzero(scores != toxicity.QUIET)
        got = [(a, b) for a, b, _ in toxicity.maximal_segments(marked.tolist(), scores[marked].tolist())]

        def best(low, high):  # Ruzzo & Tompa: the best segment (shortest of equals), then left and right of it
            options = [(round(sum(scores[a:b]), 6), -(b - a), -a, b) for a in range(low, high) for b in range(a + 1, high + 1)]
            top = max(options, default=(0,))
            if top[0] <= 0:
                return []
            a, b = -top[2], top[3]
            return best(low, a) + [(a, b)] + best(b, high)

        assert sum(scores[a:b].sum() for a, b in got) == pytest.approx(sum(scores[a:b].sum() for a, b in best(0, n)))


@pytest.fixture(scope="module")
def labelled(spark):
    rng = np.random.default_rng(8)
    words = ["".join(rng.choice(list("bcdfgaeiou"), 7)) for _ in range(400)]
    rows, labels = [], []
    for i in range(600):
        text = list(rng.choice(words, int(rng.integers(5, 80))))
        bad = int(rng.random() < 0.25)
        if bad:
            text.insert(int(rng.integers(0, len(text))), rng.choice(["vileword", "nastyterm"]))
        rows.append((i, " ".join(text), f"h{i % 7}", "x"))
        labels.append((i, bad, 1 - bad))
    rows += [(600, None, None, None), (601, "", "h1", "x"), (602, "vileword " * 3000, "h1", "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string").repartition(3).cache()
    return docs, spark.createDataFrame(labels, "doc_id long, toxic int, quality int").cache()


def test_toxicity(labelled, nothing):
    docs, labels = labelled
    train = labels.where("doc_id % 3 <> 0")
    model = toxicity.fit(docs, train)
    scored = {r["doc_id"]: r for r in model.score(docs).collect()}
    test = [(r["toxic"], scored[r["doc_id"]]["score"]) for r in labels.where("doc_id % 3 = 0").collect()]
    assert np.mean([(s >= 0.5) == (t == 1) for t, s in test]) > 0.97
    assert len(scored) == 603 and scored[600]["score"] < 0.5 and scored[601]["score"] < 0.5 and scored[602]["score"] > 0.5
    assert {r["doc_id"] for r in model.accepted(docs).collect()} == {i for i, r in scored.items() if r["score"] < 0.5}
    assert model.score(nothing).count() == 0
    assert toxicity.fit(docs, labels.limit(0)).score(docs).where("score < 0.5").count() == 603


def _plain_scores(docs, labels):
    """Log-odds by word, from plain dictionaries of neighbourhoods."""
    words = {i: [w.lower() for w in re.split("[^A-Za-z0-9]+", t or "") if w] for i, t in docs.items()}
    tokens = lambda w: list(dict.fromkeys([w + " ", w[:5], w[:4]]))
    near, corpus = {0: {}, 1: {}}, {}
    for i, own in words.items():
        for w in set(own):
            for t in tokens(w):
                corpus[t] = corpus.get(t, 0) + 1
        if i in labels:
            for before, w, after in zip([None, *own], own, [*own[1:], None]):
                for t in tokens(w):
                    near[labels[i]].setdefault(t, set()).add((before, after))
    n_words = sum(len(set(own)) for own in words.values())
    total = [sum(map(len, near[k].values())) for k in (0, 1)]
    weight, odds, clean = toxicity.PRIOR * sum(total), {}, set()
    for token in near[0].keys() | near[1].keys():
        c, t = (len(near[k].get(token, ())) for k in (0, 1))
        prior = weight * corpus[token] / n_words
        one, other = ((x + prior) / (total[k] + weight - x - prior) for k, x in ((1, t), (0, c)))
        d, spread = math.log(one) - math.log(other), math.sqrt(1 / (t + prior) + 1 / (c + prior))
        if t >= toxicity.SUPPORT and d >= toxicity.EFFECT and d >= toxicity.SIGNIFICANT * spread:
            odds[token] = d
        raw = math.log((t + 0.5) / (total[1] + 1)) - math.log((c + 0.5) / (total[0] + 1))
        if raw + math.sqrt(1 / (t + 0.5) + 1 / (c + 0.5)) < toxicity.EFFECT:
            clean.add(token)

    def score(w):
        for t in tokens(w):
            if t in odds:
                return odds[t]
            if t in clean:
                break
        return toxicity.QUIET

    return odds, {i: [score(w) for w in own] for i, own in words.items()}


def test_toxicity_against_plain_sums(spark):
    """Log-odds, the places and scores of all segments and the evidence; a clean word that begins like a toxic one."""
    rng = np.random.default_rng(17)
    words = ["".join(rng.choice(list("bcdfgaeiou"), 6)) for _ in range(120)] + ["vilemoor"]
    docs, labels = {}, {}
    for i in range(400):
        text = list(rng.choice(words, int(rng.integers(3, 40))))
        labels[i] = int(rng.random() < 0.3)
        for _ in range(3 * labels[i]):
            text.insert(int(rng.integers(0, len(text))), str(rng.choice(["vileword", "vilest", "Nasty"])))
        docs[i] = "  ".join(text) + "."
    docs |= {500: None, 501: "", 502: "vilemoor vileword vileness nasty", 503: docs[3]}
    table = spark.createDataFrame(list(docs.items()), "doc_id long, text string").repartition(5)
    model = toxicity.fit(table, spark.createDataFrame(list(labels.items()), "doc_id long, toxic int"))
    odds, scores = _plain_scores(docs, labels)
    got = dict(zip(model.tokens, model.scores))
    assert {t: s for t, s in got.items() if s != toxicity.QUIET} == pytest.approx(odds)
    assert got["vilemoor "] == toxicity.QUIET and got["vileword "] > toxicity.EFFECT and got["vile"] > toxicity.EFFECT

    def best(own, low, high):
        options = [(round(sum(own[a:b]), 9), a - b, -a) for a in range(low, high) for b in range(a + 1, high + 1)]
        top = max(options, default=(0,))
        if top[0] <= 0:
            return []
        a, b = -top[2], -top[2] - top[1]
        return best(own, low, a) + [(a, b, pytest.approx(top[0]))] + best(own, b, high)

    for r in model.score(table).where("doc_id < 50 or doc_id >= 500").collect():
        want = best(scores[r["doc_id"]], 0, len(scores[r["doc_id"]]))
        assert [(s["start"], s["stop"], s["score"]) for s in r["segments"]] == want
        top = max((s["score"] for s in r["segments"]), default=None)
        assert r["evidence"] == pytest.approx(0.0 if top is None else model.decay * top - math.log(toxicity.CHANCE * r["n_words"]))


def test_quality(labelled, nothing):
    docs, labels = labelled
    scored = quality.site_quality(docs, labels.where("doc_id % 3 <> 0"), F.col("source"), F.concat_ws("/", "source", "lang"))
    scored = {r["doc_id"]: r for r in scored.collect()}
    test = [(r["quality"], scored[r["doc_id"]]["score"]) for r in labels.where("doc_id % 3 = 0").collect()]
    assert len(scored) == 603 and np.mean([(s >= 0.5) == (q == 1) for q, s in test]) > 0.85
    assert all(0 < r["path_share"] < 1 for r in scored.values())
    alone = quality.site_quality(docs, labels.limit(0), F.col("source"), F.col("lang"))
    assert {round(r["score"], 6) for r in alone.collect()} == {0.5}
    empty = docs.limit(0)
    assert quality.site_quality(empty, labels, F.col("source"), F.col("lang")).count() == 0


def test_whole_ibans_secrets_and_addresses(spark):
    """Every country's length, spaced or not, and long secrets and addresses, are found to their end."""
    lengths = {name: n for n, names in pii.IBAN_LENGTHS.items() for name in names.split("|")}
    assert set(lengths) == set(pii.COUNTRIES[4:-1].split("|"))
    ibans = ["DE89370400440532013000", "GB82WEST12345698765432", *[(c + "00" + "1234567890" * 3)[:n] for c, n in lengths.items()]]
    wanted = {f"pay {v} IN full": ("iban", v) for v in ibans}
    spaced = [" ".join(v[i : i + 4] for i in range(0, len(v), 4)) for v in ibans]
    wanted |= {f"pay {v} IN full": ("iban", v) for v in spaced}
    secret, local = "token=" + "a1" * 150, "n" * 80
    wanted |= {f"the {secret} here": ("secret", secret), f"ask {local} [at] mail.a1.b2.c3.d4.{'h' * 70}.org now": ("at_email", None)}
    table = spark.createDataFrame([(t,) for t in wanted], "text string")
    matches = {k: v for k, v in pii._matches(F.col("text")).items() if k in ("iban", "secret", "at_email")}
    good = pii._checks()
    checked = lambda kind: F.filter(matches[kind], lambda s: good[kind](s.value)).alias(kind)
    found = table.select("text", *map(checked, matches)).collect()
    for row in found:
        kind, value = wanted[row["text"]]
        assert [s["value"] for s in row[kind]] == [value or row["text"][4:-4]]


def test_items_that_share_an_id(spark):
    """Windows of items with one id, or none, and of an item that stands twice, are each looked up."""
    made = [" ".join(f"{name}{i}" for i in range(14)) for name in "abcde"]
    bench = spark.createDataFrame([(0, made[0]), (0, made[1]), (None, made[2]), (None, made[3]), (1, made[4]), (1, made[4])], "item_id long, text string")
    table = spark.createDataFrame([(i, f"before {t} after") for i, t in enumerate(made)], "doc_id long, text string")
    found = {r["doc_id"]: r["hits"] for r in positional_index.decontaminate(table, bench).collect()}
    assert [{h["item_id"] for h in found[i]} for i in range(5)] == [{0}, {0}, {None}, {None}, {1}]
    assert all({(h["start"], h["position"]) for h in found[i]} == {(k, k + 1) for k in range(5)} for i in range(5))


def test_counts_by_kind(spark, tmp_path):
    from themata.llm.queries import QUERIES

    texts = ["a@b.cd and c@d.ef and 1.2.3.4", None, "", "call +49 30 1234567, pay 4111 1111 1111 1111", "x@y.zz 1.2.3.4 5.6.7.8 9.9.9.999"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = {r["doc_id"]: (r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]) for r in QUERIES["op4_weak_supervision_pii"](spark, str(tmp_path)).collect()}
    assert found == {0: (2, 1, 0, 0), 1: (0, 0, 0, 0), 2: (0, 0, 0, 0), 3: (0, 0, 1, 1), 4: (1, 2, 0, 0)}


def test_ids_of_dotted_capital_i(spark):
    tokenizer = Tokenizer.from_file(public_tokenizer())
    texts = ["ŞİRKETİ.", "GENEL MÜDÜRLÜĞÜ (ANKARA İLİ), 2024", "İ. İ, İ!", "aİ' İs't"]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc_id"]: (r["length"], r["ids_crc32"]) for r in packing.best_fit_packing(table, public_tokenizer()).collect()}
    ids = [np.array([*tokenizer.encode(t, add_special_tokens=False).ids, 0], "<u4") for t in texts]
    assert found == {i: (len(own), zlib.crc32(own.tobytes())) for i, own in enumerate(ids)}


def test_toxic_neighbourhoods_of_little_text_per_task(spark):
    rows = spark.range(6000, numPartitions=1).select("id", F.repeat(F.concat(F.lit("word "), F.col("id")), 50).alias("text"), F.lit(1).alias("toxic"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0]
    sizes = [sum(len(r["text"]) for r in part) for part in toxicity._dealt(rows).rdd.glom().collect()]
    assert size > 2 * toxicity.TASK_BYTES
    assert max(sizes) < 1.2 * toxicity.TASK_BYTES and sum(sizes) == size


def test_texts_are_kept_or_rejected_in_small_blocks(monkeypatch):
    class Docs:  # hands over what runs in a task
        columns, schema = ["doc_id", "lang", "text"], None
        sparkSession = sparkContext = property(lambda self: self)
        broadcast = staticmethod(lambda value: SimpleNamespace(value=value))
        mapInArrow = staticmethod(lambda work, schema: work)

    seen = []
    scan = toxicity._scan
    monkeypatch.setattr(toxicity, "_scan", lambda column, *rest: (seen.append(column.nbytes), scan(column, *rest))[1])
    model = toxicity.ToxicityModel(["bad "], [3.0], 0.5, [-1.0, 2.0, 0.0, 0.0, 0.0])
    rows = [(i, None if i % 7 == 0 else "en", None if i % 5 == 0 else ("bad " if i % 3 == 0 else "good ") * 1000) for i in range(1200)]
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=Docs.columns)
    kept = pa.Table.from_batches(model.accepted(Docs())(iter([batch.slice(0, 0), batch])))
    assert kept.to_pylist() == [dict(zip(Docs.columns, r)) for r in rows if not (r[2] or "").startswith("bad")]
    assert max(seen) < 2 << 20 < batch.nbytes


def test_texts_are_cut_into_pieces_in_small_blocks(monkeypatch):
    class Docs:  # hands over what runs in a task
        mapInArrow = staticmethod(lambda work, schema: work)

    seen = []
    work = SimpleNamespace(ids=lambda column: (seen.append(column.nbytes), packing_encoder.ids(column))[1])
    packing_encoder = packing.encoder(public_tokenizer())
    monkeypatch.setattr(packing, "encoder", lambda path: work)
    monkeypatch.setattr(packing, "texts", lambda docs, *columns: docs)
    batch = pa.RecordBatch.from_arrays([pa.array(range(600)), pa.array([f"word{i} " * 700 for i in range(600)])], names=["id", "text"])
    made = pa.Table.from_batches(packing.pieces(Docs(), "")(iter([batch])))
    lengths = made.group_by("doc_id").aggregate([("length", "sum")]).sort_by("doc_id")["length_sum"].to_pylist()
    assert lengths == [len(packing_encoder.tokenizer.encode(t, add_special_tokens=False).ids) + 1 for t in batch.column(1).to_pylist()]
    assert max(seen) < 2 << 20 < batch.nbytes


def test_toxic_neighbourhoods_move_as_words(spark, monkeypatch):
    """Tokens are the same as those of the words themselves, and only words are shuffled before they are distinct."""
    texts = ["Éclair abcd abcde ab ABC x", "abcd abcde ab", "", None, "ééééé-éééé éééééé a", "abcde abcd abcde abcd abcde"] * 3
    rows = [(i, t or "", i % 2) for i, t in enumerate(texts)]
    table = spark.createDataFrame(rows, "id long, text string, toxic int").repartition(4)
    near = {}
    for _, text, label in rows:
        own = re.findall("[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+", text)
        own = ["".join(c.lower() if c < "\x80" else c for c in w) for w in own]
        for before, w, after in zip([None, *own], own, [*own[1:], None]):
            for token in {w.lower() + " ", w.lower()[:5], w.lower()[:4]}:
                near.setdefault(token, set()).add((label, before, after))
    monkeypatch.setattr(toxicity, "TASK_BYTES", 100)
    counted = toxicity._neighbourhoods(table)
    plan = counted._jdf.queryExecution().executedPlan().toString()
    got = {r["token"]: (r["n_toxic"], r["n_clean"]) for r in counted.collect()}
    assert got == {t: (sum(x[0] for x in s), sum(1 - x[0] for x in s)) for t, s in near.items()}
    moved = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)
    assert len(moved) == 2 and "near" in moved[1] and "token" not in moved[1], plan
