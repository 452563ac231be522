"""Toxicity of documents by maximum-scoring segments of token log-odds.

Tokens are whole words and their first five and four characters, so that inflected and compound forms share
evidence. A token's log-odds between toxic and other labelled documents have a Dirichlet prior in proportion to
its document frequency in the whole corpus (Monroe, Colaresi & Quinn 2008). Counts are of distinct neighbourhoods (word
before and after), so that copies of a document do not multiply evidence.

A word scores the log-odds of its longest token that is significantly toxic, unless a longer token of it was clean:
then, and without any such token, it scores ``QUIET``. One linear scan (Ruzzo & Tompa 1999) finds all maximal-scoring
segments of a whole text. A segment of score S in n words has expected chance count K n exp(-lambda S), with lambda from
the score frequencies of the whole corpus (Karlin & Altschul 1990). ``evidence`` is lambda S - ln(K n) of the best
segment, the logarithm of how much rarer than chance it is. A logistic curve over it, the sum of all segments and the
length, fitted on the labelled rows, makes a probability.

Labelled rows used for fitting are at most ``LABELLED``, chosen by a hash of the id. Every token of theirs is tested;
what the driver and the tasks hold is bounded by the words of these rows. Everything else covers all documents.

Defined cases: null, empty and wordless texts have no segment and get the score of no evidence; documents with
several labels count as toxic if one says so; without labels of both kinds every score is the share of toxic
labels (0 without any); repeated documents are each scored; an empty table gives an empty table.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from themata.cluster import materialise, unnest
from themata.llm.batches import SCAN_BYTES, Words, blocks, record, texts, translation

#: Labelled rows that the model is fitted on.
LABELLED = 20_000

#: Bytes of labelled text whose neighbourhoods a task makes distinct; a word has three tokens.
TASK_BYTES = 1 << 20

#: Neighbourhoods in toxic documents that a token needs at least.
SUPPORT = 3

#: Weight of the prior, as a share of the labelled words.
PRIOR = 0.01

#: Standard deviations that a token's log-odds must exceed 0.
SIGNIFICANT = 3.0

#: Log-odds below which a token is left quiet: frequent words differ a little between languages and topics.
EFFECT = 1.5

#: Score of words without a significant token.
QUIET = -0.25

#: K of the expected chance count.
CHANCE = 0.1

_APART = translation(lower=True, apart=[c for c in range(128) if not (48 <= c < 58 or 65 <= c < 91 or 97 <= c < 123)])


#: Ends whole words, which differ so from equal beginnings of longer ones.
_END = " "


def _tokens(words: Words) -> list[pa.Array]:
    """Tokens of each word of the vocabulary, longest first; a beginning equal to a longer one is null."""
    lower = pc.utf8_lower(words.vocabulary)
    five, four = pc.utf8_slice_codeunits(lower, 0, 5), pc.utf8_slice_codeunits(lower, 0, 4)
    whole = pc.binary_join_element_wise(lower, pa.scalar(_END, lower.type), "")
    return [whole, five, pc.if_else(pc.equal(five, four), pa.scalar(None, four.type), four)]


def _tasks(labelled: DataFrame) -> int:
    """Tasks of about ``TASK_BYTES`` of text for the stored sample."""
    size = labelled.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(1, math.ceil(size / TASK_BYTES))


def _dealt(labelled: DataFrame) -> DataFrame:
    """The stored sample in tasks of about ``TASK_BYTES`` of text, whatever its files."""
    return labelled.repartition(_tasks(labelled))


def _seen_words(labelled: DataFrame) -> DataFrame:
    """``(word, near, toxic)``: words of the labelled texts in lower case with a hash of the words before and after,
    distinct in each block."""
    schema = pa.schema([("word", pa.string()), ("near", pa.int64()), ("toxic", pa.int32())])

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, 1 << 18):
            words = Words(block.column(1), _APART)
            if not len(words.codes):
                continue
            hashes = pd.util.hash_array(words.vocabulary.to_numpy(zero_copy_only=False)).astype(np.uint64)[words.codes]
            before, after = np.roll(hashes, 1), np.roll(hashes, -1)
            filled = words.counts > 0  # no neighbours beyond the ends of a text
            before[words.bounds[:-1][filled]] = after[words.bounds[1:][filled] - 1] = 0
            near = (before * np.uint64(0x9E3779B97F4A7C15) + after).astype(np.int64)
            label = np.repeat(block.column(2).to_numpy(), words.counts)
            lower = pc.utf8_lower(words.vocabulary).take(pa.array(words.codes))
            seen = pa.table([lower, pa.array(near), pa.array(label)], names=schema.names)
            seen = seen.group_by(schema.names).aggregate([])
            yield from seen.select(schema.names).cast(schema).to_batches()

    return labelled.mapInArrow(emit, "word string, near long, toxic int")


def _neighbourhoods(labelled: DataFrame) -> DataFrame:
    """``(token, n_toxic, n_clean)`` in distinct neighbourhoods of the labelled texts. Words move to the tasks of their
    neighbourhoods and become tokens only there, so that a third of the rows is shuffled."""
    seen = _seen_words(_dealt(labelled)).repartition(_tasks(labelled), "near")
    five, four = F.left("word", F.lit(5)), F.left("word", F.lit(4))
    tokens = F.array(F.concat("word", F.lit(_END)), five, F.when(five != four, four))  # as in _tokens
    found = unnest(seen, ["near", "toxic"], tokens, "token").distinct()
    toxic = F.col("toxic").cast("long")
    return found.groupBy("token").agg(F.sum(toxic).alias("n_toxic"), F.sum(1 - toxic).alias("n_clean"))


def _corpus_counts(rows: DataFrame, tokens: list[str]) -> DataFrame:
    """``(token, n)``: words of all documents with each of ``tokens``, by its place; the null token has all words.
    A word counts once per document."""
    schema = pa.schema([("token", pa.int32()), ("n", pa.int64())])
    shared = rows.sparkSession.sparkContext.broadcast(tokens)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.array(shared.value, pa.string())
        for block in blocks(batches, SCAN_BYTES):
            words = Words(block.column(1), _APART)
            if not len(words.codes):
                continue
            doc = np.repeat(np.arange(block.num_rows), words.counts)
            once = np.unique(doc * len(words.vocabulary) + words.codes)  # a word counts once per document
            n = np.bincount(once % len(words.vocabulary), minlength=len(words.vocabulary))
            total = np.zeros(len(table) + 1)
            for coded in _tokens(words):
                at = pc.fill_null(pc.index_in(coded, table, skip_nulls=True), len(table)).to_numpy()
                total += np.bincount(at, n, minlength=len(total))
            total[-1] = n.sum()
            at = np.flatnonzero(total)
            yield record(schema, pa.array(at, pa.int32(), mask=at == len(table)), total[at].astype(np.int64))

    return rows.mapInArrow(count, "token int, n long").groupBy("token").agg(F.sum("n").alias("n"))


@dataclass
class ToxicityModel:
    tokens: list[str]
    scores: list[float]
    decay: float  # lambda
    weights: list[float]  # of 1, any segment, evidence of the best, sum of lambda S, logarithm of the length

    def evidence(self, rows: DataFrame, keep: list[str] = ()) -> DataFrame:
        """``(id, n_words, evidence, total, segments)``; a segment has its first word, the word after its last, and
        its score. ``total`` is the sum of lambda S; evidence is 0 without a segment."""
        spark = rows.sparkSession
        shared = spark.sparkContext.broadcast((self.tokens, self.scores))
        decay, extra = self.decay, list(keep)
        fields = [(c, pa.int32()) for c in extra]
        segment = pa.struct([("start", pa.int64()), ("stop", pa.int64()), ("score", pa.float64())])
        schema = pa.schema([("id", pa.int64()), *fields, ("n_words", pa.int64()), ("evidence", pa.float64()), ("total", pa.float64()), ("segments", pa.list_(segment))])

        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for block in blocks(batches, SCAN_BYTES):
                found = _scan(block.column(1), *shared.value, decay)
                kept = [block.column(2 + i) for i in range(len(extra))]
                yield record(schema, block.column(0), *kept, *found)

        columns = "".join(f", {c} int" for c in extra)
        struct = "array<struct<start: long, stop: long, score: double>>"
        return rows.mapInArrow(scan, f"id long{columns}, n_words long, evidence double, total double, segments {struct}")

    def score(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """``(doc_id, score, evidence, n_words, segments)`` of all documents."""
        found = self.evidence(texts(docs, id_col, text_col))
        score = 1 / (1 + F.exp(-sum(F.lit(w) * x for w, x in zip(self.weights, _features()))))
        return found.select(F.col("id").alias("doc_id"), score.alias("score"), "evidence", "n_words", "segments")

    def accepted(self, docs: DataFrame, threshold: float = 0.5, text_col: str = "text") -> DataFrame:
        """The rows of ``docs``, with all their columns, whose score is below ``threshold``."""
        shared = docs.sparkSession.sparkContext.broadcast((self.tokens, self.scores))
        decay, weights, place = self.decay, self.weights, docs.columns.index(text_col)
        limit = math.log(threshold / (1 - threshold))

        def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for block in blocks(batches, SCAN_BYTES, place):
                text = pc.fill_null(block.column(place), "")
                n, best, total, found = _scan(text, *shared.value, decay)
                features = [np.ones(len(n)), np.array([bool(f) for f in found], float), best, total, np.log1p(n)]
                yield block.filter(pa.array(sum(w * x for w, x in zip(weights, features)) < limit))

        return docs.mapInArrow(keep, docs.schema)


def _scan(column: pa.Array, tokens: list[str], scores: list[float], decay: float) -> tuple:
    """Number of words, evidence, total and segments of each text."""
    table, values = pa.array(tokens, pa.string()), np.array([*scores, QUIET])
    words = Words(column, _APART)
    at = [pc.index_in(t, table, skip_nulls=True) for t in _tokens(words)]
    by_word = values[pc.fill_null(pc.coalesce(*at), len(table)).to_numpy()]
    marked = np.flatnonzero((by_word != QUIET)[words.codes])
    score = by_word[words.codes[marked]]
    docs = np.searchsorted(words.bounds, marked, side="right") - 1
    cuts = np.searchsorted(docs, np.arange(len(column) + 1))
    found: list[list] = []
    best, total = np.zeros(len(column)), np.zeros(len(column))
    for d, n in enumerate(words.counts.tolist()):
        own = slice(cuts[d], cuts[d + 1])
        segments = maximal_segments((marked[own] - words.bounds[d]).tolist(), score[own].tolist())
        if segments:
            best[d] = decay * max(s for _, _, s in segments) - math.log(CHANCE * n)
            total[d] = decay * sum(s for _, _, s in segments)
        found.append([{"start": a, "stop": b, "score": s} for a, b, s in segments])
    return words.counts, best, total, found


def maximal_segments(places: list[int], scores: list[float]) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments (first word, word after the last, score) in one pass.

    ``places`` and ``scores`` are the words that do not score ``QUIET``; runs of quiet words between them
    count by their length. Positive neighbours of a segment are merged as Ruzzo & Tompa describe.
    """
    stack: list[tuple[int, int, float, float]] = []  # first, after last, total before, total after
    total, last = 0.0, 0
    for place, score in zip(places, scores):
        total += QUIET * (place - last)
        last = place + 1
        before, total = total, total + score
        if score <= 0:
            continue
        first, left = place, before
        while stack:
            j = len(stack) - 1
            while j >= 0 and stack[j][2] >= left:
                j -= 1
            if j < 0 or stack[j][3] >= total:
                break
            first, left = stack[j][0], stack[j][2]
            del stack[j:]
        stack.append((first, place + 1, left, total))
    return [(a, b, after - before) for a, b, before, after in stack]


def _decay(scores: np.ndarray, shares: np.ndarray) -> float:
    """The positive root of sum(share * exp(lambda * score)) = 1; 1 where the mean is not negative."""
    if not len(scores) or scores.max() <= 0 or scores @ shares >= 0:
        return 1.0
    low, high = 0.0, 1.0
    excess = lambda x: shares @ np.exp(np.minimum(x * scores, 700)) - 1
    while excess(high) < 0:
        low, high = high, 2 * high
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if excess(middle) < 0 else (low, middle)
    return high


def _features() -> list:
    return [F.lit(1.0), F.when(F.size("segments") > 0, 1.0).otherwise(0.0), F.col("evidence"), F.col("total"), F.log1p("n_words")]


def _logistic(features: np.ndarray, toxic: np.ndarray) -> list[float]:
    """Weights by Newton steps with a small ridge on all but the first."""
    weights = np.zeros(features.shape[1])
    ridge = np.diag([1e-6] + [0.01] * (features.shape[1] - 1))
    for _ in range(200):
        p = 1 / (1 + np.exp(-np.clip(features @ weights, -30, 30)))
        gradient = features.T @ (toxic - p) - ridge @ weights
        step = np.linalg.solve((features * (p * (1 - p))[:, None]).T @ features + ridge, gradient)
        weights += step * min(1.0, 2.0 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-9:
            break
    return weights.tolist()


def _beginnings(token: str) -> list[str]:
    """The shorter tokens of the words that have ``token``, longest first."""
    return [b for b in (token.removesuffix(_END)[:5], token[:4].removesuffix(_END)) if b != token]


def _tested(counted: DataFrame, n_toxic: int, n_clean: int) -> DataFrame:
    """Tokens seen in ``SUPPORT`` toxic neighbourhoods, and clean ones that begin with one of them."""
    t, c = F.col("n_toxic") + 0.5, F.col("n_clean") + 0.5
    apart = F.log(t / (n_toxic + 1)) - F.log(c / (n_clean + 1))
    marked = counted.select("*", apart.alias("apart"), (apart + F.sqrt(1 / t + 1 / c) < EFFECT).alias("clean"))
    likely = marked.where(F.col("n_toxic") >= SUPPORT)
    body = F.rtrim("token")
    shorter = marked.where((F.col("n_toxic") < SUPPORT) & F.col("clean")).select(
        "token", "n_toxic", "n_clean", "clean", F.explode(F.array(F.left(body, F.lit(5)), F.left(body, F.lit(4)))).alias("beginning")
    )
    starts = likely.where("apart > 0").select(F.col("token").alias("beginning"))
    clean = shorter.join(starts, "beginning", "left_semi").drop("beginning").distinct()
    return likely.select(clean.columns).unionAll(clean)


def _own_shares(scores: dict[str, float], shares: dict[str, float]) -> list[float]:
    """Share of the words whose longest token in ``scores`` is the token itself."""
    own = {token: shares[token] for token in scores}
    for token in scores:
        nearest = next((b for b in _beginnings(token) if b in scores), None)
        if nearest is not None:
            own[nearest] -= shares[token]
    return [max(0.0, x) for x in own.values()]


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", id_col: str = "doc_id", text_col: str = "text", labelled: int = LABELLED) -> ToxicityModel:
    """Model from ``labels`` (id, 0/1), with frequencies over all ``docs``."""
    rows = texts(docs, id_col, text_col)
    known = labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("toxic"))
    known = known.where("id is not null and toxic in (0, 1)").groupBy("id").agg(F.max("toxic").alias("toxic"))
    chosen = known.orderBy(F.xxhash64("id"), "id").limit(labelled)  # bounded by the parameter, hence the broadcast
    sample = materialise(rows.join(F.broadcast(chosen), "id").select("id", "text", "toxic"))
    sizes = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    if len(sizes) < 2:
        return ToxicityModel([], [], 1.0, [40.0 if 1 in sizes else -40.0, 0.0, 0.0, 0.0, 0.0])
    counted = materialise(_neighbourhoods(sample))
    total = counted.agg(F.sum("n_toxic").alias("t"), F.sum("n_clean").alias("c")).first()
    found = _tested(counted, total["t"], total["c"]).toPandas()  # bounded by the words of the sample
    corpus = {r["token"]: r["n"] for r in _corpus_counts(rows, found["token"].tolist()).collect()}
    words = max(1, corpus.pop(None, 1))
    shares = np.array([max(corpus.get(i, 0), 1) / words for i in range(len(found))])
    weight = PRIOR * float(total["t"] + total["c"])
    prior, t, c = weight * shares, found["n_toxic"].to_numpy(float), found["n_clean"].to_numpy(float)
    odds = lambda n, of: np.log((n + prior) / (of + weight - n - prior))
    difference = odds(t, float(total["t"])) - odds(c, float(total["c"]))
    deviation = np.sqrt(1 / (t + prior) + 1 / (c + prior))
    toxic = (t >= SUPPORT) & (difference >= EFFECT) & (difference >= SIGNIFICANT * deviation)
    scores = dict(zip(found["token"][toxic], difference[toxic].tolist()))
    longer = found["token"][found["clean"].to_numpy(bool) & ~toxic]
    scores |= {token: QUIET for token in longer if any(b in scores for b in _beginnings(token))}
    alone = _own_shares(scores, dict(zip(found["token"], shares.tolist())))
    values, alone = np.array([*scores.values(), QUIET]), np.array([*alone, max(0.0, 1 - sum(alone))])
    tokens, scores, decay = list(scores), np.array([*scores.values()]), _decay(values, alone / alone.sum())
    model = ToxicityModel(tokens, scores.tolist(), decay, [])
    seen = model.evidence(sample, ["toxic"]).select(*[x.alias(f"x{i}") for i, x in enumerate(_features())], "toxic").toPandas()
    model.weights = _logistic(seen.drop(columns="toxic").to_numpy(float), seen["toxic"].to_numpy(float))
    return model
