"""Quality of documents by hierarchical empirical Bayes over hosts and paths.

1. A document classifier gives each document a log-odds: naive Bayes over tokens (hashed words and a few counts of
   form), estimated on at most ``LABELLED`` labelled rows chosen by a hash of the id, with token frequencies of the
   whole corpus as prior.
2. Its calibrated probabilities, and labels where known, are summed per host and per path (a part of a host) over
   all documents. Host shares are shrunk towards the global share, path shares towards their host's: each level is
   a Beta-binomial whose strength is estimated by moments, so sparse sites stay near their parent.
3. A document's posterior odds are its own evidence times its path's posterior odds against the global ones. The
   document itself is taken out of its path's and host's sums first.

Host and path sums are aggregates with map-side combination; a host with a third of all rows is one row per task.
The text is read three times and never shuffled.

Defined cases: null, empty and wordless texts have the evidence of their form counts; a null host or path is a
site of its own; without labels of both kinds every score is the share of good labels (0.5 without any); documents
with several labels count as good only if all say so; repeated rows are each scored and each count for their site;
an empty table gives an empty table.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from themata.cluster import materialise
from themata.llm.batches import LOWER, Words, blocks, record, texts

#: Labelled rows that the document classifier is fitted on.
LABELLED = 20_000

#: Slots of hashed tokens.
SLOTS = 1 << 16

#: Weight of the corpus prior, as a share of the labelled tokens.
PRIOR = 0.08

#: Fewest and most documents that a level's prior may weigh.
LEAST, MOST = 1.0, 1e6


def _features(block: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Slot of each token and the document it stands in; a token counts once per document."""
    words = Words(block.column(1), LOWER)
    doc = np.repeat(np.arange(block.num_rows), words.counts)
    hashed = np.empty(0, np.int64)
    if len(words.codes):
        names = words.vocabulary.to_numpy(zero_copy_only=False)
        hashed = (pd.util.hash_array(names) % np.uint64(SLOTS - 256)).astype(np.int64)[words.codes] + 256
    counts = words.counts
    letters = pc.binary_length(block.column(1)).to_numpy(zero_copy_only=False)
    marks = np.array([len(t) for t in pc.replace_substring_regex(block.column(1), r"[\pL\s]+", "").to_pylist()])
    distinct = np.array([len(np.unique(words.codes[a:b])) for a, b in zip(words.bounds[:-1].tolist(), words.bounds[1:].tolist())])
    level = lambda x, top: np.minimum(np.floor(x), top).astype(np.int64)
    form = np.stack([
        level(np.log2(counts + 1), 31),
        32 + level(32 * marks / np.maximum(letters, 1), 31),
        64 + level(32 * distinct / np.maximum(counts, 1), 31),
        96 + level(2 * letters / np.maximum(counts, 1), 63),
    ], axis=1)
    slots = np.concatenate((hashed, form.ravel()))
    docs = np.concatenate((doc, np.repeat(np.arange(block.num_rows), 4)))
    once = np.unique(docs * SLOTS + slots)
    return once % SLOTS, once // SLOTS


def _slot_counts(rows: DataFrame, label: bool) -> np.ndarray:
    """Documents per slot; two rows (label 0 and 1) if ``rows`` has a label as third column."""
    schema = pa.schema([("slot", pa.int32()), ("good", pa.int32()), ("n", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, SLOTS), np.int64)
        for block in blocks(batches):
            slots, docs = _features(block)
            good = block.column(2).to_numpy()[docs] if label else np.zeros(len(docs), np.int64)
            total += np.bincount(good * SLOTS + slots, minlength=2 * SLOTS).reshape(2, SLOTS)
        good, slots = np.nonzero(total)
        yield record(schema, slots, good, total[good, slots])

    counted = rows.mapInArrow(count, "slot int, good int, n long").groupBy("slot", "good").agg(F.sum("n").alias("n"))
    result = np.zeros((2, SLOTS))
    for r in counted.collect():  # at most two rows per slot
        result[r["good"], r["slot"]] = r["n"]
    return result


@dataclass
class DocumentModel:
    weights: np.ndarray | None  # log-odds by slot
    intercept: float
    slope: float
    share: float  # of good labels

    def evidence(self, docs: DataFrame, keep: list[str], id_col: str, text_col: str) -> DataFrame:
        """``(id, p, *keep)``: calibrated probability of each document by itself."""
        shared = docs.sparkSession.sparkContext.broadcast(self.weights)  # SLOTS numbers
        intercept, slope, share = self.intercept, self.slope, self.share
        extra = [F.col(f"`{k}`").alias(f"k{i}") for i, k in enumerate(keep)]
        text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
        rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), text.alias("text"), *extra)
        types = [f"k{i} {rows.schema[f'k{i}'].dataType.simpleString()}" for i in range(len(keep))]

        def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            weights = shared.value
            for block in blocks(batches):
                p = np.full(block.num_rows, share)
                if weights is not None:
                    slots, docs_ = _features(block)
                    sums = np.bincount(docs_, weights[slots], block.num_rows) / np.sqrt(np.maximum(np.bincount(docs_, minlength=block.num_rows), 1))
                    p = 1 / (1 + np.exp(-np.clip(intercept + slope * sums, -30, 30)))
                columns = [block.column(0), pa.array(p), *(block.column(2 + i) for i in range(len(keep)))]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "p", *(f"k{i}" for i in range(len(keep)))])

        return rows.mapInArrow(score, ", ".join(["id long", "p double", *types]))


def fit_documents(docs: DataFrame, labels: DataFrame, label_col: str, id_col: str, text_col: str, labelled: int = LABELLED) -> DocumentModel:
    """Naive Bayes log-odds over the labelled sample with the corpus frequencies as prior, then a logistic curve."""
    rows = texts(docs, id_col, text_col)
    chosen = known_labels(labels, label_col, id_col).orderBy(F.xxhash64("id"), "id").limit(labelled)
    sample = materialise(rows.join(F.broadcast(chosen), "id").select("id", "text", "good"))  # bounded by ``labelled``
    sizes = {r["good"]: r["count"] for r in sample.groupBy("good").count().collect()}
    share = sizes.get(1, 0) / max(1, sum(sizes.values())) if sizes else 0.5
    if len(sizes) < 2:
        return DocumentModel(None, 0.0, 0.0, share)
    bad, good = _slot_counts(sample, True)
    corpus = _slot_counts(rows, False)[0]
    weight = PRIOR * (good.sum() + bad.sum())
    prior = weight * np.maximum(corpus, 0.5) / np.maximum(corpus, 0.5).sum()
    share_of = lambda n: np.log((n + prior) / (n.sum() + weight))
    model = DocumentModel(share_of(good) - share_of(bad), 0.0, 1.0, share)
    scored = model.evidence(sample, ["good"], "id", "text").toPandas()
    x = np.log(scored["p"] / (1 - scored["p"])).to_numpy()
    model.intercept, model.slope = _curve(x, scored["k0"].to_numpy(float))
    return model


def _curve(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    design, weights = np.stack([np.ones(len(x)), x], axis=1), np.zeros(2)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(design @ weights, -30, 30)))
        gradient = design.T @ (y - p) - 0.01 * weights
        step = np.linalg.solve((design * (p * (1 - p))[:, None]).T @ design + 0.01 * np.eye(2), gradient)
        weights += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return float(weights[0]), float(weights[1])


def known_labels(labels: DataFrame, label_col: str, id_col: str) -> DataFrame:
    rows = labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("good"))
    return rows.where("id is not null and good in (0, 1)").groupBy("id").agg(F.min("good").alias("good"))


def _strength(sites: DataFrame, parent: Column) -> float:
    """Documents that a level's prior weighs, by moments: the spread of site shares around their parent beyond
    what chance gives. ``sites`` has n and s (sum of probabilities)."""
    p, n = F.col("s") / F.col("n"), F.col("n")
    inside = parent * (1 - parent)
    row = sites.where(n > 1).agg(F.sum(n * F.pow(p - parent, 2)).alias("spread"), F.sum(inside).alias("chance"), F.sum((n - 1) * inside).alias("room")).first()
    if not row["room"]:
        return MOST
    between = max(0.0, (row["spread"] - row["chance"]) / row["room"])
    return MOST if between <= 0 else min(MOST, max(LEAST, 1 / between - 1))


def site_quality(docs: DataFrame, labels: DataFrame, host: Column, path: Column, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text", labelled: int = LABELLED) -> DataFrame:
    """``(doc_id, host, path, evidence, path_share, host_share, score)`` of every document."""
    model = fit_documents(docs, labels, label_col, id_col, text_col, labelled)
    named = docs.withColumn("__host", host.cast("string")).withColumn("__path", path.cast("string"))
    known = known_labels(labels, label_col, id_col)
    seen = model.evidence(named, ["__host", "__path"], id_col, text_col).withColumnsRenamed({"k0": "host", "k1": "path"})
    seen = seen.join(known, "id", "left").withColumn("e", F.coalesce(F.col("good").cast("double"), F.col("p")))
    seen = materialise(seen.select("id", "host", "path", "p", "e"))
    paths = materialise(seen.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum("e").alias("s")))
    hosts = paths.groupBy("host").agg(F.sum("n").alias("hn"), F.sum("s").alias("hs"))
    whole = paths.agg(F.sum("n").alias("n"), F.sum("s").alias("s")).first()
    if not whole["n"]:
        columns = "doc_id long, host string, path string, evidence double, host_share double, path_share double, score double"
        return docs.sparkSession.createDataFrame([], columns)
    share = min(1 - 1e-6, max(1e-6, whole["s"] / whole["n"]))
    host_weight = _strength(hosts.withColumnsRenamed({"hn": "n", "hs": "s"}), F.lit(share))
    both = paths.join(hosts.withColumnRenamed("host", "of"), F.col("host").eqNullSafe(F.col("of"))).drop("of")
    host_share = (F.col("hs") + host_weight * share) / (F.col("hn") + host_weight)
    both = materialise(both.withColumn("host_share", host_share))
    path_weight = _strength(both, F.col("host_share"))
    sites = both.select(F.col("host").alias("of_host"), F.col("path").alias("of_path"), "n", "s", "hn", "hs")
    joined = seen.join(sites, F.col("host").eqNullSafe(F.col("of_host")) & F.col("path").eqNullSafe(F.col("of_path")))
    # the document's own part is taken out of both sums
    around = (F.col("hs") - F.col("e") + host_weight * share) / (F.col("hn") - 1 + host_weight)
    local = (F.col("s") - F.col("e") + path_weight * F.col("host_share")) / (F.col("n") - 1 + path_weight)
    safe = lambda c: F.least(F.greatest(c, F.lit(1e-6)), F.lit(1 - 1e-6))
    logit = lambda c: F.log(c / (1 - c))
    prior = math.log(share / (1 - share))
    found = joined.withColumn("host_share", safe(around)).withColumn("path_share", safe(local))
    score = 1 / (1 + F.exp(-(logit(safe(F.col("p"))) + logit(F.col("path_share")) - F.lit(prior))))
    return found.select(F.col("id").alias("doc_id"), "host", "path", F.col("p").alias("evidence"), "host_share", "path_share", score.alias("score"))
