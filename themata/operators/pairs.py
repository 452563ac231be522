"""Pairwise mutual information of terms over documents."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from themata.cluster import materialise

#: Terms whose joint counts one task holds as a matrix (int32: 64 MB).
TERM_BLOCK = 4096


def joint_counts(vectors: DataFrame, column: str, place: np.ndarray, block: int = TERM_BLOCK) -> DataFrame:
    """``(a, b, co)`` for pairs a < b of term positions that share documents.

    ``place`` maps a vector index to its position. Tasks add the stored cells of their documents up
    in a matrix and emit each pair once, so no document ever spreads into rows of pairs, and the
    only shuffle adds up those matrices. Beyond one block of terms, each pair of blocks is a job
    branch of its own.
    """
    n_terms = len(place)

    def counter(first: int, second: int):
        def partial(batches):
            total = np.zeros((block, block), np.int32)
            for batch in batches:
                lists = pa.compute.struct_field(batch.column(0), 2)
                spots = place[lists.flatten().to_numpy(zero_copy_only=False)]
                ends = np.cumsum(pa.compute.list_value_length(lists).to_numpy(zero_copy_only=False))
                for start, end in zip(np.concatenate([[0], ends[:-1]]).astype(int), ends.astype(int)):
                    row = spots[start:end]
                    left = row[(row >= first * block) & (row < (first + 1) * block)] - first * block
                    right = row[(row >= second * block) & (row < (second + 1) * block)] - second * block
                    total[np.ix_(left, right)] += 1
            a, b = np.nonzero(total)
            keep = (a + first * block) < (b + second * block)
            a, b = a[keep], b[keep]
            for begin in range(0, len(a), 100_000):
                i, j = a[begin : begin + 100_000], b[begin : begin + 100_000]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(i + first * block, pa.int32()),
                        pa.array(j + second * block, pa.int32()),
                        pa.array(total[i, j].astype(np.int64)),
                    ],
                    ["a", "b", "co"],
                )

        return partial

    blocks = range(-(-n_terms // block))
    found = None
    for first in blocks:
        for second in blocks:
            if second >= first:
                part = vectors.select(column).mapInArrow(counter(first, second), "a int, b int, co long")
                found = part if found is None else found.unionByName(part)
    return found.groupBy("a", "b").agg(F.sum("co").alias("co"))


def term_pair_mi(vectors: DataFrame, selected: list, n_docs: int, top: int = 1000, column: str = "counts") -> DataFrame:
    """The ``top`` pairs by log2(N * agree / (df_a * df_b)): ``(term_a, term_b, agree, mi)``.

    ``vectors`` holds sparse count vectors, ``selected`` the rows ``(term, df)`` behind their columns.
    agree = documents with both or neither = N - df_a - df_b + 2 co. Pairs that share documents come
    from ``joint_counts``. For the others the score falls with either frequency, so with terms in
    (df, term) order a pair (a, b) is preceded by all pairs (a', b') with a' <= a, b' <= b; only pairs
    with fewer than ``top`` such predecessors can be among the best. That leaves about top * ln(top)
    pairs to look at, whatever the number of terms, and none is missed.
    """
    spark = vectors.sparkSession
    order = sorted(range(len(selected)), key=lambda i: (selected[i]["df"], selected[i]["term"].encode()))
    place = np.empty(len(order), int)
    place[order] = np.arange(len(order))
    listed = [(p, selected[i]["term"], selected[i]["df"]) for p, i in enumerate(order)]
    table = spark.createDataFrame(listed, "pos int, term string, df long")
    met = materialise(joint_counts(vectors, column, place))

    candidates = []
    for a in range(len(order)):
        for b in range(a + 1, len(order)):
            # pairs (a', b') with a' <= a, b' <= b, a' < b', without (a, b) itself
            before = (a + 1) * b - a * (a + 1) // 2 - 1
            if before >= top:
                break
            candidates.append((a, b))
    rest = spark.createDataFrame(candidates or [], "a int, b int").join(met, ["a", "b"], "left_anti")
    scored = met.unionByName(rest.withColumn("co", F.lit(0).cast("long")))
    left = F.broadcast(table.select(F.col("pos").alias("a"), F.col("term").alias("term_a"), F.col("df").alias("df_a")))
    right = F.broadcast(table.select(F.col("pos").alias("b"), F.col("term").alias("term_b"), F.col("df").alias("df_b")))
    agree = F.lit(n_docs) - F.col("df_a") - F.col("df_b") + 2 * F.col("co")
    ratio = (F.lit(float(n_docs)) * F.col("agree")) / (F.col("df_a").cast("double") * F.col("df_b"))
    full = scored.join(left, "a").join(right, "b").withColumn("agree", agree)
    full = full.where("agree > 0").withColumn("mi", F.log2(ratio))
    return full.orderBy(F.desc("mi"), "a", "b").limit(top).select("term_a", "term_b", "agree", "mi")
