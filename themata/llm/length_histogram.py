"""Exact token counts from one aggregate: the number of documents of each encoded length.

Suffix sums over the histogram answer, for every context limit, how many documents and tokens lie beyond it,
how many tokens are left when each document is cut there, and which share of documents fits. Tasks count
lengths in their blocks first; sums run over blocks of lengths and then inside each block, so no task holds
the whole histogram.

Defined cases: null or empty text has length 0; repeated rows count each; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from themata.cluster import materialise
from themata.llm.batches import blocks, record, texts
from themata.llm.tokens import encoder

#: Lengths summed by one task.
LENGTHS = 4096


def histogram(docs: DataFrame, tokenizer: str, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``(length, n_docs)`` of all documents."""
    schema = pa.schema([("length", pa.int64()), ("n_docs", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            yield record(schema, *np.unique(encoder(tokenizer).ids(block.column(1))[1], return_counts=True))

    counted = texts(docs, id_col, text_col).mapInArrow(count, "length long, n_docs long")
    return counted.groupBy("length").agg(F.sum("n_docs").alias("n_docs"))


def length_sums(lengths: DataFrame) -> DataFrame:
    """Per length as context limit: documents and tokens in documents at least as long, tokens left when all
    documents are cut to it (``truncated_tokens``), and the share of documents that fit (``share_fitting``)."""
    stored = materialise(lengths).withColumn("block", F.expr(f"length div {LENGTHS}"))
    blocks_ = stored.groupBy("block").agg(F.sum("n_docs").alias("d"), F.sum(F.col("length") * F.col("n_docs")).alias("t"))
    after = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    later = blocks_.select(
        "block", F.coalesce(F.sum("d").over(after), F.lit(0)).alias("later_d"), F.coalesce(F.sum("t").over(after), F.lit(0)).alias("later_t"),
        F.sum("d").over(everything).alias("all_d"), F.sum("t").over(everything).alias("all_t"),
    )
    own = Window.partitionBy("block").orderBy(F.desc("length")).rowsBetween(Window.unboundedPreceding, 0)
    docs_from = F.col("later_d") + F.sum("n_docs").over(own)
    tokens_from = F.col("later_t") + F.sum(F.col("length") * F.col("n_docs")).over(own)
    summed = stored.join(later, "block").select(
        "length", "n_docs", "all_d", "all_t", docs_from.alias("docs_from"), tokens_from.alias("tokens_from")
    )
    return summed.select(
        "length", "n_docs", "docs_from", "tokens_from",
        (F.col("all_t") - F.col("tokens_from") + F.col("length") * F.col("docs_from")).alias("truncated_tokens"),
        ((F.col("all_d") - F.col("docs_from") + F.col("n_docs")) / F.col("all_d")).alias("share_fitting"),
    )


def quantiles(sums: DataFrame, shares: list[float]) -> DataFrame:
    """``(share, length)``: the smallest length that at least ``share`` of the documents do not exceed."""
    found = [F.min(F.when(F.col("share_fitting") >= s, F.col("length"))).alias(f"q{i}") for i, s in enumerate(shares)]
    row = sums.agg(*found)
    return row.select(F.explode(F.array(*[F.struct(F.lit(float(s)).alias("share"), F.col(f"q{i}").alias("length")) for i, s in enumerate(shares)])).alias("x")).select("x.*")


def totals(sums: DataFrame, limits: list[int]) -> DataFrame:
    """``(limit, truncated_tokens)`` for any limits, also such that no document has as its length."""
    tokens = [F.sum(F.col("n_docs") * F.least(F.col("length"), F.lit(int(n)))).alias(f"l{i}") for i, n in enumerate(limits)]
    row = sums.agg(*tokens)
    return row.select(F.explode(F.array(*[F.struct(F.lit(int(n)).alias("limit"), F.coalesce(F.col(f"l{i}"), F.lit(0)).alias("truncated_tokens")) for i, n in enumerate(limits)])).alias("x")).select("x.*")
