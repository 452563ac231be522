"""Corpus pipeline: documents without toxic text, near copies, benchmark passages and personal data, packed.

Each stage takes all its predecessor kept; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from themata.cluster import broadcast_if_small, materialise
from themata.llm import jaccard_join, packing, pii, positional_index, toxicity
from themata.llm.tokens import public_tokenizer


def _free_name(docs: DataFrame, name: str = "__key") -> str:
    """A column name that ``docs`` does not have, whatever the case of its letters."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name += "_"
    return name


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score below 0.5, by the labels that are not held out."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    labels = labels.where(F.crc32(F.col("doc_id").cast("string")) % 5 != 0)
    return toxicity.fit(docs, labels).accepted(docs)


def keep_one_of_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by word 5-gram Jaccard similarity of 0.8, the one with the smallest id, of its texts the
    first by hash; of rows with one id and text, one. Texts that are not linked stay, also under one id. Documents
    without an id all stay."""
    key = F.when(F.col("doc_id").isNotNull(), F.xxhash64("doc_id", "text"))  # tells the texts of an id apart
    found = jaccard_join.near_duplicates(docs.select(key.alias("key"), "text"), id_col="key")
    linked = found.where("doc_id is not null").groupBy(F.col("doc_id").alias("key")).agg(F.min("component_id").alias("component"), F.count("*").alias("n"))
    ids = docs.where("doc_id is not null").groupBy(key.alias("key")).agg(F.min("doc_id").alias("id"))
    rows = materialise(linked.join(ids, "key"))
    first = rows.groupBy("component").agg(F.min(F.struct("id", "key")).alias("first"), F.count("*").alias("size"))
    first = materialise(first.where("size > 1").select("component", F.col("first.key").alias("kept")))
    gone = rows.join(broadcast_if_small(first), "component").where("key <> kept").select("key")
    gone = materialise(gone)
    own = _free_name(docs)
    named = docs.withColumn(own, key)
    left = named.join(broadcast_if_small(gone.withColumnRenamed("key", own)), own, "left_anti")
    repeated = materialise(rows.where("n > 1").select(F.col("key").alias(own)))
    if repeated.isEmpty():
        return left.select(docs.columns)
    several = left.join(broadcast_if_small(repeated), own, "left_semi").select(own, *docs.columns)
    row = F.struct(*docs.columns)
    one = several.groupBy(own).agg(F.min_by(row, F.xxhash64(*docs.columns)).alias("row")).select("row.*")
    return left.join(broadcast_if_small(repeated), own, "left_anti").select(docs.columns).unionAll(one)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no 10-word window of a benchmark item occurs."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    own, key = _free_name(docs), F.xxhash64("doc_id", "text")  # also tells rows without an id apart
    found = positional_index.decontaminate(docs.select(key.alias("key"), "text"), benchmark, id_col="key")
    hit = materialise(found.where(F.size("hits") > 0).select(F.col("doc_id").alias(own)).distinct())
    return docs.withColumn(own, key).join(broadcast_if_small(hit), own, "left_anti").select(docs.columns)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with every span of personal data replaced by its kind; ``n_chars`` follows the text."""
    found = pii.annotate(docs, pii.fit(docs), base="base_spans", spans="all_spans")
    text = F.when(F.size("all_spans") > 0, pii.redact(F.col("text"), F.col("all_spans"))).otherwise(F.col("text"))
    length = F.when(F.size("all_spans") > 0, F.length(text).cast("long")).otherwise(F.col("n_chars"))
    changed = {"text": text, "n_chars": length}
    return found.select(*[changed.get(c, F.col(f"`{c}`")).alias(c) for c in docs.columns])


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their sequence and offset."""
    return packing.best_fit_packing(docs, public_tokenizer())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", reject_toxic),
    ("ngram_jaccard_join", keep_one_of_group),
    ("benchmark_decontamination", decontaminate),
    ("pii", redact_personal_data),
    ("best_fit_packing", pack),
]

#: Word shingles, tokenizer ids and learned models have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``; each result is stored before the next stage reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = materialise(docs)
    return docs
