"""Label codes and splits."""

from __future__ import annotations

from pyspark.ml.feature import IndexToString, OneHotEncoder, StringIndexer
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import Column, DataFrame, functions as F

from themata.cluster import with_dense_id


def fit_labels(df: DataFrame, label: str = "label", unseen: str = "error") -> PipelineModel:
    """Label to code (alphabetical order) and one-hot vector, fixed by the rows it is fitted on."""
    indexer = StringIndexer(
        inputCol=label, outputCol="label_idx", stringOrderType="alphabetAsc", handleInvalid=unseen
    )
    one_hot = OneHotEncoder(inputCol="label_idx", outputCol="label_one_hot", dropLast=False)
    return Pipeline(stages=[indexer, one_hot]).fit(df)


def label_names(encoder: PipelineModel) -> list[str]:
    return encoder.stages[0].labels


def decode_labels(df: DataFrame, encoder: PipelineModel, code: str = "prediction", output: str = "label") -> DataFrame:
    return IndexToString(inputCol=code, outputCol=output, labels=label_names(encoder)).transform(df)


def split_at(df: DataFrame, threshold: int, key: str = "doc_id") -> DataFrame:
    """Add ``split``: the first ``threshold`` rows by ``key`` are train, the rest test.

    Rows are numbered in range partitions with one count per partition on the driver, so no task holds more
    than its range. Rows with equal keys at the boundary all are train; a null key is test.
    """
    keys = df.select(key).where(F.col(key).isNotNull())
    numbered = with_dense_id(keys, [key], "__number")
    boundary = numbered.where(F.col("__number") < threshold).agg(F.max(key)).first()[0]
    if boundary is None:
        return df.withColumn("split", F.lit("test"))
    return df.withColumn("split", F.when(F.col(key) <= F.lit(boundary), "train").otherwise("test"))


def hash_fold(key: str | Column, k: int, seed: int = 0) -> Column:
    """Fold number of a row: shuffled, but the same on every run and executor."""
    return F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(k)).cast("int")


def head(df: DataFrame, n: int, key: str = "doc_id") -> DataFrame:
    """The first ``n`` rows by key (a top-k)."""
    return df.orderBy(key).limit(n)
