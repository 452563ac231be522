"""Stage store: named tables and models, reused only while parameters and input agree."""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

#: reload every stage / reload only parsed text / compute everything anew
CACHE_MODES = ("all", "parse-only", "none")


class StageStore:
    """Parquet tables under ``root/stage/<hash>``; the hash covers the stage name, its
    parameters and a description of the input, so a changed input never meets old data."""

    def __init__(self, spark: SparkSession, root: str, use_cache: str = "all"):
        if use_cache not in CACHE_MODES:
            raise ValueError(f"use_cache must be one of {CACHE_MODES}")
        self.spark, self.root, self.use_cache = spark, root.rstrip("/"), use_cache

    def path(self, stage: str, params: dict, inputs: object) -> str:
        key = json.dumps([stage, params, inputs], sort_keys=True, default=str)
        return f"{self.root}/stage/{hashlib.sha256(key.encode()).hexdigest()[:32]}"

    def _may_reload(self, parsing: bool) -> bool:
        return self.use_cache == "all" or (self.use_cache == "parse-only" and parsing)

    def table(
        self,
        stage: str,
        build: Callable[[], DataFrame],
        params: dict | None = None,
        inputs: object = None,
        parsing: bool = False,
    ) -> DataFrame:
        """The stored table of this stage, built and written first if it is not there yet."""
        path = self.path(stage, params or {}, inputs)
        if self._may_reload(parsing):
            try:  # the marker is written last, so a half-written stage is built anew
                self.spark.read.format("binaryFile").load(f"{path}/_SUCCESS").count()
                return self.spark.read.parquet(path)
            except AnalysisException as error:
                if error.getCondition() != "PATH_NOT_FOUND":
                    raise
        build().write.mode("overwrite").parquet(path)
        return self.spark.read.parquet(path)

    def model(self, stage: str, build: Callable[[], object], reader, params: dict | None = None, inputs: object = None):
        """Same for a fitted ``pyspark.ml`` model; ``reader`` is its class."""
        path = self.path(stage, params or {}, inputs)
        if self._may_reload(False):
            try:
                return reader.load(path)
            except Exception as error:  # a missing path surfaces as different JVM errors
                if "does not exist" not in str(error):
                    raise
        model = build()
        model.write().overwrite().save(path)
        return model


def input_fingerprint(df: DataFrame) -> list:
    """Schema, analysed plan, number of files and a hash of their paths, sizes and times, without reading rows.

    The plan tells filters and expressions apart; numbers that Spark gives anew each time are taken out.
    """
    plan = re.sub(r"#\d+L?|plan_id=\d+", "", df._jdf.queryExecution().analyzed().toString())
    files = df.sparkSession.read.format("binaryFile").load(df.inputFiles())
    marks = F.xxhash64("path", "length", "modificationTime")
    row = files.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(marks).alias("mark")).first()
    return [df.schema.simpleString(), plan, row["n"], row["mark"]]
