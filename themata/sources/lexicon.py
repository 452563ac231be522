"""Word lists: stop words, place names, protected words. Paths are parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from themata.cluster import INLINE_TERMS
from themata.functions.greek import stem_word
from themata.functions.text import strip_accents


def read_lexicon(spark: SparkSession, path: str | list[str], pattern: str = r"^(?:\s*-\s+)?(.*)$") -> DataFrame:
    """``(term)``: one entry per line; a leading list dash (YAML style) is ignored."""
    lines = spark.read.text(path)
    return lines.select(F.regexp_extract("value", pattern, 1).alias("term")).where("term != ''").distinct()


def normalise_lexicon(terms: DataFrame, stem: bool = True, protected=()) -> DataFrame:
    """Accents off, upper case and (by default) stemmed, so that entries meet processed tokens."""
    words = terms.select(F.upper(strip_accents(F.col("term"))).alias("word"))
    stemmed = stem_word("word", protected) if stem else F.col("word")
    return words.select(stemmed.alias("term")).distinct()


def inline_terms(terms: DataFrame, limit: int = INLINE_TERMS) -> list[str] | None:
    """The terms as a Python list if there are at most ``limit`` of them, else None."""
    rows = terms.select("term").limit(limit + 1).collect()
    return sorted(r["term"] for r in rows) if len(rows) <= limit else None
