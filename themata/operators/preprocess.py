"""From text to tokens."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from themata.cluster import INLINE_TERMS, keyed_rows, unnest
from themata.functions import text as T
from themata.functions.greek import stem_tokens
from themata.sources.lexicon import inline_terms


def drop_stopwords(df: DataFrame, stopwords: DataFrame, column: str = "tokens") -> DataFrame:
    """Drop the tokens that a lexicon lists. A lexicon of bounded size becomes a hash look-up per
    token; a larger one is anti-joined on the exploded tokens."""
    terms = inline_terms(stopwords)
    if terms is not None:
        return df.withColumn(column, T.drop_terms(column, terms))
    rows = keyed_rows(df)
    exploded = unnest(rows, ["__row"], column, "token", "pos")
    kept = exploded.join(stopwords.select(F.col("term").alias("token")).distinct(), "token", "left_anti")
    return _regroup(rows, kept, column).select(df.columns)


def mark_lexicon(
    df: DataFrame, lexicon: DataFrame, column: str = "tokens", constant: str = T.COUNTRY_CONST
) -> DataFrame:
    """Replace the tokens that a lexicon lists by one placeholder."""
    terms = inline_terms(lexicon)
    if terms is not None:
        return df.withColumn(column, T.mark_terms(column, terms, constant))
    rows = keyed_rows(df)
    exploded = unnest(rows, ["__row"], column, "token", "pos")
    listed = lexicon.select(F.col("term").alias("token"), F.lit(True).alias("__listed")).distinct()
    marked = exploded.join(listed, "token", "left").withColumn(
        "token", F.when(F.col("__listed"), F.lit(constant)).otherwise(F.col("token"))
    )
    return _regroup(rows, marked, column).select(df.columns)


def _regroup(rows: DataFrame, exploded: DataFrame, column: str) -> DataFrame:
    """Put the tokens of each row back into an array (never longer than the one it had)."""
    grouped = exploded.groupBy("__row").agg(F.sort_array(F.collect_list(F.struct("pos", "token"))).alias("__list"))
    tokens = F.coalesce(F.col("__list.token"), F.array().cast("array<string>"))
    return rows.drop(column).join(grouped, "__row", "left").withColumn(column, tokens)


def preprocess(
    docs: DataFrame,
    stopwords=(),
    places=(),
    protected=(),
    text: str = "text",
    stem: bool = True,
    compat: bool = False,
) -> DataFrame:
    """``text`` to ``tokens``: accents, upper case, tokenise, stop words, stem, numbers, places,
    minimum length, in this order. Stop words go before the costly stemmer.

    The word lists are collections or lexicon DataFrames. With collections (or lexicons of bounded
    size) the whole chain is one narrow projection.
    """

    def filtered(df: DataFrame, words, by_join, by_value) -> DataFrame:
        if not isinstance(words, DataFrame) and len(words) > INLINE_TERMS:
            words = df.sparkSession.createDataFrame([(w,) for w in set(words)], "term string")
        if isinstance(words, DataFrame):
            return by_join(df, words)
        return df.withColumn("tokens", by_value("tokens", words))

    tokens = T.tokenize(F.upper(T.strip_accents(F.col(text))), compat)
    df = docs.withColumn("tokens", tokens).drop(text)
    df = filtered(df, stopwords, drop_stopwords, T.drop_terms)
    if stem:
        df = df.withColumn("tokens", stem_tokens("tokens", protected))
    df = df.withColumn("tokens", T.mark_numbers(F.col("tokens")))
    df = filtered(df, places, mark_lexicon, T.mark_terms)
    # Naming the tokens twice keeps this projection apart from the one above: folded together with a
    # later Python function, the stemmer's nested lambdas stop Spark from planning that function.
    long_enough = T.min_length(F.col("tokens"))
    return df.withColumn("tokens", F.when(F.size("tokens") > 0, long_enough).otherwise(F.col("tokens")))
