"""Neighbouring word pairs and their association (Church & Hanks 1990)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from themata.cluster import INLINE_TERMS, keyed_rows, materialise, unnest
from themata.functions.arrays import pairs
from themata.functions.text import keep_terms


def bigrams(tokens: DataFrame) -> DataFrame:
    """One row per neighbouring pair inside a document: ``(doc_id, pos, w1, w2)``."""
    listed = unnest(tokens, ["doc_id"], pairs(F.col("tokens")), "pair", "pos")
    return listed.select("doc_id", "pos", "pair.w1", "pair.w2")


def ngram_counts(tokens: DataFrame) -> DataFrame:
    """Corpus counts of single tokens (``w2`` null) and pairs, ``(w1, w2, n)``, in one pass and one
    shuffle. Frequent keys are summed on the map side first."""
    single = F.transform("tokens", lambda t: F.struct(t.alias("w1"), F.lit(None).cast("string").alias("w2")))
    both = unnest(tokens, [], F.concat(single, pairs(F.col("tokens"))), "g")
    return both.groupBy("g.w1", "g.w2").agg(F.count(F.lit(1)).alias("n"))


def frequent_bigrams(counts: DataFrame, min_freq: int) -> DataFrame:
    """Pairs that occur at least ``min_freq`` times in the corpus."""
    return counts.where(F.col("w2").isNotNull() & (F.col("n") >= min_freq)).select(
        "w1", "w2", F.col("n").alias("freq")
    )


def bigram_pmi(counts: DataFrame, min_freq: int = 3) -> DataFrame:
    """``(w1, w2, term, freq, pmi)`` with ``pmi = log2(n_ab * N / (n_a * n_b))``.

    A word of a kept pair occurs at least as often as the pair, so rarer words leave before the
    joins. The total is a scalar subquery; the join sides are sized by AQE at run time.
    """
    words = counts.where(F.col("w2").isNull())
    total = words.agg(F.sum("n")).scalar()
    common = words.where(F.col("n") >= min_freq)
    first = common.select("w1", F.col("n").alias("n1"))
    second = common.select(F.col("w1").alias("w2"), F.col("n").alias("n2"))
    scored = frequent_bigrams(counts, min_freq).join(first, "w1").join(second, "w2")
    # the products are exact below 2^53, so equal inputs give equal scores
    ratio = (F.col("freq").cast("double") * total) / (F.col("n1").cast("double") * F.col("n2"))
    return scored.select("w1", "w2", F.concat_ws(" ", "w1", "w2").alias("term"), "freq", F.log2(ratio).alias("pmi"))


def top_bigrams(counts: DataFrame, n: int, min_freq: int = 3) -> DataFrame:
    """The ``n`` pairs of highest PMI; ties by the words."""
    return bigram_pmi(counts, min_freq).orderBy(F.desc("pmi"), "w1", "w2").limit(n)


def fit_bigrams(tokens: DataFrame, n: int, min_freq: int = 3) -> DataFrame:
    """The kept pairs as a stage table. Counts are stored once and read by all three uses."""
    counts = materialise(ngram_counts(tokens).where(F.col("w2").isNull() | (F.col("n") >= min_freq)))
    return materialise(top_bigrams(counts, n, min_freq))


def append_bigrams(tokens: DataFrame, kept: DataFrame, n: int) -> DataFrame:
    """Add each occurrence of a kept pair after the document's tokens, in order, as ``"a b"``.

    ``n`` bounds the kept table. A bounded set is looked up in the row, without a shuffle; a
    larger one is semi-joined on the exploded pairs.
    """
    if n <= INLINE_TERMS:
        terms = sorted(r["term"] for r in kept.select("term").collect())
        if not terms:
            return tokens
        named = F.transform(pairs(F.col("tokens")), lambda p: F.concat_ws(" ", p["w1"], p["w2"]))
        found = tokens.withColumn("__pairs", named).withColumn("__pairs", keep_terms("__pairs", terms))
        return found.withColumn("tokens", F.concat("tokens", "__pairs")).drop("__pairs")
    rows = keyed_rows(tokens)
    listed = unnest(rows, ["__row"], pairs(F.col("tokens")), "pair", "pos")
    found = (
        listed.select("__row", "pos", F.concat_ws(" ", "pair.w1", "pair.w2").alias("term"))
        .join(kept.select("term"), "term", "left_semi")
        .groupBy("__row")
        .agg(F.sort_array(F.collect_list(F.struct("pos", "term"))).alias("__found"))
    )
    extra = F.coalesce(F.col("__found.term"), F.array().cast("array<string>"))
    joined = rows.join(found, "__row", "left").withColumn("tokens", F.concat("tokens", extra))
    return joined.select(tokens.columns)


def bigrams_by_variance(kept: DataFrame, term_var: DataFrame, limit: int) -> DataFrame:
    """Kept pairs that are dictionary terms, ordered by their variance among the classes."""
    ranked = kept.select("term").join(term_var, "term")
    return ranked.orderBy(F.desc("var"), "term").limit(limit)
