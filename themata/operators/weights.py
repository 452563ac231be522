"""Weight transforms and descriptive weights on long-form TF-IDF ``(doc_id, term_id, w)``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

TRANSFORMS = ("entropy", "binary", "log", "none")


def entropy_weights(tfidf: DataFrame, n_docs: int | Column) -> DataFrame:
    """``(term_id, e)``: 1 + sum(p ln p) / ln N with p = w / column sum (Dumais 1991).

    sum(p ln p) equals sum(w ln w) / S - ln S, so one map-side-combined pass is enough; zero cells
    add nothing. A column without weight (idf 0) has p = 0 everywhere, hence e = 1.
    """
    n = n_docs if isinstance(n_docs, Column) else F.lit(float(n_docs))
    w = F.col("w")
    sums = tfidf.groupBy("term_id").agg(
        F.sum("w").alias("s"), F.sum(F.when(w > 0, w * F.log(w)).otherwise(0.0)).alias("wlw")
    )
    plogp = F.when(F.col("s") > 0, F.col("wlw") / F.col("s") - F.log("s")).otherwise(0.0)
    # with one document ln N is 0 and so is every p ln p
    share = F.when(n > 1, plogp / F.log(n)).otherwise(0.0)
    return sums.select("term_id", (1 + share).alias("e"))


def transform_weights(tfidf: DataFrame, method: str, entropy: DataFrame | None = None, compat: bool = False) -> DataFrame:
    """Entropy, binary, log or no transform. ``compat=True`` takes entropy weights as 1, i.e. log."""
    if method not in TRANSFORMS:
        raise ValueError(f"no such transform: {method}")
    if method == "entropy" and not compat:
        if entropy is None:
            raise RuntimeError("train the entropy weights first")
        # one row per selected term
        joined = tfidf.join(F.broadcast(entropy), "term_id")
        return joined.select("doc_id", "term_id", (F.col("e") * F.log1p("w")).alias("w"))
    value = {
        "binary": (F.col("w") > 0).cast("double"),
        "none": F.col("w"),
    }.get(method, F.log1p("w"))
    return tfidf.select("doc_id", "term_id", value.alias("w"))


def descriptive_weights(selected: DataFrame, limit: int, divisor: float = 6.0) -> DataFrame:
    """Top terms for display: ``(rank, term, weight)``; the weight of the first is damped.

    ``selected`` carries its rank, so no window is needed.
    """
    weight = F.when(F.col("rank") == 1, F.col("var") / divisor).otherwise(F.col("var"))
    return selected.where(F.col("rank") <= limit).select("rank", "term", weight.alias("weight"))
