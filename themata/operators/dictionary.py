"""Dictionary, term counts and the statistics built on them (long form, zero cells absent)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from themata.cluster import unnest, with_dense_id
from themata.functions.arrays import bag


def bags(tokens: DataFrame) -> DataFrame:
    """Replace ``tokens`` by ``bag``: distinct terms with counts, computed inside each row."""
    return tokens.withColumn("bag", bag(F.col("tokens"))).drop("tokens")


def explode_bags(bagged: DataFrame) -> DataFrame:
    others = [c for c in bagged.columns if c != "bag"]
    rows = unnest(bagged, others, "bag", "__b")
    return rows.select(*others, "__b.term", "__b.n")


def dictionary(tokens: DataFrame) -> DataFrame:
    """``(term, term_id)``, ids from 0 in the order in which terms are first seen.

    The first position of each term is a map-side-combined minimum; the ids come from a range
    sort with per-partition offsets, never from a one-partition window.
    """
    seen = unnest(tokens, ["doc_id"], "tokens", "term", "pos")
    first = seen.groupBy("term").agg(F.min(F.struct("doc_id", "pos")).alias("first"))
    placed = first.select("term", F.col("first.doc_id").alias("doc_id"), F.col("first.pos").alias("pos"))
    return with_dense_id(placed, ["doc_id", "pos"], "term_id").select("term", "term_id")


def id_to_term(ids: DataFrame, words: DataFrame) -> DataFrame:
    """Inverse look-up: add ``term`` to a table keyed by ``term_id``."""
    return ids.join(words, "term_id")


def term_counts(tokens: DataFrame, words: DataFrame) -> DataFrame:
    """``(doc_id, term_id, n)``; terms outside the dictionary are dropped. Counts are made per row,
    so the only shuffle is the dictionary join (none at all when the dictionary is small)."""
    counted = explode_bags(bags(tokens.select("doc_id", "tokens")))
    return counted.join(words, "term").select("doc_id", "term_id", "n")


def label_terms(tokens: DataFrame, label: str = "label") -> DataFrame:
    """``(label, term, n, df)``: occurrences and documents per class and term.

    One pass over the text serves class TF, variance, document frequency and IDF. Frequent terms
    and large classes are combined on the map side before they are shuffled.
    """
    both = tokens.select(F.col(label).alias("label"), F.array("tokens", F.array_distinct("tokens")).alias("lists"))
    lists = unnest(both, ["label"], "lists", "list", "distinct")
    rows = unnest(lists, ["label", "distinct"], "list", "term")
    return rows.groupBy("label", "term").agg(
        F.count_if(F.col("distinct") == 0).alias("n"), F.count_if(F.col("distinct") == 1).alias("df")
    )


def label_set(docs: DataFrame, label: str = "label") -> DataFrame:
    """Distinct labels and the number of documents of each."""
    return docs.groupBy(F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("n_docs"))


def class_tf(by_label: DataFrame) -> DataFrame:
    """``(label, term, tf)``: share of the term among all tokens of its class."""
    totals = by_label.groupBy("label").agg(F.sum("n").alias("total"))  # one row per class
    return by_label.join(totals, "label").select("label", "term", (F.col("n") / F.col("total")).alias("tf"))


def population_variance_with_zeros(value: Column, classes: Column) -> Column:
    """Population variance over ``classes`` cells of which only the present ones are rows.

    Present cells keep Spark's stable running variance; the absent zeros are merged in by the
    formula for pooling two groups, so nothing cancels and no dense grid is built.
    """
    present = F.count(value).cast("double")
    absent = classes - present
    pooled = present * F.var_pop(value) + F.pow(F.avg(value), 2) * present * absent / classes
    return pooled / classes


def class_variance(tf: DataFrame, n_classes: int | Column) -> DataFrame:
    """``(term, var)``: variance of the class TFs, classes without the term counting as zero."""
    classes = n_classes if isinstance(n_classes, Column) else F.lit(float(n_classes))
    return tf.groupBy("term").agg(population_variance_with_zeros(F.col("tf"), classes).alias("var"))


def by_variance(variance: DataFrame, digits: int = 10) -> tuple[DataFrame, list[Column]]:
    """The table with key columns of its own, or each comparison of a sort would round again, and the order of
    ``select_terms`` by them."""
    power = F.when(F.col("var") > 0, F.floor(F.log10("var")))
    keyed = variance.withColumn("__power", power).withColumn("__key", F.round(F.col("var") / F.pow(F.lit(10.0), "__power"), digits))
    return keyed, [F.desc_nulls_last("__power"), F.desc("__key"), F.asc("term")]


def select_terms(variance: DataFrame, n_dims: int, digits: int = 10) -> DataFrame:
    """The ``n_dims`` terms of largest variance. Variances that agree to ``digits`` decimals of their leading
    figure count as equal, whatever their size, and are ordered by the term, so the cut does not depend on
    summation order."""
    keyed, order = by_variance(variance, digits)
    return keyed.orderBy(*order).limit(n_dims).drop("__power", "__key")


def doc_freq(counts: DataFrame) -> DataFrame:
    """``(term_id, df)``: documents that hold the term."""
    return counts.where("n > 0").groupBy("term_id").agg(F.count(F.lit(1)).alias("df"))


def idf(df: Column, n_docs: int | Column) -> Column:
    """ln(N / df), without smoothing."""
    return F.log((n_docs if isinstance(n_docs, Column) else F.lit(float(n_docs))) / df)
