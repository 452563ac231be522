"""The feature model: term selection, IDF and weight transform fitted on training documents."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, Normalizer
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from themata.cluster import INLINE_TERMS, broadcast_if_small, keyed_rows, materialise, unnest
from themata.functions.arrays import bag
from themata.functions.text import keep_terms
from themata.operators import dictionary as D
from themata.operators.ngrams import append_bigrams, fit_bigrams
from themata.operators.weights import TRANSFORMS, entropy_weights, transform_weights


@dataclass
class FeatureModel:
    """Everything the test rows need from training. ``selected`` has one row per kept term:
    ``(rank, term_id, term, var, df, idf)``, best first; it is bounded by ``n_dims``."""

    selected: DataFrame
    n_docs: int
    labels: list
    n_dims: int
    bigrams: DataFrame | None = None
    n_bigrams: int = 0
    entropy: DataFrame | None = None
    method: str = "none"
    _vocabulary: list = field(default_factory=list, repr=False)

    # -- training ---------------------------------------------------------------------------

    @classmethod
    def fit(
        cls,
        tokens: DataFrame,
        label: str = "label",
        n_dims: int = 3000,
        n_bigrams: int = 0,
        bigram_min_freq: int = 3,
        method: str = "none",
    ) -> "FeatureModel":
        """Fit on ``(doc_id, label, tokens)``; rows with a null label are left out. Two jobs over the text (three with bigrams): the class
        counts, and for the entropy transform the column sums."""
        if method not in TRANSFORMS:
            raise ValueError(f"no such transform: {method}")
        kept = None
        if n_bigrams > 0:
            kept = fit_bigrams(tokens, n_bigrams, bigram_min_freq)
            tokens = append_bigrams(tokens, kept, n_bigrams)
        tokens = tokens.where(F.col(label).isNotNull())  # a document without a class cannot train
        by_label = materialise(D.label_terms(tokens, label))
        sizes = {r["label"]: r["n_docs"] for r in D.label_set(tokens, label).collect()}
        n_docs = sum(sizes.values())
        selected = materialise(rank_terms(by_label, len(sizes), n_docs, n_dims))
        model = cls(selected, n_docs, sorted(sizes), n_dims, kept, n_bigrams)
        if method == "entropy":
            model.entropy = materialise(entropy_weights(model._tfidf(tokens), n_docs))
        model.method = method
        return model

    # -- use --------------------------------------------------------------------------------

    def vocabulary(self) -> list:
        """The selected rows, best first. At most ``n_dims`` of them."""
        if not self._vocabulary:
            self._vocabulary = self.selected.orderBy("rank").collect()
        return self._vocabulary

    def _with_bigrams(self, tokens: DataFrame) -> DataFrame:
        return tokens if self.bigrams is None else append_bigrams(tokens, self.bigrams, self.n_bigrams)

    def counts(self, tokens: DataFrame) -> DataFrame:
        """``(doc_id, term_id, n, total, idf)`` over the selected terms; ``total`` is the document's
        sum. A bounded selection is looked up in the row, so counts and totals need no shuffle."""
        return self._counts(self._with_bigrams(tokens))

    def _counts(self, tokens: DataFrame) -> DataFrame:
        words = broadcast_if_small(self.selected.select("term", "term_id", "idf"))
        if self.n_dims <= INLINE_TERMS:
            terms = [r["term"] for r in self.vocabulary()]
            known = tokens.select("doc_id", keep_terms("tokens", terms).alias("tokens"))
            sized = known.select("doc_id", F.size("tokens").alias("total"), bag(F.col("tokens")).alias("bag"))
            found = D.explode_bags(sized).join(words, "term")
        else:
            rows = keyed_rows(tokens.select("doc_id", bag(F.col("tokens")).alias("bag")))
            listed = unnest(rows, ["__row", "doc_id"], "bag", "entry")
            found = listed.select("__row", "doc_id", "entry.term", "entry.n").join(words, "term")
            totals = found.groupBy("__row").agg(F.sum("n").alias("total"))
            found = found.join(totals, "__row")
        return found.select("doc_id", "term_id", "n", "total", "idf")

    def tf(self, tokens: DataFrame) -> DataFrame:
        return self.counts(tokens).select("doc_id", "term_id", (F.col("n") / F.col("total")).alias("tf"))

    def tfidf(self, tokens: DataFrame) -> DataFrame:
        """``(doc_id, term_id, w)`` for training or test rows, with the training IDF."""
        return self._tfidf(self._with_bigrams(tokens))

    def _tfidf(self, tokens: DataFrame) -> DataFrame:
        weight = F.col("n") / F.col("total") * F.col("idf")
        return self._counts(tokens).select("doc_id", "term_id", weight.alias("w"))

    def weights(self, tokens: DataFrame, refit: bool = False, compat: bool = False) -> DataFrame:
        """Transformed TF-IDF. ``refit=True`` re-estimates entropy weights from the given rows."""
        tfidf = self.tfidf(tokens)
        entropy = self.entropy
        if refit and self.method == "entropy":
            entropy = materialise(entropy_weights(tfidf, tokens.count()))
        return transform_weights(tfidf, self.method, entropy, compat)

    def count_vectors(self, tokens: DataFrame, output: str = "counts") -> DataFrame:
        """One sparse vector of term counts per document, column order = rank. Narrow."""
        terms = [r["term"] for r in self.vocabulary()]
        counter = CountVectorizerModel.from_vocabulary(terms, inputCol="tokens", outputCol=output)
        return counter.transform(self._with_bigrams(tokens)).drop("tokens")

    def vectors(self, tokens: DataFrame, output: str = "features") -> DataFrame:
        """One sparse vector per document (all zero if it holds no selected term), column order =
        rank. Narrow: counting, L1 norm and IDF are JVM transformers, the non-linear transforms
        touch only the stored values."""
        rows = self.vocabulary()
        keep = [c for c in tokens.columns if c != "tokens"]
        scaler = ElementwiseProduct(
            scalingVec=Vectors.dense([r["idf"] for r in rows]), inputCol="__tf", outputCol="__w"
        )
        counted = self.count_vectors(tokens, "__n")
        weighted = scaler.transform(Normalizer(p=1.0, inputCol="__n", outputCol="__tf").transform(counted))
        return weighted.select(*keep, self._transform_vector(F.col("__w")).alias(output))

    def _transform_vector(self, vector: Column) -> Column:
        if self.method == "none":
            return vector
        scale = None
        if self.method == "entropy":
            found = {r["term_id"]: r["e"] for r in self.entropy.collect()}
            scale = np.array([found.get(r["term_id"], 1.0) for r in self.vocabulary()])
        return sparse_values(vector, self.method, scale)


def sparse_values(vector: Column, method: str, scale: np.ndarray | None = None) -> Column:
    """Apply a transform to the stored values of sparse vectors, batch by batch in Arrow."""

    @F.arrow_udf(VectorUDT())
    def apply(column: pa.Array) -> pa.Array:
        kind, size, indices, values = (pc.struct_field(column, i) for i in range(4))
        stored = values.flatten().to_numpy(zero_copy_only=False)
        new = (stored > 0).astype(float) if method == "binary" else np.log1p(stored)
        if scale is not None:
            new = new * scale[indices.flatten().to_numpy(zero_copy_only=False)]
        lists = pa.ListArray.from_arrays(_offsets(values), pa.array(new, pa.float64()))
        return pa.StructArray.from_arrays([kind, size, indices, lists], ["type", "size", "indices", "values"])

    return apply(vector)


def _offsets(lists: pa.ListArray) -> pa.Array:
    lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    return pa.array(np.concatenate([[0], np.cumsum(lengths)]), pa.int32())


def rank_terms(by_label: DataFrame, n_classes: int, n_docs: int, n_dims: int) -> DataFrame:
    """``(rank, term_id, term, var, df, idf)`` from the class counts; ``term_id`` = rank - 1.

    The cut is a top-k (no global sort); only its ``n_dims`` rows are numbered in one place.
    """
    frequency = by_label.groupBy("term").agg(F.sum("df").alias("df"))
    variance = D.class_variance(D.class_tf(by_label), n_classes)
    best = D.select_terms(variance, n_dims)
    rows = [tuple(r) for r in best.select("term", "var").collect()]  # bounded by n_dims
    ranked = by_label.sparkSession.createDataFrame(
        [(i + 1, i, term, var) for i, (term, var) in enumerate(rows)],
        "rank int, term_id long, term string, var double",
    )
    return ranked.join(frequency.join(F.broadcast(ranked.select("term")), "term"), "term").select(
        "rank", "term_id", "term", "var", "df", D.idf(F.col("df"), n_docs).alias("idf")
    )
