"""Dimensionality reduction and linear statistics on ``(…, features)`` tables.

Fitted reductions hold a width x k matrix; applying one is a block product per Arrow batch.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import DataFrame, functions as F

from themata.functions.blocks import DOUBLES, as_vector, cross_product, is_vector, lists, width_of
from themata.operators.wide import Axes, covariance_axes, times, top_axes

#: Columns up to which a columns x columns matrix is formed, in tasks and on the driver (128 MB).
MATRIX_WIDTH = 4096


@dataclass
class Projection:
    """``y = (x - mean) @ components``."""

    components: np.ndarray
    mean: np.ndarray
    variances: np.ndarray

    def transform(self, df: DataFrame, column: str = "features") -> DataFrame:
        components, shift = self.components, self.mean @ self.components
        source = F.col(column) if is_vector(df, column) else F.col(column).cast("array<double>")

        @F.arrow_udf(DOUBLES)
        def project(values: pa.Array) -> pa.Array:
            return lists(times(values, components) - shift)

        return df.withColumn(column, project(source))


def fixed_signs(components: np.ndarray) -> np.ndarray:
    """Flip components so that the entry of largest size is positive."""
    largest = components[np.argmax(np.abs(components), axis=0), np.arange(components.shape[1])]
    return components * np.where(largest < 0, -1.0, 1.0)


def class_means(df: DataFrame, column: str = "features", label: str = "label") -> DataFrame:
    """``(label, n, mean, variance)`` per class, as arrays; one map-side-combined aggregate.
    ``variance`` is the population variance."""
    vectors = df.select(F.col(label).alias("label"), as_vector(df, column).alias("v"))
    stats = vectors.groupBy("label").agg(
        Summarizer.metrics("count", "mean", "variance").summary(F.col("v")).alias("s")
    )
    n = F.col("s.count")
    return stats.select(
        "label",
        n.alias("n"),
        vector_to_array("s.mean").alias("mean"),
        F.transform(vector_to_array("s.variance"), lambda v: v * (n - 1) / n).alias("variance"),
    )


def fit_pca(df: DataFrame, k: int, column: str = "features") -> Projection:
    """Centred PCA. Up to ``MATRIX_WIDTH`` columns tasks sum the covariance in one pass and the driver finds its leading
    axes; wider tables take passes over the rows instead, see ``wide``. The mean is taken off after the product, so
    sparse rows stay sparse."""
    width = width_of(df, column)
    if width > MATRIX_WIDTH:
        axes, mean, total = covariance_axes(df, k, column)
    else:
        vectors = df.select(as_vector(df, column).alias("v"))
        mean = vectors.select(Summarizer.mean(F.col("v")).alias("m")).first()["m"].toArray()
        whole = covariance(df, column)
        axes, total = _matrix_axes(whole, k), float(np.trace(whole))
    return Projection(fixed_signs(axes.vectors), mean, axes.values / total if total else axes.values)


def fit_svd(df: DataFrame, k: int, column: str = "features") -> Projection:
    """Top right-singular vectors of the uncentred matrix; ``variances`` holds singular values. Wide tables as for PCA."""
    width = width_of(df, column)
    if width > MATRIX_WIDTH:
        axes, _, _ = covariance_axes(df, k, column, centred=False)
    else:
        axes = _matrix_axes(cross_product(df, column, width), k)
    return Projection(fixed_signs(axes.vectors), np.zeros(width), np.sqrt(axes.values))


def pca_of_moments(n: int, total: np.ndarray, products: np.ndarray, k: int) -> Projection:
    """Centred PCA from the number of rows, their sum and the sum of their outer products."""
    whole = (products - np.outer(total, total) / n) / max(n - 1, 1)
    axes, trace = _matrix_axes(whole, k), float(np.trace(whole))
    return Projection(fixed_signs(axes.vectors), total / n, axes.values / trace if trace > 0 else axes.values)


def _matrix_axes(whole: np.ndarray, k: int) -> Axes:
    """Leading axes of a matrix at hand: all of them where it is small, else by subspaces."""
    if len(whole) <= 512 or 4 * k > len(whole):
        values, vectors = np.linalg.eigh(whole)
        k = min(k, len(whole))
        return Axes(vectors[:, ::-1][:, :k], np.maximum(values[::-1][:k], 0.0), np.zeros(k), 0)
    return top_axes(lambda w: whole @ w, len(whole), k)


@dataclass
class Scatter:
    """Within and between class scatter, with what they were computed from."""

    labels: list
    priors: np.ndarray
    means: np.ndarray
    mean: np.ndarray
    within: np.ndarray
    between: np.ndarray


def lda_scatter(df: DataFrame, column: str = "features", label: str = "label") -> Scatter:
    """Sw = sum P_i cov_i (n-1 covariances), Sb = sum P_i (mu_i - m)(mu_i - m)^T.

    Two passes: class means, then one weighted cross product of the rows minus their class mean.
    """
    rows = sorted(class_means(df, column, label).collect(), key=lambda r: r["label"])
    labels = [r["label"] for r in rows]
    counts = np.array([r["n"] for r in rows], float)
    means = np.array([r["mean"] for r in rows])
    priors = counts / counts.sum()
    mean = priors @ means
    # P_i / (n_i - 1) on each row of class i; a class of one row has no spread
    weight = {l: p / (n - 1) if n > 1 else 0.0 for l, p, n in zip(labels, priors, counts)}
    pairs = [F.lit(x) for item in weight.items() for x in item]
    weighted = df.withColumn("__w", F.element_at(F.create_map(*pairs), F.col(label)))
    if not is_vector(df, column):
        weighted = weighted.withColumn(column, F.col(column).cast("array<double>"))
    within = cross_product(weighted, column, means.shape[1], "__w", dict(zip(labels, means)), label)
    off = means - mean
    return Scatter(labels, priors, means, mean, within, (off * priors[:, None]).T @ off)


def fit_lda(df: DataFrame, k: int, column: str = "features", label: str = "label") -> Projection:
    """Eigenvectors of pinv(Sw) Sb, largest eigenvalue first; k = min(asked, classes - 1, width)."""
    scatter = lda_scatter(df, column, label)
    values, vectors = np.linalg.eig(np.linalg.pinv(scatter.within) @ scatter.between)
    order = np.argsort(-values.real, kind="stable")[: min(k, len(scatter.labels) - 1, len(values))]
    components = fixed_signs(vectors.real[:, order])
    return Projection(components, np.zeros(len(values)), values.real[order])


REDUCTIONS = {"PCA": fit_pca, "SVD": fit_svd, "LDA": fit_lda}


def fit_reduction(df: DataFrame, method: str, k: int, column: str = "features", label: str = "label") -> Projection:
    if method not in REDUCTIONS:
        raise ValueError(f"no such reduction: {method}")
    extra = (label,) if method == "LDA" else ()
    return REDUCTIONS[method](df, k, column, *extra)


def covariance(df: DataFrame, column: str = "features") -> np.ndarray:
    """Covariance matrix of the columns, n-1 denominator."""
    vectors = df.select(as_vector(df, column).alias("v"))
    rows = RowMatrix(MLUtils.convertVectorColumnsFromML(vectors, "v"))
    return rows.computeCovariance().toArray()


def matrix_cells(spark, values: np.ndarray, name: str = "value") -> DataFrame:
    """A width x width matrix as rows ``(i, j, value)`` with i <= j."""
    cells = [(int(i), int(j), float(values[i, j])) for i, j in zip(*np.triu_indices(len(values)))]
    return spark.createDataFrame(cells, f"i int, j int, {name} double")
