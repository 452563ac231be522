"""Nearest class mean and Gaussian naive Bayes. Parameters: classes x width numbers."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from themata.functions.blocks import as_array, best_class, is_vector
from themata.operators.neighbours import METRICS, whitening
from themata.operators.reduce import class_means


def features_of(df: DataFrame, column: str = "features") -> Column:
    return F.col(column) if is_vector(df, column) else F.col(column).cast("array<double>")


@dataclass
class CentroidModel:
    labels: list
    means: np.ndarray
    metric: object = "euclidean"
    covariance: np.ndarray | None = None

    def _distance(self):
        means, metric = self.means, self.metric
        if not isinstance(metric, str):
            return lambda x: np.stack([metric(x, m) for m in means], axis=1)
        if metric == "cosine":
            lengths = np.linalg.norm(means, axis=1)
            # dividing by the row's own length does not change which class is nearest
            return lambda x: -(x @ means.T) / np.where(lengths == 0, 1.0, lengths)
        if metric == "mahalanobis":
            white = whitening(self.covariance)
            return lambda x: np.stack([(((x - m) @ white) ** 2).sum(1) for m in means], axis=1)
        return lambda x: np.stack([((x - m) ** 2).sum(1) for m in means], axis=1)

    def scorer(self):
        """Function from a block of rows to rows x classes, the best class largest."""
        distance = self._distance()
        return lambda x: -distance(x)

    def predict(self, df: DataFrame, column: str = "features") -> DataFrame:
        """Add ``prediction``: the nearest class mean, the first class on a tie. Narrow."""
        picked = best_class(features_of(df, column), self.means.shape[1], self.scorer(), self.labels)
        return df.withColumn("prediction", picked)


def fit_centroids(df: DataFrame, metric="cosine", covariance=None, column="features", label="label") -> CentroidModel:
    """``metric``: a name, or a function (row block, class mean) -> distances."""
    if isinstance(metric, str) and metric not in METRICS:
        raise ValueError(f"no such metric: {metric}")
    if metric == "mahalanobis" and covariance is None:
        raise ValueError("the mahalanobis metric needs a covariance matrix")
    rows = sorted(class_means(df, column, label).collect(), key=lambda r: r["label"])
    return CentroidModel([r["label"] for r in rows], np.array([r["mean"] for r in rows]), metric, covariance)


def gnb_stats(df: DataFrame, column: str = "features", label: str = "label") -> DataFrame:
    """``(label, n, mean, variance, prior, prior_positive_cells)`` per class, arrays per column.

    ``prior_positive_cells`` is the number of positive cells of the class over all rows.
    """
    positive = F.size(F.filter(as_array(df, column), lambda x: x > 0))
    cells = df.groupBy(F.col(label).alias("label")).agg(F.sum(positive).alias("positive"))
    stats = class_means(df, column, label).join(cells, "label")  # one row per class
    rows = df.agg(F.count(F.lit(1))).scalar()
    return stats.select(
        "label", "n", "mean", "variance", (F.col("n") / rows).alias("prior"),
        (F.col("positive") / rows).alias("prior_positive_cells"),
    )


@dataclass
class GaussianNBModel:
    labels: list
    means: np.ndarray
    variances: np.ndarray
    priors: np.ndarray

    def scorer(self):
        """Function from a block of rows to rows x classes: log prior plus sum of log densities (no underflow)."""
        means, var, prior = self.means, self.variances, np.log(self.priors)
        constant = prior - 0.5 * np.log(2 * np.pi * var).sum(1)
        return lambda x: np.stack([c - 0.5 * ((x - m) ** 2 / v).sum(1) for c, m, v in zip(constant, means, var)], axis=1)

    def predict(self, df: DataFrame, column: str = "features") -> DataFrame:
        """Add ``prediction``: the class of the largest score. Narrow."""
        return df.withColumn("prediction", best_class(features_of(df, column), self.means.shape[1], self.scorer(), self.labels))


def fit_gnb(df: DataFrame, column="features", label="label", prior: str = "rows") -> GaussianNBModel:
    """``prior``: ``rows`` (class share) or ``positive_cells``. Zero variances get a floor of 1e-9 of
    the largest one."""
    if prior not in ("rows", "positive_cells"):
        raise ValueError(f"no such prior: {prior}")
    rows = sorted(gnb_stats(df, column, label).collect(), key=lambda r: r["label"])
    weight = "prior" if prior == "rows" else "prior_positive_cells"
    return gnb_model(*([r[c] for r in rows] for c in ("label", "mean", "variance", weight)))


def gnb_model(labels: list, means, variances, priors) -> GaussianNBModel:
    variances = np.array(variances)
    floor = 1e-9 * max(variances.max(), 1e-12)
    return GaussianNBModel(labels, np.array(means), np.maximum(variances, floor), np.maximum(np.array(priors, float), 1e-300))
