"""Training by name, parameter grids, and k-fold runs of the whole chain."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

from pyspark.sql import Column, DataFrame, functions as F

from themata.cluster import materialise
from themata.operators import centroids, learners, mixture, neighbours, network
from themata.operators.evaluate import accuracy
from themata.operators.reduce import covariance, fit_reduction
from themata.plans.features import FeatureModel

GRID_SCHEMA = "run_id int, method string, params map<string,string>, accuracy double"


@dataclass
class KNNModel:
    """The training rows themselves, with the metric."""

    train: DataFrame
    n_neighbors: int
    metric: object
    covariance: object

    def predict(self, df: DataFrame, column: str = "features") -> DataFrame:
        test = df.select("id", F.col(column).alias("features"))
        found = neighbours.knn_predict(self.train, test, self.n_neighbors, self.metric, self.covariance)
        return df.join(found, "id", "left")


def _fit_knn(df: DataFrame, n_neighbors: int = 5, metric="euclidean", V=None) -> KNNModel:
    if metric == "mahalanobis" and V is None:
        V = covariance(df)
    return KNNModel(df.select("id", "label", "features"), n_neighbors, metric, V)


def _fit_mean(df: DataFrame, metric="cosine", V=None):
    if metric == "mahalanobis" and V is None:
        V = covariance(df)
    return centroids.fit_centroids(df, metric, V)


def _fit_gmm(df: DataFrame, covariance_type: str = "full", **params):
    fits = {"full": mixture.fit_gmm_full, "diag": mixture.fit_gmm_diag}
    if covariance_type not in fits:
        raise ValueError(f"no such covariance type: {covariance_type}")
    return fits[covariance_type](df, **params)


METHODS: dict[str, Callable] = {
    "KNN": _fit_knn,
    "MEAN": _fit_mean,
    "NB": centroids.fit_gnb,
    "GMM": _fit_gmm,
    "RandomForest": learners.fit_forest,
    "SVM": learners.fit_svm,
    "ANN": network.fit_network,
    "MLP": learners.fit_mlp,
}


def train_model(df: DataFrame, method: str = "KNN", **params):
    """Fit the named classifier on ``(id, label, features)``."""
    if method not in METHODS:
        raise ValueError(f"no such classifier: {method}")
    return METHODS[method](df, **params)


def evaluate_model(model, df: DataFrame) -> float:
    if model is None:
        raise RuntimeError("train the classifier first")
    return accuracy(model.predict(df)).first()["accuracy"]


def shown(params: dict) -> dict[str, str]:
    return {k: getattr(v, "__name__", str(v)) for k, v in params.items()}


def parameter_grid(train: DataFrame, test: DataFrame, grid: list[dict], threads: int = 4) -> DataFrame:
    """Fit and score each parameter set (``method`` and its arguments) on one fixed split.

    All fits read the same stage tables; a few run at a time so that small jobs overlap.
    """
    train, test = materialise(train), materialise(test)

    def run(item):
        number, params = item
        arguments = {k: v for k, v in params.items() if k != "method"}
        score = evaluate_model(train_model(train, params["method"], **arguments), test)
        return number, params["method"], shown(arguments), float(score)

    with ThreadPool(threads) as pool:
        rows = pool.map(run, list(enumerate(grid)))
    return train.sparkSession.createDataFrame(rows, GRID_SCHEMA)


def grids() -> dict[str, list[dict]]:
    """The swept parameter sets per method (fixed values)."""
    counts, forest = range(1, 30), range(20, 80, 3)
    return {
        "KNN": [{"method": "KNN", "metric": m, "n_neighbors": n}
                for m in ("euclidean", "cosine", "mahalanobis") for n in (5, 10, 20)],
        "RandomForest": [{"method": "RandomForest", "n_estimators": n} for n in forest],
        "MEAN": [{"method": "MEAN", "metric": m} for m in ("euclidean", "cosine", "mahalanobis")],
        "GMM": [{"method": "GMM", "covariance_type": c, "n_components": n} for c in ("full", "diag") for n in counts],
        "SVM": [{"method": "SVM", "kernel": k, "C": c} for k in ("rbf", "linear", "poly") for c in (0.5, 1.0, 1.5)],
        "ANN": [{"method": "ANN", "epochs": 10, "batch_size": b, "learning_rate": (1 + 200 * i) / 1000} for b in (10, 20, 50, 80) for i in range(5)],
    }


def all_models() -> list[dict]:
    """One parameter set per classifier, for the comparison of all models (fixed values)."""
    return [
        {"method": "NB"},
        {"method": "SVM", "kernel": "rbf", "C": 1.5},
        {"method": "RandomForest", "n_estimators": 35},
        {"method": "MEAN", "metric": "mahalanobis"},
        {"method": "GMM", "covariance_type": "diag", "n_components": 11},
        {"method": "KNN", "n_neighbors": 10, "metric": "cosine"},
        {"method": "ANN", "epochs": 40, "batch_size": 20},
    ]


def k_fold(df: DataFrame, k: int, fold: Column, fit_and_score: Callable[[DataFrame, DataFrame], DataFrame]) -> DataFrame:
    """The rows of a parameter grid with their ``fold``; ``fit_and_score(train, test)`` returns them and sees
    nothing of the test part while fitting."""
    rows = materialise(df.withColumn("__fold", fold))
    out = []
    for number in range(k):
        train = rows.where(F.col("__fold") != number).drop("__fold")
        test = rows.where(F.col("__fold") == number).drop("__fold")
        out += [(number, *row) for row in fit_and_score(train, test).collect()]  # one row per parameter set
    return df.sparkSession.createDataFrame(out, f"fold int, {GRID_SCHEMA}")


def fold_means(scores: DataFrame) -> DataFrame:
    """Mean accuracy of each parameter set over the folds."""
    named = scores.groupBy("run_id", "method", F.array_sort(F.map_entries("params")).alias("params"))
    return named.agg(F.avg("accuracy").alias("accuracy")).withColumn("params", F.map_from_entries("params"))


def text_vectors(train: DataFrame, test: DataFrame, n_dims: int = 3000, n_bigrams: int = 0, bigram_min_freq: int = 5,
                 method: str = "binary", reduction: str = "PCA", components: int = 70) -> tuple[DataFrame, DataFrame]:
    """Tokens ``(doc_id, label, tokens)`` to reduced vectors ``(id, label, features)``, everything
    fitted on the training part."""
    model = FeatureModel.fit(train, n_dims=n_dims, n_bigrams=n_bigrams, bigram_min_freq=bigram_min_freq, method=method)
    vectors = materialise(model.vectors(train))
    reducer = fit_reduction(vectors, reduction, components)
    named = lambda df: reducer.transform(df).withColumnRenamed("doc_id", "id").select("id", "label", "features")
    return materialise(named(vectors)), materialise(named(model.vectors(test)))


def compare_models(tokens: DataFrame, k: int, fold: Column, models: list[dict] | None = None, threads: int = 4,
                   **chain) -> DataFrame:
    """K-fold comparison: per fold the whole chain is fitted on the training part, then every model."""
    chosen = models or all_models()

    def fit_and_score(train: DataFrame, test: DataFrame) -> DataFrame:
        return parameter_grid(*text_vectors(train, test, **chain), chosen, threads)

    return k_fold(tokens, k, fold, fit_and_score)


def single_run(train: DataFrame, test: DataFrame, params: dict, **chain) -> float:
    """Train on one corpus, score on another, both ``(doc_id, label, tokens)``."""
    a, b = text_vectors(train, test, **chain)
    arguments = {key: v for key, v in params.items() if key != "method"}
    return evaluate_model(train_model(a, params["method"], **arguments), b)
