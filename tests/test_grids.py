"""Grids that share work against separate fits of every set."""

import numpy as np
import pytest

from themata.operators import learners, mixture, neighbours
from themata.plans import experiments, grids


@pytest.fixture(scope="module")
def parts(clusters):
    rng = np.random.default_rng(8)
    spark = clusters.sparkSession
    # the same rows, some of which are mislabelled
    rows = [(r["id"], r["label"] if r["id"] % 6 else "abcd"[int(rng.integers(0, 4))], r["features"]) for r in clusters.orderBy("id").collect()]
    df = spark.createDataFrame(rows, clusters.schema).coalesce(2).cache()
    return df.where("id % 5 <> 0"), df.where("id % 5 = 0")


def accuracies(df):
    return [r["accuracy"] for r in df.orderBy("run_id").collect()]


def test_sets_that_run_together():
    found = grids.grouped(experiments.grids()["KNN"])
    assert [(m, c, len(s)) for m, c, s in found] == [("KNN", {"metric": m}, 3) for m in ("euclidean", "cosine", "mahalanobis")]
    assert len(grids.grouped(experiments.grids()["RandomForest"])) == 1 and len(grids.grouped(experiments.grids()["GMM"])) == 2
    assert len(grids.grouped(experiments.grids()["SVM"])) == 3 and len(grids.grouped(experiments.grids()["ANN"])) == 4
    v = np.eye(2)
    mixed = [{"method": "KNN", "V": v}, {"method": "KNN", "V": v, "n_neighbors": 3}, {"method": "KNN", "V": np.eye(2)}, {"method": "other"}, {"method": "other"}]
    assert [[place for place, _ in s] for _, _, s in grids.grouped(mixed)] == [[0, 1], [2], [3], [4]]


def test_equal_to_separate_fits(parts):
    grid = [{"method": "KNN", "metric": m, "n_neighbors": n} for m in ("cosine", "mahalanobis") for n in (1, 9)]
    grid += [{"method": "MEAN", "metric": m} for m in ("euclidean", "cosine", "mahalanobis")] + [{"method": "NB", "prior": p} for p in ("rows", "positive_cells")]
    grid += [{"method": "SVM", "kernel": "linear", "C": c, "max_iter": 5} for c in (0.5, 1.5)]
    one, many = grids.shared_grid(*parts, grid), experiments.parameter_grid(*parts, grid)
    assert accuracies(one) == accuracies(many)
    shown = lambda df: [(r["run_id"], r["method"], r["params"]) for r in df.orderBy("run_id").collect()]
    assert shown(one) == shown(many)


def test_one_search_for_all_numbers(parts, monkeypatch):
    calls = []
    search = neighbours.nearest
    monkeypatch.setattr(neighbours, "nearest", lambda *a: calls.append(a[2]) or search(*a))
    grids.shared_grid(*parts, experiments.grids()["KNN"])
    assert calls == [20, 20, 20]


def test_first_trees_of_a_forest(parts):
    train, test = parts
    forest = learners.fit_forest(train, n_estimators=7, max_depth=6)
    rows = forest.prefix_predictions(test, [1, 4, 7]).collect()
    whole = {r["id"]: r["prediction"] for r in forest.predict(test).collect()}
    assert all(r["predictions"][2] == whole[r["id"]] for r in rows)
    assert len({tuple(r["predictions"]) for r in rows}) > 4
    scores = grids.forest_scores(train, test, [1, 4, 7], max_depth=6)
    labels = {r["id"]: r["label"] for r in test.collect()}
    assert np.allclose(scores, [np.mean([r["predictions"][i] == labels[r["id"]] for r in rows]) for i in range(3)])


@pytest.mark.parametrize("kind", ["full", "diag"])
def test_mixtures_of_growing_size(parts, kind):
    train, test = parts
    fitted = mixture.fit_path(kind, train, [3, 1, 2], max_iter=20)
    assert [len(fitted[n].parts["a"]) for n in (1, 2, 3)] == [1, 2, 3]
    assert fitted[1].history[-1] <= fitted[2].history[-1] <= fitted[3].history[-1]
    alone = (mixture.fit_gmm_full if kind == "full" else mixture.fit_gmm_diag)(train, n_components=1)
    assert np.allclose(alone.parts["b"][0][1], fitted[1].parts["b"][0][1])
    scores = accuracies(grids.shared_grid(train, test, [{"method": "GMM", "covariance_type": kind, "n_components": n} for n in (1, 2)]))
    again = mixture.fit_path(kind, train, [1, 2])
    assert scores[0] > 0.7 and np.allclose(scores, [experiments.evaluate_model(again[n], test) for n in (1, 2)])


def test_split_components_keep_weight_and_mean():
    spread = np.linalg.cholesky(np.linalg.inv(np.diag([4.0, 1.0])))
    two = mixture.grown("full", [(1.0, np.array([1.0, 2.0]), spread)], 2)
    assert [w for w, _, _ in two] == [0.5, 0.5] and np.allclose(sorted(m.tolist() for _, m, _ in two), [[0, 2], [2, 2]])
    three = mixture.grown("diag", [(0.3, np.zeros(2), np.ones(2)), (0.7, np.ones(2), np.array([1.0, 9.0]))], 3)
    assert np.isclose(sum(w for w, _, _ in three), 1) and sorted(w for w, _, _ in three) == [0.3, 0.35, 0.35]


def test_networks_of_all_rates(parts):
    grid = [{"method": "ANN", "epochs": 4, "batch_size": 60, "learning_rate": r} for r in (0.0001, 0.03)]
    low, high = accuracies(grids.shared_grid(*parts, grid))
    assert high > low and np.allclose([low, high], accuracies(experiments.parameter_grid(*parts, grid)))
