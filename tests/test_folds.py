"""Folds from additive statistics against separate fits of every fold."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from themata.operators import dictionary as D
from themata.operators import reduce
from themata.plans import experiments, folds
from themata.plans.features import FeatureModel



def by_id():
    return F.pmod("doc_id", F.lit(3)).cast("int")


@pytest.fixture(scope="module")
def tokens(spark):
    """Documents of three classes; one class is in one fold only, and some documents have no label or no tokens."""
    rng = np.random.default_rng(11)
    own = {c: [f"{c}{i}".upper() for i in range(14)] for c in "xyz"}
    both = [f"W{i}" for i in range(20)]
    rows = []
    for i in range(150):
        label = "xyz"[i % 2] if i % 25 else "z"
        words = list(rng.choice(own[label], rng.integers(3, 8))) + list(rng.choice(both, rng.integers(2, 9))) + ["ALWAYS"]
        rows.append((i, label, [str(w) for w in words]))
    rows += [(150, "x", []), (151, None, ["W1", "W2"]), (152, "y", ["NOWHERE"])]
    rows += [(153 + 3 * i, "u", ["U1", "U2", "W1"]) for i in range(4)]  # all in fold 0
    return spark.createDataFrame(rows, "doc_id long, label string, tokens array<string>").repartition(3).cache()


def test_terms_of_every_fold(tokens):
    found = folds.fold_terms(tokens, by_id(), 3, 25).orderBy("fold", "rank").collect()
    for f in range(3):
        model = FeatureModel.fit(tokens.where(by_id() != f), n_dims=25)
        want = model.vocabulary()
        mine = [r for r in found if r["fold"] == f]
        assert [(r["rank"], r["term"], r["df"]) for r in mine] == [(r["rank"], r["term"], r["df"]) for r in want]
        assert np.allclose([r["var"] for r in mine], [r["var"] for r in want], rtol=1e-12)
        assert np.allclose([r["idf"] for r in mine], [r["idf"] for r in want], rtol=1e-14)


@pytest.mark.parametrize("method", ["binary", "none", "log", "entropy"])
def test_weights_and_axes_of_every_fold(tokens, method):
    chain = folds.fit_chain(tokens, by_id(), 3, n_dims=25, method=method, components=4)
    rows = chain.rows.orderBy("doc_id").collect()
    counts = np.array([r["counts"].toArray() for r in rows])
    own = np.array([r["fold"] for r in rows])
    for f in range(3):
        model = FeatureModel.fit(tokens.where(by_id() != f), n_dims=25, method=method)
        want = {r["doc_id"]: r["features"].toArray() for r in model.vectors(tokens.where("label is not null")).collect()}
        assert np.allclose(chain.features[f](counts), [want[r["doc_id"]] for r in rows], atol=1e-12)
        x = chain.features[f](counts[own != f])
        base = x - x.mean(0)
        values = np.linalg.svd(base, compute_uv=False)[:4] ** 2
        projected = (x - chain.projections[f].mean) @ chain.projections[f].components
        assert np.allclose((projected**2).sum(0), values, rtol=1e-8) and np.allclose(chain.projections[f].mean, x.mean(0))


def test_all_models_equal_separate_fits(tokens):
    models = [
        {"method": "NB"}, {"method": "NB", "prior": "positive_cells"}, {"method": "MEAN", "metric": "euclidean"}, {"method": "MEAN", "metric": "cosine"},
        {"method": "MEAN", "metric": "mahalanobis"}, {"method": "GMM", "covariance_type": "diag", "n_components": 1},
        {"method": "GMM", "covariance_type": "full", "n_components": 1},
    ]
    key = lambda r: (r["fold"], r["run_id"])
    mine = sorted(folds.fold_scores(folds.fit_chain(tokens, by_id(), 3, n_dims=25, components=3), models).collect(), key=key)
    want = sorted(experiments.compare_models(tokens.where("label is not null"), 3, by_id(), models, n_dims=25, components=3).collect(), key=key)
    assert [(r["fold"], r["method"], r["params"]) for r in mine] == [(r["fold"], r["method"], r["params"]) for r in want]
    assert np.allclose([r["accuracy"] for r in mine], [r["accuracy"] for r in want], atol=1e-12)


def test_without_reduction_and_wide(tokens, monkeypatch):
    models = [{"method": "NB"}, {"method": "MEAN", "metric": "euclidean"}]
    plain = folds.fold_scores(folds.fit_chain(tokens, by_id(), 3, n_dims=25, components=None), models).collect()
    assert len(plain) == 6
    one = folds.fit_chain(tokens, by_id(), 3, n_dims=25, components=4)
    monkeypatch.setattr(folds, "MATRIX_WIDTH", 10)  # more columns than fit a matrix: fold by fold
    two = folds.fit_chain(tokens, by_id(), 3, n_dims=25, components=4)
    for a, b in zip(one.projections, two.projections):
        assert np.allclose(np.abs(a.components), np.abs(b.components), atol=1e-6) and np.allclose(a.variances, b.variances)


def test_what_is_refused(tokens):
    chain = folds.fit_chain(tokens, by_id(), 3, n_dims=10, components=2)
    for params in ({"method": "KNN"}, {"method": "GMM", "n_components": 2}, {"method": "MEAN", "metric": "none"}):
        with pytest.raises(ValueError):
            folds.fold_scores(chain, [params])
    with pytest.raises(ValueError):
        folds.fit_chain(tokens, by_id(), 3, method="cube")
    with pytest.raises(RuntimeError):
        folds.fit_chain(tokens.limit(0), by_id(), 3)


def test_the_text_is_read_once(tokens, spark, tmp_path):
    tokens.write.parquet(f"{tmp_path}/t")
    read = spark.sparkContext.accumulator(0)

    @F.udf("array<string>")
    def counted(words):
        read.add(1)
        return words

    stored = spark.read.parquet(f"{tmp_path}/t").withColumn("tokens", counted("tokens"))
    chain = folds.fit_chain(stored, by_id(), 3, n_dims=25, components=3)
    folds.fold_scores(chain, [{"method": "NB"}]).collect()
    assert read.value <= tokens.count()
    assert D.label_set(tokens).count() == 5 and isinstance(chain.projections[0], reduce.Projection)
