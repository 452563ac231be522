import numpy as np
import pytest
from pyspark.sql import functions as F

from themata.checks.queries import QUERIES
from themata.operators import centroids, labels, learners, mixture, neighbours, reduce
from themata.operators.evaluate import accuracy, score_labels, score_series
from themata.plans import experiments


def features(df):
    return np.array([r["features"] for r in df.orderBy("id").collect()])


def score(model, df):
    return experiments.evaluate_model(model, df)


# -- reductions


def test_pca_against_numpy(clusters, points):
    x, _ = points
    fitted = reduce.fit_pca(clusters, 3)
    centred = x - x.mean(0)
    _, s, vt = np.linalg.svd(centred, full_matrices=False)
    assert np.allclose(fitted.components, reduce.fixed_signs(vt[:3].T))
    assert np.allclose(fitted.components.T @ fitted.components, np.eye(3))
    assert np.allclose(fitted.variances, s[:3] ** 2 / (s**2).sum())
    assert np.allclose(features(fitted.transform(clusters)), centred @ fitted.components)


def test_svd_is_not_centred(clusters, points):
    x, _ = points
    fitted = reduce.fit_svd(clusters, 2)
    _, s, vt = np.linalg.svd(x, full_matrices=False)
    assert np.allclose(fitted.variances, s[:2])
    assert np.allclose(features(fitted.transform(clusters)), x @ reduce.fixed_signs(vt[:2].T))


def test_lda_against_numpy(clusters, points):
    x, y = points
    s = reduce.lda_scatter(clusters)
    sw = sum((y == c).mean() * np.cov(x[y == c].T) for c in "abcd")
    off = np.array([x[y == c].mean(0) - x.mean(0) for c in "abcd"])
    sb = sum((y == c).mean() * np.outer(o, o) for c, o in zip("abcd", off))
    assert np.allclose(s.within, sw) and np.allclose(s.between, sb)
    fitted = reduce.fit_lda(clusters, 50)
    assert fitted.components.shape == (6, 3)  # at most classes - 1
    assert np.all(np.diff(fitted.variances) <= 1e-9)
    assert score(centroids.fit_centroids(fitted.transform(clusters), "euclidean"), fitted.transform(clusters)) > 0.95
    with pytest.raises(ValueError):
        reduce.fit_reduction(clusters, "ICA", 2)


def test_covariance(clusters, points):
    assert np.allclose(reduce.covariance(clusters), np.cov(points[0], rowvar=False))


# -- labels and splits


def test_splits(spark):
    df = spark.range(20).withColumnRenamed("id", "doc_id")
    parts = {r["doc_id"]: r["split"] for r in labels.split_at(df, 8).collect()}
    assert parts == {i: "train" if i < 8 else "test" for i in range(20)}
    fold = labels.hash_fold("doc_id", 5, seed=3)
    first = df.select("doc_id", fold.alias("f")).collect()
    assert first == df.repartition(3).select("doc_id", fold.alias("f")).orderBy("doc_id").collect()
    assert {r["f"] for r in first} <= set(range(5))


# -- neighbours


def brute(train, test, k, distance):
    out = {}
    for q, x in test.items():
        ranked = sorted((distance(np.array(x), np.array(v)), i) for i, v in train.items())
        out[q] = [i for _, i in ranked[:k]]
    return out


def unit(v):
    n = np.linalg.norm(v)
    return v / n if n else v


METRICS = {
    "euclidean": lambda a, b: np.linalg.norm(a - b),
    "cosine": lambda a, b: 1 - unit(a) @ unit(b),
}


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of all rows are copies of one vector; one row has no direction."""
    rng = np.random.default_rng(3)
    rows = [(i, f"l{i % 3}", [1.0, 2.0, 0.5] if i % 3 == 0 else rng.normal(0, 2, 3).tolist()) for i in range(300)]
    rows[7] = (7, "l1", [0.0, 0.0, 0.0])
    return spark.createDataFrame(rows, "id long, label string, features array<double>")


@pytest.mark.parametrize("metric", ["euclidean", "cosine", "mahalanobis"])
@pytest.mark.parametrize("block_rows", [4096, 20])
def test_nearest_against_brute_force(skewed, metric, block_rows):
    train = {r["id"]: r["features"] for r in skewed.collect()}
    test = {i: v for i, v in train.items() if i % 4 == 0 or i == 7}
    covariance = reduce.covariance(skewed)
    inverse = np.linalg.inv(covariance)
    distance = METRICS.get(metric, lambda a, b: np.sqrt((a - b) @ inverse @ (a - b)))
    found = neighbours.nearest(skewed, skewed.where("id % 4 = 0 or id = 7"), 5, metric, covariance, block_rows)
    got = {}
    for r in found.orderBy("id", "dist", "train_id").collect():
        got.setdefault(r["id"], []).append((r["dist"], r["train_id"]))
    want = brute(train, test, 5, distance)
    for q in test:
        a = [distance(np.array(test[q]), np.array(train[i])) for _, i in got[q]]
        b = [distance(np.array(test[q]), np.array(train[i])) for i in want[q]]
        assert np.allclose(a, b, atol=1e-9) and len(a) == 5
        assert np.allclose([d for d, _ in got[q]], b, atol=1e-7)
    if metric == "euclidean":  # ties between copies go to the smaller id
        assert [i for _, i in got[0]] == [0, 3, 6, 9, 12]


def test_pruning_visits_few_cells(spark):
    rng = np.random.default_rng(0)
    centres = rng.normal(0, 100, (10, 2))
    rows = [(i, "x", (centres[i % 10] + rng.normal(0, 1, 2)).tolist()) for i in range(500)]
    df = spark.createDataFrame(rows, "id long, label string, features array<double>")
    found = neighbours.nearest(df, df, 3, "euclidean", block_rows=20)
    want = brute({i: v for i, _, v in rows}, {i: v for i, _, v in rows}, 3, METRICS["euclidean"])
    got = {}
    for r in found.orderBy("id", "dist", "train_id").collect():
        got.setdefault(r["id"], []).append(r["train_id"])
    assert got == want


def test_blocks_grow_with_the_rows():
    """What moves is rows times the blocks of the other side: the number of blocks may not grow with the rows."""
    blocks = [-(-n // neighbours.rows_of_blocks(n, 64)) for n in (10_000, 100_000, 500_000)]
    assert blocks == [3, 8, 8]
    assert neighbours.rows_of_blocks(10**9, 64) * 64 * 8 <= neighbours.BLOCK_BYTES


@pytest.mark.parametrize("metric", ["euclidean", None])
def test_first_rows_of_a_block_with_ties(metric):
    rng = np.random.default_rng(2)
    t, q, ids = rng.integers(0, 3, (2000, 3)).astype(float), rng.integers(0, 3, (5, 3)).astype(float), rng.permutation(2000)
    largest = []

    def city(a, b):
        largest.append(len(b))
        return np.abs(a[:, None, :] - b[None, :, :]).sum(2)

    exact = city(q, t) if metric is None else neighbours.distances(q, t)
    largest.clear()
    found, dist = neighbours.block_top_k(q, t, ids, 7, city if metric is None else None)
    for r in range(5):
        want = np.lexsort((ids, exact[r].round(9)))[:7]
        assert found[r].tolist() == want.tolist() and np.allclose(dist[r], exact[r][want])
    assert max(largest, default=0) <= 512


def test_constant_columns_do_not_count(clusters):
    wider = clusters.select("id", "label", F.concat("features", F.array(F.lit(3.0))).alias("features"))
    for method in ({"method": "KNN", "n_neighbors": 3, "metric": "mahalanobis"}, {"method": "MEAN", "metric": "mahalanobis"}):
        arguments = {k: v for k, v in method.items() if k != "method"}
        found = [sorted(experiments.train_model(df, method["method"], **arguments).predict(df).select("id", "prediction").collect()) for df in (clusters, wider)]
        assert found[0] == found[1]


def test_custom_metric_and_vote(spark):
    rows = [(1, "b", [0.0, 1.0]), (2, "a", [1.0, 0.0]), (3, "c", [5.0, 5.0]), (4, "c", [6.0, 5.0])]
    train = spark.createDataFrame(rows, "id long, label string, features array<double>")
    test = spark.createDataFrame([(9, [0.0, 0.0]), (8, [5.5, 5.0])], "id long, features array<double>")
    city = lambda q, t: np.abs(q[:, None, :] - t[None, :, :]).sum(2)
    out = neighbours.knn_predict(train, test, 2, city, block_rows=1)
    assert {r["id"]: r["prediction"] for r in out.collect()} == {9: "a", 8: "c"}  # 9: tie, the smaller label
    with pytest.raises(ValueError):
        neighbours.knn_predict(train, test, 2, "hamming")


# -- classifiers


def test_centroids(clusters, points):
    x, y = points
    means = np.array([x[y == c].mean(0) for c in "abcd"])
    cov = np.cov(x, rowvar=False)
    inverse = np.linalg.inv(cov)
    direct = {
        "euclidean": [[np.linalg.norm(m - r) for m in means] for r in x],
        "cosine": [[METRICS["cosine"](m, r) for m in means] for r in x],
        "mahalanobis": [[(m - r) @ inverse @ (m - r) for m in means] for r in x],
    }
    for metric, d in direct.items():
        out = centroids.fit_centroids(clusters, metric, cov).predict(clusters).orderBy("id").collect()
        assert [r["prediction"] for r in out] == ["abcd"[i] for i in np.argmin(d, axis=1)]
    custom = centroids.fit_centroids(clusters, lambda block, mean: np.abs(block - mean).sum(1))
    assert score(custom, clusters) > 0.95


def test_gaussian_nb(clusters, points):
    x, y = points
    model = centroids.fit_gnb(clusters)
    assert np.allclose(model.means, [x[y == c].mean(0) for c in "abcd"])
    assert np.allclose(model.variances, [x[y == c].var(0) for c in "abcd"])
    assert np.allclose(model.priors, 0.25)
    cells = centroids.fit_gnb(clusters, prior="positive_cells")
    assert np.allclose(cells.priors, [(x[y == c] > 0).sum() / len(y) for c in "abcd"])
    assert score(model, clusters) > 0.95


def test_diagonal_mixture(clusters):
    model = mixture.fit_gmm_diag(clusters, n_components=2, max_iter=15)
    assert np.all(np.diff(model.history) >= -1e-9)  # the likelihood does not fall
    assert all(abs(sum(w for w, _, _ in parts) - 1) < 1e-9 for parts in model.parts.values())
    assert score(model, clusters) > 0.9
    assert accuracy(model.predict(clusters, score="mixture")).first()[0] > 0.9


def test_one_component_mixture_is_the_gaussian(clusters, points):
    x, y = points
    parts = mixture.fit_gmm_diag(clusters, n_components=1, max_iter=3).parts
    for c in "abcd":
        (weight, mean, var), = parts[c]
        assert weight == pytest.approx(1) and np.allclose(mean, x[y == c].mean(0)) and np.allclose(var, x[y == c].var(0) + 1e-6)


def test_full_mixture(clusters):
    assert score(mixture.fit_gmm_full(clusters, n_components=1, max_iter=10), clusters) > 0.95


def test_gmm_full_components_of_few_rows(spark):
    """Components with fewer rows than dimensions stay regular and are told apart."""
    rng = np.random.default_rng(5)
    centres = {("a", 0): 0.0, ("a", 1): 8.0, ("b", 0): 4.0, ("b", 1): 12.0}
    rows = [(label, (at + rng.normal(size=12)).tolist()) for (label, _), at in centres.items() for _ in range(9)]
    df = spark.createDataFrame(rows, "label string, features array<double>")
    model = mixture.fit_gmm_full(df, n_components=2, max_iter=10)
    assert sorted(round(m.mean() / 4) for p in model.parts.values() for _, m, _ in p) == [0, 1, 2, 3]
    assert all(np.isfinite(h).all() for p in model.parts.values() for _, _, h in p)
    assert np.all(np.diff(model.history) >= -1e-9)
    assert accuracy(model.predict(df, score="mixture")).first()[0] == 1.0


def test_registered_full_mixture_has_several_components():
    query = QUERIES["gmm_full"]
    assert query.__closure__[query.__code__.co_freevars.index("params")].cell_contents["n_components"] == 5


@pytest.mark.parametrize("kernel", ["rbf", "poly"])
def test_kernel_estimate_sharpens(kernel):
    rng = np.random.default_rng(1)
    x = rng.normal(0, 1, (30, 4))
    exact = np.exp(-0.1 * neighbours.squared_distances(x, x)) if kernel == "rbf" else (0.1 * x @ x.T) ** 3
    errors = []
    for n in (64, 16384):
        z = learners.KernelMap.draw(kernel, 4, 0.1, n)(x)
        errors.append(np.abs(z @ z.T - exact).mean())
    assert errors[1] < errors[0] / 4


def test_scale_gamma(clusters, points):
    assert learners.scale_gamma(clusters) == pytest.approx(1 / (6 * points[0].var()))


@pytest.mark.parametrize("kernel", ["linear", "rbf"])
def test_svm(clusters, kernel):
    model = learners.fit_svm(clusters, kernel=kernel, C=1.0, random_features=128, max_iter=15)
    assert len(model.pairs) == 6
    assert score(model, clusters) > 0.9


def test_planes_of_all_pairs_equal_single_fits(clusters):
    from pyspark.ml.classification import LinearSVC

    spread = clusters.select("id", "label", F.transform("features", lambda x: x / 4).alias("features"))
    rows = learners.kernel_rows(spread, "linear")
    fitted = learners.fit_all_planes(rows, [0.05, 1.0], max_iter=60)
    for model, C in zip(fitted, (0.05, 1.0)):
        for p, (a, b) in enumerate(model.pairs):
            names = [model.labels[a], model.labels[b]]
            own = rows.data.where(F.col("label").isin(names)).select("v", (F.col("label") == names[1]).cast("double").alias("y")).cache()
            x = np.array([r["v"].toArray() for r in own.collect()])
            sign = 2 * np.array([r["y"] for r in own.collect()]) - 1
            reg = 1 / (C * len(x))

            def loss(w, x=x, sign=sign, reg=reg):
                return np.maximum(0, 1 - sign * (x @ w[:-1] + w[-1])).mean() + reg / 2 * (w[:-1] ** 2).sum()

            if p == 0:
                single = LinearSVC(featuresCol="v", labelCol="y", regParam=reg, maxIter=40, standardization=False).fit(own)
                assert loss(model.planes[:, p]) <= loss(np.append(single.coefficients.toArray(), single.intercept)) * 1.001 + 1e-6
            assert all(loss(model.planes[:, p]) <= loss(model.planes[:, p] + e) + 1e-4 for e in 0.05 * np.vstack([np.eye(7), -np.eye(7)]))


def test_hinge_sums_in_two_levels(clusters):
    rows = learners.kernel_rows(clusters, "linear").data.select(F.lit(0).alias("y"), "v").unionAll(
        learners.kernel_rows(clusters.limit(50), "linear").data.select(F.lit(1), "v")).repartition(5)
    w = np.random.default_rng(0).normal(size=(7, 2)) / 9
    one, two = (learners.hinge_sums(rows, w, np.array([0, 0]), np.array([1, 2]), many) for many in (False, True))
    assert np.allclose(one, two) and one.shape == (8, 2)


def test_hinge_sums_of_packed_rows(clusters, monkeypatch):
    """Rows are stored as given, packed, and mapped as they are read."""
    monkeypatch.setattr(learners, "BLOCK_ROWS", 7)
    kernel = learners.kernel_rows(clusters, "rbf", random_features=16)
    rows = kernel.data.select((F.ascii("label") - 97).alias("y"), "v")
    assert len(rows.first()["v"]) == 6
    w = np.random.default_rng(0).normal(size=(17, 2)) / 9
    stored = learners.packed(rows, 6)
    assert dict(stored.dtypes) == {"y": "binary", "x": "binary"} and stored.count() >= 240 / 7
    one, two = (learners.hinge_sums(df, w, np.array([0, 0]), np.array([1, 2]), False, kernel.mapping, 6) for df in (rows, stored))
    found = rows.collect()
    x, y = kernel.mapping(np.array([r["v"].toArray() for r in found])), np.array([r["y"] for r in found])
    for k, other in enumerate((1, 2)):
        own = (y == 0) | (y == other)
        loss = 1 - np.where(y == other, 1, -1) * (x @ w[:-1, k] + w[-1, k])
        assert one[0, k] == pytest.approx(np.maximum(loss[own], 0).sum())
    assert np.allclose(one, two)


def test_forest_keeps_the_nodes_of_its_rows(clusters, monkeypatch):
    """Passes do not walk down all trees again, lineage is cut, and the trees are those of a fit that does."""
    fitted = []
    fit = learners._fit_ml
    monkeypatch.setattr(learners, "_fit_ml", lambda df, estimator, *rest: fitted.append(estimator) or fit(df, estimator, *rest))
    kept = learners.fit_forest(clusters, n_estimators=3).model
    assert fitted[0].getCacheNodeIds() and clusters.sparkSession.sparkContext.getCheckpointDir()
    plain = fit(clusters, fitted[0].copy().setCacheNodeIds(False), "features", "label").model
    assert [t.toDebugString.split("\n", 1)[1] for t in kept.trees] == [t.toDebugString.split("\n", 1)[1] for t in plain.trees]


def test_forest_and_network(clusters):
    forest = learners.fit_forest(clusters, n_estimators=10)
    assert score(forest, clusters) > 0.9
    again = learners.fit_forest(clusters, n_estimators=10)
    assert forest.predict(clusters).collect() == again.predict(clusters).collect()
    assert score(learners.fit_mlp(clusters, layers=(10, 5), max_iter=60), clusters) > 0.9


def test_unknown_names_and_missing_training(clusters):
    with pytest.raises(ValueError):
        experiments.train_model(clusters, "CNN3D")
    with pytest.raises(RuntimeError):
        experiments.evaluate_model(None, clusters)


# -- experiments


def test_grid_and_chart_rows(clusters):
    grid = [{"method": "MEAN", "metric": m} for m in ("euclidean", "cosine")] + [{"method": "KNN", "n_neighbors": 3, "metric": "euclidean"}]
    scores = experiments.parameter_grid(clusters.where("id % 3 <> 0"), clusters.where("id % 3 = 0"), grid).cache()
    assert [r["method"] for r in scores.orderBy("run_id").collect()] == ["MEAN", "MEAN", "KNN"]
    assert all(r["accuracy"] > 0.9 for r in scores.collect())
    texts = {r["label"] for r in score_labels(scores, ("method", "n_neighbors")).collect()}
    assert texts == {"metric=euclidean", "metric=cosine"}
    wide = score_series(scores.where("method = 'MEAN'"), "metric", F.col("method"), ["euclidean", "cosine"]).collect()
    assert len(wide) == 1 and wide[0]["euclidean"] > 0.9
    assert len(experiments.grids()["GMM"]) == 58 and len(experiments.grids()["SVM"]) == 9


def test_compare_models_and_single_run(spark):
    words = {"x": ["ALPHA", "BETA", "GAMMA"], "y": ["DELTA", "EPSILON", "BETA"]}
    rng = np.random.default_rng(5)
    rows = [(i, "xy"[i % 2], rng.choice(words["xy"[i % 2]], 6).tolist()) for i in range(60)]
    tokens = spark.createDataFrame(rows, "doc_id long, label string, tokens array<string>").coalesce(2)
    chain = {"n_dims": 10, "components": 3}
    models = [{"method": "NB"}, {"method": "MEAN", "metric": "mahalanobis"}, {"method": "KNN", "n_neighbors": 3}]
    scores = experiments.compare_models(tokens, 2, labels.hash_fold("doc_id", 2), models, **chain)
    means = {r["method"]: r["accuracy"] for r in experiments.fold_means(scores).collect()}
    assert set(means) == {"NB", "MEAN", "KNN"} and min(means.values()) > 0.8
    twice = [{"method": "MEAN", "metric": m} for m in ("euclidean", "cosine")]
    scores = experiments.compare_models(tokens, 2, labels.hash_fold("doc_id", 2), twice, **chain)
    assert scores.count() == 4 and experiments.fold_means(scores).count() == 2
    single = experiments.single_run(tokens.where("doc_id < 40"), tokens.where("doc_id >= 40"), {"method": "MEAN", "metric": "euclidean"},
                                    reduction="LDA", **chain)
    assert single > 0.8


def test_mixture_steps_read_blocks_of_bytes(spark):
    rows = spark.range(3000, numPartitions=1).select((F.col("id") % 3).cast("int").alias("label"), F.array(F.col("id") * 0.5, F.rand(1)).alias("x"))
    blocks = mixture._packed(rows, 2).collect()
    assert len(blocks) == 9 and max(len(b["x"]) for b in blocks) <= 1024 * 16  # three classes in three chunks
    stored = {(b["label"], v) for b in blocks for v in np.frombuffer(b["x"]).reshape(-1, 2)[:, 0].tolist()}
    assert stored == {(i % 3, i * 0.5) for i in range(3000)}


def test_kernel_features_by_array_operations(monkeypatch):
    """The cosines are those of NumPy to rounding, without its loop over cells, and nothing of the rows is overwritten."""
    rng = np.random.default_rng(3)
    z = np.concatenate([rng.normal(size=9000) * 30, np.arange(-40, 41) * np.pi / 4, [0.0, -0.0, 1e-300]])
    assert np.abs(learners.cosines(z.reshape(-1, 4).copy()) - np.cos(z.reshape(-1, 4))).max() < 5e-14
    assert np.isnan(learners.cosines(np.array([np.nan, np.inf]))).all() and learners.cosines(np.empty((0, 5))).shape == (0, 5)
    x, want = rng.normal(size=(50, 7)), {}
    for kernel in learners.KERNELS:
        mapping = learners.KernelMap.draw(kernel, 7, 0.3, 64)
        want = {"linear": lambda: x, "rbf": lambda: mapping.scale * np.cos(x @ mapping.weights[0] + mapping.offset),
                "poly": lambda: mapping.scale * np.prod([x @ s for s in mapping.weights], axis=0)}[kernel]()
        given = x.copy()
        with monkeypatch.context() as m:
            m.setattr(learners.np, "cos", None)
            found = mapping(given)
        assert np.allclose(found, want, rtol=1e-12, atol=1e-14) and np.array_equal(given, x)
