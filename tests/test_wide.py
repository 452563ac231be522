"""Leading axes by passes over the rows, against NumPy on whole matrices."""

import tracemalloc

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import SparseVector, Vectors, VectorUDT
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from themata.operators import reduce, wide

ROWS = StructType([StructField("id", LongType()), StructField("features", VectorUDT())])


def angles(a, b):
    """Sines of the principal angles between the spans of two orthonormal bases."""
    return np.linalg.svd(a - b @ (b.T @ a), compute_uv=False)


def sparse_rows(n, width, rng, topics=12):
    """Rows of a few stored cells each, by topic, as a matrix; some rows are empty."""
    x = np.zeros((n, width))
    favourite = rng.integers(0, width, (topics, 40))
    for i in range(n):
        if i % 50:
            own = np.concatenate([rng.choice(favourite[rng.integers(0, topics)], 25, replace=False), rng.integers(0, width, 6)])
            x[i, own] = rng.random(len(own)) + 0.5
    return x


def table(spark, x, as_dense=()):
    rows = []
    for i, row in enumerate(x):
        at = np.flatnonzero(row)
        rows.append((i, Vectors.dense(row) if i in as_dense else SparseVector(len(row), at.tolist(), row[at].tolist())))
    return spark.createDataFrame(rows, ROWS).repartition(3).cache()


def test_top_axes_of_a_matrix():
    rng = np.random.default_rng(0)
    for spectrum in (np.geomspace(1, 1e-6, 200), np.repeat([5.0, 2.0, 1.0], [3, 60, 137]), np.r_[np.ones(4), np.zeros(196)]):
        q = np.linalg.qr(rng.normal(size=(200, 200)))[0]
        a = (q * spectrum) @ q.T
        found = wide.top_axes(lambda w, a=a: a @ w, 200, 3)
        assert np.allclose(found.values, np.sort(spectrum)[::-1][:3], atol=1e-9)
        assert np.allclose(a @ found.vectors, found.vectors * found.values, atol=1e-8)
        assert np.allclose(found.vectors.T @ found.vectors, np.eye(3), atol=1e-12)


def test_stopping():
    a = np.diag(np.linspace(1, 0.99, 300))
    with pytest.raises(RuntimeError):
        wide.top_axes(lambda w: a @ w, 300, 5, max_passes=2)
    assert np.allclose(wide.top_axes(lambda w: np.zeros_like(w), 30, 4).values, 0)


@pytest.mark.parametrize("dense_width", [4096, 10])
def test_products_of_sparse_and_dense_rows(spark, dense_width, monkeypatch):
    monkeypatch.setattr(wide, "DENSE_WIDTH", dense_width)
    monkeypatch.setattr(wide, "CELLS", 100)
    rng = np.random.default_rng(1)
    x, block = sparse_rows(200, 130, rng), rng.normal(size=(130, 4))
    df = table(spark, x, as_dense=(3, 77))
    assert np.allclose(wide.gram_times(df, "features", block), x.T @ (x @ block))
    projected = reduce.Projection(block, x.mean(0), np.ones(4)).transform(df).orderBy("id").collect()
    assert np.allclose([r["features"] for r in projected], (x - x.mean(0)) @ block)
    assert np.allclose(wide.gram_times(df.limit(0), "features", block), 0)


@pytest.mark.parametrize("centred", [True, False])
def test_axes_of_3000_columns(spark, centred):
    x = sparse_rows(900, 3000, np.random.default_rng(2))
    found, mean, total = wide.covariance_axes(table(spark, x), 8, centred=centred, tol=1e-11)
    base = x - x.mean(0) if centred else x
    _, s, vt = np.linalg.svd(base, full_matrices=False)
    values = s**2 / 899 if centred else s**2
    assert np.allclose(found.values, values[:8], rtol=1e-9) and np.isclose(total, values.sum())
    assert angles(found.vectors, vt[:8].T).max() < 1e-6
    assert np.allclose(mean, x.mean(0) if centred else 0)


def test_wide_and_narrow_tables_agree(spark, monkeypatch):
    x = sparse_rows(300, 700, np.random.default_rng(3))
    df = table(spark, x)
    for fit in (reduce.fit_pca, reduce.fit_svd):
        narrow = fit(df, 6)
        with monkeypatch.context() as m:
            m.setattr(reduce, "MATRIX_WIDTH", 100)
            broad = fit(df, 6)
        assert np.allclose(np.abs(narrow.components), np.abs(broad.components), atol=1e-7)
        assert np.allclose(narrow.variances, broad.variances, rtol=1e-8) and np.allclose(narrow.mean, broad.mean)


def test_seventy_axes_of_100000_columns(spark):
    """Planted axes: rows are sums of 70 sparse directions with falling strength."""
    width, k = 100_000, 70
    rows = spark.range(600).select("id", F.transform(
        F.sequence(F.lit(0), F.lit(11)), lambda j: F.pmod(F.xxhash64("id", j), F.lit(k)).cast("int")).alias("topics"))
    cell = lambda t: F.transform(F.sequence(F.lit(0), F.lit(19)), lambda j: F.pmod(F.xxhash64(t, j, F.lit("c")), F.lit(width)).cast("int"))
    picked = rows.select("id", F.array_sort(F.array_distinct(F.flatten(F.transform("topics", cell)))).alias("at"))
    drawn = picked.collect()
    df = spark.createDataFrame([(r["id"], SparseVector(width, r["at"], [1.0] * len(r["at"]))) for r in drawn], ROWS).repartition(4).cache()
    found, mean, _ = wide.covariance_axes(df, k, tol=1e-9)
    assert found.vectors.shape == (width, k)
    used = np.unique(np.concatenate([r["at"] for r in drawn]))  # the other columns are zero
    x = np.zeros((600, len(used)))
    for i, r in enumerate(drawn):
        x[i, np.searchsorted(used, r["at"])] = 1.0
    _, s, vt = np.linalg.svd(x - x.mean(0), full_matrices=False)
    assert np.allclose(found.values, s[:k] ** 2 / 599, rtol=1e-7)
    assert angles(found.vectors[used], vt[:k].T).max() < 1e-5


def test_list_columns(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(80, 20)) * np.linspace(3, 1, 20)
    df = spark.createDataFrame([(i, row.tolist()) for i, row in enumerate(x)], "id long, features array<double>")
    found, _, _ = wide.covariance_axes(df.select("id", array_to_vector("features").alias("features")), 4)
    assert np.allclose(np.abs(found.vectors), np.abs(reduce.fit_pca(df, 4).components), atol=1e-6)


def test_packed_products_shuffle_once_however_many_files(spark, monkeypatch):
    """Frequent columns are multiplied as a matrix; tasks, and what they shuffle, do not follow the files."""
    monkeypatch.setattr(wide, "DENSE_WIDTH", 10)
    monkeypatch.setattr(wide, "CELLS", 100)
    rng = np.random.default_rng(5)
    x, w = sparse_rows(300, 130, rng), rng.normal(size=(130, 4))
    df = table(spark, x, as_dense=(3, 77)).repartition(50)
    for hot in (np.arange(0), np.array([3, 17, 64]), np.arange(130)):
        rows = wide.packed(df, "features", hot, 130)
        assert np.allclose(wide.packed_times(rows, hot, w, 3), x.T @ (x @ w))
    seen = []
    real = wide.packed_times
    monkeypatch.setattr(wide, "packed_times", lambda rows, hot, w, tasks: seen.append((rows, len(hot), tasks)) or real(rows, hot, w, tasks))
    monkeypatch.setattr(wide, "HOT_COLUMNS", 20)
    wide.covariance_axes(df, 3)
    rows, n_hot, tasks = seen[0]
    assert n_hot == 20 and rows.coalesce(tasks).rdd.getNumPartitions() <= spark.sparkContext.defaultParallelism
    assert len({r.semanticHash() for r, _, _ in seen}) == 1  # stored once, read in each pass


def test_axes_take_little_memory_of_the_driver():
    """A few blocks are held, however many passes there are."""
    width, k = 40_000, 50
    block = 8 * width * (k + wide.EXTRA)
    spectrum = (np.arange(1, width + 1.0) ** -0.5)[:, None]
    tracemalloc.start()
    found = wide.lean_axes(lambda w: spectrum * w, width, k, 1e-7)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found.passes > 3 and most < 7 * block
    assert np.allclose(found.values, spectrum[:k, 0], rtol=1e-9)
    assert np.allclose(found.vectors.T @ found.vectors, np.eye(k), atol=1e-12)


def test_restarts_lose_nothing():
    rng = np.random.default_rng(6)
    q = np.linalg.qr(rng.normal(size=(900, 900)))[0]
    a = (q * np.arange(1, 901.0) ** -0.3) @ q.T
    found = wide.lean_axes(lambda w: a @ w, 900, 12)
    assert found.passes > 6 and np.allclose(found.values, np.arange(1, 13.0) ** -0.3, rtol=1e-10)
    assert np.allclose(a @ found.vectors, found.vectors * found.values, atol=2e-9)


def test_lean_axes_equal_those_with_images():
    rng = np.random.default_rng(8)
    for spectrum in (np.geomspace(1, 1e-6, 200), np.repeat([5.0, 2.0, 1.0], [3, 60, 137]), np.r_[np.ones(4), np.zeros(196)], np.zeros(200)):
        q = np.linalg.qr(rng.normal(size=(200, 200)))[0]
        a = (q * spectrum) @ q.T
        one, two = wide.top_axes(lambda w, a=a: a @ w, 200, 3), wide.lean_axes(lambda w, a=a: a @ w, 200, 3)
        assert np.allclose(one.values, two.values, atol=1e-9) and np.allclose(a @ two.vectors, two.vectors * two.values, atol=1e-8)
        assert np.allclose(two.vectors.T @ two.vectors, np.eye(3), atol=1e-12)
    a = np.diag(np.linspace(1, 0.99, 300))
    with pytest.raises(RuntimeError):
        wide.lean_axes(lambda w: a @ w, 300, 5, max_passes=2)
    assert np.allclose(wide.lean_axes(lambda w: a @ w, 300, 300).values, np.sort(np.diag(a))[::-1])
