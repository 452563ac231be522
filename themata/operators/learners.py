"""Classifiers built on ``pyspark.ml``: one-vs-one support vectors, forest, dense network."""

from __future__ import annotations

import math
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.classification import MultilayerPerceptronClassifier, RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, functions as F

from themata.cluster import materialise, shared_folder
from themata.functions.blocks import CHUNK_ROWS, as_array, as_vector, best_class, matrix, width_of
from themata.operators.centroids import features_of
from themata.operators.labels import fit_labels, label_names
from themata.operators.network import GROUPS, added

KERNELS = ("linear", "rbf", "poly")

#: Rows of a stored block, and its type: class numbers and cells as bytes, which tasks read without unpacking lists.
BLOCK_ROWS = 256
BLOCKS = "y binary, x binary"

#: Stored files from which the sums of tasks are added up in groups before they reach the driver.
FEW_FILES = 64


@dataclass
class KernelMap:
    """Random features whose inner product approximates a kernel. ``linear`` is the identity."""

    kernel: str
    weights: list
    offset: np.ndarray | None = None
    scale: float = 1.0

    @classmethod
    def draw(cls, kernel: str, width: int, gamma: float, features: int = 512, degree: int = 3, seed: int = 0):
        rng = np.random.default_rng(seed)
        if kernel == "linear":
            return cls(kernel, [])
        if kernel == "rbf":  # random Fourier features (Rahimi & Recht 2007)
            w = rng.normal(0.0, np.sqrt(2 * gamma), (width, features))
            return cls(kernel, [w], rng.uniform(0, 2 * np.pi, features), np.sqrt(2.0 / features))
        # random Maclaurin features (Kar & Karnick 2012) of (gamma x.y)^degree
        signs = [rng.choice([-1.0, 1.0], (width, features)) for _ in range(degree)]
        return cls(kernel, signs, None, np.sqrt(gamma**degree / features))

    def __call__(self, x: np.ndarray) -> np.ndarray:
        if self.kernel == "linear":
            return x
        out = x @ self.weights[0]
        if self.kernel == "rbf":
            out += self.offset
            out = cosines(out)
        for signs in self.weights[1:]:
            out *= x @ signs
        out *= self.scale
        return out


#: Cells whose cosines are taken at once, so that they and what lies between stay in the cache; coefficients of sin(r) / r.
COS_CELLS = 4096
SINE = [(-1) ** i / math.factorial(2 * i + 1) for i in range(11)]


def cosines(z: np.ndarray) -> np.ndarray:
    """``np.cos`` of moderate angles, to rounding, in place: 1 - 2 sin(z / 2)^2 by the series of the sine, as array operations."""
    flat = z.reshape(-1)
    whole, square = np.empty(COS_CELLS), np.empty(COS_CELLS)
    for i in range(0, len(flat), COS_CELLS):
        r = flat[i : i + COS_CELLS]
        n, q = whole[: len(r)], square[: len(r)]
        r *= 0.5 / np.pi
        np.rint(r, out=n)
        r -= n
        r *= np.pi  # half the angle, within a quarter turn
        np.multiply(r, r, out=q)
        np.multiply(q, SINE[-1], out=n)
        for c in SINE[-2:0:-1]:
            n += c
            n *= q
        n += SINE[0]
        r *= n
        r *= r
        r *= -2.0
        r += 1.0
    return flat.reshape(z.shape)


def scale_gamma(df: DataFrame, column: str = "features") -> float:
    """1 / (width * variance of all cells)."""
    cells = as_array(df, column)
    add = lambda f: F.aggregate(cells, F.lit(0.0), lambda a, x: a + f(x))
    row = df.agg(F.sum(F.size(cells)).alias("n"), F.sum(add(lambda x: x)).alias("s"),
                 F.sum(add(lambda x: x * x)).alias("q"), F.max(F.size(cells)).alias("d")).first()
    variance = row["q"] / row["n"] - (row["s"] / row["n"]) ** 2
    return 1.0 / (row["d"] * variance) if variance > 0 else 1.0


@dataclass
class SVMModel:
    labels: list
    pairs: list
    planes: np.ndarray
    kernel: KernelMap
    width: int

    def predict(self, df: DataFrame, column: str = "features") -> DataFrame:
        """Add ``prediction``: one vote per pair of classes, the smaller label on a tie. Narrow: all
        pairs are one block product."""
        planes, pairs, kernel, classes = self.planes, self.pairs, self.kernel, len(self.labels)

        def votes(x: np.ndarray) -> np.ndarray:
            margin = kernel(x) @ planes[:-1] + planes[-1]
            out = np.zeros((len(x), classes))
            for p, (a, b) in enumerate(pairs):
                second = margin[:, p] > 0
                out[second, b] += 1
                out[~second, a] += 1
            return out

        return df.withColumn("prediction", best_class(features_of(df, column), self.width, votes, self.labels))


@dataclass
class KernelRows:
    """Stored rows ``(label, v)`` as given, which tasks map to a kernel's features, far longer than they are, as they
    read them; with the rows of each class."""

    data: DataFrame
    sizes: dict
    mapping: KernelMap
    width: int


def kernel_rows(
    df: DataFrame, kernel: str = "rbf", gamma="scale", degree: int = 3, random_features: int = 512, seed: int = 0,
    column: str = "features", label: str = "label",
) -> KernelRows:
    if kernel not in KERNELS:
        raise ValueError(f"no such kernel: {kernel}")
    width = width_of(df, column)
    g = scale_gamma(df, column) if gamma == "scale" and kernel != "linear" else (1.0 if gamma == "scale" else gamma)
    mapping = KernelMap.draw(kernel, width, g, random_features, degree, seed)
    data = materialise(df.select(F.col(label).alias("label"), array_to_vector(features_of(df, column)).alias("v")))
    sizes = {r["label"]: r["count"] for r in data.groupBy("label").count().collect()}
    return KernelRows(data, sizes, mapping, width)


def fit_planes(rows: KernelRows, C: float = 1.0, max_iter: int = 100) -> SVMModel:
    """One linear machine per pair of classes."""
    return fit_all_planes(rows, [C], max_iter)[0]


def fit_all_planes(rows: KernelRows, penalties: list[float], max_iter: int = 100, tol: float = 1e-6) -> list[SVMModel]:
    """For each penalty one linear machine per pair of classes: mean hinge loss plus |w|^2 / (2 C n).

    All machines improve together: a round is one job, in which tasks add up loss and subgradient of every machine at
    its own next point, so the number of jobs depends neither on the classes nor on the penalties.
    """
    labels = sorted(rows.sizes)
    pairs = list(combinations(range(len(labels)), 2))
    wanted = [(C, a, b) for C in penalties for a, b in pairs]
    counts = np.array([rows.sizes[labels[a]] + rows.sizes[labels[b]] for _, a, b in wanted], float)
    strength = 1.0 / (np.array([C for C, _, _ in wanted]) * counts)
    first, second = np.array([a for _, a, _ in wanted]), np.array([b for _, _, b in wanted])
    code = F.element_at(F.create_map(*[F.lit(x) for i, name in enumerate(labels) for x in (name, i)]), F.col("label"))
    given = materialise(packed(rows.data.select(F.coalesce(code.cast("int"), F.lit(-1)).alias("y"), "v"), rows.width))
    many = len(given.inputFiles()) > FEW_FILES

    searches = [lbfgs(np.zeros(_length(rows) + 1), max_iter, tol) for _ in wanted]
    points = {i: next(search) for i, search in enumerate(searches)}
    planes: list = [None] * len(wanted)
    while points:
        active = sorted(points)
        w = np.stack([points[i] for i in active], axis=1)
        sums = hinge_sums(given, w, first[active], second[active], many, rows.mapping, rows.width)
        for k, i in enumerate(active):
            value = sums[0, k] / counts[i] + strength[i] / 2 * (w[:-1, k] ** 2).sum()
            gradient = sums[1:, k] / counts[i] + strength[i] * np.append(w[:-1, k], 0.0)
            try:
                points[i] = searches[i].send((value, gradient))
            except StopIteration as done:
                planes[i] = done.value
                del points[i]
    n = len(pairs)
    return [SVMModel(labels, pairs, np.array(planes[k * n : (k + 1) * n]).T, rows.mapping, rows.width) for k in range(len(penalties))]


def _length(rows: KernelRows) -> int:
    return len(rows.mapping(np.zeros((1, rows.width)))[0])


def packed(rows: DataFrame, width: int) -> DataFrame:
    """Rows ``(y, v)`` in blocks of at most ``BLOCK_ROWS``; a pass over them costs little but the products."""

    def pack(batches):
        for batch in batches:
            for begin in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(begin, BLOCK_ROWS)
                y, x = part.column(0).to_numpy(zero_copy_only=False).astype(np.int32), matrix(part.column(1), width)
                yield pa.RecordBatch.from_arrays([pa.array([y.tobytes()], pa.binary()), pa.array([x.tobytes()], pa.binary())], ["y", "x"])

    return rows.mapInArrow(pack, BLOCKS)


def _blocks(batch: pa.RecordBatch, width: int):
    """Class numbers and cells of a bounded number of rows of ``(y, v)``, packed or not."""
    if pa.types.is_binary(batch.schema.field(0).type):
        for y, x in zip(batch.column(0), batch.column(1)):
            yield np.frombuffer(y.as_buffer(), np.int32), np.frombuffer(x.as_buffer()).reshape(-1, width)
        return
    for begin in range(0, batch.num_rows, CHUNK_ROWS):
        part = batch.slice(begin, CHUNK_ROWS)
        yield part.column(0).to_numpy(zero_copy_only=False), matrix(part.column(1), width)


def hinge_sums(rows: DataFrame, planes: np.ndarray, first: np.ndarray, second: np.ndarray, many: bool = False,
               mapping: KernelMap | None = None, width: int | None = None) -> np.ndarray:
    """Per machine the sum of the hinge losses and of their subgradients over rows ``(y, v)``, packed or
    not; a machine, a column of ``planes`` with the offset last, tells class ``second`` from ``first``. ``v`` has
    ``width`` cells, of which ``mapping`` makes those of a machine."""
    width = width or len(planes) - 1

    def partial(batches):
        total = np.zeros((len(planes) + 1, planes.shape[1]))
        seen = False
        for batch in batches:
            for y, x in _blocks(batch, width):
                y, x = y[:, None], x if mapping is None else mapping(x)
                sign = (y == second).astype(float) - (y == first)
                loss = np.where(sign != 0, 1.0 - sign * (x @ planes[:-1] + planes[-1]), 0.0)
                pull = np.where(loss > 0, -sign, 0.0)
                total[0] += np.maximum(loss, 0.0).sum(0)
                total[1:-1] += x.T @ pull
                total[-1] += pull.sum(0)
                seen = True
        if seen:
            group = TaskContext.get().partitionId() % GROUPS
            yield pa.RecordBatch.from_arrays([pa.array([group], pa.int32()), pa.array([total.tobytes()], pa.binary())], ["part", "sums"])

    parts = rows.mapInArrow(partial, "part int, sums binary")
    if many:
        parts = parts.groupBy("part").applyInArrow(added, "part int, sums binary")
    return sum(np.frombuffer(r["sums"]) for r in parts.collect()).reshape(len(planes) + 1, -1)  # a row a task, or GROUPS of them


def lbfgs(start: np.ndarray, max_iter: int = 100, tol: float = 1e-6, memory: int = 10):
    """Limited-memory quasi-Newton steps as a coroutine: yields a point, is sent value and gradient there, returns the
    last point. The line search asks for the weak Wolfe conditions, which kinks allow (Lewis & Overton 2013)."""
    x = start
    f, g = yield x
    history: list[tuple[np.ndarray, np.ndarray]] = []
    still = 0
    for _ in range(max_iter):
        d, taken = -g, []
        for s, y in reversed(history):
            taken.append((s @ d) / (s @ y))
            d = d - taken[-1] * y
        d = d * ((history[-1][0] @ history[-1][1]) / (history[-1][1] @ history[-1][1]) if history else 1.0 / max(np.linalg.norm(g), 1e-12))
        for (s, y), a in zip(history, reversed(taken)):
            d = d + s * (a - (y @ d) / (s @ y))
        slope = g @ d
        if slope >= 0:
            if not history:
                break
            history = []
            continue
        low, high, step = 0.0, np.inf, 1.0
        for _ in range(30):
            value, gradient = yield x + step * d
            if value > f + 1e-4 * step * slope:
                high = step
            elif gradient @ d < 0.9 * slope:
                low = step
            else:
                break
            step = (low + high) / 2 if np.isfinite(high) else 2 * step
        if value >= f:
            if not history:
                break
            history = []  # start anew from the steepest descent before giving up
            still += 1
            if still > 3:
                break
            continue
        s, y = step * d, gradient - g
        if s @ y > 1e-12 * (s @ s):
            history = [*history[1 - memory :], (s, y)]
        still = still + 1 if f - value <= tol * max(abs(f), 1e-12) else 0
        x, f, g = x + s, value, gradient
        if still > 3:
            break
    return x


def fit_svm(
    df: DataFrame, kernel: str = "rbf", C: float = 1.0, gamma="scale", degree: int = 3, random_features: int = 512,
    max_iter: int = 100, seed: int = 0, column: str = "features", label: str = "label",
) -> SVMModel:
    """One linear machine per pair of classes, on kernel features. The kernels are approximate by
    design: an exact solver needs all rows in one place."""
    return fit_planes(kernel_rows(df, kernel, gamma, degree, random_features, seed, column, label), C, max_iter)


@dataclass
class MLModel:
    """A ``pyspark.ml`` classifier with its label codes."""

    model: object
    names: list

    def predict(self, df: DataFrame, column: str = "features") -> DataFrame:
        scored = self.model.transform(df.withColumn("__v", as_vector(df, column)))
        names = F.array(*[F.lit(n) for n in self.names])
        picked = F.get(names, F.col("__p").cast("int"))
        return scored.select(*df.columns, picked.alias("prediction"))


    def prefix_predictions(self, df: DataFrame, sizes: list[int], column: str = "features") -> DataFrame:
        """Add ``predictions``: what the first ``n`` trees of a forest predict, for each of ``sizes``. Narrow: every tree
        gives its class shares once."""
        trees = self.model.trees[: max(sizes)]
        scored = df.withColumn("__v", as_vector(df, column))
        for i, tree in enumerate(trees):
            tree = tree.copy().setRawPredictionCol("").setPredictionCol("").setProbabilityCol(f"__t{i}").setFeaturesCol("__v")
            scored = tree.transform(scored)
        shares = F.flatten(F.array(*[vector_to_array(f"__t{i}") for i in range(len(trees))]))
        classes, count = len(self.names), len(trees)

        @F.arrow_udf("array<int>")
        def first(values: pa.Array) -> pa.Array:
            votes = np.cumsum(values.flatten().to_numpy(zero_copy_only=False).reshape(len(values), count, classes), axis=1)
            return pa.array(list(votes[:, [n - 1 for n in sizes]].argmax(2)), pa.list_(pa.int32()))

        names = F.array(*[F.lit(n) for n in self.names])
        picked = F.transform(first(shares), lambda code: F.get(names, code))
        return scored.select(*df.columns, picked.alias("predictions"))


def _fit_ml(df: DataFrame, estimator, column: str, label: str) -> MLModel:
    numeric = dict(df.dtypes)[label] != "string"
    encoder = fit_labels(df.select(F.col(label).cast("string").alias("label")))
    names = label_names(encoder)
    data = df.select(F.col(label).cast("string").alias("label"), as_vector(df, column).alias("__v"))
    coded = encoder.transform(data).select("label_idx", "__v")
    kind = df.schema[label].dataType
    values = [r[0] for r in df.sparkSession.createDataFrame([(n,) for n in names], "n string")
              .select(F.col("n").cast(kind)).collect()] if numeric else names
    return MLModel(estimator.fit(coded), values)


def fit_forest(df: DataFrame, n_estimators: int = 35, max_depth: int = 30, seed: int = 0, column="features", label="label") -> MLModel:
    """Random forest. Trees grow to ``max_depth`` levels; 30 is the most that Spark allows.

    The node that each row has reached is kept from pass to pass: otherwise every pass sends the trees so far, which grow
    with the rows, to all tasks and walks down them again. The trees are the same either way.
    """
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(shared_folder(df.sparkSession))  # else the lineage of the kept nodes grows with every pass
    forest = RandomForestClassifier(numTrees=n_estimators, seed=seed, featuresCol="__v", labelCol="label_idx",
                                    predictionCol="__p", maxDepth=max_depth, cacheNodeIds=True)
    return _fit_ml(df, forest, column, label)


def fit_mlp(
    df: DataFrame, layers: tuple = (50, 20, 30), max_iter: int = 100, seed: int = 0, column="features", label="label"
) -> MLModel:
    """Dense network with softmax output and cross-entropy loss. Spark's hidden units are sigmoid and
    its solver is L-BFGS."""
    classes = df.select(label).distinct().count()
    sizes = [width_of(df, column), *layers, classes]
    network = MultilayerPerceptronClassifier(layers=sizes, maxIter=max_iter, seed=seed, featuresCol="__v",
                                             labelCol="label_idx", predictionCol="__p")
    return _fit_ml(df, network, column, label)
