"""Dense networks trained by mini-batch Adam, data-parallel.

The rows are numbered once in a seeded random order and stored by batch. A step reads one batch: the parameters go to
its tasks, each task adds up loss and gradients of its rows over bounded blocks and returns them once, and the sums,
in two levels where a batch has many tasks, update the parameters on the driver. So a step moves parameters only, and
the result does not depend on how a batch is cut into tasks, but for rounding. Epochs visit the batches in a new
seeded order; which rows share a batch stays.

Small batches are kept as an RDD. Each of their steps needs the parameters of the one before, and is over sooner than a job
begins: so once an epoch they are dealt into runs, in the order of their steps, and a task takes all steps of a run. A run is
bounded (``RUN_BYTES``), whatever the number of rows; between runs the state of the optimiser travels.

Networks that differ in their learning rate only are trained together: a step reads its batch once for all of them.

With labels as the target, the Kullback-Leibler divergence is the cross entropy.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel, TaskContext
from pyspark.sql import DataFrame, functions as F

from themata.cluster import shared_folder, with_dense_id
from themata.functions.blocks import CHUNK_ROWS, as_array, best_class, matrix, width_of
from themata.operators.centroids import features_of

#: Batches are stored in chunks of at least so many rows, so that small ones do not make small files.
STORED_ROWS = 4096

#: Bytes of the rows whose steps a task takes, one after the other.
RUN_BYTES = 32 << 20

#: Rows of a batch from which the sums of its tasks are added up in groups first, and the number of groups.
TWO_LEVEL_ROWS = 1 << 20
GROUPS = 64

#: Hidden layers (fixed values).
LAYERS = ((50, "relu"), (20, "relu"), (30, "relu"))

#: Constants of the optimiser (fixed values).
BETA_1, BETA_2, EPSILON = 0.9, 0.999, 1e-7

#: Moments below this move nothing. They are set to zero now and then: where units have died they would halve on and on
#: into numbers so small that CPUs take many times as long over them.
TINY, TINY_STEPS = 1e-290, 64

#: Activations and their derivatives by the output.
ACTIVATIONS = {
    "relu": (lambda z: np.maximum(z, 0.0), lambda a: (a > 0).astype(float)),
    "sigmoid": (lambda z: 0.5 * (1.0 + np.tanh(0.5 * z)), lambda a: a * (1.0 - a)),
    "tanh": (np.tanh, lambda a: 1.0 - a * a),
    "linear": (lambda z: z, np.ones_like),
}


@dataclass
class Shape:
    """Units of all layers, from the columns to the classes, and the activations of the hidden ones."""

    units: list[int]
    activations: list[str]

    @property
    def size(self) -> int:
        return sum((a + 1) * b for a, b in zip(self.units, self.units[1:]))

    def split(self, flat: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Weights and offsets of each layer as views of one flat array, or of several stacked."""
        out, at, many = [], 0, flat.shape[:-1]
        for a, b in zip(self.units, self.units[1:]):
            out.append((flat[..., at : at + a * b].reshape(*many, a, b), flat[..., None, at + a * b : at + a * b + b]))
            at += (a + 1) * b
        return out

    def initial(self, seed: int) -> np.ndarray:
        """Uniform weights within sqrt(6 / (inputs + outputs)), offsets of zero."""
        rng, flat = np.random.default_rng(seed), np.zeros(self.size)
        for weights, _ in self.split(flat):
            limit = np.sqrt(6.0 / sum(weights.shape))
            weights[:] = rng.uniform(-limit, limit, weights.shape)
        return flat

    def outputs(self, flat: np.ndarray, x: np.ndarray) -> list[np.ndarray]:
        """What each layer puts out; the last are log probabilities."""
        out = [x]
        layers = self.split(flat)
        for (w, b), name in zip(layers, self.activations):
            out.append(ACTIVATIONS[name][0](out[-1] @ w + b))
        z = out[-1] @ layers[-1][0] + layers[-1][1]
        z = z - z.max(-1, keepdims=True)
        return [*out, z - np.log(np.exp(z).sum(-1, keepdims=True))]

    def gradient(self, flat: np.ndarray, x: np.ndarray, y: np.ndarray) -> tuple[float | np.ndarray, np.ndarray]:
        """Sums of the loss and of its gradient over the rows; ``y`` holds class numbers. ``flat`` may be several networks,
        stacked, and so are the results then."""
        out = self.outputs(flat, x)
        rows = np.arange(len(y))
        loss = -out[-1][..., rows, y].sum(-1)
        back = np.exp(out[-1])
        back[..., rows, y] -= 1.0
        total = np.empty(flat.shape)
        slots = self.split(total)
        for i, (w, _) in reversed(list(enumerate(self.split(flat)))):
            dw, db = slots[i]
            dw[:], db[:] = out[i].swapaxes(-1, -2) @ back, back.sum(-2, keepdims=True)
            if i:
                back = (back @ w.swapaxes(-1, -2)) * ACTIVATIONS[self.activations[i - 1]][1](out[i])
        return loss, total


@dataclass
class Adam:
    """Adaptive moments (Kingma & Ba 2015) of one network, or of several stacked with a column of rates."""

    parameters: np.ndarray
    learning_rate: float | np.ndarray = 0.001
    steps: int = 0
    first: np.ndarray = field(default=None)
    second: np.ndarray = field(default=None)

    def step(self, gradient: np.ndarray) -> None:
        if self.first is None:
            self.first, self.second = np.zeros_like(gradient), np.zeros_like(gradient)
        self.steps += 1
        self.first = BETA_1 * self.first
        self.first += (1 - BETA_1) * gradient
        self.second = BETA_2 * self.second
        self.second += (1 - BETA_2) * gradient**2
        rate = self.learning_rate * np.sqrt(1 - BETA_2**self.steps) / (1 - BETA_1**self.steps)
        move, below = rate * self.first, np.sqrt(self.second)
        below += EPSILON
        move /= below
        self.parameters = self.parameters - move
        if self.steps % TINY_STEPS == 0:
            self.first[np.abs(self.first) < TINY] = 0.0
            self.second[self.second < TINY] = 0.0


@dataclass
class NetworkModel:
    """``history`` holds the mean loss of each epoch, taken before each step."""

    shape: Shape
    parameters: np.ndarray
    labels: list
    history: list[float]

    def predict(self, df: DataFrame, column: str = "features") -> DataFrame:
        """Add ``prediction``: the most probable label, the smaller one on a tie. Narrow."""
        shape, flat = self.shape, self.parameters
        picked = best_class(features_of(df, column), shape.units[0], lambda x: shape.outputs(flat, x)[-1], self.labels)
        return df.withColumn("prediction", picked)


@dataclass
class Batches:
    """Rows ``(batch, y, x)`` stored by batch; ``rows`` counts them."""

    spark: object
    path: str
    rows: int
    batch_size: int
    together: int  # batches in a stored chunk

    @property
    def count(self) -> int:
        return -(-self.rows // self.batch_size)

    def read(self, number: int) -> DataFrame:
        chunk = self.spark.read.schema("batch long, y int, x array<double>").parquet(f"{self.path}/chunk={number // self.together}")
        return chunk.where(F.col("batch") == number).select("y", "x")

    @property
    def chunks(self) -> int:
        return -(-self.count // self.together)

    def kept(self, width: int) -> RDD:
        """``(batch, (y, x))`` as arrays, one element a batch of at most ``STORED_ROWS`` rows, partitioned by chunk; in
        memory or, beyond it, on disk."""

        def pack(key: tuple, table: pa.Table) -> pa.Table:
            y, x = table["y"].to_numpy().astype(np.int32), matrix(pa.concat_arrays(table["x"].chunks), width)
            return pa.table({"batch": pa.array([key[0].as_py()], pa.int64()), "y": pa.array([y.tobytes()], pa.binary()), "x": pa.array([x.tobytes()], pa.binary())})

        stored = self.spark.read.schema("batch long, y int, x array<double>").parquet(self.path)
        packed = stored.groupBy("batch").applyInArrow(pack, "batch long, y binary, x binary")
        together = self.together
        pairs = packed.rdd.map(lambda r: (r["batch"], (np.frombuffer(r["y"], np.int32), np.frombuffer(r["x"]).reshape(-1, width))))
        return pairs.partitionBy(max(1, self.chunks), lambda batch: batch // together).persist(StorageLevel.MEMORY_AND_DISK)


def numbered(df: DataFrame, labels: list, seed: int = 0, key: str = "id", column: str = "features", label: str = "label") -> DataFrame:
    """Rows ``(place, y, x)`` in the order of a seeded hash of their unique ``key``. Rows with a null label are left out."""
    number = F.create_map(*[F.lit(v) for i, name in enumerate(labels) for v in (name, i)])
    rows = df.where(F.col(label).isNotNull()).select(
        F.xxhash64(F.lit(seed), key).alias("hash"), F.col(key).alias("key"), F.element_at(number, F.col(label)).cast("int").alias("y"), as_array(df, column).alias("x")
    )
    return with_dense_id(rows, ["hash", "key"], "place").select("place", "y", "x")


def deal_batches(df: DataFrame, labels: list, batch_size: int, seed: int = 0, key: str = "id", column: str = "features", label: str = "label", places: DataFrame | None = None) -> Batches:
    """The rows of ``df`` in batches of ``batch_size`` (the last may be smaller), in the order of ``numbered``; ``places``
    is what that gave, if it is at hand."""
    placed = places if places is not None else numbered(df, labels, seed, key, column, label)
    together = max(1, STORED_ROWS // batch_size)
    batch = F.floor(F.col("place") / batch_size)
    path = f"{shared_folder(df.sparkSession)}/themata/{uuid.uuid4().hex}"
    dealt = placed.select(batch.alias("batch"), "y", "x", F.floor(batch / together).alias("chunk"), F.floor(F.col("place") / TWO_LEVEL_ROWS).alias("part"))
    dealt.repartition("chunk", "part").drop("part").write.partitionBy("chunk").parquet(path)
    return Batches(df.sparkSession, path, placed.count(), batch_size, together)


def _gradients(shape: Shape, networks: list[np.ndarray]):
    """Function over Arrow batches ``(y, x)``: one row a task with the number of rows, the losses and the gradients."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 + len(networks) * (1 + shape.size))
        for batch in batches:
            for begin in range(0, batch.num_rows, CHUNK_ROWS):
                part = batch.slice(begin, CHUNK_ROWS)
                y, x = part.column(0).to_numpy(zero_copy_only=False), matrix(part.column(1), shape.units[0])
                found = [shape.gradient(flat, x, y) for flat in networks]
                total += np.concatenate([[len(y)], [loss for loss, _ in found], *[g for _, g in found]])
        if total[0]:
            group = TaskContext.get().partitionId() % GROUPS
            yield pa.RecordBatch.from_arrays([pa.array([group], pa.int32()), pa.array([total.tobytes()], pa.binary())], ["part", "sums"])

    return partial


def added(table: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(s) for s in table["sums"].to_pylist())
    return pa.table({"part": table["part"].slice(0, 1), "sums": pa.array([total.tobytes()], pa.binary())})


def batch_gradients(batch: DataFrame, shape: Shape, networks: list[np.ndarray], many: bool = False) -> tuple[np.ndarray, list[np.ndarray]]:
    """Mean loss and mean gradient of every network over the rows ``(y, x)`` of a batch."""
    parts = batch.mapInArrow(_gradients(shape, networks), "part int, sums binary")
    if many:
        parts = parts.groupBy("part").applyInArrow(added, "part int, sums binary")
    total = sum(np.frombuffer(r["sums"]) for r in parts.collect())  # one row a task, or GROUPS of them
    n = len(networks)
    return total[1 : 1 + n] / total[0], list(total[1 + n :].reshape(n, -1) / total[0])


def small_batch_gradients(kept: RDD, number: int, together: int, shape: Shape, networks: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray]]:
    """The same over batch ``number`` of ``kept``: one task, which returns the sums."""

    def partial(pairs: Iterator) -> list:
        out = []
        for batch, (y, x) in pairs:  # to the end, or the Python worker could not serve the next step
            if batch == number:
                parts = [(y[i : i + CHUNK_ROWS], x[i : i + CHUNK_ROWS]) for i in range(0, len(y), CHUNK_ROWS)]
                found = [[shape.gradient(flat, b, a) for a, b in parts] for flat in networks]
                out.append((len(y), [sum(loss for loss, _ in own) for own in found], [sum(g for _, g in own) for own in found]))
        return out

    ((rows, losses, gradients),) = kept.context.runJob(kept, partial, [number // together])
    return np.array(losses) / rows, [g / rows for g in gradients]


def in_runs(kept: RDD, order: list[int], run: int) -> RDD:
    """``(step, (y, x))`` of ``kept`` for the order of an epoch, ``run`` steps in a partition."""
    step = np.empty(len(order), np.int64)
    step[order] = np.arange(len(order))
    return kept.map(lambda pair: (int(step[pair[0]]), pair[1])).partitionBy(max(1, -(-len(order) // run)), lambda at: at // run)


def run_of_steps(runs: RDD, number: int, shape: Shape, state: Adam) -> tuple[np.ndarray, Adam]:
    """All steps of run ``number`` in one task: the losses before each of them, and the state after the last."""

    def steps(pairs: Iterator) -> list:
        losses = []
        for _, (y, x) in sorted(pairs, key=lambda pair: pair[0]):
            parts = [shape.gradient(state.parameters, x[i : i + CHUNK_ROWS], y[i : i + CHUNK_ROWS]) for i in range(0, len(y), CHUNK_ROWS)]
            losses.append(sum(loss for loss, _ in parts) / len(y))
            state.step(sum(g for _, g in parts) / len(y))
        return [(np.array(losses), state)]

    return runs.context.runJob(runs, steps, [number])[0]


def forget(runs: RDD) -> None:
    """Have the shuffle files of ``runs`` removed now; else those of all epochs lie there until the driver collects garbage."""
    cleaner, below = runs.context._jsc.sc().cleaner(), runs._jrdd.rdd()
    while cleaner.isDefined() and below.dependencies().nonEmpty():
        link = below.dependencies().head()
        if hasattr(link, "shuffleId") and link.getClass().getSimpleName() == "ShuffleDependency":
            cleaner.get().doCleanupShuffle(link.shuffleId(), False)
            return
        below = link.rdd()


def fit_networks(
    df: DataFrame, learning_rates: list[float], layers: tuple = LAYERS, epochs: int = 50, batch_size: int = 10, seed: int = 0,
    key: str = "id", column: str = "features", label: str = "label", places: Callable[[list], DataFrame] | None = None,
) -> list[NetworkModel]:
    """One network for each learning rate, all from the same start and over the same batches. ``places`` gives the rows as
    ``numbered`` does, for fits that share them."""
    unknown = [a for _, a in layers if a not in ACTIVATIONS]
    if unknown:
        raise ValueError(f"no such activation: {unknown[0]}")
    labels = sorted(r[0] for r in df.select(label).where(F.col(label).isNotNull()).distinct().collect())
    shape = Shape([width_of(df, column), *[n for n, _ in layers], len(labels)], [a for _, a in layers])
    batches = deal_batches(df, labels, batch_size, seed, key, column, label, places and places(labels))
    state = Adam(np.stack([shape.initial(seed) for _ in learning_rates]), np.array(learning_rates, float)[:, None])
    small = batch_size <= STORED_ROWS
    kept = batches.kept(shape.units[0]) if small else None
    run = max(1, RUN_BYTES // (8 * shape.units[0] * batch_size))
    history = []
    for order in epoch_orders(batches.count, epochs, seed):
        losses = []
        runs = in_runs(kept, order, run) if small else None
        for at in range(0, len(order), run if small else 1):
            if small:
                found, state = run_of_steps(runs, at // run, shape, state)
                losses.extend(found)
            else:
                loss, gradients = batch_gradients(batches.read(order[at]), shape, list(state.parameters), batch_size >= TWO_LEVEL_ROWS)
                losses.append(loss)
                state.step(np.stack(gradients))
        if small:
            forget(runs)
        history.append(np.mean(losses, axis=0))
    if small:
        kept.unpersist()
    return [NetworkModel(shape, p.copy(), labels, [float(h[i]) for h in history]) for i, p in enumerate(state.parameters)]


def epoch_orders(n_batches: int, epochs: int, seed: int) -> Iterator[list[int]]:
    """The order of the batches in each epoch."""
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        yield rng.permutation(n_batches).tolist()


def fit_network(df: DataFrame, learning_rate: float = 0.001, **params) -> NetworkModel:
    """A dense network with softmax output: Kullback-Leibler divergence, Adam, ``epochs`` passes over batches of
    ``batch_size`` rows. Steps follow each other, so small batches keep one core busy, larger ones as many as they have tasks."""
    return fit_networks(df, [learning_rate], **params)[0]
