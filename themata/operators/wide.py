"""Leading axes of tables with very many columns, without a matrix of columns x columns anywhere.

A block of ``k`` and a few more directions is improved pass by pass (block Krylov subspaces with restarts, after Musco
& Musco 2015 and Wu & Simon 2000). A pass multiplies it by the rows and back: tasks hold the block, take the products
of bounded blocks of rows and return the columns they touched; a shuffle adds these up. Rows are stored once in packed
blocks: the columns with most cells are multiplied as a dense matrix, the other cells one by one. There are as many tasks
as cores, so what a pass shuffles does not grow with the rows. The driver keeps ``BLOCKS`` blocks of columns x directions,
orthonormal, with the sums of a pass at most two more, and solves eigenproblems of that few directions. It stops when the residual of every wanted axis is small, which bounds its error.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, functions as F

from themata.cluster import collect_garbage, materialise
from themata.functions.blocks import CHUNK_ROWS, as_vector, matrix

#: Directions besides the wanted ones, which speed up the last of them.
EXTRA = 10

#: Blocks of directions in the basis at most, those that a restart keeps, and rows of them that are worked on at once.
BLOCKS, KEPT = 3, 2
STEP_ROWS = 4096

#: Bytes of the directions that a job multiplies at most: they lie on every executor, and as many go back from every task.
SLICE_BYTES = 32 << 20

#: Up to so many columns a block of rows is multiplied as a dense matrix.
DENSE_WIDTH = 4096

#: Stored cells of sparse rows that are multiplied at once.
CELLS = 1 << 16

#: Columns of sparse rows, those with most cells, that are multiplied as a dense matrix.
HOT_COLUMNS = 2048

#: Columns and bytes that travel together at least, and groups in which the sums of more tasks than ``FEW_TASKS`` are added
#: up first.
STRIPE = 64
STRIPE_BYTES = 1 << 19
GROUPS = 256
FEW_TASKS = 64


@dataclass
class Axes:
    """``vectors`` (columns x k) with their eigenvalues, largest first, the norms of their residuals and the passes."""

    vectors: np.ndarray
    values: np.ndarray
    residuals: np.ndarray
    passes: int


def top_axes(apply: Callable[[np.ndarray], np.ndarray], width: int, k: int, tol: float = 1e-9, max_passes: int = 200, seed: int = 0) -> Axes:
    """Largest eigenvalues and their vectors of a symmetric operator without negative eigenvalues.

    ``apply`` multiplies a block of columns. Done when all residuals are below ``tol`` of the largest eigenvalue; raises
    RuntimeError when ``max_passes`` do not get there.
    """
    k = min(k, width)
    size = min(width, k + EXTRA)
    basis = np.linalg.qr(np.random.default_rng(seed).normal(size=(width, size)))[0]
    image, passes = apply(basis), 1
    while True:
        small = basis.T @ image
        values, turn = np.linalg.eigh((small + small.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        axes, moved = basis @ turn[:, :size], image @ turn[:, :size]
        off = moved - axes * values[:size]
        residuals = np.linalg.norm(off[:, :k], axis=0)
        bound = tol * max(values[0], np.finfo(float).tiny)
        if (residuals <= bound).all() or basis.shape[1] == width:
            return Axes(axes[:, :k], np.maximum(values[:k], 0.0), residuals, passes)
        if passes >= max_passes:
            raise RuntimeError(f"axes have not converged in {max_passes} passes; largest residual {residuals.max():.3g}")
        if basis.shape[1] > 4 * size:  # restart from the best half
            basis, image = basis @ turn[:, : 2 * size], image @ turn[:, : 2 * size]
        fresh = _beyond(off[:, np.linalg.norm(off, axis=0) > bound / 10], basis)
        if not fresh.shape[1]:
            return Axes(axes[:, :k], np.maximum(values[:k], 0.0), residuals, passes)
        basis, image = np.hstack([basis, fresh]), np.hstack([image, apply(fresh)])
        passes += 1


def _beyond(block: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """Orthonormal columns that span what ``block`` adds to ``basis``; directions that add next to nothing are left out."""
    block = block / np.linalg.norm(block, axis=0)
    for _ in range(3):  # the later rounds take away what rounding left
        block = block - basis @ (basis.T @ block)
        strength, turn = np.linalg.eigh(block.T @ block)
        kept = strength > 1e-14 * max(strength.max(initial=0.0), 1e-300)
        block = block @ (turn[:, kept] / np.sqrt(strength[kept]))
    return block[:, : basis.shape[0] - basis.shape[1]]


def lean_axes(apply: Callable[[np.ndarray], np.ndarray], width: int, k: int, tol: float = 1e-9, max_passes: int = 200, seed: int = 0) -> Axes:
    """``top_axes`` for very many columns. ``apply`` returns an array of its own.

    The basis takes at most ``BLOCKS`` blocks. Its images are not kept: they lie within it, but for that of the last block,
    of which the part outside is the next one (a thick restart, too, leaves only that part outside).
    """
    k = min(k, width)
    size = min(width, k + EXTRA)
    room = min(width, BLOCKS * size)
    basis, small = np.empty((width, room)), np.zeros((room, room))
    basis[:, :size] = np.linalg.qr(np.random.default_rng(seed).normal(size=(width, size)))[0]
    known, have, passes = 0, size, 0
    while True:
        rest = apply(basis[:, known:have])
        passes += 1
        part = _without(rest, basis[:, :have])
        small[:have, known:have] = part
        small[known:have, :have] = part.T
        values, turn = np.linalg.eigh((small[:have, :have] + small[:have, :have].T) / 2)
        values, turn = np.maximum(values[::-1], 0.0), turn[:, ::-1]
        inside = _triangle(rest)
        residuals = np.linalg.norm(inside @ turn[known:have, :k], axis=0)
        scale = max(values[0], np.finfo(float).tiny)
        fresh = None
        if (residuals > tol * scale).any() and have < width:
            if passes >= max_passes:
                raise RuntimeError(f"axes have not converged in {max_passes} passes; largest residual {residuals.max():.3g}")
            fresh = _outside(rest, basis[:, :have], scale * min(tol, 1e-9) / 1000)[:, : width - have]
        if fresh is None or not fresh.shape[1]:
            return Axes(np.vstack([basis[i : i + STEP_ROWS, :have] @ turn[:, :k] for i in range(0, width, STEP_ROWS)]), values[:k], residuals, passes)
        if have + fresh.shape[1] > room:  # go on from the best
            keep = min(KEPT * size, room - fresh.shape[1])
            for i in range(0, width, STEP_ROWS):
                basis[i : i + STEP_ROWS, :keep] = basis[i : i + STEP_ROWS, :have] @ turn[:, :keep]
            small[:] = 0.0
            small[np.arange(keep), np.arange(keep)] = values[:keep]
            have = keep
        known, have = have, have + fresh.shape[1]
        basis[:, known:have] = fresh


def _without(block: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """Take from ``block``, in place, its part within an orthonormal ``basis``, and return that."""
    total = 0.0
    for _ in range(2):  # the second round takes away what rounding left
        part = sum(basis[i : i + STEP_ROWS].T @ block[i : i + STEP_ROWS] for i in range(0, len(block), STEP_ROWS))
        for i in range(0, len(block), STEP_ROWS):
            block[i : i + STEP_ROWS] -= basis[i : i + STEP_ROWS] @ part
        total = total + part
    return total


def _triangle(block: np.ndarray) -> np.ndarray:
    """R of the QR decomposition, a bounded number of rows at a time."""
    out = np.zeros((0, block.shape[1]))
    for i in range(0, len(block), STEP_ROWS):
        out = np.linalg.qr(np.vstack([out, block[i : i + STEP_ROWS]]), mode="r")
    return out


def _outside(block: np.ndarray, basis: np.ndarray, floor: float) -> np.ndarray:
    """Orthonormal columns that span what ``block``, which is overwritten, has outside ``basis``, but for directions weaker
    than ``floor``."""
    for _ in range(3):  # the later rounds take away what rounding left
        _, strength, turn = np.linalg.svd(_triangle(block), full_matrices=False)
        kept = strength > floor
        turn = turn[kept].T / strength[kept]
        for i in range(0, len(block), STEP_ROWS):
            block[i : i + STEP_ROWS, : turn.shape[1]] = block[i : i + STEP_ROWS] @ turn
        block, floor = block[:, : turn.shape[1]], 0.5
        _without(block, basis)
    return block


def cells(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Stored cells of vectors: first cell of each row (and the end), columns and values."""
    kind, _, indices, values = (pc.struct_field(column, i) for i in range(4))
    lengths = pc.list_value_length(values).to_numpy(zero_copy_only=False)
    starts = np.concatenate(([0], np.cumsum(lengths)))
    place = np.arange(starts[-1]) - np.repeat(starts[:-1], lengths)
    sparse = np.repeat(kind.to_numpy(zero_copy_only=False) == 0, lengths)
    place[sparse] = indices.flatten().to_numpy(zero_copy_only=False)
    return starts, place, values.flatten().to_numpy(zero_copy_only=False)


def _parts(column: pa.Array) -> Iterator[tuple]:
    """Rows ``begin`` to ``stop`` with about ``CELLS`` stored cells: each cell's row from ``begin`` on, column and value."""
    starts, place, values = cells(column)
    begin = 0
    while begin < len(starts) - 1:
        stop = max(begin + 1, int(np.searchsorted(starts, starts[begin] + CELLS, side="right")) - 1)
        a, b = starts[begin], starts[stop]
        if b > a:
            yield begin, stop, np.repeat(np.arange(stop - begin), np.diff(starts[begin : stop + 1])), place[a:b], values[a:b]
        begin = stop


_PACKED = pa.schema([(c, pa.int32() if c == "n" else pa.binary()) for c in ("n", "hot", "warm", "counts", "place", "values", "order")])


def packed(df: DataFrame, column: str, hot: np.ndarray, width: int) -> DataFrame:
    """Rows of a vector column in blocks of at most ``CHUNK_ROWS`` rows and, of more than one, about ``CELLS`` cells besides
    those of the columns ``hot``: these cells' places in a dense matrix and values (``warm``), the number of the others by
    row, their columns, values and order by column."""
    rank = np.full(width, -1, np.int32)
    rank[hot] = np.arange(len(hot))
    shared = df.sparkSession.sparkContext.broadcast(rank)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, CHUNK_ROWS):
                yield from _blocks(batch.column(0).slice(low, CHUNK_ROWS), shared.value, len(hot))

    vectors = df.select(as_vector(df, column).alias("v"))
    return vectors.mapInArrow(pack, "n int, hot binary, warm binary, counts binary, place binary, values binary, order binary")


def _blocks(column: pa.Array, rank: np.ndarray, n_hot: int) -> Iterator[pa.RecordBatch]:
    starts, place, values = cells(column)
    cold = rank[place] < 0
    ends = np.concatenate(([0], np.cumsum(cold)))[starts]
    low = 0
    while low < len(starts) - 1:
        high = max(low + 1, int(np.searchsorted(ends, ends[low] + CELLS, side="right")) - 1)
        own = slice(starts[low], starts[high])
        out, at, v = cold[own], place[own], values[own]
        row = np.repeat(np.arange(high - low), np.diff(starts[low : high + 1]))
        dense = (row * n_hot + rank[at])[~out]
        order = np.argsort(at[out], kind="stable")
        parts = [dense.astype("<i4"), v[~out], np.diff(ends[low : high + 1]).astype("<i4"), at[out].astype("<i4"), v[out], order.astype("<i4")]
        yield pa.RecordBatch.from_arrays([pa.array([high - low], pa.int32()), *[pa.array([x.tobytes()], pa.binary()) for x in parts]], schema=_PACKED)
        low = high


def _add_block(total: np.ndarray, row: dict, hot: np.ndarray, block: np.ndarray, leading: np.ndarray, added: np.ndarray) -> None:
    """total += X^T (X block) for one packed block, but for the columns ``hot``, whose sums go to ``added``; ``leading`` is
    the block's part of them."""
    n, counts = row["n"], np.frombuffer(row["counts"], "<i4")
    place, values, order = np.frombuffer(row["place"], "<i4"), np.frombuffer(row["values"]), np.frombuffer(row["order"], "<i4")
    dense = np.zeros(n * len(hot))
    dense[np.frombuffer(row["hot"], "<i4")] = np.frombuffer(row["warm"])
    dense = dense.reshape(n, len(hot))
    rows = dense @ leading
    if len(place):
        filled, starts = np.flatnonzero(counts), np.cumsum(counts) - counts
        cell = block[place]
        cell *= values[:, None]
        rows[filled] += np.add.reduceat(cell, starts[filled], axis=0)
        cell = rows[np.repeat(np.arange(n), counts)[order]]
        cell *= values[order][:, None]
        sorted_ = place[order]
        first = np.flatnonzero(np.diff(sorted_, prepend=-1))
        total[sorted_[first]] += np.add.reduceat(cell, first, axis=0)
    added += dense.T @ rows


def times(column: pa.Array, block: np.ndarray) -> np.ndarray:
    """X block for the rows X of a list or vector column."""
    if not pa.types.is_struct(column.type) or len(block) <= DENSE_WIDTH:
        return np.concatenate([matrix(column.slice(i, CHUNK_ROWS), len(block)) @ block for i in range(0, len(column), CHUNK_ROWS)] or [np.zeros((0, block.shape[1]))])
    out = np.zeros((len(column), block.shape[1]))
    for begin, stop, owner, place, values in _parts(column):
        filled, first = np.unique(owner, return_index=True)
        out[begin + filled] = np.add.reduceat(block[place] * values[:, None], first, axis=0)
    return out


_STRIPES = "stripe int, part int, s binary"


def _added(table: pa.Table) -> pa.Table:
    total = np.zeros(len(table["s"][0].as_py()) // 8)
    for values in table["s"]:
        total += np.frombuffer(values.as_py())
    return pa.table({"stripe": table["stripe"].slice(0, 1), "part": table["part"].slice(0, 1), "s": pa.array([total.tobytes()], pa.binary())})


def summed(df: DataFrame, partial: Callable[[Iterator[pa.RecordBatch]], np.ndarray], shape: tuple[int, int], tasks: int | None = None) -> np.ndarray:
    """Sum of the matrices that ``partial`` makes of the Arrow batches of each task. They travel in stripes of rows and
    are added up in two levels, or in one if there are few ``tasks``, so that no task holds more than a share of them."""
    height = max(STRIPE, STRIPE_BYTES // (8 * max(1, shape[1])))

    def stripes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = partial(batches)
        group = TaskContext.get().partitionId() % GROUPS
        for number in range(-(-len(total) // height)):
            stripe = total[number * height : (number + 1) * height]
            if stripe.any():
                yield pa.RecordBatch.from_arrays([pa.array([number], pa.int32()), pa.array([group], pa.int32()), pa.array([stripe.tobytes()], pa.binary())], ["stripe", "part", "s"])

    parts = df.mapInArrow(stripes, _STRIPES)
    for keys in [["stripe", "part"], ["stripe"]][tasks is not None and tasks <= FEW_TASKS :]:
        parts = parts.groupBy(*keys).applyInArrow(_added, _STRIPES)
    out = np.zeros(shape)
    found = parts.toArrow()
    for number, values in zip(found["stripe"].to_pylist(), found["s"]):
        out[number * height : (number + 1) * height] = np.frombuffer(values.as_buffer()).reshape(-1, shape[1])
    return out


def gram_times(df: DataFrame, column: str, block: np.ndarray) -> np.ndarray:
    """X^T (X block) over all rows of a vector column; ``block`` is columns x directions."""
    width = len(block)
    if width > DENSE_WIDTH:
        hot = np.empty(0, np.int64)
        return packed_times(packed(df, column, hot, width), hot, block)
    shared = df.sparkSession.sparkContext.broadcast(block)  # columns x directions, as the driver itself holds

    def partial(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        w = shared.value
        total = np.zeros(w.shape)
        for batch in batches:
            for begin in range(0, batch.num_rows, CHUNK_ROWS):
                x = matrix(batch.column(0).slice(begin, CHUNK_ROWS), width)
                total += x.T @ (x @ w)
        return total

    out = summed(df.select(as_vector(df, column).alias("v")), partial, block.shape)
    shared.destroy()  # the driver's copy too
    return out


def packed_times(rows: DataFrame, hot: np.ndarray, block: np.ndarray, tasks: int | None = None) -> np.ndarray:
    """X^T (X block) over rows in blocks of ``packed`` with the same ``hot``, read by at most ``tasks`` tasks."""
    shared = rows.sparkSession.sparkContext.broadcast((hot, block))

    def partial(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        hot, w = shared.value
        total, leading, added = np.zeros(w.shape), w[hot], np.zeros((len(hot), w.shape[1]))
        for batch in batches:
            for i in range(batch.num_rows):
                _add_block(total, batch.slice(i, 1).to_pylist()[0], hot, w, leading, added)
        total[hot] += added
        return total

    out = summed(rows.coalesce(tasks) if tasks else rows, partial, block.shape, tasks)
    shared.destroy()  # the driver's copy too
    return out


def covariance_axes(df: DataFrame, k: int, column: str = "features", centred: bool = True, tol: float = 1e-9) -> tuple[Axes, np.ndarray, float]:
    """Leading axes of the covariance (n - 1 denominator) or, not ``centred``, of X^T X; the mean that was taken off,
    and the sum of all eigenvalues. Give a stage table: it is read once a pass."""
    vectors = df.select(as_vector(df, column).alias("v"))
    facts = vectors.agg(Summarizer.metrics("count", "mean", "variance", "normL2", "numNonZeros").summary(F.col("v")).alias("s")).select("s.*").first()
    n, mean = facts["count"], facts["mean"].toArray()
    if len(mean) > DENSE_WIDTH:
        hot = np.sort(np.argsort(-facts["numNonZeros"].toArray(), kind="stable")[:HOT_COLUMNS])
        tasks = df.sparkSession.sparkContext.defaultParallelism
        rows = materialise(packed(df, column, hot, len(mean)).repartition(tasks))

        def gram(w: np.ndarray) -> np.ndarray:
            out, step = np.empty(w.shape), max(1, SLICE_BYTES // (8 * len(w)))
            for i in range(0, w.shape[1], step):
                out[:, i : i + step] = packed_times(rows, hot, w[:, i : i + step], tasks)
                collect_garbage(df.sparkSession)
            return out
    else:
        gram = lambda w: gram_times(df, column, w)
    axes = lean_axes if len(mean) > DENSE_WIDTH else top_axes
    if not centred:
        total = float((facts["normL2"].toArray() ** 2).sum())
        return axes(gram, len(mean), k, tol), np.zeros(len(mean)), total
    scale = max(n - 1, 1)

    def apply(w: np.ndarray) -> np.ndarray:
        out, shift = gram(w), n * (mean @ w)
        for i in range(0, len(out), STEP_ROWS):
            part = out[i : i + STEP_ROWS]
            part -= np.outer(mean[i : i + STEP_ROWS], shift)
            part /= scale
        return out

    return axes(apply, len(mean), k, tol), mean, float(facts["variance"].toArray().sum())
