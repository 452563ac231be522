"""Exact k nearest neighbours as an equi-join on cells.

Training rows belong to the cell of their nearest pivot. A test row visits only the cells that the
triangle inequality cannot rule out, and of each visited block only its best k rows leave the task
(after Lu et al. 2012, "Efficient processing of k nearest neighbor joins using MapReduce"). Cells
with many rows, however they come about, are split into blocks of bounded size on both sides.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from themata.cluster import materialise
from themata.functions.blocks import chunks, map_rows, matrix, width_of

#: Bytes of the rows of a block on either side, the rows of the smallest one, and the parts that rows are cut into
#: before blocks reach those bytes. A pair of blocks reads both, so what moves grows with rows times parts.
BLOCK_BYTES = 32 << 20
BLOCK_ROWS = 4096
PARTS = 8
MAX_PIVOTS = 512

#: Training rows for which a function of two row blocks is called at once, so that its temporary arrays stay small.
TILE_ROWS = 512
METRICS = ("euclidean", "cosine", "mahalanobis")


def whitening(covariance: np.ndarray) -> np.ndarray:
    """L with V^-1 = L L^T: the Mahalanobis distance is Euclidean after ``x @ L``. Directions in which the rows do not
    vary, such as constant columns, do not count (a pseudo-inverse)."""
    values, axes = np.linalg.eigh(covariance)
    used = values > 1e-12 * max(values.max(initial=0.0), 1e-300)
    return axes * np.where(used, 1.0 / np.sqrt(np.where(used, values, 1.0)), 0.0)


def embed(column: Column, width: int, metric: str, covariance: np.ndarray | None = None, side: int = 0) -> Column:
    """Map rows to a space where the metric ranks like the Euclidean distance.

    Cosine: rows of length one. Rows without direction get an axis of their own (one for the
    training side, one for the test side), at a right angle to everything, as 1 - cos = 1 wants.
    """
    column = column.cast("array<double>")
    if metric == "euclidean":
        return column
    if metric == "mahalanobis":
        white = whitening(covariance)
        return map_rows(column, width, lambda x: x @ white)

    def unit(x: np.ndarray) -> np.ndarray:
        norm = np.linalg.norm(x, axis=1, keepdims=True)
        extra = np.zeros((len(x), 2))
        extra[norm[:, 0] == 0, side] = 1.0
        return np.hstack([x / np.where(norm == 0, 1.0, norm), extra])

    return map_rows(column, width, unit)


def squared_distances(q: np.ndarray, t: np.ndarray) -> np.ndarray:
    d = (q * q).sum(1)[:, None] + (t * t).sum(1)[None, :] - 2.0 * (q @ t.T)
    return np.maximum(d, 0.0)


def distances(q: np.ndarray, t: np.ndarray) -> np.ndarray:
    return np.sqrt(squared_distances(q, t))


def block_top_k(q: np.ndarray, t: np.ndarray, t_ids: np.ndarray, k: int, metric=None):
    """(positions, distances) of the k nearest rows of ``t`` for each row of ``q``, by (distance, id).

    The matrix product only proposes candidates. Their distances are then computed from
    differences, and rows where rounding could have hidden a candidate are computed in full.
    """
    order = np.argsort(t_ids, kind="stable")
    k = min(k, len(t))

    def best(d: np.ndarray, positions: np.ndarray):
        if len(d) > 4 * k:  # sort only what can be among the first k, ties included
            last = np.partition(d, k - 1)[k - 1]
            if not np.isnan(last):
                near = np.flatnonzero(d <= last)
                d, positions = d[near], positions[near]
        pick = np.lexsort((positions, d))[:k]
        return positions[pick], d[pick]

    t = t[order]
    out_pos, out_dist = np.empty((len(q), k), int), np.empty((len(q), k))
    step = max(1, 4_000_000 // max(1, len(t)))
    for start in range(0, len(q), step):
        part = q[start : start + step]
        everything = np.arange(len(t))
        if metric is not None:
            d = np.hstack([np.asarray(metric(part, t[i : i + TILE_ROWS]), float) for i in range(0, len(t), TILE_ROWS)])
            for r in range(len(part)):
                out_pos[start + r], out_dist[start + r] = best(d[r], everything)
            continue
        rough = squared_distances(part, t)
        slack = 1e-12 * ((part * part).sum(1) + (t * t).sum(1).max()) * t.shape[1]
        m = min(len(t), 2 * k + 16)
        near = np.argpartition(rough, m - 1, axis=1)[:, :m] if m < len(t) else np.tile(everything, (len(part), 1))
        for r in range(len(part)):
            cand = near[r]
            exact = np.sqrt(((t[cand] - part[r]) ** 2).sum(1))
            pos, d = best(exact, cand)
            if m < len(t):
                worst = d[-1] ** 2 + 2 * slack[r]
                if rough[r, cand].max() <= worst:  # others may be as near
                    cand = np.flatnonzero(rough[r] <= worst)
                    pos, d = best(np.sqrt(((t[cand] - part[r]) ** 2).sum(1)), cand)
            out_pos[start + r], out_dist[start + r] = pos, d
    return order[out_pos], out_dist


def rows_of_blocks(rows: int, width: int) -> int:
    """Rows of a block: a fixed share of all, within bounds."""
    return max(BLOCK_ROWS, min(BLOCK_BYTES // (8 * max(width, 1)), math.ceil(rows / PARTS)))


def _pick(values: list[int], index: str) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), F.col(index))


def nearest(
    train: DataFrame,
    test: DataFrame,
    k: int,
    metric="euclidean",
    covariance: np.ndarray | None = None,
    block_rows: int | None = None,
) -> DataFrame:
    """``(id, train_id, label, dist)``: the ``k`` nearest training rows of each test row, ties by id.

    ``train`` is ``(id, label, features)``, ``test`` has ``id`` and ``features``. ``metric`` is a
    name, or a function of two row blocks returning the matrix of their distances; such a function
    need not obey the triangle inequality, so every block is then visited. Each of its distances may
    depend on its own two rows only. ``block_rows`` is chosen by the rows and their width if not given.
    """
    custom = None if isinstance(metric, str) else metric
    if custom is None and metric not in METRICS:
        raise ValueError(f"no such metric: {metric}")
    name = metric if custom is None else "euclidean"
    width = width_of(train, "features")
    left = materialise(
        train.select("id", "label", embed(F.col("features"), width, name, covariance, 0).alias("v"))
    )
    right = test.select(
        F.col("id").alias("qid"), embed(F.col("features"), width, name, covariance, 1).alias("v")
    )
    wide = width + 2 if name == "cosine" else width
    n_train = left.count()
    if n_train == 0:
        raise RuntimeError("no training rows")
    block_rows = block_rows or rows_of_blocks(n_train, wide)

    n_pivots = 1 if custom else min(MAX_PIVOTS, math.ceil(n_train / block_rows))
    # a bounded, repeatable choice of pivots; copies of one vector count once
    chosen = left.select("v", F.xxhash64("id").alias("h")).orderBy("h").limit(n_pivots).collect()
    pivots = np.unique(np.array([r["v"] for r in chosen]), axis=0)

    @F.arrow_udf(T.StructType([T.StructField("cell", T.IntegerType()), T.StructField("r", T.DoubleType())]))
    def assign(values: pa.Array) -> pa.Array:
        cells, radii = [np.zeros(0, int)], [np.zeros(0)]
        for block in chunks(values, wide):
            d = distances(block, pivots)
            cells.append(np.argmin(d, axis=1))
            radii.append(d.min(axis=1))
        return pa.StructArray.from_arrays(
            [pa.array(np.concatenate(cells), pa.int32()), pa.array(np.concatenate(radii))], ["cell", "r"]
        )

    placed = left.withColumn("a", assign("v")).select("id", "label", "v", "a.cell", "a.r")
    if n_pivots > 1:
        placed = materialise(placed)
    sizes, radius = np.zeros(len(pivots), int), np.zeros(len(pivots))
    for row in placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("r").alias("r")).collect():
        sizes[row["cell"]], radius[row["cell"]] = row["n"], row["r"]
    # the k rows nearest to each pivot bound the k-th distance of any test row from above
    inner = Window.partitionBy("cell").orderBy("r", "id")
    first = placed.select("cell", "r", "id").withColumn("rn", F.row_number().over(inner)).where(F.col("rn") <= k)
    near_pivot = np.full((len(pivots), k), np.inf)
    for row in first.select("cell", "r", "rn").collect():  # at most pivots x k rows
        near_pivot[row["cell"], row["rn"] - 1] = row["r"]
    filled = np.flatnonzero(sizes)

    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def route(values: pa.Array) -> pa.Array:
        visits = []
        for block in chunks(values, wide):
            if custom is not None:
                visits += [filled.tolist()] * len(block)
                continue
            d = distances(block, pivots)
            bounds = (d[:, :, None] + near_pivot[None, :, :]).reshape(len(block), -1)
            nth = min(k, bounds.shape[1]) - 1
            bound = np.partition(bounds, nth, axis=1)[:, nth]
            limit = bound * (1 + 1e-6) + 1e-6
            open_ = (d - radius[None, :] <= limit[:, None]) & (sizes > 0)[None, :]
            visits += [np.flatnonzero(row).tolist() for row in open_]
        return pa.array(visits, pa.list_(pa.int32()))

    routed = materialise(right.withColumn("cells", route("v")))
    visits = routed.select("qid", "v", F.explode("cells").alias("cell"))
    load = np.zeros(len(pivots), int)
    for row in visits.groupBy("cell").count().collect():
        load[row["cell"]] = row["count"]
    splits = [max(1, math.ceil(n / block_rows)) for n in sizes.tolist()]
    shares = [max(1, math.ceil(n / block_rows)) for n in load.tolist()]

    def block_of(key: str, parts: list[int]) -> Column:
        return F.pmod(F.xxhash64(key), _pick(parts, "cell")).cast("int")

    def every(parts: list[int]) -> Column:
        return F.explode(F.sequence(F.lit(0), _pick(parts, "cell") - 1))

    blocks = placed.select("id", "label", "v", "cell", block_of("id", splits).alias("sub"), every(shares).alias("part"))
    asks = visits.select("qid", "v", "cell", block_of("qid", shares).alias("part"), every(splits).alias("sub"))

    types = {f.name: f.dataType for f in left.schema} | {"qid": right.schema["qid"].dataType}
    schema = T.StructType(
        [
            T.StructField("qid", types["qid"]),
            T.StructField("train_id", types["id"]),
            T.StructField("label", types["label"]),
            T.StructField("dist", T.DoubleType()),
        ]
    )
    empty = to_arrow_schema(schema).empty_table()

    def search(known: pa.Table, asked: pa.Table) -> pa.Table:
        if not known.num_rows or not asked.num_rows:
            return empty
        t = matrix(pa.concat_arrays(known["v"].chunks), wide)
        q = matrix(pa.concat_arrays(asked["v"].chunks), wide)
        ids = np.array(known["id"].to_pylist())
        pos, dist = block_top_k(q, t, ids, k, custom)
        rows = np.repeat(np.arange(len(q)), pos.shape[1])
        flat = pa.array(pos.ravel())
        return pa.table(
            {
                "qid": asked["qid"].take(pa.array(rows)),
                "train_id": known["id"].take(flat),
                "label": known["label"].take(flat),
                "dist": pa.array(dist.ravel()),
            }
        )

    keys = ["cell", "sub", "part"]
    local = blocks.groupBy(*keys).cogroup(asks.groupBy(*keys)).applyInArrow(search, schema)
    # the rank filter is applied before the shuffle too, so at most k rows per task and test row move
    order = Window.partitionBy("qid").orderBy("dist", "train_id")
    top = local.withColumn("rn", F.row_number().over(order)).where(F.col("rn") <= k)
    shown = F.col("dist") * F.col("dist") / 2 if name == "cosine" else F.col("dist")
    return top.select(F.col("qid").alias("id"), "train_id", "label", shown.alias("dist"))


def vote(neighbours: DataFrame) -> DataFrame:
    """``(id, prediction)``: the most frequent label, the smaller one on a tie."""
    counted = neighbours.groupBy("id", "label").agg(F.count(F.lit(1)).alias("n"))
    best = counted.groupBy("id").agg(F.min(F.struct((-F.col("n")).alias("n"), "label")).alias("best"))
    return best.select("id", F.col("best.label").alias("prediction"))


def knn_predict(
    train: DataFrame, test: DataFrame, n_neighbors: int = 5, metric="euclidean", covariance=None,
    block_rows: int | None = None,
) -> DataFrame:
    return vote(nearest(train, test, n_neighbors, metric, covariance, block_rows))
