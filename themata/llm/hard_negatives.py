"""Hard negatives by spanning-tree bounds between anchors.

Anchors are linked in a minimum spanning tree over their distances. A task scores its rows against the root in full
and then walks down the tree: an anchor's score with a row differs from that of its parent anchor by at most the
length of the edge times the norm of the row. Where the interval this leaves cannot reach the child's window, the row
is not scored again, and the interval, widened, goes on to the grandchildren; the others are rescored by a block
product and start anew from an exact score. Scores are integers and products of float64 while no sum can reach 2^53,
else of 64-bit integers, so that every score is exact.

Two walks are made: one for the positives of each anchor, whose window is all that reaches the best so far; one for
the negatives, whose windows follow from the positives' scores and shrink as the best so far fill up. Tasks keep the
best of each anchor, by score and id; a shuffle in two steps merges them. Anchors are taken in blocks of ``ANCHORS``,
near ones together: a block's vectors (``ANCHORS`` times the width) and its tree are all that is broadcast, and the rows, stored once, are
read twice a block. Bounds prune where anchors are near each other compared with the windows; where they are not, all
rows are rescored, and the result is the same.

Defined cases: rows with a null label or vector, or a null or non-finite component take no part; neither do rows of
another width than the widest. Rows with one id each count by themselves, as anchors and as partners. A row without
an id is no anchor and comes last among equal scores. Anchors without positives, or positives without negatives in
their window, give no rows. An empty table gives an empty table; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from themata.cluster import materialise
from themata.llm.batches import record
from themata.llm.lexical_search import MERGE, ranked
from themata.llm.topk import Best

#: Anchors that are worked on at once.
ANCHORS = 1024

#: Anchors that the others are ordered by, so that a block holds near ones.
PIVOTS = 256

#: Rows of a block inside a task.
ROWS = 2048

#: Each component becomes floor(SCALE * x).
SCALE = 256

#: What a task returns, for Spark and for Arrow.
_FOUND = "part int, anchor int, slot int, score long, id long, row long"
_SCHEMA = pa.schema([(name, pa.int32()) for name in ("part", "anchor", "slot")] + [(name, pa.int64()) for name in ("score", "id", "row")])


def scaled_rows(table: DataFrame, label: Column, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``(row, id, label, v)`` of the rows that take part, ``v`` in whole numbers; a stage table."""
    vector = F.col(f"`{vector_col}`").cast("array<double>")
    finite = F.forall("x", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = table.select(F.col(f"`{id_col}`").cast("long").alias("id"), label.cast("long").alias("label"), vector.alias("x"))
    rows = rows.where(F.col("label").isNotNull() & F.col("x").isNotNull() & finite)
    scaled = materialise(rows.select(
        F.monotonically_increasing_id().alias("row"), "id", "label", F.transform("x", lambda x: F.floor(x * SCALE).cast("double")).alias("v")
    ))
    width = scaled.agg(F.max(F.size("v"))).first()[0]
    return scaled.where(F.size("v") == F.lit(width or 0))


@dataclass
class Tree:
    """A block of anchors: vectors, labels, rows, and for each its parent and the length of the edge to it. Levels
    list the anchors from the root downwards."""

    vectors: np.ndarray
    labels: np.ndarray
    rows: np.ndarray
    parent: np.ndarray
    length: np.ndarray
    levels: list[np.ndarray]


def spanning_tree(vectors: np.ndarray, labels: np.ndarray, rows: np.ndarray) -> Tree:
    """Minimum spanning tree by Prim's algorithm, from the anchor nearest to the mean."""
    n, x = len(vectors), vectors.astype(float)
    root = int(((x - x.mean(0)) ** 2).sum(1).argmin())
    parent, near = np.full(n, root), np.sqrt(((x - x[root]) ** 2).sum(1))
    depth, length = np.zeros(n, int), np.zeros(n)
    open_ = np.ones(n, bool)
    open_[root] = False
    for _ in range(n - 1):
        a = int(np.where(open_, near, np.inf).argmin())
        open_[a] = False
        depth[a], length[a] = depth[parent[a]] + 1, near[a]
        d = np.sqrt(((x - x[a]) ** 2).sum(1))
        closer = open_ & (d < near)
        near[closer], parent[closer] = d[closer], a
    return Tree(vectors, labels, rows, parent, length, [np.flatnonzero(depth == k) for k in range(depth.max() + 1)])


def walk(tree: Tree, x: np.ndarray, low: np.ndarray, high: np.ndarray, eligible) -> Iterator[tuple]:
    """Yields ``(anchors, rows, scores, n_scored)`` level by level: all pairs of anchor and row (``eligible`` gives
    their mask for a level) whose score is within the anchor's ``low`` and ``high``, and how many had to be scored."""
    norms = np.sqrt((x.astype(float) ** 2).sum(1))
    lower = upper = None
    where = np.zeros(len(tree.parent), int)
    for depth, level in enumerate(tree.levels):
        if depth == 0:
            exact = tree.vectors[level] @ x.T
            lower, upper = exact.astype(float), exact.astype(float)
            reach = np.ones(exact.shape, bool)
        else:
            above = where[tree.parent[level]]
            step = tree.length[level][:, None] * norms[None, :]
            step = step * (1 + 1e-9) + 1.0  # more than rounding could take away
            lower, upper = lower[above] - step, upper[above] + step
            reach = (upper >= low[level][:, None]) & (lower <= high[level][:, None])
            rows, columns = np.flatnonzero(reach.any(1)), np.flatnonzero(reach.any(0))
            exact = np.zeros(reach.shape, x.dtype)
            if len(rows):
                block = np.ix_(rows, columns)
                exact[block] = tree.vectors[level[rows]] @ x[columns].T
                lower[block] = upper[block] = exact[block]
        where[level] = np.arange(len(level))
        hit = reach & eligible(level) & (exact >= low[level][:, None]) & (exact <= high[level][:, None])
        a, r = np.nonzero(hit)
        yield level[a], r, exact[a, r], int(reach.sum())


def _matrix(column: pa.Array, dtype) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(dtype).reshape(len(column), -1)


def _row_blocks(batches: Iterator[pa.RecordBatch], dtype):
    for batch in batches:
        for begin in range(0, batch.num_rows, ROWS):
            part = batch.slice(begin, ROWS)
            ids, null = pc.fill_null(part.column(1), 0), part.column(1).is_null()
            plain = [c.to_numpy(zero_copy_only=False) for c in (part.column(0), ids, null, part.column(2))]
            yield *plain, _matrix(part.column(3), dtype)


def _emit(best: Best, slots: int) -> pa.RecordBatch:
    keys, scores, null, ids, rows = best.entries
    part = np.full(len(keys), TaskContext.get().partitionId() % MERGE)
    return record(_SCHEMA, part, keys // slots, keys % slots, scores.astype(np.int64), pa.array(ids, mask=null), rows)


def _positives(shared, n_positives: int, dtype):
    def search(batches):
        tree = shared.value
        best = Best(len(tree.labels), n_positives, dtype)
        for rows, ids, null, labels, x in _row_blocks(batches, dtype):
            same = lambda level: (tree.labels[level][:, None] == labels[None, :]) & (tree.rows[level][:, None] != rows[None, :])
            for a, r, scores, _ in walk(tree, x, best.floor, np.full(len(tree.labels), np.inf), same):
                best.offer(a, scores, null[r], ids[r], rows[r])
            best.settle()
        yield _emit(best, 1)

    return search


def _negatives(shared, windows, n_positives: int, n_negatives: int, dtype):
    """``windows``: lowest and highest score by anchor and positive, an empty one where there is no positive."""

    def search(batches):
        tree, (low, high) = shared.value, windows.value
        best = Best(low.size, n_negatives, dtype)
        some = (low <= high).any(1)
        for rows, ids, null, labels, x in _row_blocks(batches, dtype):
            floor = np.maximum(low, best.floor.reshape(low.shape))
            floor = np.where(low <= high, floor, np.inf)
            other = lambda level: tree.labels[level][:, None] != labels[None, :]
            top = np.where(some, np.where(low <= high, high, -np.inf).max(1), -np.inf)
            for a, r, scores, _ in walk(tree, x, floor.min(1), top, other):
                for slot in range(n_positives):
                    within = (scores >= floor[a, slot]) & (scores <= high[a, slot])
                    k = r[within]
                    best.offer(a[within] * n_positives + slot, scores[within], null[k], ids[k], rows[k])
            best.settle()
        yield _emit(best, n_positives)

    return search


def _by_place(anchors: DataFrame) -> DataFrame:
    """Anchors in an order that brings near ones together: by the nearest of ``PIVOTS`` of them, then by id."""
    some = anchors.orderBy(F.xxhash64("id", "row"), "row").limit(PIVOTS).select("v").collect()
    if not some:
        return anchors.orderBy("id", "row")
    pivots = np.array([r["v"] for r in some])

    @F.arrow_udf("int")
    def nearest(v: pa.Array) -> pa.Array:
        x = _matrix(v, np.float64)
        return pa.array((x @ pivots.T - (pivots * pivots).sum(1) / 2).argmax(1), pa.int32())

    return anchors.withColumn("cell", nearest("v")).orderBy("cell", "id", "row")


def _blocks_of(anchors: DataFrame) -> Iterator[list]:
    group: list = []
    for row in anchors.toLocalIterator():
        group.append(row)
        if len(group) == ANCHORS:
            yield group
            group = []
    if group:
        yield group


def mine(table: DataFrame, label: Column, is_anchor: Column, n_positives: int = 5, n_negatives: int = 10, lowest: int = 30, highest: int = 90,
         id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``: for each anchor and each of its
    ``n_positives`` best rows of the same label, the ``n_negatives`` best rows of other labels whose score is between
    ``lowest`` and ``highest`` per cent of the positive's. ``is_anchor`` is a condition on ``id``."""
    spark = table.sparkSession
    rows = scaled_rows(table, label, id_col, vector_col)
    facts = rows.agg(F.max(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)).alias("square")).first()
    square = facts["square"] or 0.0
    if square >= 2.0**62:
        raise ValueError("scores do not fit in 64 bits")
    dtype = np.float64 if square < 2.0**52 else np.int64
    order = [F.desc("score"), F.asc_nulls_last("id"), F.asc("row")]
    results = []
    anchors = materialise(rows.where(is_anchor & F.col("id").isNotNull()))
    for group in _blocks_of(_by_place(anchors)):
        vectors = np.array([r["v"] for r in group]).astype(dtype)
        tree = spanning_tree(vectors, np.array([r["label"] for r in group]), np.array([r["row"] for r in group]))
        shared = spark.sparkContext.broadcast(tree)
        given = rows.select("row", "id", "label", "v")
        first = given.mapInArrow(_positives(shared, n_positives, dtype), _FOUND)
        positives = ranked(first, ["anchor", "slot"], order, n_positives).collect()  # n_positives for each anchor of the block
        low, high = np.full((len(group), n_positives), np.inf), np.full((len(group), n_positives), -np.inf)
        names = []
        for p in positives:
            low[p["anchor"], p["rank"] - 1] = -((-lowest * p["score"]) // 100)
            high[p["anchor"], p["rank"] - 1] = (highest * p["score"]) // 100
            names.append((p["anchor"], p["rank"] - 1, group[p["anchor"]]["id"], p["id"], p["score"]))
        if not names:
            continue
        windows = spark.sparkContext.broadcast((low, high))
        second = given.mapInArrow(_negatives(shared, windows, n_positives, n_negatives, dtype), _FOUND)
        best = ranked(second, ["anchor", "slot"], order, n_negatives)
        named = spark.createDataFrame(names, "anchor int, slot int, anchor_id long, positive_id long, positive_score long")
        results.append(materialise(best.join(F.broadcast(named), ["anchor", "slot"]).select(  # a block's positives
            "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
        )))
    if not results:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    whole = results[0]
    for more in results[1:]:
        whole = whole.unionAll(more)
    return whole
