"""Near duplicates among embeddings with navigable small-world graphs per shard.

Vectors are dealt by a hash into shards of a bounded number. Each shard gets a hierarchical navigable small-world
graph (Malkov & Yashunin 2018), built in batches over arrays. The vectors of every shard query every graph once
(their own, and those of the shards behind): a beam search keeps the nearest nodes it has met. Where a whole beam
lies within the threshold there may be more, so these queries get a wider beam and, beyond ``WIDEST``, a scan of
the shard in blocks. An audit compares some queries of each pair of shards with a scan and doubles the beam until
recall is at least ``RECALL``. Cosines of candidates are verified in double precision.

A pair of shards returns link counts per vector and a spanning forest of its links, never the links themselves.
Equal vectors are one node with a count. Components are unions of the forests.

Defined cases: vectors that are null, empty, zero, or hold null or non-finite components link with nothing; rows
with one id are one vertex with the links of all its rows; a null id takes no part, is its own (null) component
and is kept; vectors of different length never link; an empty table gives an empty table.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from themata.cluster import materialise
from themata.llm.batches import record
from themata.llm.components import components

THRESHOLD = 0.95

#: Vectors in one graph, in expectation.
SHARD = 8192

#: Links of a node on the ground level (half of that above), and the beam while building.
LINKS, BUILD_BEAM = 24, 48

#: Beam of the first search, and of the last one before a scan.
BEAM, WIDEST = 24, 384

#: Queries of each pair of shards that are audited, and the recall to reach.
AUDITED, RECALL = 96, 0.98

#: Queries handled at once.
QUERIES = 512


class Level:
    """One level of a graph: its nodes among the shard's vectors, and the links between them by place."""

    def __init__(self, nodes: np.ndarray, vectors: np.ndarray, links: np.ndarray):
        self.nodes, self.vectors, self.links = nodes, vectors, links

    def search(self, queries: np.ndarray, entry: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """Places (-1: none) and cosines of the nearest nodes met, best first, for each query and its entry place."""
        q = len(queries)
        rows = np.arange(q)
        seen = np.zeros((q, len(self.nodes) + 1), bool)  # the last column stands for missing links
        seen[:, -1] = True
        seen[rows, entry] = True
        ids = np.full((q, beam), -1, np.int32)
        cosines = np.full((q, beam), -np.inf, np.float32)
        ids[:, 0], cosines[:, 0] = entry, np.einsum("qd,qd->q", queries, self.vectors[entry])
        todo = np.zeros((q, beam), bool)
        todo[:, 0] = True
        wide = max(1, min(3, beam // 8))
        active = rows
        while len(active):
            open_cosines = np.where(todo[active], cosines[active], -np.inf)
            best = np.argpartition(-open_cosines, min(wide, beam) - 1, axis=1)[:, :wide]
            at = active[:, None]
            fine = np.take_along_axis(open_cosines, best, axis=1) > -np.inf
            todo[at, best] = False
            next_ids = np.where(fine[:, :, None], self.links[ids[at, best]], -1).reshape(len(active), -1)
            next_ids.sort(axis=1)
            fresh = ~seen[at, next_ids]
            fresh[:, 1:] &= next_ids[:, 1:] != next_ids[:, :-1]
            seen[at, next_ids] = True
            met = np.full(next_ids.shape, -np.inf, np.float32)
            r, c = np.nonzero(fresh)
            met[r, c] = np.einsum("kd,kd->k", queries[active[r]], self.vectors[next_ids[r, c]])
            all_cosines = np.concatenate((cosines[active], met), axis=1)
            keep = np.argpartition(-all_cosines, beam - 1, axis=1)[:, :beam]
            cosines[active] = np.take_along_axis(all_cosines, keep, axis=1)
            ids[active] = np.take_along_axis(np.concatenate((ids[active], next_ids), axis=1), keep, axis=1)
            todo[active] = np.take_along_axis(np.concatenate((todo[active], fresh), axis=1), keep, axis=1)
            active = active[(todo[active] & (cosines[active] > -np.inf)).any(axis=1)]
        order = np.argsort(-cosines, axis=1, kind="stable")
        cosines = np.take_along_axis(cosines, order, axis=1)
        return np.where(cosines > -np.inf, np.take_along_axis(ids, order, axis=1), -1), cosines


def diverse(vectors: np.ndarray, of: np.ndarray, candidates: np.ndarray, m: int) -> np.ndarray:
    """Up to ``m`` of each row's candidates (-1: none): nearest first, those nearer to a chosen one than to the
    node itself only if room is left."""
    width = candidates.shape[1]
    near = np.einsum("ad,acd->ac", vectors[of], vectors[candidates])
    near[(candidates < 0) | (candidates == of[:, None])] = -np.inf
    order = np.argsort(-near, axis=1, kind="stable")
    candidates, near = np.take_along_axis(candidates, order, axis=1), np.take_along_axis(near, order, axis=1)
    valid = near > -np.inf
    valid[:, 1:] &= candidates[:, 1:] != candidates[:, :-1]
    own = vectors[candidates]
    gram = own @ own.transpose(0, 2, 1)
    chosen = np.zeros(candidates.shape, bool)
    for c in range(width):
        covered = (chosen & (gram[:, c, :] > near[:, c : c + 1])).any(axis=1)
        chosen[:, c] = valid[:, c] & ~covered & (chosen.sum(axis=1) < m)
    rank = np.where(chosen, 0, np.where(valid, 1, 2)) * width + np.arange(width)
    first = np.argsort(rank, axis=1)[:, :m]
    picked = np.where(np.take_along_axis(valid, first, axis=1), np.take_along_axis(candidates, first, axis=1), -1)
    return np.pad(picked, ((0, 0), (0, m - picked.shape[1])), constant_values=-1)


def build_level(vectors: np.ndarray, nodes: np.ndarray, m: int) -> Level:
    """Graph over ``vectors[nodes]``, inserted in batches that double in size."""
    own = np.ascontiguousarray(vectors[nodes], np.float32)
    n = len(own)
    links = np.full((n + 1, m), -1, np.int32)  # the last row serves missing nodes
    level = Level(nodes, own, links)
    done = 0
    while done < n:
        size = min(n - done, max(32, min(done, QUERIES)))
        batch = np.arange(done, done + size)
        within = own[batch] @ own[batch].T
        np.fill_diagonal(within, -np.inf)
        k = min(size, m)
        found = batch[np.argpartition(-within, k - 1, axis=1)[:, :k]].astype(np.int32) if size > 1 else np.full((1, 1), -1, np.int32)
        if done:
            part = Level(nodes[:done], own[:done], np.where(links[:done] < done, links[:done], -1))
            entry = np.argmax(own[batch] @ own[: min(done, 64)].T, axis=1)
            found = np.concatenate((part.search(own[batch], entry, BUILD_BEAM)[0], found), axis=1)
        links[batch] = diverse(own, batch, found, m)
        # the other way round: nodes that gained links choose anew among old and new ones
        target, source = links[batch].ravel(), np.repeat(batch, m)
        source, target = source[target >= 0], target[target >= 0]
        order = np.argsort(target, kind="stable")
        source, target = source[order], target[order]
        gained, first, counts = np.unique(target, return_index=True, return_counts=True)
        for at in range(0, len(gained), QUERIES):
            part, f, c = gained[at : at + QUERIES], first[at : at + QUERIES], np.minimum(counts[at : at + QUERIES], 2 * m)
            new = np.full((len(part), int(c.max())), -1, np.int32)
            slot = np.arange(new.shape[1])[None, :] < c[:, None]
            new[slot] = source[(f[:, None] + np.arange(new.shape[1]))[slot]]
            links[part] = diverse(own, part, np.concatenate((links[part], new), axis=1), m)
        done += size
    return level


class Graph:
    """Levels from the ground up; a node's height follows from its place, as the shard's order is by a hash."""

    def __init__(self, vectors: np.ndarray, links: list[np.ndarray] | None = None):
        self.vectors = vectors
        n, step, self.levels = len(vectors), 1, []
        while not self.levels or n // step >= 8:
            nodes = np.arange(0, n, step)
            m = LINKS if step == 1 else LINKS // 2
            if links is None:
                self.levels.append(build_level(vectors, nodes, m))
            else:
                self.levels.append(Level(nodes, np.ascontiguousarray(vectors[nodes], np.float32), links[len(self.levels)]))
            step *= LINKS // 2

    def search(self, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        entry = np.zeros(len(queries), np.int64)
        for level in self.levels[:0:-1]:
            entry = level.search(queries, entry, 8)[0][:, 0].astype(np.int64) * (LINKS // 2)
        return self.levels[0].search(queries, entry, beam)


def links_between(graph: Graph, queries: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Query and node numbers of all links found from ``queries`` into ``graph``, verified in double precision."""
    audited = np.unique(np.linspace(0, len(queries) - 1, min(AUDITED, len(queries))).astype(np.int64))
    truth = queries[audited] @ graph.vectors.T >= threshold
    beam = BEAM
    while True:
        left, right = _search(graph, queries, beam, threshold)
        known = np.isin(left, audited)
        found = np.zeros_like(truth)
        found[np.searchsorted(audited, left[known]), right[known]] = True
        if (found & truth).sum() >= RECALL * truth.sum() or beam >= len(graph.vectors):
            return left, right
        beam *= 2


def _search(graph: Graph, queries: np.ndarray, beam: int, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    lefts, rights = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    todo = np.arange(len(queries))
    single = queries.astype(np.float32)
    widest = max(beam, WIDEST)
    while len(todo) and beam <= widest:
        dense = []
        for at in range(0, len(todo), QUERIES):
            part = todo[at : at + QUERIES]
            ids, cosines = graph.search(single[part], min(beam, len(graph.vectors)))
            full = (cosines[:, -1] >= threshold - 0.01) & (beam < len(graph.vectors))
            dense.append(part[full])
            r, c = np.nonzero((ids >= 0) & (cosines >= threshold - 0.01) & ~full[:, None])
            left, right = part[r], ids[r, c].astype(np.int64)
            good = np.einsum("kd,kd->k", queries[left], graph.vectors[right]) >= threshold
            lefts.append(left[good])
            rights.append(right[good])
        todo = np.concatenate(dense)
        beam *= 4
    for at in range(0, len(todo), QUERIES):  # more neighbours than the widest beam holds
        part = todo[at : at + QUERIES]
        r, c = np.nonzero(queries[part] @ graph.vectors.T >= threshold)
        lefts.append(part[r])
        rights.append(c)
    return np.concatenate(lefts), np.concatenate(rights)


def forest(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Smallest reachable number of each of ``n`` nodes."""
    root = np.arange(n)
    while len(left):
        low = np.minimum(root[left], root[right])
        before = root.copy()
        np.minimum.at(root, root[left], low)
        np.minimum.at(root, root[right], low)
        while (root != root[root]).any():
            root = root[root]
        if (root == before).all():
            return root
    return root


_SHARDS = pa.schema([("shard", pa.int64()), ("ids", pa.binary()), ("sizes", pa.binary()), ("vectors", pa.binary()), ("links", pa.list_(pa.binary()))])
_SHARDS_DDL = "shard long, ids binary, sizes binary, vectors binary, links array<binary>"
_FOUND = pa.schema([("id", pa.int64()), ("links", pa.int64()), ("root", pa.int64())])


def _build(table: pa.Table) -> pa.Table:
    table = table.sort_by([("mixed", "ascending"), ("id", "ascending")])
    vectors = table["vector"].combine_chunks().flatten().to_numpy().astype(np.float64).reshape(table.num_rows, -1)
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)  # no overflow in the squares
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    graph = Graph(vectors)
    pack = lambda name: [table[name].to_numpy().astype("<i8").tobytes()]
    links = [[level.links.astype("<i4").tobytes() for level in graph.levels]]
    return pa.Table.from_batches([record(_SHARDS, table["shard"][:1].combine_chunks(), pack("id"), pack("size"), [vectors.tobytes()], links)])


def _query(threshold: float):
    def query(table: pa.Table) -> pa.Table:
        rows = table.sort_by("shard").to_pylist()
        ids = [np.frombuffer(r["ids"], "<i8") for r in rows]
        sizes = [np.frombuffer(r["sizes"], "<i8") for r in rows]
        vectors = [np.frombuffer(r["vectors"], np.float64).reshape(len(i), -1) for r, i in zip(rows, ids)]
        m = [LINKS] + [LINKS // 2] * 64
        graph = Graph(vectors[-1], [np.frombuffer(b, "<i4").reshape(-1, m[i]) for i, b in enumerate(rows[-1]["links"])])
        left, right = links_between(graph, vectors[0], threshold)
        alone = len(rows) == 1
        if alone:  # each link once, whichever side found it
            pairs = np.unique(np.minimum(left, right) * len(ids[0]) + np.maximum(left, right))
            left, right = pairs // len(ids[0]), pairs % len(ids[0])
            left, right = left[left != right], right[left != right]
            names, counts = ids[0], sizes[0]
        else:
            names, counts = np.concatenate(ids), np.concatenate(sizes)
            right = right + len(ids[0])
        other = names[left] != names[right]
        left, right = left[other], right[other]
        links = np.bincount(left, counts[right], len(names)) + np.bincount(right, counts[left], len(names))
        root = forest(len(names), left, right)
        some = np.flatnonzero(links)
        return pa.Table.from_batches([record(_FOUND, names[some], links[some].astype(np.int64), names[root[some]])])

    return query


def usable(vector: Column) -> Column:
    """Whether a vector has a direction: not null, not empty, all components finite, not all zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf)))
    return F.coalesce((F.size(vector) > 0) & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` of every row."""
    rows = vectors.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{vector_col}`").cast("array<double>").alias("vector"))
    good = F.coalesce(usable(F.col("vector")) & F.col("vec_id").isNotNull(), F.lit(False))
    rows = rows.select("vec_id", F.when(good, F.col("vector")).alias("vector"))
    keyed = rows.select("vec_id", "vector", F.when(good, F.xxhash64("vector")).alias("h1"), F.when(good, F.xxhash64(F.lit(1), "vector")).alias("h2"))
    keyed = materialise(keyed)
    classes = keyed.where("h1 is not null").groupBy("h1", "h2").agg(
        F.min("vec_id").alias("id"), F.count("*").alias("size"), F.any_value("vector").alias("vector")
    )
    classes = materialise(classes.withColumn("dim", F.size("vector")))
    forests, counts = [], []
    for row in classes.groupBy("dim").count().collect():  # one search for each length of vectors
        shards = max(1, math.ceil(row["count"] / SHARD))
        dealt = classes.where(F.col("dim") == row["dim"]).withColumn("mixed", F.xxhash64("id", "h1"))
        dealt = dealt.withColumn("shard", F.pmod("mixed", F.lit(shards)).cast("long")).withColumn("mixed", F.xxhash64("mixed"))
        dealt = dealt.select("shard", "mixed", "id", "size", "vector").repartition(shards, "shard")
        graphs = materialise(dealt.groupBy("shard").applyInArrow(_build, _SHARDS_DDL))
        met = graphs.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))))
        met = met.withColumn("low", F.least("shard", "other")).withColumn("high", F.greatest("shard", "other"))
        met = met.repartition(max(1, shards * (shards + 1) // 2), "low", "high")
        found = materialise(met.groupBy("low", "high").applyInArrow(_query(threshold), "id long, links long, root long"))
        forests.append(found.select(F.col("id").alias("a"), F.col("root").alias("b")))
        counts.append(found.select("id", "links"))
    if not forests:
        return keyed.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    edges, linked = forests[0], counts[0]
    for e, c in zip(forests[1:], counts[1:]):
        edges, linked = edges.unionAll(e), linked.unionAll(c)
    # members of a class, and rows with one id, hang together too
    members = keyed.where("h1 is not null").select("vec_id", "h1", "h2").join(classes.select("h1", "h2", "id", "size"), ["h1", "h2"])
    members = materialise(members.select("vec_id", "id", "size"))
    edges = edges.unionAll(members.select(F.col("vec_id").alias("a"), F.col("id").alias("b")))
    named = components(edges).withColumnRenamed("node", "vec_id")
    totals = linked.groupBy("id").agg(F.sum("links").alias("links"))
    own = members.distinct().join(totals, "id", "left").groupBy("vec_id").agg(F.sum(F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("n_links"))
    whole = keyed.select("vec_id").join(own, "vec_id", "left").join(named, "vec_id", "left")
    component = F.coalesce("component", "vec_id")
    return whole.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
    )
