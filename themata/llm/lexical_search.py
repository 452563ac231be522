"""Ranked lexical search of a whole corpus by dense blocked multiplication.

The items' terms are the columns of the work: each document becomes its counts of those terms, and its number of all
terms, in one pass over the texts, stored for what follows. Numbers of documents and terms and document frequencies
are combined aggregates over that table. A score is then an element of a matrix product, item weights times document
impacts. Tasks multiply tile by tile: up to ``TILE_ITEMS`` items with the vocabulary that they share, compacted, times
the impacts of ``TILE_DOCS`` documents, in float64 by BLAS. Weights and impacts are integers, and a tile's vocabulary
is cut where a sum over it could reach 2^53, so every product is exact whatever the order of additions; the sums of
the cuts are added in 64-bit integers. Each task keeps the best documents of each item, by score and id, and a shuffle
in two steps merges them.

Items are read in rounds of at most ``ROUND_TERMS`` distinct terms and ``ROUND_WORDS`` words (a single longer item is
a round of its own); a round's items are what is broadcast. Documents are read once a round.

Defined cases: null and empty texts have no terms; a document without a term of an item has no score for it, an item
without terms or without scored documents gives no rows. Equal scores rank by ascending id, a null id last; rows with
one id rank one after the other. Items are told apart by row, so repeated or null item ids each get their own ranks.
Empty tables give no rows. Other columns are not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from themata.cluster import materialise
from themata.llm.batches import Words, blocks, record, steps, texts, translation
from themata.llm.topk import Best

ROUND_TERMS = 1 << 20
ROUND_WORDS = 1 << 22
TILE_ITEMS = 128
TILE_TERMS = 4096
TILE_DOCS = 1024

#: Sums of products below this are exact in float64.
EXACT = 1 << 53

#: Impacts are below this, as 10^9 tf div (10^3 tf + 8 m) shows.
MAX_IMPACT = 1_000_000

#: Partial results of an item are merged in so many groups first.
MERGE = 64

_LETTERS = translation(lower=True, apart=[*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])


def terms_of(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """``(item, item_id, terms)`` of the items that have any, in text order; ``item`` numbers the rows."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("item_id", pa.int64()), ("terms", pa.list_(pa.string()))])
        for block in blocks(batches):
            words = Words(block.column(1), _LETTERS)
            lists = pa.ListArray.from_arrays(pa.array(words.bounds, pa.int32()), words.vocabulary.take(pa.array(words.codes)))
            yield record(schema, block.column(0), lists)

    found = texts(items, id_col, text_col).mapInArrow(split, "item_id long, terms array<string>").where(F.size("terms") > 0)
    return materialise(found.select(F.monotonically_increasing_id().alias("item"), "item_id", "terms"))


def rounds(items: DataFrame) -> Iterator[list]:
    """Rows of ``terms_of`` in groups of bounded vocabulary and length."""
    group: list = []
    seen: set = set()
    words = 0
    for row in items.toLocalIterator():
        own = set(row["terms"])
        if group and (len(seen | own) > ROUND_TERMS or words + len(row["terms"]) > ROUND_WORDS):
            yield group
            group, seen, words = [], set(), 0
        group.append(row)
        seen |= own
        words += len(row["terms"])
    if group:
        yield group


def term_counts(docs: DataFrame, vocabulary: list[str], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(row, doc_id, n, codes, counts)`` of every document, as a stage table: the number of all its terms, and the
    places in ``vocabulary`` of the terms it holds with their occurrences."""
    known = docs.sparkSession.sparkContext.broadcast(vocabulary)
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("codes", pa.list_(pa.int32())), ("counts", pa.list_(pa.int64()))])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = pa.array(known.value, pa.string())
        size = max(1, len(wanted))
        for block in blocks(batches):
            words = Words(block.column(1), _LETTERS)
            code = pc.fill_null(pc.index_in(words.vocabulary, wanted), -1).to_numpy(zero_copy_only=False).astype(np.int64)[words.codes]
            owner = np.repeat(np.arange(block.num_rows), words.counts)
            cells, found = np.unique((owner * size + code)[code >= 0], return_counts=True)
            ends = np.searchsorted(cells, size * np.arange(block.num_rows + 1)).astype(np.int32)
            lists = [pa.ListArray.from_arrays(pa.array(ends), pa.array(v)) for v in ((cells % size).astype(np.int32), found.astype(np.int64))]
            yield record(schema, block.column(0), pa.array(words.counts.astype(np.int64)), *lists)

    made = texts(docs, id_col, text_col).mapInArrow(count, "doc_id long, n long, codes array<int>, counts array<long>")
    return materialise(made.select(F.monotonically_increasing_id().alias("row"), "*"))


@dataclass
class Tile:
    """Items times vocabulary: ``weights[i, j]`` is that of item ``items[i]`` for the term ``codes[j]``. Columns are
    cut at ``cuts`` so that no sum over a part, times the largest impact, can reach 2^53."""

    items: np.ndarray
    codes: np.ndarray
    weights: np.ndarray
    cuts: list[int]


def tiles(items: list[tuple[np.ndarray, np.ndarray]], limit: int = EXACT // MAX_IMPACT - 1) -> list[Tile]:
    """Tiles of items given as (codes, weights times repeats). A weight above ``limit`` takes several columns."""
    out: list[Tile] = []
    begin = 0
    while begin < len(items):
        stop, codes = begin, np.empty(0, np.int64)
        while stop < len(items) and stop - begin < TILE_ITEMS:
            more = np.union1d(codes, items[stop][0])
            if stop > begin and len(more) > TILE_TERMS:
                break
            codes, stop = more, stop + 1
        weights = np.zeros((stop - begin, len(codes)), np.int64)
        for i, (own, w) in enumerate(items[begin:stop]):
            weights[i, np.searchsorted(codes, own)] = w
        columns, parts = [codes], [np.minimum(weights, limit)]
        while (weights > limit).any():
            weights = np.maximum(weights - limit, 0)
            rest = np.flatnonzero(weights.any(axis=0))
            columns.append(codes[rest])
            parts.append(np.minimum(weights, limit)[:, rest])
        codes, whole = np.concatenate(columns), np.concatenate(parts, axis=1)
        cuts, sums = [0], np.zeros(len(whole), np.int64)
        for j in range(len(codes)):
            grown = sums + whole[:, j]
            if j > cuts[-1] and (j - cuts[-1] >= TILE_TERMS or grown.max() > limit):
                cuts.append(j)
                grown = whole[:, j].copy()
            sums = grown
        out.append(Tile(np.arange(begin, stop), codes, whole.astype(float), [*cuts, len(codes)]))
        begin = stop
    return out


def impacts(counts: np.ndarray, n: np.ndarray, total_docs: int, total_terms: int) -> np.ndarray:
    """10^9 tf div (10^3 tf + 8 m), with m = 100 - 75 + 75 n N div L."""
    m = 100 - 75 + (75 * n * total_docs) // total_terms
    return (1_000_000_000 * counts) // (1000 * counts + 8 * m)


class Block:
    """Up to ``TILE_DOCS`` documents as triples sorted by term, ready to fill dense tiles."""

    def __init__(self, batch: pa.RecordBatch, total_docs: int, total_terms: int):
        n = batch.column(2).to_numpy(zero_copy_only=False)
        lengths = pc.list_value_length(batch.column(3)).to_numpy(zero_copy_only=False)
        codes, counts = (batch.column(i).flatten().to_numpy(zero_copy_only=False) for i in (3, 4))
        docs = np.repeat(np.arange(batch.num_rows), lengths)
        values = impacts(counts.astype(np.int64), n[docs], total_docs, total_terms)
        order = np.argsort(codes, kind="stable")
        self.rows, self.n_docs = batch.column(0).to_numpy(zero_copy_only=False), batch.num_rows
        self.ids = pc.fill_null(batch.column(1), 0).to_numpy(zero_copy_only=False)
        self.null = batch.column(1).is_null().to_numpy(zero_copy_only=False)
        self.codes, self.docs, self.values = codes[order], docs[order], values[order].astype(float)

    def dense(self, codes: np.ndarray) -> np.ndarray:
        """Impacts of the terms ``codes`` in all documents of the block."""
        starts, ends = np.searchsorted(self.codes, codes), np.searchsorted(self.codes, codes, side="right")
        lengths = ends - starts
        place = np.repeat(starts, lengths) + steps(lengths)
        out = np.zeros((len(codes), self.n_docs))
        out[np.repeat(np.arange(len(codes)), lengths), self.docs[place]] = self.values[place]
        return out

    def scores(self, tile: Tile) -> np.ndarray:
        total = np.zeros((len(tile.items), self.n_docs), np.int64)
        for a, b in zip(tile.cuts, tile.cuts[1:]):
            total += (tile.weights[:, a:b] @ self.dense(tile.codes[a:b])).astype(np.int64)
        return total


#: What a task returns, for Spark and for Arrow.
_FOUND = "part int, item int, score long, doc_id long, row long"
_SCHEMA = pa.schema([("part", pa.int32()), ("item", pa.int32()), ("score", pa.int64()), ("doc_id", pa.int64()), ("row", pa.int64())])


def _multiply(shared, k: int, total_docs: int, total_terms: int):
    """Function over batches of ``term_counts``: the best documents of each item among a task's."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = shared.value
        n_items = sum(len(t.items) for t in work)
        best = Best(n_items, k, np.int64)
        for batch in batches:
            for begin in range(0, batch.num_rows, TILE_DOCS):
                block = Block(batch.slice(begin, TILE_DOCS), total_docs, total_terms)
                for tile in work:
                    scores = block.scores(tile)
                    i, d = np.nonzero(scores >= np.maximum(best.floor[tile.items], 1)[:, None])
                    best.offer(tile.items[i], scores[i, d], block.null[d], block.ids[d], block.rows[d])
                best.settle()
        items, scores, null, ids, rows = best.entries
        part = TaskContext.get().partitionId() % MERGE
        yield record(_SCHEMA, np.full(len(items), part), items, scores, pa.array(ids, mask=null), rows)

    return search


def ranked(found: DataFrame, keys: list[str], order: list, k: int) -> DataFrame:
    """The first ``k`` rows of each key with their ``rank``; parts of the tasks are merged before all meet."""
    window = lambda *by: Window.partitionBy(*by).orderBy(*order)
    merged = found.withColumn("rank", F.row_number().over(window("part", *keys))).where(F.col("rank") <= k).drop("rank", "part")
    return merged.withColumn("rank", F.row_number().over(window(*keys))).where(F.col("rank") <= k)


def search(docs: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """``(item_id, rank, doc_id, score)``: the ``k`` documents of highest score above 0 for each row of ``items``."""
    spark = docs.sparkSession
    results = []
    for group in rounds(terms_of(items, item_col, item_text_col)):
        vocabulary = sorted({t for row in group for t in row["terms"]})
        place = {t: i for i, t in enumerate(vocabulary)}
        counted = term_counts(docs, vocabulary, id_col, text_col)
        total = counted.agg(F.count_if(F.col("n") > 0).alias("docs"), F.sum("n").alias("terms")).first()
        if not total["docs"]:
            continue
        frequency = counted.select(F.explode("codes").alias("code")).groupBy("code").count()
        df = np.zeros(len(vocabulary), np.int64)
        for row in frequency.toLocalIterator():  # one row a term of the round
            df[row["code"]] = row["count"]
        weight = np.array([math.floor(1000 * math.log((2 * total["docs"] + 2) / (2 * n + 1))) for n in df.tolist()], np.int64)
        made = []
        for row in group:
            codes, repeats = np.unique([place[t] for t in row["terms"]], return_counts=True)
            made.append((codes, weight[codes] * repeats))
        work = spark.sparkContext.broadcast(tiles(made))
        held = counted.where(F.size("codes") > 0).select("row", "doc_id", "n", "codes", "counts")
        found = held.mapInArrow(_multiply(work, k, total["docs"], total["terms"]), _FOUND)
        best = ranked(found, ["item"], [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("row")], k)
        names = spark.createDataFrame([(i, row["item_id"]) for i, row in enumerate(group)], "item int, item_id long")
        results.append(materialise(best.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")))  # a round's items
    if not results:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    whole = results[0]
    for more in results[1:]:
        whole = whole.unionAll(more)
    return whole
