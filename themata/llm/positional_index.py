"""Benchmark decontamination with a distributed positional inverted index.

The index is dealt by documents: a shard holds the postings of a few megabytes of whole texts, one row per
term with its gap-coded word positions, and one row that says where each document lies. It is stored as a
table. A test item's windows are looked up shard by shard: the positions of the window's rarest term are
shifted to the window's start and intersected with the shifted lists of its other terms, rarest first, so
most windows end at an absent term. With ``slop`` every term may stand that many words from its place.

Nothing is grouped by a term: a frequent one has a bounded list in every shard. Test items are a stated query
set, taken to the tasks in blocks of bounded size. Only the terms of the test items are stored while they are
at most ``MAX_TERMS``; beyond that all terms are, with the same result.

Words are runs of letters, digits and non-ASCII characters, A-Z in lower case. An item of fewer words than a
window is one window. Defined cases: null, empty and wordless texts have no words and no hits; items without
words have no windows; repeated documents and items, also
under one id or none, are each looked up; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from themata.cluster import materialise
from themata.llm.batches import Words, blocks, record, texts, translation

WINDOW = 10

#: Distinct test terms that are held by each task to keep other terms out of the index.
MAX_TERMS = 200_000

#: Test windows taken to the tasks at once.
BLOCK_WINDOWS = 100_000

#: Positions left free between documents, so that no match crosses them.
FREE = 256

_LETTERS = translation(lower=True, apart=[c for c in range(128) if not (48 <= c < 58 or 65 <= c < 91 or 97 <= c < 123)])

_INDEX = pa.schema([
    ("shard", pa.int64()), ("term", pa.string()), ("n", pa.int64()), ("first", pa.int64()), ("width", pa.int32()), ("gaps", pa.binary()),
])

_FOUND = pa.schema([
    ("shard", pa.int64()), ("row", pa.int64()), ("doc_id", pa.int64()), ("n_words", pa.int64()),
    ("hits", pa.list_(pa.struct([("item_id", pa.int64()), ("start", pa.int64()), ("position", pa.int64()), ("length", pa.int64())]))),
])


def item_words(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """``(item_id, words)`` of the test items that have words."""
    schema = pa.schema([("item_id", pa.int64()), ("words", pa.list_(pa.string()))])

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            words = Words(block.column(1), _LETTERS)
            lists = pa.ListArray.from_arrays(pa.array(words.bounds, pa.int32()), words.vocabulary.take(pa.array(words.codes)))
            yield record(schema, block.column(0), lists)

    found = texts(items, id_col, text_col).mapInArrow(split, "item_id long, words array<string>")
    return found.where(F.size("words") > 0)


def build_index(docs: DataFrame, terms: list[str] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Index rows ``(shard, term, n, first, width, gaps)`` of all documents; those of ``terms`` only, if given.

    The row of the empty term lists the shard's documents: ids, whether null, first positions, word counts.
    """
    wanted = None if terms is None else docs.sparkSession.sparkContext.broadcast(terms)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        keep = None if wanted is None else pa.array(wanted.value, pa.string())
        for number, block in enumerate(blocks(batches)):
            words = Words(block.column(1), _LETTERS)
            starts = words.bounds[:-1] + FREE * np.arange(block.num_rows)
            ids = block.column(0)
            lists = [pc.fill_null(ids, 0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False), starts, words.counts]
            rows = [("", block.num_rows, 0, 8, np.concatenate(lists).astype("<i8").tobytes())]
            places = np.arange(len(words.codes)) + FREE * np.repeat(np.arange(block.num_rows), words.counts)
            codes = words.codes
            if keep is not None:
                mask = pc.is_in(words.vocabulary, keep).to_numpy(zero_copy_only=False)[codes]
                codes, places = codes[mask], places[mask]
            order = np.argsort(codes, kind="stable")
            codes, places = codes[order], places[order]
            cuts = np.flatnonzero(np.diff(codes, prepend=-1, append=-1)) if len(codes) else np.zeros(1, int)
            names = words.vocabulary.take(pa.array(codes[cuts[:-1]])).to_pylist()
            for name, a, b in zip(names, cuts[:-1].tolist(), cuts[1:].tolist()):
                gaps = np.diff(places[a:b])
                width = 1 if b - a < 2 else next(w for w in (1, 2, 4, 8) if gaps.max() < 256**w // (2 if w == 8 else 1))
                rows.append((name, b - a, int(places[a]), width, gaps.astype(f"<u{width}").tobytes()))
            yield record(_INDEX, [(part << 24) + number] * len(rows), *zip(*rows))

    schema = "shard long, term string, n long, first long, width int, gaps binary"
    return texts(docs, id_col, text_col).mapInArrow(index, schema)


def _postings(first: int, width: int, gaps: bytes) -> np.ndarray:
    return np.concatenate(([first], first + np.cumsum(np.frombuffer(gaps, f"<u{width}").astype(np.int64))))


def match(window: list[tuple[int, str]], lists: dict[str, np.ndarray], slop: int) -> tuple[np.ndarray, np.ndarray]:
    """First and last positions of the window's matches; ``window`` is (offset, term), rarest term first."""
    offset, term = window[0]
    if term not in lists:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    begin = lists[term] - offset
    low = high = lists[term]
    for offset, term in window[1:]:
        if term not in lists or not len(begin):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        postings = lists[term]
        at = np.searchsorted(postings, begin + offset - slop)
        place = postings[np.minimum(at, len(postings) - 1)]
        ok = (at < len(postings)) & (place <= begin + offset + slop)
        begin, place = begin[ok], place[ok]
        low, high = np.minimum(low[ok], place), np.maximum(high[ok], place)
    return low, high


def _look_up(shared, slop: int):
    """Function that looks the shared windows up in one shard."""

    def look_up(shard: pa.Table) -> pa.Table:
        lists, docs = {}, None
        for row in shard.select(["term", "first", "width", "gaps"]).to_pylist():
            if row["term"]:
                lists[row["term"]] = _postings(row["first"], row["width"], row["gaps"])
            else:
                docs = np.frombuffer(row["gaps"], "<i8").reshape(4, -1)
        ids, null, starts, counts = docs
        hits: list[list] = [[] for _ in ids]
        for item, at, terms in shared.value:
            low, high = match(terms, lists, slop)
            for d, a, b in zip((np.searchsorted(starts, low, side="right") - 1).tolist(), low.tolist(), high.tolist()):
                hits[d].append({"item_id": item, "start": at, "position": a - int(starts[d]), "length": b - a + 1})
        doc_ids = pa.array(ids, mask=null.astype(bool))
        number = shard["shard"][0].as_py()
        made = record(_FOUND, np.full(len(ids), number), np.arange(len(ids)), doc_ids, counts, hits)
        return pa.Table.from_batches([made])

    return look_up


def search(index: DataFrame, items: DataFrame, window: int = WINDOW, slop: int = 0) -> DataFrame:
    """``(doc_id, n_words, hits)`` of every document in ``index``; a hit is an item's window with its start in
    the item, and the first position and number of words of its match in the document."""
    if window + 2 * slop >= FREE:
        raise ValueError("window and slop reach across documents")
    spark = index.sparkSession
    seen = index.where("term <> ''").groupBy("term").agg(F.sum("n").alias("n"))
    # items are told apart by row, as ids may repeat or be null
    rows = items.select(F.monotonically_increasing_id().alias("key"), "item_id", "words")
    places = rows.select("key", "item_id", F.posexplode("words").alias("at", "term")).join(seen, "term", "left")
    ranked = places.groupBy("key", "item_id", "at", "term").agg(F.max(F.coalesce("n", F.lit(0))).alias("n"))
    ordered = ranked.groupBy("key", "item_id").agg(F.sort_array(F.collect_list(F.struct("at", "term", "n"))).alias("words"))
    results = []
    for block in _window_blocks(ordered, window):
        look_up = _look_up(spark.sparkContext.broadcast(block), slop)
        results.append(index.groupBy("shard").applyInArrow(look_up, (
            "shard long, row long, doc_id long, n_words long, "
            "hits array<struct<item_id: long, start: long, position: long, length: long>>"
        )))
    if len(results) == 1:
        return results[0].drop("shard", "row")
    joined = results[0]
    for more in results[1:]:
        joined = joined.unionAll(more)
    whole = joined.groupBy("shard", "row").agg(
        F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"), F.flatten(F.collect_list("hits")).alias("hits")
    )
    return whole.drop("shard", "row")


def _window_blocks(ordered: DataFrame, window: int) -> Iterator[list]:
    """Windows ``(item_id, start, [(offset, term), ...])`` with the rarest term first, in bounded blocks."""
    block: list = []
    given = False
    for row in ordered.toLocalIterator():
        words = row["words"]
        for start in range(max(1, len(words) - window + 1)):
            own = sorted((w["n"], i, w["term"]) for i, w in enumerate(words[start : start + window]))
            block.append((row["item_id"], start, [(i, term) for _, i, term in own]))
        if len(block) >= BLOCK_WINDOWS:
            yield block
            block, given = [], True
    if block or not given:
        yield block


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, slop: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Hits of the benchmark's windows in all documents, see ``search``."""
    items = materialise(item_words(benchmark))
    distinct = items.select(F.explode("words").alias("term")).distinct()
    terms = [r["term"] for r in distinct.limit(MAX_TERMS + 1).collect()]
    index = materialise(build_index(docs, terms if len(terms) <= MAX_TERMS else None, id_col, text_col))
    return search(index, items, window, slop)
