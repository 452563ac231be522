"""Removal of repeated word windows by super-k-mer partitioning.

A window is ``window`` consecutive words of one document. Its minimiser is the smallest hash of ``MERS`` words in
it; consecutive windows that share a minimiser travel together as one packed string (a super-k-mer) to the
minimiser's bucket, so equal windows meet. A bucket sorts its windows, compares equal hashes word by word, and
reports every window that is not the first of its kind. Documents are ordered by id.

Equal super-k-mers of a block of text are joined before the shuffle: only the earliest travels, the windows of
the others are reported at once. So a passage that fills a third of all documents sends one string per block.
Buckets follow the bytes of the input and are grouped one at a time; strings are compressed per block and bucket.

A hash so frequent that its windows could fill a bucket (``HOT_BYTES``; bytes are counted over all texts first) is
nobody's minimiser but where a window holds no other; such windows go by the smallest hash of half a window. Both
follow from the window's words alone, so equal windows still meet; the counts only decide the cost.

Defined cases: null, empty and short texts keep all their words; documents are told apart by id and, where ids
repeat, by text, then ordered by a hash of it; rows that repeat id and text are one document and get its result;
a null id comes first; an empty table gives an empty table.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from itertools import compress

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from themata.cluster import materialise
from themata.llm.batches import Words, blocks, gather, record, steps, texts

WINDOW = 20

#: Words in a minimiser.
MERS = 3

#: Bytes of input text per bucket; its super-k-mers hold about three times as many.
BUCKET_BYTES = 4 << 20

#: Bytes of windows that one minimiser may bring to its bucket before the joining of equal strings.
HOT_BYTES = 4 << 20

#: Bytes of text whose hashes are counted at once.
COUNTED_BYTES = 1 << 19

#: Counters of the table of frequent hashes (a power of two). More of them keep rare hashes apart on larger corpora.
COUNTERS = 1 << 22

#: Marks what goes behind all unmarked hashes.
LAST = np.uint64(1 << 63)

_ODD = np.array([0x9E3779B97F4A7C15], np.uint64)  # an array, as these products are meant to wrap around

_PACKED = pa.schema([
    ("bucket", pa.int64()), ("strings", pa.binary()), ("docs", pa.binary()), ("digests", pa.binary()), ("starts", pa.binary()), ("runs", pa.binary()),
])
_SPANS = pa.schema([("id", pa.int64()), ("digest", pa.int64()), ("start", pa.int32()), ("n", pa.int32())])
_SPANS_DDL = "id long, digest long, start int, n int"


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every bit of 64-bit values over all others."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours, by doubling."""
    have = 1
    low = x
    while have * 2 <= width:
        low = np.minimum(low[:-have], low[have:])
        have *= 2
    rest = width - have
    return np.minimum(low[: len(low) - rest], low[rest:]) if rest else low


def rolling_hash(x: np.ndarray, width: int) -> np.ndarray:
    """Polynomial hash of every ``width`` neighbours, by doubling."""
    power, have, whole = _ODD, 1, x
    taken, result = 0, None
    while True:
        if width & have:
            if result is None:
                result = whole
            else:
                n = len(x) - taken - have + 1
                result = result[:n] * power + whole[taken : taken + n]
            taken += have
        if taken == width:
            return result
        whole = whole[: len(whole) - have] * power + whole[have:]
        power, have = power * power, have * 2


def frequent(rows: DataFrame, grams: Callable, size: int) -> np.ndarray | None:
    """For each counter whether its hashes are frequent, None if none is; ``grams`` gives the hashes of a block of
    texts and the bytes of the windows around each, ``size`` is the bytes of all texts.

    One table per task; only counters that matter leave it, those under a thousandth of the bound, or less on
    inputs of many tasks, add up to no more than half of it.
    """
    floor = HOT_BYTES // max(1000, size >> 22) // 2
    schema = pa.schema([("slot", pa.int64()), ("bytes", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(COUNTERS, np.int64)
        for block in blocks(batches, COUNTED_BYTES):
            hashes, around = grams(block)
            if len(hashes):
                np.add.at(table, (hashes & np.uint64(COUNTERS - 1)).astype(np.int64), around)
        slots = np.flatnonzero(table > floor)
        for at in range(0, len(slots), 1 << 16):
            yield record(schema, slots[at : at + (1 << 16)], table[slots[at : at + (1 << 16)]])

    counted = rows.mapInArrow(count, "slot long, bytes long").groupBy("slot").agg(F.sum("bytes").alias("bytes"))
    # a counter also holds its share of all other hashes
    bound = HOT_BYTES // 2 + size * WINDOW * 8 // COUNTERS
    slots = counted.where(F.col("bytes") > bound).select("slot").toArrow().column(0).to_numpy()  # at most all counters
    if not len(slots):
        return None
    table = np.zeros(COUNTERS, bool)
    table[slots] = True
    return table


def shared(rows: DataFrame, table: np.ndarray | None):
    """Broadcast of the table, None if there is none."""
    return None if table is None else rows.sparkSession.sparkContext.broadcast(table)


def demoted(hashes: np.ndarray, hot: np.ndarray) -> np.ndarray:
    """``hashes`` with those that are frequent behind all others."""
    return hashes >> np.uint64(1) | np.where(hot[(hashes & np.uint64(COUNTERS - 1)).astype(np.int64)], LAST, np.uint64(0))


def _word_hashes(words: Words) -> np.ndarray:
    return pd.util.hash_array(words.vocabulary.to_numpy(zero_copy_only=False)).astype(np.uint64)[words.codes]


def _word_grams(window: int):
    """Hashes of ``MERS`` words in a block, and the bytes of the windows around each."""

    def grams(block: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        words = Words(block.column(1))
        n = len(words.codes)
        if n < window:
            return np.empty(0, np.uint64), np.empty(0, np.int64)
        lengths = pc.binary_length(words.vocabulary).to_numpy(zero_copy_only=False).astype(np.int64)[words.codes] + 1
        ends = np.concatenate(([0], np.cumsum(lengths)))
        at = np.arange(n - MERS + 1)
        around = ends[np.minimum(at + window, n)] - ends[np.maximum(at + MERS - window, 0)]
        return mix(rolling_hash(_word_hashes(words), MERS)), around

    return grams


def _packer(window: int, buckets: int, frequent_):
    """Function from text blocks to packed super-k-mers per bucket, and the spans found in the block itself."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=1).compress
        task = TaskContext.get().partitionId()
        for number, block in enumerate(blocks(batches)):
            words = Words(block.column(1))
            counts, n = words.counts, len(words.codes)
            if n < window:
                continue
            hashes = _word_hashes(words)
            grams = mix(rolling_hash(hashes, MERS))
            least = sliding_min(grams if frequent_ is None else demoted(grams, frequent_.value), window - MERS + 1)
            if frequent_ is not None and (least >= LAST).any():
                half = max(MERS, window // 2)
                far = sliding_min(mix(rolling_hash(hashes, half)), window - half + 1)
                least = np.where(least >= LAST, far | LAST, least)
            doc = np.repeat(np.arange(block.num_rows), counts)[: len(least)]
            valid = np.arange(len(least)) + window <= words.bounds[doc + 1]
            new = valid.copy()
            new[1:] &= ~valid[:-1] | (least[1:] != least[:-1]) | (doc[1:] != doc[:-1])
            starts = np.flatnonzero(new)
            if not len(starts):
                continue
            # a run ends where the next one begins or the first invalid window follows
            stops = np.minimum(np.append(starts[1:], len(least)), words.bounds[doc[starts] + 1] - window + 1)
            runs, place = stops - starts, starts - words.bounds[doc[starts]]
            ids, digests = block.column(0).to_numpy()[doc[starts]], block.column(2).to_numpy()[doc[starts]]
            spaced = pc.binary_join_element_wise(words.vocabulary, "", " ")
            flat, ends = np.frombuffer(spaced.buffers()[2], np.uint8), np.frombuffer(spaced.buffers()[1], np.int32)
            canon, after = gather(flat, ends[: len(spaced)], np.diff(ends[: len(spaced) + 1]), words.codes)
            canon, after = canon.tobytes(), np.concatenate(([0], after))
            first, last = after[starts].tolist(), (after[stops + window - 1] - 1).tolist()
            bucket = (least[starts] % np.uint64(buckets)).astype(np.int64)
            order = np.lexsort((place, digests, ids))
            strings: list[bytes] = []
            seen: dict[bytes, int] = {}
            sent, again = [], []
            for i in order.tolist():
                string = canon[first[i] : last[i]]
                j = seen.setdefault(string, i)
                if j == i:
                    sent.append(i)
                    strings.append(string)
                elif ids[i] != ids[j] or digests[i] != digests[j] or place[i] != place[j]:
                    again.append(i)
            rows = []
            sent = np.array(sent)
            by_bucket = np.argsort(bucket[sent], kind="stable")
            cuts = np.flatnonzero(np.diff(bucket[sent][by_bucket], prepend=-1, append=-1))
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                at = by_bucket[a:b]
                own = sent[at]
                rows.append((
                    int(bucket[own[0]]), squeeze(b"\n".join([strings[k] for k in at.tolist()])), squeeze(ids[own].astype("<i8").tobytes()),
                    squeeze(digests[own].astype("<i8").tobytes()), squeeze(place[own].astype("<i4").tobytes()), squeeze(runs[own].astype("<u4").tobytes()),
                ))
            if again:  # already known to repeat; goes through the shuffle next to the buckets
                own = np.array(again)
                rows.append((
                    buckets + (task * 65_537 + number) % buckets, b"", squeeze(ids[own].astype("<i8").tobytes()),
                    squeeze(digests[own].astype("<i8").tobytes()), squeeze(place[own].astype("<i4").tobytes()), squeeze(runs[own].astype("<u4").tobytes()),
                ))
            yield record(_PACKED, *zip(*rows))

    return pack


def _repeats(ids, digests, starts) -> pa.Table:
    """Spans of consecutive windows, from single windows in any order."""
    order = np.lexsort((starts, digests, ids))
    ids, digests, starts = ids[order], digests[order], starts[order]
    new = np.ones(len(ids), bool)
    new[1:] = (ids[1:] != ids[:-1]) | (digests[1:] != digests[:-1]) | (starts[1:] > starts[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(ids))[: len(first)] - 1
    return pa.Table.from_batches([record(_SPANS, ids[first], digests[first], starts[first], starts[last] - starts[first] + 1)])


def _same_windows(codes: np.ndarray, at: np.ndarray, hashes: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Windows that occur more than once (as places in ``at``) and a group number for each, compared exactly."""
    order = np.argsort(hashes, kind="stable")
    same = hashes[order][1:] == hashes[order][:-1]
    group = np.concatenate(([0], np.cumsum(~same)))
    keep = np.concatenate((same, [False])) | np.concatenate(([False], same))
    order, group = order[keep], group[keep]
    if len(order):
        pairs = np.flatnonzero(group[1:] == group[:-1])
        left, right = at[order[pairs]], at[order[pairs + 1]]
        differ = np.zeros(len(pairs), bool)
        for k in range(window):
            differ |= codes[left + k] != codes[right + k]
        if differ.any():  # equal hashes of different windows: number these groups by their words
            odd = np.isin(group, group[pairs[differ]])
            rows = np.column_stack([group[odd], codes[at[order[odd]][:, None] + np.arange(window)]])
            group[odd] = group.max() + 1 + np.unique(rows, axis=0, return_inverse=True)[1].ravel()
    return order, group


def _unpacker(window: int, buckets: int):
    """Function from a bucket's super-k-mers to the spans of windows that occur earlier."""

    def unpack(table: pa.Table) -> pa.Table:
        expand = zstandard.ZstdDecompressor().decompress
        column = lambda name, kind: np.concatenate([
            np.frombuffer(expand(v), kind) for v in table[name].to_pylist()
        ]).astype(np.int64)
        ids, digests = column("docs", "<i8"), column("digests", "<i8")
        starts, runs = column("starts", "<i4"), column("runs", "<u4")
        if table["bucket"][0].as_py() >= buckets:
            return _repeats(np.repeat(ids, runs), np.repeat(digests, runs), np.repeat(starts, runs) + steps(runs))
        strings = b"\n".join([expand(v) for v in table["strings"].to_pylist()])
        lines = pc.split_pattern(pa.array([strings], pa.large_string()), "\n").flatten()
        lists = pc.split_pattern(lines, " ")
        coded = lists.flatten().dictionary_encode()
        codes = coded.indices.to_numpy()
        hashes = rolling_hash(mix((np.arange(len(coded.dictionary), dtype=np.uint64) + np.uint64(1)) * _ODD)[codes], window)
        first = lists.offsets.to_numpy()[:-1].astype(np.int64)
        run = np.repeat(np.arange(len(runs)), runs)
        offset = steps(runs)
        at = first[run] + offset
        which, group = _same_windows(codes, at, hashes[at], window)
        run, start = run[which], starts[run[which]] + offset[which]
        order = np.lexsort((start, digests[run], ids[run], group))
        run, start, group = run[order], start[order], group[order]
        head = np.maximum.accumulate(np.where(np.diff(group, prepend=-1) != 0, np.arange(len(group)), 0))
        later = (ids[run] != ids[run[head]]) | (digests[run] != digests[run[head]]) | (start != start[head]) if len(run) else np.zeros(0, bool)
        return _repeats(ids[run[later]], digests[run[later]], start[later])

    return unpack


def repeated_spans(rows: DataFrame, window: int = WINDOW) -> DataFrame:
    """``(id, digest, start, n)``: ``n`` consecutive windows from word ``start`` that each occur earlier."""
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(1, math.ceil(size / BUCKET_BYTES))
    schema = "bucket long, strings binary, docs binary, digests binary, starts binary, runs binary"
    packed = rows.mapInArrow(_packer(window, buckets, shared(rows, frequent(rows, _word_grams(window), size))), schema)
    return packed.groupBy("bucket").applyInArrow(_unpacker(window, buckets), _SPANS_DDL)


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(id, text, digest)``; the digest is 0 as long as no id repeats, a null id is the smallest long."""
    rows = texts(docs, id_col, text_col).withColumn("id", F.coalesce("id", F.lit(-(2**63))))
    ids = docs.select(F.col(f"`{id_col}`").alias("id")).groupBy("id").count()
    repeated = not ids.where("count > 1").isEmpty()
    return rows.withColumn("digest", F.xxhash64("text") if repeated else F.lit(0).cast("long"))


def remove_repeats(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_words, n_removed, kept)``; ``kept`` is the remaining words joined by single spaces."""
    rows = keyed(docs, id_col, text_col)
    spans = materialise(repeated_spans(rows, window))
    listed = spans.groupBy("id", "digest").agg(F.collect_list("start").alias("starts"), F.collect_list("n").alias("ns"))
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string())])

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks([batch]):
                out = []
                for i, text, starts, ns in zip(*(c.to_pylist() for c in block.columns)):
                    words = text.encode().split()
                    n_removed = 0
                    n_words = len(words)
                    if starts:
                        change = np.zeros(n_words + 1, np.int64)
                        np.add.at(change, starts, 1)
                        np.add.at(change, np.add(starts, ns) + window - 1, -1)
                        left = np.cumsum(change[:-1]) == 0
                        n_removed = n_words - int(left.sum())
                        words = compress(words, left.tolist())
                    out.append((None if i == -(2**63) else i, n_words, n_removed, b" ".join(words).decode()))
                yield record(schema, *zip(*out))

    joined = rows.join(listed, ["id", "digest"], "left").select("id", "text", "starts", "ns")
    return joined.mapInArrow(keep, "doc_id long, n_words long, n_removed long, kept string")
