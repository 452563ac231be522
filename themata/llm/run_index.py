"""Removal of repeated byte strings with run-length Burrows-Wheeler indexes.

A match is ``WINDOW`` bytes that also start earlier (smaller id, or same document further ahead). Every window has a
minimiser, the smallest hash of ``GRAM`` bytes in it; consecutive windows of a document with one minimiser travel
as one segment to the minimiser's bucket, so equal windows meet there. Equal segments of a block of text are joined
before the shuffle, equal segments of a bucket after it.

A gram so frequent that its windows could fill a bucket is nobody's minimiser but where a window holds no other;
such windows go by the smallest hash of half a window, see ``superkmer``.

Segments that hold their minimiser once and share it with no other segment have no window of another one, nor one
twice. Nor does a window that holds half a window which stands once in the bucket; segments are cut there. Over the
rest, which is the repetitive part of the corpus, a bucket builds a run-length Burrows-Wheeler transform: rotations
are sorted to the window's depth, equal symbols in a row are one run, counts are kept per run, and every place
where neighbours part within one symbol less than a window is sampled. Then all strings are streamed backwards
through the index: an interval is extended by the next symbol and shrunk to one symbol less, which is the matching
statistic cut at the window's length. Windows of one content end in one interval; all but the earliest occurrence
of its windows are marked.

Only documents with spans meet them by a shuffle. A filter of their ids, of bounded size, tells the others, which
pass straight through.

Defined cases: null, empty and short texts keep all their bytes; documents are told apart by id and, where ids
repeat, by text, then ordered by a hash of it; rows that repeat id and text are one document and get its result;
a null id comes first; an empty table gives an empty table.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from themata.cluster import materialise
from themata.llm.batches import blocks, gather, record, steps
from themata.llm.superkmer import _SPANS_DDL, LAST, _repeats, demoted, frequent, keyed, mix, shared, sliding_min

WINDOW = 100

#: Bytes in a minimiser.
GRAM = 16

_PLACE = np.uint64((1 << 24) - 1)

#: Bytes of input text per bucket.
BUCKET_BYTES = 4 << 20

#: Bytes of text hashed at once.
PART_BYTES = 1 << 18

#: Bits of a bitmap, and bitmaps (of 4 KB) at most, in the filter of documents with spans.
PAGE_BITS = 1 << 15
MAX_PAGES = 1 << 13

_PACKED = pa.schema([
    ("bucket", pa.int64()), ("text", pa.binary()), ("lengths", pa.binary()), ("marks", pa.binary()), ("docs", pa.binary()),
    ("digests", pa.binary()), ("starts", pa.binary()),
])


def _grams(data: np.ndarray) -> np.ndarray:
    """Hash of the ``GRAM`` bytes from each place."""
    n = len(data) - 7
    eight = np.empty(n, np.uint64)
    for shift in range(8):
        part = data[shift : shift + (len(data) - shift) // 8 * 8]
        eight[shift::8] = part.view("<u8")
    return mix(eight[: n - 8] * np.uint64(0x9E3779B97F4A7C15) + eight[8:])


def _far(grams: np.ndarray, length: int) -> np.ndarray:
    """Hash of ``length`` bytes from each place, by those of the grams in them."""
    n = len(grams) - length + GRAM
    total = np.zeros(n, np.uint64)
    for at in [*range(0, length - GRAM, GRAM), length - GRAM]:
        total = total * np.uint64(0x9E3779B97F4A7C15) + grams[at : at + n]
    return mix(total)


def _data(block: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a block's texts and where each begins and ends."""
    column = block.column(1).cast(pa.binary())
    ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return np.frombuffer(column.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]], ends - ends[0]


def _byte_grams(window: int):
    """Hashes of ``GRAM`` bytes in a block, and the bytes of the windows around each."""

    def grams(block: pa.RecordBatch) -> tuple[np.ndarray, int]:
        data, _ = _data(block)
        hashes = np.empty(len(data) - GRAM + 1 if len(data) >= window else 0, np.uint64)
        for at in range(0, len(hashes), PART_BYTES):
            hashes[at : at + PART_BYTES] = _grams(data[at : at + PART_BYTES + GRAM - 1]) >> np.uint64(24)
        return hashes, 2 * window - GRAM

    return grams


def _segments(data: np.ndarray, bounds: np.ndarray, window: int, hot: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
    """Document, first byte, last byte (exclusive), minimiser of each segment of a block, and whether the minimiser
    may stand in the segment more than once. Below the minimiser's 40 bits the place is packed, from either side."""
    none = np.empty(0, np.int64)
    if len(data) < window:
        return none, none, none, none, none.astype(bool)
    whole, width = _grams(data), window - GRAM + 1
    grams = whole & ~_PLACE
    if hot is not None:
        low = demoted(whole >> np.uint64(24), hot)  # 39 bits and the mark
        grams = low << np.uint64(24) | low & LAST
    place = np.arange(len(grams), dtype=np.uint64) & _PLACE
    leftmost = sliding_min(grams | place, width)
    rightmost = sliding_min(grams | (_PLACE - place), width)
    least = leftmost >> np.uint64(24)
    behind = np.zeros(len(least), bool)
    if hot is not None:
        behind = leftmost >= LAST
        if behind.any():
            half = max(GRAM, window // 2)
            far = sliding_min(_far(whole, half), window - half + 1)
            least = np.where(behind, (far | LAST) >> np.uint64(24), least)
    lengths = np.diff(bounds)
    new = np.empty(len(least), bool)
    new[0] = True
    np.not_equal(least[1:], least[:-1], out=new[1:])
    new[bounds[:-1][(lengths >= window)]] = True
    closed = np.zeros(len(least) + 1, np.int8)  # windows that reach into the next document
    low = np.minimum(np.maximum(bounds[1:] - window + 1, bounds[:-1]), len(least))
    np.add.at(closed, low, 1)
    np.add.at(closed, np.minimum(bounds[1:], len(least)), -1)
    valid = np.cumsum(closed[:-1], dtype=np.int32) == 0
    starts = np.flatnonzero(new & valid)
    doc = np.searchsorted(bounds, starts, side="right") - 1
    stops = np.minimum(np.append(starts[1:], len(least))[: len(starts)], bounds[doc + 1] - window + 1)
    twice = behind[starts] | ((leftmost[starts] & _PLACE) != _PLACE - (rightmost[stops - 1] & _PLACE))
    return doc, starts, stops + window - 1, least[starts].astype(np.int64), twice


def _all_segments(data: np.ndarray, bounds: np.ndarray, window: int, hot: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
    """``_segments``, some documents of about ``PART_BYTES`` at a time, so that its arrays stay small."""
    found, low = [], 0
    while low < len(bounds) - 1:
        high = max(low + 1, int(np.searchsorted(bounds, bounds[low] + PART_BYTES, side="right")) - 1)
        doc, first, last, least, twice = _segments(data[bounds[low] : bounds[high]], bounds[low : high + 1] - bounds[low], window, hot)
        found.append((doc + low, first + bounds[low], last + bounds[low], least, twice))
        low = high
    return tuple(map(np.concatenate, zip(*found)))


def _packer(window: int, buckets: int, frequent_):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=1).compress
        task = TaskContext.get().partitionId()
        for number, block in enumerate(blocks(batches)):
            data, bounds = _data(block)
            doc, first, last, least, twice = _all_segments(data, bounds, window, None if frequent_ is None else frequent_.value)
            if not len(doc):
                continue
            raw = data.tobytes()
            ids, digests, place = block.column(0).to_numpy()[doc], block.column(2).to_numpy()[doc], first - bounds[doc]
            bucket = least % buckets
            marks = least // buckets & 0x7FFFFFFF | twice * (1 << 31)
            seen: dict[bytes, int] = {}
            kept, again = [], []
            order = np.lexsort((place, digests, ids)).tolist()
            begin, end = first.tolist(), last.tolist()
            for i in order:
                j = seen.setdefault(raw[begin[i] : end[i]], i)
                if j == i:
                    kept.append(i)
                elif ids[i] != ids[j] or digests[i] != digests[j] or place[i] != place[j]:
                    again.append(i)
            del seen, order
            kept = np.array(kept)
            kept = kept[np.argsort(bucket[kept], kind="stable")]
            cuts = np.flatnonzero(np.diff(bucket[kept], prepend=-1, append=-1)) if len(kept) else np.zeros(1, int)
            parts = [(int(bucket[kept[a]]), kept[a:b], True) for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())]
            if again:  # known to repeat already; rides next to the buckets
                parts.append((buckets + (task * 65_537 + number) % buckets, np.array(again), False))
            rows = []
            for name, own, with_text in parts:
                text = b"".join([raw[begin[i] : end[i]] for i in own.tolist()]) if with_text else b""
                rows.append((
                    name, squeeze(text), squeeze((last - first)[own].astype("<i4").tobytes()), marks[own].astype("<u4").tobytes() if with_text else b"",
                    squeeze(ids[own].astype("<i8").tobytes()), squeeze(digests[own].astype("<i8").tobytes()), squeeze(place[own].astype("<i4").tobytes()),
                ))
            packed = record(_PACKED, *zip(*rows))
            del raw, rows, begin, end
            yield packed

    return pack


class RunIndex:
    """Run-length Burrows-Wheeler transform of ``text``, taken as a circle, for strings up to ``depth`` symbols."""

    def __init__(self, text: np.ndarray, depth: int):
        n = self.n = len(text)
        order, rank = self._sorted(text, depth - 1)
        # places whose rotation differs from the one before within depth - 1 symbols
        self.parted = np.append(np.flatnonzero(np.diff(rank[order], prepend=-1)), n)
        del rank
        symbols = text[order - 1].astype(np.int64)
        del order
        heads = np.flatnonzero(np.diff(symbols, prepend=-1))
        lengths = np.diff(np.append(heads, n))
        by_symbol = np.lexsort((heads, symbols[heads]))
        self.keys = symbols[heads][by_symbol] * (n + 1) + heads[by_symbol]
        self.lengths = lengths[by_symbol]
        self.before = np.cumsum(self.lengths) - self.lengths
        self.first = np.searchsorted(self.keys, np.arange(257) * (n + 1))
        self.total = np.append(self.before, n)[self.first]  # symbols smaller than each symbol

    @staticmethod
    def _sorted(text: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """Rotations in the order of their first ``depth`` symbols, ties by place, and ranks with ties equal."""
        n = len(text)
        around = np.concatenate((text, np.resize(text, 8)))
        key = np.zeros(n, np.uint64)
        for i in range(8):
            key = (key << np.uint64(8)) | around[i : i + n]
        have = 8
        while True:
            order = np.argsort(key, kind="stable")
            key = key[order]
            changed = np.zeros(n, bool)
            np.not_equal(key[1:], key[:-1], out=changed[1:])
            del key
            rank = np.empty(n, np.int64)
            rank[order] = np.cumsum(changed)
            if have == depth:
                return order, rank
            del order
            step = min(have, depth - have)
            key = rank.astype(np.uint64)
            key *= np.uint64(n)
            key += np.roll(rank, -step).view(np.uint64)
            have += step

    def count(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Rotations that start with ``symbol`` and follow, without it, before ``place``: its rank, shifted."""
        at = np.searchsorted(self.keys, symbol * (self.n + 1) + place, side="right") - 1
        head = self.keys[at] - symbol * (self.n + 1)
        inside = at >= self.first[symbol]
        return np.where(inside, self.before[at] + np.minimum(place - head, self.lengths[at]), self.total[symbol])

    def intervals(self, text: np.ndarray, starts: np.ndarray, lengths: np.ndarray, depth: int) -> np.ndarray:
        """For each place of the given strings the first rotation with its ``depth`` symbols; -1 near their ends.

        All strings are streamed at once, backwards: shrink to depth - 1 symbols, extend by one. As every string
        stands in the text, intervals are never empty and their first rotation says it all. Long strings are
        streamed as pieces that overlap by a window, so that few stragglers do not prolong the walk.
        """
        found = np.full(len(text), -1, np.int64)
        stride = 3 * depth
        pieces = np.maximum(1, -(-(lengths - depth + 1) // stride))
        starts, ends = np.repeat(starts, pieces) + stride * steps(pieces), np.repeat(starts + lengths, pieces)
        lengths = np.minimum(ends - starts, stride + depth - 1)
        order = np.argsort(-lengths, kind="stable")
        starts, lengths = starts[order], lengths[order]
        low = np.zeros(len(starts), np.int64)
        for step in range(int(lengths[0]) if len(lengths) else 0):
            active = int(np.searchsorted(-lengths, -step, side="left"))  # pieces longer than ``step``
            first = low[:active]
            if step >= depth:
                first = self.parted[np.searchsorted(self.parted, first, side="right") - 1]
            place = starts[:active] + lengths[:active] - 1 - step
            low[:active] = self.count(text[place].astype(np.int64), first)
            if step >= depth - 1:
                found[place] = low[:active]
        return found


def _repetitive(text: np.ndarray, starts: np.ndarray, lengths: np.ndarray, window: int) -> tuple[np.ndarray, ...]:
    """String, first byte in it and length of each part of the given strings (one after the other in ``text``) that
    is left when windows are taken out which hold half a window that stands once in ``text``."""
    ends = starts + lengths
    edge = np.zeros(len(text) + 1, np.int8)  # windows that reach into the next string
    np.add.at(edge, ends - window + 1, 1)
    np.add.at(edge, ends, -1)
    inside = np.cumsum(edge[: len(text) - window + 1], dtype=np.int8) == 0
    half = max(GRAM, window // 2)
    bits = max(16, (len(text) // 2).bit_length())
    slots = np.empty(len(text) - half + 1, np.int32)
    counts = np.zeros(1 << bits, np.int32)
    for at in range(0, len(slots), PART_BYTES):
        part = _far(_grams(text[at : at + PART_BYTES + half - 1]), half) >> np.uint64(64 - bits)
        slots[at : at + PART_BYTES] = part
        np.add.at(counts, part.astype(np.int64), 1)
    single = np.empty(len(slots), bool)
    for at in range(0, len(slots), PART_BYTES):
        single[at : at + PART_BYTES] = counts[slots[at : at + PART_BYTES]] == 1
    del slots, counts
    once = np.zeros(len(single) + 1, np.int32)
    np.cumsum(single, out=once[1:])
    keep = inside & (once[window - half + 1 :] == once[: len(once) - window + half - 1])
    change = np.diff(keep.view(np.int8), prepend=0, append=0)
    first, stop = np.flatnonzero(change == 1), np.flatnonzero(change == -1)
    which = np.searchsorted(ends, first, side="right")
    return which, first - starts[which], stop - first + window - 1


def _finder(window: int, buckets: int):
    def find(table: pa.Table) -> pa.Table:
        expand = zstandard.ZstdDecompressor().decompress
        column = lambda name, kind, packed=True: np.concatenate([
            np.frombuffer(expand(v) if packed else v, kind) for v in table[name].to_pylist()
        ]).astype(np.int64)
        lengths, starts = column("lengths", "<i4"), column("starts", "<i4")
        ids, digests = column("docs", "<i8"), column("digests", "<i8")
        if table["bucket"][0].as_py() >= buckets:
            runs = lengths - window + 1
            return _repeats(np.repeat(ids, runs), np.repeat(digests, runs), np.repeat(starts, runs) + steps(runs))
        data = b"".join([expand(v) for v in table["text"].to_pylist()])
        offsets = np.concatenate(([0], np.cumsum(lengths)))
        strings = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(lengths), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
        coded = pc.dictionary_encode(strings)
        string = coded.indices.to_numpy().astype(np.int64)
        count = len(coded.dictionary)
        # occurrences in document order; the first of each string stands for it
        order = np.lexsort((starts, digests, ids))
        first = np.full(count, -1)
        first[string[order[::-1]]] = order[::-1]
        position = np.empty(len(order), np.int64)
        position[order] = np.arange(len(order))
        # documents by number in the same order
        document = np.empty(len(order), np.int64)
        document[order] = np.cumsum((np.diff(ids[order], prepend=ids[order[0]]) != 0) | (np.diff(digests[order], prepend=digests[order[0]]) != 0))
        marks = column("marks", "<u4", False)[first]
        _, by_mark, sizes = np.unique(marks & 0x7FFFFFFF, return_inverse=True, return_counts=True)
        shared = np.flatnonzero((sizes[by_mark] > 1) | (marks >> 31 > 0))
        # what may repeat of strings that share their minimiser, or hold it twice: document's first byte and length
        flat, part, ahead, own = np.frombuffer(data, np.uint8), shared, np.empty(0, np.int64), np.empty(0, np.int64)
        if len(shared):
            text, ends = gather(flat, offsets[first], lengths[first], shared)
            which, ahead, own = _repetitive(text, ends - lengths[first[shared]], lengths[first[shared]], window)
            part = shared[which]
        # windows by the interval of their content
        text, ends = gather(flat, offsets[first[part]] + ahead, own, np.arange(len(part)))
        del flat, data, strings, coded  # a bucket's texts, several times over
        group = np.full(len(text), -1, np.int64)
        if len(part):
            group = RunIndex(text, window).intervals(text, ends - own, own, window)
        # the earliest occurrence of every interval, over the first occurrences of its strings
        place = np.flatnonzero(group >= 0)
        which = np.repeat(np.arange(len(part)), own)[place]
        base = first[part[which]]
        whence = document[base] << 32 | starts[base] + place - (ends - own - ahead)[which]
        del which, base
        at = np.lexsort((whence, group[place]))
        head = np.maximum.accumulate(np.where(np.diff(group[place[at]], prepend=-1) != 0, np.arange(len(at)), 0))
        later = np.zeros(len(text), bool)
        later[place[at]] = whence[at] != whence[at[head]]  # than the window of this content that comes first
        del group, place, whence, at, head
        # other occurrences of a string repeat all its windows, its first one those found above
        repeated = position != position[first[string]]
        i = np.flatnonzero(repeated)
        j = first[string[i]]
        differ = (ids[i] != ids[j]) | (digests[i] != digests[j]) | (starts[i] != starts[j])
        i = i[differ]
        runs = lengths[i] - window + 1
        hit = np.flatnonzero(later)
        which = np.repeat(np.arange(len(part)), own)[hit]
        base = first[part[which]]
        return _repeats(
            np.concatenate((np.repeat(ids[i], runs), ids[base])), np.concatenate((np.repeat(digests[i], runs), digests[base])),
            np.concatenate((np.repeat(starts[i], runs) + steps(runs), starts[base] + hit - (ends - own - ahead)[which])),
        )

    return find


def repeated_spans(rows: DataFrame, window: int = WINDOW) -> DataFrame:
    """``(id, digest, start, n)``: ``n`` consecutive windows from byte ``start`` that each occur earlier."""
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(1, math.ceil(size / BUCKET_BYTES))
    schema = "bucket long, text binary, lengths binary, marks binary, docs binary, digests binary, starts binary"
    packed = rows.mapInArrow(_packer(window, buckets, shared(rows, frequent(rows, _byte_grams(window), size))), schema)
    return packed.groupBy("bucket").applyInArrow(_finder(window, buckets), _SPANS_DDL)


def _with_flag(rows: DataFrame, found: DataFrame) -> DataFrame:
    """``rows`` with ``listed``, false where a row surely has no span. No shuffle: the bits of documents with spans
    are broadcast, at most ``MAX_PAGES`` bitmaps; beyond ``MAX_PAGES`` * 2048 of them, more rows are listed in vain."""
    listed = found.select("id", "digest").distinct()
    pages = min(MAX_PAGES, 1 << (listed.count() >> 11).bit_length())
    slot = F.pmod(F.xxhash64("id", "digest"), F.lit(pages * PAGE_BITS)) + 1
    page, position = F.bitmap_bucket_number(slot), F.bitmap_bit_position(slot)
    bits = listed.groupBy(page.alias("page")).agg(F.bitmap_construct_agg(position).alias("bits"))
    rows = rows.join(F.broadcast(bits), page == F.col("page"), "left")
    byte = F.conv(F.hex(F.substring("bits", (F.floor(position / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    flag = F.coalesce(F.getbit(byte, (position % 8).cast("int")) == 1, F.lit(False))
    return rows.withColumn("listed", flag).drop("page", "bits")


def remove_repeats(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_bytes, n_removed, spans, kept)``: maximal removed byte spans (start, stop) and the other bytes."""
    rows = keyed(docs, id_col, text_col)
    found = materialise(repeated_spans(rows, window))
    listed = found.groupBy("id", "digest").agg(F.collect_list("start").alias("starts"), F.collect_list("n").alias("ns"))
    span = pa.struct([("start", pa.int64()), ("stop", pa.int64())])
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("spans", pa.list_(span)), ("kept", pa.binary())])

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks([batch]):
                out = []
                for i, text, starts, ns in zip(*(c.to_pylist() for c in block.columns)):
                    data = text.encode()
                    spans = []
                    if starts:
                        order = np.argsort(starts, kind="stable")
                        begin = np.array(starts, np.int64)[order]
                        end = np.maximum.accumulate(begin + np.array(ns, np.int64)[order] + window - 1)
                        new = np.concatenate(([True], begin[1:] > end[:-1]))
                        last = np.append(np.flatnonzero(new)[1:], len(begin)) - 1
                        spans = list(zip(begin[new].tolist(), end[last].tolist()))
                    at, left = 0, []
                    for a, b in spans:
                        left.append(data[at:a])
                        at = b
                    kept = b"".join([*left, data[at:]])
                    named = [{"start": a, "stop": b} for a, b in spans]
                    out.append((None if i == -(2**63) else i, len(data), len(data) - len(kept), named, kept))
                yield record(schema, *zip(*out))

    marked = _with_flag(rows, found)
    joined = marked.where("listed").join(listed, ["id", "digest"], "left").select("id", "text", "starts", "ns")
    no = F.lit(None).cast("array<int>")
    joined = joined.unionAll(marked.where("not listed").select("id", "text", no.alias("starts"), no.alias("ns")))
    return joined.mapInArrow(keep, "doc_id long, n_bytes long, n_removed long, spans array<struct<start: long, stop: long>>, kept binary")
