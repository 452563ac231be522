"""Best-fit packing of documents into fixed sequences by the sum-of-squares rule.

A document's tokens (its ids and one end id) are cut into pieces of at most ``capacity``; only documents
longer than that are cut. Pieces are dealt by a hash of document and piece into shards of a bounded number
of pieces, so that neither a hot source nor a long document makes one shard larger. Each shard is packed by
itself: longest piece first, every piece goes into the open sequence for which the sum over residual gaps of
(number of open sequences with that gap) squared becomes smallest; a sequence is opened only when none has
room. Full sequences leave the sum. The number of shards follows the number of pieces; each shard leaves
at most a few sequences unfilled.

Defined cases: null or empty text is a document of the end id alone; an empty table gives an empty table;
documents with the same id are packed one by one, each with pieces from 0; a null id stays null.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from themata.cluster import materialise
from themata.llm.batches import SCAN_BYTES, blocks, record, texts
from themata.llm.tokens import encoder

CAPACITY = 2048

#: Id put behind each document.
END_ID = 0

#: Pieces packed by one task, in expectation.
SHARD_PIECES = 25_000

_PIECES = pa.schema([
    ("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
])


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: place in the document, length, and checksum of its little-endian 32-bit ids."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end, step = encoder(tokenizer), END_ID.to_bytes(4, "little"), 4 * capacity
        for block in blocks(batches, SCAN_BYTES):
            ids, counts = encode.ids(block.column(1))
            raw, at = memoryview(ids.tobytes()), 0
            rows = []
            for doc, size in zip(block.column(0).to_pylist(), counts.tolist()):
                own = bytes(raw[at : at + 4 * size]) + end
                at += 4 * size
                for k, start in enumerate(range(0, len(own), step)):
                    piece = own[start : start + step]
                    rows.append((doc, k, start // 4, len(piece) // 4, zlib.crc32(piece)))
            yield record(_PIECES, *zip(*rows))

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long"
    return texts(docs, id_col, text_col).mapInArrow(cut, schema)


def sum_of_squares(lengths: list[int], capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of each piece, for pieces of 1 to ``capacity`` tokens in the given order."""
    # squares change by 2 (open[gap - length] - open[gap] + 1) when a sequence moves from one gap to a smaller
    # one; a sequence without a gap is not counted, which saves half a unit more
    open_at = np.zeros(capacity + 1)
    open_at[0] = -0.5
    sequences: list[list[int]] = [[] for _ in range(capacity + 1)]
    numbers, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    used = 0
    for i, length in enumerate(lengths):
        room = open_at[length:]
        change = np.where(room > 0, open_at[: capacity - length + 1] - room, np.inf)
        left = int(change.argmin()) if len(change) else 0
        if change[left] < np.inf:
            gap = left + length
            number = sequences[gap].pop()
            open_at[gap] -= 1
        else:
            number, gap = used, capacity
            used += 1
        numbers[i], offsets[i] = number, capacity - gap
        if gap > length:
            sequences[gap - length].append(number)
            open_at[gap - length] += 1
    return numbers, offsets


def pack(parts: DataFrame, capacity: int = CAPACITY, shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """``parts`` (rows of ``pieces``, stored) with ``sequence_id`` and ``offset``."""
    shards = max(1, math.ceil(parts.count() / shard_pieces))

    def place(shard: pa.Table) -> pa.Table:
        order = [("length", "descending"), *((c, "ascending") for c in ("doc_id", "piece", "start", "ids_crc32"))]
        shard = shard.sort_by(order)
        numbers, offsets = sum_of_squares(shard["length"].to_pylist(), capacity)
        sequence = numbers * shards + shard["shard"].to_numpy()
        return shard.drop_columns("shard").append_column("offset", pa.array(offsets)).append_column("sequence_id", pa.array(sequence))

    dealt = parts.withColumn("shard", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(shards)))
    # a fixed number of partitions: Spark would merge such small ones into a single task
    dealt = dealt.repartition(min(shards, 4 * parts.sparkSession.sparkContext.defaultParallelism), "shard")
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, offset long, sequence_id long"
    return dealt.groupBy("shard").applyInArrow(place, schema)


def best_fit_packing(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of all documents with the sequence and offset where each goes."""
    return pack(materialise(pieces(docs, tokenizer, capacity, id_col, text_col)), capacity)
