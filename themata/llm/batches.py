"""Helpers shared by the operators that work on Arrow batches: whole texts in, flat arrays and rows out."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

#: Bytes of text handled at once inside a task; bounds memory whatever the Arrow batch holds.
BLOCK_BYTES = 4 << 20

#: Bytes of text for steps that make a few numbers of each text, so that larger blocks save nothing. Workers go on
#: holding most of what they once took, also in the steps that follow.
SCAN_BYTES = 1 << 20


def texts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, text)`` as long and string; null text is empty. Other columns are left behind, so that
    clashing names cannot reach an operator."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    return df.select(F.col(f"`{id_col}`").cast("long").alias("id"), text.alias("text"))


def blocks(batches: Iterator[pa.RecordBatch], block_bytes: int = BLOCK_BYTES, place: int = 1) -> Iterator[pa.RecordBatch]:
    """Batches, by default ``(id, text)``, cut into slices of whole documents with about ``block_bytes`` of the text
    at ``place``, which may be null."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(place)), 0)
        ends = np.cumsum(lengths.to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < batch.num_rows:
            done = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, done + block_bytes, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def translation(lower: bool = False, apart: list[int] = ()) -> np.ndarray:
    """Byte table: A-Z in lower case if ``lower``, the bytes of ``apart`` as spaces."""
    table = np.arange(256, dtype=np.uint8)
    if lower:
        table[65:91] += 32
    table[list(apart)] = 32
    return table


LOWER = translation(lower=True)


def translated(column: pa.Array, table: np.ndarray) -> pa.Array:
    """Texts with every byte replaced by ``table``, which must leave bytes above 127 alone."""
    _, ends, data = column.cast(pa.string()).buffers()
    ends = np.frombuffer(ends, np.int32)[column.offset : column.offset + len(column) + 1]
    changed = table[np.frombuffer(data, np.uint8)[ends[0] : ends[-1]]] if ends[-1] > ends[0] else b""
    return pa.StringArray.from_buffers(len(column), pa.py_buffer(ends - ends[0]), pa.py_buffer(changed))


class Words:
    """Words of a block of texts between ASCII white space, dictionary-coded.

    ``codes`` holds one code per word, ``vocabulary`` the words by code, ``bounds`` the place of each
    document's first word in ``codes`` (and the end of the last).
    """

    def __init__(self, column: pa.Array, table: np.ndarray | None = None):
        if table is not None:
            column = translated(column, table)
        lists = pc.ascii_split_whitespace(column)
        flat = lists.flatten()
        bounds = lists.offsets.to_numpy() - lists.offsets[0].as_py()
        full = pc.greater(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)
        if not full.all():  # white space at an end leaves an empty part
            bounds = np.concatenate(([0], np.cumsum(full)))[bounds]
            flat = flat.filter(pa.array(full))
        coded = flat.dictionary_encode()
        self.bounds = bounds.astype(np.int64)
        self.codes = coded.indices.to_numpy(zero_copy_only=False)
        self.vocabulary: pa.Array = coded.dictionary

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)


def ragged(values: list[bytes], dtype) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte strings as one array of ``dtype``, with the start and the length of each."""
    lengths = np.fromiter(map(len, values), np.int64, len(values)) // np.dtype(dtype).itemsize
    return np.frombuffer(b"".join(values), dtype), np.cumsum(lengths) - lengths, lengths


def steps(counts: np.ndarray) -> np.ndarray:
    """0..c-1 for every count c, one after the other."""
    counts = np.asarray(counts, np.int64)
    return np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)


def record(schema: pa.Schema, *columns) -> pa.RecordBatch:
    """Record batch of ``schema`` from arrays or lists."""
    made = [c if isinstance(c, pa.Array) else pa.array(c, type=f.type) for c, f in zip(columns, schema)]
    return pa.RecordBatch.from_arrays(made, schema=schema)


#: Items whose places ``gather`` holds at once.
GATHERED = 1 << 19


def gather(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray, codes: np.ndarray):
    """The pieces ``flat[starts[c] : starts[c] + lengths[c]]`` of all codes in one array, and where each ends."""
    counts = lengths[codes]
    ends = np.cumsum(counts)
    out = np.empty(ends[-1] if len(ends) else 0, flat.dtype)
    low = 0
    while low < len(codes):
        done = ends[low] - counts[low]
        high = max(low + 1, int(np.searchsorted(ends, done + GATHERED, side="right")))
        place = np.repeat(starts[codes[low:high]] - ends[low:high] + counts[low:high], counts[low:high])
        place += np.arange(done, ends[high - 1])
        out[done : ends[high - 1]] = flat[place]
        low = high
    return out, ends


class Generations:
    """Cache of at most two generations of ``limit`` entries. Entries used again move to the young
    generation; when that is full, it becomes the old one and the old one goes. Results never depend on it."""

    def __init__(self, limit: int):
        self.limit = limit
        self.young: dict = {}
        self.old: dict = {}

    def values(self, keys: list, learn) -> list:
        """The entries of ``keys``; ``learn`` gives those of a list of keys that have none."""
        young = self.young
        if len(young) > self.limit:
            self.old, self.young = young, {}
            young = self.young
        found = list(map(young.get, keys))
        absent = [i for i, v in enumerate(found) if v is None]
        if absent:
            old = self.old
            again = [old.get(keys[i]) for i in absent]
            new = [keys[i] for i, v in zip(absent, again) if v is None]
            made = iter(learn(new) if new else ())
            for i, v in zip(absent, again):
                found[i] = young[keys[i]] = next(made) if v is None else v
        return found
