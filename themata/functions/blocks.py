"""Numeric work on blocks of rows: Arrow lists or ML vectors to NumPy matrices and back."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, functions as F, types as T

CHUNK_ROWS = 1024
DOUBLES = T.ArrayType(T.DoubleType())


def is_vector(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, VectorUDT)


def as_array(df: DataFrame, column: str) -> Column:
    return vector_to_array(column) if is_vector(df, column) else F.col(column).cast("array<double>")


def as_vector(df: DataFrame, column: str) -> Column:
    return F.col(column) if is_vector(df, column) else array_to_vector(F.col(column).cast("array<double>"))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of a list column, or of a dense / sparse vector column, as one dense matrix."""
    rows = len(column)
    if not pa.types.is_struct(column.type):
        return column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(rows, width)
    kind, _, indices, values = (pc.struct_field(column, i) for i in range(4))
    sparse = kind.to_numpy(zero_copy_only=False) == 0
    lengths = pc.list_value_length(values).to_numpy(zero_copy_only=False)
    stored = values.flatten().to_numpy(zero_copy_only=False)
    owner = np.repeat(np.arange(rows), lengths)
    place = np.arange(len(stored)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    place[sparse[owner]] = indices.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((rows, width))
    out[owner, place] = stored
    return out


def chunks(column: pa.Array, width: int) -> Iterator[np.ndarray]:
    """The same, a bounded number of rows at a time."""
    for start in range(0, len(column), CHUNK_ROWS):
        yield matrix(column.slice(start, CHUNK_ROWS), width)


def lists(block: np.ndarray) -> pa.Array:
    rows, width = block.shape
    offsets = pa.array(np.arange(rows + 1) * width, pa.int32())
    return pa.ListArray.from_arrays(offsets, pa.array(np.ascontiguousarray(block).ravel(), pa.float64()))


def map_rows(column: Column, width: int, function) -> Column:
    """``array<double>`` column: ``function`` maps a block of rows to a block of rows."""

    @F.arrow_udf(DOUBLES)
    def apply(values: pa.Array) -> pa.Array:
        parts = [lists(function(block)) for block in chunks(values, width)]
        return pa.concat_arrays(parts) if parts else pa.array([], pa.list_(pa.float64()))

    return apply(column)


def best_class(column: Column, width: int, scores, labels: list) -> Column:
    """The label of the first largest score; ``scores`` maps a block to rows x classes."""

    @F.arrow_udf(T.IntegerType())
    def apply(values: pa.Array) -> pa.Array:
        picks = [np.argmax(scores(block), axis=1) for block in chunks(values, width)]
        return pa.array(np.concatenate(picks) if picks else [], pa.int32())

    return F.get(F.array(*[F.lit(label) for label in labels]), apply(column))


def width_of(df: DataFrame, column: str) -> int:
    """Number of columns of the vectors, read from one row."""
    row = df.select(F.size(as_array(df, column)).alias("d")).first()
    if row is None:
        raise ValueError("no rows to learn from")
    return row["d"]


def cross_product(df: DataFrame, column: str, width: int, weight: str | None = None, center: dict | None = None,
                  key: str | None = None) -> np.ndarray:
    """Sum of w * (x - c)(x - c)^T over all rows, as a width x width matrix on the driver.

    Each task adds up its own matrix over bounded blocks and emits it once; the cells are then
    summed by a shuffle. ``center`` maps the values of ``key`` to the vector taken off.
    """
    if width > 4096:
        raise ValueError("cross product wider than 4096 columns: select or reduce terms first")
    columns = [F.col(column).alias("x")] + ([F.col(weight).alias("w")] if weight else []) + (
        [F.col(key).alias("k")] if key else [])
    upper = np.triu_indices(width)

    def partial(batches):
        total = np.zeros((width, width))
        for batch in batches:
            names = batch.schema.names
            for start in range(0, batch.num_rows, CHUNK_ROWS):
                part = batch.slice(start, CHUNK_ROWS)
                x = matrix(part.column(0), width)
                if key:
                    keys = part.column(names.index("k")).to_pylist()
                    x = x - np.array([center[k] for k in keys])
                if weight:
                    w = part.column(names.index("w")).to_numpy(zero_copy_only=False)
                    total += x.T @ (x * w[:, None])
                else:
                    total += x.T @ x
        if total.any():
            yield pa.RecordBatch.from_arrays(
                [pa.array(upper[0], pa.int32()), pa.array(upper[1], pa.int32()), pa.array(total[upper])],
                ["i", "j", "v"],
            )

    cells = df.select(*columns).mapInArrow(partial, "i int, j int, v double")
    summed = cells.groupBy("i", "j").agg(F.sum("v").alias("v")).toArrow()
    out = np.zeros((width, width))
    i, j, v = (summed.column(c).to_numpy() for c in ("i", "j", "v"))
    out[i, j] = v
    out[j, i] = v
    return out
