"""Array helpers as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from themata.cluster import let


def bag(tokens: Column) -> Column:
    """``array<struct<term, n>>``: the distinct tokens of one document with their counts.

    A document is one row, so its counts need no shuffle: sort the array, find where a new value
    starts, and take the distances between the starts.
    """

    def runs(s: Column) -> Column:
        positions = F.sequence(F.lit(0), F.size(s) - 1)
        starts = F.filter(positions, lambda i: (i == 0) | (F.get(s, i) != F.get(s, i - 1)))

        def count(b: Column) -> Column:
            ends = F.concat(F.slice(b, 2, F.size(b)), F.array(F.size(s)))
            return F.zip_with(
                b, ends, lambda i, j: F.struct(F.get(s, i).alias("term"), (j - i).cast("long").alias("n"))
            )

        return let(starts, count)

    empty = F.array().cast("array<struct<term:string,n:bigint>>")
    return F.when(F.size(tokens) > 0, let(F.sort_array(tokens), runs)).otherwise(empty)


def pairs(tokens: Column) -> Column:
    """Neighbouring tokens of one array as ``array<struct<w1, w2>>``; empty below two tokens."""
    n = F.size(tokens)
    zipped = F.zip_with(
        F.slice(tokens, 1, n - 1),
        F.slice(tokens, 2, n - 1),
        lambda a, b: F.struct(a.alias("w1"), b.alias("w2")),
    )
    return F.when(n > 1, zipped).otherwise(F.array().cast("array<struct<w1:string,w2:string>>"))


def argmax(scores: Column) -> Column:
    """Position (from 0) of the first largest element."""
    return (F.array_position(scores, F.array_max(scores)) - 1).cast("int")


def one_hot(code: Column, size: int) -> Column:
    return F.transform(F.sequence(F.lit(0), F.lit(size - 1)), lambda i: F.when(i == code, 1.0).otherwise(0.0))
