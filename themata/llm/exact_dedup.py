"""Exact duplicates by two-pass Bloom filtering, with DataFrame functions only.

Texts are equal when they are identical without their ASCII white space. One narrow projection turns every row into a
digest (SHA-256 of what is left, in UTF-8), its length and a number of its own; texts never move. The first pass
counts how many rows fall on each slot of a Bloom filter, ``HASHES`` slots a row, and keeps the slots that two rows or
more fell on as bitmaps. The second pass looks every digest up in these: a row with a slot to itself has no equal and
passes straight through, in its task. Only the others, possibly repeated, are stored, shuffled and grouped by digest.

The filter grows with the rows, ``SLOTS_PER_ROW`` slots each, up to ``MAX_SLOTS``; its bitmaps are broadcast and hold
``MAX_SLOTS / 8`` bytes at most (128 MB). Beyond ``MAX_SLOTS / SLOTS_PER_ROW`` rows it lets ever more single rows
through to the shuffle; what they shuffle is a digest and three numbers a row, and the result is the same.

Groups are counted on the map side first. Those with at least one ``HEAVY``-th of the possibly repeated rows, of which
there are at most ``HEAVY``, come back to their rows by broadcast, so that no task meets a whole large group.

Defined cases: null text is empty, and all empty or white texts are equal to each other. Of equal texts the row with
the most code points stays, then the one with the smallest id; a row without an id comes after those with one. Of
rows that agree in all this, one stays. An empty table gives an empty table; other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from themata.cluster import broadcast_if_small, keyed_rows, materialise

#: Characters that do not count: space, tab, line feed, vertical tab, form feed, carriage return.
WHITE = " \t\n\x0b\x0c\r"

SLOTS_PER_ROW = 16
HASHES = 2
MAX_SLOTS = 1 << 30

#: Groups with at least this share (one in so many) of the possibly repeated rows are joined by broadcast.
HEAVY = 10_000


def _text(text_col: str) -> Column:
    return F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", row_col: str | None = None) -> DataFrame:
    """``(row, id, n_chars, digest)`` of every row, as a stage table; ``row`` is ``row_col``, if given."""
    kept = F.translate(_text(text_col), WHITE, "")
    row = F.col(f"`{row_col}`") if row_col else F.monotonically_increasing_id()
    rows = docs.select(
        row.alias("row"), F.col(f"`{id_col}`").cast("long").alias("id"), F.length(_text(text_col)).cast("long").alias("n_chars"),
        F.unhex(F.sha2(kept.cast("binary"), 256)).alias("digest"),
    )
    return materialise(rows)


def filter_size(n_rows: int) -> int:
    """Slots for ``n_rows`` rows: a power of two between ``SLOTS_PER_ROW`` and twice as many for each, as far as the bound goes."""
    return min(MAX_SLOTS, 1 << max(15, (SLOTS_PER_ROW * n_rows).bit_length()))


def _slots(slots: int) -> list[Column]:
    """The slots of a digest, counted from 1."""
    return [F.pmod(F.xxhash64("digest", F.lit(i)), F.lit(slots)) + 1 for i in range(HASHES)]


def crowded_slots(rows: DataFrame, slots: int) -> DataFrame:
    """First pass: ``(page, bits)``, bitmaps of the slots that two rows or more fell on; pages without any are absent."""
    taken = rows.select(F.explode(F.array_distinct(F.array(*_slots(slots)))).alias("slot"))
    crowded = taken.groupBy("slot").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    page, position = F.bitmap_bucket_number("slot").alias("page"), F.bitmap_bit_position("slot")
    return materialise(crowded.groupBy(page).agg(F.bitmap_construct_agg(position).alias("bits")))


def with_flag(rows: DataFrame, pages: DataFrame, slots: int) -> DataFrame:
    """Second pass: ``rows`` with ``repeated``, false where the digest surely occurs once. No shuffle."""
    flag = F.lit(True)
    for i, slot in enumerate(_slots(slots)):
        page, bits = f"page{i}", f"bits{i}"
        named = pages.select(F.col("page").alias(page), F.col("bits").alias(bits))
        rows = rows.join(F.broadcast(named), F.bitmap_bucket_number(slot) == F.col(page), "left")
        position = F.bitmap_bit_position(slot)
        byte = F.conv(F.hex(F.substring(bits, (F.floor(position / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
        flag = flag & F.coalesce(F.getbit(byte, (position % 8).cast("int")) == 1, F.lit(False))
        rows = rows.drop(page)
    return rows.withColumn("repeated", flag).drop(*[f"bits{i}" for i in range(HASHES)])


def mark_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", row_col: str | None = None) -> DataFrame:
    """``(row, id, n_chars, digest, keep_id, group_size, kept)``, one row for each of ``docs``; ``keep_id`` is the id
    of the row that stays of its group, ``kept`` whether it is this row."""
    rows = fingerprints(docs, id_col, text_col, row_col)
    slots = filter_size(rows.count())
    pages = crowded_slots(rows, slots)
    flagged = with_flag(rows, pages, slots)
    columns = ["row", "id", "n_chars", "digest"]
    single = flagged.where("not repeated").select(
        *columns, F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept")
    )
    candidates = materialise(flagged.where("repeated").select(columns))

    best = F.min(F.struct((-F.col("n_chars")).alias("less"), F.col("id").isNull().alias("unnamed"), "id", "row"))
    groups = materialise(
        candidates.groupBy("digest").agg(F.count(F.lit(1)).alias("group_size"), best.alias("best"))
        .select("digest", "group_size", F.col("best.id").alias("keep_id"), F.col("best.row").alias("keep_row"))
    )
    limit = max(2, -(-candidates.count() // HEAVY))
    heavy, light = groups.where(F.col("group_size") >= limit), groups.where(F.col("group_size") < limit)
    shown = [*columns, "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept")]
    of_heavy = candidates.join(F.broadcast(heavy), "digest").select(shown)
    others = candidates.join(F.broadcast(heavy.select("digest")), "digest", "left_anti")
    of_light = others.join(light, "digest").select(shown)
    return single.unionAll(of_heavy).unionAll(of_light)


def drop_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    own = "__row"
    while own in {c.lower() for c in docs.columns}:
        own += "_"
    numbered = keyed_rows(docs, own)
    marked = mark_duplicates(numbered, id_col, text_col, own)
    gone = materialise(marked.where("not kept").select(F.col("row").alias(own)))
    return numbered.join(broadcast_if_small(gone), own, "left_anti").select([F.col(f"`{c}`") for c in docs.columns])
