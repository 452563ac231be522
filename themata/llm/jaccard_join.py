"""N-gram Jaccard join by grouped prefixes.

A document is the set of its distinct shingles of ``SHINGLE`` words. Shingles have one global order, rarer first
(frequencies come from a counter table over all documents, hashes break ties); with Jaccard similarity of at least
4/5, two sets share a shingle among the first n - ceil(4n/5) + 1 of each. The order only decides the cost.

1. Documents with equal sets become one class. Classes with equal prefix and size become one group, and only the
   group's prefix is indexed.
2. Every prefix shingle has the list of its groups by size. Each group is paired with the list's first group of
   fitting size, and each class with the first of its own group; parity bitmaps (a lower bound of the difference)
   drop most pairs, the rest is verified on the texts.
3. Lists that now lie in one component can add nothing. In the others the groups are expanded to their classes,
   and pairs from different components that pass size and bitmap are verified: first as many as would join them,
   then all pairs between components that are left. Long lists are dealt in blocks.

So a large group of near copies costs about one verification per member and list, never all its pairs, while no
component misses a link. Shingles are compared as 64-bit hashes, equal sets as 128 bits.

Defined cases: null, empty and wordless texts have an empty set and no links; fewer words than a shingle are one
shingle; rows with one id are one vertex, but
each of their texts is compared under a key of its own; a null id takes no part and has no component; an empty table gives an
empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from themata.cluster import broadcast_if_small, materialise
from themata.llm.batches import LOWER, SCAN_BYTES, Words, blocks, record, steps, texts
from themata.llm.components import components
from themata.llm.superkmer import mix, rolling_hash

SHINGLE = 5

#: Counters of the frequency table (of 4 bytes): one for so many bytes of text, within these bounds; more of them
#: tell rarer shingles apart.
COUNTER_BYTES = 128
MIN_COUNTERS, MAX_COUNTERS = 1 << 20, 1 << 24

#: Members of a list compared by one task at once.
LIST_BLOCK = 2000

#: Members of short lists that go into one group, about.
BUNDLE_MEMBERS = 10_000

_SLICE = 1 << 15
_SIGNATURE = pa.schema([
    ("id", pa.int64()), ("n", pa.int64()), ("d1", pa.int64()), ("d2", pa.int64()), ("p1", pa.int64()), ("p2", pa.int64()),
    ("prefix", pa.binary()), ("bits", pa.binary()),
])
_SIGNATURE_DDL = "id long, n long, d1 long, d2 long, p1 long, p2 long, prefix binary, bits binary"
_SALTS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F], np.uint64)


def shingle_sets(column: pa.Array) -> Iterator[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each text."""
    words = Words(column, LOWER)
    hashes = np.empty(0, np.uint64)
    if len(words.codes):
        hashes = pd.util.hash_array(words.vocabulary.to_numpy(zero_copy_only=False)).astype(np.uint64)[words.codes]
    rolled = mix(rolling_hash(hashes, SHINGLE)) if len(hashes) >= SHINGLE else hashes
    bounds = words.bounds.tolist()
    for a, b in zip(bounds[:-1], bounds[1:]):
        if b - a >= SHINGLE:
            yield np.unique(rolled[a : b - SHINGLE + 1])
        elif b > a:
            yield mix(rolling_hash(hashes[a:b], b - a) + np.uint64(b - a))
        else:
            yield hashes[:0]


def shingle_counters(rows: DataFrame, counters: int | None = None) -> np.ndarray:
    """Number of (document, shingle) pairs per counter, over all documents; one table per task is summed."""
    if counters is None:
        size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        counters = min(MAX_COUNTERS, max(MIN_COUNTERS, 1 << (size // COUNTER_BYTES).bit_length()))
    width = min(_SLICE, counters)
    schema = pa.schema([("slice", pa.int32()), ("counts", pa.binary())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=1).compress
        table = np.zeros(counters, "<u4")
        for block in blocks(batches, SCAN_BYTES):
            found = list(shingle_sets(block.column(1)))
            if found:
                np.add.at(table, (np.concatenate(found) & np.uint64(counters - 1)).astype(np.int64), 1)
        if table.any():
            parts = table.reshape(-1, width)
            yield record(schema, np.arange(len(parts)), [squeeze(p) for p in parts])

    def add(table: pa.Table) -> pa.Table:
        expand = zstandard.ZstdDecompressor().decompress
        total = np.zeros(width, np.int64)
        for part in table["counts"]:
            total += np.frombuffer(expand(part.as_py()), "<u4")
        total = zstandard.ZstdCompressor(level=1).compress(np.minimum(total, 2**32 - 1).astype("<u4"))
        return pa.Table.from_batches([record(schema, table["slice"][:1].combine_chunks(), [total])])

    summed = rows.mapInArrow(count, "slice int, counts binary").groupBy("slice").applyInArrow(add, "slice int, counts binary")
    result = np.zeros((counters // width, width), np.uint32)
    expand = zstandard.ZstdDecompressor().decompress
    for row in summed.collect():  # as many rows as slices
        result[row["slice"]] = np.frombuffer(expand(row["counts"]), "<u4")
    return result.ravel()


def frequency_class(counts: np.ndarray) -> np.ndarray:
    """0 for shingles that no counter shows to be frequent, else the doublings above four times the mean."""
    rare = max(1.0, 4 * counts.mean())
    doublings = lambda part: np.ceil(np.log2(np.maximum(part / rare, 1.0))).astype(np.uint8)
    return np.concatenate([doublings(counts[at : at + _SLICE]) for at in range(0, len(counts), _SLICE)])


def parity_bits(hashes: np.ndarray) -> bytes:
    """Parity of the number of shingles per slot; two to four slots for each shingle, so that few differences
    share one and the bound is close."""
    size = 64
    while size < 2 * len(hashes):
        size *= 2
    bits = np.bincount((hashes >> np.uint64(32) & np.uint64(size - 1)).astype(np.int64), minlength=size) & 1
    return np.packbits(bits.astype(np.uint8), bitorder="little").tobytes()


def may_link(n1: int, bits1: np.ndarray, n2: int, bits2: np.ndarray) -> bool:
    """False only if the sets cannot have similarity 4/5: slots of different parity hold a difference each, and
    a link allows at most a ninth of both sizes. Larger bitmaps are folded to the smaller's slots."""
    if 5 * min(n1, n2) < 4 * max(n1, n2):
        return False
    if len(bits1) < len(bits2):
        bits1, bits2 = bits2, bits1
    if len(bits1) > len(bits2):
        bits1 = np.bitwise_xor.reduce(bits1.reshape(-1, len(bits2)), axis=0)
    return 9 * int(np.bitwise_count(bits1 ^ bits2).sum()) <= n1 + n2


def signatures(rows: DataFrame, order: np.ndarray) -> DataFrame:
    """Size, digests of set and prefix, prefix and bitmap of each document; all empty without shingles."""
    shared = rows.sparkSession.sparkContext.broadcast(order)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = shared.value
        digest = lambda x: (mix(x[None, :] ^ _SALTS[:, None]).sum(axis=1)).astype(np.int64).tolist()
        for block in blocks(batches, SCAN_BYTES):
            out = []
            for i, found in zip(block.column(0).to_pylist(), shingle_sets(block.column(1))):
                n = len(found)
                rank = order[(found & np.uint64(len(order) - 1)).astype(np.int64)]
                prefix = found[np.argsort(rank, kind="stable")[: n - (4 * n + 4) // 5 + 1 if n else 0]]
                out.append((i, n, *digest(found), *digest(prefix), prefix.astype("<u8").tobytes(), parity_bits(found)))
            yield record(_SIGNATURE, *zip(*out))

    return rows.mapInArrow(sign, _SIGNATURE_DDL)


def prefix_lists(groups: DataFrame) -> DataFrame:
    """``(key, member, n, leader)`` of prefix shingles with at least two groups; ``groups`` has id, n, prefix.

    Rows come sorted by shingle and size, so a task holds one batch and the current leader.
    """
    posted = pa.schema([("key", pa.int64()), ("member", pa.int64()), ("n", pa.int64())])
    listed = pa.schema([*posted, ("leader", pa.int64())])

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prefixes = [np.frombuffer(p, "<i8") for p in batch.column(2).to_pylist()]
            if prefixes:
                sizes = [len(p) for p in prefixes]
                yield record(posted, np.concatenate(prefixes), np.repeat(batch.column(0).to_numpy(), sizes), np.repeat(batch.column(1).to_numpy(), sizes))

    def lead(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = leader = size = None  # the list at hand
        held = None  # its first row, until a second one comes
        for batch in batches:
            keys = batch.column(0).to_numpy()
            same = keys[1:] == keys[:-1]
            edge = np.arange(len(keys)) % max(1, len(keys) - 1) == 0  # may go on in another batch
            near = np.concatenate((same, [False])) | np.concatenate(([False], same)) | edge
            out = []
            for k, m, n in zip(*(c.filter(pa.array(near)).to_pylist() for c in batch.columns)):
                if k != key:
                    key, leader, size, held = k, m, n, (k, m, n, m)
                    continue
                if held is not None:
                    out.append(held)
                    held = None
                if 4 * n > 5 * size:
                    leader, size = m, n
                out.append((k, m, n, leader))
            if out:
                yield record(listed, *zip(*out))

    postings = groups.select("id", "n", "prefix").mapInArrow(post, "key long, member long, n long")
    dealt = postings.repartition("key").sortWithinPartitions("key", "n", "member")
    return dealt.mapInArrow(lead, "key long, member long, n long, leader long")


def _bitmap_filter(pairs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """Pairs ``(a, b)`` that the bitmaps of both leave possible."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def possible(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [
                may_link(n1, np.frombuffer(x, np.uint8), n2, np.frombuffer(y, np.uint8))
                for n1, x, n2, y in zip(*(batch.column(i).to_pylist() for i in range(2, 6)))
            ]
            yield record(schema, *(batch.column(i).filter(pa.array(keep, pa.bool_())) for i in range(2)))

    left = bitmaps.select(F.col("id").alias("a"), F.col("n").alias("n1"), F.col("bits").alias("bits1"))
    right = bitmaps.select(F.col("id").alias("b"), F.col("n").alias("n2"), F.col("bits").alias("bits2"))
    joined = pairs.join(left, "a").join(right, "b").select("a", "b", "n1", "bits1", "n2", "bits2")
    return joined.mapInArrow(possible, "a long, b long").distinct()


def verified(pairs: DataFrame, rows: DataFrame) -> DataFrame:
    """Pairs ``(a, b)`` whose texts have similarity of at least 4/5."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                left, right = part.column(2).dictionary_encode(), part.column(3).dictionary_encode()
                x, y = list(shingle_sets(left.dictionary)), list(shingle_sets(right.dictionary))
                for i, j in zip(left.indices.to_pylist(), right.indices.to_pylist()):
                    both = len(np.intersect1d(x[i], y[j], assume_unique=True))
                    keep.append(100 * both >= 80 * (len(x[i]) + len(y[j]) - both) and both > 0)
            yield record(schema, *(batch.column(i).filter(pa.array(keep, pa.bool_())) for i in range(2)))

    pairs = materialise(pairs)
    ids = pairs.select(F.col("a").alias("id")).unionAll(pairs.select(F.col("b").alias("id"))).distinct()
    needed = materialise(rows.join(broadcast_if_small(materialise(ids)), "id", "left_semi"))
    left = needed.select(F.col("id").alias("a"), F.col("text").alias("x"))
    right = needed.select(F.col("id").alias("b"), F.col("text").alias("y"))
    joined = pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y")
    return joined.mapInArrow(verify, "a long, b long").distinct()


def _open_lists(lists: DataFrame, classes: DataFrame, found: DataFrame) -> tuple[DataFrame, int]:
    """``(key, id, component, n_list)`` of the classes in lists that still span several components, and their number."""
    named = classes.select("id", "member").join(found.select(F.col("node").alias("id"), "component"), "id", "left")
    named = named.select("id", "member", F.coalesce("component", "id").alias("component"))
    spread = lists.select("key", "member").join(named, "member").select("key", "id", "component")
    spread = materialise(spread)
    spans = spread.groupBy("key").agg(F.count("*").alias("n_list"), F.min("component").alias("low"), F.max("component").alias("high"))
    spans = materialise(spans.where("low <> high and n_list > 2").select("key", "n_list"))
    return spread.join(spans, "key"), spans.agg(F.sum("n_list")).first()[0] or 0


def _block_pairs(members: DataFrame, bundles: int, spanning: bool) -> DataFrame:
    """``(key, a, b)``: pairs of different components within each list, by size and bitmap; blocks of a long list meet
    pairwise, other lists are compared whole, many in one of ``bundles`` groups.

    With ``spanning``, pairs that would only join what other pairs of the block already join are left out.
    """
    schema = pa.schema([("key", pa.int64()), ("a", pa.int64()), ("b", pa.int64())])

    def compare(table: pa.Table) -> pa.Table:
        columns = table.select(["id", "component", "n", "bits", "part"]).to_pydict()
        ids, groups, sizes, parts = (np.array(columns[c], np.int64) for c in ("id", "component", "n", "part"))
        bits = [np.frombuffer(b, np.uint8) for b in columns["bits"]]
        widths = np.array([len(b) for b in bits])
        tables = {w: np.stack([bits[i] for i in np.flatnonzero(widths == w)]) for w in set(widths.tolist())}
        places = {w: np.flatnonzero(widths == w) for w in tables}
        right = parts == parts.max()  # the block at hand, or the second one of two
        groups = np.unique(groups, return_inverse=True)[1]
        firsts, seconds = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for i in np.flatnonzero(parts == parts.min()).tolist():
            for width, others in tables.items():
                own, at = bits[i], places[width]
                if width < len(own):
                    own = np.bitwise_xor.reduce(own.reshape(-1, width), axis=0)
                elif width > len(own):
                    others = np.bitwise_xor.reduce(others.reshape(len(others), -1, len(own)), axis=1)
                ok = right[at] & (groups[at] != groups[i]) & (5 * sizes[at] >= 4 * sizes[i]) & (5 * sizes[i] >= 4 * sizes[at])
                ok[ok] = 9 * np.bitwise_count(others[ok] ^ own).sum(axis=1, dtype=np.int64) <= sizes[i] + sizes[at[ok]]
                near = at[ok]
                if spanning and len(near):  # one pair per component met, all of which are one from now on
                    met, once = np.unique(groups[near], return_index=True)
                    near = near[once]
                    groups[np.isin(groups, met)] = groups[i]
                firsts.append(np.minimum(ids[i], ids[near]))
                seconds.append(np.maximum(ids[i], ids[near]))
        pairs = np.unique(np.stack([np.concatenate(firsts), np.concatenate(seconds)], axis=1), axis=0)
        key = np.full(len(pairs), table["key"][0].as_py())
        return pa.Table.from_batches([record(schema, key, np.ascontiguousarray(pairs[:, 0]), np.ascontiguousarray(pairs[:, 1]))])

    long = members.where(F.col("n_list") > LIST_BLOCK)
    parts = F.ceil(F.col("n_list") / LIST_BLOCK)
    dealt = long.withColumn("part", F.pmod(F.xxhash64("id"), parts)).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)))
    dealt = dealt.withColumn("low", F.least("part", "other")).withColumn("high", F.greatest("part", "other"))
    of_long = dealt.groupBy("key", "low", "high").applyInArrow(compare, "key long, a long, b long")
    bundled = members.where(F.col("n_list") <= LIST_BLOCK).withColumn("bundle", F.pmod(F.xxhash64("key"), F.lit(bundles)))
    bundled = bundled.select("bundle", "key", "id", "component", "n", "bits")
    return of_long.unionAll(bundled.groupBy("bundle").applyInArrow(_bundle_pairs(spanning), "key long, a long, b long"))


def _bundle_pairs(spanning: bool):
    """Function from whole lists to their pairs ``(key, a, b)`` as in ``_block_pairs``. In an order of its own in
    each list, the first member is compared with all others, then the second one, and so on, for all lists at once; so
    with ``spanning`` most pairs of a list share one member, which differs from list to list."""
    schema = pa.schema([("key", pa.int64()), ("a", pa.int64()), ("b", pa.int64())])

    def compare(table: pa.Table) -> pa.Table:
        key, ids, component, sizes = (table[c].to_numpy() for c in ("key", "id", "component", "n"))
        order = np.lexsort((mix(ids.astype(np.uint64) ^ mix(key.astype(np.uint64))), key))
        key, ids, component, sizes = key[order], ids[order], component[order], sizes[order]
        bits = table["bits"].combine_chunks().take(pa.array(order)).to_pylist()
        widths = np.fromiter(map(len, bits), np.int64, len(bits))
        # bitmaps of one width as rows of a table, and folded to half the width
        slot, whole, half = np.empty(len(bits), np.int64), {}, {}
        for width in np.unique(widths).tolist():
            own = np.flatnonzero(widths == width)
            slot[own] = np.arange(len(own))
            whole[width] = np.frombuffer(b"".join([bits[i] for i in own.tolist()]), "<u8").reshape(len(own), -1)
            if width > 8:
                half[width] = np.bitwise_xor.reduce(whole[width].reshape(len(own), 2, -1), axis=1)
        # components of each list, and which of them are one from now on
        by = np.lexsort((component, key))
        new = (np.diff(key[by], prepend=0) != 0) | (np.diff(component[by], prepend=0) != 0)
        label = np.empty(len(key), np.int64)
        label[by] = np.cumsum(new)
        root = np.arange(len(key) + 1)
        lists, firsts, seconds = [], [], []
        heads = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        lengths = np.diff(np.append(heads, len(key)))
        for step in range(int(lengths.max()) - 1):
            longer = lengths > step + 1
            heads, lengths = heads[longer], lengths[longer]
            rest = lengths - step - 1
            i = np.repeat(heads + step, rest)
            j = i + 1 + steps(rest)
            fits = (root[label[i]] != root[label[j]]) & (5 * sizes[i] >= 4 * sizes[j]) & (5 * sizes[j] >= 4 * sizes[i])
            i, j = i[fits], j[fits]
            i, j = np.where(widths[i] <= widths[j], i, j), np.where(widths[i] <= widths[j], j, i)
            ok = np.zeros(len(i), bool)
            for width, rows in whole.items():
                for other, near in ((width, whole), (2 * width, half)):
                    if other in near:
                        at = np.flatnonzero((widths[i] == width) & (widths[j] == other))
                        for low in range(0, len(at), 4096):
                            some = at[low : low + 4096]
                            differ = np.bitwise_count(rows[slot[i[some]]] ^ near[other][slot[j[some]]]).sum(axis=1, dtype=np.int64)
                            ok[some] = 9 * differ <= sizes[i[some]] + sizes[j[some]]
            i, j = i[ok], j[ok]
            if spanning and len(i):
                joins = np.zeros(len(i), bool)
                for k, (x, y) in enumerate(zip(label[i].tolist(), label[j].tolist())):
                    while root[x] != x:
                        x = root[x]
                    while root[y] != y:
                        y = root[y]
                    if x != y:
                        root[max(x, y)] = min(x, y)
                        joins[k] = True
                i, j = i[joins], j[joins]
                while (root[root] != root).any():
                    root = root[root]
            lists.append(key[i])
            firsts.append(np.minimum(ids[i], ids[j]))
            seconds.append(np.maximum(ids[i], ids[j]))
        none = [np.empty(0, np.int64)]
        return pa.Table.from_batches([record(schema, *(np.concatenate(none + x) for x in (lists, firsts, seconds)))])

    return compare


def link_components(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Signatures of all, and ``(node, component)`` of the linked documents; ``rows`` has id and text, and rows with
    one id have one text."""
    every = materialise(signatures(rows, frequency_class(shingle_counters(rows))))
    signed = every.where("n > 0 and id is not null")
    # a class is named by its smallest id, a group by its smallest class
    classes = signed.groupBy("d1", "d2").agg(
        F.min("id").alias("id"), F.first("n").alias("n"), F.first("p1").alias("p1"), F.first("p2").alias("p2")
    )
    classes = materialise(classes)
    groups = materialise(classes.groupBy("p1", "p2", "n").agg(F.min("id").alias("member"), F.count("*").alias("size")))
    classes = materialise(classes.join(groups, ["p1", "p2", "n"]).select("id", "n", "d1", "d2", "p1", "member", "size"))
    bitmaps = signed.select("id", "n", "d1", "d2", "bits").join(classes.select("id", "n", "d1", "d2"), ["id", "n", "d1", "d2"], "left_semi")
    bitmaps = materialise(bitmaps.select("id", "n", "bits").dropDuplicates(["id"]))
    leaders = classes.where("id = member").select("id", "n", "d1", "d2")
    lists = materialise(prefix_lists(signed.join(leaders, ["id", "n", "d1", "d2"], "left_semi")))
    same = classes.where("size > 1").select(F.col("p1").alias("key"), F.col("id"), "member")

    pairs = lists.where("leader <> member").select(F.least("leader", "member").alias("a"), F.greatest("leader", "member").alias("b"))
    pairs = pairs.unionAll(same.where("id <> member").select(F.col("member").alias("a"), F.col("id").alias("b"))).distinct()
    first = materialise(verified(_bitmap_filter(pairs, bitmaps), rows))
    found = components(first)

    of_groups = classes.where("size > 1").groupBy(F.col("p1").alias("key"), "member").agg(F.count("*").alias("c")).select("key", "member")
    lists = lists.select("key", "member").unionAll(of_groups)
    for spanning in (True, False):  # after the first round nearly all that links hangs together
        members, n_members = _open_lists(lists, classes, found)
        pairs = materialise(_block_pairs(members.join(bitmaps, "id"), n_members // BUNDLE_MEMBERS + 1, spanning))
        first = materialise(first.unionAll(verified(pairs.select("a", "b").distinct(), rows)))
        found = components(first)
        # a list without any pair has none between what its components become either
        lists = lists.join(pairs.select("key").distinct(), "key", "left_semi")
    # rows of a class tie their ids
    ties = signed.select("id", "d1", "d2").join(classes.select(F.col("id").alias("b"), "d1", "d2"), ["d1", "d2"]).where("id <> b").select(F.col("id").alias("a"), "b")
    edges = found.select(F.col("node").alias("a"), F.col("component").alias("b")).unionAll(ties)
    return every, components(edges)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` of every document."""
    rows = texts(docs, id_col, text_col)
    ids = docs.select(F.col(f"`{id_col}`").cast("long").alias("id")).where("id is not null").groupBy("id").count()
    if ids.where("count > 1").isEmpty():
        signed, found = link_components(rows)
        named = signed.select("id", "n").join(found.select(F.col("node").alias("id"), "component"), "id", "left")
        return named.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.coalesce("component", "id").alias("component_id"))
    # ids repeat: texts are linked under keys, then keys with one id are tied
    key = F.when(F.col("id").isNotNull(), F.xxhash64("id", "text"))
    keys = materialise(rows.select(key.alias("key"), "id").where("id is not null").distinct())
    signed, found = link_components(rows.select(key.alias("id"), "text"))
    least = keys.groupBy("id").agg(F.min("key").alias("b"))
    ties = keys.join(least, "id").where("key <> b").select(F.col("key").alias("a"), "b")
    tied = components(found.select(F.col("node").alias("a"), F.col("component").alias("b")).unionAll(ties))
    whole = keys.join(tied.select(F.col("node").alias("key"), "component"), "key", "left")
    whole = materialise(whole.select("key", "id", F.coalesce("component", "key").alias("component")))
    names = whole.groupBy("component").agg(F.min("id").alias("component_id"))
    named = whole.join(names, "component").select("key", F.col("id").alias("doc_id"), "component_id")
    every = signed.select(F.col("id").alias("key"), F.col("n").alias("n_shingles")).join(named, "key", "left")
    return every.select("doc_id", "n_shingles", "component_id")
