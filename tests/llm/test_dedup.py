"""Repeated windows, near copies and embeddings against brute force."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from themata.llm import components, hnsw, jaccard_join, run_index, superkmer
from themata.llm.batches import gather


def _kept_words(rows, window):
    seen, out = set(), {}
    for i, text in sorted(rows):
        words = (text or "").encode().split()
        gone = set()
        for k in range(len(words) - window + 1):
            item = tuple(words[k : k + window])
            if item in seen:
                gone.update(range(k, k + window))
            seen.add(item)
        out[i] = (len(words), len(gone), b" ".join(w for k, w in enumerate(words) if k not in gone).decode())
    return out


def _kept_bytes(rows, window):
    seen, out = set(), {}
    for i, text in sorted(rows):
        data = (text or "").encode()
        gone = np.zeros(len(data) + 1, int)
        for k in range(len(data) - window + 1):
            item = data[k : k + window]
            if item in seen:
                gone[k : k + window] = 1
            seen.add(item)
        spans = np.flatnonzero(np.diff(gone, prepend=0) == 1), np.flatnonzero(np.diff(gone, prepend=0) == -1)
        out[i] = (len(data), int(gone.sum()), [tuple(s) for s in zip(*(x.tolist() for x in spans))], bytes(b for b, g in zip(data, gone) if not g))
    return out


def test_superkmers_equal_brute_force(docs, rows):
    found = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept"]) for r in superkmer.remove_repeats(docs).collect()}
    assert found == _kept_words(rows, superkmer.WINDOW)


def test_run_index_equals_brute_force(docs, rows, monkeypatch):
    monkeypatch.setattr(run_index, "BUCKET_BYTES", 20_000)  # several buckets
    found = {
        r["doc_id"]: (r["n_bytes"], r["n_removed"], [tuple(s) for s in r["spans"]], bytes(r["kept"]))
        for r in run_index.remove_repeats(docs).collect()
    }
    assert found == _kept_bytes(rows, run_index.WINDOW)


@pytest.fixture(scope="module")
def headed():
    """A common line in different surroundings, some of which repeat, and one made of the line alone."""
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    line = " ".join(word() for _ in range(13))
    made = [" ".join([*(word() for _ in range(30)), line, *(word() for _ in range(30))]) for _ in range(300)]
    return list(enumerate([*made, *made[:5], f"{line} " * 12, f"x {line} " * 6]))


def _largest_group(module, packer, grams, column, table):
    """Bytes of strings in the largest group of one bucket."""
    import zstandard

    rows = superkmer.keyed(table, "doc_id", "text")
    size = sum(len(r["text"]) for r in rows.collect())
    schema = {superkmer: "bucket long, strings binary, docs binary, digests binary, starts binary, runs binary"}.get(
        module, "bucket long, text binary, lengths binary, marks binary, docs binary, digests binary, starts binary"
    )
    frequent = superkmer.shared(rows, superkmer.frequent(rows, grams(module.WINDOW), size))
    packed = rows.mapInArrow(packer(module.WINDOW, 1 << 20, frequent), schema).where(f"bucket < {1 << 20}")
    sums = {}
    for r in packed.collect():
        sums[r["bucket"]] = sums.get(r["bucket"], 0) + len(zstandard.ZstdDecompressor().decompress(bytes(r[column])))
    return max(sums.values())


def test_common_line_is_dealt(spark, headed, monkeypatch):
    """A line in all documents brings no bucket more than the bound, and the result stays."""
    table = spark.createDataFrame(headed, "doc_id long, text string").repartition(3)
    for module, packer, grams, column in [
        (superkmer, superkmer._packer, superkmer._word_grams, "strings"), (run_index, run_index._packer, run_index._byte_grams, "text"),
    ]:
        whole = _largest_group(module, packer, grams, column, table)
        with monkeypatch.context() as m:
            m.setattr(superkmer, "HOT_BYTES", 5000)
            split = _largest_group(module, packer, grams, column, table)
        assert whole > 10_000 and split < 5000


def test_results_with_common_lines_equal_brute_force(spark, headed, docs, rows, monkeypatch):
    table = spark.createDataFrame(headed, "doc_id long, text string").repartition(3)
    monkeypatch.setattr(run_index, "BUCKET_BYTES", 5000)
    monkeypatch.setattr(superkmer, "BUCKET_BYTES", 5000)
    for bound, given, made in [(8000, table, headed), (0, docs, rows)]:  # with 0 about all hashes are frequent
        monkeypatch.setattr(superkmer, "HOT_BYTES", bound)
        found = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept"]) for r in superkmer.remove_repeats(given).collect()}
        assert found == _kept_words(made, superkmer.WINDOW)
        found = {
            r["doc_id"]: (r["n_bytes"], r["n_removed"], [tuple(s) for s in r["spans"]], bytes(r["kept"]))
            for r in run_index.remove_repeats(given).collect()
        }
        assert found == _kept_bytes(made, run_index.WINDOW)


def test_run_index_intervals():
    rng = np.random.default_rng(1)
    text = rng.integers(97, 100, 3000).astype(np.uint8)
    text[1000:1400] = text[200:600]
    starts, lengths = np.array([0, 900, 1700]), np.array([900, 800, 1300])
    found = run_index.RunIndex(text, 12).intervals(text, starts, lengths, 12)
    names = {}
    for start, length in zip(starts, lengths):
        for k in range(start, start + length - 11):
            names.setdefault(text[k : k + 12].tobytes(), set()).add(found[k])
    assert all(len(v) == 1 for v in names.values()) and len(set().union(*names.values())) == len(names)


def test_parts_that_may_repeat():
    rng = np.random.default_rng(2)
    text = rng.integers(97, 123, 6000).astype(np.uint8)
    text[3000:3300] = text[500:800]
    text[5000:5120] = text[700:820]
    starts, lengths = np.array([0, 600, 650, 3100, 5500]), np.array([600, 50, 2450, 2400, 500])
    text = np.concatenate([text[a : a + n] for a, n in zip(starts, lengths)])
    starts = np.cumsum(lengths) - lengths
    windows = {}
    for which, (start, length) in enumerate(zip(starts.tolist(), lengths.tolist())):
        for k in range(length - 39):
            windows.setdefault(text[start + k : start + k + 40].tobytes(), []).append((which, k))
    repeated = {place for places in windows.values() if len(places) > 1 for place in places}
    left = [(w, a + k) for w, a, n in zip(*run_index._repetitive(text, starts, lengths, 40)) for k in range(n - 39)]
    assert len(set(left)) == len(left) and repeated <= set(left)
    assert len(left) < 2 * len(repeated)


@pytest.mark.parametrize("operator", [superkmer.remove_repeats, run_index.remove_repeats, jaccard_join.near_duplicates])
def test_empty_table(operator, nothing):
    assert operator(nothing).count() == 0


def test_repeated_and_null_ids(spark):
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(1, text), (1, text), (1, text + " more"), (None, text), (2, text)]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    found = sorted((str(r["doc_id"]), r["n_removed"]) for r in superkmer.remove_repeats(table).collect())
    # the null id comes first; of the two texts of id 1 one comes first, but all windows stand in the null row
    assert found == [("1", 40), ("1", 40), ("1", 40), ("2", 40), ("None", 0)]
    spans = sorted((str(r["doc_id"]), r["n_removed"] > 0) for r in run_index.remove_repeats(table).collect())
    assert spans == [("1", True), ("1", True), ("1", True), ("2", True), ("None", False)]
    near = sorted((str(r["doc_id"]), str(r["component_id"])) for r in jaccard_join.near_duplicates(table).collect())
    assert near == [("1", "1"), ("1", "1"), ("1", "1"), ("2", "1"), ("None", "None")]


def _components(rows):
    sets = {}
    for i, text in rows:
        words = (text or "").encode().lower().split()
        sets[i] = {tuple(words[k : k + 5]) for k in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} - {()}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= 80 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in sets}


def test_jaccard_join_equals_brute_force(docs, rows, monkeypatch):
    monkeypatch.setattr(jaccard_join, "LIST_BLOCK", 3)  # blocks meet in pairs
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.near_duplicates(docs).collect()}
    assert found == _components(rows)


def test_jaccard_join_of_many_near_copies(spark):
    rng = random.Random(9)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(150):
        words = list(base)
        for _ in range(rng.randint(0, 3)):
            words[rng.randrange(60)] = f"x{rng.randrange(40)}"
        rows.append((i, " ".join(words)))
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.near_duplicates(table).collect()}
    assert found == _components(rows)


def test_bitmaps_never_drop_a_link():
    rng = np.random.default_rng(2)
    for n in (1, 3, 40, 900):
        x = rng.integers(0, 2**63, n).astype(np.uint64)
        y = np.concatenate((x[: max(1, int(n * 0.9))], rng.integers(0, 2**63, n // 20).astype(np.uint64)))
        both, union = len(np.intersect1d(x, y)), len(np.union1d(x, y))
        bits = [np.frombuffer(jaccard_join.parity_bits(v), np.uint8) for v in (x, y)]
        if 100 * both >= 80 * union:
            assert jaccard_join.may_link(len(x), bits[0], len(y), bits[1])


@pytest.mark.parametrize("spanning", [True, False])
def test_bundles_of_lists(spanning):
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**63, (3, 400)).astype(np.uint64)
    made = [np.append(base[i % 3][: 300 + i], rng.integers(0, 2**63, i % 23).astype(np.uint64)) for i in range(90)]
    rows = [(k, i, i // 2) for k in (-5, 0, 7) for i in range(90) if rng.random() < 0.7]
    bits = [jaccard_join.parity_bits(m) for m in made]
    table = pa.table({
        "key": [k for k, _, _ in rows], "id": [i for _, i, _ in rows], "component": [c for _, _, c in rows],
        "n": [len(made[i]) for _, i, _ in rows], "bits": [bits[i] for _, i, _ in rows],
    })
    found = jaccard_join._bundle_pairs(spanning)(table).to_pylist()
    may = lambda a, b: jaccard_join.may_link(
        len(made[a]), np.frombuffer(bits[a], np.uint8), len(made[b]), np.frombuffer(bits[b], np.uint8)
    )
    every = {(k, a, b) for k, a, c in rows for k2, b, d in rows if k == k2 and a < b and c != d and may(a, b)}
    pairs = {(r["key"], r["a"], r["b"]) for r in found}
    assert len(pairs) == len(found) and every

    def classes(links):
        root = {(k, c): (k, c) for k, _, c in rows}
        for k, a, b in sorted(links):
            x, y = root[k, a // 2], root[k, b // 2]
            root = {v: x if r == y else r for v, r in root.items()}
        return {frozenset(v for v in root if root[v] == r) for r in root.values()}

    if spanning:  # a forest over the components of each list
        assert pairs <= every and classes(pairs) == classes(every)
        assert len(pairs) == len({(k, c) for k, _, c in rows}) - len(classes(every))
    else:
        assert pairs == every


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(0, 40)]
    star = [(100, i) for i in range(101, 160)]
    edges = spark.createDataFrame(chain + star + [(7, 7)], "a long, b long")
    found = {r["node"]: r["component"] for r in components.components(edges).collect()}
    assert found == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 160)}}


def test_embeddings_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(hnsw, "SHARD", 300)
    rng = np.random.default_rng(4)
    x = rng.normal(0, 1, (900, 16))
    x[500:560] = x[3] + rng.normal(0, 0.05, (60, 16))  # a dense group
    x[700:720] = x[5]  # exact copies
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = unit @ unit.T >= hnsw.THRESHOLD
    rows = [(i, v) for i, v in enumerate(x.tolist())]
    odd = [(1000, None), (1001, [0.0] * 16), (1002, [float("nan")] * 16), (1003, []), (None, x[3].tolist()), (1004, [1.0, float("inf")]), (1005, [1.0, 2.0])]
    table = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>").repartition(3)
    found = {r["vec_id"]: r for r in hnsw.near_duplicates(table).collect()}
    counts = np.array([found[i]["n_links"] for i in range(900)])
    assert (counts <= near.sum(axis=1) - 1).all() and counts.sum() >= 0.95 * (near.sum() - 900)
    assert found[510]["component_id"] == 3 and found[719]["component_id"] == 5 and not found[719]["kept"]
    assert all(found[i]["n_links"] == 0 and found[i]["kept"] for i in (1000, 1001, 1002, 1003, 1004, 1005, None))
    assert hnsw.near_duplicates(table.limit(0)).count() == 0


def test_links_of_texts_that_share_an_id(spark):
    """Each text of an id keeps its own links: many ids with two unrelated texts, and near copies of both."""
    rng = random.Random(4)
    made, want = [], {}
    for i in range(20):
        for side in (0, 1):
            words = ["".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(60 + 40 * side)]
            made.append((i, " ".join(words)))
            for copy in (0, 1):
                words[rng.randrange(len(words))] = "changed"
                other = 1000 + 100 * i + 10 * side + copy
                made.append((other, " ".join(words)))
                want[other] = i
    table = spark.createDataFrame(made, "doc_id long, text string").repartition(3)
    found = {(r["doc_id"], r["component_id"]) for r in jaccard_join.near_duplicates(table).collect()}
    assert found == {(i, i) for i in range(20)} | set(want.items())


def peak_of(work):
    """Bytes that ``work`` holds at most, its result included, and the result."""
    tracemalloc.start()
    try:
        found = work()
        return tracemalloc.get_traced_memory()[1], found
    finally:
        tracemalloc.stop()


def test_gathering_holds_few_places_at_once():
    flat, n = np.arange(1 << 22, dtype=np.int64).astype(np.uint8), 1 << 15
    codes = np.arange(n)[::-1]
    starts, lengths = np.arange(n) * 128, np.full(n, 128)
    peak, (text, ends) = peak_of(lambda: gather(flat, starts, lengths, codes))
    assert (text.reshape(n, 128) == flat.reshape(n, 128)[::-1]).all() and ends[-1] == len(flat)
    assert peak < 5 * len(flat)  # a byte each, and places of a part


def test_sorting_rotations_holds_few_copies():
    text = np.random.default_rng(0).integers(97, 101, 1 << 18).astype(np.uint8)
    peak, index = peak_of(lambda: run_index.RunIndex(text, 100))
    assert peak < 64 * len(text)
    assert (index.intervals(text, np.array([0]), np.array([len(text)]), 100)[: len(text) - 99] >= 0).all()
