"""Exact duplicates, ranked lexical search and hard negatives against brute force."""

import hashlib
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from themata.llm import exact_dedup, hard_negatives, lexical_search
from themata.llm.topk import Best

WHITE = re.compile(r"[\x20\x09-\x0D]")
TERMS = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# -- exact duplicates -----------------------------------------------------------------------------


def brute_duplicates(rows):
    """(id, keep_id, group_size, kept, digest) of rows (id, text), as a sorted list."""
    groups = {}
    for number, (i, text) in enumerate(rows):
        groups.setdefault(WHITE.sub("", text or ""), []).append((-len(text or ""), i is None, i or 0, number))
    out = []
    for text, members in groups.items():
        digest = hashlib.sha256(text.encode()).hexdigest()
        first = rows[min(members)[3]][0]
        same = [m for m in members if m[:3] == min(members)[:3]]
        for m in members:  # of rows that agree in all, one stays: they cannot be told apart in the result
            out.append((str(rows[m[3]][0]), str(first), len(members), m == same[0], digest))
    return sorted(out)


def found_duplicates(df):
    marked = exact_dedup.mark_duplicates(df).withColumn("hex", F.lower(F.hex("digest")))
    return sorted((str(r["id"]), str(r["keep_id"]), r["group_size"], r["kept"], r["hex"]) for r in marked.collect())


@pytest.fixture(scope="module")
def copied():
    rng = random.Random(5)
    texts = ["".join(rng.choice("ab \t\né") for _ in range(rng.randint(0, 6))) for _ in range(400)] + [None, "", "\x0b\x0c\r", "x y", "xy", "x" * 100_000]
    rows = [(i, t) for i, t in enumerate(texts)]
    return rows + [(None, "solo"), (None, "ab"), (None, "ab"), (3, texts[3]), (3, texts[3]), (9, " solo "), (7_000, "hot"), *((8_000 + i, "h o t") for i in range(300))]


@pytest.mark.parametrize("heavy", [10_000, 3])
@pytest.mark.parametrize("slots", [1 << 30, 64])
def test_exact_duplicates_equal_brute_force(spark, copied, heavy, slots, monkeypatch):
    monkeypatch.setattr(exact_dedup, "HEAVY", heavy)  # 3: most groups go by the shuffle, the hot one by broadcast
    monkeypatch.setattr(exact_dedup, "MAX_SLOTS", slots)  # 64: every slot is crowded and nothing passes straight through
    df = spark.createDataFrame([(i, t, "k", 1) for i, t in copied], "doc_id long, text string, digest string, row int").repartition(5)
    assert found_duplicates(df) == brute_duplicates(copied)


def test_single_rows_pass_straight_through(spark):
    rows = [(i, f"text number {i}") for i in range(3000)] + [(5000 + i, f"text number {i}") for i in range(100)]
    found = exact_dedup.fingerprints(spark.createDataFrame(rows, "doc_id long, text string"))
    slots = exact_dedup.filter_size(found.count())
    flagged = exact_dedup.with_flag(found, exact_dedup.crowded_slots(found, slots), slots).cache()
    repeated = {r["id"] for r in flagged.where("repeated").select("id").collect()}
    assert set(range(100)) | set(range(5000, 5100)) <= repeated and len(repeated) < 300
    plan = flagged._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and "Python" not in plan and "InArrow" not in plan


def test_rows_that_stay(spark, copied):
    df = spark.createDataFrame([(i, t, "a", 1.0) for i, t in copied], "doc_id long, text string, key string, __row double")
    kept = exact_dedup.drop_duplicates(df)
    assert kept.columns == df.columns
    want = sorted(digest for *_, kept_, digest in brute_duplicates(copied) if kept_)
    assert sorted(hashlib.sha256(WHITE.sub("", r["text"] or "").encode()).hexdigest() for r in kept.collect()) == want
    assert exact_dedup.mark_duplicates(df.limit(0)).count() == 0 and exact_dedup.drop_duplicates(df.limit(0)).count() == 0


# -- ranked lexical search ------------------------------------------------------------------------


def brute_search(docs, items, k):
    split = lambda text: TERMS.findall((text or "").translate(LOWER))
    terms = [(i, split(t)) for i, t in docs]
    n_docs, n_terms = sum(bool(t) for _, t in terms), sum(len(t) for _, t in terms)
    df = {}
    for _, own in terms:
        for t in set(own):
            df[t] = df.get(t, 0) + 1
    out = []
    for item, text in items:
        scored = []
        for row, (i, own) in enumerate(terms):
            score = 0
            for t in split(text):
                tf = own.count(t)
                if tf:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += w * ((1_000_000_000 * tf) // (1000 * tf + 8 * (25 + (75 * len(own) * n_docs) // n_terms)))
            if score > 0:
                scored.append((-score, i is None, i or 0, row))
        out += [(str(item), r + 1, str(docs[s[3]][0]), -s[0]) for r, s in enumerate(sorted(scored)[:k])]
    return sorted(out)


@pytest.mark.parametrize("tile", [(128, 4096, 1024, 1 << 20), (2, 5, 7, 40)])
def test_search_equals_brute_force(spark, rows, docs, tile, monkeypatch):
    for name, value in zip(("TILE_ITEMS", "TILE_TERMS", "TILE_DOCS", "ROUND_TERMS"), tile):
        monkeypatch.setattr(lexical_search, name, value)
    long_words = rows[6][1].split()
    asked = [
        (1, " ".join(long_words[:12])), (1, "of THE the, ab!"), (None, "the the x" + "x" * 4999), (None, None), (2, ""), (3, "zzz nowhere"),
        (4, " ".join(long_words)), (5, "\U0001f600 İaß"), (6, rows[7][1]),
    ]
    given = [*rows, (None, rows[6][1]), (2, rows[6][1]), (2, rows[6][1])]
    more = spark.createDataFrame([(i, t, "en", 0, 0.0, "k") for i, t in given[len(rows):]], docs.schema)
    items = spark.createDataFrame([(i, t, 1.0) for i, t in asked], "item_id long, text string, score double").repartition(2)
    found = lexical_search.search(docs.unionAll(more), items, 10).collect()
    assert sorted((str(r["item_id"]), r["rank"], str(r["doc_id"]), r["score"]) for r in found) == brute_search(given, asked, 10)


def test_weights_beyond_the_exact_bound_are_cut():
    limit = lexical_search.EXACT // lexical_search.MAX_IMPACT - 1
    big = [(np.array([0, 2]), np.array([3 * limit + 7, 5])), (np.array([1, 2]), np.array([limit, limit - 1]))]
    (tile,) = lexical_search.tiles(big)
    sums = {c: tile.weights[:, tile.codes == c].sum(1).astype(int).tolist() for c in range(3)}
    assert sums == {0: [3 * limit + 7, 0], 1: [0, limit], 2: [5, limit - 1]}
    assert max(tile.weights[:, a:b].sum(1).max() for a, b in zip(tile.cuts, tile.cuts[1:])) * lexical_search.MAX_IMPACT < 2**53


def test_search_of_nothing(spark, docs, nothing):
    items = spark.createDataFrame([(1, "the of")], "item_id long, text string")
    assert lexical_search.search(nothing, items).count() == 0
    assert lexical_search.search(docs, items.limit(0)).count() == 0
    assert lexical_search.search(docs, items).count() == 10


def test_best_entries_do_not_depend_on_their_order():
    rng = np.random.default_rng(1)
    entries = [(int(rng.integers(0, 3)), int(rng.integers(0, 4)), bool(rng.random() < 0.2), int(rng.integers(0, 9)), i) for i in range(200)]
    want = [e for key in range(3) for e in sorted((e for e in entries if e[0] == key), key=lambda e: (-e[1], e[2], e[3], e[4]))[:6]]
    for order in (rng.permutation(200), np.arange(200)):
        best = Best(3, 6, np.int64)
        for part in np.array_split(order, 9):
            best.offer(*(np.array(x) for x in zip(*[entries[i] for i in part])))
            best.settle()
        assert list(zip(*(x.tolist() for x in best.entries))) == want
        assert best.floor.tolist() == [min(e[1] for e in want if e[0] == key) for key in range(3)]


# -- hard negatives -------------------------------------------------------------------------------


def brute_negatives(table, step=10):
    rows = []
    for i, v, label in table:
        if v is None or label is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        if i is not None and i % 7 == 0:
            label = (label + 1) % 10
        rows.append((i, [math.floor(256 * x) for x in v], label))
    out = []
    for a, (anchor, v, label) in enumerate(rows):
        if anchor is None or anchor % step:
            continue
        scored = [(-sum(x * y for x, y in zip(v, w)), i is None, i or 0, k, i, own) for k, (i, w, own) in enumerate(rows)]
        scored.sort(key=lambda s: s[:4])
        for s, *_, k, p, own in [s for s in scored if s[5] == label and s[3] != a][:5]:
            fits = [t for t in scored if t[5] != label and 30 * -s <= 100 * -t[0] <= 90 * -s]
            out += [(anchor, str(p), r + 1, str(t[4]), -s, -t[0]) for r, t in enumerate(fits[:10])]
    return sorted(out)


def vectors(kind, n, rng):
    if kind == "spread":
        return rng.normal(size=(n, 6))
    if kind == "ties":
        return rng.integers(-2, 3, (n, 4)) / 4
    if kind == "large":  # products beyond 2^53
        return rng.normal(size=(n, 4)) * 1e6
    centres = rng.normal(size=(8, 6)) * 4
    return centres[np.arange(n) % 8] + rng.normal(size=(n, 6)) * 0.01


@pytest.mark.parametrize("kind", ["spread", "ties", "large", "clusters"])
def test_negatives_equal_brute_force(spark, kind, monkeypatch):
    monkeypatch.setattr(hard_negatives, "ANCHORS", 13)
    monkeypatch.setattr(hard_negatives, "ROWS", 50)
    x = vectors(kind, 400, np.random.default_rng(3)).astype(np.float32).astype(float).tolist()
    table = [(i, v, i * 7 % 4) for i, v in enumerate(x)]
    table += [(20, x[21], 1), (20, x[21], 1), (None, x[5], 2), (None, x[20], 3), (1000, None, 1), (1010, x[0], None), (1020, [*x[0][:-1], None], 1),
              (1030, [*x[0][:-1], math.nan], 1), (1040, [*x[0][:-1], math.inf], 1), (1050, [0.0] * len(x[0]), 2)]
    df = spark.createDataFrame([(*r, "k") for r in table], "vec_id long, embedding array<double>, label int, row string").coalesce(3)
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    found = hard_negatives.mine(df, label, F.col("id") % 10 == 0).collect()
    got = sorted((r["anchor_id"], str(r["positive_id"]), r["rank"], str(r["negative_id"]), r["positive_score"], r["negative_score"]) for r in found)
    assert got == brute_negatives(table)


def test_tree_spans_and_prunes():
    rng = np.random.default_rng(4)
    x = np.floor(256 * vectors("clusters", 600, rng))
    tree = hard_negatives.spanning_tree(x[:64], np.zeros(64), np.arange(64))
    assert sorted(np.concatenate(tree.levels).tolist()) == list(range(64))
    assert np.allclose(tree.length, np.sqrt(((x[:64] - x[tree.parent]) ** 2).sum(1)))
    exact = x[:64] @ x.T
    low, high = np.full(64, 0.6 * exact.max()), np.full(64, np.inf)
    pairs, scored = {}, 0
    for a, r, scores, n in hard_negatives.walk(tree, x, low, high, lambda level: np.ones((len(level), len(x)), bool)):
        pairs.update(zip(zip(a.tolist(), r.tolist()), scores.tolist()))
        scored += n
    assert pairs == {(a, r): exact[a, r] for a, r in np.argwhere(exact >= low[:, None]).tolist()}
    assert scored < 0.5 * exact.size  # neighbours of the parent's far rows are not scored again


def test_negatives_of_nothing(spark):
    df = spark.createDataFrame([(0, [1.0, 2.0], 1)], "vec_id long, embedding array<double>, label int")
    assert hard_negatives.mine(df, F.col("label"), F.col("id") % 10 == 0).count() == 0  # an anchor without positives
    assert hard_negatives.mine(df.limit(0), F.col("label"), F.col("id") % 10 == 0).count() == 0
