import math

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from themata import cluster
from themata.operators import dictionary as D, ngrams, pairs, weights
from themata.plans import features as features_module
from themata.plans.features import FeatureModel


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def python_tokens(corpus_tokens):
    return {r["doc_id"]: (r["label"], r["tokens"]) for r in corpus_tokens.collect()}


def test_pmi_by_hand(spark):
    tokens = spark.createDataFrame([(1, ["a", "b", "a", "b"]), (2, ["a", "b", "c"])], "doc_id long, tokens array<string>")
    scored = {r["term"]: (r["freq"], r["pmi"]) for r in ngrams.bigram_pmi(ngrams.ngram_counts(tokens), 1).collect()}
    # 7 tokens: a 3, b 3, c 1; pairs stay inside documents
    assert scored["a b"] == (3, pytest.approx(math.log2(3 * 7 / 9)))
    assert scored["b a"] == (1, pytest.approx(math.log2(7 / 9)))
    assert scored["b c"] == (1, pytest.approx(math.log2(7 / 3)))
    assert len(scored) == 3
    kept = ngrams.fit_bigrams(tokens, 1, 2)
    assert [r["term"] for r in kept.collect()] == ["a b"]


def test_append_bigrams_both_ways(spark, monkeypatch):
    tokens = spark.createDataFrame(
        [(1, ["a", "b", "a", "b"]), (2, ["c"]), (3, []), (4, ["b", "c", "a", "b"])], "doc_id long, tokens array<string>")
    kept = spark.createDataFrame([("a b",), ("b c",)], "term string")
    inline = rows(ngrams.append_bigrams(tokens, kept, 2))
    monkeypatch.setattr(ngrams, "INLINE_TERMS", 0)
    joined = rows(ngrams.append_bigrams(tokens, kept, 2))
    assert inline == joined == [
        (1, ["a", "b", "a", "b", "a b", "a b"]), (2, ["c"]), (3, []), (4, ["b", "c", "a", "b", "b c", "a b"])]


def test_dictionary_ids_follow_first_sight(spark):
    data = [(d, [f"w{(d * 7 + i) % 23}" for i in range(9)]) for d in range(40)]
    tokens = spark.createDataFrame(data, "doc_id long, tokens array<string>").repartition(5)
    seen = {}
    for _, words in data:
        for w in words:
            seen.setdefault(w, len(seen))
    assert {r["term"]: r["term_id"] for r in D.dictionary(tokens).collect()} == seen


def test_selection_tf_idf_against_numpy(spark, corpus_tokens):
    docs = python_tokens(corpus_tokens)
    vocabulary = sorted({t for _, ts in docs.values() for t in ts})
    ids = sorted(docs)
    m = np.array([[docs[d][1].count(t) for t in vocabulary] for d in ids], float)
    y = np.array([docs[d][0] for d in ids])
    tf = np.array([m[y == c].sum(0) / m[y == c].sum() for c in sorted(set(y))])
    var = tf.var(axis=0)
    order = sorted(range(len(vocabulary)), key=lambda j: (-round(var[j], 15), vocabulary[j]))[:6]
    model = FeatureModel.fit(corpus_tokens, n_dims=6, method="entropy")
    assert [r["term"] for r in model.vocabulary()] == [vocabulary[j] for j in order]
    assert np.allclose([r["var"] for r in model.vocabulary()], var[order])

    small = m[:, order]
    with np.errstate(all="ignore"):
        w = np.nan_to_num(small / small.sum(1, keepdims=True)) * np.log(len(ids) / (small > 0).sum(0))
        p = w / w.sum(0)
        e = 1 + np.where(p > 0, p * np.log(np.where(p > 0, p, 1)), 0).sum(0) / np.log(len(ids))
    want = e * np.log1p(w)
    dense = {r["doc_id"]: r["v"] for r in model.vectors(corpus_tokens).select("doc_id", vector_to_array("features").alias("v")).collect()}
    assert np.allclose([dense[d] for d in ids], want)  # every document is there, empty ones as zeros
    long = {(r["doc_id"], r["term_id"]): r["w"] for r in model.weights(corpus_tokens).collect()}
    assert all(abs(want[ids.index(d), j] - value) < 1e-12 for (d, j), value in long.items())
    assert len(long) == (small > 0).sum()


def test_large_selection_takes_the_join(corpus_tokens, monkeypatch):
    model = FeatureModel.fit(corpus_tokens, n_dims=6)
    inline = rows(model.tfidf(corpus_tokens))
    monkeypatch.setattr(features_module, "INLINE_TERMS", 0)
    assert rows(model.tfidf(corpus_tokens)) == inline


def test_transforms(corpus_tokens):
    for method, function in (("binary", lambda w: float(w > 0)), ("log", math.log1p), ("none", lambda w: w)):
        model = FeatureModel.fit(corpus_tokens, n_dims=6, method=method)
        plain = {r[:2]: r[2] for r in rows(model.tfidf(corpus_tokens))}
        assert {r[:2]: r[2] for r in rows(model.weights(corpus_tokens))} == pytest.approx({k: function(w) for k, w in plain.items()})
    entropy = FeatureModel.fit(corpus_tokens, n_dims=6, method="entropy")
    as_log = FeatureModel.fit(corpus_tokens, n_dims=6, method="log")
    assert rows(entropy.weights(corpus_tokens, compat=True)) == rows(as_log.weights(corpus_tokens))
    # re-estimated on the same rows, the weights are the same
    assert [r[2] for r in rows(entropy.weights(corpus_tokens, refit=True))] == pytest.approx(
        [r[2] for r in rows(entropy.weights(corpus_tokens))])
    with pytest.raises(ValueError):
        FeatureModel.fit(corpus_tokens, method="cubic")
    with pytest.raises(RuntimeError):
        weights.transform_weights(entropy.tfidf(corpus_tokens), "entropy")


def test_bigrams_come_from_training_only(spark, corpus_tokens):
    model = FeatureModel.fit(corpus_tokens, n_dims=50, n_bigrams=5, bigram_min_freq=2)
    terms = {r["term"] for r in model.vocabulary()}
    assert "INTEREST RATE" in terms
    test = spark.createDataFrame([(9, ["INTEREST", "RATE", "OTHER", "PAIR"])], "doc_id long, tokens array<string>")
    named = {r["term_id"]: r["term"] for r in model.vocabulary()}
    assert {named[r["term_id"]] for r in model.counts(test).collect()} == {"INTEREST", "RATE", "INTEREST RATE"}


@pytest.mark.parametrize("top, block", [(5, 4096), (40, 4096), (40, 4), (1000, 3)])
def test_pair_information_against_all_pairs(corpus_tokens, top, block, monkeypatch):
    monkeypatch.setattr(pairs.joint_counts, "__defaults__", (block,))
    model = FeatureModel.fit(corpus_tokens, n_dims=15)
    docs = python_tokens(corpus_tokens)
    df = {r["term"]: r["df"] for r in model.vocabulary()}
    order = sorted(df, key=lambda t: (df[t], t))
    want = []
    for i, a in enumerate(order):
        for j in range(i + 1, len(order)):
            b = order[j]
            agree = sum((a in ts) == (b in ts) for _, ts in docs.values())
            if agree:
                want.append((-math.log2(len(docs) * agree / (df[a] * df[b])), i, j, a, b, agree))
    want = sorted(want)[:top]
    got = pairs.term_pair_mi(model.count_vectors(corpus_tokens), model.vocabulary(), model.n_docs, top).collect()
    assert {(r["term_a"], r["term_b"], r["agree"]) for r in got} == {w[3:] for w in want}


def test_dense_ids_over_many_partitions(spark):
    df = spark.range(1000).withColumn("k", F.xxhash64("id")).repartition(7)
    out = cluster.with_dense_id(df, ["k"], "n", partitions=6).orderBy("n").collect()
    assert [r["n"] for r in out] == list(range(1000))
    assert [r["k"] for r in out] == sorted(r["k"] for r in out)


def test_variance_with_absent_classes(spark):
    tf = spark.createDataFrame([("a", "x", 0.5), ("b", "x", 0.1), ("a", "y", 0.25)], "label string, term string, tf double")
    got = {r["term"]: r["var"] for r in D.class_variance(tf, 3).collect()}
    assert got == pytest.approx({"x": np.var([0.5, 0.1, 0]), "y": np.var([0.25, 0, 0])})


def test_lists_of_every_size_act_alike(spark, monkeypatch):
    """Look-up in the row and join give the same rows, also with repeated and null ids and null labels."""
    from themata.operators import ngrams, preprocess
    from themata.plans import features

    rows = [(1, "x", ["A", "B", "C"]), (1, "y", ["C", "C"]), (None, "x", ["D", "B"]), (2, None, ["A"]), (3, "y", [])]
    tokens = spark.createDataFrame(rows, "doc_id long, label string, tokens array<string>").coalesce(2)
    words = spark.createDataFrame([("B",), ("D",)], "term string")
    kept = spark.createDataFrame([("A B",), ("C C",)], "term string")

    def results():
        model = features.FeatureModel.fit(tokens, n_dims=3)
        return [
            sorted(map(str, df.collect()))
            for df in (
                preprocess.drop_stopwords(tokens, words), preprocess.mark_lexicon(tokens, words),
                ngrams.append_bigrams(tokens, kept, 2), model.counts(tokens),
            )
        ]

    inline = results()
    monkeypatch.setattr(preprocess, "inline_terms", lambda terms: None)
    monkeypatch.setattr(ngrams, "INLINE_TERMS", 0)
    monkeypatch.setattr(features, "INLINE_TERMS", 0)
    assert results() == inline


def test_small_variances_are_told_apart(spark):
    from themata.operators.dictionary import select_terms

    rows = [("a", 1e-20), ("b", 3e-20), ("c", 0.0), ("d", 2e-3), ("e", 3e-20 * (1 + 1e-14))]
    found = select_terms(spark.createDataFrame(rows, "term string, var double"), 4)
    assert [r["term"] for r in found.collect()] == ["d", "b", "e", "a"]
