import sys
import unicodedata

import pytest
from pyspark.sql import functions as F

from themata.functions import text as T
from themata.functions.arrays import argmax, bag, one_hot, pairs
from themata.functions.greek import stem_tokens, stem_word
from themata.operators.preprocess import drop_stopwords, mark_lexicon, preprocess


def without_marks(text):
    return "".join(c for c in unicodedata.normalize("NFD", text) if unicodedata.category(c) != "Mn")


def test_strip_accents_on_all_characters(spark):
    blocks = []
    for start in range(0, sys.maxunicode + 1, 256):
        chars = [chr(c) for c in range(start, start + 256) if not 0xD800 <= c <= 0xDFFF]
        blocks += [(c,) for c in chars if without_marks(c) != c][:64] or [("".join(chars),)]
    df = spark.createDataFrame(blocks, "t string").repartition(4)
    wrong = [r for r in df.select("t", T.strip_accents(F.col("t")).alias("s")).collect() if r["s"] != without_marks(r["t"])]
    assert not wrong


@pytest.mark.parametrize(
    "text, default, as_written",
    [
        ("TIMH 3.14 EYPO", ["TIMH", "314", "EYPO"], ["TIMH", "4", "EYPO"]),
        ("3.5", ["35"], []),
        ("1.234,56", ["123456"], ["3", "6"]),
        ("Η.Π.Α. ΝΕΑ", ["ΗΠΑ", "ΝΕΑ"], ["ΝΕΑ"]),
        ("Α.Β.Γ.Δ.Ε. X", ["ΑΒΓΔΕ", "X"], ["Δ", "X"]),
    ],
)
def test_decimals_and_acronyms(spark, text, default, as_written):
    df = spark.createDataFrame([(text,)], "t string")
    row = df.select(T.tokenize(F.col("t")).alias("a"), T.tokenize(F.col("t"), compat=True).alias("b")).first()
    full = lambda tokens: [t for t in tokens if t]
    assert full(row["a"]) == default
    # as written, digits and parts turn into control characters, which the clean-up blanks out
    assert full(row["b"]) == as_written


def test_long_run_without_dot_is_linear(spark):
    row = spark.createDataFrame([("A" * 300_000,)], "t string").select(F.size(T.tokenize(F.col("t"))).alias("n")).first()
    assert row["n"] == 1


def test_bag_and_pairs(spark):
    df = spark.createDataFrame([(["b", "a", "b"],), (["x"],), ([],)], "t array<string>")
    rows = df.select(bag(F.col("t")).alias("b"), pairs(F.col("t")).alias("p")).collect()
    assert [[(x["term"], x["n"]) for x in r["b"]] for r in rows] == [[("a", 1), ("b", 2)], [("x", 1)], []]
    assert [[tuple(x) for x in r["p"]] for r in rows] == [[("b", "a"), ("a", "b")], [], []]


def test_argmax_and_one_hot(spark):
    row = spark.createDataFrame([([0.1, 0.7, 0.7],)], "s array<double>").select(
        argmax(F.col("s")).alias("i"), one_hot(argmax(F.col("s")), 3).alias("o")).first()
    assert row["i"] == 1 and row["o"] == [0.0, 1.0, 0.0]


# one word per step: ending cut, ending put back
STEMS = {
    "ΦΑΓΙΑ": "ΦΑ", "ΚΡΕΑΤΩΝ": "ΚΡΕ", "ΓΕΓΟΝΟΤΑ": "ΓΕΓΟΝ",
    "ΠΑΠΑΔΕΣ": "ΠΑΠΑΔ", "ΜΑΜΑΔΕΣ": "ΜΑΜ",
    "ΚΑΦΕΔΕΣ": "ΚΑΦ", "ΓΗΠΕΔΩΝ": "ΓΗΠΕΔ",
    "ΑΡΚΟΥΔΕΣ": "ΑΡΚΟΥΔ", "ΠΑΠΠΟΥΔΕΣ": "ΠΑΠΠ",
    "ΥΠΟΘΕΣΕΩΝ": "ΥΠΟΘΕΣ", "ΘΕΩΝ": "ΘΕ",
    "ΟΙΚΟΝΟΜΙΑ": "ΟΙΚΟΝΟΜ", "ΒΙΒΛΙΟ": "ΒΙΒΛΙ", "ΠΑΛΙΟΣ": "ΠΑΛΑΙ", "ΠΑΛΙΑ": "ΠΑΛΑ",
    "ΠΟΛΙΤΙΚΗ": "ΠΟΛΙΤ", "ΤΕΧΝΙΚΩΝ": "ΤΕΧΝΙΚ", "ΦΟΙΝΙΚΟΣ": "ΦΟΙΝΙΚ",
    "ΑΓΑΜΕ": "ΑΓΑΜ", "ΑΓΑΠΗΣΑΜΕ": "ΑΓΑΠ", "ΠΟΤΑΜΕ": "ΠΟΤΑΜ",
    "ΑΓΑΠΗΣΑΝΕ": "ΑΓΑΠ", "ΤΡΑΓΑΝΕ": "ΤΡΑΓΑΝ", "ΒΕΤΕΡΑΝΕ": "ΒΕΤΕΡΑΝ",
    "ΑΓΑΠΗΣΕΤΕ": "ΑΓΑΠ", "ΒΕΝΕΤΕ": "ΒΕΝΕΤ",
    "ΑΡΧΟΝΤΑΣ": "ΑΡΧΟΝΤ", "ΚΡΕΩΝΤΑΣ": "ΚΡΕΩΝΤ", "ΛΕΓΟΝΤΑΣ": "ΛΕΓ",
    "ΟΝΟΜΑΣΤΕ": "ΟΝΟΜΑΣΤ", "ΛΕΓΟΜΑΣΤΕ": "ΛΕΓ",
    "ΠΙΕΣΤΕ": "ΠΙΕΣΤ", "ΑΛΕΣΤΕ": "ΑΛΕΣΤ", "ΛΥΘΕΙΕΣΤΕ": "ΛΥΘΕ",
    "ΑΓΑΠΗΘΗΚΕ": "ΑΓΑΠ", "ΠΡΟΣΘΗΚΕΣ": "ΠΡΟΣΘΗΚ",
    "ΦΑΡΜΑΚΟΥΣΑ": "ΦΑΡΜΑΚΟΥΣ", "ΓΝΩΡΙΖΟΥΣΑ": "ΓΝΩΡΙΖ",
    "ΝΑΥΑΓΕ": "ΝΑΥΑΓ", "ΚΟΛΛΑΓΕ": "ΚΟΛΛ", "ΨΟΦΑΓΕ": "ΨΟΦ",
    "ΕΡΗΜΟΝΗΣΑ": "ΕΡΗΜΟΝΗΣ", "ΑΓΑΠΗΣΕ": "ΑΓΑΠ",
    "ΧΡΗΣΤΕ": "ΧΡΗΣΤ", "ΑΓΑΠΗΣΤΕ": "ΑΓΑΠ",
    "ΣΠΙΟΥΝΕ": "ΣΠΙΟΥΝ", "ΑΓΑΠΟΥΝΕ": "ΑΓΑΠ",
    "ΠΑΡΑΣΟΥΣΟΥΜΕ": "ΠΑΡΑΣΟΥΣΟΥΜ", "ΑΓΑΠΟΥΜΕ": "ΑΓΑΠ",
    "ΓΡΑΜΜΑΤΑ": "ΓΡΑΜΜΑ", "ΣΤΑΜΑΤΑ": "ΣΤΑΜΑΤ", "ΟΝΟΜΑΤΟΣ": "ΟΝΟΜ",
    "ΑΝΘΡΩΠΟΙ": "ΑΝΘΡΩΠ", "ΜΑΘΗΤΗΣ": "ΜΑΘΗΤ",
    "ΚΑΛΥΤΕΡΟΣ": "ΚΑΛ", "ΕΞΩΤΕΡΟΣ": "ΕΞΩΤΕΡ", "ΜΟΤΕΡΟΣ": "ΜΥΤ",
    "ΝΑ": "ΝΑ", "HELLO": "HELLO", "ΑΒC": "ΑΒC",
}


def test_stems(spark):
    df = spark.createDataFrame([(w, s) for w, s in STEMS.items()], "word string, want string").coalesce(1)
    got = {r["word"]: r["got"] for r in df.select("word", stem_word("word").alias("got")).collect()}
    assert got == STEMS


def test_protected_words_and_arrays(spark):
    df = spark.createDataFrame([(["ΑΝΘΡΩΠΟΙ", "HELLO", "ΚΑΛΥΤΕΡΟΣ"],), (["HELLO"],)], "t array<string>")
    rows = df.select(stem_tokens("t", protected=["ΚΑΛΥΤΕΡΟΣ"]).alias("s")).collect()
    assert [r["s"] for r in rows] == [["ΑΝΘΡΩΠ", "HELLO", "ΚΑΛΥΤΕΡΟΣ"], ["HELLO"]]


def test_preprocess_order(spark):
    df = spark.createDataFrame([(1, "Η Ελλάδα και οι άνθρωποι, 2 αυτοκίνητα12 it's Γερμανίας")], "doc_id long, text string")
    out = preprocess(df, stopwords=["ΚΑΙ", "Η", "ΟΙ"], places=["ΕΛΛΑΔ", "ΓΕΡΜΑΝ"]).first()["tokens"]
    assert out == ["COUNTRYVALUE", "ΑΝΘΡΩΠ", "NUMBERVALUE", "NUMBERVALUE", "COUNTRYVALUE"]


def test_large_lexicons_take_the_join(spark, monkeypatch):
    df = spark.createDataFrame([(1, ["a", "b", "a", "c"]), (2, ["b"]), (3, [])], "doc_id long, tokens array<string>")
    words = spark.createDataFrame([("b",), ("x",)], "term string")
    small = [sorted(map(tuple, f(df, words).collect())) for f in (drop_stopwords, mark_lexicon)]
    import themata.operators.preprocess as P

    monkeypatch.setattr(P, "inline_terms", lambda terms: None)
    large = [sorted(map(tuple, f(df, words).collect())) for f in (drop_stopwords, mark_lexicon)]
    assert small == large
    assert small[0] == [(1, ["a", "a", "c"]), (2, []), (3, [])]
