"""The pipeline against brute force on its own stages' rules."""

import corpus_pipeline
from themata.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def test_stages_keep_columns_and_clean_documents(spark):
    source = spark.read.parquet(f"{SF}/documents.parquet")
    docs, sizes = source, [source.count()]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF).cache()
        assert docs.dtypes == source.dtypes
        sizes.append(docs.count())
    assert sizes == sorted(sizes, reverse=True) and sizes[-1] >= 0.5 * sizes[0]
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert packed.select("doc_id").distinct().count() == sizes[-1]


def test_one_of_each_group_stays(spark):
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(3, text), (1, text), (2, text + " more"), (4, "other words"), (None, text), (1, text), (5, None)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    kept = corpus_pipeline.keep_one_of_group(spark, docs, SF).collect()
    assert sorted(str(r["doc_id"]) for r in kept) == ["1", "4", "5", "None"]


def test_unlinked_texts_of_one_id_stay(spark):
    first, second, third = (" ".join(f"{c}{i}" for i in range(40)) for c in "uvw")
    rows = [(1, first), (2, first + " more"), (2, second), (2, third), (3, third + " more"), (2, second), (4, ""), (4, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    kept = corpus_pipeline.keep_one_of_group(spark, docs, SF).collect()
    assert sorted((r["doc_id"], r["text"]) for r in kept) == [(1, first), (2, second), (2, third), (4, "")]


def test_registered_queries_return_every_row(spark):
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    want = spark.read.parquet(f"{SF}/documents.parquet").count()
    for name in ("op3_superkmer_dedup", "op4_weak_supervision_pii", "op8_toxic_segments", "op10_positional_index", "op13_bloom_exact_dedup"):
        assert QUERIES[name](spark, SF).count() == want


def test_columns_named_like_the_stages_own_stay(spark):
    source = spark.read.parquet(f"{SF}/documents.parquet").limit(20)
    docs = source.selectExpr("*", "doc_id as key", "'mine' as __key", "1 as Base")
    for stage in (corpus_pipeline.keep_one_of_group, corpus_pipeline.decontaminate):
        kept = stage(spark, docs, SF)
        assert kept.dtypes == docs.dtypes
        assert all(r["key"] == r["doc_id"] and r["__key"] == "mine" for r in kept.collect())
