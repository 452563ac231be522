"""Registered queries of the corpus operators; each reads its whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from themata.llm.tokens import public_tokenizer


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from themata.llm.packing import best_fit_packing

    return best_fit_packing(_table(spark, sf_dir, "documents"), public_tokenizer())


def op2_grouped_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from themata.llm.jaccard_join import near_duplicates

    return near_duplicates(_table(spark, sf_dir, "documents"))


def op3_superkmer_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from themata.llm.superkmer import remove_repeats

    found = remove_repeats(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op4_weak_supervision_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from themata.llm.pii import BASE, annotate, fit, listed

    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = annotate(docs, fit(docs))

    def of_kind(k: int):
        return lambda s: s.kind == k  # a second argument would be taken for the element's place

    counts = [F.size(F.filter("base", of_kind(k))).cast("long").alias(f"n_{name}") for k, name in enumerate(BASE)]
    return found.select("doc_id", *counts, F.sha2(listed(F.col("base")), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))


def op5_small_world_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from themata.llm.hnsw import near_duplicates

    return near_duplicates(_table(spark, sf_dir, "embeddings"))


def op6_run_length_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    from themata.llm.run_index import remove_repeats

    found = remove_repeats(_table(spark, sf_dir, "documents"))
    n_spans = F.size("spans").cast("long").alias("n_spans")
    return found.select("doc_id", "n_bytes", "n_removed", n_spans, F.sha2("kept", 256).alias("kept_sha256"))


def op7_site_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from themata.llm.quality import site_quality

    held_out = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    path = F.concat_ws("/", "source", "lang")
    scored = site_quality(docs, labels.where(~held_out), F.col("source"), path)
    return scored.withColumn("keep", F.col("score") >= 0.5).withColumn("held_out", held_out)


def op8_toxic_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    from themata.llm.toxicity import fit

    held_out = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    scored = fit(docs, labels.where(~held_out)).score(docs)
    return scored.select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "evidence",
    )


def op9_length_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    from themata.llm.length_histogram import histogram, length_sums

    return length_sums(histogram(_table(spark, sf_dir, "documents"), public_tokenizer()))


def op10_positional_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    from themata.llm.positional_index import decontaminate

    found = decontaminate(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    hit = F.array_distinct(F.flatten(F.transform("hits", lambda h: F.sequence(h.position, h.position + h.length - 1))))
    items = F.array_sort(F.array_distinct(F.transform("hits", lambda h: h.item_id.cast("string"))))
    return found.select(
        "doc_id", "n_words", F.size(hit).cast("long").alias("n_hit"), F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"), (F.size("hits") > 0).alias("contaminated"),
    )


def op11_tree_bounded_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    from themata.llm.hard_negatives import mine

    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(_table(spark, sf_dir, "embeddings"), label, F.col("id") % 100 == 0)


def op12_dense_tile_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    from themata.llm.lexical_search import search

    return search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op13_bloom_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from themata.llm.exact_dedup import mark_duplicates

    marked = mark_duplicates(_table(spark, sf_dir, "documents"))
    return marked.select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name: query for name, query in list(globals().items()) if name.startswith("op")
}

ORACLE: dict[str, str] = {
    "op11_tree_bounded_negatives": """
        with finite as (
            select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
                list_transform(embedding, lambda x: floor(256 * x::double)) as v
            from embeddings
            where label is not null and embedding is not null
                and len(list_filter(embedding, lambda x: x is null or not isfinite(x::double))) = 0
        ), scored as (
            select a.vec_id as anchor_id, r.vec_id as id, a.label = r.label as same, list_inner_product(a.v, r.v)::bigint as score
            from finite a join finite r on a.vec_id <> r.vec_id
            where a.vec_id % 100 = 0
        ), positives as (
            select anchor_id, id as positive_id, score as positive_score from scored where same
            qualify row_number() over (partition by anchor_id order by score desc, id) <= 5
        )
        select anchor_id, positive_id, (row_number() over best)::int as rank, id as negative_id, positive_score, score as negative_score
        from positives join scored using (anchor_id)
        where not same and 30 * positive_score <= 100 * score and 100 * score <= 90 * positive_score
        window best as (partition by anchor_id, positive_id order by score desc, id)
        qualify row_number() over best <= 10
    """,
    "op12_dense_tile_search": r"""
        with words as (
            select doc_id, unnest(regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'
            )) as term from documents
        ), counts as (select doc_id, term, count(*) as tf from words group by all
        ), sizes as (select doc_id, sum(tf)::bigint as n from counts group by all
        ), total as (select count(*) as n_docs, sum(n)::bigint as n_terms from sizes
        ), weights as (
            select term, floor(1000 * ln((2 * n_docs + 2)::double / (2 * count(*) + 1)::double))::bigint as w
            from counts, total group by term, n_docs
        ), asked as (
            select item_id, unnest(regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'
            )) as term from benchmark
        ), scored as (
            select item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * n_docs) // n_terms))))::bigint as score
            from asked join counts using (term) join sizes using (doc_id) join weights using (term), total
            group by all
        )
        select item_id, (row_number() over best)::int as rank, doc_id, score from scored where score > 0
        window best as (partition by item_id order by score desc, doc_id)
        qualify row_number() over best <= 10
    """,
    "op13_bloom_exact_dedup": r"""
        with rows as (
            select doc_id, length(coalesce(text, '')) as n_chars, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) as text_sha256
            from documents
        )
        select doc_id, first_value(doc_id) over best as keep_id, count(*) over (partition by text_sha256) as group_size,
            row_number() over best = 1 as kept, text_sha256
        from rows window best as (partition by text_sha256 order by n_chars desc, doc_id)
    """,
}
