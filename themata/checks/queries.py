"""One query per operator over the given tables. D = documents (label = lang), E = embeddings."""

from __future__ import annotations

import uuid
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from themata.cluster import broadcast_if_small, materialise, shared_folder, spread, unnest
from themata.functions import arrays, text as T
from themata.functions.greek import stem_vocabulary
from themata.operators import centroids, dictionary as D, evaluate, labels, neighbours, ngrams
from themata.operators import pairs, reduce, weights
from themata.operators.preprocess import drop_stopwords, mark_lexicon, preprocess
from themata.plans import experiments, folds, grids
from themata.plans.features import FeatureModel
from themata.sources import lexicon, raw
from themata.sources.store import StageStore, input_fingerprint

N_TERMS = 3000
WIDE_TERMS = 100_000
N_BIGRAMS, MIN_FREQ = 3000, 5
NEIGHBOURS = 10

#: Folders of the exported raw files.
RAW_FOLDERS = 256

#: Latin capitals spelt in Greek ones, to give the stemmer words to work on.
LATIN, GREEK = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "ΑΒΚΔΕΦΓΗΙΙΚΛΜΝΟΠΚΡΣΤΥΒΩΞΥΖ"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def docs(spark, sf) -> DataFrame:
    return spread(table(spark, sf, "documents").select("doc_id", F.col("lang").alias("label"), "text"))


def pages(spark, sf) -> DataFrame:
    """A second corpus, unseen in training."""
    return spread(table(spark, sf, "pages").select(F.col("page_id").alias("doc_id"), F.col("html").alias("text")))


def tokens(spark, sf) -> DataFrame:
    # no Greek in these tables, so the stemmer would pass every word
    return preprocess(docs(spark, sf), stem=False)


def test_tokens(spark, sf) -> DataFrame:
    return preprocess(pages(spark, sf), stem=False)


def vectors(spark, sf) -> DataFrame:
    return table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("id"), "label", F.col("embedding").cast("array<double>").alias("features")
    )


def staged_tokens(spark, sf) -> DataFrame:
    """Tokens as a stage table, for queries that read them more than once: at scale, writing them is
    far cheaper than a second run of the text chain. Dealt anew where they are read, as term counting is costly too."""
    return spread(materialise(tokens(spark, sf)))


def features(spark, sf, method: str = "none", n_dims: int = N_TERMS) -> tuple[FeatureModel, DataFrame]:
    """A model fitted on the documents, and their tokens."""
    t = staged_tokens(spark, sf)
    return FeatureModel.fit(t, n_dims=n_dims, method=method), t


def joined(df: DataFrame) -> DataFrame:
    return df.select("doc_id", F.array_join("tokens", " ").alias("tokens"))


def benchmark_tokens(spark, sf) -> DataFrame:
    words = T.tokenize(F.upper(T.strip_accents(F.col("text"))))
    return unnest(table(spark, sf, "benchmark").select(words.alias("w")), [], "w", "term").where("term != ''").distinct()


def short_words(spark, sf) -> DataFrame:
    return benchmark_tokens(spark, sf).where(F.length("term") <= 3)


def long_words(spark, sf) -> DataFrame:
    return benchmark_tokens(spark, sf).where(F.length("term") > 3)


# -- sources --------------------------------------------------------------------------------------


def export_raw(df: DataFrame, root: str) -> None:
    """Write each document as ``<label><id>.raw`` in ISO-8859-7, for the scan to read; folders by a hash of the name, so
    that none holds them all."""
    base = root if "://" in root else f"file://{root}" if root.startswith("/") else root.replace("file:", "file://")

    def write(batches):
        fs, path = pyarrow.fs.FileSystem.from_uri(base)
        folders = set()
        for batch in batches:
            for key, label, text in zip(*(c.to_pylist() for c in batch.columns)):
                name = f"{label}{key}.raw"
                folder = f"{path}/{zlib.crc32(name.encode()) % RAW_FOLDERS}"
                if folder not in folders:
                    fs.create_dir(folder, recursive=True)
                    folders.add(folder)
                with fs.open_output_stream(f"{folder}/{name}") as out:
                    out.write(text.encode("iso8859_7", errors="ignore"))
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], ["n"])

    df.select("doc_id", "label", "text").mapInArrow(write, "n long").agg(F.sum("n")).collect()


def scan_raw(spark, sf):
    root = f"{shared_folder(spark)}/themata/{uuid.uuid4().hex}"
    export_raw(docs(spark, sf), root)
    number = F.regexp_extract("doc_id", r"([0-9]+)\.raw$", 1).cast("long")
    return raw.scan_raw(spark, root).select(number.alias("doc_id"), "label", "text")


def corpus_union(spark, sf):
    return raw.corpus_union(
        {"train": docs(spark, sf).select("doc_id", "text"), "test": pages(spark, sf).select("doc_id", "text")}
    )


def raw_articles(spark, sf):
    return docs(spark, sf).select("doc_id", "label", F.translate("text", "\n\x96", "  ").alias("text"))


def to_utf8(spark, sf):
    narrow = ~F.col("text").rlike("[^\\x00-\\xFF]")
    content = F.when(narrow, F.encode("text", "ISO-8859-1")).otherwise(F.encode("text", "UTF-8"))
    return raw.to_utf8(docs(spark, sf).select("doc_id", content.alias("content")))


def lexicon_terms(spark, sf):
    path = f"{shared_folder(spark)}/themata/{uuid.uuid4().hex}"
    words = table(spark, sf, "benchmark").select(F.explode(F.split("text", r"\s+")).alias("value")).where("value != ''")
    words.write.text(path)
    return lexicon.normalise_lexicon(lexicon.read_lexicon(spark, path))


def stage_roundtrip(spark, sf):
    corpus = docs(spark, sf)
    store = StageStore(spark, f"{shared_folder(spark)}/themata/{uuid.uuid4().hex}")
    stage = lambda: store.table("tokens", lambda: tokens(spark, sf), {"stem": False}, input_fingerprint(corpus), parsing=True)
    stage()  # builds and writes
    stored = stage()  # reloads
    return stored.groupBy("label").agg(F.count(F.lit(1)).alias("n_docs"), F.sum(F.size("tokens")).alias("n_tokens"))


# -- text -----------------------------------------------------------------------------------------


def on_text(function):
    return lambda spark, sf: docs(spark, sf).select("doc_id", function(F.col("text")).alias("text"))


def tokenize(compat):
    upper = lambda c: F.upper(T.strip_accents(c))

    def query(spark, sf):
        return joined(docs(spark, sf).select("doc_id", T.tokenize(upper(F.col("text")), compat).alias("tokens")))

    return query


def on_tokens(function):
    """Over the plain tokens (accents off, upper case, split)."""

    def query(spark, sf):
        plain = docs(spark, sf).select("doc_id", T.tokenize(F.upper(T.strip_accents(F.col("text")))).alias("tokens"))
        return joined(function(plain, spark, sf))

    return query


def on_array(function):
    return on_tokens(lambda df, spark, sf: df.withColumn("tokens", function(F.col("tokens"))))


def stem_vocab(spark, sf):
    spelt = F.transform("tokens", lambda t: F.translate(t, LATIN, GREEK))
    words = materialise(unnest(tokens(spark, sf).select(spelt.alias("tokens")), [], "tokens", "word").distinct())
    return stem_vocabulary(words.select(F.array("word").alias("tokens")))


def preprocess_all(spark, sf):
    return joined(preprocess(docs(spark, sf), stopwords=short_words(spark, sf), places=long_words(spark, sf)))


# -- n-grams --------------------------------------------------------------------------------------


def ngram_counts(spark, sf):
    return ngrams.ngram_counts(tokens(spark, sf)).select("w1", F.coalesce("w2", F.lit("")).alias("w2"), "n")


def pmi_columns(df):
    return df.select("term", "freq", F.round("pmi", 9).alias("pmi"))


def append_bigrams(spark, sf):
    t = staged_tokens(spark, sf)
    return joined(ngrams.append_bigrams(t, ngrams.fit_bigrams(t, N_BIGRAMS, MIN_FREQ), N_BIGRAMS))


def bigram_by_variance(spark, sf):
    t = staged_tokens(spark, sf)
    kept = ngrams.fit_bigrams(t, N_BIGRAMS, MIN_FREQ)
    both = ngrams.append_bigrams(t, kept, N_BIGRAMS)
    by_label = materialise(D.label_terms(both))
    variance = D.class_variance(D.class_tf(by_label), by_label.select("label").distinct().count())
    variance = variance.select("term", F.round("var", 12).alias("var"))
    return ngrams.bigrams_by_variance(kept, variance, 40)


# -- dictionary and weights -----------------------------------------------------------------------


def counts_with_ids(spark, sf):
    t = staged_tokens(spark, sf)
    words = D.dictionary(t)
    return D.term_counts(t, broadcast_if_small(words)), words


def id_to_term(spark, sf):
    counts, words = counts_with_ids(spark, sf)
    return D.id_to_term(counts, broadcast_if_small(words)).select("doc_id", "term", "n")


def variance(spark, sf):
    by_label = D.label_terms(tokens(spark, sf))
    classes = docs(spark, sf).agg(F.countDistinct("label").cast("double")).scalar()
    return D.class_variance(D.class_tf(by_label), classes)


def select_terms(spark, sf, n=N_TERMS):
    return D.select_terms(variance(spark, sf), n).select("term", F.round("var", 12).alias("var"))


def doc_freq(spark, sf):
    m, t = features(spark, sf)
    return D.doc_freq(m.counts(t))


def tfidf_columns(df):
    return df.select("doc_id", "term_id", F.round("w", 9).alias("w"))


def tf(spark, sf):
    m, t = features(spark, sf)
    return m.tf(t).select("doc_id", "term_id", F.round("tf", 9).alias("tf"))


def idf(spark, sf):
    m, _ = features(spark, sf)
    return m.selected.select("term_id", "df", F.round("idf", 9).alias("idf"))


def tfidf(test=False):
    def query(spark, sf):
        m, t = features(spark, sf)
        return tfidf_columns(m.tfidf(test_tokens(spark, sf) if test else t))

    return query


def transformed(method, test=False):
    def query(spark, sf):
        m, t = features(spark, sf, method)
        return tfidf_columns(m.weights(test_tokens(spark, sf) if test else t))

    return query


def term_pair_mi(spark, sf):
    m, t = features(spark, sf, n_dims=N_TERMS)
    found = pairs.term_pair_mi(m.count_vectors(t), m.vocabulary(), m.n_docs)
    return found.select("term_a", "term_b", "agree", F.round("mi", 9).alias("mi"))


def term_weights(spark, sf):
    m, _ = features(spark, sf)
    return weights.descriptive_weights(m.selected, 200).select("rank", "term", F.round("weight", 12).alias("weight"))


def feature_vectors(spark, sf):
    values = vector_to_array("features")
    summed = F.aggregate(values, F.lit(0.0), lambda a, x: a + x)
    m, t = features(spark, sf)
    return m.vectors(t).select(
        "doc_id", F.size(F.filter(values, lambda x: x > 0)).alias("n_terms"), F.round(summed, 9).alias("total")
    )


# -- reductions -----------------------------------------------------------------------------------


def reduced(method, k=8):
    return lambda spark, sf: reduce.fit_reduction(vectors(spark, sf), method, k).transform(vectors(spark, sf))


def first_axis(method):
    """The leading axis up to its sign, one row a column."""

    def query(spark, sf):
        fitted = reduce.fit_reduction(vectors(spark, sf), method, 1)
        cells = [(i, abs(float(x))) for i, x in enumerate(fitted.components[:, 0])]
        return spark.createDataFrame(cells, "dim int, weight double").withColumn("weight", F.round("weight", 7))

    return query


def pca_wide(spark, sf):
    """Documents over up to 100,000 terms, reduced to 70 axes; their places on the first one up to its sign."""
    m, t = features(spark, sf, "binary", WIDE_TERMS)
    rows = materialise(m.vectors(t))
    scored = reduce.fit_pca(rows, 70).transform(rows)
    return scored.select("doc_id", F.round(F.abs(F.get("features", F.lit(0))), 6).alias("first_axis"))


def reduce_test(spark, sf):
    """Terms of one corpus reduced, then applied to another."""
    m, t = features(spark, sf, "binary")
    fitted = reduce.fit_pca(materialise(m.vectors(t)), 70)  # the fit reads its rows several times
    return fitted.transform(m.vectors(test_tokens(spark, sf)))


def lda_scatter(spark, sf):
    s = reduce.lda_scatter(vectors(spark, sf))
    within = reduce.matrix_cells(spark, s.within).withColumn("kind", F.lit("within"))
    between = reduce.matrix_cells(spark, s.between).withColumn("kind", F.lit("between"))
    return within.unionByName(between).select("kind", "i", "j", F.round("value", 10).alias("value"))


def covariance(spark, sf):
    cells = reduce.matrix_cells(spark, reduce.covariance(vectors(spark, sf)))
    return cells.select("i", "j", F.round("value", 10).alias("value"))


# -- labels and classifiers -----------------------------------------------------------------------


def encode_labels(spark, sf):
    d = docs(spark, sf).select("doc_id", "label")
    coded = labels.fit_labels(d).transform(d)
    return coded.select("doc_id", "label", F.col("label_idx").cast("int").alias("label_idx"))


def argmax_decode(spark, sf):
    return vectors(spark, sf).select("id", arrays.argmax(F.col("features")).alias("prediction"))


def split_at(spark, sf):
    return labels.split_at(docs(spark, sf).select("doc_id"), 700)


def kfold(spark, sf):
    return docs(spark, sf).select("doc_id", F.pmod("doc_id", F.lit(5)).cast("int").alias("fold"))


def manhattan(q: np.ndarray, t: np.ndarray) -> np.ndarray:
    return np.stack([np.abs(t - row).sum(1) for row in q])


def knn(metric):
    """Every vector against every vector."""

    def query(spark, sf):
        v = vectors(spark, sf)
        cov = reduce.covariance(v) if metric == "mahalanobis" else None
        return neighbours.knn_predict(v, v, NEIGHBOURS, metric, cov)

    return query


def centroid_means(spark, sf):
    means = reduce.class_means(vectors(spark, sf))
    return means.select("label", F.posexplode("mean").alias("dim", "m")).select(
        "label", "dim", F.round("m", 9).alias("mean")
    )


def predictions(fit):
    def query(spark, sf):
        v = vectors(spark, sf)
        return fit(v).predict(v).select("id", "prediction")

    return query


def centroid(metric):
    return predictions(lambda v: experiments.train_model(v, "MEAN", metric=metric))


def gnb_fit(spark, sf):
    stats = centroids.gnb_stats(vectors(spark, sf))
    zipped = F.arrays_zip("mean", "variance")
    rows = stats.select("label", "prior", "prior_positive_cells", F.posexplode(zipped).alias("dim", "z"))
    return rows.select(
        "label", "dim", F.round("z.mean", 9).alias("mean"), F.round("z.variance", 9).alias("variance"),
        F.round("prior", 9).alias("prior"), F.round("prior_positive_cells", 9).alias("prior_positive_cells"),
    )


def on_documents(method, **params):
    """A classifier of documents by language: terms, weights, PCA and fit on four of five documents, prediction of
    the others."""

    def query(spark, sf):
        t = staged_tokens(spark, sf)
        tested = F.col("doc_id") % 5 == 0
        train, test = experiments.text_vectors(t.where(~tested), t.where(tested), n_dims=N_TERMS)
        return experiments.train_model(train, method, **params).predict(test).select("id", "prediction")

    return query


# -- evaluation -----------------------------------------------------------------------------------


def accuracy(spark, sf):
    v = vectors(spark, sf)
    scored = evaluate.accuracy(centroids.fit_centroids(v, "euclidean").predict(v))
    return scored.select(F.round("accuracy", 9).alias("accuracy"))


def centroid_grid(spark, sf) -> DataFrame:
    v = vectors(spark, sf)
    train, test = v.where("id % 5 <> 0"), v.where("id % 5 = 0")
    grid = [{"method": "MEAN", "metric": m} for m in ("euclidean", "cosine")]
    grid += [{"method": "NB", "prior": p} for p in ("rows", "positive_cells")]
    return experiments.parameter_grid(train, test, grid)


def grid_scores(spark, sf):
    params = F.array_join(F.map_values("params"), ",")
    return centroid_grid(spark, sf).select(
        "method", params.alias("params"), F.round("accuracy", 9).alias("accuracy"))


def grid_knn(spark, sf):
    """Nine sets of neighbours: three searches, of which each serves three numbers."""
    v = vectors(spark, sf)
    scores = grids.shared_grid(v.where("id % 5 <> 0"), v.where("id % 5 = 0"), experiments.grids()["KNN"])
    return scores.select(F.col("params.metric").alias("metric"), F.col("params.n_neighbors").cast("int").alias("n_neighbors"), F.round("accuracy", 9).alias("accuracy"))


def document_grid(sets):
    """Parameter sets compared on documents by language, fitted on four of five; common work is done once."""

    def query(spark, sf):
        t = staged_tokens(spark, sf)
        tested = F.col("doc_id") % 5 == 0
        train, test = experiments.text_vectors(t.where(~tested), t.where(tested), n_dims=N_TERMS)
        scores = grids.shared_grid(train, test, sets())
        return scores.withColumn("params", F.array_join(F.transform(F.map_entries("params"), lambda e: F.concat_ws("=", e["key"], e["value"])), ","))

    return query


def kfold_centroid(spark, sf):
    def fit_and_score(train, test):
        return experiments.parameter_grid(train, test, [{"method": "MEAN", "metric": "euclidean"}])

    scores = experiments.k_fold(vectors(spark, sf), 5, F.pmod("id", F.lit(5)), fit_and_score)
    return scores.select("fold", "method", F.round("accuracy", 9).alias("accuracy"))


def by_fifth():
    return F.pmod("doc_id", F.lit(5)).cast("int")


def kfold_terms(spark, sf):
    found = folds.fold_terms(tokens(spark, sf), by_fifth(), 5, N_TERMS)
    return found.select("fold", "rank", "term", F.round("var", 12).alias("var"), "df", F.round("idf", 9).alias("idf"))


def kfold_nb(spark, sf):
    """Naive Bayes over the terms themselves, five folds."""
    chain = folds.fit_chain(tokens(spark, sf), by_fifth(), 5, N_TERMS, components=None)
    return folds.fold_scores(chain, [{"method": "NB"}]).select("fold", "method", F.round("accuracy", 9).alias("accuracy"))


def kfold_all(spark, sf):
    """The whole chain, bigrams and 70 axes included, in five folds, with every model that moments determine."""
    t = staged_tokens(spark, sf)
    both = ngrams.append_bigrams(t, ngrams.fit_bigrams(t, N_BIGRAMS, MIN_FREQ), N_BIGRAMS)
    models = [{"method": "NB"}, *({"method": "MEAN", "metric": m} for m in ("euclidean", "cosine", "mahalanobis")),
              *({"method": "GMM", "covariance_type": c, "n_components": 1} for c in ("full", "diag"))]
    scores = folds.fold_scores(folds.fit_chain(both, by_fifth(), 5, N_TERMS, components=70), models)
    return scores.withColumn("params", F.array_join(F.transform(F.map_entries("params"), lambda e: F.concat_ws("=", e["key"], e["value"])), ","))


def score_labels(spark, sf):
    return evaluate.score_labels(centroid_grid(spark, sf))


def score_series(spark, sf):
    grid = centroid_grid(spark, sf)
    wide = evaluate.score_series(
        grid.withColumn("params", F.map_from_arrays(F.array(F.lit("value")), F.map_values("params"))),
        "value", F.col("method"), ["cosine", "euclidean", "positive_cells", "rows"])
    return wide.select("series", *[F.round(c, 9).alias(c) for c in ("cosine", "euclidean", "positive_cells", "rows")])


QUERIES = {
    # sources
    "scan_raw": scan_raw,
    "corpus_union": corpus_union,
    "raw_articles": raw_articles,
    "to_utf8": to_utf8,
    "lexicon": lexicon_terms,
    "stage_roundtrip": stage_roundtrip,
    "head_n": lambda s, sf: labels.head(docs(s, sf), 100),
    # text
    "strip_accents": on_text(T.strip_accents),
    "upper_text": on_text(lambda c: F.upper(T.strip_accents(c))),
    "merge_decimals": on_text(T.merge_decimals),
    "collapse_acronyms": on_text(T.collapse_acronyms),
    "clean_nonword": on_text(lambda c: T.clean_nonword(T.strip_accents(c))),
    "tokenize": tokenize(False),
    "tokenize_as_written": tokenize(True),
    "drop_stopwords": on_tokens(lambda df, s, sf: drop_stopwords(df, short_words(s, sf))),
    "stem_vocab": stem_vocab,
    "mark_numbers": on_array(T.mark_numbers),
    "mark_lexicon": on_tokens(lambda df, s, sf: mark_lexicon(df, long_words(s, sf))),
    "min_len": on_array(T.min_length),
    "preprocess": preprocess_all,
    # n-grams
    "bigrams": lambda s, sf: ngrams.bigrams(tokens(s, sf)),
    "ngram_counts": ngram_counts,
    "bigram_min_freq": lambda s, sf: ngrams.frequent_bigrams(ngrams.ngram_counts(tokens(s, sf)), MIN_FREQ),
    "bigram_pmi": lambda s, sf: pmi_columns(ngrams.bigram_pmi(ngrams.ngram_counts(tokens(s, sf)), MIN_FREQ)),
    "top_bigrams": lambda s, sf: pmi_columns(ngrams.fit_bigrams(tokens(s, sf), N_BIGRAMS, MIN_FREQ)),
    "append_bigrams": append_bigrams,
    "bigram_by_variance": bigram_by_variance,
    # dictionary, weights
    "dictionary": lambda s, sf: D.dictionary(tokens(s, sf)),
    "id_to_term": id_to_term,
    "term_counts": lambda s, sf: counts_with_ids(s, sf)[0],
    "class_tf": lambda s, sf: D.class_tf(D.label_terms(tokens(s, sf))).select(
        "label", "term", F.round("tf", 12).alias("tf")),
    "class_variance": lambda s, sf: variance(s, sf).select("term", F.round("var", 12).alias("var")),
    "select_terms": select_terms,
    "tf": tf,
    "doc_freq": doc_freq,
    "idf": idf,
    "tfidf_train": tfidf(),
    "tfidf_test": tfidf(test=True),
    "term_pair_mi": term_pair_mi,
    "term_weights": term_weights,
    "label_set": lambda s, sf: D.label_set(docs(s, sf)),
    "feature_vectors": feature_vectors,
    "tx_entropy": transformed("entropy"),
    "tx_binary": transformed("binary"),
    "tx_log": transformed("log"),
    "tx_none": transformed("none"),
    "tx_test": transformed("entropy", test=True),
    # reductions
    "pca": reduced("PCA"),
    "svd_project": reduced("SVD"),
    "pca_first_axis": first_axis("PCA"),
    "svd_first_axis": first_axis("SVD"),
    "pca_wide": pca_wide,
    "lda_scatter": lda_scatter,
    "lda_project": reduced("LDA"),
    "reduce_test": reduce_test,
    "covariance": covariance,
    # labels, classifiers
    "encode_labels": encode_labels,
    "argmax_decode": argmax_decode,
    "split_at": split_at,
    "kfold": kfold,
    "knn_euclidean": knn("euclidean"),
    "knn_cosine": knn("cosine"),
    "knn_mahalanobis": knn("mahalanobis"),
    "knn_custom_metric": knn(manhattan),
    "centroids": centroid_means,
    "centroid_euclidean": centroid("euclidean"),
    "centroid_cosine": centroid("cosine"),
    "centroid_mahalanobis": centroid("mahalanobis"),
    "gnb_fit": gnb_fit,
    "gnb_predict": predictions(centroids.fit_gnb),
    "gmm_full": on_documents("GMM", covariance_type="full", n_components=5),
    "gmm_diag": on_documents("GMM", covariance_type="diag", n_components=11),
    "random_forest": on_documents("RandomForest", n_estimators=35),
    "svm_linear": on_documents("SVM", kernel="linear"),
    "svm_rbf": on_documents("SVM", kernel="rbf", C=1.5),
    "svm_poly": on_documents("SVM", kernel="poly"),
    "mlp": on_documents("MLP"),
    "mlp_adam": on_documents("ANN", epochs=40, batch_size=200, learning_rate=0.005),
    # evaluation
    "accuracy": accuracy,
    "grid_centroid": grid_scores,
    "grid_knn": grid_knn,
    "grid_forest": document_grid(lambda: experiments.grids()["RandomForest"]),
    "grid_svm": document_grid(lambda: experiments.grids()["SVM"]),
    "grid_gmm": document_grid(lambda: [p for p in experiments.grids()["GMM"] if p["n_components"] <= 6]),
    "sweep_ann": document_grid(lambda: experiments.grids()["ANN"]),
    "kfold_centroid": kfold_centroid,
    "kfold_terms": kfold_terms,
    "kfold_nb": kfold_nb,
    "kfold_all": kfold_all,
    "score_labels": score_labels,
    "score_series": score_series,
}
