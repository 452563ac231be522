from themata.operators import centroids, reduce
from themata.operators.preprocess import preprocess
from themata.plans.features import FeatureModel
from themata.streaming import score, score_stream


def test_fitted_chain_on_a_stream(spark, corpus, tmp_path):
    tokens = preprocess(corpus)
    model = FeatureModel.fit(tokens, n_dims=20, method="log")
    reducer = reduce.fit_pca(model.vectors(tokens), 3)
    classifier = centroids.fit_centroids(reducer.transform(model.vectors(tokens)), "euclidean")
    batch = {r["doc_id"]: r["prediction"] for r in score(corpus, model, reducer, classifier).collect()}
    corpus.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(corpus.schema).parquet(str(tmp_path / "in"))
    out = str(tmp_path / "out")
    writer = score_stream(stream, model, reducer, classifier, lambda df, number: df.write.mode("overwrite").parquet(f"{out}/batch={number}"))
    query = writer.option("checkpointLocation", str(tmp_path / "cp")).start()
    query.processAllAvailable()
    query.stop()
    assert {r["doc_id"]: r["prediction"] for r in spark.read.parquet(out).collect()} == batch
