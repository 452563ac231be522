from pyspark.sql import functions as F

from themata import cluster
from themata.checks import queries


def test_no_task_holds_much_of_a_large_scan(spark, tmp_path, monkeypatch):
    """One file of one row group, larger than the input that was dealt to all cores before."""
    spark.range(3000).select("id", F.lit("fr").alias("lang"), F.sha2(F.col("id").cast("string"), 512).alias("text")).coalesce(1).write.parquet(f"{tmp_path}/in.parquet")
    scan = spark.read.parquet(f"{tmp_path}/in.parquet")
    size = int(str(scan._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    monkeypatch.setattr(cluster, "SPREAD_BYTES", size - 1, raising=False)
    monkeypatch.setattr(cluster, "TASK_BYTES", 40_000, raising=False)
    dealt = cluster.spread(scan)
    rows = dealt.groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in rows) <= 1.5 * 3000 * 40_000 / size
    assert sorted(dealt.collect()) == sorted(scan.collect())
    assert cluster.spread(scan.where("id < 10")).where("id = 3").count() == 1


def test_stored_tokens_are_dealt_where_they_are_read(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(cluster, "TASK_BYTES", 1000, raising=False)
    rows = [(i, "en", f"w{i} x{i} y{i}") for i in range(2000)]
    spark.createDataFrame(rows, "doc_id long, lang string, text string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    found = queries.staged_tokens(spark, str(tmp_path))
    assert found.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0] < 200
    assert found.count() == 2000
