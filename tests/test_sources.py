import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from themata.sources import raw
from themata.sources.lexicon import inline_terms, normalise_lexicon, read_lexicon
from themata.sources.raw import scan_raw, to_utf8
from themata.sources.store import StageStore, input_fingerprint


def test_scan_raw(spark, tmp_path):
    (tmp_path / "a" / "deep").mkdir(parents=True)
    (tmp_path / "b").mkdir()
    (tmp_path / "a" / "Art1.raw").write_bytes("Τέχνη\nκαι".encode("iso8859_7") + b"\x96\xae\xd2\xff" + b"!")
    (tmp_path / "a" / "deep" / "Sports-7.raw").write_bytes("γκολ".encode("iso8859_7"))
    (tmp_path / "b" / "World.raw").write_bytes(b"x")
    (tmp_path / "b" / "12.raw").write_bytes(b"no label")
    (tmp_path / "b" / "Art.txt").write_bytes(b"other ending")
    rows = scan_raw(spark, [str(tmp_path / "a"), str(tmp_path / "b")]).collect()
    found = {r["label"]: r["text"] for r in rows}
    want = (b"\xae\xd2\xff").decode("iso8859_7", errors="ignore")
    assert found == {"Art": f"Τέχνη και {want}!", "Sports": "γκολ", "World": "x"}
    assert all(r["doc_id"].endswith(".raw") for r in rows)


def test_raw_files_are_listed_by_tasks(spark, tmp_path, monkeypatch):
    """No list of files on the driver; the same rows as by Spark's own reader, in other bounds of tasks and batches too."""
    for i in range(60):
        folder = tmp_path / "a b" / str(i % 7) / ("_hidden" if i % 10 == 3 else "x=1" if i % 2 else "deep")
        folder.mkdir(parents=True, exist_ok=True)
        (folder / f"{'Art' if i % 3 else '.Art'}%20{i}.raw").write_bytes(f"text {i}".encode() * (i % 5))
    (tmp_path / "a b" / "0" / "one.txt").write_bytes(b"other")
    paths = [str(tmp_path / "a b"), f"file:{tmp_path}/a b/1", str(tmp_path / "a b" / "2" / "deep" / "Art%202.raw")]
    with monkeypatch.context() as m:
        m.setattr(raw, "_store", lambda *_: None)
        want = sorted(map(tuple, scan_raw(spark, paths).collect()))
    assert 10 < len(want) < 60
    read = type(spark.read)
    with monkeypatch.context() as m:
        real = read.format
        m.setattr(read, "format", lambda self, source: 1 / 0 if source == "binaryFile" else real(self, source))
        for limits in ({}, {"BATCH_FILES": 3, "TASK_FILES": 5, "BATCH_BYTES": 8}):
            for name, value in limits.items():
                m.setattr(raw, name, value)
            assert sorted(map(tuple, scan_raw(spark, paths).collect())) == want
    (tmp_path / "none").mkdir()
    assert scan_raw(spark, str(tmp_path / "none")).count() == 0
    assert scan_raw(spark, f"{tmp_path}/a b/[12]").count() == len([r for r in want if "/a b/1/" in r[0] or "/a b/2/" in r[0]])
    with pytest.raises(AnalysisException):
        scan_raw(spark, str(tmp_path / "gone")).count()


def test_to_utf8(spark):
    rows = [(1, "плюс".encode()), (2, "плюс".encode("cp1251")), (3, b"plain"), (4, b"\xef\x98\xe0")]
    out = to_utf8(spark.createDataFrame(rows, "id long, content binary")).orderBy("id").collect()
    assert [(r["text"], r["encoding_was"]) for r in out] == [
        ("плюс", "UTF-8"), ("плюс", "cp1251"), ("plain", "UTF-8"), ("па", "cp1251")]


def test_lexicon(spark, tmp_path):
    (tmp_path / "list.txt").write_text("Γερμανία\nΕλλάδα\n  - ΑΛΛΑ\nNew 'Land'\n\n", encoding="utf8")
    terms = read_lexicon(spark, str(tmp_path / "list.txt"))
    assert inline_terms(terms) == sorted(["Γερμανία", "Ελλάδα", "ΑΛΛΑ", "New 'Land'"])
    assert set(inline_terms(normalise_lexicon(terms))) == {"ΓΕΡΜΑΝ", "ΕΛΛΑΔ", "ΑΛΛ", "NEW 'LAND'"}
    assert inline_terms(terms, limit=3) is None


def test_stage_store(spark, tmp_path):
    calls = []

    def build(n):
        def run():
            calls.append(n)
            return spark.range(n)

        return run

    store = StageStore(spark, str(tmp_path))
    assert store.table("ids", build(3), {"n": 3}).count() == 3
    assert store.table("ids", build(3), {"n": 3}).count() == 3
    assert store.table("ids", build(4), {"n": 4}).count() == 4
    assert store.table("ids", build(3), {"n": 3}, inputs="changed").count() == 3
    assert calls == [3, 4, 3]
    StageStore(spark, str(tmp_path), "parse-only").table("ids", build(3), {"n": 3})
    StageStore(spark, str(tmp_path), "parse-only").table("ids", build(3), {"n": 3}, parsing=True)
    StageStore(spark, str(tmp_path), "none").table("ids", build(3), {"n": 3}, parsing=True)
    assert calls == [3, 4, 3, 3, 3]


def test_fingerprint_sees_changed_files(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(3).write.parquet(path)
    first = input_fingerprint(spark.read.parquet(path))
    assert input_fingerprint(spark.read.parquet(path)) == first
    spark.range(4).write.mode("append").parquet(path)
    assert input_fingerprint(spark.read.parquet(path)) != first


def test_stage_store_models(spark, tmp_path):
    from pyspark.ml import PipelineModel

    from themata.operators.labels import decode_labels, fit_labels

    df = spark.createDataFrame([("b",), ("a",), ("c",)], "label string")
    store = StageStore(spark, str(tmp_path))
    first = store.model("labels", lambda: fit_labels(df), PipelineModel)
    again = store.model("labels", lambda: 1 / 0, PipelineModel)
    coded = again.transform(df)
    assert {r["label"]: r["label_idx"] for r in coded.collect()} == {"a": 0.0, "b": 1.0, "c": 2.0}
    back = decode_labels(coded.select(F.col("label_idx").alias("prediction")), first)
    assert sorted(r["label"] for r in back.collect()) == ["a", "b", "c"]


def test_stage_depends_on_the_plan_and_is_whole(spark, tmp_path):
    source = str(tmp_path / "rows")
    spark.range(20).write.parquet(source)
    rows = spark.read.parquet(source)
    part = rows.where("id % 5 <> 0")
    store = StageStore(spark, str(tmp_path / "store"))
    assert store.table("rows", lambda: rows, inputs=input_fingerprint(rows)).count() == 20
    assert store.table("rows", lambda: part, inputs=input_fingerprint(part)).count() == 16
    assert input_fingerprint(rows) == input_fingerprint(spark.read.parquet(source))
    half = store.path("half", {}, None)
    spark.range(3).write.parquet(half)
    (tmp_path / "store" / "stage" / half.rsplit("/", 1)[1] / "_SUCCESS").unlink()
    assert store.table("half", lambda: spark.range(7)).count() == 7
