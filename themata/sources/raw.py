"""Labelled raw article files, corpus unions and encoding normalisation."""

from __future__ import annotations

import math
import os
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from themata.cluster import TASK_BYTES, materialise

#: Leading ASCII letters of the file name are the label.
LABEL_PATTERN = "^[a-zA-Z]+"

#: Files that a task reads at most, and files or bytes of them that are handed on together.
TASK_FILES = 20_000
BATCH_FILES = 1024
BATCH_BYTES = 4 << 20


def decode_single_byte(content: Column, charset: str) -> Column:
    """Decode bytes of a one-byte charset, dropping bytes the charset does not define.

    Spark's own ``decode`` knows few charsets. Latin-1 maps each byte to the code point of the
    same number, so decoding as Latin-1 and translating the upper half gives any other one-byte
    charset, still inside generated code.
    """
    source, target, undefined = [], [], []
    for byte in range(0x80, 0x100):
        text = bytes([byte]).decode(charset, errors="ignore")
        if not text:
            undefined.append(chr(byte))
        elif text != chr(byte):
            source.append(chr(byte))
            target.append(text)
    latin = F.decode(content, "ISO-8859-1")
    if not source and not undefined:
        return latin
    return F.translate(latin, "".join(source + undefined), "".join(target))


def file_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def _store(spark: SparkSession, path: str) -> tuple[str, str, str] | None:
    """URI, what comes before the paths of its files in their full names, and its path, if tasks can open it by pyarrow."""
    jvm = spark.sparkContext._jvm
    there = jvm.org.apache.hadoop.fs.Path(path)
    store = there.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    if any(c in path for c in "{}[]*?\\") or not store.exists(there):
        return None
    full = store.makeQualified(there)
    uri, own = full.toString(), full.toUri().getPath()
    if store.getScheme() == "file":
        return uri, uri.removesuffix(own), own
    try:
        fs, own = pyarrow.fs.FileSystem.from_uri(uri)
        fs.get_file_info(own)
    except (pa.ArrowException, OSError):
        return None
    return (uri, uri.removesuffix(own), own) if uri.endswith(own) else None


def _entries(fs: pyarrow.fs.FileSystem, path: str) -> Iterator[tuple[str, int, bool]]:
    """Path, bytes and whether it is a folder of all that a folder holds; of a file itself. Local folders are not held as a whole."""
    if fs.get_file_info(path).type == pyarrow.fs.FileType.File:
        yield path, fs.get_file_info(path).size, False
    elif isinstance(fs, pyarrow.fs.LocalFileSystem):
        with os.scandir(path) as found:
            for entry in found:
                yield entry.path, entry.stat().st_size, entry.is_dir()
    else:
        for info in fs.get_file_info(pyarrow.fs.FileSelector(path)):
            yield info.path, info.size or 0, info.type == pyarrow.fs.FileType.Directory


def _file_system(uri: str) -> pyarrow.fs.FileSystem:
    return pyarrow.fs.LocalFileSystem() if uri.startswith("file:") else pyarrow.fs.FileSystem.from_uri(uri)[0]


_LISTED = pa.schema([("uri", pa.string()), ("before", pa.string()), ("path", pa.string()), ("size", pa.int64()), ("folder", pa.bool_())])


def list_files(spark: SparkSession, stores: list[tuple[str, str, str]], glob: str) -> DataFrame:
    """``(uri, before, path, size)`` of all files below, whose names match. Tasks list folders, a level of the tree in a
    job, and write what they find, so the driver holds no file's name. Hidden names and
    empty files are passed over, as Spark does."""

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list = []
        for batch in batches:
            for uri, before, path in zip(*(c.to_pylist() for c in batch.columns)):
                for found in _entries(_file_system(uri), path):
                    rows.append((uri, before, *found))
                    if len(rows) == BATCH_FILES:
                        yield pa.RecordBatch.from_arrays([*map(pa.array, zip(*rows))], schema=_LISTED)
                        rows = []
        if rows:
            yield pa.RecordBatch.from_arrays([*map(pa.array, zip(*rows))], schema=_LISTED)

    name = file_name(F.col("path"))
    hidden = name.startswith(".") | (name.startswith("_") & ~name.contains("=")) | name.endswith("._COPYING_")
    pattern = spark.sparkContext._jvm.org.apache.hadoop.fs.GlobPattern(glob).compiled().pattern()
    cores, levels = spark.sparkContext.defaultParallelism, []
    level = spark.createDataFrame(stores, "uri string, before string, path string")
    while not level.isEmpty():
        entries = materialise(level.repartition(4 * cores).mapInArrow(look, "uri string, before string, path string, size long, folder boolean").where(~hidden))
        levels.append(entries.where(~F.col("folder") & (F.col("size") > 0) & name.rlike(f"(?s)^(?:{pattern})$")).drop("folder"))
        level = entries.where("folder").select("uri", "before", "path")
    found = reduce(DataFrame.unionAll, levels)
    return found.dropDuplicates(["before", "path"]) if len(stores) > 1 else found  # one path may lie below another


def read_files(files: DataFrame) -> DataFrame:
    """``(path, content)`` of listed files, dealt to tasks by their number and bytes."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, contents, held = [], [], 0
            for uri, before, path in zip(*(c.to_pylist() for c in batch.columns)):
                with _file_system(uri).open_input_stream(path) as file:
                    contents.append(file.read())
                names.append(before + path)
                held += len(contents[-1])
                if held >= BATCH_BYTES or len(names) == BATCH_FILES:
                    yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(contents, pa.binary())], ["path", "content"])
                    names, contents, held = [], [], 0
            if names:
                yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(contents, pa.binary())], ["path", "content"])

    sums = files.agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("size")).first()
    tasks = max(2 * files.sparkSession.sparkContext.defaultParallelism, math.ceil((sums["size"] or 0) / TASK_BYTES), math.ceil(sums["n"] / TASK_FILES))
    return files.select("uri", "before", "path").repartition(tasks).mapInArrow(read, "path string, content binary")


def scan_raw(
    spark: SparkSession,
    paths: str | list[str],
    glob: str = "[a-zA-Z]*.raw",
    charset: str = "iso8859_7",
) -> DataFrame:
    """``(doc_id, label, text)`` from a directory tree of raw article files.

    Several paths are chained into one corpus. Newlines and U+0096 become spaces; files whose
    name does not start with a letter have no label and are passed over by the glob when the
    tree is listed. ``doc_id`` is the path: unique without any global numbering.

    Tasks list the tree and read the files. Patterns of paths, and stores that only Spark's readers open, are
    listed by Spark: its driver then holds an entry for every file.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    stores = [_store(spark, path) for path in paths]
    if stores and None not in stores:
        files = read_files(list_files(spark, stores, glob))
    else:
        files = (
            spark.read.format("binaryFile")
            .option("pathGlobFilter", glob)
            .option("recursiveFileLookup", "true")
            .load(paths)
        )
    label = F.regexp_extract(file_name(F.col("path")), LABEL_PATTERN, 0)
    text = F.translate(decode_single_byte(F.col("content"), charset), "\n\x96", "  ")
    return files.select(F.col("path").alias("doc_id"), label.alias("label"), text.alias("text")).where("label != ''")


def corpus_union(corpora: dict[str, DataFrame]) -> DataFrame:
    """Chain corpora of one schema, remembering each row's origin in ``split``."""
    parts = [df.withColumn("split", F.lit(name)) for name, df in corpora.items()]
    return reduce(lambda a, b: a.unionByName(b), parts)


def to_utf8(files: DataFrame, fallback: str = "cp1251") -> DataFrame:
    """Decode ``content`` as UTF-8 where it is valid, as ``fallback`` where it is not.

    Returns the other columns with ``text`` and ``encoding_was``. Bytes that the fallback charset
    does not define are dropped.
    """
    valid = F.is_valid_utf8(F.col("content").cast("string"))
    return files.select(
        *[c for c in files.columns if c != "content"],
        F.when(valid, F.decode("content", "UTF-8"))
        .otherwise(decode_single_byte(F.col("content"), fallback))
        .alias("text"),
        F.when(valid, F.lit("UTF-8")).otherwise(F.lit(fallback)).alias("encoding_was"),
    )
