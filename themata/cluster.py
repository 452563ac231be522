"""Helpers for running on a cluster: shared scratch folder, stage tables, checked broadcasts."""

from __future__ import annotations

import math
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: A word list up to this size is written into the plan as a literal set (a hash look-up
#: per token). Longer lists are joined instead.
INLINE_TERMS = 20_000

#: A table is broadcast only when a count shows at most this many rows.
BROADCAST_ROWS = 200_000

_local_folder: tempfile.TemporaryDirectory | None = None


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir``, or a temp folder in local mode."""
    global _local_folder
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    if _local_folder is None:
        _local_folder = tempfile.TemporaryDirectory(prefix="themata-")
    return _local_folder.name


def materialise(df: DataFrame) -> DataFrame:
    """Write ``df`` as a parquet table in the shared folder and read it back.

    Cuts the lineage in a way that survives lost executors, keeps column pruning for the
    readers and gives Catalyst real sizes for its join choices.
    """
    path = f"{shared_folder(df.sparkSession)}/themata/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def collect_garbage(spark: SparkSession) -> None:
    """Have the shuffle files and broadcasts of jobs that are over removed: Spark does so when the driver's JVM finds that
    nothing refers to them, which may be long after, while passes over large tables add to them."""
    spark.sparkContext._jvm.System.gc()


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast ``df`` when a count proves it small; otherwise leave the join to AQE.

    Meant for stage tables (already materialised), where the count is cheap.
    """
    if df.limit(max_rows + 1).count() <= max_rows:
        return F.broadcast(df)
    return df


def sql_list(terms) -> str:
    """String literals for an ``IN`` list. Thousands of them parse in milliseconds, while as many
    literal Columns take seconds to build; Catalyst turns both into a hash set."""
    escaped = (t.replace("\\", "\\\\").replace("'", "\\'") for t in terms)
    return ", ".join(f"'{t}'" for t in escaped)


def let(value: Column, body) -> Column:
    """Bind ``value`` once and use it many times inside ``body``.

    Column expressions have no local variables: naming a value twice evaluates it twice, and
    inside a lambda once per element. A one-element ``transform`` evaluates it exactly once.
    """
    return F.transform(F.array(value), body).getItem(0)


def with_dense_id(df: DataFrame, order_by: list[str], id_col: str, partitions: int | None = None) -> DataFrame:
    """Number the rows 0, 1, 2 ... in the order of ``order_by`` without a one-partition window.

    Rows are range-partitioned and sorted, numbered inside their partition, and shifted by the
    number of rows in the partitions before. Only one count per partition reaches the driver.
    ``order_by`` must be a unique key, otherwise equal rows may swap places.
    """
    spark = df.sparkSession
    source = materialise(df)  # range partitioning samples its input, so do not compute it twice
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = source.repartitionByRange(n, *order_by).sortWithinPartitions(*order_by)
    numbered = materialise(ranged.withColumn("__mono", F.monotonically_increasing_id()))
    # monotonically_increasing_id keeps the partition number above bit 33, the row number below
    part = F.shiftright("__mono", 33)
    sizes = numbered.groupBy(part.alias("__part")).count().orderBy("__part").collect()
    offsets, total = [], 0
    for row in sizes:
        offsets.append((row["__part"], total))
        total += row["count"]
    shifts = spark.createDataFrame(offsets or [(0, 0)], "__part long, __offset long")
    row_in_part = F.col("__mono").bitwiseAND(F.lit((1 << 33) - 1))
    return (
        numbered.withColumn("__part", part)
        .join(F.broadcast(shifts), "__part")  # one row per partition
        .withColumn(id_col, F.col("__offset") + row_in_part)
        .drop("__mono", "__part", "__offset")
    )


#: Catalyst's estimate for tables of unknown size.
UNKNOWN_BYTES = (1 << 63) - 1

#: Bytes of a scan, as stored, for one task of the text work.
TASK_BYTES = 16 << 20


def spread(df: DataFrame, per_core: int = 2) -> DataFrame:
    """Give a scan enough tasks for work that costs far more than reading: some for each core, and so many that
    none gets much more than ``TASK_BYTES``, however the files are cut.

    A parquet file is split between its row groups only, and small files are read together, so a task may hold
    hundreds of megabytes of text. The size is Catalyst's estimate of the scan; without one rows stay where they are.
    """
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if size >= int(df.sparkSession.conf.get("spark.sql.defaultSizeInBytes", str(UNKNOWN_BYTES))):
        return df
    return df.repartition(max(per_core * df.sparkSession.sparkContext.defaultParallelism, math.ceil(size / TASK_BYTES)))


def keyed_rows(df: DataFrame, name: str = "__row") -> DataFrame:
    """``df`` as a stage table with a number of its own for each row, for operators that take rows apart and
    put them together again; keys of the caller may repeat or be null."""
    return materialise(df.withColumn(name, F.monotonically_increasing_id()))


def unnest(df: DataFrame, keep: list, array: str | Column, name: str = "item", pos: str | None = None) -> DataFrame:
    """``explode`` for computed arrays: rows of ``keep`` columns plus ``name`` (and ``pos``).

    Plain ``explode`` makes Catalyst infer a ``size(array) > 0`` filter and push it down, which
    computes an expensive array twice. The outer form infers none; its null rows are dropped
    after the generator.
    """
    if pos is None:
        return df.select(*keep, F.explode_outer(array).alias(name)).where(F.col(name).isNotNull())
    return df.select(*keep, F.posexplode_outer(array).alias(pos, name)).where(F.col(pos).isNotNull())
