"""Helpers shared by the text operators: shared-folder tables, sizes and column handling."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from prodseries import session

# A side of a join is only broadcast when its counted size is below this.
BROADCAST_BYTES = 32 << 20


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share: ``spark.checkpoint.dir``. Only a session within one
    machine (tests) may go without it, and gets a temporary one."""
    folder = session.shared_folder(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return folder


# Tables written inside ``scope``; outside it they stay until their folder is swept.
_HELD: list[list[str]] = []


@contextmanager
def scope() -> Iterator[list[str]]:
    """Collects the paths of the tables that are written meanwhile."""
    _HELD.append([])
    try:
        yield _HELD[-1]
    finally:
        _HELD.pop()


def dropped(spark: SparkSession, paths: list[str]) -> None:
    """Delete tables of a scope that nothing is going to read any more."""
    for path in paths:
        there = spark._jvm.org.apache.hadoop.fs.Path(path)
        there.getFileSystem(spark._jsc.hadoopConfiguration()).delete(there, True)


def written(df: DataFrame, label: str, group_bytes: int | None = None) -> DataFrame:
    """Write an intermediate table to the shared folder and read it back: later reads neither
    recompute it nor depend on the executors that made it. A writer holds a row group of
    ``group_bytes`` (Parquet's default: 128 MB) in memory."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    writer = df.write.option("compression", "zstd")
    (writer.option("parquet.block.size", group_bytes) if group_bytes else writer).parquet(path)
    if _HELD:
        _HELD[-1].append(path)
    return spark.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    """The cluster's configured shuffle width; every explicit deal follows it."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def text_bytes(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def total(df: DataFrame, value: Column) -> int:
    """One number over a whole table (partial sums per task, one row to the driver)."""
    return int(df.agg(F.sum(value).alias("v")).first()["v"] or 0)


def maybe_broadcast(df: DataFrame, row_bytes: int) -> DataFrame:
    """Hint a broadcast after counting the rows of a written table; beyond the bound the
    planner is left to shuffle."""
    return F.broadcast(df) if df.count() * row_bytes <= BROADCAST_BYTES else df


def row_key(*values: Column) -> Column:
    """A number for each row's values, by which verdicts on rows are carried; a null is a value."""
    return F.xxhash64(*[v.isNull() for v in values], *values)


def free_name(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have."""
    while name in df.columns:
        name += "_"
    return name
