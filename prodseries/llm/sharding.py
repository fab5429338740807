"""Sharding by sampled splitters.

Records get a 64-bit key (text hash above, row hash below), so equal texts are neighbours and
even a third of all rows with one text can be cut. A size-weighted sample of keys gives the
quantile splitters of many fine ranges; a range that comes out overfull is subdivided by
sampling inside it. Exact sizes per range and a running sum inside each then give every
record its place on one long line of bytes, which is cut into shards of equal length.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from prodseries.llm.common import partitions, text_bytes, written

# Key bits below the text hash, by which a hot text is spread.
ROW_BITS = 20
# Splitters are held by the driver and every task: a fixed bound, not a share of the data.
MAX_RANGES = 4096
SAMPLES_PER_RANGE = 64
# A group of equal texts moves across a cut as a whole when it is below this share of a shard.
GROUP_SHARE = 0.01
ROW_OVERHEAD = 8


def record_keys(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, text, size, key). Null text: the 8 bytes of overhead and the key of null."""
    text, row = F.xxhash64(F.col(text_col)), F.xxhash64(F.col(id_col), F.col(text_col))
    low = (1 << ROW_BITS) - 1
    return docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(text_col).alias("text"),
        (text_bytes(F.col(text_col)) + ROW_OVERHEAD).alias("size"),
        text.bitwiseAND(F.lit(~low)).bitwiseOR(row.bitwiseAND(F.lit(low))).alias("key"),
    )


def sampled_splitters(keyed: DataFrame, n_ranges: int, total_bytes: int, seed: int) -> np.ndarray:
    """Quantiles of a size-weighted sample: a row is drawn with probability in proportion to
    its size, so equal counts of drawn keys mean equal bytes."""
    wanted = n_ranges * SAMPLES_PER_RANGE
    drawn = keyed.filter(F.rand(seed) * float(max(total_bytes, 1)) < F.col("size") * float(wanted))
    keys = np.sort(np.array([r[0] for r in drawn.select("key").collect()], dtype=np.int64))
    if not len(keys):
        return keys
    at = (np.arange(1, n_ranges) * len(keys)) // n_ranges
    return np.unique(keys[at])


def range_number(splitters: np.ndarray):
    @F.pandas_udf("int")
    def number(key: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(splitters, key.to_numpy(), side="right").astype(np.int32))

    return number


def balanced_ranges(keyed: DataFrame, n_ranges: int, total_bytes: int) -> tuple[np.ndarray, list]:
    """Splitters and the exact (range, bytes, rows), after subdividing overfull ranges."""
    splitters = sampled_splitters(keyed, n_ranges, total_bytes, 17)
    most = 2 * max(1, total_bytes // n_ranges)
    for again in range(4):
        number = range_number(splitters)
        held = keyed.withColumn("range", number("key"))
        sizes = sorted(
            tuple(r)
            for r in held.groupBy("range").agg(F.sum("size").alias("b"), F.count("*").alias("n")).collect()
        )
        overfull = [(r, b) for r, b, n in sizes if b > most and n > 1]
        if not overfull or len(splitters) >= 2 * MAX_RANGES:
            break
        bytes_in = sum(b for _, b in overfull)
        inside = held.filter(F.col("range").isin([r for r, _ in overfull]))
        finer = sampled_splitters(inside, 2 * max(1, bytes_in // (most // 2)), bytes_in, 18 + again)
        more = np.union1d(splitters, finer)
        if len(more) == len(splitters):  # what is left is one large row
            break
        splitters = more
    return splitters, sizes


def assign_shards(
    docs: DataFrame, n_shards: int = 24, id_col: str = "doc_id", text_col: str = "text", with_text: bool = True
) -> DataFrame:
    """One row per input row: doc_id, text, size, key, shard (0 to n_shards-1) and slot
    (gapless from 0 within the shard, in key order).

    Sizes of shards differ by at most about one record, or by a small group of equal texts,
    which is not cut. Null texts count 8 bytes; repeated rows and null ids are ordinary
    records; an empty table gives an empty result; other columns are not read.
    """
    spark = docs.sparkSession
    keyed = record_keys(docs, id_col, text_col)
    if not with_text:
        keyed = keyed.withColumn("text_crc32", F.coalesce(F.crc32(F.col("text").cast("binary")), F.lit(0))).drop("text")
    counted = keyed.agg(F.sum("size").alias("b"), F.count("*").alias("n")).first()
    total_bytes = int(counted["b"] or 0)
    n_ranges = max(1, min(MAX_RANGES, counted["n"] or 1, max(8 * n_shards, partitions(spark))))
    splitters, sizes = balanced_ranges(keyed, n_ranges, total_bytes)

    # At most 2 * MAX_RANGES rows: where each range starts on the line of bytes.
    starts, at = [], 0
    for r, b, _ in sizes:
        starts.append((r, at))
        at += b
    ranges = spark.createDataFrame(starts, "range int, range_start long")
    order = ["key", "doc_id"]
    line = Window.partitionBy("range").orderBy(*order)
    group = Window.partitionBy("range", "group")
    placed = (
        keyed.withColumn("range", range_number(splitters)("key"))
        .join(F.broadcast(ranges), "range")
        .withColumn("row", F.row_number().over(line))
        .withColumn("end", F.sum("size").over(line.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("group", F.shiftright("key", ROW_BITS))
        .withColumn("group_start", F.min(F.col("end") - F.col("size")).over(group))
        .withColumn("group_end", F.max("end").over(group))
    )
    shard_bytes = max(total_bytes / n_shards, 1e-9)
    whole = (F.col("group_end") - F.col("group_start")) <= GROUP_SHARE * shard_bytes
    middle = F.col("range_start") + F.when(whole, (F.col("group_start") + F.col("group_end")) / 2).otherwise(
        F.col("end") - F.col("size") / 2
    )
    shard = F.least(F.floor(middle / shard_bytes), F.lit(n_shards - 1)).cast("int")
    kept = written(
        placed.withColumn("shard", shard).drop("end", "group", "group_start", "group_end", "range_start"), "shards"
    )

    # Rows of a shard before each (shard, range): at most n_shards + 2 * MAX_RANGES rows.
    counts = sorted(tuple(r) for r in kept.groupBy("shard", "range").agg(F.min("row"), F.count("*")).collect())
    before, firsts, last = 0, [], None
    for s, r, first, n in counts:
        before = 0 if s != last else before
        firsts.append((s, r, before - first))
        before, last = before + n, s
    offsets = spark.createDataFrame(firsts, "shard int, range int, shift long")
    return (
        kept.join(F.broadcast(offsets), ["shard", "range"])
        .withColumn("slot", F.col("row") + F.col("shift"))
        .drop("range", "row", "shift")
    )


def write_shards(docs: DataFrame, path: str, n_shards: int = 24, id_col: str = "doc_id", text_col: str = "text") -> None:
    """The shards as folders ``shard=<k>`` of Parquet files, each in slot order."""
    shards = assign_shards(docs, n_shards, id_col, text_col)
    width = max(n_shards, partitions(docs.sparkSession))
    (
        shards.repartitionByRange(width, "shard", "slot")
        .sortWithinPartitions("shard", "slot")
        .write.mode("overwrite")
        .partitionBy("shard")
        .parquet(path)
    )
