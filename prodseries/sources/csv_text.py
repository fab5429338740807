"""Delimited text as Spark's CSV source reads it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def cells_hold_line_breaks(spark: SparkSession, path: str) -> bool:
    """A quoted cell goes on over a line's end exactly where the line has an odd number of quotes.

    Files without such cells are read in blocks by many tasks, others by one task each.
    """
    lines = spark.read.text(path)
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    return not lines.filter(quotes % 2 == 1).isEmpty()


def quoted(cell: Column, delimiter: str = ",") -> Column:
    """A cell's text with quotes where it needs them; NULL is empty."""
    text = F.coalesce(cell, F.lit(""))
    special = text.contains(delimiter) | text.contains('"') | text.contains("\n") | text.contains("\r")
    return F.when(special, F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(text)


def numbered(rows: DataFrame, file: str, block: str, place: str, number: str) -> DataFrame:
    """Count rows from 0 in order of file, block and place. ``place`` rises by one from row to row
    of a block; only the blocks, which are few, are put in order."""
    blocks = rows.groupBy(file, block).agg(F.min(place).alias("_first"), F.count("*").alias("_rows"))
    before = Window.orderBy(file, block).rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.select(file, block, "_first", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    out = rows.join(starts, [file, block]).withColumn(number, F.col("_start") + F.col(place) - F.col("_first"))
    return out.drop(file, block, place, "_start", "_first")
