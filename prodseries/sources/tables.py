"""Typed reads and writes of the tables that stages hand to each other."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prodseries.functions.measures import nan_to_null
from prodseries.schemas import FORECAST_CONTEXT, OPERATIONAL_SCHEMA, require_columns
from prodseries.sources.csv_text import cells_hold_line_breaks, numbered

# Doubled quotes, and blanks kept as they are.
CSV_FORMAT = {"quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def read_table(
    spark: SparkSession, path: str, schema: T.StructType | None = None, fmt: str = "parquet",
    line_breaks: bool | None = None,
) -> DataFrame:
    """Scan a stage table. CSV text is coerced: a cell that is empty or does not fit its type is
    NULL. ``line_breaks`` says whether cells may hold any, which makes each file one task's; None
    looks for them in a pass over the text."""
    if fmt == "parquet":
        return (spark.read.schema(schema) if schema else spark.read).parquet(path)
    if fmt != "csv":
        raise ValueError(f"Unsupported format: {fmt}")
    if line_breaks is None:
        line_breaks = cells_hold_line_breaks(spark, path)
    text = spark.read.csv(path, header=True, inferSchema=False, multiLine=line_breaks, **CSV_FORMAT)
    # An exported file may start with a byte order mark.
    text = text.toDF(*[c.lstrip("\ufeff") for c in text.columns])
    if schema is None:
        return text
    require_columns(text, schema.fieldNames(), path)
    return text.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema])


def write_table(
    df: DataFrame, path: str, fmt: str = "parquet", partition_by: list[str] | None = None, bom: bool = False
) -> None:
    """Replace a stage table as a whole. ``bom`` starts every CSV file with a byte order mark,
    as spreadsheet programs expect it."""
    if fmt not in ("parquet", "csv"):
        raise ValueError(f"Unsupported format: {fmt}")
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt == "csv":
        if bom:
            df = df.withColumnRenamed(df.columns[0], "\ufeff" + df.columns[0])
            writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
            writer = writer.partitionBy(*partition_by) if partition_by else writer
        writer.options(header=True, **CSV_FORMAT).csv(path)
    else:
        writer.parquet(path)


def write_ordered(df: DataFrame, path: str, order: list[str], files: int | None = None) -> None:
    """Replace a Parquet table by files that continue each other: rows are ranged over files in
    ``order`` (NULLs last) and sorted in each. No task holds more than a range of the rows."""
    files = files or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.asc_nulls_last(c) for c in order]
    ordered = df.repartitionByRange(files, *keys).sortWithinPartitions(*keys)
    ordered.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)


def read_ordered(spark: SparkSession, path: str, number: str = "row_no") -> DataFrame:
    """An ordered table with each row's place in it, from its file's name and its place there.
    Rows per file come from the files' footers."""
    rows = spark.read.parquet(path)
    placed = rows.select("*", F.col("_metadata.file_path").alias("_file"), F.lit(0).alias("_block"), F.col("_metadata.row_index").alias("_place"))
    return numbered(placed, "_file", "_block", "_place", number)


def write_report(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").json(path)


def as_feature_table(df: DataFrame, level: str) -> DataFrame:
    """Validate and type a feature table for forecasting, tagging it with its level."""
    require_columns(df, ["period_date", "series_id", "target_value", "mineral", "unidad"], level)
    if "departamento" not in df.columns:
        df = df.withColumn("departamento", F.lit("Total"))
    return (
        df.withColumn("period_date", F.col("period_date").try_cast("date"))
        .withColumn("target_value", nan_to_null(F.col("target_value").try_cast("double")))
        .withColumn("level", F.lit(level))
        .dropna(subset=["period_date", "series_id", "target_value"])
    )


def series_history(national: DataFrame, departamento: DataFrame) -> DataFrame:
    """Both feature tables as one history table; the forecasting input."""
    columns = [*FORECAST_CONTEXT, "period_date", "target_value"]
    return national.select(*columns).unionByName(departamento.select(*columns))


def as_operational_forecasts(df: DataFrame) -> DataFrame:
    """Type a table of frozen forecasts. Rows without a value stay; they are dropped later,
    point by point, when documents are built."""
    require_columns(df, OPERATIONAL_SCHEMA.fieldNames(), "operational forecasts")
    typed = df.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in OPERATIONAL_SCHEMA])
    return typed.withColumn("forecast_value", nan_to_null(F.col("forecast_value"))).dropna(
        subset=["level", "series_id", "selected_model", "forecast_period_date"]
    )
