"""Sheet -> clean long tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prodseries.functions.text import parse_numeric
from prodseries.schemas import LONG_COLUMNS, SERIES_KEY
from prodseries.sources.sheets import sheet_to_long

READING_ORDER = ["col_ord", "row_ord"]


def typed_cells(sheet: DataFrame, source_dataset: str) -> DataFrame:
    """All cells with parsed values, duplicates still in."""
    return (
        sheet_to_long(sheet)
        .withColumns(
            {
                "parsed": parse_numeric(F.col("value_raw")),
                "source_dataset": F.lit(source_dataset),
                "year": F.year("period_date"),
                "month": F.month("period_date"),
            }
        )
        .select("*", "parsed.*")
        .select(*LONG_COLUMNS, *READING_ORDER)
    )


def first_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Keep the first row of every key; NULL keys are equal to each other.

    An aggregate rather than a ranking window: copies of a hot key collapse before the
    shuffle instead of meeting in one task.
    """
    payload = [c for c in df.columns if c not in keys]
    return (
        df.groupBy(*keys)
        .agg(F.min_by(F.struct(*payload), F.struct(*order)).alias("kept"))
        .select(*keys, "kept.*")
    )


def clean_full(sheet: DataFrame, source_dataset: str) -> DataFrame:
    """Deduplicated observations, missing ones included."""
    cells = typed_cells(sheet, source_dataset)
    return first_per_key(cells, SERIES_KEY, READING_ORDER).select(*LONG_COLUMNS)


def clean_base(full: DataFrame) -> DataFrame:
    """Drop cells without a value. Runs after deduplication, so a missing first entry hides a
    later valid one; cells that are present but not numbers stay for the quality rules."""
    return full.filter(~F.col("is_missing"))


def cleaning_report(sheet: DataFrame, source_dataset: str) -> DataFrame:
    """One row of counters over the deduplicated table, plus what deduplication removed."""
    cells = typed_cells(sheet, source_dataset)
    keyed = cells.withColumn("_rows", F.lit(1)).groupBy(*SERIES_KEY).agg(
        F.sum("_rows").alias("copies"),
        F.min_by(
            F.struct("is_missing", "is_invalid_numeric", "mineral", "departamento"), F.struct(*READING_ORDER)
        ).alias("kept"),
    )
    return keyed.select(*SERIES_KEY, "copies", "kept.*").agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("rows_raw_long"),
        F.count("*").alias("rows_after_dedup"),
        F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("duplicates_removed"),
        F.count_if("is_missing").alias("rows_missing_semantic"),
        F.count_if("is_invalid_numeric").alias("rows_invalid_numeric"),
        F.count_if(~F.col("is_missing")).alias("rows_base_dataset"),
        F.count_if(F.col("period_date").isNull()).alias("null_period_date"),
        F.count_if(F.col("mineral").isNull()).alias("null_mineral"),
        F.count_if(F.col("departamento").isNull()).alias("null_departamento"),
        F.count_distinct("period_date").alias("unique_periods"),
        F.count_distinct("series_code").alias("unique_series_codes"),
    )
