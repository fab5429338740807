"""Wide monthly sheets: row 0 holds series codes, row 1 descriptions, the rest one month each.

A sheet is a DataFrame ``(row_ord bigint, cells array<string>)``. ``cells[0]`` is the period
token (ignored in the two header rows) and ``cells[k]`` belongs to column ``k``.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prodseries.functions.text import normalize_text, parse_period, parse_series_metadata
from prodseries.sources.csv_text import cells_hold_line_breaks, numbered, quoted

# Doubled quotes; blanks are kept; a cell may be of any length and a row of any width.
SHEET_FORMAT = {
    "header": False, "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False,
    "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_other", "maxCharsPerColumn": -1,
}
_LEAST_COLUMNS = 20_480


def _scan(spark: SparkSession, path: str, width: int, delimiter: str, line_breaks: bool) -> DataFrame:
    """Rows as ``c0 .. c<width - 1>`` with their file and place; ``_other`` has the text of a row of
    another width."""
    schema = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(width)] + [T.StructField("_other", T.StringType())])
    reader = spark.read.schema(schema).options(sep=delimiter, multiLine=line_breaks, maxColumns=max(_LEAST_COLUMNS, 2 * width), **SHEET_FORMAT)
    return reader.csv(path)


def _width_of(record: Column, delimiter: str) -> Column:
    """Cells of a row's text: the delimiters that are in no quoted cell, and one."""
    mark = re.escape(delimiter)
    bare = F.regexp_replace(record, rf'(^|{mark})\uFEFF?"[^"]*+(?:""[^"]*+)*+"', "$1")
    return F.length(bare) - F.length(F.replace(bare, F.lit(delimiter), F.lit(""))) + 1


def read_sheet(spark: SparkSession, path: str, delimiter: str = ",") -> DataFrame:
    """Read a delimited sheet as text cells, with or without a byte order mark.

    ``path`` is a file or a folder of files that continue each other in order of their names;
    ``row_ord`` counts their rows in that order. Cells may hold quotes (doubled), delimiters and
    line breaks; rows may be of any width and are kept whole. An empty cell is NULL; empty lines
    are skipped.

    Everything is done by the CSV source: a first pass finds the widest row, a second one reads
    under a schema of that width. Files are read in blocks by many tasks; only if some cell
    holds a line break is each file one task's, which streams it.
    """
    line_breaks = cells_hold_line_breaks(spark, path)
    # Under one column every wider row comes as its text.
    widths = _scan(spark, path, 1, delimiter, line_breaks).select(
        F.coalesce(_width_of(F.col("_other"), delimiter), F.lit(1)).alias("width"), "c0"
    )
    width = widths.agg(F.max("width").alias("width"), F.count("c0")).first()["width"] or 1
    rows = _scan(spark, path, width, delimiter, line_breaks).select(
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_place"),
        F.coalesce(_width_of(F.col("_other"), delimiter), F.lit(width)).alias("_width"),
        *[F.nullif(F.col(f"c{i}") if i else F.ltrim(F.col("c0"), F.lit("\ufeff")), F.lit("")).alias(f"c{i}") for i in range(width)],
    )
    return numbered(rows, "_file", "_block", "_place", "row_ord").select(
        "row_ord", F.slice(F.array(*[f"c{i}" for i in range(width)]), F.lit(1), F.col("_width")).alias("cells")
    )


def write_sheet(sheet: DataFrame, path: str, delimiter: str = ",", files: int | None = None) -> None:
    """Write a sheet as delimited text that ``read_sheet`` reads back: files in order of their
    names hold the rows in order of ``row_ord``. Rows without any text are empty lines."""
    files = files or int(sheet.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    line = F.array_join(F.transform("cells", lambda c: quoted(c, delimiter)), delimiter)
    ordered = sheet.repartitionByRange(files, "row_ord").sortWithinPartitions("row_ord")
    ordered.select(line.alias("value")).write.mode("overwrite").text(path)


def sheet_series(sheet: DataFrame) -> DataFrame:
    """One row per data column: its code, description and parsed description parts.

    A code may head several columns; all of them then carry the description of the last one.
    """
    header = (
        sheet.filter(F.col("row_ord") < 2)
        .select("row_ord", F.posexplode("cells").alias("col_ord", "cell"))
        .filter(F.col("col_ord") > 0)
        .groupBy("col_ord")
        .agg(
            F.max(F.when(F.col("row_ord") == 0, F.col("cell"))).alias("code"),
            F.max(F.when(F.col("row_ord") == 1, F.col("cell"))).alias("description"),
        )
        # An empty header cell reads as the text "nan".
        .select(
            "col_ord",
            normalize_text(F.coalesce("code", F.lit("nan"))).alias("series_code"),
            normalize_text(F.coalesce("description", F.lit("nan"))).alias("description"),
        )
    )
    described = header.groupBy("series_code").agg(
        F.max_by("description", "col_ord").alias("series_description"),
        F.collect_list("col_ord").alias("columns"),
    )
    return described.select(
        F.explode("columns").alias("col_ord"),
        "series_code",
        "series_description",
        parse_series_metadata(F.col("series_description")).alias("meta"),
    ).select("col_ord", "series_code", "series_description", "meta.*")


def sheet_to_long(sheet: DataFrame) -> DataFrame:
    """Unpivot the data rows and attach the description of every column.

    Descriptions are parsed once per column, periods once per row; only cell values are
    handled per cell. ``col_ord`` and ``row_ord`` keep the column-major reading order.
    """
    cells = (
        sheet.filter(F.col("row_ord") >= 2)
        .withColumn("period_raw", normalize_text(F.coalesce(F.get("cells", 0), F.lit("nan"))))
        .withColumn("period_date", parse_period(F.col("period_raw")))
        .select("row_ord", "period_raw", "period_date", F.posexplode("cells").alias("col_ord", "value_raw"))
        .filter(F.col("col_ord") > 0)
    )
    return cells.join(sheet_series(sheet), "col_ord")
