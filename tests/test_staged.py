"""Sheets and tables on files: order, line breaks, blocks, and what the shared folder may be."""

import pytest
from pyspark.sql import functions as F

from prodseries.session import scratch_path, shared_folder
from prodseries.sources.csv_text import cells_hold_line_breaks
from prodseries.sources.sheets import read_sheet, write_sheet
from prodseries.sources.tables import read_ordered, read_table, write_ordered, write_table

CELLS = [
    ["", "A,1", 'B "x"'],
    ["", "d - x - y (u)", None],
    *[[f"Ene{i:02}", str(i), None if i % 3 else f" {i} , é "] for i in range(60)],
]


def sheet_of(spark, cells, step=7):
    return spark.createDataFrame([(i * step, c) for i, c in enumerate(cells)], "row_ord bigint, cells array<string>")


def test_a_folder_of_files_is_one_sheet_in_one_order(spark, tmp_path):
    path = str(tmp_path / "sheet")
    write_sheet(sheet_of(spark, CELLS).orderBy(F.rand(1)), path, files=4)
    assert len(list((tmp_path / "sheet").glob("part-*"))) == 4
    back = read_sheet(spark, path).orderBy("row_ord").collect()
    assert [r.row_ord for r in back] == list(range(len(CELLS)))
    assert [r.cells for r in back] == [[c or None for c in row] for row in CELLS]


def test_files_without_line_breaks_are_read_in_blocks(spark, tmp_path):
    path = str(tmp_path / "sheet")
    write_sheet(sheet_of(spark, CELLS), path, files=2)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "128")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        sheet = read_sheet(spark, path)
        assert sheet.select("row_ord").rdd.getNumPartitions() >= 1
        blocks = spark.read.csv(path).select("_metadata.file_block_start").distinct().count()
        assert blocks > 2  # of two files
        assert [r.cells[0] for r in sheet.orderBy("row_ord").collect()] == [c[0] or None for c in CELLS]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    plan = sheet._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "MapInArrow" not in plan and "binaryFile" not in plan


def test_line_breaks_and_widths_over_several_files(spark, tmp_path):
    cells = [["", "two\nlines", "c"], ["", 'say ""', "d\r\nd"], ["x"], ["Abr24", "1", "2", "3", "4"], ["May24", None, None, None, "\n"]]
    path = str(tmp_path / "odd")
    write_sheet(sheet_of(spark, cells), path, delimiter=";", files=3)
    assert cells_hold_line_breaks(spark, path)
    back = read_sheet(spark, path, ";").orderBy("row_ord").collect()
    assert [r.cells for r in back] == [[c or None for c in row] for row in cells]


def test_empty_and_single_column_sheets(spark, tmp_path):
    (tmp_path / "empty.csv").write_text("")
    assert read_sheet(spark, str(tmp_path / "empty.csv")).collect() == []
    (tmp_path / "one.csv").write_text("\ufeffa\n\nb\n", encoding="utf-8")
    assert [r.cells for r in read_sheet(spark, str(tmp_path / "one.csv")).orderBy("row_ord").collect()] == [["a"], ["b"]]


def test_wide_rows(spark, tmp_path):
    wide = [[f"c{i}" for i in range(2500)], ["x"], [str(i) for i in range(2501)]]
    write_sheet(sheet_of(spark, wide), str(tmp_path / "wide"), files=1)
    back = read_sheet(spark, str(tmp_path / "wide")).orderBy("row_ord").collect()
    assert [r.cells for r in back] == wide


def test_order_is_told_by_the_files(spark, tmp_path):
    rows = [(i % 50 if i % 7 else None, f"k{i % 11}", i) for i in range(1000)]
    df = spark.createDataFrame(rows, "a int, b string, n int").repartition(5)
    path = str(tmp_path / "ordered")
    write_ordered(df, path, ["a", "b", "n"], files=6)
    back = read_ordered(spark, path).orderBy("row_no").collect()
    assert [r.row_no for r in back] == list(range(1000))
    assert [(r.a, r.b, r.n) for r in back] == sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1], r[2]))
    # The ranges of the files follow each other.
    spans = spark.read.parquet(path).groupBy(F.col("_metadata.file_name").alias("f")).agg(
        F.min(F.struct(F.col("a").isNull(), "a", "b", "n")).alias("low"), F.max(F.struct(F.col("a").isNull(), "a", "b", "n")).alias("high")
    ).orderBy("f").collect()
    assert len(spans) > 2
    assert all(tuple(x.high) < tuple(y.low) for x, y in zip(spans, spans[1:], strict=False))


def test_csv_tables_say_whether_cells_hold_line_breaks(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b, c"), (3, None)], "n int, t string")
    path = str(tmp_path / "t")
    write_table(df, path, "csv")
    for line_breaks in (None, True, False):
        assert sorted(map(tuple, read_table(spark, path, df.schema, "csv", line_breaks).collect())) == [(1, "a"), (2, "b, c"), (3, None)]


def test_shared_folder(spark, monkeypatch):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    assert scratch_path(spark, "x") != scratch_path(spark, "x")

    class Elsewhere:
        conf = type("C", (), {"get": staticmethod(lambda k, d=None: d)})
        sparkContext = type("S", (), {"master": "yarn"})

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(Elsewhere)
