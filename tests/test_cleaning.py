import datetime

import pytest

from prodseries.operators import cleaning
from prodseries.sources.sheets import read_sheet
from prodseries.sources.tables import as_feature_table, as_operational_forecasts, read_table, write_table
from prodseries.schemas import LONG_COLUMNS, LONG_SCHEMA, OPERATIONAL_SCHEMA

SHEET = """,C1,C2,C1,
,Produccion - Cobre - Junín (TM.F),sin formato,Produccion - Oro - Lima (grs.f),Produccion - Zinc - Total (tm.f)
Ene24,"1,000",n.d.,7,1
Feb24,,5,8,2
Ene24,99,6,9,3
Set24,1,1,1,4
2024-04,2,2,2,5
"""


@pytest.fixture
def sheet(spark, tmp_path):
    path = tmp_path / "sheet.csv"
    path.write_text(SHEET, encoding="utf-8")
    return read_sheet(spark, str(path))


def test_sheet_is_read_in_file_order(sheet):
    assert [r.row_ord for r in sheet.orderBy("row_ord").collect()] == list(range(7))
    assert sheet.orderBy("row_ord").first().cells[1:4] == ["C1", "C2", "C1"]


def test_first_value_and_last_description_win(sheet, rows):
    full = cleaning.clean_full(sheet, "sheet.csv")
    assert full.columns == LONG_COLUMNS
    jan, feb = datetime.date(2024, 1, 1), datetime.date(2024, 2, 1)
    # C1 heads two columns: the first column's cells survive under the last description,
    # and a missing first entry (February) hides the later value.
    assert rows(full.filter("series_code = 'C1'"), "period_date", "value", "is_missing", "mineral", "unidad") == [
        (jan, 1000.0, False, "Oro", "grs.f"),
        (feb, None, True, "Oro", "grs.f"),
        (None, 1.0, False, "Oro", "grs.f"),
    ]
    assert rows(full.filter("series_code = 'C2'"), "period_date", "value", "is_missing", "mineral") == [
        (jan, None, True, None),
        (feb, 5.0, False, None),
        (None, 1.0, False, None),
    ]


def test_empty_header_code_is_text_nan(sheet, rows):
    full = cleaning.clean_full(sheet, "sheet.csv")
    assert {r.series_code for r in full.select("series_code").distinct().collect()} == {"C1", "C2", "nan"}


def test_base_drops_missing_only(sheet):
    full = cleaning.clean_full(sheet, "sheet.csv")
    assert full.count() == 9
    assert cleaning.clean_base(full).count() == 7


def test_report_counts(sheet):
    report = cleaning.cleaning_report(sheet, "sheet.csv").first().asDict()
    assert report == {
        "rows_raw_long": 20, "rows_after_dedup": 9, "duplicates_removed": 11, "rows_missing_semantic": 2,
        "rows_invalid_numeric": 0, "rows_base_dataset": 7, "null_period_date": 3, "null_mineral": 3,
        "null_departamento": 3, "unique_periods": 2, "unique_series_codes": 3,
    }


def test_unpivot_then_pivot_is_identity(spark):
    cells = [["", "A", "B"], ["", "d - x - y (u)", "d - z - y (u)"], ["Ene20", "1", "2"], ["Feb20", "3", None]]
    sheet = spark.createDataFrame(list(enumerate(cells)), "row_ord bigint, cells array<string>")
    long = cleaning.typed_cells(sheet, "s")
    back = {(r.row_ord, r.col_ord): r.value_raw for r in long.collect()}
    assert back == {(i, j): cells[i][j] for i in (2, 3) for j in (1, 2)}


def test_first_per_key_on_a_hot_key(spark):
    df = spark.range(30000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 'hot' ELSE string(id) END AS k", "id AS o", "id * 2 AS v"
    )
    kept = cleaning.first_per_key(df, ["k"], ["o"])
    assert kept.count() == 20001
    assert kept.filter("k = 'hot'").first().v == 0


def test_table_round_trip_as_csv_and_parquet(spark, sheet, tmp_path):
    base = cleaning.clean_base(cleaning.clean_full(sheet, "sheet.csv"))
    for fmt in ("csv", "parquet"):
        path = str(tmp_path / fmt)
        write_table(base, path, fmt)
        again = read_table(spark, path, LONG_SCHEMA, fmt)
        assert again.schema.simpleString() == LONG_SCHEMA.simpleString()
        assert again.count() == base.count()
    with pytest.raises(ValueError):
        write_table(base, str(tmp_path / "x"), "xml")


def test_typed_loads(spark):
    table = spark.createDataFrame(
        [("2024-01-01", "s", "1.5", "m", "u"), ("bad", "s", "2", "m", "u"), ("2024-02-01", "s", "NaN", "m", "u")],
        "period_date string, series_id string, target_value string, mineral string, unidad string",
    )
    loaded = as_feature_table(table, "nacional_mineral")
    assert [(r.departamento, r.level, r.target_value) for r in loaded.collect()] == [("Total", "nacional_mineral", 1.5)]
    with pytest.raises(ValueError, match="series_id"):
        as_feature_table(table.drop("series_id"), "nacional_mineral")
    frozen = spark.createDataFrame(
        [("l", "s", "m", "d", "u", "naive", "2024-01-01", "2024-02-01", "2024-02", "x"),
         ("l", "s", "m", "d", "u", None, "2024-01-01", "2024-02-01", "2024-02", "1")],
        ", ".join(f"{c} string" for c in OPERATIONAL_SCHEMA.fieldNames()),
    )
    # A row without a value stays, a row without a model goes.
    assert [r.forecast_value for r in as_operational_forecasts(frozen).collect()] == [None]


def test_sheet_cells_with_quotes_and_line_breaks_and_rows_of_any_width(spark, tmp_path):
    path = tmp_path / "odd.csv"
    path.write_text(
        '\ufeffperiodo,"code ""x"", y","two\nlines"\nx,d1,d2\nAbr24,1,77,88\n\nMay24,,\n', encoding="utf-8"
    )
    rows = [(r.row_ord, r.cells) for r in read_sheet(spark, str(path)).orderBy("row_ord").collect()]
    assert rows == [
        (0, ["periodo", 'code "x", y', "two\nlines"]),
        (1, ["x", "d1", "d2"]),
        (2, ["Abr24", "1", "77", "88"]),
        (3, ["May24", None, None]),
    ]


def test_csv_tables_keep_their_text(spark, tmp_path):
    from prodseries.sources.tables import read_table, write_table

    df = spark.createDataFrame(
        [('say "hi", twice', 1), ("two\nlines", 2), ("  blanks  ", 3), ("", 4), (None, 5)], "t string, n int"
    )
    for bom in (False, True):
        path = str(tmp_path / f"t{bom}")
        write_table(df, path, "csv", bom=bom)
        for schema in (None, df.schema):
            back = read_table(spark, path, schema, "csv")
            assert back.columns == ["t", "n"]
            assert {int(r.n): r.t for r in back.collect()} == {r.n: r.t or None for r in df.collect()}
    assert any(p.read_bytes().startswith(b"\xef\xbb\xbf") for p in (tmp_path / "tTrue").glob("*.csv"))
