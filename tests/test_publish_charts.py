import datetime

import pytest

from prodseries.operators import charts, publish

D = datetime.date
T1, T2 = "2025-01-01 00:00:00", "2025-02-01 00:00:00"
DOC = "period_date date, series_code string, value double, note string"


def batch(spark, *rows):
    return spark.createDataFrame(list(rows), DOC)


def state(df):
    return {
        (r.period_date, r.series_code): (r.value, r.note, str(r.ingested_at)[:7], str(r.updated_at)[:7])
        for r in df.collect()
    }


A, B, C = (D(2024, 1, 1), "a"), (D(2024, 1, 1), "b"), (D(2024, 2, 1), "a")


@pytest.mark.parametrize("partition", [None, "period_date"])
def test_upsert_statuses_and_stamps(spark, partition):
    snapshot = publish.first_load(batch(spark, (*A, 1.0, "x"), (*B, 2.0, "y")), T1)
    merged = publish.upsert(snapshot, batch(spark, (*A, 9.0, None), (*C, 3.0, "z")), ["period_date", "series_code"], T2, partition=partition)
    assert {(r.period_date, r.series_code): r.write_status for r in merged.collect()} == {
        A: "matched", B: "kept", C: "inserted",
    }
    # A NULL that the batch carries replaces the old value.
    assert state(merged) == {
        A: (9.0, None, "2025-01", "2025-02"), B: (2.0, "y", "2025-01", "2025-01"), C: (3.0, "z", "2025-02", "2025-02"),
    }
    assert publish.upsert_counters(merged).first().asDict() == {
        "n_operations": 2, "matched_count": 1, "modified_count": 1, "upserted_count": 1,
    }


def test_upsert_keeps_fields_the_batch_does_not_carry(spark):
    snapshot = publish.first_load(batch(spark, (*A, 1.0, "x")), T1)
    merged = publish.upsert(snapshot, batch(spark, (*A, 5.0, "?"), (*C, 6.0, "?")).drop("note"), ["period_date", "series_code"], T2)
    assert state(merged) == {A: (5.0, "x", "2025-01", "2025-02"), C: (6.0, None, "2025-02", "2025-02")}


def test_upsert_matches_null_key_parts_when_told_to(spark):
    rows = batch(spark, (D(2024, 1, 1), None, 1.0, "x"))
    merged = publish.upsert(publish.first_load(rows, T1), rows, ["period_date", "series_code"], T2, ["series_code"])
    assert [r.write_status for r in merged.collect()] == ["matched"]


def test_repeated_batch_key_fails(spark):
    snapshot = publish.first_load(batch(spark, (*A, 1.0, "x")), T1)
    with pytest.raises(Exception, match="duplicate key in batch"):
        publish.upsert(snapshot, batch(spark, (*B, 1.0, "x"), (*B, 2.0, "x")), ["period_date", "series_code"], T2).collect()


def test_upsert_table_rewrites_touched_months_only(spark, tmp_path):
    path = str(tmp_path / "facts")
    keys = ["period_date", "series_code"]
    first = batch(spark, (*A, 1.0, "x"), (*B, 2.0, "y"), (*C, 3.0, "z"))
    assert publish.upsert_table(spark, path, first, keys, T1)["upserted_count"] == 3
    january = sorted(p.name for p in (tmp_path / "facts" / "period_date=2024-01-01").glob("*.parquet"))
    again = batch(spark, (*C, 4.0, "z"), (D(2024, 2, 1), "n", 7.0, "n"))
    for load in (1, 2):
        counters = publish.upsert_table(spark, path, again, keys, T2)
        assert counters == {
            "n_operations": 2, "matched_count": load, "modified_count": load, "upserted_count": 2 - load,
        }
    assert january == sorted(p.name for p in (tmp_path / "facts" / "period_date=2024-01-01").glob("*.parquet"))
    table = spark.read.parquet(path)
    assert table.count() == 4
    # Twice is once: only the first insert sets ingested_at.
    assert state(table)[(D(2024, 2, 1), "n")] == (7.0, "n", "2025-02", "2025-02")
    assert state(table)[C] == (4.0, "z", "2025-01", "2025-02")


def test_upsert_join_reuses_the_key_check_partitioning(spark):
    snapshot = publish.first_load(batch(spark, (*A, 1.0, "x")), T1)
    merged = publish.upsert(snapshot.hint("merge"), batch(spark, (*A, 1.0, "x")), ["period_date", "series_code"], T2)
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2


def tables(spark):
    rows = [("2024-01", 1), ("2024-02", 2), (None, 3)]
    tidy = spark.createDataFrame(rows, "period_yyyymm string, v int")
    return [tidy, tidy.filter("v = 1")], tidy


def test_load_selection(spark):
    both, tidy = tables(spark)
    chosen = publish.select_load_rows(both, tidy, "incremental")
    # The newest month of the facts decides for every table.
    assert [t.count() for t in chosen] == [1, 0]
    assert [t.count() for t in publish.select_load_rows(both, tidy, "incremental", "2024-01")] == [1, 1]
    assert [t.count() for t in publish.select_load_rows(both, tidy, "full_refresh")] == [3, 1]
    assert [t.count() for t in publish.select_load_rows(both, tidy, "full_refresh", "2024-02")] == [1, 0]
    with pytest.raises(ValueError):
        publish.select_load_rows(both, tidy, "partial")
    with pytest.raises(Exception, match="No periods found"):
        publish.select_load_rows(both, tidy.filter("v = 3"), "incremental")[0].collect()


OPERATIONAL = (
    "level string, series_id string, mineral string, departamento string, unidad string, selected_model string,"
    " last_observed_period date, forecast_period_date date, forecast_period_yyyymm string, forecast_value double"
)


def frozen(spark, *rows):
    out = []
    for level, series, mineral, area, model, m, value in rows:
        d = D(2024, m, 1)
        out.append((level, series, mineral, area, "u", model, D(2023, 12, 1), d, d.strftime("%Y-%m"), value))
    return spark.createDataFrame(out, OPERATIONAL)


def test_prediction_documents(spark):
    df = frozen(
        spark,
        ("l", "s", " oro ", "d", "naive", 3, 2.0),
        ("l", "s", "oro", "d", "naive", 2, None),
        ("l", "s", "oro", "d", "naive", 1, 2.0),
        ("l", "t", "oro", "d", "naive", 1, None),
        ("l", "u", "", "d", "seasonal_ar", 1, 1.0),
        ("l", "u", "oro", "d", "seasonal_ar", 2, 3.0),
    )
    docs = {r.series_id: r for r in publish.prediction_documents(df, {"selection_mode": "level_mae"}).collect()}
    assert set(docs) == {"s", "u"}
    s = docs["s"]
    assert s.prediction_id == "naive|l|s|2024-01|2024-03" and s.forecast_window_months == 2
    assert [p.forecast_period_yyyymm for p in s.forecasts] == ["2024-01", "2024-03"]
    assert s.forecast_stats.is_flat_forecast and s.forecast_stats.mean_value == 2.0
    assert docs["u"].mineral is None and not docs["u"].forecast_stats.is_flat_forecast
    assert s.source.asDict() == {
        "phase": "fase8_operational", "selection_mode": "level_mae", "dynamic_tolerance_pct": None,
    }
    summary = {r.model: (r.documents, r.flat_documents) for r in publish.prediction_summary(publish.prediction_documents(df)).collect()}
    assert summary == {"naive": (1, 1), "seasonal_ar": (1, 0)}


def test_selection_metadata_keeps_what_is_there(spark):
    report = spark.createDataFrame([(("m", 10.0),)], "selection_rule struct<mode: string, dynamic_tolerance_pct: double>")
    assert publish.selection_metadata(report) == {"selection_mode": "m", "dynamic_tolerance_pct": 10.0}
    partial = spark.createDataFrame([((None, "m"),)], "selection_rule struct<x: string, mode: string>")
    assert publish.selection_metadata(partial) == {"selection_mode": "m"}
    assert publish.selection_metadata(spark.range(1)) == {}


LEVEL = "departamento_mineral"


def forecasts(spark):
    return frozen(
        spark,
        (LEVEL, "a", "oro", "Lima", "naive", 1, 5.0),
        (LEVEL, "b", "cobre", "Lima", "naive", 1, 5.0),
        (LEVEL, "c", "zinc", "Junin", "seasonal_ar", 1, 1.0),
        ("nacional_mineral", "n", "plata", "Lima", "naive", 1, 2.0),
    )


def test_pick_series(spark):
    df = forecasts(spark)
    assert charts.pick_series(df, LEVEL).first().series_id == "a"  # a tie goes to the first id
    assert charts.pick_series(df, LEVEL, "c").first().selected_model == "seasonal_ar"
    with pytest.raises(Exception, match="Requested series_id not found"):
        charts.pick_series(df, LEVEL, "n").collect()
    with pytest.raises(Exception, match="No operational forecasts found"):
        charts.pick_series(df, "other").collect()


def test_category_lines_take_any_level_of_the_department(spark):
    lines = charts.category_lines(forecasts(spark), LEVEL, "a", 2)
    assert sorted(r.category for r in lines.collect()) == ["cobre", "oro"]
    everything = charts.category_lines(forecasts(spark), LEVEL, "a", 9)
    assert sorted(r.category for r in everything.collect()) == ["cobre", "oro", "plata"]
    national = charts.category_lines(forecasts(spark), "nacional_mineral")
    assert [r.category for r in national.collect()] == ["plata"]


def test_smoothing_includes_the_current_row(spark):
    df = spark.createDataFrame(
        [("s", "naive", D(2024, m, 1), float(m), 2.0 * m) for m in range(1, 5)],
        "series_id string, model string, date date, actual double, predicted double",
    )
    rows = charts.smoothed_trend(charts.residuals(df), 3).orderBy("date").collect()
    assert [r.actual_trend for r in rows] == [1.0, 1.5, 2.0, 3.0]
    assert [r.predicted_trend for r in rows] == [2.0, 3.0, 4.0, 6.0]
    assert [r.residual for r in rows] == [-1.0, -2.0, -3.0, -4.0]


def test_columns_of_an_earlier_load_stay(spark, tmp_path):
    """A batch that lacks a column must not take it from the months it rewrites."""
    path = str(tmp_path / "t")
    first = spark.createDataFrame([(datetime.date(2024, 1, 1), "a", 1.0)], "period_date date, k string, value double")
    extra = spark.createDataFrame(
        [(datetime.date(2024, 1, 1), "b", 2.0, "kept")], "period_date date, k string, value double, extra string"
    )
    for batch in (first, extra, first):
        publish.upsert_table(spark, path, batch, ["period_date", "k"], "2024-02-01 00:00:00")
    rows = {r.k: (r.value, r.extra) for r in publish.stored_table(spark, path).collect()}
    assert rows == {"a": (1.0, None), "b": (2.0, "kept")}


def test_documents_with_and_without_metadata_merge(spark):
    forecasts = spark.createDataFrame(
        [("m", "l", "s", "min", "dep", "u", datetime.date(2024, 1, 1), datetime.date(2024, 2, 1), "2024-02", 3.0)],
        "selected_model string, level string, series_id string, mineral string, departamento string, unidad string,"
        " last_observed_period date, forecast_period_date date, forecast_period_yyyymm string, forecast_value double",
    )
    snapshot = publish.first_load(publish.prediction_documents(forecasts), "2024-02-01 00:00:00")
    batch = publish.prediction_documents(forecasts, {"selection_mode": "level_mae", "dynamic_tolerance_pct": 10})
    row = publish.upsert(snapshot, batch, publish.PREDICTIONS["keys"], "2024-03-01 00:00:00").first()
    assert row.write_status == "matched" and row.source.selection_mode == "level_mae"


def test_two_spellings_of_a_month_give_one_aggregate(spark):
    schema = (
        "period_date date, period_raw string, period_yyyymm string, year int, month int, quarter int, semester int,"
        " mineral string, unidad string, dept_sum_value double, n_departamentos long, official_total_value double,"
        " abs_gap_vs_total double, pct_gap_vs_total double"
    )
    day = datetime.date(2024, 4, 1)
    rows = [(day, raw, "2024-04", 2024, 4, 2, 1, "m", "u", v, 1, v, 0.0, 0.0) for raw, v in (("Abr24", 1.0), ("abr24", 2.0))]
    minerals = spark.createDataFrame(rows, schema)
    departments = spark.createDataFrame(
        [],
        "period_date date, period_raw string, period_yyyymm string, year int, month int, quarter int, semester int,"
        " departamento string, unidad string, dept_unit_sum_value double, n_minerales long",
    )
    documents = publish.aggregate_documents(minerals, departments)
    assert [d.dept_sum_value for d in documents.collect()] == [2.0]
    assert "_spelling" not in documents.columns
