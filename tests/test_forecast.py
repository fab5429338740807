from pyspark.sql import functions as F
import datetime
import math

import numpy as np
import pytest

from prodseries.operators import forecast, selection

D = datetime.date


def month(i, base=2018):
    return D(base + i // 12, i % 12 + 1, 1)


def history(spark, series, level="departamento_mineral"):
    """``series``: id -> values or (month number, value) pairs."""
    rows = []
    for sid, values in series.items():
        points = [v if isinstance(v, tuple) else (i, v) for i, v in enumerate(values)]
        rows += [(level, sid, "m-" + sid, "d", "u", month(i), float(v)) for i, v in points]
    return spark.createDataFrame(
        rows,
        "level string, series_id string, mineral string, departamento string, unidad string, period_date date,"
        " target_value double",
    )


def noisy(n, seed=1):
    rng = np.random.default_rng(seed)
    return list(100 + np.arange(n) * 0.7 + 10 * np.sin(np.arange(n) * math.pi / 6) + rng.normal(0, 3, n))


def seasonal_ar(y, h):
    y = list(map(float, y))
    d = np.diff(y)
    # d[i] is the change into row i+2 of a 1-based series; the fit uses rows 14..n.
    target, near, far = d[12:], d[11:-1], d[: len(d) - 12]
    (a, b), *_ = np.linalg.lstsq(np.column_stack([near, far]), target, rcond=None)
    for _ in range(h):
        y.append(y[-1] + a * (y[-1] - y[-2]) + b * (y[-12] - y[-13]))
    return y[-h:]


def trend_seasonal(y, h, base=2018):
    x = np.array([12 * month(i, base).year + month(i, base).month for i in range(len(y))], float)
    slope, intercept = np.polyfit(x - x.mean(), y, 1)
    line = lambda t: intercept + slope * (t - x.mean())
    residual = np.array(y) - line(x)
    out = []
    for t in x[-1] + np.arange(1, h + 1):
        same = residual[(x - 1) % 12 == (t - 1) % 12]
        out.append(line(t) + (same.mean() if len(same) else 0.0))
    return out


def values_of(df):
    return [r.forecast_value for r in df.orderBy("horizon_step").collect()]


def test_models_equal_their_definitions(spark):
    y = noisy(40)
    h = history(spark, {"s": y})
    assert values_of(forecast.forecast_with(h, "naive", 3)) == [y[-1]] * 3
    np.testing.assert_allclose(values_of(forecast.forecast_with(h, "moving_average", 2)), [np.mean(y[-3:])] * 2)
    # Past step 12 the seasonal term uses forecasts.
    np.testing.assert_allclose(values_of(forecast.forecast_with(h, "seasonal_ar", 15)), seasonal_ar(y, 15), rtol=1e-8)
    np.testing.assert_allclose(
        values_of(forecast.forecast_with(h, "trend_seasonal", 14)), trend_seasonal(y, 14), rtol=1e-8
    )
    dates = [r.forecast_period_date for r in forecast.forecast_with(h, "naive", 3).orderBy("horizon_step").collect()]
    assert dates == [month(40), month(41), month(42)]


def test_unseen_month_has_no_seasonal_term(spark):
    y = [3.0, 5.0, 4.0, 8.0]
    np.testing.assert_allclose(
        values_of(forecast.forecast_with(history(spark, {"s": y}), "trend_seasonal", 3)), trend_seasonal(y, 3), rtol=1e-9
    )


def test_short_moving_average_and_unknown_model(spark):
    h = history(spark, {"s": [2.0, 4.0]})
    assert values_of(forecast.forecast_with(h, "moving_average", 1)) == [3.0]
    with pytest.raises(ValueError, match="Unsupported model: sarimax"):
        forecast.forecast_with(h, "sarimax")


def test_backtest_rows_metrics_and_future(spark):
    y = noisy(30)
    views = forecast.backtest(history(spark, {"s": y}))
    got = {(r.model, r.horizon_step): r for r in views.predictions.collect()}
    assert len(got) == 12
    expected = {
        "naive": [y[26]] * 3, "moving_average": [np.mean(y[24:27])] * 3,
        "seasonal_ar": seasonal_ar(y[:27], 3), "trend_seasonal": trend_seasonal(y[:27], 3),
    }
    for model, path in expected.items():
        np.testing.assert_allclose([got[model, k].y_pred for k in (1, 2, 3)], path, rtol=1e-8)
        assert [got[model, k].y_true for k in (1, 2, 3)] == y[27:]
        assert got[model, 1].train_rows == 27 and got[model, 1].train_last_period == month(26)
        error = np.abs(np.array(y[27:]) - path)
        metric = next(r for r in views.metrics.collect() if r.model == model)
        np.testing.assert_allclose(
            [metric.mae, metric.rmse, metric.mape, metric.smape],
            [
                error.mean(), np.sqrt((error**2).mean()), (error / np.abs(y[27:])).mean() * 100,
                (2 * error / (np.abs(y[27:]) + np.abs(path))).mean() * 100,
            ],
            rtol=1e-8,
        )
    future = {(r.model, r.horizon_step): r.forecast_value for r in views.future.collect()}
    np.testing.assert_allclose([future["seasonal_ar", k] for k in (1, 2, 3)], seasonal_ar(y, 3), rtol=1e-8)
    assert views.skipped.count() == 0


def test_metrics_skip_zero_denominators(spark):
    rows = [("l", "s", "m", "d", "u", "naive", 24, 3, month(0), 0.0, p) for p in (0.0, 2.0)]
    df = spark.createDataFrame(
        rows,
        "level string, series_id string, mineral string, departamento string, unidad string, model string,"
        " train_rows int, test_rows int, train_last_period date, y_true double, y_pred double",
    )
    r = forecast.backtest_metrics(df).first()
    assert (r.mae, r.mape, r.smape) == (1.0, None, 200.0)
    assert forecast.backtest_metrics(df.filter("y_pred = 0")).first().smape is None


def test_skip_reasons(spark):
    constant = [5.0] * 40
    views = forecast.backtest(history(spark, {"short": noisy(26), "flat": constant, "ok": noisy(30)}))
    got = sorted((r.series_id, r.model, r.reason) for r in views.skipped.collect())
    assert got == [("flat", "seasonal_ar", "singular_fit"), ("short", "all", "insufficient_history(len=26)")]
    assert {r.model for r in views.future.filter("series_id = 'flat'").collect()} == {
        "naive", "moving_average", "trend_seasonal",
    }
    # Enough for the split, too little for the seasonal model; then only the full history suffices.
    loose = forecast.backtest(history(spark, {"s": noisy(22)}), min_train=10)
    assert [r.reason for r in loose.skipped.collect()] == ["series too short for seasonal baseline"]
    assert loose.predictions.filter("model = 'seasonal_ar'").count() == 0
    assert loose.future.filter("model = 'seasonal_ar'").count() == 0


def test_future_failure_is_logged_apart(spark):
    # The held-out rows end the variation that made the training fit solvable... the other way
    # round cannot happen with real data, so the state is edited.
    state = forecast.backtest_state(history(spark, {"s": noisy(40)}))
    broken = state.selectExpr(
        "* except (fits)",
        "CASE WHEN holdout = 0 THEN transform(fits, f -> CASE WHEN f.model = 'seasonal_ar' THEN"
        " named_struct('model', f.model, 'reason', 'singular_fit', 'path', CAST(NULL AS ARRAY<DOUBLE>))"
        " ELSE f END) ELSE fits END AS fits",
    )
    assert [tuple(r) for r in forecast.skipped_series(broken).collect()] == [
        ("departamento_mineral", "s", "seasonal_ar_future", "singular_fit")
    ]
    assert forecast.future_forecasts(broken).filter("model = 'seasonal_ar'").count() == 0


def test_split_and_positional_gap(spark):
    h = history(spark, {"s": [(i if i < 20 else i + 5, float(i)) for i in range(28)], "short": noisy(26)})
    split = forecast.split_train_test(h)
    assert {r.series_id for r in split.collect()} == {"s"}
    assert [r.period_date for r in split.filter("split = 'test'").orderBy("period_date").collect()] == [
        month(30), month(31), month(32),
    ]


def test_forecasting_shuffles_history_once(spark):
    h = history(spark, {"s": noisy(30)}).repartition(3)
    plan = forecast.backtest(h).metrics._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Python" not in plan


# ------------------------------------------------------------------------- selection


def metrics(spark, *rows):
    return spark.createDataFrame(
        [("l", s, m, None if mae is None else float(mae), float(rmse)) for s, m, mae, rmse in rows],
        "level string, series_id string, model string, mae double, rmse double",
    )


def chosen(df):
    return {r.series_id: r.series_model for r in df.collect()}


def test_series_selection_ties_and_tolerance(spark):
    table = metrics(
        spark,
        ("tie", "moving_average", 1, 1), ("tie", "naive", 1, 1),
        ("rmse", "naive", 1, 2), ("rmse", "moving_average", 1, 1.5),
        ("edge", "naive", 10, 1), ("edge", "seasonal_ar", 10 * (1 + 10 / 100), 9), ("edge", "trend_seasonal", 12, 9),
        ("over", "naive", 10, 1), ("over", "seasonal_ar", 11.01, 1),
        ("dynamic", "naive", 3, 1), ("dynamic", "trend_seasonal", 2, 1), ("dynamic", "seasonal_ar", 2.1, 0),
        ("unknown", "naive", None, 1), ("unknown", "seasonal_ar", float("nan"), 1),
    )
    assert chosen(selection.select_by_series(table, "series_mae")) == {
        "tie": "naive", "rmse": "moving_average", "edge": "naive", "over": "naive", "dynamic": "trend_seasonal",
        "unknown": "naive",
    }
    assert chosen(selection.select_by_series(table, "series_mae_dynamic")) == {
        # 10 * 1.1 is 11.000000000000002: exactly at the edge counts as within.
        "tie": "naive", "rmse": "moving_average", "edge": "seasonal_ar", "over": "naive", "dynamic": "trend_seasonal",
        # Two unknown maes are both infinite, so the dynamic model is preferred.
        "unknown": "seasonal_ar",
    }
    with pytest.raises(ValueError):
        selection.select_by_series(table, "best")


def board(spark, dep="naive", nat="naive"):
    return spark.createDataFrame(
        [("departamento_mineral", dep, 1.0, 1.0), ("nacional_mineral", nat, 1.0, 1.0),
         ("departamento_mineral", "trend_seasonal", None, 0.5)],
        "level string, model string, mae_mean double, rmse_mean double",
    )


def test_level_selection_orders_unknown_last_then_by_name(spark):
    table = spark.createDataFrame(
        [("a", "z", 1.0, 1.0), ("a", "b", 1.0, 1.0), ("a", "a", None, 0.0)],
        "level string, model string, mae_mean double, rmse_mean double",
    )
    assert [tuple(r) for r in selection.select_by_level(table).collect()] == [("a", "b")]


def series_metrics(spark, **models):
    return spark.createDataFrame(
        [("departamento_mineral", s, m, 1.0, 1.0) for s, m in models.items()],
        "level string, series_id string, model string, mae double, rmse double",
    )


def test_operational_forecast_window_fallback_and_skips(spark):
    h = history(
        spark,
        {"own": noisy(30), "none": noisy(30, 2), "flat": [5.0] * 30, "odd": noisy(30, 3), "short": noisy(20),
         "late": [(i + 40, v) for i, v in enumerate(noisy(30))]},
    )
    picked = series_metrics(
        spark, own="seasonal_ar", flat="seasonal_ar", odd="mystery", short="seasonal_ar", late="naive"
    )
    out = selection.operational_forecast(
        h, board(spark), picked, "series_mae", D(2020, 8, 1), D(2021, 1, 1)
    )
    rows = out.forecasts.collect()
    models = {r.series_id: r.selected_model for r in rows}
    # A model that does not fit, or is not known, gives way to the level's model.
    assert models == {"own": "seasonal_ar", "none": "naive", "flat": "naive", "odd": "naive"}
    own = [r.forecast_value for r in sorted(rows, key=lambda r: r.forecast_period_date) if r.series_id == "own"]
    np.testing.assert_allclose(own, seasonal_ar(noisy(30), 7)[1:], rtol=1e-8)
    assert {r.forecast_period_yyyymm for r in rows} == {f"2020-{m:02d}" for m in range(8, 13)} | {"2021-01"}
    skipped = {r.series_id: (r.model, r.reason) for r in out.skipped.collect()}
    assert skipped == {
        "short": ("naive", "insufficient_history(len=20)"), "late": ("naive", "no_future_window"),
    }


def test_operational_failures_name_both_models(spark):
    h = history(spark, {"flat": [5.0] * 30, "same": [5.0] * 30})
    picked = series_metrics(spark, flat="mystery", same="seasonal_ar")
    out = selection.operational_forecast(
        h, board(spark, dep="seasonal_ar"), picked, "series_mae", D(2020, 8, 1), D(2020, 9, 1)
    )
    assert out.forecasts.count() == 0
    assert {r.series_id: (r.model, r.reason) for r in out.skipped.collect()} == {
        "flat": ("mystery", "primary=Unsupported model: mystery; fallback=singular_fit"),
        "same": ("seasonal_ar", "singular_fit"),
    }


def test_both_levels_are_required(spark):
    h = history(spark, {"s": noisy(30)})
    only = board(spark).filter("level = 'departamento_mineral'")
    with pytest.raises(Exception, match="both levels"):
        selection.operational_forecast(h, only, None, "level_mae").forecasts.collect()
    with pytest.raises(ValueError):
        selection.operational_forecast(h, only, None, "guess")


def test_executive_table_has_every_month_in_order(spark):
    h = history(spark, {"s": noisy(30)})
    out = selection.operational_forecast(h, board(spark), None, "level_mae", D(2020, 8, 1), D(2020, 9, 1))
    months = ["2020-07", "2020-08", "2020-09", "2020-10"]
    table = selection.executive_table(out.forecasts, months)
    assert table.columns[-4:] == months
    row = table.first()
    assert row["2020-07"] is None and row["2020-10"] is None and row["2020-08"] is not None
    assert {r.level: r.series_count for r in selection.series_coverage(out.forecasts).collect()} == {
        "departamento_mineral": 1, "nacional_mineral": 0,
    }
    assert selection.window_months(D(2025, 11, 1), D(2026, 2, 1)) == ["2025-11", "2025-12", "2026-01", "2026-02"]
    assert len(selection.window_months(selection.WINDOW_START, selection.WINDOW_END)) == 11


def test_leaderboard_means_skip_unknown_metrics(spark):
    table = spark.createDataFrame(
        [("l", "a", "naive", 1.0, 1.0, float("nan"), 2.0), ("l", "b", "naive", 3.0, 3.0, 4.0, None)],
        "level string, series_id string, model string, mae double, rmse double, mape double, smape double",
    )
    assert tuple(forecast.leaderboard(table).first()) == ("l", "naive", 2, 2.0, 2.0, 4.0, 2.0)


def test_a_level_without_a_model_is_logged(spark):
    h = history(spark, {"s": noisy(30)}).withColumn("level", F.lit("another"))
    out = selection.operational_forecast(h, board(spark), None, "level_mae", D(2020, 8, 1), D(2030, 9, 1))
    assert out.forecasts.count() == 0
    assert [(r.model, r.reason) for r in out.skipped.collect()] == [(None, "no_selected_model")]


# ------------------------------------------------------------- models that are fitted by name


def _months(n, start=0):
    return [datetime.date(2015 + (start + i) // 12, (start + i) % 12 + 1, 1) for i in range(n)]


def _frame(spark, series):
    rows = [("l", name, "m", "d", "u", day, float(v)) for name, (days, values) in series.items() for day, v in zip(days, values, strict=True)]
    return spark.createDataFrame(
        rows, "level string, series_id string, mineral string, departamento string, unidad string, period_date date, target_value double"
    )


def _arma_by_numpy(y, h):
    d = np.diff(y, prepend=np.nan)
    lag = lambda k: np.concatenate([np.full(k, np.nan), d[:-k]])
    long = np.column_stack([lag(1), lag(2), lag(12)])
    at = np.arange(13, len(y))  # t = 14..n
    g = np.linalg.lstsq(long[at], d[at], rcond=None)[0]
    e = np.full(len(y), np.nan)
    e[at] = d[at] - long[at] @ g
    short = np.column_stack([lag(1), lag(12), np.concatenate([[np.nan], e[:-1]])])
    at = at[1:]
    a, b, c = np.linalg.lstsq(short[at], d[at], rcond=None)[0]
    levels = list(y)
    for step in range(h):
        levels.append(levels[-1] + a * (levels[-1] - levels[-2]) + b * (levels[-12] - levels[-13]) + (c * e[len(y) - 1] if step == 0 else 0))
    return levels[len(y):]


def _changepoints_by_numpy(x, y, h):
    def terms(x):
        share = (x - x0) / (x1 - x0)
        waves = [f(2 * np.pi * k * x / 12) for k in range(1, forecast.WAVES + 1) for f in (np.sin, np.cos)]
        return np.column_stack([np.ones_like(share), share, *[np.maximum(share - c, 0) for c in forecast.CHANGEPOINTS], *waves])

    x0, x1 = x[0], x[-1]
    z = terms(x)
    fit = np.linalg.solve(z.T @ z + np.diag(forecast._RIDGES), z.T @ y)
    return terms(np.arange(x1 + 1, x1 + 1 + h)) @ fit


def test_models_by_name_equal_numpy(spark):
    rng = np.random.default_rng(8)
    series = {}
    for i, n in enumerate((24, 25, 40, 90)):
        t = np.arange(n)
        y = 100 + 3 * t + 20 * np.sin(t / 2) - 4 * np.maximum(0, t - n / 2) + rng.normal(0, 5, n).cumsum()
        series[f"s{i}"] = (_months(n, i), y)
    history = _frame(spark, series)
    for model in ("seasonal_arma", "trend_changepoints"):
        got = {}
        for r in forecast.forecast_with(history, model, 14).orderBy("horizon_step").collect():
            got.setdefault(r.series_id, []).append(r.forecast_value)
        for name, (days, y) in series.items():
            x = np.array([12.0 * d.year + d.month for d in days])
            want = _arma_by_numpy(y, 14) if model == "seasonal_arma" else _changepoints_by_numpy(x, y, 14)
            np.testing.assert_allclose(got[name], want, rtol=1e-6, err_msg=f"{model} {name}")


def test_a_changed_slope_and_a_shock_are_followed(spark):
    t = np.arange(60.0)
    bent = np.where(t < 36, 10 * t, 360 + 2 * (t - 36))
    history = _frame(spark, {"bent": (_months(60), bent)})
    line, bend = (
        [r.forecast_value for r in forecast.forecast_with(history, m, 6).orderBy("horizon_step").collect()]
        for m in ("trend_seasonal", "trend_changepoints")
    )
    truth = 360 + 2 * (np.arange(60, 66) - 36)
    assert np.abs(bend - truth).mean() < 0.5 * np.abs(line - truth).mean()


def test_models_by_name_say_why_they_are_not_fitted(spark):
    history = _frame(spark, {"flat": (_months(40), [5.0] * 40), "short": (_months(20), range(20)), "one_day": (_months(1) * 30, range(30))})
    views = forecast.backtest(history, horizon=2, min_train=10, models=["seasonal_arma", "trend_changepoints"])
    reasons = {(r.series_id, r.model): r.reason for r in views.skipped.collect()}
    assert reasons["flat", "seasonal_arma"] == "singular_fit"
    assert reasons["short", "trend_changepoints"] == "series too short for seasonal baseline"
    assert reasons["one_day", "trend_changepoints"] == "singular_fit"
    flat = views.future.filter("series_id = 'flat' AND model = 'trend_changepoints'").collect()
    assert [round(r.forecast_value, 6) for r in flat] == [5.0, 5.0]


def test_standard_models_are_four(spark):
    assert forecast.STANDARD_MODELS == ["naive", "moving_average", "seasonal_ar", "trend_seasonal"]
    history = _frame(spark, {"s": (_months(40), noisy(40))})
    assert {r.model for r in forecast.backtest(history).metrics.collect()} == set(forecast.STANDARD_MODELS)
