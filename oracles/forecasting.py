"""Forecasters, backtest, selection and the frozen operational forecast."""

from __future__ import annotations

from oracles.blocks import BLOCKS, HEADS

FORECASTING: dict[str, str] = {}

_CONTEXT = "level, series_id, mineral, departamento, unidad"

BLOCKS["hist"] = """
  SELECT level, series_id, mineral, departamento, unidad, period_date, target_value AS y,
         12 * year(period_date) + month(period_date) AS x, month(period_date) AS m,
         row_number() OVER s AS rn, count(*) OVER (PARTITION BY level, series_id) AS n_rows,
         target_value - lag(target_value, 1) OVER s AS d0,
         lag(target_value, 1) OVER s - lag(target_value, 2) OVER s AS d1,
         lag(target_value, 2) OVER s - lag(target_value, 3) OVER s AS d2,
         lag(target_value, 12) OVER s - lag(target_value, 13) OVER s AS d12
  FROM targets WHERE target_value IS NOT NULL
  WINDOW s AS (PARTITION BY level, series_id ORDER BY period_date)"""

# Each series twice: fitted without its last three rows, and on all of them.
BLOCKS["train"] = """
  SELECT hist.*, holdout, n_rows - holdout AS train_rows
  FROM hist CROSS JOIN (VALUES (3), (0)) cuts(holdout) WHERE rn <= n_rows - holdout"""
BLOCKS["fit"] = f"""
  SELECT {_CONTEXT}, holdout, n_rows, train_rows, max(period_date) AS last_period, max(x) AS last_x,
         list(y ORDER BY rn) FILTER (WHERE rn > train_rows - 13) AS tail,
         avg(y) FILTER (WHERE rn > train_rows - 3) AS recent_mean,
         sum(d1 * d1) FILTER (WHERE rn >= 14) AS s11, sum(d12 * d12) FILTER (WHERE rn >= 14) AS s22,
         sum(d1 * d12) FILTER (WHERE rn >= 14) AS s12, sum(d1 * d0) FILTER (WHERE rn >= 14) AS s1,
         sum(d12 * d0) FILTER (WHERE rn >= 14) AS s2,
         regr_slope(y, x) AS slope, regr_intercept(y, x) AS intercept
  FROM train GROUP BY {_CONTEXT}, holdout, n_rows, train_rows"""
BLOCKS["season"] = """
  SELECT level, series_id, holdout, m, avg(y - intercept - slope * x) AS e
  FROM train JOIN fit USING (level, series_id, holdout) GROUP BY level, series_id, holdout, m"""
BLOCKS["solved"] = """
  SELECT level, series_id, holdout, tail, (s1 * s22 - s2 * s12) / (s11 * s22 - s12 * s12) AS a,
         (s2 * s11 - s1 * s12) / (s11 * s22 - s12 * s12) AS b
  FROM fit WHERE train_rows >= 24 AND s11 * s22 - s12 * s12 > 1e-12 * s11 * s22"""
HEADS["ar_path"] = "ar_path(level, series_id, holdout, a, b, step, levels)"
BLOCKS["ar_path"] = """
  SELECT level, series_id, holdout, a, b, 0, tail FROM solved
  UNION ALL
  SELECT level, series_id, holdout, a, b, step + 1,
         list_append(levels, levels[-1] + a * (levels[-1] - levels[-2]) + b * (levels[-12] - levels[-13]))
  FROM ar_path WHERE step < 40"""
BLOCKS["paths"] = """
  SELECT level, series_id, holdout, 'naive' AS model, 0 AS ordinal, step, tail[-1] AS y_pred
  FROM fit CROSS JOIN range(1, 41) r(step)
  UNION ALL SELECT level, series_id, holdout, 'moving_average', 1, step, recent_mean
  FROM fit CROSS JOIN range(1, 41) r(step)
  UNION ALL SELECT level, series_id, holdout, 'seasonal_ar', 2, step, levels[-1] FROM ar_path WHERE step > 0
  UNION ALL SELECT f.level, f.series_id, f.holdout, 'trend_seasonal', 3, step,
         intercept + slope * (last_x + step) + coalesce(e, 0)
  FROM fit f CROSS JOIN range(1, 41) r(step)
  LEFT JOIN season s ON s.level = f.level AND s.series_id = f.series_id AND s.holdout = f.holdout
       AND s.m = (f.last_x + step - 1) % 12 + 1"""

# Least squares by elimination: the rows of [moments | targets] are swept one unknown at a time.
def _swept(matrix: str, n: int) -> str:
    return f"""list_transform(list_reduce(range(1, {n + 1}), lambda m, i: list_transform(m, lambda row, r:
      CASE WHEN r = i THEN list_transform(row, lambda v: v / m[i][i])
           ELSE list_transform(row, lambda v, c: v - m[r][i] / m[i][i] * m[i][c]) END), {matrix}), lambda row: row[{n + 1}])"""


def _moments(terms: list[str], target: str, ridges: list[float]) -> str:
    rows = []
    for i, a in enumerate(terms):
        cells = [f"sum({a} * {b})" + (f" + {ridges[i]}" if i == j else "") for j, b in enumerate(terms)]
        rows.append(f"[{', '.join(cells)}, sum({a} * {target})]")
    return f"[{', '.join(rows)}]"


_FIT_KEYS = "level, series_id, holdout"
BLOCKS["long_ar"] = f"""
  SELECT {_FIT_KEYS}, {_swept("mm", 3)} AS g FROM (
    SELECT {_FIT_KEYS}, {_moments(["d1", "d2", "d12"], "d0", [0, 0, 0])} AS mm
    FROM train WHERE rn >= 14 GROUP BY {_FIT_KEYS})"""
BLOCKS["residuals_e"] = f"""
  SELECT {_FIT_KEYS}, rn, d0, d1, d12, e0, lag(e0) OVER (PARTITION BY {_FIT_KEYS} ORDER BY rn) AS e1
  FROM (SELECT {_FIT_KEYS}, rn, d0, d1, d12, CASE WHEN rn >= 14 THEN d0 - g[1] * d1 - g[2] * d2 - g[3] * d12 END AS e0
        FROM train JOIN long_ar USING ({_FIT_KEYS}))"""
BLOCKS["arma"] = f"""
  SELECT {_FIT_KEYS}, {_swept("mm", 3)} AS g, e_last FROM (
    SELECT {_FIT_KEYS}, {_moments(["d1", "d12", "e1"], "d0", [0, 0, 0])} AS mm, arg_max(e0, rn) AS e_last
    FROM residuals_e WHERE rn >= 15 GROUP BY {_FIT_KEYS})"""
HEADS["arma_path"] = "arma_path(level, series_id, holdout, g, e, step, levels)"
BLOCKS["arma_path"] = f"""
  SELECT level, series_id, holdout, g, e_last, 0, tail FROM arma JOIN fit USING ({_FIT_KEYS}) WHERE train_rows >= 24
  UNION ALL
  SELECT level, series_id, holdout, g, 0.0, step + 1,
         list_append(levels, levels[-1] + g[1] * (levels[-1] - levels[-2]) + g[2] * (levels[-12] - levels[-13]) + g[3] * e)
  FROM arma_path WHERE step < 12"""


def _span_terms(share: str, x: str) -> list[str]:
    waves = [f"{f}(2 * pi() * {k} * ({x}) / 12)" for k in (1, 2) for f in ("sin", "cos")]
    return ["1.0", f"({share})", *[f"greatest(({share}) - {c}, 0.0)" for c in (0.2, 0.4, 0.6, 0.8)], *waves]


_Z = [f"z[{i}]" for i in range(1, 11)]
BLOCKS["span_rows"] = f"""
  SELECT *, [{', '.join(_span_terms("share", "x"))}] AS z
  FROM (SELECT *, (x - min(x) OVER s)::DOUBLE / (max(x) OVER s - min(x) OVER s) AS share, min(x) OVER s AS x_first
        FROM train WINDOW s AS (PARTITION BY {_FIT_KEYS}))"""
BLOCKS["span_fit"] = f"""
  SELECT {_FIT_KEYS}, x_first, x_last, {_swept("mm", 10)} AS g FROM (
    SELECT {_FIT_KEYS}, min(x_first) AS x_first, max(x) AS x_last,
           {_moments(_Z, "y", [0, 0] + [0.1] * 8)} AS mm
    FROM span_rows WHERE train_rows >= 24 GROUP BY {_FIT_KEYS})"""
BLOCKS["all_paths"] = f"""
  SELECT level, series_id, holdout, model, step, y_pred FROM paths WHERE step <= 12
  UNION ALL SELECT level, series_id, holdout, 'seasonal_arma', step, levels[-1] FROM arma_path WHERE step > 0
  UNION ALL SELECT level, series_id, holdout, 'trend_changepoints', step,
    list_sum(list_transform(list_zip(g, [{', '.join(_span_terms("(x_last + step - x_first)::DOUBLE / (x_last - x_first)", "x_last + step"))}]),
             lambda p: p[1] * p[2]))
  FROM span_fit CROSS JOIN range(1, 13) r(step)"""


def _by_name(model: str) -> str:
    return f"""
SELECT {_CONTEXT}, CAST(step AS INTEGER) AS horizon_step,
       CAST(last_period + to_months(CAST(step AS INTEGER)) AS DATE) AS forecast_period_date,
       round(y_pred, 3) AS forecast_value
FROM all_paths JOIN fit USING ({_FIT_KEYS}) WHERE holdout = 0 AND model = '{model}'"""


FORECASTING["forecast_seasonal_arma"] = _by_name("seasonal_arma")
FORECASTING["forecast_trend_changepoints"] = _by_name("trend_changepoints")
FORECASTING["leaderboard_of_all_models"] = """
SELECT level, model, count(DISTINCT series_id) AS n_series, round(avg(mae), 3) AS mae_mean, round(avg(rmse), 3) AS rmse_mean,
       round(avg(mape), 3) AS mape_mean, round(avg(smape), 3) AS smape_mean
FROM (SELECT p.level, p.series_id, model, avg(abs(y - y_pred)) AS mae, sqrt(avg((y - y_pred) * (y - y_pred))) AS rmse,
             avg(abs(y - y_pred) / abs(y)) FILTER (WHERE y <> 0) * 100 AS mape,
             avg(2 * abs(y - y_pred) / (abs(y) + abs(y_pred))) FILTER (WHERE abs(y) + abs(y_pred) <> 0) * 100 AS smape
      FROM all_paths p JOIN fit USING (level, series_id, holdout)
           JOIN hist h ON h.level = p.level AND h.series_id = p.series_id AND h.rn = train_rows + step
      WHERE holdout = 3 AND step <= 3 AND fit.n_rows >= 27 GROUP BY ALL)
GROUP BY level, model"""

FORECASTING["train_test_split"] = """
SELECT level, series_id, period_date, y AS target_value,
       CASE WHEN rn > n_rows - 3 THEN 'test' ELSE 'train' END AS split
FROM hist WHERE n_rows >= 27"""


def _single(model: str, horizon: int, digits: int) -> str:
    return f"""
SELECT {_CONTEXT}, CAST(step AS INTEGER) AS horizon_step,
       CAST(last_period + to_months(CAST(step AS INTEGER)) AS DATE) AS forecast_period_date,
       round(y_pred, {digits}) AS forecast_value
FROM paths JOIN fit USING (level, series_id, holdout)
WHERE holdout = 0 AND model = '{model}' AND step <= {horizon}"""


FORECASTING["forecast_naive"] = _single("naive", 3, 6)
FORECASTING["forecast_moving_average"] = _single("moving_average", 3, 6)
FORECASTING["forecast_seasonal_ar"] = _single("seasonal_ar", 12, 4)
FORECASTING["forecast_trend_seasonal"] = _single("trend_seasonal", 12, 4)

BLOCKS["preds"] = """
  SELECT h.level, h.series_id, h.mineral, h.departamento, h.unidad, model, ordinal,
         CAST(train_rows AS INTEGER) AS train_rows, 3 AS test_rows, last_period AS train_last_period,
         CAST(step AS INTEGER) AS horizon_step, h.period_date, y AS y_true, y_pred, abs(y - y_pred) AS abs_error
  FROM paths JOIN fit USING (level, series_id, holdout)
       JOIN hist h ON h.level = paths.level AND h.series_id = paths.series_id AND h.rn = train_rows + step
  WHERE holdout = 3 AND step <= 3 AND fit.n_rows >= 27"""
BLOCKS["series_metrics"] = f"""
  SELECT {_CONTEXT}, model, ordinal, train_rows, test_rows, train_last_period, avg(abs_error) AS mae,
         sqrt(avg(abs_error * abs_error)) AS rmse,
         avg(abs_error / abs(y_true)) FILTER (WHERE y_true <> 0) * 100 AS mape,
         avg(2 * abs_error / (abs(y_true) + abs(y_pred))) FILTER (WHERE abs(y_true) + abs(y_pred) <> 0) * 100
           AS smape
  FROM preds GROUP BY ALL"""
BLOCKS["board"] = """
  SELECT level, model, count(DISTINCT series_id) AS n_series, avg(mae) AS mae_mean, avg(rmse) AS rmse_mean,
         avg(mape) AS mape_mean, avg(smape) AS smape_mean
  FROM series_metrics GROUP BY level, model"""
BLOCKS["level_best"] = """
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY level
      ORDER BY mae_mean NULLS LAST, rmse_mean NULLS LAST, model) AS place FROM board) WHERE place = 1"""

_MEANS = ", ".join(f"round({m}_mean, 4) AS {m}_mean" for m in ("mae", "rmse", "mape", "smape"))
FORECASTING["backtest_predictions"] = """
SELECT * EXCLUDE (ordinal) REPLACE (round(y_pred, 4) AS y_pred, round(abs_error, 4) AS abs_error) FROM preds"""
FORECASTING["backtest_metrics"] = """
SELECT * EXCLUDE (ordinal) REPLACE (round(mae, 4) AS mae, round(rmse, 4) AS rmse, round(mape, 4) AS mape,
       round(smape, 4) AS smape) FROM series_metrics"""
FORECASTING["leaderboard"] = f"SELECT level, model, n_series, {_MEANS} FROM board"
FORECASTING["best_by_level"] = f"SELECT level, model AS best_model_by_mae, {_MEANS} FROM level_best"
BLOCKS["futures"] = f"""
  SELECT {_CONTEXT}, p.model, CAST(step AS INTEGER) AS horizon_step,
         CAST(last_period + to_months(CAST(step AS INTEGER)) AS DATE) AS forecast_period_date,
         round(y_pred, 4) AS forecast_value, last_period AS train_last_period
  FROM paths p JOIN fit USING (level, series_id, holdout)
  WHERE holdout = 0 AND step <= 3 AND n_rows >= 27
    AND EXISTS (SELECT 1 FROM preds q WHERE q.level = p.level AND q.series_id = p.series_id AND q.model = p.model)"""
FORECASTING["future_forecasts"] = "SELECT * FROM futures"
# Every model fits every series that is long enough on these tables, so only short ones are skipped.
FORECASTING["skipped_series"] = """
SELECT DISTINCT level, series_id, 'all' AS model, 'insufficient_history(len=' || n_rows || ')' AS reason
FROM hist WHERE n_rows < 83"""
# Of 83 months at most, 60 held out leave fewer than 24.
FORECASTING["skipped_models"] = """
SELECT DISTINCT level, series_id, 'all' AS model, 'insufficient_history(len=' || n_rows || ')' AS reason
FROM hist WHERE n_rows < 70
UNION ALL
SELECT DISTINCT level, series_id, 'seasonal_ar', 'series too short for seasonal baseline'
FROM hist WHERE n_rows >= 70 AND n_rows - 60 < 24"""
FORECASTING["forecast_report"] = """
SELECT level, 'predictions' AS measure, count(*) AS n FROM preds GROUP BY level
UNION ALL SELECT level, 'series_metrics', count(*) FROM series_metrics GROUP BY level
UNION ALL SELECT level, 'future_forecasts', count(*) FROM futures GROUP BY level
UNION ALL SELECT level, 'skipped_rows', count(DISTINCT series_id) FROM hist WHERE n_rows < 27 GROUP BY level
UNION ALL SELECT level, 'series', count(DISTINCT series_id) FROM hist GROUP BY level"""

# ---------------------------------------------------------------------------- selection

BLOCKS["ranked"] = """
  SELECT *, row_number() OVER (PARTITION BY level, series_id ORDER BY mae, rmse, ordinal) AS place,
         row_number() OVER (PARTITION BY level, series_id, ordinal >= 2 ORDER BY mae, rmse, ordinal) AS kind_place
  FROM (SELECT * REPLACE (coalesce(mae, 'inf'::DOUBLE) AS mae, coalesce(rmse, 'inf'::DOUBLE) AS rmse)
        FROM series_metrics)"""
BLOCKS["dynamic_choice"] = """
  SELECT b.level, b.series_id,
         CASE WHEN b.ordinal < 2 AND d.mae <= b.mae * 1.1 THEN d.model ELSE b.model END AS series_model
  FROM ranked b LEFT JOIN ranked d
       ON d.level = b.level AND d.series_id = b.series_id AND d.ordinal >= 2 AND d.kind_place = 1
  WHERE b.place = 1"""
FORECASTING["select_level"] = "SELECT level, model AS level_model FROM level_best"
FORECASTING["select_series"] = "SELECT level, series_id, model AS series_model FROM ranked WHERE place = 1"
FORECASTING["select_series_dynamic"] = "SELECT * FROM dynamic_choice"

BLOCKS["pub_window"] = """
  SELECT CAST(date_trunc('month', max(l_shipdate)) + INTERVAL 278 MONTH AS DATE) AS w_start,
         CAST(date_trunc('month', max(l_shipdate)) + INTERVAL 288 MONTH AS DATE) AS w_end
  FROM lineitem"""


def _operational(choice: str, min_train: int = 24) -> str:
    """Every model fits on these tables, so the primary model is the one used."""
    return f"""
  SELECT {_CONTEXT}, model AS selected_model, last_period AS last_observed_period,
         CAST(last_period + to_months(CAST(step AS INTEGER)) AS DATE) AS forecast_period_date,
         strftime(last_period + to_months(CAST(step AS INTEGER)), '%Y-%m') AS forecast_period_yyyymm,
         y_pred AS forecast_value
  FROM fit JOIN ({choice}) USING (level, series_id) JOIN paths USING (level, series_id, holdout, model)
       CROSS JOIN pub_window
  WHERE holdout = 0 AND n_rows >= {min_train}
    AND last_period + to_months(CAST(step AS INTEGER)) BETWEEN w_start AND w_end"""


BLOCKS["frozen"] = _operational(
    """SELECT f.level, f.series_id, coalesce(series_model, l.model) AS model
       FROM (SELECT DISTINCT level, series_id FROM fit) f JOIN level_best l USING (level)
       LEFT JOIN dynamic_choice USING (level, series_id)"""
)
BLOCKS["frozen_level"] = _operational(
    """SELECT f.level, f.series_id, l.model FROM (SELECT DISTINCT level, series_id FROM fit) f
       JOIN level_best l USING (level)"""
)
FORECASTING["operational_forecast"] = (
    "SELECT * REPLACE (round(forecast_value, 4) AS forecast_value) FROM frozen"
)
FORECASTING["operational_forecast_by_level"] = (
    "SELECT * REPLACE (round(forecast_value, 4) AS forecast_value) FROM frozen_level"
)
FORECASTING["operational_skipped"] = """
SELECT DISTINCT level, series_id, l.model, 'insufficient_history(len=' || n_rows || ')' AS reason
FROM hist JOIN level_best l USING (level) WHERE n_rows < 82"""
# The publication window: two to twelve months after the last observed month.
_WINDOW_COLUMNS = ", ".join(f"'m_2025_{n:02}'" for n in range(1, 12))
FORECASTING["executive_pivot"] = f"""
SELECT * FROM (PIVOT (
    SELECT {_CONTEXT}, selected_model, last_observed_period, forecast_value,
           'm_' || replace(forecast_period_yyyymm, '-', '_') AS month
    FROM frozen)
  ON month IN ({_WINDOW_COLUMNS}) USING round(max(forecast_value), 4) GROUP BY {_CONTEXT}, selected_model, last_observed_period)"""
FORECASTING["model_usage"] = """
SELECT level, selected_model, count(DISTINCT series_id) AS series_count FROM frozen GROUP BY ALL"""
FORECASTING["series_coverage"] = """
SELECT l.level, count(DISTINCT series_id) AS series_count
FROM (VALUES ('nacional_mineral'), ('departamento_mineral')) l(level) LEFT JOIN frozen USING (level)
GROUP BY l.level"""
FORECASTING["staged_forecasts"] = "SELECT * REPLACE (round(forecast_value, 4) AS forecast_value) FROM frozen"
FORECASTING["operational_report"] = """
SELECT 'series_mae_dynamic' AS mode, 10.0::DOUBLE AS dynamic_tolerance_pct, w_start AS window_start, w_end AS window_end,
       11 AS window_months, (SELECT count(*) FROM frozen) AS operational_forecast,
       (SELECT count(DISTINCT level || series_id) FROM frozen) AS operational_executive,
       (SELECT count(*) FROM (SELECT DISTINCT level, series_id FROM hist WHERE n_rows < 24)) AS operational_skipped,
       (SELECT string_agg(level || ':' || model, ',' ORDER BY level) FROM level_best) AS selected_models,
       (SELECT string_agg(level || ':' || selected_model || ':' || n, ',' ORDER BY level, selected_model) FROM (
          SELECT level, selected_model, count(DISTINCT series_id) AS n FROM frozen GROUP BY ALL)) AS model_usage,
       (SELECT string_agg(level || ':' || n, ',' ORDER BY level) FROM (
          SELECT l.level, count(DISTINCT series_id) AS n
          FROM (VALUES ('nacional_mineral'), ('departamento_mineral')) l(level) LEFT JOIN frozen USING (level)
          GROUP BY l.level)) AS series_coverage
FROM pub_window"""
