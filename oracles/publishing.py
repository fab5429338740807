"""Load selection, documents, upserts and chart datasets."""

from __future__ import annotations

from oracles.blocks import BLOCKS
from oracles.facts import GAP_FLAG, _violations

PUBLISHING: dict[str, str] = {}

_NEWEST = "(SELECT max(period_yyyymm) FROM tidy)"
PUBLISHING["select_load_rows"] = f"""
SELECT period_yyyymm, count(*) AS n_rows, 'tidy' AS table_name FROM tidy
WHERE period_yyyymm = {_NEWEST} GROUP BY period_yyyymm
UNION ALL SELECT period_yyyymm, count(*), 'agg_mineral' FROM agg_m
WHERE period_yyyymm = {_NEWEST} GROUP BY period_yyyymm
UNION ALL SELECT period_yyyymm, count(*), 'agg_departamento' FROM agg_d
WHERE period_yyyymm = {_NEWEST} GROUP BY period_yyyymm"""

_OLD, _NOW = "TIMESTAMP '2025-01-01 00:00:00'", "TIMESTAMP '2025-02-01 00:00:00'"

_FIELDS = (
    "record_id period_yyyymm series_description mineral departamento unidad source_dataset metric_level"
    " area_geografica year month quarter semester value is_total_departamento is_missing is_invalid_numeric"
).split()


def _merged(batch: str, snapshot: str, field: str) -> str:
    return f"CASE WHEN {batch} IS NOT NULL THEN b.{field} ELSE o.{field} END AS {field}"


_STAMPS = f"""
       CASE WHEN o_in IS NULL THEN {_NOW} ELSE {_OLD} END AS ingested_at,
       CASE WHEN b_in IS NULL THEN {_OLD} ELSE {_NOW} END AS updated_at,
       CASE WHEN b_in IS NULL THEN 'kept' WHEN o_in IS NULL THEN 'inserted' ELSE 'matched' END AS write_status"""

BLOCKS["aged"] = """
  SELECT *, 12 * (SELECT year(max(period_date)) FROM tidy) + (SELECT month(max(period_date)) FROM tidy)
            - 12 * year - month AS age
  FROM tidy"""
BLOCKS["fact_merge"] = f"""
  SELECT period_date, series_code, {", ".join(_merged("b_in", "o_in", f) for f in _FIELDS)},
         'v1' AS schema_version, {_STAMPS}
  FROM (SELECT * REPLACE (floor(value / 10) * 10 AS value), 1 AS o_in FROM aged WHERE age >= 3) o
  FULL JOIN (SELECT *, 1 AS b_in FROM aged WHERE age < 6) b USING (period_date, series_code)"""
PUBLISHING["upsert_facts"] = "SELECT * FROM fact_merge"
PUBLISHING["upsert_facts_counters"] = """
SELECT count(*) FILTER (WHERE write_status <> 'kept') AS n_operations,
       count(*) FILTER (WHERE write_status = 'matched') AS matched_count,
       count(*) FILTER (WHERE write_status = 'matched') AS modified_count,
       count(*) FILTER (WHERE write_status = 'inserted') AS upserted_count
FROM fact_merge"""

PUBLISHING["versioned_facts"] = "SELECT * EXCLUDE (write_status) FROM fact_merge"
PUBLISHING["streamed_facts"] = f"""
SELECT period_date, series_code, {", ".join(_FIELDS)}, 'v1' AS schema_version, {_OLD} AS ingested_at, {_OLD} AS updated_at
FROM tidy"""

_ADOC = "period_date, period_yyyymm, year, month, quarter, semester, unidad"
BLOCKS["agg_docs"] = f"""
  SELECT 'mineral_period_unit|' || period_yyyymm || '|' || unidad || '|' || mineral AS aggregate_id,
         'mineral_period_unit' AS aggregation_level, {_ADOC}, mineral, NULL::VARCHAR AS departamento,
         dept_sum_value, CAST(n_departamentos AS INTEGER) AS n_departamentos, official_total_value,
         abs_gap_vs_total, round(pct_gap_vs_total, 6) AS pct_gap_vs_total, {GAP_FLAG} AS gap_quality_flag,
         'v1' AS schema_version, NULL::DOUBLE AS dept_unit_sum_value, NULL::INTEGER AS n_minerales
  FROM agg_m
  UNION ALL
  SELECT 'departamento_period_unit|' || period_yyyymm || '|' || unidad || '|' || departamento,
         'departamento_period_unit', {_ADOC}, NULL, departamento, NULL, NULL, NULL, NULL, NULL, NULL, 'v1',
         dept_unit_sum_value, CAST(n_minerales AS INTEGER)
  FROM agg_d"""
PUBLISHING["upsert_aggregates"] = f"""
SELECT aggregate_id, aggregation_level, {_ADOC}, mineral, departamento, dept_sum_value,
       -- the second load carries no counts: new rows have none
       CASE WHEN age >= 3 THEN n_departamentos END AS n_departamentos, official_total_value, abs_gap_vs_total,
       pct_gap_vs_total, gap_quality_flag, schema_version, dept_unit_sum_value,
       CASE WHEN age >= 3 THEN n_minerales END AS n_minerales,
       CASE WHEN age >= 3 THEN {_OLD} ELSE {_NOW} END AS ingested_at,
       CASE WHEN age >= 6 THEN {_OLD} ELSE {_NOW} END AS updated_at,
       CASE WHEN age >= 6 THEN 'kept' WHEN age >= 3 THEN 'matched' ELSE 'inserted' END AS write_status
FROM (SELECT *, 12 * (SELECT year(max(period_date)) FROM agg_docs) + (SELECT month(max(period_date)) FROM agg_docs)
                - 12 * year - month AS age FROM agg_docs)"""

PUBLISHING["versioned_aggregates"] = f"""
SELECT * EXCLUDE (write_status) FROM ({PUBLISHING["upsert_aggregates"].strip()})"""

BLOCKS["docs"] = """
  SELECT selected_model || '|' || level || '|' || series_id || '|' ||
           strftime(min(forecast_period_date), '%Y-%m') || '|' || strftime(max(forecast_period_date), '%Y-%m')
           AS prediction_id,
         selected_model AS model, level, series_id,
         arg_min(mineral, forecast_period_date) AS mineral,
         arg_min(departamento, forecast_period_date) AS departamento,
         arg_min(unidad, forecast_period_date) AS unidad,
         arg_min(last_observed_period, forecast_period_date) AS last_observed_period,
         min(forecast_period_date) AS forecast_window_start, max(forecast_period_date) AS forecast_window_end,
         CAST(count(*) AS INTEGER) AS forecast_window_months, 'v1' AS schema_version,
         string_agg(forecast_period_yyyymm || ':' || printf('%.3f', forecast_value), ';'
                    ORDER BY forecast_period_date) AS points,
         CAST(count(*) AS INTEGER) AS n_points, round(min(forecast_value), 4) AS min_value,
         round(max(forecast_value), 4) AS max_value, round(avg(forecast_value), 4) AS mean_value,
         max(forecast_value) - min(forecast_value) <= 1e-12 AS is_flat_forecast,
         'fase8_operational' AS source_phase, 'series_mae_dynamic' AS source_selection_mode
  FROM frozen GROUP BY selected_model, level, series_id"""
PUBLISHING["prediction_documents"] = "SELECT * FROM docs"
PUBLISHING["document_lineage"] = """
SELECT prediction_id, n_points, 'fase8_operational' AS phase, 'series_mae_dynamic' AS selection_mode,
       10.0::DOUBLE AS dynamic_tolerance_pct
FROM docs"""
PUBLISHING["prediction_doc_summary"] = """
SELECT model, count(*) AS documents, count(*) FILTER (WHERE is_flat_forecast) AS flat_documents
FROM docs GROUP BY model"""
PUBLISHING["upsert_predictions"] = f"""
SELECT prediction_id, model, level, series_id, forecast_window_start, forecast_window_end, forecast_window_months,
       CASE WHEN o_in THEN {_OLD} ELSE {_NOW} END AS ingested_at,
       CASE WHEN b_in THEN {_NOW} ELSE {_OLD} END AS updated_at,
       CASE WHEN NOT b_in THEN 'kept' WHEN o_in THEN 'matched' ELSE 'inserted' END AS write_status
FROM (SELECT *, level = 'departamento_mineral' AS o_in,
             level = 'nacional_mineral' OR mineral LIKE '%1' AS b_in FROM docs)
WHERE o_in OR b_in"""
_REQUIRED = (
    "model level series_id forecast_window_start forecast_window_end forecast_window_months points"
    " schema_version"
).split()
PUBLISHING["prediction_contract_violations"] = _violations(
    "predictions",
    "docs",
    [(f if f != "points" else "forecasts", "required", "false") for f in _REQUIRED]
    + [(f if f != "points" else "forecasts", "type", f"{f} IS NULL") for f in _REQUIRED]
    + [("source", "type", "false")]
    + [
        (f"forecasts.{f}", "type", "false")
        for f in ("forecast_period_date", "forecast_period_yyyymm", "forecast_value")
    ],
)

# ------------------------------------------------------------------------------- charts

BLOCKS["picked"] = """
  SELECT series_id, arg_min(selected_model, forecast_period_date) AS model,
         arg_min(departamento, forecast_period_date) AS departamento
  FROM frozen WHERE level = 'departamento_mineral' GROUP BY series_id
  ORDER BY sum(forecast_value) DESC, series_id LIMIT 1"""
PUBLISHING["history_and_forecast"] = """
SELECT 'history' AS kind, series_id, period_date AS date, round(y, 4) AS value
FROM hist JOIN picked USING (series_id) WHERE level = 'departamento_mineral'
UNION ALL
SELECT 'forecast', series_id, forecast_period_date, round(forecast_value, 4)
FROM frozen JOIN picked USING (series_id) WHERE level = 'departamento_mineral'"""
BLOCKS["evaluation"] = """
  SELECT series_id, model, period_date AS date, y_true AS actual, y_pred AS predicted
  FROM preds JOIN picked USING (series_id, model) WHERE level = 'departamento_mineral'"""
PUBLISHING["residuals"] = """
SELECT series_id, model, date, actual, round(predicted, 4) AS predicted,
       round(actual - predicted, 4) AS residual FROM evaluation"""
PUBLISHING["smoothed_trend"] = """
SELECT series_id, model, date, actual, round(predicted, 4) AS predicted,
       round(avg(actual) OVER w, 4) AS actual_trend, round(avg(evaluation.predicted) OVER w, 4) AS predicted_trend
FROM evaluation WINDOW w AS (ORDER BY date ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)"""


def _lines(condition: str, n: int) -> str:
    return f"""
SELECT forecast_period_date AS date, mineral AS category, round(forecast_value, 4) AS value
FROM frozen WHERE {condition} AND mineral IN (
  SELECT mineral FROM frozen WHERE {condition} GROUP BY mineral ORDER BY sum(forecast_value) DESC, mineral LIMIT {n})"""


PUBLISHING["category_lines"] = _lines("departamento = (SELECT departamento FROM picked)", 6)
PUBLISHING["category_lines_national"] = _lines("level = 'nacional_mineral'", 4)
