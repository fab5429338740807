"""Facts, aggregates, quality rules, exploration and features."""

from __future__ import annotations

from oracles.blocks import BLOCKS

FACTS: dict[str, str] = {}

GAP_FLAG = """CASE WHEN abs(pct_gap_vs_total) <= 1 THEN 'ok' WHEN abs(pct_gap_vs_total) <= 5 THEN 'warning'
              ELSE 'critical' END"""

FACTS["tidy_observations"] = "SELECT * FROM tidy"
FACTS["agg_mineral_period"] = "SELECT * REPLACE (round(pct_gap_vs_total, 6) AS pct_gap_vs_total) FROM agg_m"
FACTS["agg_departamento_period"] = "SELECT * FROM agg_d"
FACTS["gap_quality"] = f"""
SELECT * REPLACE (round(pct_gap_vs_total, 6) AS pct_gap_vs_total),
       round(abs(pct_gap_vs_total), 6) AS abs_pct_gap, {GAP_FLAG} AS gap_quality_flag
FROM agg_m"""
BLOCKS["flag_counts"] = f"""
  SELECT count(*) FILTER (WHERE f = 'ok') AS ok, count(*) FILTER (WHERE f = 'warning') AS warning,
         count(*) FILTER (WHERE f = 'critical') AS critical
  FROM (SELECT {GAP_FLAG} AS f FROM agg_m)"""
FACTS["gap_flag_counts"] = "SELECT * FROM flag_counts"
FACTS["transform_report"] = """
SELECT count(*) AS rows_tidy, count(DISTINCT period_date) AS unique_periods,
       count(DISTINCT mineral) AS unique_minerales, count(DISTINCT departamento) AS unique_departamentos,
       string_agg(DISTINCT unidad, ',' ORDER BY unidad) AS units_detected,
       (SELECT count(*) FROM agg_m) AS rows_agg_mineral_period,
       (SELECT count(*) FROM agg_d) AS rows_agg_departamento_period,
       min(period_date) AS period_min, max(period_date) AS period_max
FROM tidy"""
FACTS["domain_values"] = """
SELECT 'mineral' AS field, mineral AS value, count(*) AS n_rows FROM tidy GROUP BY mineral
UNION ALL SELECT 'departamento', departamento, count(*) FROM tidy GROUP BY departamento
UNION ALL SELECT 'unidad', unidad, count(*) FROM tidy GROUP BY unidad"""

# ------------------------------------------------------------------------------ quality

# Rule id -> description.
_RULE_TEXT = {
    "R01": "Columns match expected schema",
    "R02": "Dataset has at least one row",
    "R03": "Mandatory columns have no nulls",
    "R04": "period_date is valid datetime",
    "R05": "year/month are consistent with period_date",
    "R06": "month value is between 1 and 12",
    "R07": "value is numeric and non-negative",
    "R08": "Primary key (period_date, series_code) is unique",
    "R09": "unidad belongs to allowed domain",
    "R10": "Base dataset has no rows flagged as missing or invalid numeric",
}
# The columns that may not be NULL.
_MANDATORY = [
    "source_dataset",
    "period_raw",
    "period_date",
    "year",
    "month",
    "series_code",
    "series_description",
    "mineral",
    "departamento",
    "unidad",
    "value",
]


def _rule(rule: str, passed: str, detail: str, source: str = "") -> str:
    text = _RULE_TEXT[rule].replace("'", "''")
    return (
        f"SELECT '{rule}' AS rule_id, '{text}' AS description, "
        f"CASE WHEN {passed} THEN 'PASS' ELSE 'FAIL' END AS status, {detail} AS detail {source}"
    )


def rules_sql(table: str) -> str:
    nulls = {c: f"(SELECT count(*) FILTER (WHERE {c} IS NULL) FROM {table})" for c in _MANDATORY}
    detail = " || ', ' || ".join(f"'\"{c}\": ' || {n}" for c, n in nulls.items())
    no_nulls = " AND ".join(f"{n} = 0" for n in nulls.values())

    def bad(condition: str) -> str:
        return f"(SELECT count(*) FILTER (WHERE NOT coalesce({condition}, false)) FROM {table})"

    date, ym = bad("period_date IS NOT NULL"), bad("year(period_date) = year AND month(period_date) = month")
    month, nan = bad("month BETWEEN 1 AND 12"), bad("value IS NOT NULL")
    negative = f"(SELECT count(*) FILTER (WHERE value < 0) FROM {table})"
    surplus = f"""(SELECT coalesce(sum(n - 1), 0)::BIGINT FROM
        (SELECT count(*) AS n FROM {table} GROUP BY period_date, series_code))"""
    units = f"(SELECT count(DISTINCT unidad) FILTER (WHERE unidad NOT IN ('tm.f','kg.f','grs.f')) FROM {table})"
    missing = f"(SELECT count(*) FILTER (WHERE is_missing) FROM {table})"
    invalid = f"(SELECT count(*) FILTER (WHERE is_invalid_numeric) FROM {table})"
    rows = f"(SELECT count(*) FROM {table})"
    return "\nUNION ALL ".join(
        [
            _rule("R01", "true", "'missing=[] extra=[]'"),
            _rule("R02", f"{rows} > 0", f"'rows=' || {rows}"),
            _rule("R03", no_nulls, f"'{{' || {detail} || '}}'"),
            _rule("R04", f"{date} = 0", f"'invalid_period_date=' || {date}"),
            _rule("R05", f"{ym} = 0", f"'inconsistent_rows=' || {ym}"),
            _rule("R06", f"{month} = 0", f"'invalid_month_rows=' || {month}"),
            _rule(
                "R07", f"{nan} = 0 AND {negative} = 0", f"'nan_values=' || {nan} || ' negative_values=' || {negative}"
            ),
            _rule("R08", f"{surplus} = 0", f"'duplicate_keys=' || {surplus}"),
            _rule("R09", f"{units} = 0", f"'invalid_units=' || {units}"),
            _rule(
                "R10",
                f"{missing} = 0 AND {invalid} = 0",
                f"'is_missing_true=' || {missing} || ' is_invalid_numeric_true=' || {invalid}",
            ),
        ]
    )


FACTS["validation_rules"] = rules_sql("faulty")
FACTS["validation_failures"] = f"SELECT * FROM ({rules_sql('faulty')}) WHERE status = 'FAIL'"
FACTS["validation_verdict"] = f"""
SELECT count(*) AS n_rules, count(*) FILTER (WHERE status = 'FAIL') AS n_failed,
       CASE WHEN bool_and(status = 'PASS') THEN 'PASS' ELSE 'FAIL' END AS overall_status
FROM ({rules_sql('obs')})"""
FACTS["validation_column_difference"] = "\nUNION ALL ".join(
    [
        _rule("R01", "false", "'missing=[''unidad'', ''value_raw''] extra=[''unit'']'"),
        _rule("R02", "(SELECT count(*) FROM obs) > 0", "'rows=' || (SELECT count(*) FROM obs)"),
    ]
)
FACTS["duplicate_keys"] = """
SELECT period_date, series_code, count(*) AS n_rows FROM faulty GROUP BY ALL HAVING count(*) > 1"""
FACTS["invalid_units"] = """
SELECT unidad, count(*) AS n_rows FROM faulty WHERE unidad NOT IN ('tm.f','kg.f','grs.f') GROUP BY ALL"""


def _violations(collection: str, source: str, checks: list[tuple[str, str, str]]) -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{collection}' AS collection, '{field}' AS field, '{rule}' AS rule, "
        f"count(*) FILTER (WHERE {broken}) AS n_violations FROM {source}"
        for field, rule, broken in checks
    )


_FACT_FIELDS = "period_date period_yyyymm year month series_code mineral departamento unidad value".split()
_AGG_FIELDS = "period_date period_yyyymm year month unidad".split()
BLOCKS["faulty_docs"] = "SELECT * FROM faulty_tidy WHERE period_date IS NOT NULL AND series_code IS NOT NULL"
BLOCKS["faulty_agg_docs"] = f"""
  SELECT period_date, period_yyyymm, year, month, unidad, {GAP_FLAG} AS gap_quality_flag FROM faulty_agg_m
  UNION ALL SELECT period_date, period_yyyymm, year, month, unidad, NULL FROM faulty_agg_d"""
FACTS["contract_violations"] = (
    _violations(
        "facts",
        "faulty_docs",
        [(f, "required", "false") for f in [*_FACT_FIELDS, "schema_version"]]
        + [(f, "type", f"{f} IS NULL") for f in _FACT_FIELDS]
        + [("schema_version", "type", "false")],
    )
    + "\nUNION ALL "
    + _violations(
        "aggregates",
        "faulty_agg_docs",
        [(f, "required", "false") for f in ["aggregation_level", *_AGG_FIELDS, "schema_version"]]
        + [(f, "type", f"{f} IS NULL") for f in _AGG_FIELDS]
        + [("schema_version", "type", "false"), ("gap_quality_flag", "type", "false")]
        + [("aggregation_level", "enum", "false")]
        + [("gap_quality_flag", "enum", "gap_quality_flag NOT IN ('ok','warning','critical')")],
    )
)

# -------------------------------------------------------------------------- exploration

BLOCKS["unit_totals"] = """
  SELECT mineral, unidad, coalesce(sum(value), 0) AS total_value
  FROM tidy WHERE is_total_departamento GROUP BY mineral, unidad"""
BLOCKS["dept_totals"] = """
  SELECT departamento, coalesce(sum(value), 0) AS total_value
  FROM tidy WHERE NOT is_total_departamento AND unidad = 'tm.f' GROUP BY departamento"""
BLOCKS["gap_means"] = """
  SELECT mineral, avg(abs(pct_gap_vs_total)) AS avg_abs_pct_gap FROM agg_m GROUP BY mineral"""
BLOCKS["outliers"] = """
  SELECT mineral, unidad, n_values, q1, q3, q1 - 1.5 * (q3 - q1) AS lower_bound,
         q3 + 1.5 * (q3 - q1) AS upper_bound,
         CAST(count(*) FILTER (WHERE value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1)) AS BIGINT)
           AS n_outliers
  FROM tidy JOIN (SELECT mineral, unidad, count(value) AS n_values, quantile_cont(value, 0.25) AS q1,
                         quantile_cont(value, 0.75) AS q3
                  FROM tidy WHERE NOT is_total_departamento GROUP BY mineral, unidad)
       USING (mineral, unidad)
  WHERE NOT is_total_departamento
  GROUP BY ALL"""
BLOCKS["sig_mineral"] = """
  SELECT mineral || ' (' || unidad || ')' AS label, total_value AS value
  FROM unit_totals ORDER BY total_value DESC, mineral, unidad LIMIT 1"""
BLOCKS["sig_dept"] = """
  SELECT departamento AS label, total_value AS value FROM dept_totals
  ORDER BY total_value DESC, departamento LIMIT 1"""
BLOCKS["sig_gap"] = """
  SELECT mineral AS label, round(avg_abs_pct_gap, 6) AS value FROM gap_means
  ORDER BY avg_abs_pct_gap DESC NULLS LAST, mineral LIMIT 1"""

FACTS["top_mineral_unit"] = "SELECT * FROM sig_mineral"
FACTS["top_departamento"] = "SELECT * FROM sig_dept"
FACTS["top_gap_mineral"] = "SELECT * FROM sig_gap"
FACTS["top_gap_minerals"] = """
SELECT mineral, round(avg_abs_pct_gap, 6) AS avg_abs_pct_gap FROM gap_means
ORDER BY gap_means.avg_abs_pct_gap DESC NULLS LAST, mineral LIMIT 12"""
FACTS["top_departamentos"] = "SELECT * FROM dept_totals ORDER BY total_value DESC, departamento LIMIT 10"
FACTS["mineral_unit_totals"] = "SELECT * FROM unit_totals"
FACTS["iqr_outliers"] = "SELECT * FROM outliers"
BLOCKS["trend"] = """
  SELECT period_date, mineral, coalesce(sum(value), 0) AS value
  FROM tidy WHERE is_total_departamento AND unidad = 'tm.f' GROUP BY period_date, mineral"""
FACTS["official_trend"] = "SELECT * FROM trend"
# The brands in tonnes: every third of 25.
_TREND_COLUMNS = ", ".join(f"'Brand_{n}'" for n in range(3, 26, 3))
FACTS["trend_pivot"] = f"""
SELECT * FROM (PIVOT (SELECT period_date, replace(mineral, '#', '_') AS mineral, value FROM trend)
  ON mineral IN ({_TREND_COLUMNS}) USING max(value) GROUP BY period_date)"""
FACTS["eda_summary"] = """
SELECT min(period_date) AS period_min, max(period_date) AS period_max,
       count(DISTINCT period_yyyymm) AS n_periods, count(DISTINCT mineral) AS n_minerales,
       count(DISTINCT departamento) FILTER (WHERE NOT is_total_departamento) AS n_departamentos,
       count(*) AS rows_tidy, count(*) FILTER (WHERE is_total_departamento) AS rows_official,
       count(*) FILTER (WHERE NOT is_total_departamento) AS rows_detail,
       (SELECT count(*) FROM agg_m) AS rows_agg_mineral, (SELECT count(*) FROM agg_d) AS rows_agg_departamento,
       (SELECT label FROM sig_mineral) AS top_mineral_unit_label,
       (SELECT value FROM sig_mineral) AS top_mineral_unit_value,
       (SELECT label FROM sig_dept) AS top_departamento_label,
       (SELECT value FROM sig_dept) AS top_departamento_value,
       (SELECT label FROM sig_gap) AS top_gap_mineral_label,
       (SELECT value FROM sig_gap) AS top_gap_mineral_value,
       string_agg(DISTINCT unidad, ',' ORDER BY unidad) AS units,
       1.0::DOUBLE AS gap_ok_max_abs, 5.0::DOUBLE AS gap_warning_max_abs,
       (SELECT ok FROM flag_counts) AS gap_ok, (SELECT warning FROM flag_counts) AS gap_warning,
       (SELECT critical FROM flag_counts) AS gap_critical,
       (SELECT CAST(coalesce(sum(n_outliers), 0) AS BIGINT) FROM outliers) AS n_outliers_detail_iqr
FROM tidy"""

# ----------------------------------------------------------------------------- features


def _features(level: str, columns: str) -> str:
    lags = ", ".join(f"lag(target_value, {k}) OVER s AS lag_{k}" for k in (1, 2, 3, 6, 12))
    leads = ", ".join(f"lead(target_value, {h}) OVER s AS target_t_plus_{h}" for h in (1, 2, 3))
    rolls = ", ".join(
        f"{expr} AS roll_{name}_{w}"
        for w in (3, 6, 12)
        for name, expr in (
            ("mean", f"round(avg(target_value) OVER w{w}, 6)"),
            ("std", f"round(stddev_samp(target_value) OVER w{w}, 6)"),
            ("min", f"min(target_value) OVER w{w}"),
            ("max", f"max(target_value) OVER w{w}"),
        )
    )
    frames = ", ".join(
        f"w{w} AS (PARTITION BY series_id ORDER BY period_date ROWS BETWEEN {w} PRECEDING AND 1 PRECEDING)"
        for w in (3, 6, 12)
    )
    return f"""
SELECT *, target_value - lag_1 AS diff_lag_1, target_value - lag_12 AS diff_lag_12,
       CASE WHEN lag_1 > 0 THEN round(target_value / lag_1 - 1, 6) END AS mom_pct,
       CASE WHEN lag_12 > 0 THEN round(target_value / lag_12 - 1, 6) END AS yoy_pct,
       lag_12 IS NOT NULL AND target_t_plus_1 IS NOT NULL AS ready_for_model_h1,
       lag_12 IS NOT NULL AND target_t_plus_3 IS NOT NULL AS ready_for_model_h3
FROM (SELECT {columns},
             round(sin(2 * pi() * month / 12), 6) AS month_sin, round(cos(2 * pi() * month / 12), 6) AS month_cos,
             round(sin(2 * pi() * quarter / 4), 6) AS quarter_sin,
             round(cos(2 * pi() * quarter / 4), 6) AS quarter_cos,
             month = 1 AS is_year_start, month = 12 AS is_year_end,
             CAST(row_number() OVER s - 1 AS INTEGER) AS series_index, {lags}, {leads}, {rolls}
      FROM targets WHERE level = '{level}'
      WINDOW s AS (PARTITION BY series_id ORDER BY period_date), {frames})"""


_KEYS = "period_date, period_yyyymm, year, month, quarter, semester, mineral, unidad, series_id, target_value"
FACTS["national_features"] = _features("nacional_mineral", _KEYS)
FACTS["departamento_features"] = _features("departamento_mineral", _KEYS + ", departamento")
FACTS["feature_report"] = """
SELECT level, count(*) AS n_rows, count(DISTINCT series_id) AS n_series,
       count(*) FILTER (WHERE l12 IS NOT NULL AND t1 IS NOT NULL) AS ready_h1_rows,
       count(*) FILTER (WHERE l12 IS NOT NULL AND t3 IS NOT NULL) AS ready_h3_rows,
       min(period_date) AS period_min, max(period_date) AS period_max, (SELECT count(*) FROM tidy) AS rows_input_tidy
FROM (SELECT *, lag(target_value, 12) OVER s AS l12, lead(target_value, 1) OVER s AS t1,
             lead(target_value, 3) OVER s AS t3
      FROM targets WINDOW s AS (PARTITION BY level, series_id ORDER BY period_date))
GROUP BY level"""

# ------------------------------------------------------------------------ staged tables

FACTS["ordered_tidy"] = """
SELECT period_date, mineral, departamento, series_code, value,
       row_number() OVER (ORDER BY period_date, mineral, departamento, series_code) - 1 AS row_no
FROM tidy"""
FACTS["staged_csv"] = "SELECT * FROM tidy"
FACTS["staged_features"] = """
SELECT level, series_id, mineral, departamento, unidad, period_date, target_value
FROM targets WHERE target_value IS NOT NULL"""
