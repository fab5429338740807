"""Named CTEs and the helper that prepends the ones a statement uses, transitively."""

from __future__ import annotations

import re

BLOCKS: dict[str, str] = {}


def statement(sql: str) -> str:
    """``sql`` with a WITH clause of every block it refers to, in dependency order."""
    ordered: list[str] = []

    def visit(text: str) -> None:
        for name in BLOCKS:
            if name not in ordered and re.search(rf"\b{name}\b", text):
                # A recursive block names itself.
                visit(re.sub(rf"\b{name}\b", "", BLOCKS[name]))
                ordered.append(name)

    visit(sql)
    if not ordered:
        return sql.strip()
    ctes = ",\n".join(f"{_head(n)} AS ({BLOCKS[n].strip()})" for n in ordered)
    return f"WITH RECURSIVE {ctes}\n{sql.strip()}"


HEADS: dict[str, str] = {}


def _head(name: str) -> str:
    return HEADS.get(name, name)


MONTH_LIST = "['ene','feb','mar','abr','may','jun','jul','ago','sep','oct','nov','dic']"
MONTH_NAME_LIST = (
    "['Enero','Febrero','Marzo','Abril','Mayo','Junio','Julio','Agosto','Septiembre','Octubre',"
    "'Noviembre','Diciembre']"
)
REGION_LIST = "['AFRICA','AMERICA','ASIA','EUROPE','MIDDLE EAST','Total']"

BLOCKS["monthly_q"] = """
  SELECT CAST(date_trunc('month', l_shipdate) + INTERVAL 276 MONTH AS DATE) AS period_date,
         p_brand AS mineral, r_name AS departamento,
         sum(l_quantity) AS detail_value,
         sum(l_quantity) FILTER (WHERE l_orderkey % 40 <> 0) AS official_value
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
       JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  GROUP BY ALL"""

BLOCKS["monthly_v"] = """
  SELECT period_date, mineral, departamento, detail_value AS value,
         CAST(regexp_extract(mineral, '(\\d+)', 1) AS INTEGER) AS brand_no
  FROM monthly_q
  UNION ALL
  SELECT period_date, mineral, 'Total', sum(official_value),
         CAST(regexp_extract(mineral, '(\\d+)', 1) AS INTEGER)
  FROM monthly_q WHERE official_value IS NOT NULL GROUP BY period_date, mineral"""

BLOCKS["token_v"] = f"""
  SELECT *, upper({MONTH_LIST}[month(period_date)][1]) || {MONTH_LIST}[month(period_date)][2:] ||
         strftime(period_date, '%y') AS token
  FROM monthly_v"""

BLOCKS["obs"] = """
  SELECT 'lineitem' AS source_dataset, token AS period_raw, period_date,
         CAST(year(period_date) AS INTEGER) AS year, CAST(month(period_date) AS INTEGER) AS month,
         replace(mineral, '#', '') || '_' || departamento AS series_code,
         'Produccion mensual - ' || mineral || ' - ' || departamento || ' (' ||
           ['tm.f','kg.f','grs.f'][brand_no % 3 + 1] || ')' AS series_description,
         mineral, departamento, ['tm.f','kg.f','grs.f'][brand_no % 3 + 1] AS unidad,
         value, false AS is_missing, false AS is_invalid_numeric,
         CAST(CAST(value AS BIGINT) AS VARCHAR) AS value_raw
  FROM token_v"""


def tidy_block(source: str) -> str:
    return f"""
  SELECT *, strftime(period_date, '%Y-%m') AS period_yyyymm,
         CASE WHEN month BETWEEN 1 AND 12 THEN {MONTH_NAME_LIST}[month] END AS month_name_es,
         CAST(quarter(period_date) AS INTEGER) AS quarter,
         CAST((month - 1) // 6 + 1 AS INTEGER) AS semester,
         coalesce(lower(departamento) = 'total', false) AS is_total_departamento,
         CASE WHEN lower(departamento) = 'total' THEN 'Nacional' ELSE 'Departamental' END AS area_geografica,
         CASE WHEN lower(departamento) = 'total' THEN 'total_oficial' ELSE 'detalle_departamental' END
           AS metric_level,
         round_even(value, 6) AS value_rounded_6,
         coalesce(strftime(period_date, '%Y-%m'), 'nan') || '|' || coalesce(series_code, 'nan') AS record_id
  FROM {source}"""


PERIOD = "period_date, period_raw, period_yyyymm, year, month, quarter, semester"


def mineral_block(source: str) -> str:
    filled = " AND ".join(f"{c} IS NOT NULL" for c in f"{PERIOD}, mineral, unidad".split(", "))
    return f"""
  SELECT d.*, t.official_total_value,
         t.official_total_value - d.dept_sum_value AS abs_gap_vs_total,
         CASE WHEN abs(t.official_total_value) > 0
              THEN (t.official_total_value - d.dept_sum_value) / t.official_total_value * 100 END
           AS pct_gap_vs_total
  FROM (SELECT {PERIOD}, mineral, unidad, coalesce(sum(value), 0) AS dept_sum_value,
               count(DISTINCT departamento) AS n_departamentos
        FROM {source} WHERE NOT is_total_departamento AND {filled} GROUP BY ALL) d
  LEFT JOIN (SELECT {PERIOD}, mineral, unidad,
                    arg_min(value, departamento || '~' || series_code) FILTER (WHERE value IS NOT NULL)
                      AS official_total_value
             FROM {source} WHERE is_total_departamento AND {filled} GROUP BY ALL) t
  USING ({PERIOD}, mineral, unidad)"""


def departamento_block(source: str) -> str:
    filled = " AND ".join(f"{c} IS NOT NULL" for c in f"{PERIOD}, departamento, unidad".split(", "))
    return f"""
  SELECT {PERIOD}, departamento, unidad, coalesce(sum(value), 0) AS dept_unit_sum_value,
         count(DISTINCT mineral) AS n_minerales
  FROM {source} WHERE NOT is_total_departamento AND {filled} GROUP BY ALL"""


BLOCKS["tidy"] = tidy_block("obs")
BLOCKS["agg_m"] = mineral_block("tidy")
BLOCKS["agg_d"] = departamento_block("tidy")

# ------------------------------------------------------------------ faulty observations

BLOCKS["faulty"] = """
  SELECT source_dataset, period_raw,
         CASE WHEN b = 8 AND ym = '2019-08' THEN NULL ELSE period_date END AS period_date, year,
         CASE WHEN b = 6 AND ym = '2021-06' THEN 13 ELSE month END AS month,
         series_code, series_description,
         CASE WHEN b = 7 AND departamento = 'EUROPE' THEN NULL ELSE mineral END AS mineral, departamento,
         CASE WHEN b = 11 AND departamento = 'ASIA' AND month = 1 THEN 'onzas' ELSE unidad END AS unidad,
         CASE WHEN r IN (0, 3) THEN NULL WHEN b = 5 AND ym = '2020-05' THEN -value ELSE value END AS value,
         r = 0 AS is_missing, r = 3 AS is_invalid_numeric, value_raw
  FROM (SELECT *, CAST(regexp_extract(mineral, '(\\d+)', 1) AS INTEGER) AS b,
               strftime(period_date, '%Y-%m') AS ym,
               ((12 * year + month) * 31 + CAST(regexp_extract(mineral, '(\\d+)', 1) AS INTEGER) * 17) % 50 AS r
        FROM obs)
  CROSS JOIN (VALUES (0), (1)) copies(copy_no)
  WHERE copy_no = 0 OR ym = '2020-03'"""

BLOCKS["faulty_tidy"] = tidy_block("faulty")
BLOCKS["faulty_agg_m"] = mineral_block("faulty_tidy")
BLOCKS["faulty_agg_d"] = departamento_block("faulty_tidy")

# ------------------------------------------------------------------------------ targets

_T = "period_date, period_yyyymm, year, month, quarter, semester"
BLOCKS["targets"] = f"""
  SELECT 'nacional_mineral' AS level, {_T}, mineral, 'Total' AS departamento, unidad,
         mineral || '|' || unidad AS series_id,
         arg_min(value, departamento || '~' || series_code) AS target_value
  FROM tidy WHERE is_total_departamento GROUP BY {_T}, mineral, unidad
  UNION ALL
  SELECT 'departamento_mineral', {_T}, mineral, departamento, unidad,
         mineral || '|' || departamento || '|' || unidad, coalesce(sum(value), 0)
  FROM tidy WHERE NOT is_total_departamento GROUP BY {_T}, mineral, departamento, unidad"""
