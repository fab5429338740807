"""The seeded sheet and everything parsed from it, plus the text operators."""

from __future__ import annotations

from oracles.blocks import BLOCKS, MONTH_LIST, REGION_LIST

CLEANING: dict[str, str] = {}

_SPACE = (
    r"[\s\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
)
# Damaged words and their repair.
_REPAIRS = {
    "Producci�n": "Producción",
    "seg�n": "según",
    "Hu�nuco": "Huánuco",
    "Jun�n": "Junín",
    "Esta�o": "Estaño",
    "Apur�mac": "Apurímac",
}


def norm(expr: str) -> str:
    for damaged, repaired in _REPAIRS.items():
        expr = f"replace({expr}, '{damaged}', '{repaired}')"
    return f"trim(regexp_replace(replace({expr}, '�', ''), '{_SPACE}', ' ', 'g'))"


def plain(expr: str) -> str:
    return rf"regexp_replace(strip_accents({expr}), '[^\x00-\x7F]', '', 'g')"


CLEANING["normalize_text_docs"] = f"""
SELECT doc_id, {norm("text || '  Producci�n seg�n  Jun�n x�y Esta�o '")} AS text
FROM documents"""
CLEANING["strip_accents_docs"] = f"SELECT doc_id, {plain('text')} AS text FROM documents"

# Header of the sheet: every brand x area, and the first brand's ASIA column once more.
BLOCKS["sheet_cols"] = f"""
  SELECT *, (brand_no - 1) * 6 + area AS col_ord, replace(mineral, '#', '') || '_' || departamento AS code,
         ['tm.f','kg.f','grs.f'][brand_no % 3 + 1] AS unit
  FROM (SELECT DISTINCT p_brand AS mineral, CAST(regexp_extract(p_brand, '(\\d+)', 1) AS INTEGER) AS brand_no
        FROM part)
  CROSS JOIN (SELECT unnest({REGION_LIST}) AS departamento, unnest(range(1, 7)) AS area)"""
BLOCKS["sheet_head"] = """
  SELECT CAST(col_ord AS INTEGER) AS col_ord, code,
         CASE WHEN brand_no = 7 AND departamento = 'EUROPE' THEN 'Sin descripcion'
              WHEN brand_no = 11 AND departamento = 'ASIA'
                THEN 'Producción mensual - ' || mineral || ' - ASIA (Onzas)'
              WHEN departamento = 'AMERICA'
                THEN 'Producci�n mensual - ' || mineral || ' - AMERICA (' || unit || ')'
              WHEN departamento = 'AFRICA'
                THEN 'Producción mensual - ' || mineral || ' - Hu�nuco (' || unit || ')'
              WHEN departamento = 'MIDDLE EAST'
                THEN 'Producción mensual - ' || mineral || ' - MIDDLE ' || chr(160) || ' EAST (' || unit || ')'
              ELSE 'Producción mensual - ' || mineral || ' - ' || departamento || ' (' || unit || ')' END
           AS description
  FROM sheet_cols
  UNION ALL
  SELECT CAST((SELECT max(col_ord) + 1 FROM sheet_cols) AS INTEGER), 'Brand1_ASIA',
         'Produccion mensual - Brand#1 - ASIA repetida (kg.f)'"""

BLOCKS["sheet_vals"] = f"""
  SELECT period_date, token, brand_no, (brand_no - 1) * 6 + list_position({REGION_LIST}, departamento) AS col_ord,
         value
  FROM token_v
  UNION ALL
  SELECT period_date, token, brand_no, (SELECT max(col_ord) + 1 FROM sheet_cols), value + 1000
  FROM token_v WHERE brand_no = 1 AND departamento = 'ASIA'"""
BLOCKS["sheet_rows"] = """
  SELECT DISTINCT period_date, CAST(12 * year(period_date) + month(period_date) - 2018 * 12 + 1 AS BIGINT) AS row_ord,
         token, 0 AS extra
  FROM token_v
  UNION ALL SELECT DATE '2020-03-01', 1000, 'Mar20', 1
  UNION ALL SELECT DATE '2023-09-01', 1001, 'Set23', 0
  UNION ALL SELECT DATE '2023-04-01', 1002, '2023-04', 0"""
BLOCKS["sheet_cells"] = """
  SELECT row_ord, col_ord, token, code, description,
         CASE WHEN v IS NULL THEN NULL
              WHEN r = 0 THEN 'n.d.' WHEN r = 1 THEN '' WHEN r = 2 THEN '—' WHEN r = 3 THEN 'abc'
              WHEN r = 4 THEN '12f' WHEN r = 5 THEN format('{:,}', v)
              WHEN r = 6 THEN '1_' || lpad(CAST(v AS VARCHAR), 9, '0') WHEN r = 7 THEN 'inf'
              WHEN r = 8 THEN NULL WHEN r = 9 THEN ' ' || v || '.25 '
              WHEN r = 10 THEN ', ' || v WHEN r = 11 THEN v || ' ,' ELSE CAST(v AS VARCHAR) END AS value_raw
  FROM (SELECT row_ord, h.col_ord, sheet_rows.token, code, description,
               CAST(value + extra AS BIGINT) AS v,
               ((12 * year(sheet_rows.period_date) + month(sheet_rows.period_date)) * 31 + brand_no * 17) % 50 AS r
        FROM sheet_rows CROSS JOIN sheet_head h
        LEFT JOIN sheet_vals sv ON sv.period_date = sheet_rows.period_date AND sv.col_ord = h.col_ord)"""

BLOCKS["series_dim"] = rf"""
  SELECT col_ord, series_code, series_description,
         CASE WHEN hit THEN {norm("parts[1]")} END AS mineral,
         CASE WHEN hit THEN {norm("parts[2]")} END AS departamento,
         CASE WHEN hit THEN lower({norm("parts[3]")}) END AS unidad
  FROM (SELECT *, regexp_matches(series_description, '^(.+?) - (.+?) - (.+?) \(([^)]+)\)$') AS hit,
               [regexp_extract(series_description, '^(.+?) - (.+?) - (.+?) \(([^)]+)\)$', 2),
                regexp_extract(series_description, '^(.+?) - (.+?) - (.+?) \(([^)]+)\)$', 3),
                regexp_extract(series_description, '^(.+?) - (.+?) - (.+?) \(([^)]+)\)$', 4)] AS parts
        FROM (SELECT col_ord, {norm("code")} AS series_code,
                     last({norm("description")}) OVER (PARTITION BY code ORDER BY col_ord
                       ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS series_description
              FROM sheet_head))"""

CLEANING["raw_wide_to_long"] = """
SELECT row_ord, col_ord, token AS period_raw, series_code, series_description, value_raw
FROM sheet_cells JOIN series_dim USING (col_ord)"""

# Read from files, rows are counted on from the two header rows and empty cells are NULL.
CLEANING["sheet_files"] = """
SELECT 1 + dense_rank() OVER (ORDER BY row_ord) AS row_ord, col_ord, token AS period_raw, series_code, series_description,
       nullif(value_raw, '') AS value_raw
FROM sheet_cells JOIN series_dim USING (col_ord)"""


def _period(token: str) -> str:
    month = f"list_position({MONTH_LIST}, lower({token}[1:3]))"
    return rf"""CASE WHEN regexp_matches({token}, '^[A-Za-z]{{3}}\d\d$') AND {month} IS NOT NULL
        THEN make_date(2000 + CAST({token}[4:5] AS INTEGER), {month}, 1) END"""


CLEANING["parse_period_tokens"] = f"SELECT row_ord, token, {_period('token')} AS period_date FROM sheet_rows"
CLEANING["parse_series_metadata"] = "SELECT * FROM series_dim"

# What counts as a number, and the spellings of a missing one below.
_NUMBER = (
    r"^[+-]?(\d+(_\d+)*\.?(\d+(_\d+)*)?|\.\d+(_\d+)*)([eE][+-]?\d+(_\d+)*)?$|^[+-]?inf(inity)?$"
)
BLOCKS["numeric_cells"] = f"""
  SELECT *, missing AS is_missing, NOT missing AND NOT number AS is_invalid_numeric,
         CASE WHEN NOT missing AND number THEN TRY_CAST(replace(digits, '_', '') AS DOUBLE) END AS value
  FROM (SELECT *, trim(replace(t, ',', '')) AS digits, regexp_matches(trim(replace(t, ',', '')), '{_NUMBER}') AS number,
               t IS NULL OR t IN ('', 'n.d.', 'nd', 'n/d', 'na', 'nan', 'none', 'null') AS missing
        FROM (SELECT *, lower({plain(norm("value_raw"))}) AS t FROM sheet_cells))"""
CLEANING["parse_numeric_tokens"] = """
SELECT row_ord, col_ord, value_raw, value, is_missing, is_invalid_numeric FROM numeric_cells"""

BLOCKS["typed_cells"] = f"""
  SELECT 'raw_sheet' AS source_dataset, token AS period_raw, {_period('token')} AS period_date,
         CAST(year({_period('token')}) AS INTEGER) AS year, CAST(month({_period('token')}) AS INTEGER) AS month,
         series_code, series_description, mineral, departamento, unidad, value, is_missing, is_invalid_numeric,
         value_raw, row_ord, col_ord
  FROM numeric_cells JOIN series_dim USING (col_ord)"""
BLOCKS["deduped"] = """
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY period_date, series_code ORDER BY col_ord, row_ord) AS rn
    FROM typed_cells) WHERE rn = 1"""
CLEANING["clean_full"] = "SELECT * EXCLUDE (row_ord, col_ord) FROM deduped"
CLEANING["clean_base"] = "SELECT * EXCLUDE (row_ord, col_ord) FROM deduped WHERE NOT is_missing"
CLEANING["cleaning_report"] = """
SELECT (SELECT count(*) FROM typed_cells) AS rows_raw_long, count(*) AS rows_after_dedup,
       (SELECT count(*) FROM typed_cells) - count(*) AS duplicates_removed,
       count(*) FILTER (WHERE is_missing) AS rows_missing_semantic,
       count(*) FILTER (WHERE is_invalid_numeric) AS rows_invalid_numeric,
       count(*) FILTER (WHERE NOT is_missing) AS rows_base_dataset,
       count(*) FILTER (WHERE period_date IS NULL) AS null_period_date,
       count(*) FILTER (WHERE mineral IS NULL) AS null_mineral,
       count(*) FILTER (WHERE departamento IS NULL) AS null_departamento,
       count(DISTINCT period_date) AS unique_periods, count(DISTINCT series_code) AS unique_series_codes
FROM deduped"""
