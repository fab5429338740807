"""Table contracts and the fixed vocabularies shared by every stage."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------- fixed values

MISSING_TOKENS = ["", "n.d.", "nd", "n/d", "na", "nan", "none", "null"]

MONTH_ABBREVIATIONS = ["ene", "feb", "mar", "abr", "may", "jun", "jul", "ago", "sep", "oct", "nov", "dic"]

MONTH_NAMES = [
    "Enero", "Febrero", "Marzo", "Abril", "Mayo", "Junio",
    "Julio", "Agosto", "Septiembre", "Octubre", "Noviembre", "Diciembre",
]

# damaged spelling -> repaired spelling
MOJIBAKE_REPAIRS = {
    "Producci�n": "Producción",
    "seg�n": "según",
    "Hu�nuco": "Huánuco",
    "Jun�n": "Junín",
    "Esta�o": "Estaño",
    "Apur�mac": "Apurímac",
}

ALLOWED_UNITS = ["tm.f", "kg.f", "grs.f"]
METRIC_TONNES = "tm.f"

NATIONAL_LEVEL = "nacional_mineral"
DEPARTMENT_LEVEL = "departamento_mineral"

MINERAL_AGGREGATE = "mineral_period_unit"
DEPARTMENT_AGGREGATE = "departamento_period_unit"

GAP_OK_MAX = 1.0
GAP_WARNING_MAX = 5.0

DOCUMENT_VERSION = "v1"

# ------------------------------------------------------------------- contracts

LONG_SCHEMA = T.StructType(
    [
        T.StructField("source_dataset", T.StringType()),
        T.StructField("period_raw", T.StringType()),
        T.StructField("period_date", T.DateType()),
        T.StructField("year", T.IntegerType()),
        T.StructField("month", T.IntegerType()),
        T.StructField("series_code", T.StringType()),
        T.StructField("series_description", T.StringType()),
        T.StructField("mineral", T.StringType()),
        T.StructField("departamento", T.StringType()),
        T.StructField("unidad", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("is_missing", T.BooleanType()),
        T.StructField("is_invalid_numeric", T.BooleanType()),
        T.StructField("value_raw", T.StringType()),
    ]
)
LONG_COLUMNS = LONG_SCHEMA.fieldNames()

# Every long column except the two flags and the raw cell must be filled in.
MANDATORY_COLUMNS = [c for c in LONG_COLUMNS if c not in ("is_missing", "is_invalid_numeric", "value_raw")]

SERIES_KEY = ["period_date", "series_code"]

PERIOD_KEYS = ["period_date", "period_raw", "period_yyyymm", "year", "month", "quarter", "semester"]

FORECAST_CONTEXT = ["level", "series_id", "mineral", "departamento", "unidad"]

OPERATIONAL_SCHEMA = T.StructType(
    [T.StructField(c, T.StringType()) for c in FORECAST_CONTEXT]
    + [
        T.StructField("selected_model", T.StringType()),
        T.StructField("last_observed_period", T.DateType()),
        T.StructField("forecast_period_date", T.DateType()),
        T.StructField("forecast_period_yyyymm", T.StringType()),
        T.StructField("forecast_value", T.DoubleType()),
    ]
)

AGGREGATE_KEY = ["aggregation_level", "period_date", "unidad", "mineral", "departamento"]
PREDICTION_KEY = ["model", "level", "series_id", "forecast_window_start", "forecast_window_end"]


def require_columns(df, needed, what="table"):
    """Fail at plan time when ``df`` lacks a column the step depends on."""
    missing = sorted(set(needed) - set(df.columns))
    if missing:
        raise ValueError(f"Missing required columns in {what}: {missing}")
    return df
