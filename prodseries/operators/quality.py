"""Data-quality rules, document contracts and key checks, each reported as rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prodseries.functions.text import text_to_bool
from prodseries.schemas import ALLOWED_UNITS, LONG_COLUMNS, MANDATORY_COLUMNS, SERIES_KEY

# Rule id -> description.
RULES = {
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



def _rule(rule_id: str, passed: Column, detail: Column) -> Column:
    return F.struct(
        F.lit(rule_id).alias("rule_id"),
        F.lit(RULES[rule_id]).alias("description"),
        F.when(passed, "PASS").otherwise("FAIL").alias("status"),
        detail.alias("detail"),
    )


def _counts(**counters: str) -> Column:
    """``name=value name=value`` from counter columns."""
    parts = []
    for name, column in counters.items():
        parts += [F.lit((" " if parts else "") + name + "="), F.col(column).cast("string")]
    return F.concat(*parts)


def column_differences(columns: list[str]) -> tuple[list[str], list[str]]:
    """Expected columns that are absent, and columns nobody expects."""
    return sorted(set(LONG_COLUMNS) - set(columns)), sorted(set(columns) - set(LONG_COLUMNS))


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys held by more than one row; NULL keys are equal to each other."""
    return df.groupBy(*keys).count().filter("count > 1").withColumnRenamed("count", "n_rows")


def invalid_units(df: DataFrame) -> DataFrame:
    """Every unit outside the allowed domain, with its row count."""
    unit = F.col("unidad").cast("string")
    return (
        df.filter(unit.isNotNull() & ~unit.isin(ALLOWED_UNITS))
        .groupBy(unit.alias("unidad"))
        .agg(F.count("*").alias("n_rows"))
    )


def _row_rules(df: DataFrame) -> DataFrame:
    """Every rule that looks at one row at a time, from a single pass without a shuffle of rows."""
    date = F.col("period_date").try_cast("date")
    year, month = F.col("year").try_cast("double"), F.col("month").try_cast("double")
    value = F.col("value").try_cast("double")
    has_value = value.isNotNull() & ~F.isnan(value)
    consistent = (F.year(date) == year.try_cast("int")) & (F.month(date) == month.try_cast("int"))

    def bad(condition: Column) -> Column:
        return F.count_if(~F.coalesce(condition, F.lit(False)))

    def null_in(name: str) -> Column:
        present = has_value if name == "value" else F.col(name).isNotNull()
        return bad(present).alias(f"null_{name}")

    counted = df.agg(
        F.count("*").alias("n"),
        *[null_in(c) for c in MANDATORY_COLUMNS],
        bad(date.isNotNull()).alias("bad_date"),
        bad(consistent).alias("bad_ym"),
        bad(month.between(1, 12)).alias("bad_month"),
        bad(has_value).alias("nan_values"),
        F.count_if(has_value & (value < 0)).alias("negative_values"),
        F.count_if(text_to_bool(F.col("is_missing"))).alias("flag_missing"),
        F.count_if(text_to_bool(F.col("is_invalid_numeric"))).alias("flag_invalid"),
    )
    nulls = [F.col(f"null_{c}") for c in MANDATORY_COLUMNS]
    null_detail = F.concat(
        F.lit("{"),
        F.concat_ws(
            ", ", *[F.concat(F.lit(f'"{c}": '), n.cast("string")) for c, n in zip(MANDATORY_COLUMNS, nulls)]
        ),
        F.lit("}"),
    )
    rules = F.array(
        _rule("R02", F.col("n") > 0, _counts(rows="n")),
        _rule("R03", F.greatest(*nulls) == 0, null_detail),
        _rule("R04", F.col("bad_date") == 0, _counts(invalid_period_date="bad_date")),
        _rule("R05", F.col("bad_ym") == 0, _counts(inconsistent_rows="bad_ym")),
        _rule("R06", F.col("bad_month") == 0, _counts(invalid_month_rows="bad_month")),
        _rule(
            "R07",
            (F.col("nan_values") == 0) & (F.col("negative_values") == 0),
            _counts(nan_values="nan_values", negative_values="negative_values"),
        ),
        _rule(
            "R10",
            (F.col("flag_missing") == 0) & (F.col("flag_invalid") == 0),
            _counts(is_missing_true="flag_missing", is_invalid_numeric_true="flag_invalid"),
        ),
    )
    return counted.select(F.inline(rules))


def _key_rule(df: DataFrame) -> DataFrame:
    """Rows beyond the first of each key. Reads two columns; copies combine before the shuffle."""
    surplus = df.groupBy(*SERIES_KEY).count().agg(
        F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).alias("surplus")
    )
    return surplus.select(
        F.inline(F.array(_rule("R08", F.col("surplus") == 0, _counts(duplicate_keys="surplus"))))
    )


def _unit_rule(df: DataFrame) -> DataFrame:
    """Counts the offending units; ``invalid_units`` is the complete table of them."""
    found = invalid_units(df).agg(F.count("*").alias("n_units"))
    return found.select(F.inline(F.array(_rule("R09", F.col("n_units") == 0, _counts(invalid_units="n_units")))))


def validation_rules(df: DataFrame) -> DataFrame:
    """One row per rule: ``rule_id, description, status, detail``.

    When columns are missing only the first two rules can be judged. Rows that cannot be
    judged (unparseable dates, NULL years) count as violations.
    """
    missing, extra = column_differences(df.columns)
    schema_rule = df.sparkSession.range(1).select(
        F.inline(
            F.array(_rule("R01", F.lit(not missing and not extra), F.lit(f"missing={missing} extra={extra}")))
        )
    )
    if missing:
        counted = df.agg(F.count("*").alias("n"))
        return schema_rule.unionByName(
            counted.select(F.inline(F.array(_rule("R02", F.col("n") > 0, _counts(rows="n")))))
        )
    return (
        schema_rule.unionByName(_row_rules(df)).unionByName(_key_rule(df)).unionByName(_unit_rule(df))
    )


def validation_failures(rules: DataFrame) -> DataFrame:
    return rules.filter(F.col("status") == "FAIL")


def validation_verdict(rules: DataFrame) -> DataFrame:
    """Overall status over all rules."""
    return rules.agg(
        F.count("*").alias("n_rules"),
        F.count_if(F.col("status") == "FAIL").alias("n_failed"),
        F.when(F.bool_and(F.col("status") == "PASS"), "PASS").otherwise("FAIL").alias("overall_status"),
    )


# ------------------------------------------------------------------- document contracts

_TYPES = {
    "date": (T.DateType, T.TimestampType, T.TimestampNTZType),
    "string": (T.StringType,),
    "integer": (T.IntegerType, T.LongType),
    "number": (T.DoubleType, T.IntegerType, T.LongType, T.DecimalType),
    "array": (T.ArrayType,),
    "object": (T.StructType,),
}

# Field -> type, the fields that must exist, and closed value sets.
FACT_CONTRACT = {
    "types": {
        "period_date": "date", "period_yyyymm": "string", "year": "integer", "month": "integer",
        "series_code": "string", "mineral": "string", "departamento": "string", "unidad": "string",
        "value": "number", "schema_version": "string",
    },
    "required": [
        "period_date", "period_yyyymm", "year", "month", "series_code", "mineral", "departamento",
        "unidad", "value", "schema_version",
    ],
}
AGGREGATE_CONTRACT = {
    "types": {
        "period_date": "date", "period_yyyymm": "string", "year": "integer", "month": "integer",
        "unidad": "string", "schema_version": "string", "gap_quality_flag": "string",
    },
    "required": [
        "aggregation_level", "period_date", "period_yyyymm", "year", "month", "unidad", "schema_version",
    ],
    "enums": {
        "aggregation_level": ["mineral_period_unit", "departamento_period_unit"],
        "gap_quality_flag": ["ok", "warning", "critical", None],
    },
    "nullable": ["gap_quality_flag"],
}
PREDICTION_CONTRACT = {
    "types": {
        "model": "string", "level": "string", "series_id": "string", "forecast_window_start": "date",
        "forecast_window_end": "date", "forecast_window_months": "integer", "forecasts": "array",
        "schema_version": "string", "source": "object",
    },
    "required": [
        "model", "level", "series_id", "forecast_window_start", "forecast_window_end",
        "forecast_window_months", "forecasts", "schema_version",
    ],
    "nullable": ["source"],
    "items": {
        "forecasts": {
            "forecast_period_date": "date", "forecast_period_yyyymm": "string", "forecast_value": "number",
        }
    },
}

CONTRACTS = {"facts": FACT_CONTRACT, "aggregates": AGGREGATE_CONTRACT, "predictions": PREDICTION_CONTRACT}


def contract_violations(df: DataFrame, collection: str, contract: dict) -> DataFrame:
    """Count violations per ``(collection, field, rule)`` in one pass; nothing is rejected.

    ``required`` is about the field existing, so it is violated by every row or by none. A
    field that exists but holds NULL violates its ``type`` unless NULL is allowed.
    """
    fields = {f.name: f.dataType for f in df.schema}
    nullable = contract.get("nullable", [])
    checks: list[tuple[str, str, Column]] = []
    nobody = F.lit(False)
    for name in contract["required"]:
        checks.append((name, "required", nobody if name in fields else F.lit(True)))
    for name, kind in contract["types"].items():
        if name not in fields:
            broken = nobody
        elif not isinstance(fields[name], _TYPES[kind]):
            broken = F.col(name).isNotNull() if name in nullable else F.lit(True)
        else:
            broken = nobody if name in nullable else F.col(name).isNull()
        checks.append((name, "type", broken))
    for name, allowed in contract.get("enums", {}).items():
        if name in fields:
            values = [v for v in allowed if v is not None]
            outside = F.col(name).isNotNull() & ~F.col(name).isin(values)
            checks.append((name, "enum", outside if None in allowed else outside | F.col(name).isNull()))
    for name, parts in contract.get("items", {}).items():
        if name in fields:
            element = {f.name: f.dataType for f in fields[name].elementType}
            for part, kind in parts.items():
                if part not in element or not isinstance(element[part], _TYPES[kind]):
                    broken = F.size(name) > 0
                else:
                    broken = F.exists(F.col(f"{name}.{part}"), F.isnull)
                checks.append((f"{name}.{part}", "type", broken))
    counted = df.agg(*[F.count_if(broken).alias(f"c{i}") for i, (_, _, broken) in enumerate(checks)])
    return counted.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(collection).alias("collection"),
                        F.lit(name).alias("field"),
                        F.lit(rule).alias("rule"),
                        F.col(f"c{i}").alias("n_violations"),
                    )
                    for i, (name, rule, _) in enumerate(checks)
                ]
            )
        )
    )
