"""Tidy facts, the two period aggregates and the gap against official totals."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prodseries.functions import measures as m
from prodseries.schemas import GAP_OK_MAX, GAP_WARNING_MAX, PERIOD_KEYS


# The order of the stored facts.
TIDY_ORDER = ["period_date", "mineral", "departamento", "series_code"]


def tidy_observations(base: DataFrame) -> DataFrame:
    """Add period, classification, rounding and key columns; units stay as they are."""
    date, month = F.col("period_date"), F.col("month")
    value, yyyymm = m.nan_to_null(F.col("value")), m.yyyymm(date)
    is_total = F.coalesce(F.lower("departamento") == "total", F.lit(False))
    return base.withColumns(
        {
            "value": value,
            "period_yyyymm": yyyymm,
            "month_name_es": m.month_name(month),
            "quarter": F.quarter(date),
            "semester": m.semester(month),
            "is_total_departamento": is_total,
            "area_geografica": F.when(is_total, "Nacional").otherwise("Departamental"),
            "metric_level": F.when(is_total, "total_oficial").otherwise("detalle_departamental"),
            "value_rounded_6": m.round_half_even(value, 6),
            "record_id": F.concat_ws(
                "|", F.coalesce(yyyymm, F.lit("nan")), F.coalesce("series_code", F.lit("nan"))
            ),
        }
    )


def first_official(value: Column, condition: Column, area: str = "departamento") -> Column:
    """First known official value of a key: the tidy sort order decides, NULL codes last."""
    order = F.struct(area, F.col("series_code").isNull(), "series_code")
    return F.min_by(value, F.when(condition & value.isNotNull(), order))


MINERAL_MEASURES = ["dept_sum_value", "n_departamentos", "official_total_value"]


def agg_mineral_period(tidy: DataFrame) -> DataFrame:
    """Regional detail against the official total, per mineral, unit and period.

    Detail and total share their grouping keys, so one conditional aggregate gives what two
    aggregates and a left join would: keys without any detail row are dropped at the end.
    """
    # The most selective keys lead: the rest follow from them and are rarely compared.
    keys = ["period_date", "mineral", "unidad", *PERIOD_KEYS[1:]]
    detail = ~F.col("is_total_departamento")
    summed = (
        tidy.dropna(subset=keys)
        .groupBy(*keys)
        .agg(
            F.count_if(detail).alias("detail_rows"),
            F.coalesce(F.sum(F.when(detail, F.col("value"))), F.lit(0.0)).alias("dept_sum_value"),
            F.count_distinct(F.when(detail, F.col("departamento"))).alias("n_departamentos"),
            first_official(F.col("value"), ~detail).alias("official_total_value"),
        )
        .filter("detail_rows > 0")
        .drop("detail_rows")
    )
    summed = summed.select(*PERIOD_KEYS, "mineral", "unidad", *MINERAL_MEASURES)
    official, gap = F.col("official_total_value"), F.col("abs_gap_vs_total")
    return summed.withColumn("abs_gap_vs_total", official - F.col("dept_sum_value")).withColumn(
        # The gap keeps its sign; its name is part of the table contract.
        "pct_gap_vs_total", F.when(F.abs(official) > 0, gap / official * 100)
    )


def agg_departamento_period(tidy: DataFrame) -> DataFrame:
    """Department totals per unit and period; units are never mixed."""
    keys = [*PERIOD_KEYS, "departamento", "unidad"]
    return (
        tidy.filter(~F.col("is_total_departamento"))
        .dropna(subset=keys)
        .groupBy(*keys)
        .agg(
            F.coalesce(F.sum("value"), F.lit(0.0)).alias("dept_unit_sum_value"),
            F.count_distinct("mineral").alias("n_minerales"),
        )
    )


def with_gap_flag(
    agg_mineral: DataFrame, ok_max: float = GAP_OK_MAX, warning_max: float = GAP_WARNING_MAX
) -> DataFrame:
    pct = F.abs("pct_gap_vs_total")
    return agg_mineral.withColumn("abs_pct_gap", pct).withColumn(
        "gap_quality_flag", m.gap_class(pct, ok_max, warning_max)
    )


def dimension_counts(tidy: DataFrame) -> DataFrame:
    """Rows per period and dimension. Distinct counts are taken over this small table, so the
    facts are read once and not multiplied per counted column."""
    return tidy.groupBy(
        "period_date", "period_yyyymm", "mineral", "departamento", "unidad", "is_total_departamento"
    ).agg(F.count("*").alias("n_rows"))


def transform_report(base: DataFrame, agg_mineral: DataFrame | None = None, agg_departamento: DataFrame | None = None) -> DataFrame:
    """Row and distinct counts of the tidy table, and rows of the aggregates that are given, as
    one row."""
    own = dimension_counts(tidy_observations(base)).agg(
        F.coalesce(F.sum("n_rows"), F.lit(0)).alias("rows_tidy"),
        F.count_distinct("period_date").alias("unique_periods"),
        F.count_distinct("mineral").alias("unique_minerales"),
        F.count_distinct("departamento").alias("unique_departamentos"),
        F.sort_array(F.collect_set("unidad")).alias("units_detected"),
        F.min("period_date").alias("period_min"),
        F.max("period_date").alias("period_max"),
    )
    named = {"rows_agg_mineral_period": agg_mineral, "rows_agg_departamento_period": agg_departamento}
    parts = [own, *[df.agg(F.count("*").alias(name)) for name, df in named.items() if df is not None]]
    stacked = reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), parts)
    return stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])


def domain_values(df: DataFrame, columns: list[str]) -> DataFrame:
    """Distinct values of several text columns as ``(field, value, n_rows)`` rows."""
    pairs = F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).alias("value")) for c in columns])
    return (
        df.select(F.inline(pairs))
        .filter(F.col("value").isNotNull())
        .groupBy("field", "value")
        .agg(F.count("*").alias("n_rows"))
    )
