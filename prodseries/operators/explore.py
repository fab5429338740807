"""Exploratory signals and the datasets behind the report charts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prodseries.operators.quantiles import iqr_outliers
from prodseries.operators.tidy import dimension_counts, with_gap_flag
from prodseries.schemas import GAP_OK_MAX, GAP_WARNING_MAX, METRIC_TONNES


def official_rows(tidy: DataFrame) -> DataFrame:
    return tidy.filter("is_total_departamento")


def detail_rows(tidy: DataFrame) -> DataFrame:
    return tidy.filter("NOT is_total_departamento")


def _total(df: DataFrame, keys: list[str], value: str = "value", name: str = "total_value") -> DataFrame:
    return df.dropna(subset=keys).groupBy(*keys).agg(F.coalesce(F.sum(value), F.lit(0.0)).alias(name))


def mineral_unit_totals(tidy: DataFrame) -> DataFrame:
    """Cumulative official production per mineral and unit."""
    return _total(official_rows(tidy), ["mineral", "unidad"])


def departamento_totals(tidy: DataFrame, unit: str = METRIC_TONNES) -> DataFrame:
    """Cumulative detail production per department for one unit."""
    return _total(detail_rows(tidy).filter(F.col("unidad") == unit), ["departamento"])


def mineral_gap_means(agg_mineral: DataFrame) -> DataFrame:
    """Average absolute percentage gap per mineral; unknown gaps are left out of the mean."""
    return (
        agg_mineral.dropna(subset=["mineral"])
        .groupBy("mineral")
        .agg(F.avg(F.abs("pct_gap_vs_total")).alias("avg_abs_pct_gap"))
    )


def top(df: DataFrame, measure: str, names: list[str], n: int) -> DataFrame:
    """The n largest rows; ties go to the alphabetically first name."""
    return df.orderBy(F.col(measure).desc_nulls_last(), *names).limit(n)


def top_gap_minerals(agg_mineral: DataFrame, n: int = 12) -> DataFrame:
    return top(mineral_gap_means(agg_mineral), "avg_abs_pct_gap", ["mineral"], n)


def top_departamentos(tidy: DataFrame, n: int = 10, unit: str = METRIC_TONNES) -> DataFrame:
    return top(departamento_totals(tidy, unit), "total_value", ["departamento"], n)


def _signal(best: DataFrame, label: Column, value: str) -> DataFrame:
    """A single winner as ``(label, value)``, or ``n/a`` and 0 when there is none."""
    return best.select(label.alias("label"), F.col(value).alias("value")).agg(
        F.coalesce(F.first("label"), F.lit("n/a")).alias("label"),
        F.coalesce(F.first("value"), F.lit(0.0)).alias("value"),
    )


def top_mineral_unit(tidy: DataFrame) -> DataFrame:
    best = top(mineral_unit_totals(tidy), "total_value", ["mineral", "unidad"], 1)
    return _signal(best, F.concat("mineral", F.lit(" ("), "unidad", F.lit(")")), "total_value")


def top_departamento(tidy: DataFrame, unit: str = METRIC_TONNES) -> DataFrame:
    return _signal(top_departamentos(tidy, 1, unit), F.col("departamento"), "total_value")


def top_gap_mineral(agg_mineral: DataFrame) -> DataFrame:
    return _signal(top_gap_minerals(agg_mineral, 1), F.col("mineral"), "avg_abs_pct_gap")


def gap_flag_counts(
    agg_mineral: DataFrame, ok_max: float = GAP_OK_MAX, warning_max: float = GAP_WARNING_MAX
) -> DataFrame:
    """Rows per gap class; a class that does not occur counts 0."""
    flag = F.col("gap_quality_flag")
    return with_gap_flag(agg_mineral, ok_max, warning_max).agg(
        *[F.count_if(flag == c).alias(c) for c in ("ok", "warning", "critical")]
    )


def detail_outliers(tidy: DataFrame) -> DataFrame:
    return iqr_outliers(detail_rows(tidy), ["mineral", "unidad"], "value")


def official_trend(tidy: DataFrame, unit: str = METRIC_TONNES) -> DataFrame:
    """Official production per period and mineral for one unit."""
    return _total(
        official_rows(tidy).filter(F.col("unidad") == unit), ["period_date", "mineral"], name="value"
    )


def trend_pivot(tidy: DataFrame, minerals: list[str] | None = None, unit: str = METRIC_TONNES) -> DataFrame:
    """The trend with one column per mineral: those of the unit, or the named ones in one pass."""
    return official_trend(tidy, unit).groupBy("period_date").pivot("mineral", minerals).agg(F.first("value"))


def eda_summary(
    tidy: DataFrame,
    agg_mineral: DataFrame,
    agg_departamento: DataFrame,
    ok_max: float = GAP_OK_MAX,
    warning_max: float = GAP_WARNING_MAX,
) -> DataFrame:
    """Coverage, signals and quality counters as one row.

    Every part is a one-row aggregate; they are laid side by side by stacking them with
    NULLs and taking the only value of each column.
    """
    def named(df: DataFrame, prefix: str) -> DataFrame:
        return df.select(F.col("label").alias(f"{prefix}_label"), F.col("value").alias(f"{prefix}_value"))

    is_total = F.col("is_total_departamento")
    parts = [
        dimension_counts(tidy).agg(
            F.min("period_date").alias("period_min"),
            F.max("period_date").alias("period_max"),
            F.count_distinct("period_yyyymm").alias("n_periods"),
            F.count_distinct("mineral").alias("n_minerales"),
            F.count_distinct(F.when(~is_total, F.col("departamento"))).alias("n_departamentos"),
            F.sort_array(F.collect_set("unidad")).alias("units"),
            F.lit(ok_max).alias("gap_ok_max_abs"),
            F.lit(warning_max).alias("gap_warning_max_abs"),
            *[
                F.coalesce(F.sum(F.when(kind, F.col("n_rows"))), F.lit(0)).alias(name)
                for name, kind in (("rows_tidy", F.lit(True)), ("rows_official", is_total), ("rows_detail", ~is_total))
            ],
        ),
        agg_mineral.agg(F.count("*").alias("rows_agg_mineral")),
        agg_departamento.agg(F.count("*").alias("rows_agg_departamento")),
        named(top_mineral_unit(tidy), "top_mineral_unit"),
        named(top_departamento(tidy), "top_departamento"),
        named(top_gap_mineral(agg_mineral), "top_gap_mineral"),
        gap_flag_counts(agg_mineral, ok_max, warning_max).select(
            *[F.col(c).alias(f"gap_{c}") for c in ("ok", "warning", "critical")]
        ),
        detail_outliers(tidy).agg(F.coalesce(F.sum("n_outliers"), F.lit(0)).alias("n_outliers_detail_iqr")),
    ]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])
