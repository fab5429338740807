"""Series targets and the lag, rolling and lead features built on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from prodseries.functions.measures import cycle, growth
from prodseries.operators.tidy import first_official
from prodseries.schemas import DEPARTMENT_LEVEL, NATIONAL_LEVEL

LAGS = [1, 2, 3, 6, 12]
WINDOWS = [3, 6, 12]
HORIZONS = [1, 2, 3]

PERIOD = ["period_date", "period_yyyymm", "year", "month", "quarter", "semester"]


def series_targets(tidy: DataFrame) -> DataFrame:
    """Monthly target of every series of both levels, from one pass over the facts.

    National series take the first official value of the month, department series the sum
    of their detail.
    """
    is_total, value = F.col("is_total_departamento"), F.col("value")
    # The most selective keys lead: the rest follow from them and are rarely compared.
    keys = ["period_date", "mineral", "departamento", "unidad", "level", *PERIOD[1:]]
    keyed = tidy.select(
        *PERIOD,
        F.when(is_total, NATIONAL_LEVEL).otherwise(DEPARTMENT_LEVEL).alias("level"),
        "mineral",
        # The official spelling may vary in case; the series is national either way.
        F.when(is_total, "Total").otherwise(F.col("departamento")).alias("departamento"),
        F.col("departamento").alias("spelling"),
        "unidad",
        "series_code",
        "value",
    ).dropna(subset=keys)
    national = F.col("level") == NATIONAL_LEVEL
    grouped = keyed.groupBy(*keys).agg(
        first_official(value, F.lit(True), "spelling").alias("first_value"),
        F.coalesce(F.sum("value"), F.lit(0.0)).alias("sum_value"),
    )
    return grouped.select(
        *keys,
        F.when(national, F.concat_ws("|", "mineral", "unidad"))
        .otherwise(F.concat_ws("|", "mineral", "departamento", "unidad"))
        .alias("series_id"),
        F.when(national, F.col("first_value")).otherwise(F.col("sum_value")).alias("target_value"),
    )


def add_calendar_features(df: DataFrame) -> DataFrame:
    month_sin, month_cos = cycle(F.col("month"), 12)
    quarter_sin, quarter_cos = cycle(F.col("quarter"), 4)
    return df.withColumns(
        {
            "month_sin": month_sin,
            "month_cos": month_cos,
            "quarter_sin": quarter_sin,
            "quarter_cos": quarter_cos,
            "is_year_start": F.coalesce(F.col("month") == 1, F.lit(False)),
            "is_year_end": F.coalesce(F.col("month") == 12, F.lit(False)),
        }
    )


def add_series_features(df: DataFrame, group_cols: list[str], target: str = "target_value") -> DataFrame:
    """Positional features within each series, all over one partitioning and one sort.

    Lags count rows, not months: a missing month shifts them. Rolling frames end at the
    previous row.
    """
    series = Window.partitionBy(*group_cols).orderBy("period_date")
    y = F.col(target)
    columns: dict[str, Column] = {"series_index": F.row_number().over(series) - 1}
    for k in LAGS:
        columns[f"lag_{k}"] = F.lag(target, k).over(series)
    for w in WINDOWS:
        frame = series.rowsBetween(-w, -1)
        columns[f"roll_mean_{w}"] = F.avg(target).over(frame)
        columns[f"roll_std_{w}"] = F.stddev_samp(target).over(frame)
        columns[f"roll_min_{w}"] = F.min(target).over(frame)
        columns[f"roll_max_{w}"] = F.max(target).over(frame)
    for h in HORIZONS:
        columns[f"target_t_plus_{h}"] = F.lead(target, h).over(series)
    lag_1, lag_12 = F.col("lag_1"), F.col("lag_12")
    return df.withColumns(columns).withColumns(
        {
            "diff_lag_1": y - lag_1,
            "diff_lag_12": y - lag_12,
            "mom_pct": growth(y, lag_1),
            "yoy_pct": growth(y, lag_12),
            "ready_for_model_h1": lag_12.isNotNull() & F.col("target_t_plus_1").isNotNull(),
            "ready_for_model_h3": lag_12.isNotNull() & F.col("target_t_plus_3").isNotNull(),
        }
    )


def national_features(tidy: DataFrame) -> DataFrame:
    targets = series_targets(tidy).filter(F.col("level") == NATIONAL_LEVEL).drop("level", "departamento")
    return add_series_features(add_calendar_features(targets), ["mineral", "unidad"])


def departamento_features(tidy: DataFrame) -> DataFrame:
    targets = series_targets(tidy).filter(F.col("level") == DEPARTMENT_LEVEL).drop("level")
    return add_series_features(add_calendar_features(targets), ["mineral", "departamento", "unidad"])


def target_history(tidy: DataFrame) -> DataFrame:
    """Both levels' targets as forecasting history, without building feature columns."""
    return series_targets(tidy).filter(F.col("target_value").isNotNull())


def feature_report(national: DataFrame, departamento: DataFrame, tidy: DataFrame | None = None) -> DataFrame:
    """One row of coverage counters per level, with the rows of the tidy table they come from
    where it is given."""

    def report(df: DataFrame, level: str) -> DataFrame:
        return df.agg(
            F.lit(level).alias("level"),
            F.count("*").alias("n_rows"),
            F.count_distinct("series_id").alias("n_series"),
            F.count_if("ready_for_model_h1").alias("ready_h1_rows"),
            F.count_if("ready_for_model_h3").alias("ready_h3_rows"),
            F.min("period_date").alias("period_min"),
            F.max("period_date").alias("period_max"),
        )

    both = report(national, NATIONAL_LEVEL).unionByName(report(departamento, DEPARTMENT_LEVEL))
    if tidy is None:
        return both
    return both.withColumn("rows_input_tidy", tidy.agg(F.count("*")).scalar())
