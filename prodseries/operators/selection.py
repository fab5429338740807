"""Model selection and the frozen operational forecast."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prodseries.functions.measures import month_index, nan_to_null, yyyymm
from prodseries.operators.forecast import (
    DYNAMIC_MODELS,
    MIN_TRAIN,
    SERIES,
    best_by_level,
    fit_series,
    model_ordinal,
    order_history,
    path_of,
    reason_of,
)
from prodseries.schemas import DEPARTMENT_LEVEL, FORECAST_CONTEXT, NATIONAL_LEVEL, require_columns

SELECTION_MODES = ["level_mae", "series_mae", "series_mae_dynamic"]
DYNAMIC_TOLERANCE_PCT = 10.0

# The default publication window.
WINDOW_START = date(2026, 2, 1)
WINDOW_END = date(2026, 12, 1)


def select_by_level(board: DataFrame) -> DataFrame:
    """``level -> model``: the level's best model by mean mae."""
    require_columns(board, ["level", "model", "mae_mean"], "leaderboard")
    for extra in ("rmse_mean", "mape_mean", "smape_mean"):
        if extra not in board.columns:
            board = board.withColumn(extra, F.lit(None).cast("double"))
    return best_by_level(board).select("level", F.col("best_model_by_mae").alias("level_model"))


def select_by_series(
    metrics: DataFrame, mode: str = "series_mae_dynamic", tolerance_pct: float = DYNAMIC_TOLERANCE_PCT
) -> DataFrame:
    """``(level, series_id) -> model`` by lowest (mae, rmse); unknown metrics count as infinite.

    In the dynamic mode a flat winner gives way to the best dynamic model whose mae is
    within the tolerance. Two infinite maes are within any tolerance of each other.
    """
    if mode not in ("series_mae", "series_mae_dynamic"):
        raise ValueError(f"Unsupported selection mode: {mode}")
    require_columns(metrics, [*SERIES, "model", "mae", "rmse"], "series metrics")
    infinite = F.lit(float("inf"))
    ranked = metrics.withColumn("mae", F.coalesce(nan_to_null(F.col("mae")), infinite)).withColumn(
        "rmse", F.coalesce(nan_to_null(F.col("rmse")), infinite)
    )
    model = F.col("model")
    rank = F.struct("mae", "rmse", model_ordinal(model))
    entry = F.struct("model", "mae")
    winners = ranked.groupBy(*SERIES).agg(
        F.min_by(entry, rank).alias("best"),
        F.min_by(entry, F.when(model.isin(DYNAMIC_MODELS), rank)).alias("dynamic"),
    )
    chosen = F.col("best.model")
    if mode == "series_mae_dynamic":
        acceptable = F.col("dynamic.mae") <= F.col("best.mae") * (1.0 + tolerance_pct / 100.0)
        flat = ~chosen.isin(DYNAMIC_MODELS)
        chosen = F.when(flat & acceptable, F.col("dynamic.model")).otherwise(chosen)
    return winners.select(*SERIES, chosen.alias("series_model"))


@dataclass(frozen=True)
class OperationalForecast:
    forecasts: DataFrame
    skipped: DataFrame


def operational_forecast(
    history: DataFrame,
    board: DataFrame,
    metrics: DataFrame | None = None,
    mode: str = "series_mae_dynamic",
    window_start: date | Column = WINDOW_START,
    window_end: date | Column = WINDOW_END,
    min_train: int = MIN_TRAIN,
    tolerance_pct: float = DYNAMIC_TOLERANCE_PCT,
) -> OperationalForecast:
    """Forecast every series with its selected model up to the window's end and keep the
    months inside the window. A model that cannot be fitted gives way to its level's model.
    """
    if mode not in SELECTION_MODES:
        raise ValueError(f"Unsupported selection mode: {mode}")
    start = window_start if isinstance(window_start, Column) else F.lit(window_start)
    end = window_end if isinstance(window_end, Column) else F.lit(window_end)

    levels = require_levels(select_by_level(board))
    state = fit_series(order_history(history), F.lit(0), []).join(levels, "level", "left")
    if mode == "level_mae":
        state = state.withColumn("series_model", F.lit(None).cast("string"))
    else:
        state = state.join(select_by_series(metrics, mode, tolerance_pct), SERIES, "left")

    fallback, primary = F.col("level_model"), F.coalesce("series_model", "level_model")
    horizon = month_index(end) - month_index(F.col("last_period"))
    judged = (
        state.withColumns({"horizon": horizon, "primary": primary})
        .withColumns({"primary_reason": reason_of("primary"), "fallback_reason": reason_of("level_model")})
        .withColumn("used", F.when(F.col("primary_reason").isNull(), primary).otherwise(fallback))
        .withColumn(
            "reason",
            F.when(
                F.col("n_rows") < min_train,
                F.concat(F.lit("insufficient_history(len="), F.col("n_rows").cast("string"), F.lit(")")),
            )
            .when(F.col("horizon") < 1, "no_future_window")
            .when(F.col("primary").isNull(), "no_selected_model")
            .when(
                F.col("primary_reason").isNotNull() & (primary == fallback), F.col("primary_reason")
            )
            .when(
                F.col("primary_reason").isNotNull() & F.col("fallback_reason").isNotNull(),
                F.concat(
                    F.lit("primary="), F.col("primary_reason"), F.lit("; fallback="), F.col("fallback_reason")
                ),
            ),
        )
    )
    # Before a model is tried, the log names the level's model; afterwards the tried one.
    untried = (F.col("n_rows") < min_train) | (F.col("horizon") < 1)
    skipped = judged.filter(F.col("reason").isNotNull()).select(
        *SERIES, F.when(untried, fallback).otherwise(F.col("primary")).alias("model"), "reason"
    )
    forecasts = (
        judged.filter(F.col("reason").isNull())
        .select(
            *FORECAST_CONTEXT,
            F.col("used").alias("selected_model"),
            F.col("last_period").alias("last_observed_period"),
            F.posexplode(path_of("used", "horizon")).alias("i", "forecast_value"),
        )
        .withColumn("forecast_period_date", F.add_months("last_observed_period", F.col("i") + 1))
        .filter(F.col("forecast_period_date") >= start)
        .select(
            *FORECAST_CONTEXT,
            "selected_model",
            "last_observed_period",
            "forecast_period_date",
            yyyymm(F.col("forecast_period_date")).alias("forecast_period_yyyymm"),
            "forecast_value",
        )
    )
    return OperationalForecast(forecasts, skipped)


def require_levels(selected: DataFrame) -> DataFrame:
    """Both levels must have a model; checked when the plan runs."""
    found = F.collect_set("level").alias("found")
    checked = selected.agg(found, F.collect_list(F.struct("level", "level_model")).alias("rows"))
    complete = F.array_contains("found", NATIONAL_LEVEL) & F.array_contains("found", DEPARTMENT_LEVEL)
    message = f"Leaderboard must contain both levels: {NATIONAL_LEVEL} and {DEPARTMENT_LEVEL}"
    rows = F.when(complete, F.col("rows")).otherwise(F.raise_error(F.lit(message)))
    return checked.select(F.inline(rows))


def window_months(start: date, end: date) -> list[str]:
    first, last = start.year * 12 + start.month - 1, end.year * 12 + end.month - 1
    return [f"{i // 12:04d}-{i % 12 + 1:02d}" for i in range(first, last + 1)]


def executive_table(forecasts: DataFrame, months: list[str] | None = None) -> DataFrame:
    """One row per series, one column per month, in order: the named ones, always all of them,
    or else those that the forecasts have."""
    return (
        forecasts.groupBy(*FORECAST_CONTEXT, "selected_model", "last_observed_period")
        .pivot("forecast_period_yyyymm", months)
        .agg(F.first("forecast_value", ignorenulls=True))
    )


def model_usage(forecasts: DataFrame) -> DataFrame:
    """Series per level and selected model."""
    return forecasts.groupBy("level", "selected_model").agg(F.count_distinct("series_id").alias("series_count"))


def series_coverage(forecasts: DataFrame) -> DataFrame:
    """Series with a forecast per level; a level without any counts 0."""
    counted = forecasts.agg(
        *[
            F.count_distinct(F.when(F.col("level") == level, F.col("series_id"))).alias(level)
            for level in (NATIONAL_LEVEL, DEPARTMENT_LEVEL)
        ]
    )
    return counted.select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(level).alias("level"), F.col(level).alias("series_count"))
                    for level in (NATIONAL_LEVEL, DEPARTMENT_LEVEL)
                ]
            )
        )
    )


FALLBACK_RULE = "lowest mean mae of the level"


def operational_report(
    operational: OperationalForecast, board: DataFrame, mode: str, tolerance_pct: float, start: Column, end: Column
) -> DataFrame:
    """What a freeze did, as one nested row: the rule, the window, the levels' models, rows of
    its outputs, and model usage and coverage in series. Every part is an aggregate of one row."""
    forecasts = operational.forecasts
    index = [*FORECAST_CONTEXT, "selected_model", "last_observed_period"]

    def listed(df: DataFrame, name: str) -> DataFrame:
        return df.agg(F.array_sort(F.collect_list(F.struct(*df.columns))).alias(name))

    rows = ["operational_forecast", "operational_executive", "operational_skipped"]
    tables = [forecasts, forecasts.select(*index).distinct(), operational.skipped]
    parts = [t.agg(F.count("*").alias(name)) for t, name in zip(tables, rows, strict=True)]
    parts += [
        listed(select_by_level(board), "selected_models"),
        listed(model_usage(forecasts), "model_usage"),
        listed(series_coverage(forecasts), "series_coverage"),
    ]
    # Laid side by side by stacking them with NULLs and taking the only value of each column.
    stacked = reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), parts)
    rule = {"mode": mode, "fallback": FALLBACK_RULE, "dynamic_tolerance_pct": tolerance_pct}
    months = (F.months_between(end, start) + 1).cast("int")
    return stacked.agg(*[F.max(c).alias(c) for c in stacked.columns]).select(
        F.struct(*[F.lit(v).alias(k) for k, v in rule.items()]).alias("selection_rule"),
        F.struct(start.alias("start"), end.alias("end"), months.alias("months")).alias("forecast_window"),
        F.struct(*rows).alias("rows"),
        "selected_models",
        "model_usage",
        "series_coverage",
    )
