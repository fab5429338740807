"""Datasets behind the forecast charts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from prodseries.operators.explore import top
from prodseries.schemas import DEPARTMENT_LEVEL, NATIONAL_LEVEL


def pick_series(forecasts: DataFrame, level: str, requested: str | None = None) -> DataFrame:
    """The requested series, or the one with the highest total forecast, with its descriptors.

    Always one row. Fails when the plan runs if the level has no forecasts or the series is
    not among them.
    """
    candidates = forecasts.filter(F.col("level") == level)
    message = f"No operational forecasts found for level={level}"
    if requested is not None:
        candidates = candidates.filter(F.col("series_id") == requested)
        message = f"Requested series_id not found in operational forecasts: {requested}"
    described = ["selected_model", "mineral", "departamento", "unidad"]
    totals = candidates.groupBy("level", "series_id").agg(
        F.sum("forecast_value").alias("total_forecast"),
        # A series is described by its first forecast row.
        F.min_by(F.struct(*described), "forecast_period_date").alias("first_row"),
    )
    best = top(totals, "total_forecast", ["series_id"], 1)
    return best.agg(F.first(F.struct("level", "series_id", "first_row.*")).alias("best")).select(
        F.coalesce("best.level", F.raise_error(F.lit(message)).cast("string")).alias("level"),
        *[F.col(f"best.{c}").alias(c) for c in ["series_id", *described]],
    )


def _of_picked(df: DataFrame, picked: DataFrame, *columns: str) -> DataFrame:
    # The picked side is one row.
    return df.join(F.broadcast(picked.select(*columns)), [*columns], "left_semi")


def history_and_forecast(
    history: DataFrame, forecasts: DataFrame, level: str = DEPARTMENT_LEVEL, requested: str | None = None
) -> DataFrame:
    """Observed and forecast months of one series on one axis."""
    picked = pick_series(forecasts, level, requested)
    observed = _of_picked(history, picked, "level", "series_id").select(
        F.lit("history").alias("kind"), "series_id", F.col("period_date").alias("date"),
        F.col("target_value").alias("value"),
    )
    expected = _of_picked(forecasts, picked, "level", "series_id").select(
        F.lit("forecast").alias("kind"), "series_id", F.col("forecast_period_date").alias("date"),
        F.col("forecast_value").alias("value"),
    )
    return observed.unionByName(expected)


def selected_evaluation(
    predictions: DataFrame, forecasts: DataFrame, level: str = DEPARTMENT_LEVEL, requested: str | None = None
) -> DataFrame:
    """Backtest rows of one series under the model selected for it."""
    picked = pick_series(forecasts, level, requested).withColumnRenamed("selected_model", "model")
    return _of_picked(predictions, picked, "level", "series_id", "model").select(
        "series_id", "model", F.col("period_date").alias("date"),
        F.col("y_true").alias("actual"), F.col("y_pred").alias("predicted"),
    )


def residuals(evaluation: DataFrame) -> DataFrame:
    return evaluation.withColumn("residual", F.col("actual") - F.col("predicted"))


def smoothed_trend(evaluation: DataFrame, window: int = 3) -> DataFrame:
    """Trailing means that include the current row, shorter at the start."""
    frame = Window.partitionBy("series_id", "model").orderBy("date").rowsBetween(-(window - 1), 0)
    return evaluation.withColumn("actual_trend", F.avg("actual").over(frame)).withColumn(
        "predicted_trend", F.avg("predicted").over(frame)
    )


def category_lines(
    forecasts: DataFrame, level: str = DEPARTMENT_LEVEL, requested: str | None = None, top_n: int = 6
) -> DataFrame:
    """Forecast lines of the n minerals with the highest totals.

    The department view takes every row of the picked series' department, whatever its
    level; the national view takes the national level. Totals add up across units.
    """
    if level == DEPARTMENT_LEVEL:
        source = _of_picked(forecasts, pick_series(forecasts, level, requested), "departamento")
    else:
        source = forecasts.filter(F.col("level") == NATIONAL_LEVEL)
    totals = (
        source.dropna(subset=["mineral"]).groupBy("mineral").agg(F.sum("forecast_value").alias("total_value"))
    )
    # At most top_n names.
    leaders = F.broadcast(top(totals, "total_value", ["mineral"], top_n).select("mineral"))
    return source.join(leaders, "mineral", "left_semi").select(
        F.col("forecast_period_date").alias("date"), F.col("mineral").alias("category"),
        F.col("forecast_value").alias("value"),
    )
