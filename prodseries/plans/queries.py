"""The query catalog: every operator applied to the star-schema tables.

Each query is ``(spark, sf_dir) -> DataFrame`` over whole tables. Ratios and fitted values
are rounded so that engines that add floating-point numbers in another order agree.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from prodseries.functions import text
from prodseries.functions.measures import month_index
from prodseries.operators import charts, cleaning, explore, features, forecast, publish, quality, selection, snapshots, tidy
from prodseries.schemas import DEPARTMENT_LEVEL, NATIONAL_LEVEL, SERIES_KEY
from prodseries.session import scratch_path
from prodseries.sources import sheets, star, tables

Query = Callable[[SparkSession, str], DataFrame]
CATALOG: dict[str, Query] = {}

FIRST_LOAD = "2025-01-01 00:00:00"
SECOND_LOAD = "2025-02-01 00:00:00"


def query(fn: Query) -> Query:
    CATALOG[fn.__name__] = fn
    return fn


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def _tidy(spark: SparkSession, sf: str) -> DataFrame:
    return tidy.tidy_observations(star.observations(spark, sf))


def _agg_mineral(spark: SparkSession, sf: str) -> DataFrame:
    return tidy.agg_mineral_period(_tidy(spark, sf))


def _history(spark: SparkSession, sf: str) -> DataFrame:
    return features.target_history(_tidy(spark, sf))


# ----------------------------------------------------------------- facts and aggregates


@query
def tidy_observations(spark, sf):
    return _tidy(spark, sf)


@query
def agg_mineral_period(spark, sf):
    return rounded(_agg_mineral(spark, sf), 6, "pct_gap_vs_total")


@query
def agg_departamento_period(spark, sf):
    return tidy.agg_departamento_period(_tidy(spark, sf))


@query
def gap_quality(spark, sf):
    flagged = tidy.with_gap_flag(_agg_mineral(spark, sf))
    return rounded(flagged, 6, "pct_gap_vs_total", "abs_pct_gap")


@query
def gap_flag_counts(spark, sf):
    return explore.gap_flag_counts(_agg_mineral(spark, sf))


@query
def transform_report(spark, sf):
    facts = _tidy(spark, sf)
    report = tidy.transform_report(
        star.observations(spark, sf), tidy.agg_mineral_period(facts), tidy.agg_departamento_period(facts)
    )
    return report.withColumn("units_detected", F.array_join("units_detected", ","))


@query
def domain_values(spark, sf):
    return tidy.domain_values(_tidy(spark, sf), ["mineral", "departamento", "unidad"])


# ---------------------------------------------------------------------- staged tables

@query
def ordered_tidy(spark, sf):
    """The facts in their order, which the files that hold them tell."""
    path = scratch_path(spark, "ordered-tidy")
    tables.write_ordered(_tidy(spark, sf), path, tidy.TIDY_ORDER)
    return tables.read_ordered(spark, path).select(*tidy.TIDY_ORDER, "value", "row_no")


@query
def staged_csv(spark, sf):
    """The facts written as text with a byte order mark and read back under their types."""
    facts, path = _tidy(spark, sf), scratch_path(spark, "staged-csv")
    tables.write_table(facts, path, "csv", bom=True)
    return tables.read_table(spark, path, facts.schema, "csv")


@query
def staged_features(spark, sf):
    """Both feature tables written as text and loaded as forecasting history."""
    facts = _tidy(spark, sf)
    built = {NATIONAL_LEVEL: features.national_features(facts), DEPARTMENT_LEVEL: features.departamento_features(facts)}
    loaded = []
    for level, table in built.items():
        path = scratch_path(spark, f"staged-{level}")
        tables.write_table(table, path, "csv")
        loaded.append(tables.as_feature_table(tables.read_table(spark, path, fmt="csv"), level))
    return tables.series_history(*loaded)


@query
def staged_forecasts(spark, sf):
    """Frozen forecasts written as text and loaded with their types."""
    path = scratch_path(spark, "staged-forecasts")
    tables.write_table(_operational(spark, sf).forecasts, path, "csv")
    return rounded(tables.as_operational_forecasts(tables.read_table(spark, path, fmt="csv")), 4, "forecast_value")


# ------------------------------------------------------------------------------- text


@query
def normalize_text_docs(spark, sf):
    damaged = F.concat("text", F.lit("  Producci�n seg�n  Jun�n x�y Esta�o "))
    return star.table(spark, sf, "documents").select("doc_id", text.normalize_text(damaged).alias("text"))


@query
def strip_accents_docs(spark, sf):
    return star.table(spark, sf, "documents").select("doc_id", text.strip_accents(F.col("text")).alias("text"))


# --------------------------------------------------------------------------- cleaning


@query
def raw_wide_to_long(spark, sf):
    return sheets.sheet_to_long(star.raw_sheet(spark, sf)).select(
        "row_ord", "col_ord", "period_raw", "series_code", "series_description", "value_raw"
    )


@query
def sheet_files(spark, sf):
    """The sheet written as a folder of delimited files and read back."""
    path = scratch_path(spark, "sheet")
    sheets.write_sheet(star.raw_sheet(spark, sf), path, files=3)
    return sheets.sheet_to_long(sheets.read_sheet(spark, path)).select(
        "row_ord", "col_ord", "period_raw", "series_code", "series_description", "value_raw"
    )


@query
def parse_period_tokens(spark, sf):
    tokens = star.raw_sheet(spark, sf).filter("row_ord >= 2").select("row_ord", F.get("cells", 0).alias("token"))
    return tokens.withColumn("period_date", text.parse_period(F.col("token")))


@query
def parse_series_metadata(spark, sf):
    return sheets.sheet_series(star.raw_sheet(spark, sf))


@query
def parse_numeric_tokens(spark, sf):
    cells = sheets.sheet_to_long(star.raw_sheet(spark, sf))
    return cells.select("row_ord", "col_ord", "value_raw", text.parse_numeric(F.col("value_raw")).alias("p")).select(
        "row_ord", "col_ord", "value_raw", "p.*"
    )


@query
def clean_full(spark, sf):
    return cleaning.clean_full(star.raw_sheet(spark, sf), "raw_sheet")


@query
def clean_base(spark, sf):
    return cleaning.clean_base(cleaning.clean_full(star.raw_sheet(spark, sf), "raw_sheet"))


@query
def cleaning_report(spark, sf):
    return cleaning.cleaning_report(star.raw_sheet(spark, sf), "raw_sheet")


# ---------------------------------------------------------------------------- quality


@query
def validation_rules(spark, sf):
    return quality.validation_rules(star.faulty_observations(spark, sf))


@query
def validation_failures(spark, sf):
    return quality.validation_failures(quality.validation_rules(star.faulty_observations(spark, sf)))


@query
def validation_verdict(spark, sf):
    return quality.validation_verdict(quality.validation_rules(star.observations(spark, sf)))


@query
def validation_column_difference(spark, sf):
    reshaped = star.observations(spark, sf).withColumnRenamed("unidad", "unit").drop("value_raw")
    return quality.validation_rules(reshaped)


@query
def duplicate_keys(spark, sf):
    return quality.duplicate_keys(star.faulty_observations(spark, sf), SERIES_KEY)


@query
def invalid_units(spark, sf):
    return quality.invalid_units(star.faulty_observations(spark, sf))


@query
def contract_violations(spark, sf):
    faulty = tidy.tidy_observations(star.faulty_observations(spark, sf))
    facts = quality.contract_violations(publish.fact_documents(faulty), "facts", quality.FACT_CONTRACT)
    documents = publish.aggregate_documents(
        tidy.agg_mineral_period(faulty), tidy.agg_departamento_period(faulty)
    )
    return facts.unionByName(quality.contract_violations(documents, "aggregates", quality.AGGREGATE_CONTRACT))


@query
def prediction_contract_violations(spark, sf):
    documents = publish.prediction_documents(_operational(spark, sf).forecasts)
    return quality.contract_violations(documents, "predictions", quality.PREDICTION_CONTRACT)


# ------------------------------------------------------------------------ exploration


@query
def top_mineral_unit(spark, sf):
    return explore.top_mineral_unit(_tidy(spark, sf))


@query
def top_departamento(spark, sf):
    return explore.top_departamento(_tidy(spark, sf))


@query
def top_gap_mineral(spark, sf):
    return rounded(explore.top_gap_mineral(_agg_mineral(spark, sf)), 6, "value")


@query
def top_gap_minerals(spark, sf):
    return rounded(explore.top_gap_minerals(_agg_mineral(spark, sf)), 6, "avg_abs_pct_gap")


@query
def top_departamentos(spark, sf):
    return explore.top_departamentos(_tidy(spark, sf))


@query
def mineral_unit_totals(spark, sf):
    return explore.mineral_unit_totals(_tidy(spark, sf))


@query
def iqr_outliers(spark, sf):
    return explore.detail_outliers(_tidy(spark, sf))


@query
def official_trend(spark, sf):
    return explore.official_trend(_tidy(spark, sf))


@query
def trend_pivot(spark, sf):
    pivoted = explore.trend_pivot(_tidy(spark, sf))
    return pivoted.withColumnsRenamed({m: m.replace("#", "_") for m in pivoted.columns})


@query
def eda_summary(spark, sf):
    facts = _tidy(spark, sf)
    summary = explore.eda_summary(facts, tidy.agg_mineral_period(facts), tidy.agg_departamento_period(facts))
    return rounded(summary, 6, "top_gap_mineral_value").withColumn("units", F.array_join("units", ","))


# --------------------------------------------------------------------------- features

FITTED = (
    ["month_sin", "month_cos", "quarter_sin", "quarter_cos", "mom_pct", "yoy_pct"]
    + [f"roll_{s}_{w}" for s in ("mean", "std") for w in features.WINDOWS]
)


@query
def national_features(spark, sf):
    return rounded(features.national_features(_tidy(spark, sf)), 6, *FITTED)


@query
def departamento_features(spark, sf):
    return rounded(features.departamento_features(_tidy(spark, sf)), 6, *FITTED)


@query
def feature_report(spark, sf):
    facts = _tidy(spark, sf)
    return features.feature_report(features.national_features(facts), features.departamento_features(facts), facts)


# ------------------------------------------------------------------------- forecasting


@query
def train_test_split(spark, sf):
    return forecast.split_train_test(_history(spark, sf)).select("level", "series_id", "period_date", "target_value", "split")


@query
def forecast_naive(spark, sf):
    return forecast.forecast_with(_history(spark, sf), "naive")


@query
def forecast_moving_average(spark, sf):
    return rounded(forecast.forecast_with(_history(spark, sf), "moving_average"), 6, "forecast_value")


@query
def forecast_seasonal_ar(spark, sf):
    return rounded(forecast.forecast_with(_history(spark, sf), "seasonal_ar", 12), 4, "forecast_value")


@query
def forecast_trend_seasonal(spark, sf):
    return rounded(forecast.forecast_with(_history(spark, sf), "trend_seasonal", 12), 4, "forecast_value")


@query
def forecast_seasonal_arma(spark, sf):
    return rounded(forecast.forecast_with(_history(spark, sf), "seasonal_arma", 12), 3, "forecast_value")


@query
def forecast_trend_changepoints(spark, sf):
    return rounded(forecast.forecast_with(_history(spark, sf), "trend_changepoints", 12), 3, "forecast_value")


@query
def leaderboard_of_all_models(spark, sf):
    metrics = forecast.backtest(_history(spark, sf), models=list(forecast.MODELS)).metrics
    return rounded(forecast.leaderboard(metrics), 3, *[f"{m}_mean" for m in ("mae", "rmse", "mape", "smape")])


@query
def backtest_predictions(spark, sf):
    return rounded(forecast.backtest(_history(spark, sf)).predictions, 4, "y_pred", "abs_error")


@query
def backtest_metrics(spark, sf):
    return rounded(forecast.backtest(_history(spark, sf)).metrics, 4, "mae", "rmse", "mape", "smape")


@query
def leaderboard(spark, sf):
    board = forecast.leaderboard(forecast.backtest(_history(spark, sf)).metrics)
    return rounded(forecast.sort_leaderboard(board), 4, *[f"{m}_mean" for m in ("mae", "rmse", "mape", "smape")])


@query
def best_by_level(spark, sf):
    best = forecast.best_by_level(forecast.leaderboard(forecast.backtest(_history(spark, sf)).metrics))
    return rounded(best, 4, *[f"{m}_mean" for m in ("mae", "rmse", "mape", "smape")])


@query
def future_forecasts(spark, sf):
    return rounded(forecast.backtest(_history(spark, sf)).future, 4, "forecast_value")


# Long enough that part of the series falls short of it at every scale.
STRICT_MIN_TRAIN = 80


@query
def skipped_series(spark, sf):
    return forecast.backtest(_history(spark, sf), min_train=STRICT_MIN_TRAIN).skipped


# So long that what is left to train on is too short for a season.
LONG_HORIZON, SHORT_TRAIN = 60, 10


@query
def skipped_models(spark, sf):
    """Models that cannot be fitted to a series that others are fitted to, and series without any."""
    return forecast.backtest(_history(spark, sf), LONG_HORIZON, SHORT_TRAIN).skipped


@query
def forecast_report(spark, sf):
    history = _history(spark, sf)
    return forecast.forecast_report(history, forecast.backtest(history))


# --------------------------------------------------------------------------- selection


@query
def select_level(spark, sf):
    board = forecast.leaderboard(forecast.backtest(_history(spark, sf)).metrics)
    return selection.select_by_level(board)


@query
def select_series(spark, sf):
    metrics = forecast.backtest(_history(spark, sf)).metrics
    return selection.select_by_series(metrics, "series_mae")


@query
def select_series_dynamic(spark, sf):
    metrics = forecast.backtest(_history(spark, sf)).metrics
    return selection.select_by_series(metrics, "series_mae_dynamic")


def _window(spark: SparkSession, sf: str) -> tuple[Column, Column]:
    """From two to twelve months after the last observed month."""
    last = star.last_month(spark, sf).scalar()
    return F.add_months(last, 2), F.add_months(last, 12)


@dataclass(frozen=True)
class Stages:
    history: DataFrame
    backtest: forecast.Backtest
    operational: selection.OperationalForecast

    @property
    def forecasts(self) -> DataFrame:
        return self.operational.forecasts


def _operational(
    spark: SparkSession, sf: str, mode: str = "series_mae_dynamic", min_train: int = forecast.MIN_TRAIN
) -> Stages:
    history = _history(spark, sf)
    views = forecast.backtest(history)
    metrics = views.metrics
    start, end = _window(spark, sf)
    frozen = selection.operational_forecast(
        history, forecast.leaderboard(metrics), metrics, mode, start, end, min_train
    )
    return Stages(history, views, frozen)


@query
def operational_forecast(spark, sf):
    return rounded(_operational(spark, sf).forecasts, 4, "forecast_value")


@query
def operational_forecast_by_level(spark, sf):
    return rounded(_operational(spark, sf, "level_mae").forecasts, 4, "forecast_value")


@query
def operational_skipped(spark, sf):
    return _operational(spark, sf, min_train=STRICT_MIN_TRAIN + 2).operational.skipped


@query
def executive_pivot(spark, sf):
    table = selection.executive_table(_operational(spark, sf).forecasts)
    names = {m: "m_" + m.replace("-", "_") for m in table.columns if m[0].isdigit()}
    return rounded(table.withColumnsRenamed(names), 4, *names.values())


@query
def model_usage(spark, sf):
    return selection.model_usage(_operational(spark, sf).forecasts)


@query
def series_coverage(spark, sf):
    return selection.series_coverage(_operational(spark, sf).forecasts)


def _operational_report(spark: SparkSession, sf: str) -> DataFrame:
    stages = _operational(spark, sf)
    board = forecast.leaderboard(stages.backtest.metrics)
    return selection.operational_report(
        stages.operational, board, "series_mae_dynamic", selection.DYNAMIC_TOLERANCE_PCT, *_window(spark, sf)
    )


@query
def operational_report(spark, sf):
    report = _operational_report(spark, sf)
    listed = {
        "selected_models": ["level", "level_model"],
        "model_usage": ["level", "selected_model", "series_count"],
        "series_coverage": ["level", "series_count"],
    }

    def said(name: str) -> Column:
        return F.array_join(F.transform(name, lambda x: F.concat_ws(":", *[x[c].cast("string") for c in listed[name]])), ",")

    return report.select(
        "selection_rule.mode", "selection_rule.dynamic_tolerance_pct",
        *[F.col(f"forecast_window.{c}").alias(f"window_{c}") for c in ("start", "end", "months")],
        "rows.*", *[said(name).alias(name) for name in listed],
    )


# -------------------------------------------------------------------------- publishing


@query
def select_load_rows(spark, sf):
    facts = _tidy(spark, sf)
    tables = [facts, tidy.agg_mineral_period(facts), tidy.agg_departamento_period(facts)]
    chosen = publish.select_load_rows(tables, facts, "incremental")
    names = ["tidy", "agg_mineral", "agg_departamento"]
    counts = [
        t.groupBy("period_yyyymm").agg(F.count("*").alias("n_rows")).withColumn("table_name", F.lit(n))
        for t, n in zip(chosen, names)
    ]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


def _months_before_last(spark: SparkSession, sf: str) -> Column:
    last = star.last_month(spark, sf).scalar()
    return month_index(last) - month_index(F.col("period_date"))


def _fact_merge(spark: SparkSession, sf: str) -> DataFrame:
    """A snapshot of preliminary values up to three months ago, merged with the last six."""
    facts = publish.fact_documents(_tidy(spark, sf))
    age = _months_before_last(spark, sf)
    preliminary = facts.filter(age >= 3).withColumn("value", F.floor(F.col("value") / 10) * 10.0)
    snapshot = publish.first_load(preliminary, FIRST_LOAD)
    return publish.upsert(snapshot, facts.filter(age < 6), publish.FACTS["keys"], SECOND_LOAD)


@query
def upsert_facts(spark, sf):
    return _fact_merge(spark, sf)


@query
def upsert_facts_counters(spark, sf):
    return publish.upsert_counters(_fact_merge(spark, sf))


@query
def upsert_aggregates(spark, sf):
    facts = _tidy(spark, sf)
    documents = publish.aggregate_documents(tidy.agg_mineral_period(facts), tidy.agg_departamento_period(facts))
    age = _months_before_last(spark, sf)
    snapshot = publish.first_load(documents.filter(age >= 3), FIRST_LOAD)
    # The second load carries no counts, so matched rows keep theirs.
    batch = documents.filter(age < 6).drop("n_departamentos", "n_minerales")
    return rounded(
        publish.upsert(snapshot, batch, now=SECOND_LOAD, **publish.AGGREGATES), 6, "pct_gap_vs_total"
    )


def _stored(df: DataFrame, label: str) -> DataFrame:
    """A batch as a stored table: a load reads it for its months and then for its rows."""
    path = scratch_path(df.sparkSession, label)
    tables.write_table(df, path)
    return df.sparkSession.read.parquet(path)


def _two_loads(spark: SparkSession, table: dict, first: DataFrame, second: DataFrame) -> DataFrame:
    stored = snapshots.SnapshotTable(spark, scratch_path(spark, "snapshots"), **table)
    stored.load(_stored(first, "first-batch"), FIRST_LOAD)
    stored.load(_stored(second, "second-batch"), SECOND_LOAD)
    return stored.rows()


@query
def versioned_facts(spark, sf):
    """The two loads of ``upsert_facts`` into a table of versions, as it then stands."""
    facts = publish.fact_documents(_tidy(spark, sf))
    age = _months_before_last(spark, sf)
    preliminary = facts.filter(age >= 3).withColumn("value", F.floor(F.col("value") / 10) * 10.0)
    return _two_loads(spark, publish.FACTS, preliminary, facts.filter(age < 6))


@query
def versioned_aggregates(spark, sf):
    """The two loads of ``upsert_aggregates``, whose keys may be NULL in part."""
    facts = _tidy(spark, sf)
    documents = publish.aggregate_documents(tidy.agg_mineral_period(facts), tidy.agg_departamento_period(facts))
    age = _months_before_last(spark, sf)
    batch = documents.filter(age < 6).drop("n_departamentos", "n_minerales")
    return rounded(_two_loads(spark, publish.AGGREGATES, documents.filter(age >= 3), batch), 6, "pct_gap_vs_total")


@query
def streamed_facts(spark, sf):
    """Fact documents that arrive file by file, loaded by a stream that takes each batch once."""
    source, checkpoint = scratch_path(spark, "arrivals"), scratch_path(spark, "stream")
    documents = publish.fact_documents(_tidy(spark, sf))
    documents.repartitionByRange(4, "period_date", "series_code").write.parquet(source)
    stored = snapshots.SnapshotTable(spark, scratch_path(spark, "snapshots"), **publish.FACTS)
    arriving = spark.readStream.schema(documents.schema).option("maxFilesPerTrigger", 2).parquet(source)
    load = stored.loader("facts", lambda batch_id: FIRST_LOAD)
    arriving.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return stored.rows()


def _flat(documents: DataFrame) -> DataFrame:
    """Nested fields as plain columns, points as text."""
    point = lambda p: F.concat_ws(
        ":", p["forecast_period_yyyymm"], F.format_string("%.3f", p["forecast_value"])
    )
    stats = [
        F.col("forecast_stats.n_points").alias("n_points"),
        *[F.round(f"forecast_stats.{c}", 4).alias(c) for c in ("min_value", "max_value", "mean_value")],
        F.col("forecast_stats.is_flat_forecast").alias("is_flat_forecast"),
    ]
    return documents.select(
        *[c for c in documents.columns if c not in ("forecasts", "forecast_stats", "source")],
        F.array_join(F.transform("forecasts", point), ";").alias("points"),
        *stats,
        F.col("source.phase").alias("source_phase"),
        F.col("source.selection_mode").alias("source_selection_mode"),
    )


def _documents(spark: SparkSession, sf: str) -> DataFrame:
    return publish.prediction_documents(
        _operational(spark, sf).forecasts, {"selection_mode": "series_mae_dynamic"}
    )


@query
def prediction_documents(spark, sf):
    return _flat(_documents(spark, sf))


@query
def document_lineage(spark, sf):
    """Documents with the settings that the stored report of their forecasts recorded."""
    path = scratch_path(spark, "operational-report")
    tables.write_report(_operational_report(spark, sf), path)
    recorded = publish.selection_metadata(spark.read.json(path))
    documents = publish.prediction_documents(_operational(spark, sf).forecasts, recorded)
    return documents.select("prediction_id", "forecast_stats.n_points", "source.phase", "source.selection_mode", "source.dynamic_tolerance_pct")


@query
def prediction_doc_summary(spark, sf):
    return publish.prediction_summary(_documents(spark, sf))


@query
def upsert_predictions(spark, sf):
    documents = _documents(spark, sf)
    snapshot = publish.first_load(documents.filter(F.col("level") == DEPARTMENT_LEVEL), FIRST_LOAD)
    batch = documents.filter((F.col("level") == NATIONAL_LEVEL) | F.col("mineral").endswith("1"))
    # All documents share one window, so there are no untouched months to set aside.
    merged = publish.upsert(snapshot, batch, publish.PREDICTIONS["keys"], SECOND_LOAD)
    return merged.select(
        "prediction_id", "model", "level", "series_id", "forecast_window_start", "forecast_window_end",
        "forecast_window_months", "ingested_at", "updated_at", "write_status",
    )


# ------------------------------------------------------------------------------ charts


@query
def history_and_forecast(spark, sf):
    stages = _operational(spark, sf)
    series = charts.history_and_forecast(stages.history, stages.forecasts)
    return rounded(series, 4, "value")


def _evaluation(spark: SparkSession, sf: str) -> DataFrame:
    stages = _operational(spark, sf)
    return charts.selected_evaluation(stages.backtest.predictions, stages.forecasts)


@query
def residuals(spark, sf):
    return rounded(charts.residuals(_evaluation(spark, sf)), 4, "predicted", "residual")


@query
def smoothed_trend(spark, sf):
    return rounded(charts.smoothed_trend(_evaluation(spark, sf)), 4, "predicted", "actual_trend", "predicted_trend")


@query
def category_lines(spark, sf):
    return rounded(charts.category_lines(_operational(spark, sf).forecasts), 4, "value")


@query
def category_lines_national(spark, sf):
    lines = charts.category_lines(_operational(spark, sf).forecasts, NATIONAL_LEVEL, top_n=4)
    return rounded(lines, 4, "value")
