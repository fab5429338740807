"""The monthly run: every stage reads its inputs from tables and writes its outputs as tables.

Stage tables live under one root, which has to be storage all executors share. They are what
cuts lineage between stages, so a lost executor repeats part of one stage at most.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from prodseries.operators import charts, cleaning, explore, features, forecast, publish, quality, selection, tidy
from prodseries.operators.snapshots import SnapshotTable
from prodseries.schemas import DEPARTMENT_LEVEL, GAP_OK_MAX, GAP_WARNING_MAX, NATIONAL_LEVEL
from prodseries.sources.tables import as_feature_table, as_operational_forecasts, series_history, write_ordered, write_report, write_table

PUBLISHED = {"facts": publish.FACTS, "aggregates": publish.AGGREGATES, "predictions": publish.PREDICTIONS}


class QualityError(ValueError):
    """The base table failed a quality rule; later stages must not run on it."""


@dataclass(frozen=True)
class Settings:
    source_dataset: str
    now: datetime | str
    horizon: int = forecast.HORIZON
    min_train: int = forecast.MIN_TRAIN
    selection_mode: str = "series_mae_dynamic"
    dynamic_tolerance_pct: float = selection.DYNAMIC_TOLERANCE_PCT
    window_start: date = selection.WINDOW_START
    window_end: date = selection.WINDOW_END
    load_strategy: str = "incremental"
    load_period: str | None = None
    dry_run: bool = False
    gap_ok_max: float = GAP_OK_MAX
    gap_warning_max: float = GAP_WARNING_MAX
    chart_level: str = DEPARTMENT_LEVEL
    chart_series: str | None = None
    chart_top_n: int = 6
    chart_window: int = 3


class MonthlyRun:
    def __init__(self, spark: SparkSession, root: str, settings: Settings):
        self.spark, self.root, self.settings = spark, root.rstrip("/"), settings

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def table(self, name: str) -> DataFrame:
        folder, _, own = name.partition("/")
        if folder == "published" and own in PUBLISHED:
            return self.published(own).rows()
        return self.spark.read.parquet(self.path(name))

    def published(self, name: str) -> SnapshotTable:
        return SnapshotTable(self.spark, self.path(f"published/{name}"), **PUBLISHED[name])

    def write(self, df: DataFrame, name: str) -> DataFrame:
        write_table(df, self.path(name))
        return self.table(name)

    def report(self, df: DataFrame, name: str) -> None:
        write_report(df, self.path(f"reports/{name}"))

    # ---------------------------------------------------------------------------- stages

    def clean(self, sheet: DataFrame) -> None:
        source = self.settings.source_dataset
        full = self.write(cleaning.clean_full(sheet, source), "interim/long_full")
        self.write(cleaning.clean_base(full), "interim/long_base")
        self.report(cleaning.cleaning_report(sheet, source), "cleaning")
        self.report(tidy.domain_values(full, ["mineral"]), "cleaning_minerals")

    def validate(self) -> None:
        rules = self.write(quality.validation_rules(self.table("interim/long_base")), "reports/validation_rules")
        self.write(quality.validation_failures(rules), "reports/validation_failures")
        self.write(quality.invalid_units(self.table("interim/long_base")), "reports/invalid_units")
        verdict = quality.validation_verdict(rules).first()
        if verdict["overall_status"] != "PASS":
            raise QualityError(f"{verdict['n_failed']} of {verdict['n_rules']} quality rules failed")

    def transform(self) -> None:
        base = self.table("interim/long_base")
        # In their order, so that a period's rows lie together and others are skipped by file statistics.
        write_ordered(tidy.tidy_observations(base), self.path("processed/tidy"), tidy.TIDY_ORDER)
        facts = self.table("processed/tidy")
        self.write(tidy.agg_mineral_period(facts), "processed/agg_mineral_period")
        self.write(tidy.agg_departamento_period(facts), "processed/agg_departamento_period")
        aggregates = [self.table(f"processed/agg_{name}_period") for name in ("mineral", "departamento")]
        self.report(tidy.transform_report(base, *aggregates), "transforms")
        self.report(tidy.domain_values(facts, ["unidad"]), "transform_units")

    def explore(self) -> None:
        facts, by_mineral = self.table("processed/tidy"), self.table("processed/agg_mineral_period")
        s = self.settings
        summary = explore.eda_summary(
            facts, by_mineral, self.table("processed/agg_departamento_period"), s.gap_ok_max, s.gap_warning_max
        )
        self.report(summary, "eda")
        self.write(explore.official_trend(facts), "reports/trend_official")
        self.write(explore.top_gap_minerals(by_mineral), "reports/gap_by_mineral")
        self.write(explore.top_departamentos(facts), "reports/top_departamentos")

    def build_features(self) -> None:
        facts = self.table("processed/tidy")
        national = self.write(features.national_features(facts), "processed/features_national")
        departamento = self.write(features.departamento_features(facts), "processed/features_departamento")
        self.report(features.feature_report(national, departamento, facts), "features")

    def history(self) -> DataFrame:
        return series_history(
            as_feature_table(self.table("processed/features_national"), NATIONAL_LEVEL),
            as_feature_table(self.table("processed/features_departamento"), DEPARTMENT_LEVEL),
        )

    def forecast(self) -> None:
        s = self.settings
        # One fit feeds five tables, so it is stored first.
        state = self.write(forecast.backtest_state(self.history(), s.horizon, s.min_train), "work/backtest_state")
        views = forecast.Backtest(state)
        self.write(views.predictions, "processed/eval_predictions")
        self.write(views.future, "processed/future_forecasts")
        metrics = self.write(views.metrics, "reports/metrics_by_series")
        board = self.write(forecast.sort_leaderboard(forecast.leaderboard(metrics)), "reports/leaderboard")
        self.write(views.skipped, "reports/skipped_series")
        self.report(forecast.best_by_level(board), "best_model_by_level")
        self.report(forecast.forecast_report(self.history(), views), "forecasting")

    def freeze(self) -> None:
        s = self.settings
        frozen = selection.operational_forecast(
            self.history(), self.table("reports/leaderboard"), self.table("reports/metrics_by_series"),
            s.selection_mode, s.window_start, s.window_end, s.min_train, s.dynamic_tolerance_pct,
        )
        forecasts = self.write(frozen.forecasts, "processed/operational_forecast")
        months = selection.window_months(s.window_start, s.window_end)
        self.write(selection.executive_table(forecasts, months), "processed/operational_executive")
        self.write(frozen.skipped, "reports/operational_skipped")
        self.report(selection.model_usage(forecasts), "model_usage")
        self.report(selection.series_coverage(forecasts), "series_coverage")
        stored = selection.OperationalForecast(forecasts, self.table("reports/operational_skipped"))
        report = selection.operational_report(
            stored, self.table("reports/leaderboard"), s.selection_mode, s.dynamic_tolerance_pct,
            F.lit(s.window_start), F.lit(s.window_end),
        )
        self.report(report, "operational_forecast")

    def publish_facts(self) -> dict[str, dict[str, int]]:
        s = self.settings
        facts = self.table("processed/tidy")
        tables = [facts, self.table("processed/agg_mineral_period"), self.table("processed/agg_departamento_period")]
        chosen, by_mineral, by_department = publish.select_load_rows(tables, facts, s.load_strategy, s.load_period)
        documents = publish.aggregate_documents(by_mineral, by_department, s.gap_ok_max, s.gap_warning_max)
        period = publish.selected_period(facts, s.load_strategy, s.load_period)
        n_aggregates = sum(t.count() for t in tables[1:])
        return {
            "facts": self._upsert("facts", publish.fact_documents(chosen), facts.count(), period),
            "aggregates": self._upsert("aggregates", documents, n_aggregates, period),
        }

    def publish_predictions(self) -> dict[str, int]:
        metadata = publish.selection_metadata(self.spark.read.json(self.path("reports/operational_forecast")))
        forecasts = as_operational_forecasts(self.table("processed/operational_forecast"))
        documents = publish.prediction_documents(forecasts, metadata)
        return self._upsert("predictions", documents, forecasts.count(), None)

    def _upsert(
        self, name: str, batch: DataFrame, n_input: int, period: Column | None
    ) -> dict[str, int]:
        """Check a batch against its contract, load it unless this is a dry run, and report."""
        # The batch is read more than once while its months are located and merged.
        stored = self.write(batch, f"work/published/{name}")
        self.write(
            quality.contract_violations(stored, name, quality.CONTRACTS[name]), f"reports/contract_{name}"
        )
        counters = dict.fromkeys(publish.COUNTERS, 0)
        if not self.settings.dry_run:
            counters = self.published(name).load(stored, self.settings.now)
        facts = {
            "collection": name,
            "strategy": self.settings.load_strategy,
            "dry_run": self.settings.dry_run,
            "input_rows": n_input,
            "selected_rows": stored.count(),
            **counters,
        }
        columns = [F.lit(v).alias(k) for k, v in facts.items()]
        covered = F.lit(None).cast("string") if period is None else period
        self.report(self.spark.range(0, 1, 1, 1).select(*columns, covered.alias("selected_period")), f"load_{name}")
        return counters

    def chart_data(self) -> None:
        s = self.settings
        forecasts = self.table("processed/operational_forecast")
        history = self.history()
        evaluation = self.write(
            charts.selected_evaluation(
                self.table("processed/eval_predictions"), forecasts, s.chart_level, s.chart_series
            ),
            "charts/evaluation",
        )
        if evaluation.isEmpty():
            raise ValueError("No evaluation rows found for selected series and model.")
        self.write(
            charts.history_and_forecast(history, forecasts, s.chart_level, s.chart_series), "charts/history_and_forecast"
        )
        self.write(charts.residuals(evaluation), "charts/residuals")
        self.write(charts.smoothed_trend(evaluation, s.chart_window), "charts/smoothed_trend")
        self.write(
            charts.category_lines(forecasts, s.chart_level, s.chart_series, s.chart_top_n), "charts/category_lines"
        )

    def run(self, sheet: DataFrame) -> dict[str, dict[str, int]]:
        """All stages in order; stops at a failed quality verdict."""
        self.clean(sheet)
        self.validate()
        self.transform()
        counters = self.publish_facts()
        self.explore()
        self.build_features()
        self.forecast()
        self.freeze()
        self.chart_data()
        counters["predictions"] = self.publish_predictions()
        return counters
