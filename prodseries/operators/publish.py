"""Documents and idempotent upserts into snapshot tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from prodseries.functions import measures as m
from prodseries.functions.text import optional_text
from prodseries.schemas import (
    AGGREGATE_KEY,
    DEPARTMENT_AGGREGATE,
    DOCUMENT_VERSION,
    GAP_OK_MAX,
    GAP_WARNING_MAX,
    MINERAL_AGGREGATE,
    PREDICTION_KEY,
    SERIES_KEY,
)

STRATEGIES = ["incremental", "full_refresh"]
FLAT_TOLERANCE = 1e-12
# Settings a forecast report may have recorded.
SOURCE_FIELDS = {"selection_mode": "string", "dynamic_tolerance_pct": "double"}


def as_timestamp(now: datetime | str | Column) -> Column:
    """The load time is always an argument, so a load can be repeated exactly."""
    if isinstance(now, Column):
        return now
    text = now.strftime("%Y-%m-%d %H:%M:%S.%f") if isinstance(now, datetime) else now
    return F.lit(text).cast("timestamp_ntz")


# ------------------------------------------------------------------- load selection


def selected_period(tidy: DataFrame, strategy: str, period: str | None = None) -> Column | None:
    """The period a load covers: a value, or NULL-free scalar subquery; None means all."""
    if strategy not in STRATEGIES:
        raise ValueError(f"Unsupported strategy: {strategy}")
    if period is not None:
        return F.lit(period)
    if strategy == "full_refresh":
        return None
    latest = tidy.agg(
        F.coalesce(
            F.max("period_yyyymm"),
            F.raise_error(F.lit("No periods found in tidy dataset for incremental loading")).cast("string"),
        ).alias("period_yyyymm")
    )
    return latest.scalar()


def select_load_rows(
    tables: list[DataFrame], tidy: DataFrame, strategy: str, period: str | None = None
) -> list[DataFrame]:
    """Restrict every table to the load's period. The newest period is a scalar subquery, so
    it reaches the scans as an ordinary predicate."""
    wanted = selected_period(tidy, strategy, period)
    return [t if wanted is None else t.filter(F.col("period_yyyymm") == wanted) for t in tables]


# ------------------------------------------------------------------------ documents


def fact_documents(tidy: DataFrame) -> DataFrame:
    """Fact rows as they are published; rows without a key are left out."""
    text = [
        "record_id", "period_yyyymm", "series_code", "series_description", "mineral", "departamento",
        "unidad", "source_dataset", "metric_level", "area_geografica",
    ]
    whole = ["year", "month", "quarter", "semester"]
    flags = ["is_total_departamento", "is_missing", "is_invalid_numeric"]
    return tidy.select(
        F.to_date("period_date").alias("period_date"),
        *[optional_text(F.col(c)).alias(c) for c in text],
        *[F.col(c).cast("int").alias(c) for c in whole],
        m.nan_to_null(F.col("value")).alias("value"),
        *flags,
        F.lit(DOCUMENT_VERSION).alias("schema_version"),
    ).dropna(subset=SERIES_KEY)


def _text_or_none(c: str) -> Column:
    # Identifiers spell an absent part as the word None.
    return F.coalesce(optional_text(F.col(c)), F.lit("None"))


def aggregate_documents(
    agg_mineral: DataFrame,
    agg_departamento: DataFrame,
    ok_max: float = GAP_OK_MAX,
    warning_max: float = GAP_WARNING_MAX,
) -> DataFrame:
    """Both aggregates in one table; the dimension a level does not use is NULL.

    Months spelled in two ways give two aggregate rows with one key: the spelling that sorts
    last is the one that is published.
    """

    def common(level: str, dimension: str) -> list[Column]:
        parts = [F.lit(level), *[_text_or_none(c) for c in ("period_yyyymm", "unidad", dimension)]]
        return [
            F.concat_ws("|", *parts).alias("aggregate_id"),
            F.lit(level).alias("aggregation_level"),
            F.to_date("period_date").alias("period_date"),
            optional_text(F.col("period_yyyymm")).alias("period_yyyymm"),
            *[F.col(c).cast("int").alias(c) for c in ("year", "month", "quarter", "semester")],
            optional_text(F.col("unidad")).alias("unidad"),
            F.col("period_raw").alias("_spelling"),
        ]

    no_text = F.lit(None).cast("string")
    pct = m.nan_to_null(F.col("pct_gap_vs_total"))
    minerals = agg_mineral.select(
        *common(MINERAL_AGGREGATE, "mineral"),
        optional_text(F.col("mineral")).alias("mineral"),
        no_text.alias("departamento"),
        "dept_sum_value",
        F.col("n_departamentos").cast("int").alias("n_departamentos"),
        "official_total_value",
        "abs_gap_vs_total",
        pct.alias("pct_gap_vs_total"),
        m.gap_class(F.abs(pct), ok_max, warning_max).alias("gap_quality_flag"),
        F.lit(DOCUMENT_VERSION).alias("schema_version"),
    )
    departments = agg_departamento.select(
        *common(DEPARTMENT_AGGREGATE, "departamento"),
        no_text.alias("mineral"),
        optional_text(F.col("departamento")).alias("departamento"),
        "dept_unit_sum_value",
        F.col("n_minerales").cast("int").alias("n_minerales"),
        no_text.alias("gap_quality_flag"),
        F.lit(DOCUMENT_VERSION).alias("schema_version"),
    )
    both = minerals.unionByName(departments, allowMissingColumns=True).filter(F.col("period_date").isNotNull())
    last = Window.partitionBy(*AGGREGATE_KEY).orderBy(F.col("_spelling").desc_nulls_last())
    return both.withColumn("_place", F.row_number().over(last)).filter("_place = 1").drop("_place", "_spelling")


def selection_metadata(report: DataFrame) -> dict[str, object]:
    """The selection settings a forecast report recorded, as far as it recorded them."""
    rule = report.schema["selection_rule"].dataType.fieldNames() if "selection_rule" in report.columns else []
    wanted = {"mode": "selection_mode", "dynamic_tolerance_pct": "dynamic_tolerance_pct"}
    present = [F.col(f"selection_rule.{k}").alias(v) for k, v in wanted.items() if k in rule]
    if not present:
        return {}
    row = report.select(*present).first()
    return {k: v for k, v in row.asDict().items() if v is not None} if row else {}


def prediction_documents(forecasts: DataFrame, metadata: dict[str, object] | None = None) -> DataFrame:
    """One document per model and series: ordered forecast points, window, stats and source.

    Points without a date, month or value are dropped, and documents without points with
    them; descriptors come from the first row whether or not its point is kept. An array
    holds at most the months of the publication window.
    """
    date, value = F.col("forecast_period_date"), m.nan_to_null(F.col("forecast_value"))
    month = optional_text(F.col("forecast_period_yyyymm"))
    usable = date.isNotNull() & value.isNotNull() & month.isNotNull()
    point = F.struct(
        date.alias("forecast_period_date"), month.alias("forecast_period_yyyymm"), value.alias("forecast_value")
    )

    def kept(c: Column) -> Column:
        return F.when(usable, c)

    described = ["mineral", "departamento", "unidad", "last_observed_period"]
    keys = ["selected_model", "level", "series_id"]
    grouped = (
        forecasts.dropna(subset=keys)
        .groupBy(*keys)
        .agg(
            F.array_sort(F.collect_list(kept(point))).alias("forecasts"),
            F.count(kept(value)).alias("n_points"),
            F.min(kept(date)).alias("forecast_window_start"),
            F.max(kept(date)).alias("forecast_window_end"),
            F.min(kept(value)).alias("min_value"),
            F.max(kept(value)).alias("max_value"),
            F.avg(kept(value)).alias("mean_value"),
            F.min_by(F.struct(*described), date).alias("first_row"),
        )
        .filter("n_points > 0")
    )
    # One shape whatever a report recorded, so that loads with and without it merge.
    known = metadata or {}
    source = [F.lit("fase8_operational").alias("phase")]
    source += [F.lit(known.get(k)).cast(kind).alias(k) for k, kind in SOURCE_FIELDS.items()]
    source += [F.lit(v).alias(k) for k, v in known.items() if k not in SOURCE_FIELDS]
    return grouped.select(
        F.concat_ws(
            "|", *keys, m.yyyymm(F.col("forecast_window_start")), m.yyyymm(F.col("forecast_window_end"))
        ).alias("prediction_id"),
        F.col("selected_model").alias("model"),
        "level",
        "series_id",
        *[optional_text(F.col(f"first_row.{c}")).alias(c) for c in described[:3]],
        F.col("first_row.last_observed_period").alias("last_observed_period"),
        "forecast_window_start",
        "forecast_window_end",
        F.col("n_points").cast("int").alias("forecast_window_months"),
        "forecasts",
        F.struct(
            F.col("n_points").cast("int").alias("n_points"),
            "min_value",
            "max_value",
            "mean_value",
            (F.col("max_value") - F.col("min_value") <= FLAT_TOLERANCE).alias("is_flat_forecast"),
        ).alias("forecast_stats"),
        F.struct(*source).alias("source"),
        F.lit(DOCUMENT_VERSION).alias("schema_version"),
    )


def prediction_summary(documents: DataFrame) -> DataFrame:
    """Documents, and documents that forecast one flat value, per model."""
    return documents.groupBy("model").agg(
        F.count("*").alias("documents"),
        F.count_if("forecast_stats.is_flat_forecast").alias("flat_documents"),
    )


# -------------------------------------------------------------------------- upserts

# What each published table is keyed by, which key parts may be NULL, and the month it is stored under.
FACTS = {"keys": SERIES_KEY, "partition": "period_date"}
AGGREGATES = {
    "keys": AGGREGATE_KEY,
    "nullable_keys": ["unidad", "mineral", "departamento"],
    "partition": "period_date",
}
PREDICTIONS = {"keys": PREDICTION_KEY, "partition": "forecast_window_start"}


def upsert(
    snapshot: DataFrame,
    batch: DataFrame,
    keys: list[str],
    now: datetime | str | Column,
    nullable_keys: list[str] | None = None,
    partition: str | None = None,
) -> DataFrame:
    """Merge a batch into a snapshot: one row per key, plus ``write_status``.

    A batch row replaces the fields it carries and leaves the others; ``updated_at`` moves on
    every match, ``ingested_at`` is set once. Keys only in the snapshot are kept, so a refresh
    never deletes. A batch with a repeated key is an error.

    NULLs match each other in ``nullable_keys`` only. The other key parts are joined by plain
    equality, so the repeated-key check and the join share one partitioning and one sort.

    ``partition`` names a month-grained key column. Snapshot rows of months the batch does not
    touch then bypass the join: they are neither shuffled nor sorted.
    """
    if partition is None:
        return _merge(snapshot, batch, keys, now, nullable_keys or [])
    touched = batch.select(partition).distinct()
    merged = _merge(snapshot.join(touched, partition, "left_semi"), batch, keys, now, nullable_keys or [])
    resting = snapshot.join(touched, partition, "left_anti").withColumn("write_status", F.lit("kept"))
    return merged.unionByName(resting, allowMissingColumns=True)


def _merge(
    snapshot: DataFrame, batch: DataFrame, keys: list[str], now: datetime | str | Column, nullable_keys: list[str]
) -> DataFrame:
    stamp = as_timestamp(now)
    repeated = F.raise_error(F.lit(f"duplicate key in batch: {keys}")).cast("boolean")
    new = batch.withColumn(
        "_in_batch",
        F.when(F.count("*").over(Window.partitionBy(*keys)) > 1, repeated).otherwise(True),
    )
    managed = ["ingested_at", "updated_at"]
    old = snapshot.select(*[F.col(c).alias(f"_o_{c}") for c in snapshot.columns], F.lit(True).alias("_in_old"))
    condition = F.lit(True)
    for k in keys:
        mine, theirs = F.col(k), F.col(f"_o_{k}")
        condition = condition & (mine.eqNullSafe(theirs) if k in nullable_keys else mine == theirs)
    both = old.join(new, condition, "full_outer")
    in_batch, in_old = F.col("_in_batch").isNotNull(), F.col("_in_old").isNotNull()

    def prior(c: str) -> Column:
        return F.col(f"_o_{c}") if c in snapshot.columns else F.lit(None)

    fields = [c for c in snapshot.columns if c not in managed]
    fields += [c for c in batch.columns if c not in fields and c not in managed]
    merged = [
        (F.when(in_batch, F.col(c)).otherwise(prior(c)) if c in batch.columns else prior(c)).alias(c)
        for c in fields
    ]
    return both.select(
        *merged,
        F.coalesce(prior("ingested_at"), stamp).alias("ingested_at"),
        F.when(in_batch, stamp).otherwise(prior("updated_at")).alias("updated_at"),
        F.when(in_batch & in_old, "matched").when(in_batch, "inserted").otherwise("kept").alias("write_status"),
    )


def first_load(batch: DataFrame, now: datetime | str | Column) -> DataFrame:
    """A batch as the first snapshot."""
    stamp = as_timestamp(now)
    return batch.withColumn("ingested_at", stamp).withColumn("updated_at", stamp)


COUNTERS = ["n_operations", "matched_count", "modified_count", "upserted_count"]


def _counters() -> list[Column]:
    """Operations, matches, modifications and inserts. Every match is a modification, because
    ``updated_at`` always changes."""
    status = F.col("write_status")
    matched, inserted = F.count_if(status == "matched"), F.count_if(status == "inserted")
    return [
        (matched + inserted).alias("n_operations"),
        matched.alias("matched_count"),
        matched.alias("modified_count"),
        inserted.alias("upserted_count"),
    ]


def upsert_counters(merged: DataFrame) -> DataFrame:
    return merged.agg(*_counters())


def upsert_table(
    spark: SparkSession,
    path: str,
    batch: DataFrame,
    keys: list[str],
    now: datetime | str | Column,
    nullable_keys: list[str] | None = None,
    partition: str = "period_date",
) -> dict[str, int]:
    """Upsert into a Parquet table stored by month and return the counters.

    Only the months of the batch are read, merged and replaced; columns that any stored month
    has are kept. The new files are staged and moved in month by month once the whole write has
    succeeded, so a failed or retried task leaves the table as it was; a failure of the driver
    while files move can leave some months new and others old, and loading the batch again
    completes them. The counters come out of the same job.
    """
    touched = batch.select(partition).distinct()
    stored = stored_table(spark, path)
    snapshot = first_load(batch, now).limit(0) if stored is None else stored.join(touched, partition, "left_semi")
    merged = upsert(snapshot, batch, keys, now, nullable_keys)
    observed = Observation("upsert")
    (
        merged.hint("rebalance", partition)
        .observe(observed, *_counters())
        .drop("write_status")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition)
        .parquet(path)
    )
    return {k: int(v) for k, v in observed.get.items()}


def stored_table(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at ``path``, or None before its first load."""
    try:
        # Months written before a column existed lack it; the others must not lose it.
        return spark.read.option("mergeSchema", True).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
