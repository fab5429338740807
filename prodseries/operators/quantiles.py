"""Exact grouped quantiles that never gather a whole group in one place."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from prodseries.session import scratch_path

# Slices that a group, or a slice too large to be ranked, is cut into.
SLICES = 256
# Distinct values that one task ranks at most.
RANKED = 100_000


def stored(df: DataFrame, label: str) -> DataFrame:
    """A table in the shared folder: rounds over it neither recompute it nor grow its lineage."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def value_counts(df: DataFrame, groups: list[str], column: str) -> DataFrame:
    """Distinct values per group with their multiplicity; copies combine before the shuffle."""
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(*groups, F.col(column).alias("value"))
        .agg(F.count("*").alias("copies"))
    )


def join_null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Equi-join in which NULL keys match; the right side's keys are dropped."""
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    condition = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys])
    return left.join(renamed, condition, how).drop(*[f"_r_{k}" for k in keys])


def _slice_number() -> Column:
    """How many of the sorted ``cuts`` lie below ``value``, by binary search."""
    steps = [1 << i for i in reversed(range((SLICES - 1).bit_length()))]
    return F.expr(
        f"IF(cuts IS NULL, 0, aggregate(array({', '.join(map(str, steps))}), 0,"
        " (found, step) -> found + IF(get(cuts, found + step - 1) < value, step, 0)))"
    )


def _holders(rows: DataFrame, groups: list[str]) -> DataFrame:
    """``rows`` of the slices that hold a wanted rank, each slice now a part of its own.

    ``rows``: groups, part, before (values of the group below the part), n_values, wanted (ranks),
    value, copies. A mergeable sketch proposes the cuts of each part; only balance depends on it.
    """
    keys = [*groups, "part"]
    cut_points = [i / SLICES for i in range(1, SLICES)]
    # Every branch reads the multiplicities, so all of them share the one shuffle of the rows.
    present = F.when(F.col("copies") > 0, F.col("value"))
    cuts = rows.groupBy(*keys).agg(F.percentile_approx(present, cut_points, 10 * SLICES).alias("cuts"))
    sliced = join_null_safe(rows, cuts, keys, "left").withColumn("slice", _slice_number()).drop("cuts")
    running = Window.partitionBy(*keys).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    held = (
        sliced.groupBy(*keys, "slice")
        .agg(F.sum("copies").alias("in_slice"), F.first("before").alias("start"), F.first("wanted").alias("ranks"))
        .withColumn("start", F.col("start") + F.coalesce(F.sum("in_slice").over(running), F.lit(0)))
        .filter(F.exists("ranks", lambda r: (r >= F.col("start")) & (r < F.col("start") + F.col("in_slice"))))
        .drop("in_slice", "ranks")
    )
    kept = join_null_safe(sliced, held, [*keys, "slice"])
    return kept.select(
        *groups, (F.col("part") * SLICES + F.col("slice")).alias("part"), F.col("start").alias("before"), "n_values", "wanted", "value", "copies"
    )


def exact_quantiles(counts: DataFrame, groups: list[str], fractions: list[float]) -> DataFrame:
    """Linearly interpolated quantiles of ``value`` per group: columns ``q0, q1, ...``.

    Parts (at first whole groups) are cut into slices, exact counts per slice locate those that
    hold a wanted rank, and these are the parts of the next round, until none has more than
    RANKED distinct values. Only then are they ranked, so no task orders more than that however
    large a group is. ``counts`` is read in every round: pass a stored table.
    """
    ranks = [F.col("n_values") - 1] * len(fractions)
    position = [rank * fraction for rank, fraction in zip(ranks, fractions, strict=True)]
    wanted = F.array(*[f(p).cast("bigint") for p in position for f in (F.floor, F.ceil)])
    sizes = counts.groupBy(*groups).agg(F.sum("copies").alias("n_values")).withColumn("wanted", wanted)
    rows = join_null_safe(counts, sizes, groups).select(
        *groups, F.lit(0).cast("long").alias("part"), F.lit(0).cast("long").alias("before"), "n_values", "wanted", "value", "copies"
    )

    def largest(parts: DataFrame, keys: list[str]) -> int:
        return parts.groupBy(*keys).agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0

    size, rounds = largest(counts, groups), 0
    while size > RANKED:
        rows, rounds = stored(_holders(rows, groups), f"quantile-round-{rounds}"), rounds + 1
        size = largest(rows, [*groups, "part"])

    within = Window.partitionBy(*groups, "part").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    ranked = rows.withColumn("last_rank", F.col("before") + F.sum("copies").over(within) - 1).withColumn(
        "first_rank", F.col("last_rank") - F.col("copies") + 1
    )

    def value_at(i: int) -> Column:
        rank = F.get("wanted", i)
        return F.max(F.when(rank.between(F.col("first_rank"), F.col("last_rank")), F.col("value")))

    picked = ranked.groupBy(*groups, "n_values").agg(
        *[value_at(i).alias(f"v{i}") for i in range(2 * len(fractions))]
    )
    quantiles = []
    for i, p in enumerate(position):
        low, high = F.col(f"v{2 * i}"), F.col(f"v{2 * i + 1}")
        # Equal neighbours are taken as they are, which also keeps infinities intact.
        q = F.when(low == high, low).otherwise(low + (high - low) * (p - F.floor(p)))
        quantiles.append(q.alias(f"q{i}"))
    return picked.select(*groups, "n_values", *quantiles)


def iqr_outliers(df: DataFrame, groups: list[str], column: str) -> DataFrame:
    """Per group: quartiles, strict 1.5 IQR fences and the number of values outside them.

    Groups with a NULL key are groups of their own.
    """
    counts = stored(value_counts(df, groups, column), "value-counts")
    quartiles = exact_quantiles(counts, groups, [0.25, 0.75]).select(
        *groups, "n_values", F.col("q0").alias("q1"), F.col("q1").alias("q3")
    )
    spread = F.col("q3") - F.col("q1")
    fences = quartiles.withColumn("lower_bound", F.col("q1") - 1.5 * spread).withColumn(
        "upper_bound", F.col("q3") + 1.5 * spread
    )
    outside = (F.col("value") < F.col("lower_bound")) | (F.col("value") > F.col("upper_bound"))
    return (
        join_null_safe(counts, fences, groups)
        .groupBy(*groups, "n_values", "q1", "q3", "lower_bound", "upper_bound")
        .agg(F.coalesce(F.sum(F.when(outside, F.col("copies"))), F.lit(0)).alias("n_outliers"))
    )
