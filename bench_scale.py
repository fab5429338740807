"""Rows per second of the per-series operators as the number of series grows.

    python bench_scale.py 1 10 100

Every series of the history is copied k times under its own id, so partition sizes, sorts and
state grow with k while each series keeps its length.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from prodseries.operators import features, forecast, publish, quantiles, tidy  # noqa: E402
from prodseries.session import build_session  # noqa: E402
from prodseries.sources import star  # noqa: E402


def copies(df, k: int, *columns: str):
    """k copies of every row; the copy number joins the named text columns."""
    out = df.withColumn("copy_no", F.explode(F.sequence(F.lit(1), F.lit(k))))
    return out.withColumns({c: F.concat_ws("~", c, "copy_no") for c in columns}).drop("copy_no")


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = build_session(
        "prodseries-bench-scale",
        master=f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": str(4 * int(cpus)),
            "spark.ui.enabled": "false",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    # The monthly facts are few; they are spread out before they are multiplied.
    facts = tidy.tidy_observations(star.observations(spark, sf_dir)).repartition(4 * int(cpus))
    for k in map(int, sys.argv[1:] or ["1", "10", "100"]):
        grown = copies(facts, k, "mineral", "series_code")
        documents = publish.fact_documents(grown)
        snapshot = publish.first_load(documents.filter("year < 2024"), "2025-01-01 00:00:00")
        # One mineral with a third of all rows, all else spread over the copies.
        hot = facts.filter("NOT is_total_departamento").withColumn(
            "copy_no", F.explode(F.sequence(F.lit(1), F.lit(k)))
        ).withColumns(
            {
                "mineral": F.when(F.col("copy_no") % 3 == 0, "hot").otherwise(F.concat_ws("~", "mineral", "copy_no")),
                "value": F.col("value") + F.col("copy_no") / 1024,
            }
        )
        cases = {
            "agg_mineral_period": tidy.agg_mineral_period(grown),
            "departamento_features": features.departamento_features(grown),
            "backtest_metrics": forecast.backtest(features.target_history(grown)).metrics,
            "upsert_facts": publish.upsert(
                snapshot, documents.filter("year >= 2023"), publish.FACTS["keys"], "2025-02-01 00:00:00"
            ),
            "iqr_outliers_hot_group": quantiles.iqr_outliers(hot, ["mineral", "unidad"], "value"),
        }
        rows = grown.count()
        for name, df in cases.items():
            start = time.perf_counter()
            df.write.format("noop").mode("overwrite").save()
            seconds = time.perf_counter() - start
            print(
                json.dumps(
                    {"query": name, "k": k, "rows": rows, "sec": round(seconds, 2), "rows_per_sec": round(rows / seconds)}
                ),
                flush=True,
            )
    spark.stop()


if __name__ == "__main__":
    main()
