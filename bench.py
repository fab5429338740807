"""Time the headline queries and print one JSON line.

One warm-up and the median of three timed runs per query; the result is consumed by the noop
sink, so every row is produced and none is collected.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from prodseries.plans.queries import CATALOG  # noqa: E402
from prodseries.session import build_session  # noqa: E402

HEADLINE = [
    "agg_mineral_period",
    "gap_quality",
    "departamento_features",
    "backtest_metrics",
    "upsert_facts",
    "clean_full",
    "validation_rules",
    "iqr_outliers",
    "operational_forecast",
    "strip_accents_docs",
]
RUNS = 3


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "prodseries-bench",
        master=f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        start = time.perf_counter()
        CATALOG[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    # The warm-up goes through all queries before any is timed, so that none pays for the
    # JVM's start alone.
    for name in names:
        run(name)
    seconds = {name: round(statistics.median(run(name) for _ in range(RUNS)), 3) for name in names}
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
