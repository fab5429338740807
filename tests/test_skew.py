"""A part that holds a third of all rows: the joins split it and the result stays whole."""

import os

import pytest
from pyspark.sql import functions as F

from prodseries.sources import star

SF = "/root/testdata/sf0.01"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")

# Shuffled joins only, with thresholds small enough for the test tables to count as skewed.
SMALL = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


def test_hot_part_is_split(spark, tmp_path):
    for name in ("part", "supplier", "nation", "region"):
        os.symlink(f"{SF}/{name}.parquet", tmp_path / f"{name}.parquet")
    hot = F.when(F.col("l_orderkey") % 3 == 0, F.lit(7).cast("bigint")).otherwise(F.col("l_partkey"))
    star.table(spark, SF, "lineitem").withColumn("l_partkey", hot).repartition(8).write.parquet(
        str(tmp_path / "lineitem.parquet")
    )
    expected = star.table(spark, str(tmp_path), "lineitem").agg(F.sum("l_quantity")).first()[0]
    before = {k: spark.conf.get(k, None) for k in SMALL}
    for key, value in SMALL.items():
        spark.conf.set(key, value)
    try:
        monthly = star.monthly_quantities(spark, str(tmp_path))
        total = sum(r.detail_value for r in monthly.collect())
        plan = monthly._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    assert total == expected
    assert "skew=true" in plan
