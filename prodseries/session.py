"""Session settings the plans are written for."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Everything here can be overridden by the cluster's own configuration; nothing in the
# library depends on a particular value for its results.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    # Joins against tables of unknown size start shuffled; a side is only broadcast once its
    # size is known to be under the threshold, and hot join keys are split at run time.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Upserts rewrite only the partitions they touch.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(app_name: str = "prodseries", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``. Only a session within
    one machine may go without it; it then gets a temporary folder, named for later calls."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="prodseries-shared-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
