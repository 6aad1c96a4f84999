"""Session construction and shared storage location."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(master: str | None = None, app_name: str = "arlark",
                  shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """A session with the settings the library assumes.

    On a cluster, pass ``master=None`` and size ``spark.sql.shuffle.partitions``
    to the data (about 128-256 MB of shuffle per partition); AQE then coalesces
    small partitions and splits skewed ones at run time.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    if master and master.startswith("local"):
        # local mode runs everything in the driver JVM
        conf["spark.driver.memory"] = "16g"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """The runtime settings every job relies on: times are read and shown in UTC; sides that are already dealt by some of
    a join's keys alike are joined as they lie."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    return spark


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """A folder under ``spark.checkpoint.dir``, the storage that driver and executors share.

    Only a local master (tests) may leave the setting out; a scratch folder is then set as the session's own.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = tempfile.mkdtemp(prefix="arlark-")
        spark.conf.set("spark.checkpoint.dir", base)
    return os.path.join(base, *parts) if parts else base


def unique_dir(spark: SparkSession, prefix: str) -> str:
    """A fresh, never-reused folder under the shared location."""
    return shared_dir(spark, f"{prefix}-{uuid.uuid4().hex}")
