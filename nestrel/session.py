"""SparkSession construction with the settings every nestrel job relies on."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def get_spark(master: str | None = None, app: str = "nestrel",
              shuffle_partitions: int | None = None, extra_conf: dict | None = None) -> SparkSession:
    """Build (or reuse) a session tuned for nestrel.

    On a cluster the master, memory and ``spark.checkpoint.dir`` come from the
    submit configuration; this only fills in what is missing, so it is safe to
    call from tests (local mode) and from jobs alike.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.session.timeZone": "UTC",
        # Runtime re-planning: coalesce small shuffle partitions, split skewed
        # join partitions, turn joins whose measured side is small into
        # broadcast joins.
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if master and master.startswith("local"):
        # local mode runs every task inside the driver JVM, whose default heap
        # (1 GiB) makes concurrent text tasks spend their time in GC. A
        # cluster sizes executors in its own submit configuration.
        conf["spark.driver.memory"] = os.environ.get("NESTREL_DRIVER_MEMORY", "16g")
    conf.update(extra_conf or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()
