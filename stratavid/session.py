"""Session settings the library is written for."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

# AQE re-plans joins at run time: it splits a shuffle partition that holds a hot
# key and coalesces small ones, so the shuffle width below is only an upper bound.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot key even where that costs one more exchange downstream.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def cluster_session(app: str = "stratavid", **extra: str) -> SparkSession:
    """Session for a cluster: master, memory and checkpoint folder come from spark-submit."""
    builder = SparkSession.builder.appName(app)
    for name, value in {**SETTINGS, **extra}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def local_session(cores: int | str = 8, app: str = "stratavid-local", **extra: str) -> SparkSession:
    """Single-JVM session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("STRATAVID_DRIVER_MEMORY", "12g"))
        .config("spark.sql.shuffle.partitions", str(cores))
    )
    for name, value in {**SETTINGS, **extra}.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession, fallback: str | None = None) -> str:
    """Folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``.

    ``fallback`` is used only where the setting is absent, which is the case in
    local tests; on a cluster a missing setting is an error rather than a silent
    write to one machine's disk.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if fallback is None:
        raise ValueError("spark.checkpoint.dir is not set; name a folder all executors share")
    return fallback.rstrip("/")
