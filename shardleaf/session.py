"""Session builder for local runs (tests, bench). On a cluster, pass your own session."""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(cpus: int | str = "*", app: str = "shardleaf", memory: str = "8g") -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
