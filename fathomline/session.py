"""A session with the settings that the library counts on."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(master: str = "local[8]", partitions: int = 8, **conf: str) -> SparkSession:
    """UTC, adaptive execution with skew handling, Arrow for the few grouped folds. On a cluster, pass partitions by size."""
    builder = (
        SparkSession.builder.master(master).appName("fathomline")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    for k, v in conf.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()
