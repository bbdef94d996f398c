"""A session with the settings the operators are planned for."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: Adaptive execution coalesces and splits partitions at run time; the initial number is an upper bound, to be set so
#: that one shuffled partition holds tens of megabytes at the size at hand.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def session(name: str = "marketlane", **more: str) -> SparkSession:
    builder = SparkSession.builder.appName(name)
    for k, v in {**SETTINGS, **more}.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()
