"""Spark session settings of the engine."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # partition values such as bucket=02 stay text
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
}


def build(app: str = "hexloom", **more: str) -> SparkSession:
    """Session with the engine's settings; ``more`` overrides them (dots as double underscores)."""
    return SparkSession.builder.appName(app).config(map=SETTINGS | {k.replace("__", "."): v for k, v in more.items()}).getOrCreate()
