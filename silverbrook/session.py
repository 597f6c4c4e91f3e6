"""Spark sessions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def session(name: str = "silverbrook", master: str | None = None, settings: Mapping[str, str] | None = None) -> SparkSession:
    """The active session, or a new one with the defaults and the given settings.  On a cluster leave the number of
    shuffle partitions high and let adaptive execution merge small ones."""
    builder = SparkSession.builder.appName(name)
    builder = builder.master(master) if master else builder
    return builder.config(map=DEFAULTS | dict(settings or {})).getOrCreate()
