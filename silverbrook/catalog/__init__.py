"""All registered queries of the library's own operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from silverbrook.catalog import io, quality, relational, sales, streams
from silverbrook.catalog.tables import Tables

ENTRIES = relational.ENTRIES | sales.ENTRIES | quality.ENTRIES | io.ENTRIES | streams.ENTRIES


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: (lambda spark, folder, f=f: f(Tables(spark, folder))) for name, (f, _) in ENTRIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in ENTRIES.items() if sql}
