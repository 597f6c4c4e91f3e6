"""Event-time operators on streams: windows, sessions, deduplication and joins, each with a watermark.

``late`` is how far behind the latest event time a row may arrive: what is older when a batch begins is left out, and state is given
up once the watermark has passed it.  All work on batches too, where nothing is late.  Times are timestamps with a zone.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from silverbrook.plans.pipeline import Operator


def timed(time: str, late: str) -> Operator:
    """The column as a timestamp, with a watermark."""
    return lambda df: df.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, late)


def windowed(time: str, late: str, width: str, aggregates: Mapping[str, Column], keys: Sequence[str] = (), slide: str | None = None) -> Operator:
    """Aggregates of each window and key, with ``window_start`` and ``window_end``; with ``slide`` windows overlap and a row is in
    each that covers it.  In append mode a window comes out once, when the watermark has passed its end."""

    def run(df: DataFrame) -> DataFrame:
        span = F.window(time, width, slide) if slide else F.window(time, width)
        out = timed(time, late)(df).groupBy(span.alias("_window"), *keys).agg(*[c.alias(n) for n, c in aggregates.items()])
        return out.select(F.col("_window.start").alias("window_start"), F.col("_window.end").alias("window_end"), *keys, *aggregates)

    return run


def sessions(time: str, late: str, gap: str, keys: Sequence[str], aggregates: Mapping[str, Column]) -> Operator:
    """Aggregates of each run of a key's events in which none comes more than ``gap`` after the one before; ``session_end`` is ``gap``
    after the last.  A late event may join two sessions that are still open."""

    def run(df: DataFrame) -> DataFrame:
        out = timed(time, late)(df).groupBy(*keys, F.session_window(time, gap).alias("_session")).agg(*[c.alias(n) for n, c in aggregates.items()])
        return out.select(*keys, F.col("_session.start").alias("session_start"), F.col("_session.end").alias("session_end"), *aggregates)

    return run


def without_repeats(time: str, late: str, keys: Sequence[str]) -> Operator:
    """The first row of each key; a repeat goes as long as it comes within ``late`` of the first in event time, after which the
    key is forgotten.  State holds the keys of that span only."""

    def run(df: DataFrame) -> DataFrame:
        df = timed(time, late)(df)
        return df.dropDuplicatesWithinWatermark(list(keys)) if df.isStreaming else df.dropDuplicates(list(keys))

    return run


def followed_by(other: DataFrame, keys: Sequence[str], time: str, other_time: str, within: str, late: str, how: str = "inner") -> Operator:
    """Rows joined with those of ``other`` that have equal keys and come at the same time or up to ``within`` later.  With ``how`` left_outer a
    row without any comes out once the watermark rules one out.  Names of the two sides must differ but for the keys, which are
    taken from the left.  Both sides keep rows for ``within`` and ``late`` only."""
    if how not in ("inner", "left_outer"):
        raise ValueError(f"unknown kind of join {how!r}")

    def run(df: DataFrame) -> DataFrame:
        left, right = timed(time, late)(df), timed(other_time, late)(other)
        right = right.withColumnsRenamed({k: f"_{k}" for k in keys})
        test = (F.col(other_time) >= F.col(time)) & (F.col(other_time) <= F.col(time) + F.expr(f"interval {within}"))
        for k in keys:
            test = test & (F.col(k) == F.col(f"_{k}"))
        return left.join(right, test, how).drop(*[f"_{k}" for k in keys])

    return run
