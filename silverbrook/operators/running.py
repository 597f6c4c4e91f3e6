"""Running totals and numbers of rows where one key may hold all rows: two levels of sums over bands of the order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from silverbrook.operators.bands import as_number, banded, cuts
from silverbrook.plans.pipeline import Operator

#: Bands of the first order column, and the bytes of their table up to which it is broadcast.
BANDS, BROADCAST_ROWS = 256, 100_000


def _by(names: Sequence[str]) -> list[Column]:
    return [F.asc_nulls_first(f"`{c}`") for c in names]


def running(keys: Sequence[str], order: Sequence[str], total: str | None = None, number: str = "row_number", running_total: str = "running_total") -> Operator:
    """The number of each row in the order of its key and, with ``total``, the sum of that column up to it (null counts as nothing).

    The same as a window over ``keys`` ordered by ``order``, nulls first, without sorting a key's rows in one task.  Bands of the first order
    column, quantiles of the whole table, have counts and sums of their own; running over the bands gives what comes before each, and
    rows are only numbered within one.  A value so frequent that it fills several bands is a band of its own, and is parted by the
    second order column.  ``order`` must tell the rows of a key apart for the numbers to be the same in every run.  One job finds the
    quantiles while the result is built, and one counts the bands.
    """

    def run(df: DataFrame) -> DataFrame:
        bounds = cuts(df, list(dict.fromkeys(order[:2])), BANDS)
        first = bounds[order[0]]
        frequent = sorted({x for x in first if first.count(x) > 1})
        out = banded(df, {order[0]: first}, {order[0]: "_a"})
        alone = as_number(df, order[0]).isin(frequent) if frequent else F.lit(False)
        if len(order) > 1:
            out = banded(out, {order[1]: bounds[order[1]]}, {order[1]: "_b"})
        out = out.withColumn("_alone", alone.cast("int")).withColumn("_b", F.when(F.col("_alone") == 1, F.col("_b") if len(order) > 1 else F.lit(0)).otherwise(F.lit(0)))
        # a frequent value is the lower bound of its band, so it comes before the band's other rows
        band = F.struct(F.col("_a"), (1 - F.col("_alone")).alias("rest"), F.col("_b"))
        out = out.withColumn("_band", band).drop("_a", "_b", "_alone").withColumn("_keys", F.struct(*[F.col(f"`{k}`") for k in keys]) if keys else F.struct(F.lit(0).alias("all")))
        value = F.coalesce(F.col(f"`{total}`"), F.lit(0).cast(df.schema[total].dataType)) if total else F.lit(0)
        sums = out.groupBy("_keys", "_band").agg(F.count(F.lit(1)).alias("_n"), F.sum(value).alias("_s"))
        before = Window.partitionBy("_keys").orderBy("_band").rowsBetween(Window.unboundedPreceding, -1)
        sums = sums.select(F.to_json("_keys", {"ignoreNullFields": "false"}).alias("_name"), "_band", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_rows"), F.sum("_s").over(before).alias("_sum"))
        known = F.broadcast(sums) if sums.count() <= BROADCAST_ROWS else sums
        inner = Window.partitionBy("_name", "_band").orderBy(*_by(order))
        placed = out.withColumn("_name", F.to_json("_keys", {"ignoreNullFields": "false"})).withColumn("_in", F.row_number().over(inner))
        if total:
            placed = placed.withColumn("_part", F.sum(value).over(inner.rowsBetween(Window.unboundedPreceding, 0)))
        placed = placed.join(known, ["_name", "_band"]).withColumn(number, (F.col("_rows") + F.col("_in")).cast("long"))
        made = [number]
        if total:
            placed = placed.withColumn(running_total, F.when(F.col("_sum").isNull(), F.col("_part")).otherwise(F.col("_sum") + F.col("_part")))
            made.append(running_total)
        return placed.select(*[F.col(f"`{c}`") for c in df.columns if c not in made], *made)

    return run
