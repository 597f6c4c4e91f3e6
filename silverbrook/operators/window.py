"""Window functions, ranks, running sums, shares, growth and top-k."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from silverbrook.plans.pipeline import Operator

RANKS = ("row_number", "rank", "dense_rank", "percent_rank", "cume_dist", "ntile")
OFFSETS = ("lag", "lead")
_AGGREGATES = {"sum": F.sum, "avg": F.avg, "mean": F.avg, "min": F.min, "max": F.max, "count": F.count, "first": F.first, "last": F.last, "stddev": F.stddev_samp, "variance": F.var_samp}

Bound = int | None
Frame = tuple[Bound, Bound]


@dataclass(frozen=True)
class Over:
    """One windowed column."""

    function: str
    alias: str
    column: str | None = None
    offset: int = 1
    default: Any = None
    tiles: int = 4

    def expression(self, ordered: WindowSpec, framed: WindowSpec) -> Column:
        if self.function == "ntile":
            return F.ntile(self.tiles).over(ordered)
        if self.function in RANKS:
            return getattr(F, self.function)().over(ordered)
        if self.function in OFFSETS:
            return getattr(F, self.function)(self.column, self.offset, self.default).over(ordered)
        if self.function in _AGGREGATES:
            return _AGGREGATES[self.function](F.col(self.column)).over(framed)
        raise ValueError(f"unknown window function {self.function!r}")


def _orders(order_by: Sequence[str], ascending: bool | Sequence[bool]) -> list[Column]:
    flags = [ascending] * len(order_by) if isinstance(ascending, bool) else list(ascending)
    return [F.col(c).asc() if up else F.col(c).desc() for c, up in zip(order_by, flags, strict=True)]


def windowed(partition_by: Sequence[str], order_by: Sequence[str], columns: Sequence[Over], ascending: bool | Sequence[bool] = True, rows: Frame | None = None, range_: Frame | None = None) -> Operator:
    """Add windowed columns.  A rows frame wins over a range frame; None as a bound is unbounded.  Ranks and offsets
    have no frame.  An ordered window without a frame ends at the current row's last peer, as in SQL."""

    def run(df: DataFrame) -> DataFrame:
        spec = Window.partitionBy(*partition_by)
        spec = spec.orderBy(*_orders(order_by, ascending)) if order_by else spec
        framed, frame = spec, rows or range_
        if frame:
            low = Window.unboundedPreceding if frame[0] is None else frame[0]
            high = Window.unboundedFollowing if frame[1] is None else frame[1]
            framed = spec.rowsBetween(low, high) if rows else spec.rangeBetween(low, high)
        return df.select("*", *[c.expression(spec, framed).alias(c.alias) for c in columns])

    return run


def running_total(partition_by: Sequence[str], order_by: Sequence[str], column: str, alias: str = "running_total") -> Operator:
    return windowed(partition_by, order_by, [Over("sum", alias, column)], rows=(None, 0))


def add_rank(partition_by: Sequence[str], order_by: Sequence[str], alias: str = "rank", ascending: bool | Sequence[bool] = True, dense: bool = False) -> Operator:
    return windowed(partition_by, order_by, [Over("dense_rank" if dense else "rank", alias)], ascending)


def share_of_total(partition_by: Sequence[str], column: str, alias: str, digits: int = 2) -> Operator:
    """``column`` as a percentage of its partition's sum; null where that is 0."""

    def run(df: DataFrame) -> DataFrame:
        total = F.sum(column).over(Window.partitionBy(*partition_by))
        return df.withColumn(alias, F.round(F.try_divide(F.col(column) * 100, total), digits))

    return run


def above_percentile(column: str, percentile: float, alias: str, accuracy: int = 10_000) -> Operator:
    """Y where ``column`` is above the whole table's percentile.  The threshold is one aggregated row, joined to all: no
    window over everything."""

    def run(df: DataFrame) -> DataFrame:
        limit = df.agg((F.percentile_approx(column, percentile, accuracy) if accuracy else F.percentile(column, percentile)).alias("_limit"))
        return df.crossJoin(F.broadcast(limit)).withColumn(alias, F.when(F.col(column) > F.col("_limit"), "Y").otherwise("N")).drop("_limit")

    return run


def growth(partition_by: Sequence[str], order_by: Sequence[str], column: str, alias: str, digits: int = 2) -> Operator:
    """Change since the previous row in percent; null without one or where it isn't positive."""

    def run(df: DataFrame) -> DataFrame:
        before = F.lag(column).over(Window.partitionBy(*partition_by).orderBy(*order_by))
        return df.withColumn(alias, F.when(before > 0, F.round((F.col(column) - before) / before * 100, digits)))

    return run


def top_per_group(partition_by: Sequence[str], order_by: Sequence[str], n: int, ascending: bool | Sequence[bool] = False, rank: str | None = "rank") -> Operator:
    """The first ``n`` rows of each group; Spark cuts groups before the shuffle (WindowGroupLimit)."""
    name = rank or "_rank"

    def run(df: DataFrame) -> DataFrame:
        order = F.row_number().over(Window.partitionBy(*partition_by).orderBy(*_orders(order_by, ascending)))
        out = df.withColumn(name, order).where(F.col(name) <= n)
        return out if rank else out.drop(name)

    return run


def top_rows(order_by: Sequence[str], n: int, ascending: bool | Sequence[bool] = False, rank: str | None = None) -> Operator:
    """The first ``n`` rows of the table, ranked if asked for; ranks are given to those rows alone."""

    def run(df: DataFrame) -> DataFrame:
        top = df.orderBy(*_orders(order_by, ascending)).limit(n)
        return top.withColumn(rank, F.row_number().over(Window.orderBy(*_orders(order_by, ascending)))) if rank else top

    return run
