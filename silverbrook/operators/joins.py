"""Joins: by columns, by comparisons, chains, lookups, self joins and free conditions."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_, eq, ge, gt, le, lt, ne
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import AtomicType, VariantType

from silverbrook.plans.pipeline import Operator

JOIN_TYPES = {
    "inner": "inner",
    "left": "left_outer",
    "left_outer": "left_outer",
    "right": "right_outer",
    "right_outer": "right_outer",
    "full": "full_outer",
    "full_outer": "full_outer",
    "outer": "full_outer",
    "cross": "cross",
    "semi": "left_semi",
    "left_semi": "left_semi",
    "anti": "left_anti",
    "left_anti": "left_anti",
}
_COMPARE = {"=": eq, "==": eq, "!=": ne, "<>": ne, "<": lt, ">": gt, "<=": le, ">=": ge}
LEFT, RIGHT = "_l", "_r"
ROW, ROWS = "_l_row", "_l_rows"
#: Rows of a piece, as a power of two.
PIECE = 8


def join_type(name: str) -> str:
    try:
        return JOIN_TYPES[name.lower()]
    except KeyError:
        raise ValueError(f"unknown join type {name!r}") from None


@dataclass(frozen=True)
class On:
    """``left`` compared with ``right``, columns of the two sides."""

    left: str
    right: str
    compare: str = "="

    def __post_init__(self) -> None:
        if self.compare not in _COMPARE:
            raise ValueError(f"unknown comparison {self.compare!r}")

    def column(self) -> Column:
        return _COMPARE[self.compare](F.col(f"{LEFT}.`{self.left}`"), F.col(f"{RIGHT}.`{self.right}`"))


def _hinted(df: DataFrame, broadcast: bool) -> DataFrame:
    return F.broadcast(df) if broadcast else df


def _pieces(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``keys`` and arrays of up to 2**PIECE rows that agree in them.  Rows are dealt by ranges of a hash of the keys that ends in bits
    of a hash of the row, so that a task has few keys and a hot key goes to several tasks, but equal rows to one."""
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    named, low = [F.col(f"`{c}`") for c in keys], (1 << (2 * tasks).bit_length()) - 1
    hashed = [F.col(f"`{f.name}`") for f in df.schema if isinstance(f.dataType, AtomicType) and not isinstance(f.dataType, VariantType)]
    at = F.xxhash64(*named).bitwiseAND(F.lit(~low)).bitwiseOR(F.xxhash64(F.lit(0), *hashed).bitwiseAND(F.lit(low)))
    rows = df.select(*named, F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(ROW), at.alias("_l_at"))
    dealt = rows.repartitionByRange(tasks, "_l_at").sortWithinPartitions("_l_at")
    pieces = dealt.withColumn("_l_piece", F.shiftright(F.monotonically_increasing_id(), PIECE))
    return pieces.groupBy(*named, "_l_at", "_l_piece").agg(F.collect_list(ROW).alias(ROWS)).drop("_l_at", "_l_piece")


def join(
    right: DataFrame,
    how: str = "inner",
    on: Sequence[str] = (),
    conditions: Sequence[On] = (),
    broadcast: bool = False,
    suffix: str = "_right",
) -> Operator:
    """Join on same-named columns and on comparisons, all of which must hold.

    A key named in ``on`` comes once; in right and full joins it has the value of whichever side has the row.  Other
    columns of the right side that clash get ``suffix``.

    A full join is a left join and the right side's rows without a match: Spark's own full join holds all the pairs of a key
    at once before it gives them on, the left one the pairs of a row, and it may be dealt to more tasks.  Both sides are read more than
    once, so they must not change in between.  Left rows that agree in what is compared go in pieces: a right row's pairs with
    a piece stand together, and the next right row's repeat the same left rows, which columnar files hold in a fraction of a byte a pair.
    """
    kind = join_type(how)
    if kind != "cross" and not on and not conditions:
        raise ValueError("a join needs columns or conditions")

    def run(left: DataFrame) -> DataFrame:
        a, b = left.alias(LEFT), _hinted(right, broadcast).alias(RIGHT)
        tests = [On(c, c).column() for c in on] + [c.column() for c in conditions]
        if kind == "full_outer":
            return full(left, b, reduce(and_, tests))
        joined = a.crossJoin(b) if kind == "cross" and not tests else a.join(b, reduce(and_, tests), "inner" if kind == "cross" else kind)
        if kind in ("left_semi", "left_anti"):
            return joined
        return joined.select(*columns(left, kind == "right_outer"))

    one = lambda side, c: F.col(f"{side}.`{c}`")

    def columns(left: DataFrame, both: bool, side: str = LEFT) -> list[Column]:
        out = [(F.coalesce(one(side, c), one(RIGHT, c)) if both and c in on else one(side, c)).alias(c) for c in left.columns]
        return out + [one(RIGHT, c).alias(c + suffix if c in left.columns else c) for c in right.columns if c not in on]

    def full(left: DataFrame, b: DataFrame, test: Column) -> DataFrame:
        compared = list(dict.fromkeys([*on, *[c.left for c in conditions]]))
        # every piece has rows; a condition with a lambda keeps the join out of generated code, which would hold all pairs of a piece
        lazy = F.exists(one(LEFT, ROWS), lambda row: row.isNotNull())
        pairs = _pieces(left, compared).alias(LEFT).join(b, test & lazy, "left_outer").select("*", F.explode(one(LEFT, ROWS)).alias(ROW))
        matched = pairs.select(*columns(left, True, ROW))
        alone = right.alias(RIGHT).join(left.select(*[F.col(f"`{c}`") for c in compared]).distinct().alias(LEFT), test, "left_anti")
        nulls = [(one(RIGHT, c) if c in on else F.lit(None)).alias(c) for c in left.columns]
        rest = [one(RIGHT, c).alias(c + suffix if c in left.columns else c) for c in right.columns if c not in on]
        return matched.unionByName(alone.select(*nulls, *rest))

    return run


@dataclass(frozen=True)
class Step:
    """One join of a chain."""

    right: DataFrame
    how: str = "inner"
    on: Sequence[str] = ()
    conditions: Sequence[On] = ()
    broadcast: bool = False
    suffix: str = "_right"


def join_all(steps: Sequence[Step]) -> Operator:
    """Joins one after the other; Catalyst may reorder inner ones where statistics say so."""
    return lambda df: reduce(lambda d, s: d.transform(join(s.right, s.how, s.on, s.conditions, s.broadcast, s.suffix)), steps, df)


def lookup(table: DataFrame, key: str, source_key: str | None = None, columns: Sequence[str] = (), defaults: Mapping[str, Any] | None = None, broadcast: bool = False) -> Operator:
    """Add columns of a dimension; rows without a match get the defaults.  The dimension is broadcast by Spark's own
    size estimate, or always if asked for."""
    source_key, defaults = source_key or key, dict(defaults or {})
    columns = list(columns) or [c for c in table.columns if c != key]

    def run(df: DataFrame) -> DataFrame:
        side = _hinted(table.select(F.col(key).alias("_key"), *[F.col(c).alias(f"_add_{c}") for c in columns]), broadcast)
        value = lambda c: F.coalesce(f"_add_{c}", F.lit(defaults[c])) if c in defaults else F.col(f"_add_{c}")
        joined = df.join(side, F.col(source_key) == F.col("_key"), "left_outer")
        return joined.select(*[c for c in df.columns if c not in columns], *[value(c).alias(c) for c in columns])

    return run


def self_join(condition: Callable[[Callable[[str], Column], Callable[[str], Column]], Column], right_columns: Mapping[str, str] | Sequence[str], how: str = "left") -> Operator:
    """Join a table with itself.  ``condition`` gets two functions that name the columns of either side; of the right
    side the given columns are kept, under new names where a mapping gives them."""
    kept = dict(right_columns) if isinstance(right_columns, Mapping) else {c: f"{c}_right" for c in right_columns}

    def run(df: DataFrame) -> DataFrame:
        a, b = (lambda c: F.col(f"{LEFT}.`{c}`")), (lambda c: F.col(f"{RIGHT}.`{c}`"))
        joined = df.alias(LEFT).join(df.alias(RIGHT), condition(a, b), join_type(how))
        if join_type(how) in ("left_semi", "left_anti"):
            return joined
        return joined.select(*[a(c).alias(c) for c in df.columns], *[b(c).alias(n) for c, n in kept.items()])

    return run


def conditional_join(right: DataFrame, condition: Callable[[Callable[[str], Column], Callable[[str], Column]], Column], how: str = "left", columns: Sequence[str] | None = None, broadcast: bool = False) -> Operator:
    """Join by any predicate, such as a range.  The predicate sees all columns of both sides; ``columns`` chooses those of
    the right side that are added.  A predicate without an equality makes Spark compare all pairs: keep the right side
    small, or band both sides and add the band as an equality (:func:`band_join`)."""

    def run(left: DataFrame) -> DataFrame:
        a, b = (lambda c: F.col(f"{LEFT}.`{c}`")), (lambda c: F.col(f"{RIGHT}.`{c}`"))
        joined = left.alias(LEFT).join(_hinted(right, broadcast).alias(RIGHT), condition(a, b), join_type(how))
        if join_type(how) in ("left_semi", "left_anti"):
            return joined
        names = list(right.columns if columns is None else columns)
        return joined.select(*[a(c).alias(c) for c in left.columns], *[b(c).alias(f"{c}_right" if c in left.columns else c) for c in names])

    return run


def band_join(right: DataFrame, value: str, low: str, high: str, width: float, how: str = "inner") -> Operator:
    """``low <= value < high`` as an equality: both sides are cut into bands of ``width``, a right row is copied to the
    bands it touches, and the range is checked within.  Each pair is found in the one band that holds the value."""

    def run(left: DataFrame) -> DataFrame:
        band = lambda c: F.floor(F.col(c).cast("double") / F.lit(float(width))).cast("long")
        wide = right.where(F.col(high) > F.col(low)).withColumn("_band", F.explode(F.sequence(band(low), band(high))))
        a = left.withColumn("_band", band(value)).alias(LEFT)
        test = (F.col(f"{LEFT}._band") == F.col(f"{RIGHT}._band")) & (F.col(f"{LEFT}.`{value}`") >= F.col(f"{RIGHT}.`{low}`")) & (F.col(f"{LEFT}.`{value}`") < F.col(f"{RIGHT}.`{high}`"))
        joined = a.join(wide.alias(RIGHT), test, join_type(how))
        if join_type(how) in ("left_semi", "left_anti"):
            return joined.drop("_band")
        return joined.select(*[F.col(f"{LEFT}.`{c}`").alias(c) for c in left.columns], *[F.col(f"{RIGHT}.`{c}`").alias(f"{c}_right" if c in left.columns else c) for c in right.columns])

    return run


def inner_join(left: DataFrame, right: DataFrame, on: str | Sequence[str], broadcast_right: bool = False) -> DataFrame:
    return left.join(_hinted(right, broadcast_right), on, "inner")


def left_join(left: DataFrame, right: DataFrame, on: str | Sequence[str], broadcast_right: bool = False) -> DataFrame:
    return left.join(_hinted(right, broadcast_right), on, "left_outer")


def semi_join(left: DataFrame, right: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Left rows that have a match."""
    return left.join(right, on, "left_semi")


def anti_join(left: DataFrame, right: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Left rows that have none."""
    return left.join(right, on, "left_anti")
