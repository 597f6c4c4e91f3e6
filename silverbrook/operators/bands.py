"""Bands of a column's values, of about equal numbers of rows, by approximate quantiles of the whole column."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DateType, NumericType, TimestampNTZType, TimestampType

#: The digits of a quantile's rank: the more, the closer are the bands to equal numbers.
ACCURACY = 10_000


def as_number(df: DataFrame, column: str) -> Column:
    """A double in the order of the column: numbers, dates and times as they are, text by its first six bytes; null first, NaN last."""
    kind, c = df.schema[column].dataType, F.col(f"`{column}`")
    if isinstance(kind, NumericType):
        number = c.cast("double")
    elif isinstance(kind, DateType):
        number = F.unix_date(c).cast("double")
    elif isinstance(kind, TimestampType | TimestampNTZType):
        number = F.unix_micros(c.cast("timestamp")).cast("double")
    else:
        front = F.rpad(F.hex(F.substring(c.cast("string").cast("binary"), 1, 6)), 12, "0")
        number = F.conv(front, 16, 10).cast("double")
    return F.coalesce(F.nanvl(number, F.lit(math.inf)), F.lit(-math.inf))


def cuts(df: DataFrame, columns: Sequence[str], bands: int) -> dict[str, list[float]]:
    """The values that part each column's numbers in ``bands`` bands; a value that fills several stands several times.  One job;
    ``bands`` - 1 numbers a column reach the driver."""
    if bands < 2:
        return {c: [] for c in columns}
    asked = F.array(*[F.lit(i / bands) for i in range(1, bands)])
    numbers = df.select(*[as_number(df, c).alias(f"n{i}") for i, c in enumerate(columns)])
    known = [F.when(F.abs(f"n{i}") < math.inf, F.col(f"n{i}")) for i in range(len(columns))]
    row = numbers.agg(*[F.percentile_approx(n, asked, F.lit(ACCURACY)).alias(f"c{i}") for i, n in enumerate(known)]).first()
    return {c: list(row[f"c{i}"] or []) for i, c in enumerate(columns)}


def banded(df: DataFrame, bounds: dict[str, list[float]], names: dict[str, str]) -> DataFrame:
    """``df`` with the band of each column of ``bounds``, as an integer from 0, under the name that ``names`` gives."""
    out = df
    for c, name in names.items():
        splits = [-math.inf, *sorted(set(bounds[c])), math.inf]
        number = f"_number_{name}"
        out = out.withColumn(number, as_number(df, c))
        out = Bucketizer(splits=splits, inputCol=number, outputCol=name, handleInvalid="error").transform(out) if len(splits) > 2 else out.withColumn(name, F.lit(0))
        out = out.withColumn(name, F.col(name).cast("int")).drop(number)
    return out
