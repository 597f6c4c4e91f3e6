"""Rows laid out along a space-filling curve, so that files have narrow ranges of several columns at once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from silverbrook.operators.bands import banded, cuts
from silverbrook.plans.pipeline import Operator

#: Bits of a column's rank; the bands are quantiles, so skewed columns count like others.
BITS = 8


def interleaved(ranks: Sequence[str], bits: int = BITS) -> Column:
    """The bits of the ranks in turn, the highest first."""
    out = F.lit(0).cast("long")
    for b in range(bits):
        for i, name in enumerate(ranks):
            bit = F.shiftright(F.col(name).cast("long"), b).bitwiseAND(F.lit(1).cast("long"))
            out = out.bitwiseOR(F.shiftleft(bit, b * len(ranks) + len(ranks) - 1 - i))
    return out


def clustered(columns: Sequence[str], files: int) -> Operator:
    """Rows in ``files`` ranges of the curve through the quantile ranks of ``columns`` (seven at most), each range sorted by it:
    written as it is, each becomes a file, and a scan with conditions on any of the columns skips most files by their minima and maxima.
    One job finds the quantiles while the result is built.  Null values come first, text is told apart by its first six bytes."""
    if not 1 <= len(columns) <= 7:
        raise ValueError("one to seven columns")

    def run(df: DataFrame) -> DataFrame:
        names = {c: f"_rank{i}" for i, c in enumerate(columns)}
        ranked = banded(df, cuts(df, columns, 1 << BITS), names).withColumn("_curve", interleaved(list(names.values())))
        laid = ranked.repartitionByRange(files, "_curve", *columns).sortWithinPartitions("_curve", *columns)
        return laid.select(*[F.col(f"`{c}`") for c in df.columns])

    return run
