"""Column helpers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F


def parse_date(column: str | Column, formats: Sequence[str]) -> Column:
    """The date by the first format that parses it, else null."""
    c = F.col(column) if isinstance(column, str) else column
    return F.coalesce(*[F.try_to_timestamp(c, F.lit(f)).cast("date") for f in formats])


def parse_timestamp(column: str | Column, formats: Sequence[str]) -> Column:
    c = F.col(column) if isinstance(column, str) else column
    return F.coalesce(*[F.try_to_timestamp(c, F.lit(f)) for f in formats])


# The words for yes and no, and for the genders.
YES = ("true", "1", "yes", "oui", "y")
NO = ("false", "0", "no", "non", "n")
MALE = ("m", "male", "homme", "h")
FEMALE = ("f", "female", "femme")


def parse_boolean(column: str | Column) -> Column:
    """True for the words of ``YES``, false for those of ``NO``, in any case, else null."""
    c = F.lower(F.trim(F.col(column) if isinstance(column, str) else column))
    return F.when(c.isin(*YES), True).when(c.isin(*NO), False)


def parse_gender(column: str | Column) -> Column:
    """M, F or U."""
    c = F.lower(F.trim(F.col(column) if isinstance(column, str) else column))
    return F.when(c.isin(*MALE), "M").when(c.isin(*FEMALE), "F").otherwise("U")


def flag(condition: Column) -> Column:
    """Y where the condition is true, else N."""
    return F.when(condition, "Y").otherwise("N")
