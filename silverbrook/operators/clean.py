"""Cleaning, schema and projection operators."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import DataType, StringType, StructType

from silverbrook.errors import SchemaError
from silverbrook.plans.pipeline import Operator


def _present(df: DataFrame, columns: Sequence[str]) -> list[str]:
    return [c for c in columns if c in df.columns]


def trim_strings(columns: Sequence[str] | None = None) -> Operator:
    """Trim the given string columns, or all of them."""

    def run(df: DataFrame) -> DataFrame:
        strings = [f.name for f in df.schema if isinstance(f.dataType, StringType)]
        wanted = [c for c in strings if columns is None or c in columns]
        return df.withColumns({c: F.trim(c) for c in wanted}) if wanted else df

    return run


def drop_nulls(columns: Sequence[str] | None = None, how: str = "any", thresh: int | None = None) -> Operator:
    """Drop rows with nulls in any or all of the columns, or with fewer than ``thresh`` values."""
    return lambda df: df.dropna(how=how, thresh=thresh, subset=list(columns) if columns else None)


def fill_nulls(values: Mapping[str, Any]) -> Operator:
    return lambda df: df.fillna(dict(values))


def drop_duplicates(columns: Sequence[str] | None = None) -> Operator:
    """One row per distinct row, or per distinct value of the columns; which one is arbitrary (see :func:`keep_ranked`)."""
    return lambda df: df.dropDuplicates(list(columns)) if columns else df.dropDuplicates()


def lower_case(columns: Sequence[str]) -> Operator:
    return lambda df: df.withColumns({c: F.lower(c) for c in _present(df, columns)})


def upper_case(columns: Sequence[str]) -> Operator:
    return lambda df: df.withColumns({c: F.upper(c) for c in _present(df, columns)})


def keep_ranked(keys: Sequence[str], order: str, descending: bool = True, keep: str = "first", ties: Sequence[str] = ()) -> Operator:
    """The first or the last row of each key by one column; ``ties`` are further columns, ascending for ``first``.
    Null keys are a key; the null order value stands as Spark sorts it."""
    if keep not in ("first", "last"):
        raise ValueError(f"keep must be first or last, not {keep!r}")

    def run(df: DataFrame) -> DataFrame:
        down = descending == (keep == "first")
        by = [F.col(order).desc() if down else F.col(order).asc(), *[F.col(c).asc() if keep == "first" else F.col(c).desc() for c in ties]]
        rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*by))
        return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")

    return run


def enforce_schema(schema: StructType, strict: bool = True, fill_missing: bool = False) -> Operator:
    """Project to the schema's columns in its order and cast them.  Extra columns go.  A missing one is an error when
    strict, a typed null when filled, and otherwise left out."""

    def run(df: DataFrame) -> DataFrame:
        missing = [f.name for f in schema if f.name not in df.columns]
        if missing and strict and not fill_missing:
            raise SchemaError("columns are missing", {"missing": missing})
        return df.select(
            *[
                F.col(f.name).cast(f.dataType).alias(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name)
                for f in schema
                if f.name in df.columns or fill_missing
            ]
        )

    return run


def cast_columns(types: Mapping[str, str | DataType], lenient: bool = True) -> Operator:
    """Cast the columns that exist; what can't be cast becomes null, or an error when not lenient."""

    def one(name: str, kind: str | DataType) -> Column:
        return F.col(name).try_cast(kind) if lenient else F.col(name).cast(kind)

    return lambda df: df.withColumns({c: one(c, t) for c, t in types.items() if c in df.columns})


def valid_rows(not_null: Sequence[str] = (), conditions: Sequence[str] = ()) -> Operator:
    """Rows whose columns are set and for which every SQL condition is true."""

    def run(df: DataFrame) -> DataFrame:
        for test in [F.col(c).isNotNull() for c in not_null] + [F.expr(c) for c in conditions]:
            df = df.where(test)
        return df

    return run


def keep_existing(columns: Sequence[str]) -> Operator:
    """Those of the columns that exist, in the given order."""
    return lambda df: df.select(*_present(df, columns))


def stamp_ingestion(source: str | None = None, job: str | None = None, file_name: bool = False) -> Operator:
    """Ingestion time, and where rows come from."""

    def run(df: DataFrame) -> DataFrame:
        extra: dict[str, Column] = {"_ingestion_timestamp": F.current_timestamp()}
        if source is not None:
            extra["_source"] = F.lit(source)
        if job is not None:
            extra["_job_name"] = F.lit(job)
        if file_name:
            extra["_source_file"] = F.col("_metadata.file_path")
        return df.withColumns(extra)

    return run
