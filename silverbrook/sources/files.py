"""CSV, JSON and Parquet sources and sinks.

Options are Spark's own, given by keyword under snake_case names; what isn't listed goes through ``options``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, fields, replace
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import DataType, StructType

from silverbrook.errors import SinkError

MODES = ("append", "overwrite", "error", "errorifexists", "ignore")


def _camel(name: str) -> str:
    head, *rest = name.split("_")
    return head + "".join(x.title() for x in rest)


def _spark_options(settings: Any, skip: Sequence[str]) -> dict[str, str]:
    out = {}
    for f in fields(settings):
        value = getattr(settings, f.name)
        if f.name not in skip and value is not None:
            out[_camel(f.name)] = str(value).lower() if isinstance(value, bool) else str(value)
    return out | {k: str(v) for k, v in settings.options.items()}


@dataclass(frozen=True)
class _Source:
    path: str | Sequence[str] = ""
    schema: StructType | str | None = None
    options: Mapping[str, Any] = field(default_factory=dict)

    _format = ""

    def with_options(self, **changes: Any):
        """A copy with other settings."""
        return replace(self, **changes)

    def read(self, spark: SparkSession) -> DataFrame:
        if not self.path:
            raise ValueError("a source needs a path")
        reader = spark.read.format(self._format).options(**_spark_options(self, ("path", "schema", "options")))
        if self.schema is not None:
            reader = reader.schema(self.schema).option("inferSchema", "false")
        return reader.load(self.path if isinstance(self.path, str) else list(self.path))

    def preview(self, spark: SparkSession, n: int = 5) -> DataFrame:
        return self.read(spark).limit(n)

    def describe(self, spark: SparkSession) -> dict[str, Any]:
        """Columns, types, schema and number of rows; the latter reads the data."""
        df = self.read(spark)
        return {"columns": df.columns, "dtypes": df.dtypes, "schema": df.schema.json(), "row_count": df.count()}


@dataclass(frozen=True)
class Csv(_Source):
    header: bool = True
    sep: str = ","
    quote: str = '"'
    escape: str = "\\"
    encoding: str = "UTF-8"
    infer_schema: bool = True
    multi_line: bool = False
    ignore_leading_white_space: bool = True
    ignore_trailing_white_space: bool = True
    mode: str = "PERMISSIVE"
    null_value: str | None = None
    empty_value: str | None = None
    date_format: str | None = None
    timestamp_format: str | None = None
    column_name_of_corrupt_record: str = "_corrupt_record"

    _format = "csv"


@dataclass(frozen=True)
class Json(_Source):
    multi_line: bool = False
    primitives_as_string: bool = False
    prefers_decimal: bool = False
    allow_comments: bool = False
    allow_unquoted_field_names: bool = False
    allow_single_quotes: bool = False
    allow_numeric_leading_zeros: bool = False
    allow_backslash_escaping_any_character: bool = False
    allow_unquoted_control_chars: bool = False
    mode: str = "PERMISSIVE"
    column_name_of_corrupt_record: str = "_corrupt_record"
    date_format: str | None = None
    timestamp_format: str | None = None
    encoding: str | None = None
    line_sep: str | None = None
    sampling_ratio: float = 1.0
    drop_field_if_all_null: bool = False

    _format = "json"


@dataclass(frozen=True)
class Parquet(_Source):
    merge_schema: bool = False
    path_glob_filter: str | None = None

    _format = "parquet"


def read_json_lines(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    return Json(path, schema).read(spark)


def read_json_documents(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """Files that hold one JSON value over several lines."""
    return Json(path, schema, multi_line=True).read(spark)


def flatten(df: DataFrame, separator: str = "_") -> DataFrame:
    """Fields of nested structs as columns ``a_b_c``; arrays and maps stay."""

    def leaves(kind: DataType, path: tuple[str, ...]) -> list[Column]:
        if isinstance(kind, StructType):
            return [c for f in kind for c in leaves(f.dataType, (*path, f.name))]
        return [F.col(".".join(f"`{p}`" for p in path)).alias(separator.join(path))]

    return df.select(*leaves(df.schema, ()))


@dataclass(frozen=True)
class _Sink:
    path: str = ""
    mode: str = "errorifexists"
    partition_by: Sequence[str] = ()
    single_file: bool = False
    files: int | None = None
    options: Mapping[str, Any] = field(default_factory=dict)

    _format = ""

    def with_options(self, **changes: Any):
        return replace(self, **changes)

    def _shape(self, df: DataFrame) -> DataFrame:
        return df

    def write(self, df: DataFrame) -> str:
        """Write and return the path.  ``single_file`` is for small results: one task writes it all."""
        if not self.path:
            raise ValueError("a sink needs a path")
        if self.mode not in MODES:
            raise SinkError(f"unknown mode {self.mode!r}")
        df = self._shape(df)
        df = df.coalesce(1) if self.single_file else df.repartition(self.files) if self.files else df
        writer = df.write.format(self._format).mode(self.mode).options(**_spark_options(self, _SINK_FIELDS))
        (writer.partitionBy(*self.partition_by) if self.partition_by else writer).save(self.path)
        return self.path


_SINK_FIELDS = ("path", "mode", "partition_by", "single_file", "files", "options", "root_columns", "structs", "group_by", "array_column", "array_fields")


@dataclass(frozen=True)
class CsvSink(_Sink):
    header: bool = True
    sep: str = ","
    quote: str = '"'
    escape: str = "\\"
    encoding: str = "UTF-8"
    quote_all: bool = False
    line_sep: str | None = None
    null_value: str | None = None
    empty_value: str = ""
    date_format: str | None = None
    timestamp_format: str | None = None
    compression: str | None = None
    char_to_escape_quote_escaping: str | None = None

    _format = "csv"


@dataclass(frozen=True)
class JsonSink(_Sink):
    encoding: str = "UTF-8"
    line_sep: str | None = None
    ignore_null_fields: bool = True
    compression: str | None = None
    date_format: str | None = None
    timestamp_format: str | None = None
    pretty: bool | None = None

    _format = "json"


@dataclass(frozen=True)
class NestedJsonSink(JsonSink):
    """Root columns beside named structs of other columns."""

    root_columns: Sequence[str] = ()
    structs: Mapping[str, Sequence[str]] = field(default_factory=dict)

    def _shape(self, df: DataFrame) -> DataFrame:
        return df.select(*self.root_columns, *[F.struct(*columns).alias(name) for name, columns in self.structs.items()])


@dataclass(frozen=True)
class ArrayJsonSink(JsonSink):
    """One row per group with an array of its rows' fields.  A group is gathered in one row: groups must be small."""

    group_by: Sequence[str] = ()
    array_column: str = "items"
    array_fields: Sequence[str] = ()

    def _shape(self, df: DataFrame) -> DataFrame:
        return df.groupBy(*self.group_by).agg(F.collect_list(F.struct(*self.array_fields)).alias(self.array_column))


@dataclass(frozen=True)
class ParquetSink(_Sink):
    compression: str = "snappy"
    max_records_per_file: int | None = None

    _format = "parquet"

    def write_by_date(self, df: DataFrame, column: str, granularity: str = "day") -> str:
        """Partition by year, year and month, or year, month and day of a date column."""
        parts = {"year": F.year(column), "month": F.month(column), "day": F.dayofmonth(column)}
        depth = {"day": 3, "month": 2}.get(granularity, 1)
        chosen = dict(list(parts.items())[:depth])
        return replace(self, partition_by=tuple(chosen)).write(df.withColumns(chosen))


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", **settings: Any) -> str:
    return CsvSink(path, mode, **settings).write(df)


def write_json(df: DataFrame, path: str, mode: str = "overwrite", **settings: Any) -> str:
    return JsonSink(path, mode, **settings).write(df)


def write_json_lines(df: DataFrame, path: str, mode: str = "overwrite", compression: str = "gzip", **settings: Any) -> str:
    return JsonSink(path, mode, compression=compression, **settings).write(df)
