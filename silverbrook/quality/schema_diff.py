"""Compare a DataFrame's schema with the one it should have."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from silverbrook.errors import SchemaError


@dataclass(frozen=True)
class SchemaDiff:
    missing: list[str] = field(default_factory=list)
    extra: list[str] = field(default_factory=list)
    types: dict[str, tuple[str, str]] = field(default_factory=dict)
    nullable: list[str] = field(default_factory=list)
    valid: bool = True


def schema_diff(df: DataFrame, expected: StructType, strict: bool = False, check_nullable: bool = False) -> SchemaDiff:
    """Columns that are missing, extra, of another type (found, expected) or nullable though they shouldn't be.  Valid
    without missing ones and other types, when strict without extra ones, and where asked for without nullable ones."""
    have = {f.name: f for f in df.schema}
    want = {f.name: f for f in expected}
    missing = [n for n in want if n not in have]
    extra = [n for n in have if n not in want]
    types = {n: (have[n].dataType.simpleString(), f.dataType.simpleString()) for n, f in want.items() if n in have and have[n].dataType != f.dataType}
    nullable = [n for n, f in want.items() if n in have and have[n].nullable and not f.nullable]
    valid = not missing and not types and not (strict and extra) and not (check_nullable and nullable)
    return SchemaDiff(missing, extra, types, nullable, valid)


def require_schema(df: DataFrame, expected: StructType, strict: bool = False, check_nullable: bool = False) -> DataFrame:
    found = schema_diff(df, expected, strict, check_nullable)
    if not found.valid:
        raise SchemaError("schema differs", {"missing": found.missing, "extra": found.extra if strict else [], "types": found.types, "nullable": found.nullable if check_nullable else []})
    return df
