"""Compare registered queries with their SQL in DuckDB."""

from __future__ import annotations

import glob
import os
from typing import Any

import duckdb
import pandas as pd


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    """A connection in which every table of the folder is a view."""
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path if os.path.isfile(path) else path + '/*.parquet'}'")
    return con


def _value(x: Any) -> Any:
    if isinstance(x, float):
        return None if x != x else round(x, 6)
    if x is None or x is pd.NaT:
        return None
    if isinstance(x, pd.Timestamp):
        return x.to_pydatetime().isoformat()
    if hasattr(x, "isoformat"):
        return x.isoformat()
    if hasattr(x, "tolist"):
        return _value(x.tolist()) if not isinstance(x.tolist(), list) else tuple(map(_value, x.tolist()))
    return x


def rows(columns: list[str], data: list) -> list[tuple]:
    """Rows as comparable tuples, columns by name, in a fixed order."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_value(r[i]) for i in order) for r in data), key=repr)


def differences(spark_df, con: duckdb.DuckDBPyConnection, sql: str, most: int = 3) -> list[str]:
    found = con.execute(sql)
    names = [d[0] for d in found.description]
    if sorted(names) != sorted(spark_df.columns):
        return [f"columns {sorted(spark_df.columns)} / {sorted(names)}"]
    ours, theirs = rows(spark_df.columns, spark_df.collect()), rows(names, found.fetchall())
    if len(ours) != len(theirs):
        return [f"{len(ours)} rows, SQL has {len(theirs)}"]
    return [f"{a} / {b}" for a, b in zip(ours, theirs, strict=True) if a != b][:most]
