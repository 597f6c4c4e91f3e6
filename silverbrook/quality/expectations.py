"""Expectation suites: lists of ``{"expectation_type": ..., "kwargs": {...}}``, evaluated in one pass.

Nulls fail the set, range and regex expectations; an empty table passes.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from dataclasses import asdict, dataclass, field
from pathlib import Path
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F

# Names that suites use for types, and the types each accepts.
TYPE_NAMES = {
    "string": ("string",),
    "str": ("string",),
    "int": ("int", "bigint"),
    "integer": ("int", "bigint"),
    "long": ("bigint",),
    "bigint": ("bigint",),
    "float": ("float", "double"),
    "double": ("double",),
    "boolean": ("boolean",),
    "bool": ("boolean",),
    "date": ("date",),
    "timestamp": ("timestamp", "timestamp_ntz"),
}


@dataclass
class Outcome:
    expectation: str
    success: bool
    column: str | None = None
    total: int | None = None
    passed: int | None = None
    details: dict[str, Any] = field(default_factory=dict)


@dataclass
class SuiteResult:
    suite: str
    outcomes: list[Outcome]

    @property
    def success(self) -> bool:
        return all(o.success for o in self.outcomes)

    @property
    def success_rate(self) -> float:
        return sum(o.success for o in self.outcomes) / len(self.outcomes) if self.outcomes else 1.0

    def failures(self) -> list[Outcome]:
        return [o for o in self.outcomes if not o.success]

    def to_dict(self) -> dict[str, Any]:
        return {"suite": self.suite, "success": self.success, "success_rate": self.success_rate, "total": len(self.outcomes), "failed": len(self.failures()), "outcomes": [asdict(o) for o in self.outcomes]}


def _rows() -> Column:
    return F.count(F.lit(1))


def _mostly(kind: str, column: str, good: Column, mostly: float, more: Mapping[str, Column] | None = None, samples: bool = False):
    """A share of rows that must be good."""
    measures = {"total": _rows(), "good": F.count_if(good), **(more or {})}
    if samples:
        # the least and the greatest offending value: a bounded state, unlike a list of them
        bad = F.when(F.coalesce(~good, F.lit(True)), F.col(column).cast("string"))
        measures["sample"] = F.array_distinct(F.array_compact(F.array(F.min(bad), F.max(bad))))

    def judge(v: Mapping[str, Any]) -> Outcome:
        total, passed = v["total"], v["good"]
        details = {k: v[k] for k in v if k not in ("total", "good")}
        return Outcome(kind, total == 0 or passed / total >= mostly, column, total, passed, details)

    return measures, judge


def _column_exists(df: DataFrame, column: str):
    return {}, lambda v: Outcome("expect_column_to_exist", column in df.columns, column)


def _not_null(df: DataFrame, column: str, mostly: float = 1.0):
    return _mostly("expect_column_values_to_not_be_null", column, F.col(column).isNotNull(), mostly)


def _unique(df: DataFrame, column: str, mostly: float = 1.0):
    measures = {"total": _rows(), "good": F.count_distinct(F.struct(column))}
    return measures, lambda v: Outcome("expect_column_values_to_be_unique", v["total"] == 0 or v["good"] / v["total"] >= mostly, column, v["total"], v["good"])


def _in_set(df: DataFrame, column: str, value_set: Sequence[Any], mostly: float = 1.0):
    return _mostly("expect_column_values_to_be_in_set", column, F.col(column).isin(list(value_set)), mostly, samples=True)


def _between(df: DataFrame, column: str, min_value: Any = None, max_value: Any = None, mostly: float = 1.0):
    good = F.col(column).isNotNull()
    good = good & (F.col(column) >= F.lit(min_value)) if min_value is not None else good
    good = good & (F.col(column) <= F.lit(max_value)) if max_value is not None else good
    return _mostly("expect_column_values_to_be_between", column, good, mostly, {"observed_min": F.min(column), "observed_max": F.max(column)})


def _regex(df: DataFrame, column: str, regex: str, mostly: float = 1.0):
    return _mostly("expect_column_values_to_match_regex", column, F.col(column).rlike(regex), mostly, samples=True)


def _row_count(df: DataFrame, min_value: int | None = None, max_value: int | None = None):
    return {"total": _rows()}, lambda v: Outcome("expect_table_row_count_to_be_between", (min_value is None or v["total"] >= min_value) and (max_value is None or v["total"] <= max_value), None, v["total"])


def _mean(df: DataFrame, column: str, min_value: float | None = None, max_value: float | None = None):
    def judge(v: Mapping[str, Any]) -> Outcome:
        m = v["mean"]
        ok = m is not None and (min_value is None or m >= min_value) and (max_value is None or m <= max_value)
        return Outcome("expect_column_mean_to_be_between", ok, column, details={"mean": m})

    return {"mean": F.avg(column)}, judge


def _of_type(df: DataFrame, column: str, type_: str):
    found = dict(df.dtypes)[column]
    return {}, lambda v: Outcome("expect_column_values_to_be_of_type", found in TYPE_NAMES.get(type_.lower(), (type_.lower(),)), column, details={"type": found})


EXPECTATIONS: dict[str, Callable] = {
    "expect_column_to_exist": _column_exists,
    "expect_column_values_to_not_be_null": _not_null,
    "expect_column_values_to_be_unique": _unique,
    "expect_column_values_to_be_in_set": _in_set,
    "expect_column_values_to_be_between": _between,
    "expect_column_values_to_match_regex": _regex,
    "expect_table_row_count_to_be_between": _row_count,
    "expect_column_mean_to_be_between": _mean,
    "expect_column_values_to_be_of_type": _of_type,
}


def run_expectations(df: DataFrame, expectations: Sequence[Mapping[str, Any]], suite: str = "inline") -> SuiteResult:
    """Evaluate a list of expectations with one aggregation."""
    measures, judges = [], []
    for i, e in enumerate(expectations):
        kind, kwargs = e["expectation_type"], dict(e.get("kwargs", {}))
        column = kwargs.get("column")
        if kind not in EXPECTATIONS:
            judges.append((kind, {}, lambda v, k=kind: Outcome(k, False, details={"error": "unknown expectation"})))
        elif column is not None and column not in df.columns and kind != "expect_column_to_exist":
            judges.append((kind, {}, lambda v, k=kind, c=column: Outcome(k, False, c, details={"error": "no such column"})))
        else:
            found, judge = EXPECTATIONS[kind](df, **kwargs)
            measures += [m.alias(f"m{i}_{name}") for name, m in found.items()]
            judges.append((kind, found, judge))
    values = df.agg(*measures).first() if measures else None
    return SuiteResult(suite, [judge({n: values[f"m{i}_{n}"] for n in found}) for i, (_, found, judge) in enumerate(judges)])


class SuiteFolder:
    """Suites as JSON files in a folder of the driver; read once."""

    def __init__(self, folder: str | Path):
        self.folder, self._known = Path(folder), {}

    def names(self) -> list[str]:
        return sorted(p.stem for p in self.folder.glob("*.json"))

    def create(self, name: str, expectations: Sequence[Mapping[str, Any]]) -> Path:
        self.folder.mkdir(parents=True, exist_ok=True)
        path = self.folder / f"{name}.json"
        path.write_text(json.dumps({"name": name, "expectations": list(expectations)}, indent=2))
        self._known.pop(name, None)
        return path

    def load(self, name: str) -> list[dict[str, Any]]:
        if name not in self._known:
            self._known[name] = json.loads((self.folder / f"{name}.json").read_text())["expectations"]
        return self._known[name]

    def run(self, df: DataFrame, name: str, save_to: str | Path | None = None) -> SuiteResult:
        out = run_expectations(df, self.load(name), name)
        if save_to:
            Path(save_to).write_text(json.dumps(out.to_dict(), indent=2, default=str))
        return out
