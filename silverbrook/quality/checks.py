"""Data checks that run together: each check contributes aggregates, and one pass over the data computes all of them."""

from __future__ import annotations

import operator
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F

from silverbrook.errors import QualityError

WARNING, ERROR, CRITICAL = "warning", "error", "critical"

RESULT = "check_name string, check_type string, column_name string, severity string, passed boolean, total long, valid long, score double, error string"


@dataclass(frozen=True)
class Result:
    check_name: str
    check_type: str
    column_name: str | None
    severity: str
    passed: bool
    total: int | None = None
    valid: int | None = None
    score: float | None = None
    error: str | None = None

    @property
    def invalid(self) -> int | None:
        return None if self.total is None or self.valid is None else self.total - self.valid


@dataclass(frozen=True)
class Check:
    """``measures`` are aggregates; ``judge`` turns their values into (passed, total, valid)."""

    name: str
    kind: str
    column: str | None
    severity: str
    measures: tuple[Column, ...]
    judge: Callable[..., tuple[bool, int | None, int | None]]
    whole: Callable[[DataFrame], bool] | None = None
    needs: tuple[str, ...] = ()


def _ratio(valid: int | None, total: int | None) -> float | None:
    return None if total is None or valid is None else 1.0 if total == 0 else valid / total


@dataclass
class Checks:
    """A fluent list of checks.  Nulls pass the set and range checks, as SQL's NOT IN and comparisons leave them."""

    checks: list[Check] = field(default_factory=list)

    def _add(self, *args: Any, **more: Any) -> Checks:
        self.checks.append(Check(*args, **more))
        return self

    def not_null(self, *columns: str, severity: str = ERROR) -> Checks:
        for c in columns:
            self._add(f"not_null_{c}", "not_null", c, severity, (F.count(F.lit(1)), F.count(F.col(c))), lambda n, v: (n == v, n, v), needs=(c,))
        return self

    def unique(self, *columns: str, severity: str = ERROR) -> Checks:
        """No two rows with equal values; null is a value."""
        key = F.struct(*[F.col(c) for c in columns])
        return self._add(f"unique_{'_'.join(columns)}", "unique", ",".join(columns), severity, (F.count(F.lit(1)), F.count_distinct(key)), lambda n, v: (n == v, n, v), needs=columns)

    def in_set(self, column: str, values: Sequence[Any], severity: str = ERROR) -> Checks:
        bad = F.count_if(~F.col(column).isin(list(values)))
        return self._add(f"in_set_{column}", "in_set", column, severity, (F.count(F.lit(1)), bad), lambda n, b: (b == 0, n, n - b), needs=(column,))

    def in_range(self, column: str, low: Any = None, high: Any = None, severity: str = ERROR) -> Checks:
        tests = ([F.col(column) < F.lit(low)] if low is not None else []) + ([F.col(column) > F.lit(high)] if high is not None else [])
        bad = F.count_if(reduce(operator.or_, tests, F.lit(False)))
        return self._add(f"in_range_{column}", "in_range", column, severity, (F.count(F.lit(1)), bad), lambda n, b: (b == 0, n, n - b), needs=(column,))

    def row_count(self, low: int | None = None, high: int | None = None, severity: str = ERROR) -> Checks:
        return self._add("row_count", "row_count", None, severity, (F.count(F.lit(1)),), lambda n: ((low is None or n >= low) and (high is None or n <= high), n, n))

    def condition(self, name: str, sql: str, severity: str = ERROR) -> Checks:
        """No row for which the condition is false; where it is null the row passes."""
        bad = F.count_if(~F.expr(sql))
        return self._add(name, "condition", None, severity, (F.count(F.lit(1)), bad), lambda n, b: (b == 0, n, n - b))

    def custom(self, name: str, test: Callable[[DataFrame], bool], severity: str = ERROR) -> Checks:
        return self._add(name, "custom", None, severity, (), lambda: (False, None, None), whole=test)

    def run(self, df: DataFrame, fail: bool = False) -> list[Result]:
        """One aggregation for all checks but custom ones.  A check whose columns are missing, or that raises, has
        failed and says why."""
        ready = [c for c in self.checks if not c.whole and not [x for x in c.needs if x not in df.columns]]
        measures = [m.alias(f"m{i}_{j}") for i, c in enumerate(ready) for j, m in enumerate(c.measures)]
        values = df.agg(*measures).first() if measures else None
        at = {id(c): i for i, c in enumerate(ready)}
        out = []
        for c in self.checks:
            error = total = valid = None
            if c.whole:
                try:
                    passed = bool(c.whole(df))
                except Exception as e:  # noqa: BLE001  a check that can't run has failed
                    passed, error = False, f"{type(e).__name__}: {e}"[:500]
            elif id(c) not in at:
                passed, error = False, f"missing columns: {', '.join(x for x in c.needs if x not in df.columns)}"
            else:
                passed, total, valid = c.judge(*[values[f"m{at[id(c)]}_{j}"] for j in range(len(c.measures))])
            out.append(Result(c.name, c.kind, c.column, c.severity, passed, total, valid, _ratio(valid, total), error))
        if fail and (bad := [r.check_name for r in out if not r.passed and (r.severity != WARNING or r.error)]):
            raise QualityError("checks failed", {"checks": bad})
        return out

    def report(self, df: DataFrame) -> DataFrame:
        """The results as a DataFrame."""
        return results_frame(df, self.run(df))


def results_frame(df: DataFrame, results: Sequence[Result]) -> DataFrame:
    rows = [(r.check_name, r.check_type, r.column_name, r.severity, r.passed, r.total, r.valid, r.score, r.error) for r in results]
    return df.sparkSession.createDataFrame(rows, RESULT)


def summary(results: Sequence[Result]) -> dict[str, Any]:
    """Mean score of the checks that have one, and whether all passed."""
    scores = [r.score for r in results if r.score is not None]
    return {"checks": len(results), "failed": [r.check_name for r in results if not r.passed], "all_passed": all(r.passed for r in results), "score": sum(scores) / len(scores) if scores else 1.0}
