"""Scored quality reports of a table: completeness, uniqueness, validity, distribution, freshness and consistency."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F

from silverbrook.operators.joins import anti_join, semi_join
from silverbrook.quality.checks import CRITICAL, ERROR, RESULT, Result

#: Shares of good rows that pass.
COMPLETE, VALID, CONSISTENT = 0.95, 0.95, 0.99
# Fixed value: the pattern of an address that counts as valid.
EMAIL = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"


@dataclass(frozen=True)
class Measure:
    """A named aggregate pair: rows judged and rows good, with the share that passes."""

    name: str
    kind: str
    column: str | None
    total: Column
    valid: Column
    least: float
    needs: tuple[str, ...] = ()


def _set(c: str) -> Column:
    return F.count(F.col(c))


def completeness(required: Sequence[str]) -> list[Measure]:
    return [Measure(f"completeness_{c}", "completeness", c, F.count(F.lit(1)), _set(c), COMPLETE, (c,)) for c in required]


def complete_on_average(df: DataFrame, required: Sequence[str], important: Sequence[str] = (), severity: str = ERROR) -> list[Result]:
    """The verdict on the mean completeness of the required columns, then each column for information: what required ones
    hold, a missing one nothing, and important ones if they are there.  All in one aggregation."""
    found = evaluate(df, [replace(m, least=0.0) for m in completeness([*required, *(c for c in important if c in df.columns)])], severity)
    total = max((r.total or 0 for r in found), default=0)
    score = sum(r.score for r in found[: len(required)]) / len(required) if required else 0.0
    return [Result("completeness", "completeness", ",".join(required), severity, score >= COMPLETE, total, int(total * score), score), *found]


def uniqueness(*keys: str | Sequence[str]) -> list[Measure]:
    """Single columns and composite keys must both be unique."""
    out = []
    for key in keys:
        columns = [key] if isinstance(key, str) else list(key)
        out.append(Measure(f"uniqueness_{'_'.join(columns)}", "uniqueness", ",".join(columns), F.count(F.lit(1)), F.count_distinct(F.struct(*columns)), 1.0, tuple(columns)))
    return out


def emails(column: str) -> Measure:
    return Measure(f"email_{column}", "email", column, _set(column), F.count_if(F.col(column).rlike(EMAIL)), VALID, (column,))


def dates(column: str, low: Any = None, high: Any = None) -> Measure:
    """Dates from ``low`` to ``high``; give today or now as a value, so that a report can be repeated."""
    good = F.col(column).isNotNull()
    good = good & (F.col(column) >= F.lit(low)) if low is not None else good
    good = good & (F.col(column) <= F.lit(high)) if high is not None else good
    return Measure(f"date_{column}", "date", column, _set(column), F.count_if(good), VALID, (column,))


def numbers(column: str, low: float | None = None, high: float | None = None) -> Measure:
    good = F.col(column).isNotNull()
    good = good & (F.col(column) >= low) if low is not None else good
    good = good & (F.col(column) <= high) if high is not None else good
    return Measure(f"number_{column}", "number", column, _set(column), F.count_if(good), VALID, (column,))


def expected_values(column: str, values: Sequence[Any]) -> Measure:
    return Measure(f"values_{column}", "values", column, F.count(F.lit(1)), F.count_if(F.col(column).isin(list(values))), VALID, (column,))


def fresh(column: str, as_of: Any, hours: float) -> Measure:
    """Rows no older than ``hours`` at ``as_of``; one is enough to pass."""
    edge = F.lit(as_of).cast("timestamp") - F.make_dt_interval(hours=F.lit(int(hours)))
    return Measure(f"freshness_{column}", "freshness", column, _set(column), F.count_if(F.col(column).cast("timestamp") >= edge), 0.0, (column,))


def consistent(column: str, formula: str, tolerance: float = 0.01) -> Measure:
    """``column`` is what the SQL formula gives."""
    return Measure(f"consistency_{column}", "consistency", column, F.count(F.col(column) - F.expr(formula)), F.count_if(F.abs(F.col(column) - F.expr(formula)) <= tolerance), CONSISTENT, (column,))


def matches(name: str, sql: str, least: float = 1.0, where: str | None = None) -> Measure:
    """Rows (those of ``where``) for which a condition is true."""
    chosen = F.expr(where) if where else F.lit(True)
    return Measure(name, "rule", None, F.count_if(chosen), F.count_if(chosen & F.expr(sql)), least)


def evaluate(df: DataFrame, measures: Sequence[Measure], severity: str = ERROR) -> list[Result]:
    """All measures in one aggregation.  A missing column scores 0; no row to judge scores 1."""
    ready = [m for m in measures if all(c in df.columns for c in m.needs)]
    values = df.agg(*[x for i, m in enumerate(ready) for x in (m.total.alias(f"t{i}"), m.valid.alias(f"v{i}"))]).first() if ready else None
    at, out = {id(m): i for i, m in enumerate(ready)}, []
    for m in measures:
        if id(m) not in at:
            out.append(Result(m.name, m.kind, m.column, severity, False, None, None, 0.0, "missing column"))
            continue
        total, valid = values[f"t{at[id(m)]}"], values[f"v{at[id(m)]}"]
        score = 1.0 if total == 0 else valid / total
        passed = total == 0 or (valid > 0 if m.kind == "freshness" else score >= m.least)
        out.append(Result(m.name, m.kind, m.column, severity, passed, total, valid, score))
    return out


def distribution(df: DataFrame, column: str) -> DataFrame:
    """Rows of each value."""
    return df.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("rows"))


def monthly_distribution(df: DataFrame, column: str) -> DataFrame:
    """Rows of each month from the first to the last, empty ones too, so gaps show."""
    months = df.where(F.col(column).isNotNull()).groupBy(F.trunc(column, "month").alias("month")).agg(F.count(F.lit(1)).alias("rows"))
    # months are few whatever the input
    ends = months.agg(F.min("month").alias("a"), F.max("month").alias("b")).where("a is not null")
    every = ends.select(F.explode(F.sequence("a", "b", F.expr("interval 1 month"))).alias("month"))
    return every.join(months, "month", "left").select("month", F.coalesce("rows", F.lit(0).cast("long")).alias("rows"), F.col("rows").isNull().alias("gap"))


def foreign_key(child: DataFrame, column: str, parent: DataFrame, parent_column: str, least: float = CONSISTENT, severity: str = ERROR) -> Result:
    """Set child keys that a parent has."""
    keys = parent.select(F.col(parent_column).alias(column)).distinct()
    used = child.where(F.col(column).isNotNull()).select(column)
    total = used.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    found = total.join(keys.withColumn("_hit", F.lit(1)), column, "left").agg(F.sum("n").alias("total"), F.sum(F.when(F.col("_hit") == 1, F.col("n")).otherwise(0)).alias("valid")).first()
    n, valid = found["total"] or 0, found["valid"] or 0
    return Result(f"foreign_key_{column}", "foreign_key", column, severity, n == 0 or valid / n >= least, n, valid, 1.0 if n == 0 else valid / n)


def orphans(child: DataFrame, column: str, parent: DataFrame, parent_column: str, n: int = 10) -> DataFrame:
    """Up to ``n`` child rows without a parent."""
    keys = parent.select(F.col(parent_column).alias(column))
    return anti_join(child.where(F.col(column).isNotNull()), keys, column).limit(n)


def with_parent(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    return semi_join(child, parent.select(F.col(parent_column).alias(column)), column)


@dataclass(frozen=True)
class Rule:
    """A declarative rule: not_null, unique, regex, in_set or sql, on rows of ``where``."""

    name: str
    kind: str
    column: str | None = None
    value: Any = None
    where: str | None = None
    severity: str = ERROR

    def measure(self) -> Measure:
        chosen = F.expr(self.where) if self.where else F.lit(True)
        total = F.count_if(chosen)
        needs = tuple((self.column or "").split(",")) if self.column else ()
        if self.kind == "unique":
            key = F.struct(*[F.col(c) for c in needs])
            return Measure(self.name, self.kind, self.column, total, F.count_distinct(F.when(chosen, key)), 1.0, needs)
        test = {
            "not_null": lambda: F.col(self.column).isNotNull(),
            "regex": lambda: F.col(self.column).rlike(self.value),
            "in_set": lambda: F.col(self.column).isin(list(self.value)),
            "sql": lambda: F.expr(self.value),
        }
        if self.kind not in test:
            raise ValueError(f"unknown rule {self.kind!r}")
        return Measure(self.name, self.kind, self.column, total, F.count_if(chosen & test[self.kind]()), 1.0, needs)


def apply_rules(df: DataFrame, rules: Sequence[Rule]) -> list[Result]:
    """Evaluate rules; a failed critical one raises ValueError that names it."""
    out = [replace(r, severity=rule.severity) for r, rule in zip(evaluate(df, [r.measure() for r in rules]), rules, strict=True)]
    if bad := [r.check_name for r in out if not r.passed and r.severity == CRITICAL]:
        raise ValueError(f"critical rules failed: {', '.join(bad)}")
    return out


def write_report(results: Mapping[str, Sequence[Result]], spark, path: str, mode: str = "overwrite") -> None:
    """Results of several tables as Parquet, partitioned by table."""
    rows = [(table, r.check_name, r.check_type, r.column_name, r.severity, r.passed, r.total, r.valid, r.score, r.error) for table, rs in results.items() for r in rs]
    spark.createDataFrame(rows, f"table_name string, {RESULT}").write.mode(mode).partitionBy("table_name").parquet(path)
