"""Pipelines declared in YAML: lists of ``{op: name, ...parameters}`` and of checks."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from typing import Any

from silverbrook.errors import ConfigError
from silverbrook.operators import aggregate, clean, window
from silverbrook.plans.pipeline import Operator, Pipeline
from silverbrook.quality.checks import Checks
from silverbrook.sales import silver


def _aggs(items: Sequence[Mapping[str, Any]]) -> list[aggregate.Agg]:
    return [aggregate.Agg(**i) for i in items]


OPERATORS: dict[str, Callable[..., Operator]] = {
    "trim": clean.trim_strings,
    "drop_nulls": clean.drop_nulls,
    "fill_nulls": clean.fill_nulls,
    "drop_duplicates": clean.drop_duplicates,
    "lower": clean.lower_case,
    "upper": clean.upper_case,
    "keep_ranked": clean.keep_ranked,
    "cast": clean.cast_columns,
    "valid_rows": clean.valid_rows,
    "keep_existing": clean.keep_existing,
    "stamp_ingestion": clean.stamp_ingestion,
    "aggregate": lambda keys, aggs, **more: aggregate.aggregate(keys, _aggs(aggs), **more),
    "rollup": lambda keys, aggs, **more: aggregate.rollup(keys, _aggs(aggs), **more),
    "cube": lambda keys, aggs, **more: aggregate.cube(keys, _aggs(aggs), **more),
    "pivot": aggregate.pivot,
    "unpivot": aggregate.unpivot,
    "running_total": window.running_total,
    "add_rank": window.add_rank,
    "top_per_group": window.top_per_group,
    "margin": silver.margin_percent,
    "high_value": silver.high_value_orders,
    "repeat_orders": silver.repeat_orders,
    "delivery_time": silver.delivery_time,
    "tax": silver.add_tax,
    "discount": silver.add_discount,
    "payment_status": silver.payment_status,
    "fulfilment_status": silver.fulfilment_status,
}
_CHECKS = ("not_null", "unique", "in_set", "in_range", "row_count", "condition")


def declared_pipeline(steps: Sequence[Mapping[str, Any]]) -> Pipeline:
    out = Pipeline()
    for step in steps:
        more = dict(step)
        name = more.pop("op", None)
        if name not in OPERATORS:
            raise ConfigError("unknown operator", {"op": name})
        out.add(name, OPERATORS[name](**more))
    return out


def declared_checks(items: Sequence[Mapping[str, Any]]) -> Checks:
    out = Checks()
    for item in items:
        more = dict(item)
        name = more.pop("check", None)
        if name not in _CHECKS:
            raise ConfigError("unknown check", {"check": name})
        getattr(out, name)(*more.pop("columns", ()), **more)
    return out
