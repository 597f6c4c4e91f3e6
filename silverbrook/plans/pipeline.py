"""Operators are functions from DataFrame to DataFrame; pipelines are chains of them."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import DataFrame

Operator = Callable[[DataFrame], DataFrame]


class Pipeline:
    """An ordered chain of named operators; itself an operator.  Nothing runs until the result's action."""

    def __init__(self, steps: Iterable[tuple[str, Operator] | Operator] = ()):
        self.steps: list[tuple[str, Operator]] = []
        for step in steps:
            self.add(*step) if isinstance(step, tuple) else self.add(getattr(step, "__name__", "step"), step)

    def add(self, name: str, operator: Operator) -> Pipeline:
        self.steps.append((name, operator))
        return self

    def __len__(self) -> int:
        return len(self.steps)

    def __call__(self, df: DataFrame) -> DataFrame:
        return reduce(lambda d, step: d.transform(step[1]), self.steps, df)
