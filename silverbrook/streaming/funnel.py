"""Keyed state with timers: how far each key gets along a row of steps before its time is up."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType

from silverbrook.plans.pipeline import Operator
from silverbrook.streaming.events import timed

NOTHING = (None, 0, None)
_OUT = "key string, began long, reached int, ended long"


class _Funnel(StatefulProcessor):
    """An attempt begins with the first step and is over with the last one or ``limit`` milliseconds after its beginning;
    steps out of turn change nothing.  State is one row a key: when the open attempt began, its steps and the latest of their times."""

    def __init__(self, steps: Sequence[str], limit: int):
        self.steps, self.limit = list(steps), limit

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.attempt = handle.getValueState("attempt", "began long, reached int, last long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        # each use of state or timers asks the JVM, so a key's are read once a batch and written once where they have changed
        before = self.attempt.get()
        before = None if before is None else tuple(before)
        began, reached, last = before or NOTHING
        events = [e for df in rows for e in zip(df["at"].tolist(), df["step"].tolist(), strict=True)]
        out = []
        for at, step in sorted(events, key=lambda e: (e[0], e[1] or "")):
            if began is not None and at > began + self.limit:
                out.append((key[0], began, reached, last))
                began, reached, last = NOTHING
            if step != self.steps[reached]:
                continue
            began, reached, last = at if began is None else began, reached + 1, at if last is None else max(last, at)
            if reached == len(self.steps):
                out.append((key[0], began, reached, last))
                began, reached, last = NOTHING
        self._keep(before, None if began is None else (began, reached, last))
        if out:
            yield self._frame(out)

    def _keep(self, before: tuple | None, after: tuple | None) -> None:
        if after == before:
            return
        old, new = (None if a is None else a[0] + self.limit + 1 for a in (before, after))
        if old != new:
            if old is not None:
                self.handle.deleteTimer(old)
            if new is not None:
                self.handle.registerTimer(new)
        if after is None:
            self.attempt.clear()
        else:
            self.attempt.update(after)

    def _frame(self, out: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame(out, columns=["key", "began", "reached", "ended"]).astype({"began": "int64", "reached": "int32", "ended": "int64"})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        found = self.attempt.get()
        if found is not None and expiredTimerInfo.getExpiryTimeInMs() > found[0] + self.limit:
            self.attempt.clear()
            yield self._frame([(key[0], *found)])

    def close(self) -> None:
        pass


def funnel(key: str, time: str, step: str, steps: Sequence[str], minutes: int, late: str) -> Operator:
    """Each key's attempts at ``steps`` in turn: ``key`` (as text), when it ``began``, how many steps were ``reached`` within ``minutes``,
    and when the last of them was.  An attempt comes out when it is complete, when a later event shows that its time is over, or when the
    watermark does.  Events of a key are taken in the order of time within a batch; rows without a key or a time are left out.
    The session must use the RocksDB state store."""

    def run(df: DataFrame) -> DataFrame:
        rows = df.where(F.col(key).isNotNull() & F.col(time).isNotNull()).select(F.col(key).cast("string").alias("key"), time, F.col(step).alias("step"))
        rows = timed(time, late)(rows).withColumn("at", F.unix_millis(time))
        out = rows.groupBy("key").transformWithStateInPandas(_Funnel(steps, minutes * 60_000), StructType.fromDDL(_OUT), "append", "eventTime")
        return out.select("key", F.timestamp_millis("began").alias("began"), "reached", F.timestamp_millis("ended").alias("ended"))

    return run

