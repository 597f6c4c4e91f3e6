"""Metrics of streams: what each batch read, kept and left out."""

from __future__ import annotations

import threading
from dataclasses import dataclass

from pyspark.sql.streaming import StreamingQueryListener

from silverbrook.plans.jobs import METRICS, Metrics, RunResult


@dataclass(frozen=True)
class Batch:
    """``watermark``: as text, none before the first; ``late``: rows that came after it, where an operator has counted them."""

    stream: str
    number: int
    rows: int
    watermark: str | None
    state_rows: int
    late: int
    seconds: float


class StreamMetrics(StreamingQueryListener):
    """Collects the batches of all streams of a session; each stream that ends is recorded as a run in ``metrics``.
    Add it with ``spark.streams.addListener``.  Only the ``most`` last batches are kept."""

    def __init__(self, metrics: Metrics = METRICS, most: int = 10_000):
        self.metrics, self.most = metrics, most
        self.batches: list[Batch] = []
        self._names: dict[str, str] = {}
        self._rows: dict[str, int] = {}
        self._ended: set[str] = set()
        self._news = threading.Condition()

    def onQueryStarted(self, event) -> None:
        with self._news:
            self._names[str(event.runId)] = event.name or str(event.id)
            self.metrics.active.add(self._names[str(event.runId)])

    def onQueryProgress(self, event) -> None:
        p = event.progress
        state = p.stateOperators
        with self._news:
            name = self._names.get(str(p.runId), p.name or str(p.id))
            batch = Batch(name, p.batchId, p.numInputRows, (p.eventTime or {}).get("watermark"), sum(s.numRowsTotal for s in state), sum(s.numRowsDroppedByWatermark for s in state), p.batchDuration / 1000)
            self.batches = [*self.batches[-self.most + 1 :], batch]
            self._rows[str(p.runId)] = self._rows.get(str(p.runId), 0) + p.numInputRows

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        run = str(event.runId)
        with self._news:
            name = self._names.pop(run, str(event.id))
            self.metrics.active.discard(name)
            self.metrics.record(RunResult(name, "failed" if event.exception else "success", {"input": self._rows.pop(run, 0)}, error=event.exception))
            self._ended.add(run)
            self._news.notify_all()

    def wait(self, run: str, seconds: float = 30) -> bool:
        """Wait until a run's end has been told; events come some time after a stream has stopped."""
        with self._news:
            return self._news.wait_for(lambda: str(run) in self._ended, seconds)
