"""Jobs: extract, transform, validate, load, with counts taken on the way and one log record a run."""

from __future__ import annotations

import logging
import time
from collections.abc import Callable, Iterator, Mapping
from contextlib import contextmanager
from dataclasses import dataclass, field
from typing import Any

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from silverbrook.errors import SilverbrookError
from silverbrook.plans.pipeline import Operator
from silverbrook.quality.checks import Checks, Result, summary

log = logging.getLogger("silverbrook.jobs")

Frames = dict[str, DataFrame]


@dataclass
class RunResult:
    job: str
    status: str
    rows: dict[str, int] = field(default_factory=dict)
    seconds: float = 0.0
    checks: dict[str, list[Result]] = field(default_factory=dict)
    error: str | None = None

    def to_dict(self) -> dict[str, Any]:
        return {"job": self.job, "status": self.status, "records_processed": sum(self.rows.values()), "duration_seconds": self.seconds, "rows": self.rows, "checks": {t: summary(r) for t, r in self.checks.items()}, "error": self.error}


class Metrics:
    """Counts by job and status; a listener gets every run, to pass on to a monitoring system."""

    def __init__(self) -> None:
        self.runs: list[RunResult] = []
        self.active: set[str] = set()
        self.listeners: list[Callable[[RunResult], None]] = []

    def record(self, run: RunResult) -> None:
        self.runs.append(run)
        for f in self.listeners:
            f(run)

    def totals(self) -> dict[tuple[str, str], int]:
        out: dict[tuple[str, str], int] = {}
        for r in self.runs:
            out[r.job, r.status] = out.get((r.job, r.status), 0) + 1
        return out


METRICS = Metrics()


@contextmanager
def track(job: str, metrics: Metrics = METRICS, **context: Any) -> Iterator[RunResult]:
    """Time a block and record how it ended."""
    run, begun = RunResult(job, "running"), time.time()
    metrics.active.add(job)
    try:
        yield run
        run.status = "success"
    except Exception as e:
        run.status, run.error = "failed", f"{type(e).__name__}: {e}"
        raise
    finally:
        run.seconds = time.time() - begun
        metrics.active.discard(job)
        metrics.record(run)
        log.info("job %s %s in %.1f s", job, run.status, run.seconds, extra={"job": job, "rows": run.rows, **context})


@dataclass(frozen=True)
class Job:
    """``extract`` gives named tables, ``transform`` makes the results from them, ``checks`` judge those by name, and
    ``load`` writes them.

    Results are kept between checks and load, so their plans run once; rows are counted while they are written.
    """

    name: str
    extract: Callable[[SparkSession], Frames]
    transform: Callable[[Frames], Frames]
    load: Callable[[str, DataFrame], None]
    checks: Mapping[str, Checks] = field(default_factory=dict)
    fail_on_error: bool = True

    def run(self, spark: SparkSession, metrics: Metrics = METRICS) -> RunResult:
        try:
            with track(self.name, metrics) as run:
                results = self.transform(self.extract(spark))
                for name, df in results.items():
                    kept = df.persist(StorageLevel.MEMORY_AND_DISK) if name in self.checks else df
                    try:
                        if name in self.checks:
                            run.checks[name] = self.checks[name].run(kept, fail=self.fail_on_error)
                        seen = Observation(f"{self.name}-{name}")
                        self.load(name, kept.observe(seen, F.count(F.lit(1)).alias("rows")))
                        run.rows[name] = seen.get["rows"]
                    finally:
                        if name in self.checks:
                            kept.unpersist()
        except SilverbrookError:
            raise
        except Exception as e:
            raise SilverbrookError(f"job {self.name} failed", {"error": str(e)[:2000]}) from e
        return run


def chain(*operators: Operator, source: str = "input", result: str = "output") -> Callable[[Frames], Frames]:
    """A transform of one table through operators."""

    def run(frames: Frames) -> Frames:
        df = frames[source]
        for op in operators:
            df = df.transform(op)
        return {result: df}

    return run


#: What must have run before a job; jobs on one level may run side by side.
DEPENDENCIES = {
    "ingest_orders": (),
    "ingest_customers": (),
    "ingest_products": (),
    "enrich_orders": ("ingest_orders", "ingest_customers", "ingest_products"),
    "daily_sales": ("enrich_orders",),
    "product_sales": ("enrich_orders",),
    "customer_sales": ("enrich_orders",),
    "monthly_trends": ("enrich_orders",),
    "segment_analysis": ("enrich_orders",),
    "top_products": ("enrich_orders",),
    "rfm": ("enrich_orders",),
}
