"""Sinks of streams that take each batch as a DataFrame."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.streaming import StreamingQuery

from silverbrook.streaming.kafka import start


@dataclass(frozen=True)
class UpsertFolder:
    """A table of which each batch of a stream replaces rows by key.

    A batch is written, one row a key, to a folder named by its number; a batch that is played again, because the stream
    stopped after the write and before its commit, overwrites that folder, so nothing counts twice.  A write costs the batch
    alone.  Readers take each key's row with the highest ``order``, by default the latest batch's; :meth:`fold` writes that down
    as a plain table from time to time.  A folder belongs to one checkpoint, whose batch numbers it uses.
    """

    path: str
    keys: Sequence[str]
    order: Sequence[str] = ()

    def _latest(self, df: DataFrame, order: Sequence[str]) -> DataFrame:
        rest = sorted(c for c in df.columns if c not in (*self.keys, *order))
        level = Window.partitionBy(*self.keys).orderBy(*[F.desc_nulls_last(c) for c in order], *[F.desc_nulls_last(c) for c in rest])
        return df.withColumn("_place", F.row_number().over(level)).where("_place = 1").drop("_place")

    def write(self, batch: DataFrame, number: int) -> None:
        self._latest(batch, self.order).write.mode("overwrite").parquet(f"{self.path}/batch={number}")

    def read(self, spark: SparkSession) -> DataFrame:
        return self._latest(spark.read.parquet(self.path), [*self.order, "batch"]).drop("batch")

    def fold(self, spark: SparkSession, path: str) -> None:
        self.read(spark).write.parquet(path)

    def start(self, df: DataFrame, checkpoint: str, mode: str = "update", every: str | None = None) -> StreamingQuery:
        return start(df.writeStream.foreachBatch(self.write), checkpoint, mode, every)


@contextmanager
def bounded_state(spark: SparkSession, a_core: int = 2) -> Iterator[None]:
    """Streams that are started inside for the first time deal their state over ``a_core`` partitions a core, or over the session's
    shuffle partitions where those are fewer; a checkpoint keeps its number.  Each batch loads and commits every partition's state in files
    of its own, whether it has rows or not, so partitions that grow in number with the input cost more than the rows do."""
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(int(before), a_core * spark.sparkContext.defaultParallelism)))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def play(spark: SparkSession, arrivals: Sequence[DataFrame], folder: str, stream: Callable[[DataFrame], StreamingQuery]) -> None:
    """Let rows arrive in turn: each of ``arrivals`` is written to a folder and then read by the stream, which is started
    again for it, goes on from its checkpoint and stops when it has read all that is there."""
    for i, df in enumerate(arrivals):
        df.write.parquet(f"{folder}/arrival{i}")
        stream(spark.readStream.schema(df.schema).parquet(f"{folder}/arrival*")).awaitTermination()
