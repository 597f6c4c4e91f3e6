"""Kafka-shaped records: source, decoding, shaping and sinks, in batch and as a stream.

The connector is a package of its own; shaping and decoding are plain operators and work on any source of records.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from silverbrook.plans.pipeline import Operator


def decode(schema: StructType | str) -> Operator:
    """The key as text, the value's JSON fields as columns, and timestamp, partition and offset where the source has
    them."""

    def run(df: DataFrame) -> DataFrame:
        place = [c for c in ("timestamp", "partition", "offset") if c in df.columns]
        parsed = df.select(F.col("key").cast("string").alias("key"), F.from_json(F.col("value").cast("string"), schema).alias("_value"), *place)
        return parsed.select("key", "_value.*", *place)

    return run


def shape(key: str | None = None, columns: Sequence[str] | None = None) -> Operator:
    """Records for a topic: an existing ``value`` (and ``key``) as text, else the columns as JSON under the key column."""

    def run(df: DataFrame) -> DataFrame:
        if "value" in df.columns and columns is None:
            name = F.col("key").cast("string") if "key" in df.columns else F.lit(None).cast("string")
            return df.select(name.alias("key"), F.col("value").cast("string").alias("value"))
        name = F.col(key).cast("string") if key else F.lit(None).cast("string")
        return df.select(name.alias("key"), F.to_json(F.struct(*(columns or df.columns))).alias("value"))

    return run


@dataclass(frozen=True)
class Kafka:
    servers: str
    topic: str
    group: str | None = None
    starting_offsets: str | None = None
    max_per_trigger: int | None = None
    options: dict[str, str] = field(default_factory=dict)

    def _options(self, stream: bool) -> dict[str, str]:
        out = {"kafka.bootstrap.servers": self.servers, "subscribe": self.topic, "startingOffsets": self.starting_offsets or ("latest" if stream else "earliest")}
        if not stream and out["startingOffsets"] == "latest":
            raise ValueError("a batch can't start at the latest offsets")
        if self.group:
            out["kafka.group.id"] = self.group
        if stream and self.max_per_trigger:
            out["maxOffsetsPerTrigger"] = str(self.max_per_trigger)
        return out | self.options

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.format("kafka").options(**self._options(False)).load()

    def read_stream(self, spark: SparkSession) -> DataFrame:
        return spark.readStream.format("kafka").options(**self._options(True)).load()

    def write(self, df: DataFrame, key: str | None = None) -> None:
        df.transform(shape(key)).write.format("kafka").option("kafka.bootstrap.servers", self.servers).option("topic", self.topic).save()

    def write_stream(self, df: DataFrame, checkpoint: str, key: str | None = None, mode: str = "append", every: str | None = None) -> StreamingQuery:
        writer = df.transform(shape(key)).writeStream.format("kafka").option("kafka.bootstrap.servers", self.servers).option("topic", self.topic)
        return start(writer, checkpoint, mode, every)


def start(writer, checkpoint: str, mode: str = "append", every: str | None = None) -> StreamingQuery:
    """Start a stream: all that is there now, then stop; or every so often (``every``, as "1 minute")."""
    if mode not in ("append", "complete", "update"):
        raise ValueError(f"unknown output mode {mode!r}")
    if not checkpoint:
        raise ValueError("a stream needs a checkpoint folder")
    writer = writer.outputMode(mode).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()
