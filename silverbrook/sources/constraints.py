"""Writes under constraints: rows that break a rule are turned away or kept aside, in the pass that writes the others."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F


@dataclass(frozen=True)
class Constrained:
    """A Parquet folder whose rows keep the ``rules`` (name to SQL condition).  A condition that is unknown, because of a null, is broken
    unless ``unknown_passes``.

    :meth:`write` parts rows by one flag, so that good and bad ones are written in one scan: the good to ``valid=true``, the bad,
    with the names of the rules they break, to ``valid=false``.  :meth:`write_all` fails at the first bad row instead and leaves
    the folder as it was.
    """

    path: str
    rules: Mapping[str, str]
    unknown_passes: bool = False

    def _broken(self, rule: str) -> Column:
        return ~F.coalesce(F.expr(rule), F.lit(self.unknown_passes))

    def _judged(self, df: DataFrame) -> DataFrame:
        clash = {"broken", "valid"} & set(df.columns)
        if clash:
            raise ValueError(f"columns {sorted(clash)} are the sink's own")
        return df.withColumn("broken", F.array_compact(F.array(*[F.when(self._broken(r), F.lit(n)) for n, r in self.rules.items()])))

    def write(self, df: DataFrame, mode: str = "append") -> dict[str, int]:
        """Write; returns how many rows were written, were kept aside, and broke each rule, counted on the way."""
        seen = Observation()
        counts = [F.count_if(F.array_contains("broken", n)).alias(f"rule:{n}") for n in self.rules]
        judged = self._judged(df).observe(seen, F.count_if(F.size("broken") == 0).alias("good"), F.count_if(F.size("broken") > 0).alias("bad"), *counts)
        judged.withColumn("valid", F.size("broken") == 0).write.mode(mode).partitionBy("valid").parquet(self.path)
        return seen.get

    def write_all(self, df: DataFrame, mode: str = "append") -> int:
        seen = Observation()
        judged = self._judged(df)
        bad = F.raise_error(F.concat(F.lit("a row breaks "), F.array_join("broken", ", ")))
        checked = judged.withColumn("valid", F.when(F.size("broken") == 0, True).otherwise(bad.cast("boolean")))
        checked.observe(seen, F.count(F.lit(1)).alias("n")).write.mode(mode).partitionBy("valid").parquet(self.path)
        return seen.get["n"]

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(self.path).where("valid = 'true'").drop("valid", "broken")

    def quarantine(self, spark: SparkSession) -> DataFrame:
        """The rows kept aside, with the rules they break in ``broken``."""
        return spark.read.parquet(self.path).where("valid = 'false'").drop("valid")
