"""Merges, deletes, updates and changes of tables as plain joins, and plain Parquet folders to keep the results in.

Versions are folders that the caller names; what changed between two is a join.  Log, locks and retention are left to a table
format made for them.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from silverbrook.errors import SinkError
from silverbrook.sources.scratch import kept


@dataclass(frozen=True)
class When:
    """A clause of a merge: ``update``, ``delete`` or ``insert``, under an SQL condition on ``s.`` (source) and ``t.``
    (target) columns.  ``set`` gives SQL for columns; without it all of the source's columns are taken."""

    action: str
    condition: str | None = None
    set: Mapping[str, str] | None = None


UPSERT = (When("update"), When("insert"))
#: Bytes that a compacted file is meant to have.
FILE_BYTES = 128 << 20


def _repeats(target: DataFrame, source: DataFrame, keys: Sequence[str], condition: str | None) -> DataFrame:
    """Target rows, or keys of them, that several source rows match."""
    if condition:
        numbered = target.withColumn("_row", F.monotonically_increasing_id()).alias("t")
        return numbered.join(source.alias("s"), F.expr(condition)).groupBy("t._row").count().where("count > 1")
    twice = source.groupBy(*[F.col(f"`{k}`") for k in keys]).count().where("count > 1").drop("count")
    return target.join(twice, list(keys), "left_semi") if not twice.isEmpty() else twice


def merged(target: DataFrame, source: DataFrame, keys: Sequence[str] = (), clauses: Sequence[When] = UPSERT, condition: str | None = None) -> DataFrame:
    """``target`` after a merge by equal keys, or by an SQL condition on ``s.`` and ``t.`` columns: one full join.  Of the clauses the first
    whose condition holds applies; columns that only the source has are added.  A target row that several source rows match is an
    error, for which the source's keys are counted."""
    if not keys and not condition:
        raise SinkError("a merge needs keys or a condition")
    if not _repeats(target, source, keys, condition).isEmpty():
        raise SinkError("several source rows match one row", {"keys": list(keys)})
    kinds = dict(source.dtypes) | dict(target.dtypes)
    names = target.columns + [c for c in source.columns if c not in target.columns]
    row = lambda df, name: df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(name))
    t, s = row(target, "t"), row(source, "s")
    test = F.expr(condition) if condition else None
    for k in () if condition else keys:
        same = F.col(f"s.`{k}`") == F.col(f"t.`{k}`")
        test = same if test is None else test & same
    both, fresh = F.col("t").isNotNull() & F.col("s").isNotNull(), F.col("t").isNull()
    # the number of the clause that applies; none: an unmatched or untouched row
    applies = F.lit(None).cast("int")
    for i, c in reversed(list(enumerate(clauses))):
        when = fresh if c.action == "insert" else both
        applies = F.when(when & F.coalesce(F.expr(c.condition), F.lit(False)) if c.condition else when, i).otherwise(applies)
    rows = t.join(s, test, "full_outer").withColumn("_clause", applies)
    gone = [i for i, c in enumerate(clauses) if c.action == "delete"]
    stays = F.when(F.col("_clause").isNull(), F.col("t").isNotNull()).otherwise(~F.col("_clause").isin(gone) if gone else F.lit(True))

    def value(name: str) -> Column:
        null = F.lit(None).cast(kinds[name])
        old = F.col(f"t.`{name}`") if name in target.columns else null
        new = F.col(f"s.`{name}`").cast(kinds[name]) if name in source.columns else old
        out = old
        for i, c in enumerate(clauses):
            if c.action != "delete":
                given = new if c.set is None else F.expr(c.set[name]).cast(kinds[name]) if name in c.set else old if c.action == "update" else null
                out = F.when(F.col("_clause") == i, given).otherwise(out)
        return out.alias(name)

    return rows.where(stays).select(*[value(c) for c in names])


def deleted(df: DataFrame, condition: str) -> DataFrame:
    """Without the rows for which the condition is true."""
    return df.where(~F.coalesce(F.expr(condition), F.lit(False)))


def updated(df: DataFrame, values: Mapping[str, str], condition: str = "true") -> DataFrame:
    """With new values, as SQL, where the condition is true."""
    kinds, hit = dict(df.dtypes), F.coalesce(F.expr(condition), F.lit(False))
    return df.withColumns({c: F.when(hit, F.expr(v).cast(kinds[c])).otherwise(F.col(f"`{c}`")) for c, v in values.items()})


def changes(before: DataFrame, now: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """What has changed from one version to another: its rows with ``_change_type`` (insert, delete, update_preimage,
    update_postimage), by the keys.  Without keys a changed row is a delete and an insert, and repeated rows count.  Columns that only
    ``now`` has are null before."""
    names = now.columns
    before = before.select(*[F.col(f"`{c}`") if c in before.columns else F.lit(None).cast(k).alias(c) for c, k in now.dtypes])
    if not keys:
        gone, come = before.exceptAll(now), now.exceptAll(before)
        return gone.withColumn("_change_type", F.lit("delete")).unionByName(come.withColumn("_change_type", F.lit("insert")))
    whole = F.struct(*[F.col(f"`{c}`") for c in names])
    side = lambda df, out: df.select(F.struct(*[F.col(f"`{k}`") for k in keys]).alias("_key"), whole.alias(out))
    pairs = side(before, "_old").join(side(now, "_new").withColumnRenamed("_key", "_key2"), F.col("_key").eqNullSafe(F.col("_key2")), "full_outer")
    event = lambda kind, row: F.struct(F.lit(kind).alias("_change_type"), F.col(row).alias("row"))
    events = (
        F.when(F.col("_old").isNull(), F.array(event("insert", "_new")))
        .when(F.col("_new").isNull(), F.array(event("delete", "_old")))
        .when(~F.col("_old").eqNullSafe(F.col("_new")), F.array(event("update_preimage", "_old"), event("update_postimage", "_new")))
    )
    return pairs.select(F.explode(events).alias("_e")).select("_e.row.*", "_e._change_type")


def _folder(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _folder(spark, path)
    return fs.exists(p)


def replace(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Write ``df``, which may be made from what is in ``path``, in its place: first beside it, then over it.  With partitions
    only those that ``df`` has rows of are replaced."""
    writer = kept(df, "replacing").write.mode("overwrite")
    if partition_by:
        writer = writer.option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by)
    writer.parquet(path)


def merge_into(path: str, source: DataFrame, keys: Sequence[str], clauses: Sequence[When] = UPSERT) -> None:
    """Merge into a Parquet folder; without one its inserts make it."""
    spark = source.sparkSession
    if exists(spark, path):
        replace(merged(spark.read.parquet(path), source, keys, clauses), path)
    else:
        source.write.parquet(path)


def compact(spark: SparkSession, path: str, target: str, order: Sequence[str] = (), file_bytes: int = FILE_BYTES) -> int:
    """Write a Parquet folder once more to ``target`` in files of about ``file_bytes``, as many as its bytes need, ordered by columns so that
    their minima and maxima let scans skip (:func:`silverbrook.operators.clustering.clustered` does it for several at once).  Returns
    the number of files."""
    fs, p = _folder(spark, path)
    files = math.ceil(fs.getContentSummary(p).getLength() / file_bytes) or 1
    df = spark.read.parquet(path)
    (df.repartitionByRange(files, *order).sortWithinPartitions(*order) if order else df.repartition(files)).write.parquet(target)
    return files
