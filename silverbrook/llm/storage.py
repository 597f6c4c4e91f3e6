"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

_UNSET = ""


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; where that is unset and the master is local, a temporary one."""
    name = spark.conf.get("spark.checkpoint.dir", _UNSET) or spark.sparkContext.getConf().get("spark.checkpoint.dir", _UNSET)
    if name:
        return name
    known = spark.sparkContext.getCheckpointDir()
    if known:
        return known
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="silverbrook-"))
    return spark.sparkContext.getCheckpointDir()


_scopes = threading.local()


@contextmanager
def passing(spark: SparkSession) -> Iterator[None]:
    """Tables that :func:`cut` makes inside are deleted at the end, but for those made with ``stays``."""
    open_ = _scopes.__dict__.setdefault("open", [])
    open_.append([])
    try:
        yield
    finally:
        for path in open_.pop():
            delete(spark, path)


def delete(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def cut(df: DataFrame, name: str, stays: bool = False) -> DataFrame:
    """:func:`written` without the path."""
    return written(df, name, stays)[0]


def written(df: DataFrame, name: str, stays: bool = False) -> tuple[DataFrame, str]:
    """Write ``df`` as a Parquet table to the shared folder and read it back: lineage ends there, and a lost executor
    costs only the tasks that were running on it.  Within :func:`passing` the table is deleted at its end; with ``stays``
    it belongs to the next outer one, and without any it stays until the folder is cleared."""
    spark = df.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    open_ = _scopes.__dict__.setdefault("open", [])
    if len(open_) > stays:
        open_[-1 - stays].append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def partitions(spark: SparkSession, least: int = 1) -> int:
    return max(least, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))


#: Bytes up to which a table may be broadcast; the parts to which the rows of a hot key are dealt beyond that; a key is hot
#: with more than ``HOT_ROWS`` rows that are more than a ``HOT_PART``-th of all, so there are fewer hot keys than that.
BROADCAST_BYTES, SALTS, HOT_ROWS, HOT_PART = 16 << 20, 64, 1000, 10_000


def attach(df: DataFrame, table: DataFrame, key: str, size: Column, tie: Column) -> DataFrame:
    """``df`` with the columns of ``table``, which has one row a key; nulls where it has none.  ``size`` gives the bytes of
    a row of ``table``.  Their sum decides how, so the table is written first: a small one is broadcast.  For a large one
    the keys of ``df`` are counted: the rows of hot ones are dealt to ``SALTS`` parts by ``tie``, and only the rows of those
    keys in ``table`` are copied to each part.  Hot keys go by a hash, in 8 bytes each, so they may be broadcast."""
    table = cut(table, "attached")
    bytes_ = table.agg(F.sum(size + 32)).first()[0] or 0
    if bytes_ <= BROADCAST_BYTES:
        return df.join(F.broadcast(table), key, "left")
    hot = hot_keys(df, key)
    if not hot:
        return df.join(table, key, "left")
    known = F.broadcast(df.sparkSession.createDataFrame([(h, True) for h in hot], "_key long, _hot boolean"))
    marked = lambda rows: rows.withColumn("_key", F.xxhash64(key)).join(known, "_key", "left")
    first = F.lit(0).cast("long")
    spread = marked(table).withColumn("_salt", F.explode(F.sequence(first, F.when(F.col("_hot"), F.lit(SALTS - 1).cast("long")).otherwise(first))))
    dealt = marked(df).withColumn("_salt", F.when(F.col("_hot"), F.pmod(tie, F.lit(SALTS).cast("long"))).otherwise(first))
    return dealt.drop("_key", "_hot").join(spread.drop("_key", "_hot"), [key, "_salt"], "left").drop("_salt")


def hot_keys(df: DataFrame, key: str) -> list[int]:
    """The hashes of the hot keys of ``df``, fewer than ``HOT_PART`` whatever ``df`` is.  Runs a grouped count."""
    counts = cut(df.groupBy(F.xxhash64(key).alias("h")).agg(F.count(F.lit(1)).alias("n")), "counts")
    rows = counts.agg(F.sum("n")).first()[0] or 0
    return [r["h"] for r in counts.where(F.col("n") > max(HOT_ROWS, rows // HOT_PART)).select("h").collect()]


#: The most bytes and rows of a batch in which texts travel to Python.
BATCH_BYTES, BATCH_ROWS = 4 << 20, 4000


def let_workers_import(spark: SparkSession) -> None:
    """Let Python workers on this machine find the library where the driver found it (on a cluster ship it with
    ``--py-files`` or install it), and keep the batches they get small, as texts may be long."""
    for name, value in (("maxBytesPerBatch", BATCH_BYTES), ("maxRecordsPerBatch", BATCH_ROWS)):
        spark.conf.set(f"spark.sql.execution.arrow.{name}", str(value))
    root, have = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in have.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, have]))
