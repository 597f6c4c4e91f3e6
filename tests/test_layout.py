"""Constraints, clustered files, exact selection and running totals, against plain versions."""

from __future__ import annotations

import glob
import random

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from silverbrook.operators import running as R, selection
from silverbrook.operators.clustering import clustered
from silverbrook.sources.constraints import Constrained


def test_constraints_part_rows_in_one_scan(spark, tmp_path):
    rows = [(1, 5), (2, -1), (3, None), (None, 7), (None, -3)]
    spark.createDataFrame(rows, "k long, v long").write.parquet(str(tmp_path / "in"))
    df = spark.read.parquet(str(tmp_path / "in"))
    sink = Constrained(str(tmp_path / "out"), {"v": "v > 0", "k": "k is not null"})
    counts = sink.write(df)
    assert counts == {"good": 1, "bad": 4, "rule:v": 3, "rule:k": 2}
    assert [tuple(r) for r in sink.read(spark).collect()] == [(1, 5)]
    assert {(r.k, r.v, tuple(r.broken)) for r in sink.quarantine(spark).collect()} == {(2, -1, ("v",)), (3, None, ("v",)), (None, 7, ("k",)), (None, -3, ("v", "k"))}
    plan = sink._judged(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Exchange" not in plan
    lenient = Constrained(str(tmp_path / "lenient"), {"v": "v > 0"}, unknown_passes=True)
    assert lenient.write(df)["good"] == 3
    with pytest.raises(Exception, match="a row breaks v, k"):
        sink.write_all(df.where("k is null and v < 0"))
    assert sink.read(spark).count() == 1 and sink.write_all(df.where("k = 1")) == 1 and sink.read(spark).count() == 2
    with pytest.raises(ValueError, match="the sink's own"):
        sink.write(df.withColumn("valid", F.lit(1)))


def _files_to_read(path, box):
    """Files whose minima and maxima leave the box possible."""
    read = 0
    for f in glob.glob(f"{path}/*.parquet"):
        meta = pq.ParquetFile(f).metadata
        names = [meta.schema.column(i).name for i in range(meta.num_columns)]
        ok = True
        for c, (low, high) in box.items():
            parts = [meta.row_group(g).column(names.index(c)).statistics for g in range(meta.num_row_groups)]
            ok &= min(p.min for p in parts) <= high and max(p.max for p in parts) >= low
        read += ok
    return read


def test_clustered_files_are_skipped_by_two_columns(spark, tmp_path):
    rng = np.random.default_rng(1)
    x, y = np.exp(rng.standard_normal(40_000) * 2), rng.integers(0, 100_000, 40_000)
    df = spark.createDataFrame(list(zip(x.tolist(), y.tolist(), [f"s{v}" for v in y.tolist()], strict=True)), "x double, y long, s string")
    df.transform(clustered(["x", "y"], 64)).write.parquet(str(tmp_path / "curve"))
    df.repartitionByRange(64, "x", "y").sortWithinPartitions("x", "y").write.parquet(str(tmp_path / "sorted"))
    assert spark.read.parquet(str(tmp_path / "curve")).exceptAll(df).count() == 0 and spark.read.parquet(str(tmp_path / "curve")).count() == 40_000
    total = {"curve": 0, "sorted": 0}
    for _ in range(40):
        a, b = sorted(rng.choice(x, 2)), rng.integers(0, 90_000)
        low = np.searchsorted(np.sort(x), a[0])
        box = {"x": (float(np.sort(x)[low]), float(np.sort(x)[min(low + 4000, len(x) - 1)])), "y": (int(b), int(b) + 10_000)}
        alone = {"y": box["y"]}
        for name in total:
            total[name] += _files_to_read(tmp_path / name, box) + _files_to_read(tmp_path / name, alone)
    assert total["curve"] < total["sorted"] / 2
    odd = spark.createDataFrame([(None, "b", None), (1.0, None, None), (float("nan"), "a", None)], "x double, s string, n date")
    assert odd.transform(clustered(["x", "s", "n"], 2)).count() == 3
    with pytest.raises(ValueError, match="seven"):
        clustered([], 3)


def test_exact_quantiles(spark, monkeypatch):
    monkeypatch.setattr(selection, "BINS", 128)
    monkeypatch.setattr(selection, "FEW", 40)
    rng = random.Random(4)
    rows = [("a", rng.gauss(0, 1)) for _ in range(900)] + [("b", rng.choice([1.0, 1.0, 2.0])) for _ in range(999)] + [("c", 10.0 ** rng.randrange(-9, 9) * rng.choice([-1, 1])) for _ in range(200)]
    rows += [("d", 7.0), (None, 1.0), (None, 2.0), ("e", None), ("e", float("nan")), ("a", None), ("f", float("inf")), ("g", 1.7e308), ("g", -1.7e308)]
    df = spark.createDataFrame(rows, "k string, v double").repartition(4)
    asked = {"lo": 0.0, "q": 0.37, "mid": 0.5, "hi": 1.0}
    got = {r.k: tuple(r)[1:] for r in df.transform(selection.exact_quantiles(["k"], "v", asked)).collect()}
    for k in {r[0] for r in rows}:
        v = np.sort([x for g, x in rows if g == k and x is not None and np.isfinite(x)])
        if not len(v):
            assert got[k] == (None,) * 4
        elif k != "g":
            at = [p * (len(v) - 1) for p in asked.values()]
            low, high = v[np.floor(at).astype(int)], v[np.ceil(at).astype(int)]
            assert np.allclose(got[k], low + (high - low) * (np.array(at) - np.floor(at)), rtol=1e-12)
    whole = df.where("k = 'b'").transform(selection.exact_quantiles([], "v", {"m": 0.5})).collect()
    assert [r.m for r in whole] == [1.0]
    assert df.where("k = 'zz'").transform(selection.exact_quantiles(["k"], "v", asked)).count() == 0


def test_running_totals_of_one_hot_key(spark, monkeypatch):
    rng = random.Random(5)
    rows = [(rng.choice(["x", "x", "x", None]), rng.choice([0.5] * 8 + [rng.random(), None]), i if i % 9 else None, rng.choice([i, None])) for i in range(4000)]
    df = spark.createDataFrame([(*r, j) for j, r in enumerate(rows)], "k string, a double, b long, v long, id long").repartition(5)
    out = df.transform(R.running(["k"], ["a", "b", "id"], "v"))
    got = {r.id: (r.row_number, r.running_total) for r in out.collect()}
    down = lambda x: (x is not None, x or 0)
    for k in ("x", None):
        total = 0
        for n, (j, r) in enumerate(sorted(((j, r) for j, r in enumerate(rows) if r[0] == k), key=lambda x: (down(x[1][1]), down(x[1][2]), x[0])), 1):
            total += r[3] or 0
            assert got[j] == (n, total)
    assert len(got) == 4000
    from pyspark.sql import Window

    largest = df.transform(R.running([], ["a", "b", "id"], "v")).groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert largest < 4000
    one = df.select("id").transform(R.running([], ["id"])).withColumn("plain", F.row_number().over(Window.orderBy("id")))
    assert one.where("row_number <> plain").count() == 0 and df.limit(0).transform(R.running([], ["a"], "v")).count() == 0
