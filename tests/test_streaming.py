"""Streams: replay after a stop, late rows, keyed state with timers, metrics.  Results of whole streams are compared in test_queries."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from silverbrook.plans.jobs import Metrics
from silverbrook.sales.streaming import DailySalesStream
from silverbrook.streaming import events as E
from silverbrook.streaming.funnel import funnel
from silverbrook.streaming.kafka import start
from silverbrook.streaming.metrics import StreamMetrics
from silverbrook.streaming.sinks import UpsertFolder, play


def test_a_replayed_batch_counts_once(spark, tmp_path):
    """The stream stops after a batch is written and before its commit; started again it plays that batch once more."""
    table = UpsertFolder(str(tmp_path / "table"), ("k",), ("at",))
    rows = [spark.createDataFrame(x, "k long, at long, v string") for x in ([(1, 1, "a"), (2, 1, "b"), (2, 0, "old")], [(2, 2, "c"), (3, 1, "d")], [(1, 0, "late"), (4, 1, "e"), (None, 1, "n")])]
    stops = {1}

    def write(batch, number):
        table.write(batch, number)
        if number in stops:
            stops.discard(number)
            raise RuntimeError("lost before the commit")

    def stream(df):
        return start(df.writeStream.foreachBatch(write), str(tmp_path / "state"))

    with pytest.raises(Exception, match="lost before the commit"):
        play(spark, rows[:2], str(tmp_path / "in"), stream)
    schema = rows[0].schema
    stream(spark.readStream.schema(schema).parquet(str(tmp_path / "in" / "arrival*"))).awaitTermination()
    rows[2].write.parquet(str(tmp_path / "in" / "arrival2"))
    stream(spark.readStream.schema(schema).parquet(str(tmp_path / "in" / "arrival*"))).awaitTermination()
    found = {tuple(r) for r in table.read(spark).collect()}
    assert found == {(1, 1, "a"), (2, 2, "c"), (3, 1, "d"), (4, 1, "e"), (None, 1, "n")}
    table.fold(spark, str(tmp_path / "plain"))
    assert {tuple(r) for r in spark.read.parquet(str(tmp_path / "plain")).collect()} == found


def _lines(spark, rows):
    names = "order_id long, order_date date, customer_id long, total_amount decimal(12,2), discount_amount decimal(12,2), tax_amount decimal(12,2), quantity int, is_high_value_order string, order_status string, margin_percent decimal(9,2), is_vip_customer string"
    return spark.createDataFrame(rows, names)


def test_daily_sales_are_updated(spark, tmp_path):
    from datetime import date
    from decimal import Decimal

    from silverbrook.sales.gold import daily_sales

    rng = random.Random(1)
    money = lambda n: Decimal(rng.randrange(n)) / 100
    rows = [(i, date(2024, 1, rng.randrange(1, 5)), rng.choice([1, 2, 3, None]), money(9999), money(99), money(99), rng.randrange(9), rng.choice("YN"), rng.choice(["cancelled", "pending", None]), rng.choice([money(5000), None]), rng.choice("YN")) for i in range(60)]
    whole = _lines(spark, rows)
    days, seen = DailySalesStream(str(tmp_path / "days")), []
    for part in (0, 1, 2):
        (spark.createDataFrame(rows[20 * part : 20 * part + 20], whole.schema)).write.parquet(str(tmp_path / "in" / f"arrival{part}"))
        days.start(spark.readStream.schema(whole.schema).parquet(str(tmp_path / "in" / "arrival*")), str(tmp_path / "state")).awaitTermination()
        expected = {tuple(r) for r in whole.where(f"order_id < {20 * part + 20}").transform(daily_sales(stamp=False)).collect()}
        assert {tuple(r) for r in days.read(spark).select(*whole.transform(daily_sales(stamp=False)).columns).collect()} == expected
        seen.append(len(expected))
    assert seen[-1] == 4


def test_operators_on_batches(spark):
    rows = spark.createDataFrame([("2024-01-01 00:00:00", 1, "a"), ("2024-01-01 00:30:00", 1, "b"), ("2024-01-01 01:00:00", 1, "b"), (None, 1, "b"), ("2024-01-01 05:00:00", 2, None)], "ts string, k long, kind string")
    n = {"n": F.count(F.lit(1))}
    assert sorted(r.n for r in rows.transform(E.sessions("ts", "1 day", "29 minutes", ["k"], n)).collect()) == [1, 1, 1, 1]
    assert sorted(r.n for r in rows.transform(E.sessions("ts", "1 day", "30 minutes", ["k"], n)).collect()) == [1, 3]
    assert sorted(r.n for r in rows.transform(E.windowed("ts", "1 day", "1 hour", n)).collect()) == [1, 1, 2]
    assert sum(r.n for r in rows.transform(E.windowed("ts", "1 day", "1 hour", n, ["k"], "30 minutes")).collect()) == 8
    assert rows.transform(E.without_repeats("ts", "1 day", ["k", "kind"])).count() == 3
    other = rows.select("k", F.col("ts").alias("then"), F.col("kind").alias("what"))
    assert rows.transform(E.followed_by(other, ["k"], "ts", "then", "30 minutes", "1 day")).count() == 6
    outer = rows.where("kind = 'a' or kind is null").transform(E.followed_by(other.where("what = 'b'"), ["k"], "ts", "then", "10 minutes", "1 day", "left_outer"))
    assert outer.columns == ["ts", "k", "kind", "then", "what"] and outer.where("what is null").count() == 2
    with pytest.raises(ValueError, match="kind of join"):
        E.followed_by(other, ["k"], "ts", "then", "1 hour", "1 day", "cross")


def _attempts(events, steps, limit):
    out, began, reached, ended = [], None, 0, 0
    for at, step in sorted(events):
        if began is not None and at > began + limit:
            out.append((began, reached, ended))
            began, reached = None, 0
        if step == steps[reached]:
            began, reached, ended = at if began is None else began, reached + 1, at
            if reached == len(steps):
                out.append((began, reached, ended))
                began, reached = None, 0
    return out + ([(began, reached, ended)] if began is not None else [])


def test_funnel_times_out(spark, tmp_path):
    """Against plain loops; the last arrival's open attempts come out by their timers alone."""
    rng, steps = random.Random(3), ("view", "click", "purchase")
    rows = sorted((rng.randrange(1, 10_000) * 1000, rng.randrange(12), rng.choice([*steps, "view", "other"])) for _ in range(900))
    cut = [[r for r in rows if a <= r[0] < a + 2_500_000] for a in range(0, 10_000_000, 2_500_000)] + [[(10**9, 99, "view")], [(2 * 10**9, 99, "other")]]
    frames = [spark.createDataFrame(x, "at long, user long, step string").select(F.timestamp_millis("at").alias("ts"), "user", "step") for x in cut]
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    spark.conf.set(name, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        operator = funnel("user", "ts", "step", steps, 10, "0 seconds")

        def stream(df):
            return start(df.transform(operator).writeStream.format("parquet").option("path", str(tmp_path / "out")), str(tmp_path / "state"))

        play(spark, frames, str(tmp_path / "in"), stream)
    finally:
        spark.conf.set(name, before)
    got = sorted((int(r.key), r.b, r.reached, r.e) for r in spark.read.parquet(str(tmp_path / "out")).select("key", "reached", F.unix_millis("began").alias("b"), F.unix_millis("ended").alias("e")).collect())
    expected = sorted((u, *x) for u in range(12) for x in _attempts([(at, s) for at, v, s in rows if v == u], steps, 600_000))
    assert [g for g in got if g[0] != 99] == expected and len({r[2] for r in expected}) == 3


def test_metrics_of_a_failed_stream(spark, tmp_path):
    metrics = Metrics()
    seen = StreamMetrics(metrics)
    spark.range(5).write.parquet(str(tmp_path / "in"))
    spark.streams.addListener(seen)
    try:
        df = spark.readStream.schema("id long").parquet(str(tmp_path / "in"))
        good = start(df.writeStream.queryName("good").format("noop"), str(tmp_path / "a"))
        good.awaitTermination()
        bad = start(df.select(F.raise_error(F.lit("broken")).alias("x")).writeStream.queryName("bad").format("noop"), str(tmp_path / "b"))
        with pytest.raises(Exception, match="broken"):
            bad.awaitTermination()
        assert seen.wait(good.runId) and seen.wait(bad.runId)
    finally:
        spark.streams.removeListener(seen)
    assert metrics.totals() == {("good", "success"): 1, ("bad", "failed"): 1}
    assert metrics.runs[0].rows == {"input": 5} and "broken" in metrics.runs[1].error and not metrics.active
    assert [(b.stream, b.rows) for b in seen.batches] == [("good", 5)]


def test_funnel_asks_for_state_once_a_batch():
    import pandas as pd

    from silverbrook.streaming.funnel import _Funnel

    class State:
        held, calls = None, 0

        def get(self):
            self.calls += 1
            return self.held

        def update(self, value):
            self.calls, self.held = self.calls + 1, value

    class Handle:
        def __init__(self):
            self.state, self.timers = State(), []

        def getValueState(self, name, schema):
            return self.state

        def registerTimer(self, at):
            self.timers.append(at)

    handle, steps = Handle(), _Funnel(["a", "b"], 10)
    steps.init(handle)
    events = pd.DataFrame({"at": list(range(1000)), "step": ["a", "b"] * 499 + ["x", "a"]})
    out = pd.concat(list(steps.handleInputRows(("k",), iter([events[500:], events[:500]]), None)))
    assert len(out) == 499 and out.iloc[0].tolist() == ["k", 0, 2, 1]
    assert handle.state.held == (999, 1, 999) and handle.timers == [1010] and handle.state.calls == 2


def test_state_partitions_follow_cores(spark, data, tmp_path, monkeypatch):
    from silverbrook.catalog import streams

    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    monkeypatch.setattr(streams, "scratch", lambda spark, name: str(tmp_path / name))
    spark.conf.set(name, "40")
    try:
        assert streams.ENTRIES["stream_outer_join"][0](streams.Tables(spark, data)).count() > 0
        assert spark.conf.get(name) == "40"
    finally:
        spark.conf.set(name, before)
    assert len([p for p in (tmp_path / "stream" / "state" / "state" / "0").iterdir() if p.name.isdigit()]) == 2 * spark.sparkContext.defaultParallelism


def test_daily_sales_keep_no_state(spark, tmp_path):
    """Sums of batches add up, a batch that is played again counts once, and nothing but lines is kept; with ``late`` closed days stay as they are."""
    from datetime import date
    from decimal import Decimal

    line = lambda i, day, customer: (i, date(2024, 1, day) if day else None, customer, Decimal(10), Decimal(1), Decimal(2), 1, "N", "pending", None, "N")
    frames = [_lines(spark, x) for x in ([line(1, 1, 7), line(2, None, 7)], [line(3, 1, 7), line(4, 1, None), line(5, 20, 8), line(6, None, 9)], [line(7, 1, 8), line(8, 20, 8)])]

    def found(late):
        at = tmp_path / str(late)
        days = DailySalesStream(str(at / "days"), late)
        play(spark, frames, str(at / "in"), lambda df: days.start(df, str(at / "state")))
        if not late:
            days._add(frames[1], 1)
        return at, {(r.report_date, r.total_orders, r.total_revenue, r.unique_customers) for r in days.read(spark).collect()}

    at, rows = found(None)
    assert rows == {(date(2024, 1, 1), 4, 40, 2), (date(2024, 1, 20), 2, 20, 1), (None, 2, 20, 2)}
    assert not (at / "state" / "state").exists()
    at, rows = found("2 days")
    assert {r for r in rows if r[0]} == {(date(2024, 1, 1), 3, 30, 1), (date(2024, 1, 20), 2, 20, 1)}
    assert (at / "state" / "state").exists()
