"""Registered queries of streams: rows arrive in turn, the stream is started again for each arrival, and its result is compared.

Arrivals are quarters of the month of ``events``; some rows come later than their time.  A last row far in the future closes what is open.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, functions as F

from silverbrook.catalog.sales import ENTRIES as SALES, enriched
from silverbrook.catalog.tables import Entry, Tables, plain
from silverbrook.plans.jobs import Metrics
from silverbrook.sales.streaming import DailySalesStream
from silverbrook.sources.scratch import scratch
from silverbrook.streaming import events as E
from silverbrook.streaming.funnel import funnel
from silverbrook.streaming.kafka import start
from silverbrook.streaming.metrics import StreamMetrics
from silverbrook.streaming.sinks import UpsertFolder, bounded_state, play

QUARTERS = 4
FUNNEL = ("view", "click", "purchase")


def _events(t: Tables) -> DataFrame:
    return t.events.select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type", F.round(F.col("value") * 100).cast("long").alias("cents"))


def _quarter(ts: str = "ts") -> Column:
    return F.least(F.lit(QUARTERS - 1), F.floor((F.day(ts) - 1) / 8)).cast("int")


def _delayed(quarters: str) -> Column:
    return F.least(F.lit(QUARTERS - 1), _quarter() + F.expr(quarters)).cast("int")


def _arrivals(df: DataFrame, number: Column) -> list[DataFrame]:
    close = {"ts": F.lit("2100-01-01").cast("timestamp"), "event_type": F.lit("close"), "user_id": F.lit(-1).cast("long")}
    closing = df.limit(1).select(*[close.get(c, F.lit(None).cast(k)).alias(c) for c, k in df.dtypes])
    return [df.where(number == i) for i in range(QUARTERS)] + [closing]


def _run(t: Tables, arrivals: list[DataFrame], operator, mode: str = "append") -> DataFrame:
    """The rows that the operator's stream has written once all have arrived."""
    folder, kept = scratch(t.spark, "stream"), {}

    def stream(df: DataFrame):
        out = df.transform(operator)
        kept["schema"] = out.schema
        with bounded_state(t.spark):
            return start(out.writeStream.format("parquet").option("path", f"{folder}/out"), f"{folder}/state", mode)

    play(t.spark, arrivals, f"{folder}/in", stream)
    return t.spark.read.schema(kept["schema"]).parquet(f"{folder}/out")


_LATE = "case when event_id % 20 = 7 then 1 when event_id % 40 = 18 then 2 else 0 end"


def _windows(slide: str | None, width: str):
    def query(t: Tables) -> DataFrame:
        df, sums = _events(t), {"n": F.count(F.lit(1)), "cents": F.sum("cents")}
        out = _run(t, _arrivals(df, _delayed(_LATE)), E.windowed("ts", "3 days", width, sums, ["event_type"], slide))
        return out.select(*[F.unix_seconds(c).alias(c) for c in ("window_start", "window_end")], "event_type", "n", "cents")

    return query


def _without_repeats(t: Tables) -> DataFrame:
    df = _events(t).select("event_id", "ts", "event_type")
    first = df.withColumn("arrival", _quarter())
    soon = first.where("event_id % 10 = 3").withColumn("arrival", F.least(F.lit(QUARTERS - 1), F.col("arrival") + 1))
    after = first.where("event_id % 10 = 4 and arrival = 0").withColumns({"arrival": F.lit(QUARTERS - 1), "ts": F.col("ts") + F.expr("interval 20 days")})
    rows = first.unionByName(soon).unionByName(after)
    parts = [a.drop("arrival") for a in _arrivals(rows, F.col("arrival"))]
    return _run(t, parts, E.without_repeats("ts", "5 days", ["event_id"])).where("event_id is not null").select("event_id", F.unix_micros("ts").alias("at"))


def _sessions(t: Tables) -> DataFrame:
    sums = {"n": F.count(F.lit(1)), "cents": F.sum("cents")}
    out = _run(t, _arrivals(_events(t), _delayed(_LATE)), E.sessions("ts", "20 days", "6 hours", ["user_id"], sums))
    return out.select("user_id", *[F.unix_micros(c).alias(c) for c in ("session_start", "session_end")], "n", "cents")


def _followed(how: str):
    def query(t: Tables) -> DataFrame:
        def operator(df: DataFrame) -> DataFrame:
            bought = df.where("event_type in ('purchase', 'close')").select("user_id", F.col("ts").alias("bought"), F.col("event_id").alias("purchase_id"))
            seen = df.where("event_type in ('view', 'close')").select("user_id", "ts", "event_id")
            return seen.transform(E.followed_by(bought, ["user_id"], "ts", "bought", "1 hour", "10 days", how)).select("event_id", "purchase_id", "user_id")

        return _run(t, _arrivals(_events(t), _delayed("if(event_id % 20 = 7, 1, 0)")), operator).where("event_id is not null")

    return query


def _upsert(t: Tables) -> DataFrame:
    """The latest event of each user, of which a third arrive late, kept by batches."""
    folder = scratch(t.spark, "upsert")
    table = UpsertFolder(f"{folder}/table", ("user_id",), ("ts", "event_id"))
    play(t.spark, _arrivals(_events(t), _delayed("if(event_id % 3 = 0, 2, 0)"))[:-1], f"{folder}/in", lambda df: table.start(df, f"{folder}/state", "append"))
    return table.read(t.spark).select("user_id", "event_id", "event_type", "cents")


def _daily(t: Tables) -> DataFrame:
    folder = scratch(t.spark, "gold")
    lines = enriched(t).select("order_date", "customer_id", "order_id", "total_amount", "discount_amount", "tax_amount", "quantity", "is_high_value_order", "order_status", "margin_percent", "is_vip_customer")
    days = DailySalesStream(f"{folder}/days")
    play(t.spark, [lines.where(F.pmod("order_id", F.lit(3)) == i) for i in range(3)], f"{folder}/in", lambda df: days.start(df, f"{folder}/state"))
    return plain(days.read(t.spark))


def _metrics(t: Tables) -> DataFrame:
    """What the listener has seen: rows and watermark of each batch that read any."""
    name, folder, seen, last = f"events-{uuid.uuid4().hex}", scratch(t.spark, "metrics"), StreamMetrics(Metrics()), []

    def stream(df: DataFrame):
        counts = df.transform(E.windowed("ts", "3 days", "1 day", {"n": F.count(F.lit(1))}))
        with bounded_state(t.spark):
            last.append(start(counts.writeStream.queryName(name).format("noop"), f"{folder}/state"))
        return last[-1]

    t.spark.streams.addListener(seen)
    try:
        play(t.spark, _arrivals(_events(t), _delayed(_LATE))[:-1], f"{folder}/in", stream)
        for query in last:
            seen.wait(query.runId)
    finally:
        t.spark.streams.removeListener(seen)
    batches = [b for b in seen.batches if b.stream == name and b.rows]
    rows = [(i, b.rows, b.watermark) for i, b in enumerate(batches)]
    return t.spark.createDataFrame(rows, "arrival int, rows_in long, watermark string").select("arrival", "rows_in", F.unix_millis(F.to_timestamp("watermark")).alias("watermark_ms"))


def _funnel(t: Tables) -> DataFrame:
    name, value = "spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    before = t.spark.conf.get(name)
    t.spark.conf.set(name, value)
    try:
        out = _run(t, _arrivals(_events(t), _quarter()), funnel("user_id", "ts", "event_type", FUNNEL, 24 * 60, "0 seconds"))
    finally:
        t.spark.conf.set(name, before)
    return out.where("key >= 0").select("key", F.unix_millis("began").alias("began"), "reached", F.unix_millis("ended").alias("ended"))


_SQL = """
WITH e AS (SELECT event_id, ts, user_id, event_type, CAST(round(value * 100) AS BIGINT) AS cents, least(3, (day(ts) - 1) // 8) AS quarter FROM events),
a AS (SELECT *, least(3, quarter + CASE WHEN event_id % 20 = 7 THEN 1 WHEN event_id % 40 = 18 THEN 2 ELSE 0 END) AS arrival FROM e),
marks AS (SELECT arrival, (SELECT max(date_trunc('millisecond', ts)) FROM a WHERE a.arrival < b.arrival) - INTERVAL 3 DAY AS mark FROM (SELECT DISTINCT arrival FROM a) b)
"""

#: Events of each user in turn; a row holds the attempt that is open after one, and those that it has ended.
_FUNNEL_SQL = """
WITH RECURSIVE e AS (SELECT CAST(user_id AS VARCHAR) AS key, epoch_us(ts) // 1000 AS ms, event_type AS step, row_number() OVER (PARTITION BY user_id ORDER BY epoch_us(ts) // 1000, event_type) AS k FROM events WHERE user_id IS NOT NULL),
f AS (
  SELECT DISTINCT key, CAST(0 AS BIGINT) AS k, CAST(NULL AS BIGINT) AS began, 0 AS reached, CAST(NULL AS BIGINT) AS ended,
    CAST(NULL AS BIGINT) AS late_began, 0 AS late_reached, CAST(NULL AS BIGINT) AS late_ended, CAST(NULL AS BIGINT) AS whole_began, CAST(NULL AS BIGINT) AS whole_ended FROM e
  UNION ALL
  SELECT key, k, CASE WHEN now = 3 THEN NULL ELSE b END, CASE WHEN now = 3 THEN 0 ELSE now END, latest, late_began, late_reached, late_ended, CASE WHEN now = 3 THEN b END, CASE WHEN now = 3 THEN latest END
  FROM (
    SELECT *, CASE WHEN hit THEN coalesce(b0, ms) ELSE b0 END AS b, r0 + CAST(hit AS INTEGER) AS now, CASE WHEN hit THEN ms ELSE ended END AS latest
    FROM (
      SELECT *, step = ['view', 'click', 'purchase'][r0 + 1] AS hit
      FROM (
        SELECT e.key, e.k, e.ms, e.step, f.ended, CASE WHEN past THEN NULL ELSE f.began END AS b0, CASE WHEN past THEN 0 ELSE f.reached END AS r0,
          CASE WHEN past THEN f.began END AS late_began, CASE WHEN past THEN f.reached ELSE 0 END AS late_reached, CASE WHEN past THEN f.ended END AS late_ended
        FROM (SELECT f.*, e.ms > f.began + 86400000 AS past FROM f JOIN e ON e.key = f.key AND e.k = f.k + 1) f JOIN e ON e.key = f.key AND e.k = f.k + 1)))),
last AS (SELECT * FROM f QUALIFY row_number() OVER (PARTITION BY key ORDER BY k DESC) = 1)
SELECT key, late_began AS began, late_reached AS reached, late_ended AS ended FROM f WHERE late_began IS NOT NULL
UNION ALL SELECT key, whole_began, 3, whole_ended FROM f WHERE whole_began IS NOT NULL
UNION ALL SELECT key, began, reached, ended FROM last WHERE began IS NOT NULL
"""

ENTRIES: dict[str, Entry] = {
    "stream_windows": (
        _windows(None, "1 day"),
        _SQL + """SELECT CAST(epoch(date_trunc('day', ts)) AS BIGINT) AS window_start, CAST(epoch(date_trunc('day', ts)) AS BIGINT) + 86400 AS window_end, event_type, count(*) AS n, CAST(sum(cents) AS BIGINT) AS cents
        FROM a JOIN marks USING (arrival) WHERE mark IS NULL OR date_trunc('day', ts) + INTERVAL 1 DAY > mark GROUP BY 1, 2, 3""",
    ),
    "stream_sliding_windows": (
        _windows("1 day", "2 days"),
        _SQL + """, w AS (SELECT *, date_trunc('day', ts) - INTERVAL 1 DAY * k AS s FROM a, (VALUES (0), (1)) AS v(k))
        SELECT CAST(epoch(s) AS BIGINT) AS window_start, CAST(epoch(s) AS BIGINT) + 172800 AS window_end, event_type, count(*) AS n, CAST(sum(cents) AS BIGINT) AS cents
        FROM w JOIN marks USING (arrival) WHERE mark IS NULL OR s + INTERVAL 2 DAY > mark GROUP BY 1, 2, 3""",
    ),
    "stream_without_repeats": (
        _without_repeats,
        _SQL + "SELECT event_id, epoch_us(ts) AS at FROM e UNION ALL SELECT event_id, epoch_us(ts + INTERVAL 20 DAY) FROM e WHERE event_id % 10 = 4 AND quarter = 0",
    ),
    "stream_sessions": (
        _sessions,
        _SQL + """, f AS (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) <= INTERVAL 6 HOUR THEN 0 ELSE 1 END AS fresh FROM e),
        g AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS island FROM f)
        SELECT user_id, epoch_us(min(ts)) AS session_start, epoch_us(max(ts) + INTERVAL 6 HOUR) AS session_end, count(*) AS n, CAST(sum(cents) AS BIGINT) AS cents FROM g GROUP BY user_id, island""",
    ),
    "stream_join": (
        _followed("inner"),
        _SQL + "SELECT v.event_id, p.event_id AS purchase_id, v.user_id FROM e v JOIN e p ON v.user_id = p.user_id AND p.ts BETWEEN v.ts AND v.ts + INTERVAL 1 HOUR WHERE v.event_type = 'view' AND p.event_type = 'purchase'",
    ),
    "stream_outer_join": (
        _followed("left_outer"),
        _SQL + ", p AS (SELECT * FROM e WHERE event_type = 'purchase') SELECT v.event_id, p.event_id AS purchase_id, v.user_id FROM e v LEFT JOIN p ON v.user_id = p.user_id AND p.ts BETWEEN v.ts AND v.ts + INTERVAL 1 HOUR WHERE v.event_type = 'view'",
    ),
    "stream_upsert": (_upsert, _SQL + "SELECT user_id, event_id, event_type, cents FROM e QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1"),
    "stream_daily_sales": (_daily, SALES["G1_daily_sales"][1]),
    "stream_metrics": (_metrics, _SQL + "SELECT CAST(arrival AS INTEGER) AS arrival, count(*) AS rows_in, coalesce(epoch_ms(any_value(mark)), 0) AS watermark_ms FROM a JOIN marks USING (arrival) GROUP BY arrival"),
    "stream_funnel": (_funnel, _FUNNEL_SQL),
}
