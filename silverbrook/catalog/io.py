"""Registered queries of sources, sinks, merges and versions of tables, JDBC and streams: write, read back, compare."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, functions as F

from silverbrook.catalog.tables import Entry, Tables
from silverbrook.operators.clustering import clustered
from silverbrook.sources import files as S
from silverbrook.sources.constraints import Constrained
from silverbrook.sources.jdbc import Jdbc, upsert_sql
from silverbrook.sources.scratch import scratch
from silverbrook.sources.tables import When, changes, compact, deleted, merge_into, merged, replace
from silverbrook.streaming.kafka import decode, shape, start

_CUSTOMER = "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
_EVENT = "event_id long, user_id long, event_type string, value double, props string"


def _csv(t: Tables) -> DataFrame:
    path = S.write_csv(t.customer, scratch(t.spark, "csv"))
    return S.Csv(path, _CUSTOMER).read(t.spark)


def _csv_partitioned(t: Tables) -> DataFrame:
    path = S.CsvSink(scratch(t.spark, "csvp"), partition_by=("c_mktsegment",), compression="gzip", files=2).write(t.customer)
    return S.Csv(path).with_options(infer_schema=True).read(t.spark).select(F.col("c_custkey").cast("long").alias("c_custkey"), "c_mktsegment")


def _json(t: Tables) -> DataFrame:
    path = S.write_json_lines(t.customer, scratch(t.spark, "json"))
    return S.read_json_lines(t.spark, path, _CUSTOMER)


def _parquet(t: Tables) -> DataFrame:
    path = S.ParquetSink(scratch(t.spark, "parquet"), max_records_per_file=500).write(t.part)
    return S.Parquet(path, merge_schema=True).read(t.spark)


def _nested(t: Tables) -> DataFrame:
    orders = t.orders.select("o_orderkey", "o_orderstatus", "o_custkey").join(t.customer.select("c_custkey", "c_name"), F.col("o_custkey") == F.col("c_custkey"))
    path = S.NestedJsonSink(scratch(t.spark, "nested"), root_columns=("o_orderkey",), structs={"state": ["o_orderstatus"], "who": ["c_custkey", "c_name"]}).write(orders)
    return S.flatten(S.Json(path).read(t.spark))


def _arrays(t: Tables) -> DataFrame:
    path = S.ArrayJsonSink(scratch(t.spark, "array"), group_by=("o_custkey",), array_column="orders", array_fields=("o_orderkey", "o_orderstatus")).write(t.orders)
    return S.Json(path).read(t.spark).select("o_custkey", F.size("orders").cast("long").alias("n"), F.array_max(F.transform("orders", lambda x: x["o_orderkey"])).alias("last"))


def _by_date(t: Tables) -> DataFrame:
    path = S.ParquetSink(scratch(t.spark, "dates")).write_by_date(t.orders.select("o_orderkey", "o_orderdate"), "o_orderdate", "month")
    return t.spark.read.parquet(path).groupBy(F.col("year").cast("long").alias("year"), F.col("month").cast("long").alias("month")).agg(F.count(F.lit(1)).alias("n"))


def _database(t: Tables) -> Jdbc:
    return Jdbc(f"jdbc:derby:memory:d{uuid.uuid4().hex};create=true", "org.apache.derby.iapi.jdbc.AutoloadedDriver")


def _jdbc(t: Tables) -> DataFrame:
    # this database lives in the driver's memory: on a cluster its rows go through the driver
    db = _database(t)
    db.write(t.nation, "nation", "overwrite")
    split = Jdbc(db.url, db.driver, partition_column="N_NATIONKEY", lower_bound=0, upper_bound=25, num_partitions=3)
    df = split.read(t.spark, "nation")
    return df.toDF("n_nationkey", "n_name", "n_regionkey")


def _jdbc_query(t: Tables) -> DataFrame:
    db = _database(t)
    db.write(t.region, "region", "overwrite")
    return db.query(t.spark, 'SELECT "r_name" AS NAME FROM region WHERE "r_regionkey" > 2').toDF("r_name")


def _halves(t: Tables) -> tuple[DataFrame, DataFrame]:
    orders = t.orders.select("o_orderkey", "o_orderstatus", F.col("o_totalprice").alias("price"))
    return orders.where("o_orderkey % 2 = 0"), orders.where("o_orderkey % 2 = 1")


def _travel(t: Tables) -> DataFrame:
    """A folder before and after an append, each version under a name of its own."""
    folder, (even, odd) = scratch(t.spark, "versions"), _halves(t)
    even.write.parquet(f"{folder}/0")
    t.spark.read.parquet(f"{folder}/0").unionByName(odd).write.parquet(f"{folder}/1")
    version = lambda n: t.spark.read.parquet(f"{folder}/{n}").select(F.lit(n).alias("v"), "o_orderkey")
    return version(0).unionByName(version(1))


def _changed(t: Tables) -> str:
    """Three versions: even orders, a merge of others and of new prices, and a delete."""
    folder, (even, odd) = scratch(t.spark, "versions"), _halves(t)
    even.write.parquet(f"{folder}/0")
    news = odd.where("o_orderkey % 10 = 1").unionByName(even.where("o_orderkey % 10 = 0").withColumn("price", F.lit(1.0)))
    merged(t.spark.read.parquet(f"{folder}/0"), news, ["o_orderkey"]).write.parquet(f"{folder}/1")
    deleted(t.spark.read.parquet(f"{folder}/1"), "o_orderkey % 10 = 2").write.parquet(f"{folder}/2")
    return folder


def _change_feed(t: Tables) -> DataFrame:
    folder = _changed(t)
    a, b, c = (t.spark.read.parquet(f"{folder}/{n}") for n in range(3))
    feed = [changes(x, y, ["o_orderkey"]).select("o_orderkey", "price", "_change_type", F.lit(n).cast("long").alias("_commit_version")) for n, (x, y) in enumerate(((a, b), (b, c)), 1)]
    return feed[0].unionByName(feed[1])


def _history(t: Tables) -> DataFrame:
    """Rows and value of each version, from their folders."""
    folder = _changed(t)
    rows = t.spark.read.parquet(*[f"{folder}/{n}" for n in range(3)]).withColumn("version", F.regexp_extract(F.input_file_name(), "/([0-9]+)/[^/]*$", 1).cast("long"))
    return rows.groupBy("version").agg(F.count(F.lit(1)).alias("n"), F.min("o_orderkey").alias("first_key"), F.max("o_orderkey").alias("last_key"))


def _merge_in_place(t: Tables) -> DataFrame:
    path, (even, odd) = f"{scratch(t.spark, 'merged')}/orders", _halves(t)
    merge_into(path, even, ["o_orderkey"])
    merge_into(path, odd.where("o_orderkey % 10 = 1").unionByName(even.where("o_orderkey % 10 = 0").withColumn("price", F.lit(1.0))), ["o_orderkey"])
    replace(deleted(t.spark.read.parquet(path), "o_orderkey % 10 = 2"), path)
    return t.spark.read.parquet(path)


def _merge_clauses(t: Tables) -> DataFrame:
    even, _ = _halves(t)
    source = t.orders.select("o_orderkey", "o_orderstatus", F.col("o_totalprice").alias("price")).where("o_orderkey % 3 = 0")
    return merged(even, source, ["o_orderkey"], [When("delete", "s.o_orderstatus = 'F'"), When("update", "t.price > 1000", {"price": "t.price + 1"}), When("insert", "s.price > 50000")])


def _compacted(t: Tables) -> DataFrame:
    folder = _changed(t)
    compact(t.spark, f"{folder}/2", f"{folder}/3", ["o_orderkey"])
    return t.spark.read.parquet(f"{folder}/3").select("o_orderkey")


def _stream(t: Tables) -> DataFrame:
    events = t.events.drop("ts")
    folder = scratch(t.spark, "stream")
    events.transform(shape("event_id", events.columns)).write.parquet(f"{folder}/in")
    records = t.spark.readStream.schema("key string, value string").parquet(f"{folder}/in")
    query = start(records.transform(decode(_EVENT)).writeStream.format("parquet").option("path", f"{folder}/out"), f"{folder}/state")
    query.awaitTermination()
    return t.spark.read.schema(f"key string, {_EVENT}").parquet(f"{folder}/out")


def _modes(t: Tables) -> DataFrame:
    """Two appends after an overwrite, and a write that is ignored."""
    path = scratch(t.spark, "modes")
    sink = S.ParquetSink(path)
    for mode, rows in (("append", t.nation), ("overwrite", t.nation.where("n_regionkey = 0")), ("append", t.nation.where("n_regionkey = 1")), ("ignore", t.nation)):
        sink.with_options(mode=mode).write(rows)
    return t.spark.read.parquet(path)


def _json_partitioned(t: Tables) -> DataFrame:
    path = S.JsonSink(scratch(t.spark, "jsonp"), partition_by=("o_orderstatus",), compression="gzip").write(t.orders.select("o_orderkey", "o_orderstatus"))
    return S.Json(path, "o_orderkey long, o_orderstatus string").read(t.spark)


def _upsert(t: Tables) -> DataFrame:
    """Derby has MERGE; the table and its staging table are made by Spark under small quoted names."""
    db = _database(t)
    rows = t.region.select(F.col("r_regionkey").alias("k"), F.col("r_name").alias("v"))
    db.write(rows, "target", "overwrite")
    db.write(rows.select((F.col("k") + 3).alias("k"), F.lit("new").alias("v")), "staging", "overwrite")
    db.execute(t.spark, upsert_sql("target", "staging", ['"k"', '"v"'], ['"k"'], dialect="merge"))
    return db.read(t.spark, "target").toDF("k", "v")


RULES = {"price": "o_totalprice < 300000", "done": "o_orderstatus <> 'O' or o_orderdate >= date '1995-01-01'", "priority": "nullif(o_orderpriority, '5-LOW') is not null"}


def _constrained(t: Tables) -> DataFrame:
    """Orders under three rules: the good ones, and the bad ones with the rules that they break."""
    sink = Constrained(scratch(t.spark, "rules"), RULES)
    sink.write(t.orders)
    good = sink.read(t.spark).select("o_orderkey", F.lit("").alias("broken"))
    return good.unionByName(sink.quarantine(t.spark).select("o_orderkey", F.array_join("broken", ",").alias("broken")))


def _clustered(t: Tables) -> DataFrame:
    path = scratch(t.spark, "curve")
    t.lineitem.transform(clustered(["l_partkey", "l_shipdate"], 16)).write.parquet(path)
    return t.spark.read.parquet(path).select("l_orderkey", "l_linenumber", "l_partkey")


_EVEN = "SELECT o_orderkey, o_orderstatus, o_totalprice AS price FROM orders WHERE o_orderkey % 2 = 0"

ENTRIES: dict[str, Entry] = {
    "S2_W2_csv": (_csv, "SELECT * FROM customer"),
    "S3_csv_preview": (lambda t: S.Csv(S.write_csv(t.nation, scratch(t.spark, "csv")), "n_nationkey int, n_name string, n_regionkey int").preview(t.spark, 100), "SELECT * FROM nation"),
    "S4_W3_csv_partitioned": (_csv_partitioned, "SELECT c_custkey, c_mktsegment FROM customer"),
    "S5_W4_json": (_json, "SELECT * FROM customer"),
    "S6_json_preview": (lambda t: S.Json(S.write_json(t.region, scratch(t.spark, "jsonv")), "r_regionkey int, r_name string").preview(t.spark, 10), "SELECT * FROM region"),
    "S8_json_options": (lambda t: S.Json().with_options(path=S.write_json(t.region, scratch(t.spark, "jsono")), primitives_as_string=True).read(t.spark).select("r_regionkey", "r_name"), "SELECT CAST(r_regionkey AS VARCHAR) AS r_regionkey, r_name FROM region"),
    "W1_write_modes": (_modes, "SELECT * FROM nation WHERE n_regionkey IN (0, 1)"),
    "W5_json_partitioned": (_json_partitioned, "SELECT o_orderkey, o_orderstatus FROM orders"),
    "W15_jdbc_upsert": (_upsert, "SELECT r_regionkey AS k, CASE WHEN r_regionkey >= 3 THEN 'new' ELSE r_name END AS v FROM region UNION ALL SELECT CAST(r_regionkey + 3 AS INTEGER), 'new' FROM region WHERE r_regionkey >= 2"),
    "S7_W6_nested_json": (_nested, "SELECT o_orderkey, o_orderstatus AS state_o_orderstatus, c_custkey AS who_c_custkey, c_name AS who_c_name FROM orders JOIN customer ON o_custkey = c_custkey"),
    "S9_json_documents": (lambda t: S.read_json_documents(t.spark, S.write_json(t.region, scratch(t.spark, "doc"), files=5), "r_regionkey int, r_name string"), "SELECT * FROM region"),
    "S10_W8_parquet": (_parquet, "SELECT * FROM part"),
    "S11_W14_jdbc": (_jdbc, "SELECT * FROM nation"),
    "S12_jdbc_query": (_jdbc_query, "SELECT r_name FROM region WHERE r_regionkey > 2"),
    "S13_W10_time_travel": (_travel, "SELECT 0 AS v, o_orderkey FROM orders WHERE o_orderkey % 2 = 0 UNION ALL SELECT 1, o_orderkey FROM orders"),
    "S14_change_feed": (
        _change_feed,
        f"""WITH e AS ({_EVEN}) SELECT o_orderkey, price, 'update_preimage' AS _change_type, 1::BIGINT AS _commit_version FROM e WHERE o_orderkey % 10 = 0
        UNION ALL SELECT o_orderkey, 1.0, 'update_postimage', 1 FROM e WHERE o_orderkey % 10 = 0
        UNION ALL SELECT o_orderkey, o_totalprice, 'insert', 1 FROM orders WHERE o_orderkey % 10 = 1
        UNION ALL SELECT o_orderkey, price, 'delete', 2 FROM e WHERE o_orderkey % 10 = 2""",
    ),
    "S15_history": (
        _history,
        f"""WITH e AS ({_EVEN}), v AS (SELECT 0 AS version, o_orderkey FROM e UNION ALL SELECT 1, o_orderkey FROM orders WHERE o_orderkey % 2 = 0 OR o_orderkey % 10 = 1
          UNION ALL SELECT 2, o_orderkey FROM orders WHERE (o_orderkey % 2 = 0 OR o_orderkey % 10 = 1) AND o_orderkey % 10 <> 2)
        SELECT CAST(version AS BIGINT) AS version, count(*) AS n, min(o_orderkey) AS first_key, max(o_orderkey) AS last_key FROM v GROUP BY 1""",
    ),
    "W7_array_json": (_arrays, "SELECT o_custkey, count(*) AS n, max(o_orderkey) AS last FROM orders GROUP BY 1"),
    "W9_date_partitions": (_by_date, "SELECT year(o_orderdate) AS year, month(o_orderdate) AS month, count(*) AS n FROM orders GROUP BY 1, 2"),
    "W11_merge": (_merge_in_place, f"WITH e AS ({_EVEN}) SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderkey % 10 = 0 THEN 1.0 ELSE price END AS price FROM e WHERE o_orderkey % 10 <> 2 UNION ALL SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderkey % 10 = 1"),
    "W11_merge_clauses": (
        _merge_clauses,
        f"WITH e AS ({_EVEN}) SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderkey % 3 = 0 AND price > 1000 THEN price + 1 ELSE price END AS price FROM e WHERE NOT (o_orderkey % 3 = 0 AND o_orderstatus = 'F') UNION ALL SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderkey % 2 = 1 AND o_orderkey % 3 = 0 AND o_totalprice > 50000",
    ),
    "W12_W13_optimize_vacuum": (
        _compacted,
        f"SELECT o_orderkey FROM ({_EVEN}) WHERE o_orderkey % 10 <> 2 UNION ALL SELECT o_orderkey FROM orders WHERE o_orderkey % 10 = 1",
    ),
    "W12_clustered_files": (_clustered, "SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem"),
    "W10_constraints": (
        _constrained,
        """SELECT o_orderkey, concat_ws(',', CASE WHEN NOT o_totalprice < 300000 THEN 'price' END, CASE WHEN o_orderstatus = 'O' AND o_orderdate < DATE '1995-01-01' THEN 'done' END,
        CASE WHEN o_orderpriority = '5-LOW' THEN 'priority' END) AS broken FROM orders""",
    ),
    "S17_W18_records": (lambda t: t.events.drop("ts").transform(shape("event_id", ["event_id", "user_id", "event_type", "value", "props"])).transform(decode(_EVENT)), "SELECT CAST(event_id AS VARCHAR) AS key, event_id, user_id, event_type, value, props FROM events"),
    "S16_W17_stream": (_stream, "SELECT CAST(event_id AS VARCHAR) AS key, event_id, user_id, event_type, value, props FROM events"),
}
