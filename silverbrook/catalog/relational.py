"""Registered queries of the generic operators (P, J, A, V, O, D, F), with their SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType

from silverbrook.catalog.tables import Entry, Tables
from silverbrook.functions.columns import parse_boolean, parse_date, parse_gender, parse_timestamp
from silverbrook.operators import aggregate as A, clean as P, joins as J, window as V
from silverbrook.operators.running import running
from silverbrook.operators.selection import exact_quantiles
from silverbrook.plans.pipeline import Pipeline


def _padded(t: Tables) -> DataFrame:
    """Customers with padding, nulls and repeats put in by rule."""
    return t.customer.select(
        "c_custkey",
        F.concat(F.lit("  "), "c_name", F.lit(" ")).alias("c_name"),
        F.nullif(F.col("c_nationkey"), F.lit(3)).alias("c_nationkey"),
        F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")).alias("c_mktsegment"),
        "c_acctbal",
    )


_PADDED = "(SELECT c_custkey, '  ' || c_name || ' ' AS c_name, nullif(c_nationkey, 3) AS c_nationkey, nullif(c_mktsegment, 'BUILDING') AS c_mktsegment, c_acctbal FROM customer)"
_NATION = StructType([StructField("n_name", StringType()), StructField("n_nationkey", LongType()), StructField("population", DoubleType())])


def _answer() -> Column:
    """Words for yes and no in the forms in which they come, by customer."""
    return F.element_at(F.array(F.lit(" Oui"), F.lit("TRUE"), F.lit("n "), F.lit("maybe")), (F.col("c_custkey") % 4 + 1).cast("int"))


def _sex() -> Column:
    return F.when(F.col("c_mktsegment").isNotNull(), F.element_at(F.array(F.lit("Homme"), F.lit(" f"), F.lit("x")), (F.col("c_nationkey") % 3 + 1).cast("int")))


def _bands(t: Tables) -> DataFrame:
    return t.spark.createDataFrame([("low", 0.0, 50_000.0), ("mid", 50_000.0, 150_000.0), ("high", 150_000.0, 600_000.0)], "band string, low double, high double")


_BANDS = "(VALUES ('low', 0.0, 50000.0), ('mid', 50000.0, 150000.0), ('high', 150000.0, 600000.0)) AS b(band, low, high)"


def _europe(t: Tables) -> DataFrame:
    return t.nation.where("n_regionkey in (1, 3)")


def _moved(t: Tables) -> DataFrame:
    """All customers, every third under a key that no order has."""
    return t.customer.select(F.when(F.col("c_custkey") % 3 == 0, -F.col("c_custkey")).otherwise(F.col("c_custkey")).alias("c_custkey"), "c_acctbal")


_MOVED = "(SELECT * REPLACE (CASE WHEN c_custkey % 3 = 0 THEN -c_custkey ELSE c_custkey END AS c_custkey) FROM customer)"


def _agg(function: str, column: str = "l_quantity", **more):
    return lambda t: t.lineitem.transform(A.aggregate(["l_returnflag", "l_linestatus"], [A.Agg(column, function, "v", **more)]))


def _agg_sql(expression: str) -> str:
    return f"SELECT l_returnflag, l_linestatus, {expression} AS v FROM lineitem GROUP BY 1, 2"


def _over(function: str, column: str | None = None, **more):
    frame = {k: more.pop(k) for k in ("rows", "range_") if k in more}
    return lambda t: t.orders.transform(V.windowed(["o_custkey"], ["o_orderdate", "o_orderkey"], [V.Over(function, "v", column, **more)], **frame)).select("o_orderkey", "v")


_W = "(PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)"


def _over_sql(call: str, cast: str | None = None, window: str = _W) -> str:
    call = f"{call} OVER {window}"
    return f"SELECT o_orderkey, {f'CAST({call} AS {cast})' if cast else call} AS v FROM orders"


ENTRIES: dict[str, Entry] = {
    # projection, cleaning, schema
    "P2_pipeline": (
        lambda t: Pipeline([P.trim_strings(["c_name"]), P.fill_nulls({"c_mktsegment": "NONE"}), P.lower_case(["c_mktsegment"])])(_padded(t)).select("c_custkey", "c_name", "c_mktsegment"),
        f"SELECT c_custkey, trim(c_name) AS c_name, lower(coalesce(c_mktsegment, 'NONE')) AS c_mktsegment FROM {_PADDED}",
    ),
    "P3_trim": (lambda t: _padded(t).transform(P.trim_strings()), f"SELECT c_custkey, trim(c_name) AS c_name, c_nationkey, c_mktsegment, c_acctbal FROM {_PADDED}"),
    "P4_drop_nulls_any": (lambda t: _padded(t).transform(P.drop_nulls(["c_nationkey", "c_mktsegment"])), f"SELECT * FROM {_PADDED} WHERE c_nationkey IS NOT NULL AND c_mktsegment IS NOT NULL"),
    "P4_drop_nulls_all": (lambda t: _padded(t).transform(P.drop_nulls(["c_nationkey", "c_mktsegment"], how="all")), f"SELECT * FROM {_PADDED} WHERE c_nationkey IS NOT NULL OR c_mktsegment IS NOT NULL"),
    "P4_drop_nulls_thresh": (lambda t: _padded(t).transform(P.drop_nulls(thresh=4)), f"SELECT * FROM {_PADDED} WHERE (c_nationkey IS NOT NULL)::INT + (c_mktsegment IS NOT NULL)::INT >= 1"),
    "P5_fill_nulls": (lambda t: _padded(t).transform(P.fill_nulls({"c_nationkey": -1, "c_mktsegment": "NONE"})), f"SELECT c_custkey, c_name, coalesce(c_nationkey, -1) AS c_nationkey, coalesce(c_mktsegment, 'NONE') AS c_mktsegment, c_acctbal FROM {_PADDED}"),
    "P6_drop_duplicates": (lambda t: t.orders.select("o_orderstatus", "o_orderpriority").transform(P.drop_duplicates()), "SELECT DISTINCT o_orderstatus, o_orderpriority FROM orders"),
    "P6_drop_duplicates_subset": (lambda t: t.orders.transform(P.drop_duplicates(["o_custkey", "o_orderstatus"])).select("o_custkey", "o_orderstatus"), "SELECT DISTINCT o_custkey, o_orderstatus FROM orders"),
    "P7_case": (lambda t: t.customer.transform(P.lower_case(["c_name", "absent"])).transform(P.upper_case(["c_mktsegment"])), "SELECT c_custkey, lower(c_name) AS c_name, c_nationkey, c_acctbal, upper(c_mktsegment) AS c_mktsegment FROM customer"),
    "P8_keep_latest": (
        lambda t: t.orders.transform(P.keep_ranked(["o_custkey"], "o_orderdate", ties=["o_orderkey"])),
        "SELECT * FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) = 1",
    ),
    "P8_keep_last": (
        lambda t: t.orders.transform(P.keep_ranked(["o_custkey"], "o_orderdate", keep="last", ties=["o_orderkey"])),
        "SELECT * FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey DESC) = 1",
    ),
    "P9_enforce_schema": (lambda t: t.nation.transform(P.enforce_schema(_NATION, strict=False, fill_missing=True)), "SELECT n_name, CAST(n_nationkey AS BIGINT) AS n_nationkey, CAST(NULL AS DOUBLE) AS population FROM nation"),
    "P10_cast": (
        lambda t: t.orders.select("o_orderkey", F.col("o_orderpriority").substr(1, 1).alias("digit"), F.col("o_orderstatus").alias("status")).transform(P.cast_columns({"digit": IntegerType(), "status": "int", "absent": "int"})),
        "SELECT o_orderkey, TRY_CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS digit, TRY_CAST(o_orderstatus AS INTEGER) AS status FROM orders",
    ),
    "P11_valid_rows": (lambda t: _padded(t).transform(P.valid_rows(["c_mktsegment"], ["c_acctbal > 0", "c_nationkey <> 5"])), f"SELECT * FROM {_PADDED} WHERE c_mktsegment IS NOT NULL AND c_acctbal > 0 AND c_nationkey <> 5"),
    "P12_keep_existing": (lambda t: t.part.transform(P.keep_existing(["p_size", "absent", "p_partkey"])), "SELECT p_size, p_partkey FROM part"),
    "P13_ingest_metadata": (lambda t: t.supplier.transform(P.stamp_ingestion("supplier", "load", file_name=True)).select("s_suppkey", "_source", "_job_name", F.col("_source_file").endswith(".parquet").alias("from_parquet")), "SELECT s_suppkey, 'supplier' AS _source, 'load' AS _job_name, true AS from_parquet FROM supplier"),
    # joins
    "J1_inner": (lambda t: t.orders.transform(J.join(t.customer, conditions=[J.On("o_custkey", "c_custkey")])).select("o_orderkey", "c_name"), "SELECT o_orderkey, c_name FROM orders JOIN customer ON o_custkey = c_custkey"),
    "J1_left": (lambda t: t.customer.transform(J.join(t.orders, "left", conditions=[J.On("c_custkey", "o_custkey")])).select("c_custkey", "o_orderkey"), "SELECT c_custkey, o_orderkey FROM customer LEFT JOIN orders ON c_custkey = o_custkey"),
    "J1_right": (lambda t: _moved(t).transform(J.join(t.orders, "right", conditions=[J.On("c_custkey", "o_custkey")])).select("c_custkey", "o_orderkey"), f"SELECT c_custkey, o_orderkey FROM {_MOVED} RIGHT JOIN orders ON c_custkey = o_custkey"),
    "J1_full": (
        lambda t: t.customer.select((F.col("c_nationkey") + F.when(F.col("c_custkey") % 5 == 0, 100).otherwise(0)).alias("k"), "c_custkey").transform(
            J.join(t.supplier.select((F.col("s_nationkey") + F.when(F.col("s_suppkey") % 5 == 0, 200).otherwise(0)).alias("k"), "s_suppkey"), "full", on=["k"])
        ),
        "SELECT coalesce(c.k, s.k) AS k, c_custkey, s_suppkey FROM (SELECT c_nationkey + CASE WHEN c_custkey % 5 = 0 THEN 100 ELSE 0 END AS k, c_custkey FROM customer) c FULL JOIN (SELECT s_nationkey + CASE WHEN s_suppkey % 5 = 0 THEN 200 ELSE 0 END AS k, s_suppkey FROM supplier) s ON c.k = s.k",
    ),
    "J1_cross": (lambda t: t.region.transform(J.join(t.nation.select("n_name"), "cross")).select("r_name", "n_name"), "SELECT r_name, n_name FROM region, nation"),
    "J2_theta": (
        lambda t: _moved(t).transform(J.join(t.orders, conditions=[J.On("c_custkey", "o_custkey"), J.On("c_acctbal", "o_totalprice", ">")])).select("c_custkey", "o_orderkey"),
        f"SELECT c_custkey, o_orderkey FROM {_MOVED} JOIN orders ON c_custkey = o_custkey AND c_acctbal > o_totalprice",
    ),
    "J3_suffix": (
        lambda t: t.nation.select(F.col("n_regionkey").alias("key"), F.col("n_name").alias("name")).transform(J.join(t.region.select(F.col("r_regionkey").alias("key"), F.col("r_name").alias("name")), on=["key"], broadcast=True)),
        "SELECT n_regionkey AS key, n_name AS name, r_name AS name_right FROM nation JOIN region ON n_regionkey = r_regionkey",
    ),
    "J4_chain": (
        lambda t: t.orders.transform(J.join_all([J.Step(t.customer, conditions=[J.On("o_custkey", "c_custkey")]), J.Step(t.nation, conditions=[J.On("c_nationkey", "n_nationkey")]), J.Step(t.region, "left", conditions=[J.On("n_regionkey", "r_regionkey")])])).select("o_orderkey", "n_name", "r_name"),
        "SELECT o_orderkey, n_name, r_name FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey",
    ),
    "J5_lookup": (
        lambda t: t.customer.transform(J.lookup(_europe(t), "n_nationkey", "c_nationkey", ["n_name"], {"n_name": "elsewhere"})).select("c_custkey", "n_name"),
        "SELECT c_custkey, coalesce(n_name, 'elsewhere') AS n_name FROM customer LEFT JOIN (SELECT * FROM nation WHERE n_regionkey IN (1, 3)) ON c_nationkey = n_nationkey",
    ),
    "J6_self": (
        lambda t: t.nation.transform(J.self_join(lambda a, b: (a("n_regionkey") == b("n_regionkey")) & (a("n_nationkey") < b("n_nationkey")), {"n_name": "other"}, "left")).select("n_name", "other"),
        "SELECT a.n_name, b.n_name AS other FROM nation a LEFT JOIN nation b ON a.n_regionkey = b.n_regionkey AND a.n_nationkey < b.n_nationkey",
    ),
    "J7_range": (
        lambda t: t.orders.transform(J.conditional_join(_bands(t), lambda a, b: (a("o_totalprice") >= b("low")) & (a("o_totalprice") < b("high")), "left", ["band"], broadcast=True)).select("o_orderkey", "band"),
        f"SELECT o_orderkey, band FROM orders LEFT JOIN {_BANDS} ON o_totalprice >= low AND o_totalprice < high",
    ),
    "J7_band_join": (
        lambda t: t.orders.transform(J.band_join(_bands(t), "o_totalprice", "low", "high", 50_000)).select("o_orderkey", "band"),
        f"SELECT o_orderkey, band FROM orders JOIN {_BANDS} ON o_totalprice >= low AND o_totalprice < high",
    ),
    "J8_inner_using": (lambda t: J.inner_join(t.orders, t.customer.withColumnRenamed("c_custkey", "o_custkey"), "o_custkey").select("o_orderkey", "c_name"), "SELECT o_orderkey, c_name FROM orders JOIN customer ON o_custkey = c_custkey"),
    "J8_left_using": (lambda t: J.left_join(t.orders, _moved(t).withColumnRenamed("c_custkey", "o_custkey"), ["o_custkey"]).select("o_orderkey", "c_acctbal"), f"SELECT o_orderkey, c_acctbal FROM orders LEFT JOIN {_MOVED} ON o_custkey = c_custkey"),
    "J9_lookup_same_key": (lambda t: t.orders.withColumnRenamed("o_custkey", "c_custkey").transform(J.lookup(t.customer, "c_custkey", columns=["c_name"])).select("o_orderkey", "c_name"), "SELECT o_orderkey, c_name FROM orders LEFT JOIN customer ON o_custkey = c_custkey"),
    "J10_anti": (lambda t: J.anti_join(t.customer, t.orders.select(F.col("o_custkey").alias("c_custkey")), "c_custkey"), "SELECT * FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)"),
    "J11_semi": (lambda t: J.semi_join(_moved(t), t.orders.select(F.col("o_custkey").alias("c_custkey")), "c_custkey"), f"SELECT c_custkey, c_acctbal FROM {_MOVED} WHERE c_custkey IN (SELECT o_custkey FROM orders)"),
    # aggregation
    "A1_sum": (_agg("sum"), _agg_sql("sum(l_quantity)")),
    "A1_count": (_agg("count"), _agg_sql("count(l_quantity)")),
    "A1_avg": (lambda t: _agg("avg")(t).withColumn("v", F.round("v", 6)), _agg_sql("round(avg(l_quantity), 6)")),
    "A1_mean": (lambda t: _agg("mean")(t).withColumn("v", F.round("v", 6)), _agg_sql("round(avg(l_quantity), 6)")),
    "A1_min": (_agg("min", "l_extendedprice"), _agg_sql("min(l_extendedprice)")),
    "A1_max": (_agg("max", "l_extendedprice"), _agg_sql("max(l_extendedprice)")),
    "A1_first_last": (
        lambda t: t.nation.orderBy("n_nationkey").coalesce(1).transform(A.aggregate([], [A.Agg("n_name", "first", "a"), A.Agg("n_name", "last", "b")])),
        "SELECT arg_min(n_name, n_nationkey) AS a, arg_max(n_name, n_nationkey) AS b FROM nation",
    ),
    "A1_collect_list": (lambda t: t.nation.transform(A.aggregate(["n_regionkey"], [A.Agg("n_name", "collect_list", "v")])).withColumn("v", F.array_join(F.sort_array("v"), ",")), "SELECT n_regionkey, string_agg(n_name, ',' ORDER BY n_name) AS v FROM nation GROUP BY 1"),
    "A1_collect_set": (lambda t: t.orders.transform(A.aggregate(["o_orderstatus"], [A.Agg("o_orderpriority", "collect_set", "v")])).withColumn("v", F.array_join(F.sort_array("v"), ",")), "SELECT o_orderstatus, string_agg(DISTINCT o_orderpriority, ',' ORDER BY o_orderpriority) AS v FROM orders GROUP BY 1"),
    "A1_count_distinct": (_agg("count_distinct", "l_partkey"), _agg_sql("count(DISTINCT l_partkey)")),
    "A1_stddev": (lambda t: _agg("stddev")(t).withColumn("v", F.round("v", 6)), _agg_sql("round(stddev_samp(l_quantity), 6)")),
    "A1_variance": (lambda t: _agg("variance")(t).withColumn("v", F.round("v", 5)), _agg_sql("round(var_samp(l_quantity), 5)")),
    "A1_median": (_agg("median", accuracy=0), _agg_sql("quantile_cont(l_quantity, 0.5)")),
    "A1_percentile": (_agg("percentile", percentile=0.9, accuracy=0), _agg_sql("quantile_cont(l_quantity, 0.9)")),
    "A1_percentile_approx": (_agg("percentile", percentile=0.9), _agg_sql("quantile_disc(l_quantity, 0.9)")),
    "A1_exact_quantiles": (
        lambda t: t.lineitem.transform(exact_quantiles(["l_returnflag", "l_linestatus"], "l_extendedprice", {"p01": 0.01, "median": 0.5, "p90": 0.9})),
        "SELECT l_returnflag, l_linestatus, quantile_cont(l_extendedprice, 0.01) AS p01, quantile_cont(l_extendedprice, 0.5) AS median, quantile_cont(l_extendedprice, 0.9) AS p90 FROM lineitem GROUP BY ALL",
    ),
    "A3_having_order": (
        lambda t: t.orders.transform(A.aggregate(["o_custkey"], [A.Agg("*", "count", "n"), A.Agg("o_totalprice", "max")], "n > 8", ["n", "o_custkey"], [False, True])),
        "SELECT o_custkey, count(*) AS n, max(o_totalprice) AS o_totalprice_max FROM orders GROUP BY 1 HAVING count(*) > 8",
    ),
    "A4_global": (lambda t: t.lineitem.transform(A.aggregate([], [A.Agg("*", "count", "n"), A.Agg("l_quantity", "sum", "q")])), "SELECT count(*) AS n, sum(l_quantity) AS q FROM lineitem"),
    "A5_rollup": (lambda t: t.orders.transform(A.rollup(["o_orderstatus", "o_orderpriority"], [A.Agg("*", "count", "n"), A.Agg("o_totalprice", "max", "m")], "g")), "SELECT o_orderstatus, o_orderpriority, count(*) AS n, max(o_totalprice) AS m, grouping_id(o_orderstatus, o_orderpriority) AS g FROM orders GROUP BY ROLLUP (o_orderstatus, o_orderpriority)"),
    "A6_cube": (lambda t: t.orders.transform(A.cube(["o_orderstatus", "o_orderpriority"], [A.Agg("*", "count", "n"), A.Agg("o_totalprice", "min", "m")], "g")), "SELECT o_orderstatus, o_orderpriority, count(*) AS n, min(o_totalprice) AS m, grouping_id(o_orderstatus, o_orderpriority) AS g FROM orders GROUP BY CUBE (o_orderstatus, o_orderpriority)"),
    "A7_pivot": (
        lambda t: t.orders.transform(A.pivot(["o_orderpriority"], "o_orderstatus", "o_totalprice", "max", ["F", "O", "P"])),
        "SELECT o_orderpriority, max(o_totalprice) FILTER (o_orderstatus = 'F') AS F, max(o_totalprice) FILTER (o_orderstatus = 'O') AS O, max(o_totalprice) FILTER (o_orderstatus = 'P') AS P FROM orders GROUP BY 1",
    ),
    "A7_pivot_discovered": (lambda t: t.lineitem.transform(A.pivot(["l_returnflag"], "l_linestatus", "l_quantity", "count")), "SELECT l_returnflag, nullif(count(*) FILTER (l_linestatus = 'F'), 0) AS F, nullif(count(*) FILTER (l_linestatus = 'O'), 0) AS O FROM lineitem GROUP BY 1"),
    "A8_unpivot": (
        lambda t: t.part.transform(A.unpivot(["p_partkey"], ["p_size", "p_retailprice"], "measure", "v")),
        "SELECT p_partkey, 'p_size' AS measure, CAST(p_size AS DOUBLE) AS v FROM part UNION ALL SELECT p_partkey, 'p_retailprice', p_retailprice FROM part",
    ),
    "A9_dict": (lambda t: t.customer.transform(A.aggregate_dict(["c_mktsegment"], {"c_acctbal": "max", "c_custkey": "count"})), "SELECT c_mktsegment, max(c_acctbal) AS c_acctbal_max, count(c_custkey) AS c_custkey_count FROM customer GROUP BY 1"),
    "A10_conditional_count": (lambda t: t.orders.groupBy("o_orderpriority").agg(A.conditional_count("o_totalprice > 100000").alias("n")), "SELECT o_orderpriority, count(*) FILTER (o_totalprice > 100000) AS n FROM orders GROUP BY 1"),
    "A11_ratio": (
        lambda t: t.orders.groupBy("o_orderpriority").agg(A.safe_ratio(A.conditional_count("o_orderstatus = 'X'").cast("double"), A.conditional_count("o_orderstatus = 'Y'")).alias("none"), A.safe_ratio(F.count(F.lit(1)).cast("double"), F.count_distinct("o_custkey")).alias("r")).withColumn("r", F.round("r", 6)),
        "SELECT o_orderpriority, CAST(NULL AS DOUBLE) AS none, round(count(*) / count(DISTINCT o_custkey), 6) AS r FROM orders GROUP BY 1",
    ),
    # windows
    "V3_row_number": (_over("row_number"), _over_sql("row_number()", "INTEGER")),
    "V3_rank": (lambda t: t.orders.transform(V.windowed(["o_custkey"], ["o_orderpriority"], [V.Over("rank", "v")])).select("o_orderkey", "v"), _over_sql("rank()", "INTEGER", "(PARTITION BY o_custkey ORDER BY o_orderpriority)")),
    "V3_dense_rank": (lambda t: t.orders.transform(V.windowed(["o_custkey"], ["o_orderpriority"], [V.Over("dense_rank", "v")])).select("o_orderkey", "v"), _over_sql("dense_rank()", "INTEGER", "(PARTITION BY o_custkey ORDER BY o_orderpriority)")),
    "V3_percent_rank": (_over("percent_rank"), _over_sql("percent_rank()")),
    "V3_cume_dist": (_over("cume_dist"), _over_sql("cume_dist()")),
    "V3_ntile": (_over("ntile", tiles=3), _over_sql("ntile(3)", "INTEGER")),
    "V4_sum_rows": (_over("sum", "o_totalprice", rows=(-2, 0)), _over_sql("sum(o_totalprice)", None, f"{_W[:-1]} ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)")),
    "V4_count": (_over("count", "o_totalprice"), _over_sql("count(o_totalprice)")),
    "V4_min_max": (
        lambda t: t.orders.transform(V.windowed(["o_custkey"], [], [V.Over("min", "a", "o_totalprice"), V.Over("max", "b", "o_totalprice")])).select("o_orderkey", "a", "b"),
        "SELECT o_orderkey, min(o_totalprice) OVER (PARTITION BY o_custkey) AS a, max(o_totalprice) OVER (PARTITION BY o_custkey) AS b FROM orders",
    ),
    "V4_first_last": (
        lambda t: t.orders.transform(V.windowed(["o_custkey"], ["o_orderdate", "o_orderkey"], [V.Over("first", "a", "o_orderkey"), V.Over("last", "b", "o_orderkey")], rows=(None, None))).select("o_orderkey", "a", "b"),
        f"SELECT o_orderkey, first_value(o_orderkey) OVER w AS a, last_value(o_orderkey) OVER w AS b FROM orders WINDOW w AS {_W[:-1]} ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)",
    ),
    "V4_avg_stddev": (
        lambda t: t.orders.transform(V.windowed(["o_orderpriority"], [], [V.Over("avg", "a", "o_totalprice"), V.Over("stddev", "s", "o_totalprice"), V.Over("variance", "x", "o_totalprice")])).select("o_orderkey", F.round("a", 4).alias("a"), F.round("s", 4).alias("s"), F.round(F.col("x") / 1e6, 4).alias("x")),
        "SELECT o_orderkey, round(avg(o_totalprice) OVER w, 4) AS a, round(stddev_samp(o_totalprice) OVER w, 4) AS s, round(var_samp(o_totalprice) OVER w / 1e6, 4) AS x FROM orders WINDOW w AS (PARTITION BY o_orderpriority)",
    ),
    "V4_range": (
        lambda t: t.part.transform(V.windowed(["p_brand"], ["p_size"], [V.Over("count", "v", "p_partkey")], range_=(-5, 0))).select("p_partkey", "v"),
        "SELECT p_partkey, count(p_partkey) OVER (PARTITION BY p_brand ORDER BY p_size RANGE BETWEEN 5 PRECEDING AND CURRENT ROW) AS v FROM part",
    ),
    "V5_lag": (_over("lag", "o_orderkey", offset=2, default=-1), _over_sql("lag(o_orderkey, 2, -1)")),
    "V5_lead": (_over("lead", "o_orderkey"), _over_sql("lead(o_orderkey)")),
    "V6_hot_running_total": (
        lambda t: t.events.select("event_id", "event_type", "user_id", F.round(F.col("value") * 100).cast("long").alias("cents")).transform(running([], ["event_type", "user_id", "event_id"], "cents")).select("event_id", "row_number", "running_total"),
        """SELECT event_id, row_number() OVER w AS row_number, CAST(sum(CAST(round(value * 100) AS BIGINT)) OVER w AS BIGINT) AS running_total
        FROM events WINDOW w AS (ORDER BY event_type, user_id, event_id ROWS UNBOUNDED PRECEDING)""",
    ),
    "V6_running_total": (
        lambda t: t.orders.transform(V.running_total(["o_custkey"], ["o_orderdate", "o_orderkey"], "o_totalprice", "v")).select("o_orderkey", F.round("v", 4).alias("v")),
        f"SELECT o_orderkey, round(sum(o_totalprice) OVER {_W[:-1]} ROWS UNBOUNDED PRECEDING), 4) AS v FROM orders",
    ),
    "V7_add_rank": (lambda t: t.part.transform(V.add_rank(["p_brand"], ["p_size"], "v", False, True)).select("p_partkey", "v"), "SELECT p_partkey, CAST(dense_rank() OVER (PARTITION BY p_brand ORDER BY p_size DESC) AS INTEGER) AS v FROM part"),
    "V8_share": (
        lambda t: t.part.groupBy("p_brand", "p_size").agg(F.count(F.lit(1)).alias("n")).transform(V.share_of_total(["p_brand"], "n", "share", 4)),
        "SELECT *, round(n * 100 / sum(n) OVER (PARTITION BY p_brand), 4) AS share FROM (SELECT p_brand, p_size, count(*) AS n FROM part GROUP BY 1, 2)",
    ),
    "V9_above_percentile": (lambda t: t.customer.transform(V.above_percentile("c_acctbal", 0.75, "high", 0)).select("c_custkey", "high"), "SELECT c_custkey, CASE WHEN c_acctbal > (SELECT quantile_cont(c_acctbal, 0.75) FROM customer) THEN 'Y' ELSE 'N' END AS high FROM customer"),
    "V10_growth": (
        lambda t: t.orders.groupBy("o_orderpriority", F.year("o_orderdate").cast("long").alias("y")).agg(F.count(F.lit(1)).alias("n")).transform(V.growth(["o_orderpriority"], ["y"], "n", "g", 6)),
        "SELECT *, round((n - lag(n) OVER w) / lag(n) OVER w * 100, 6) AS g FROM (SELECT o_orderpriority, year(o_orderdate) AS y, count(*) AS n FROM orders GROUP BY 1, 2) WINDOW w AS (PARTITION BY o_orderpriority ORDER BY y)",
    ),
    "V11_top_per_group": (
        lambda t: t.orders.transform(V.top_per_group(["o_orderpriority"], ["o_totalprice", "o_orderkey"], 5, [False, True])).select("o_orderkey", "rank"),
        "SELECT o_orderkey, CAST(r AS INTEGER) AS rank FROM (SELECT o_orderkey, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice DESC, o_orderkey) AS r FROM orders) WHERE r <= 5",
    ),
    # order, limit, distinct
    "O1_order_by": (lambda t: t.nation.orderBy(F.col("n_regionkey").desc(), "n_name"), "SELECT * FROM nation"),
    "O2_limit": (lambda t: t.part.orderBy("p_partkey").limit(7), "SELECT * FROM part ORDER BY p_partkey LIMIT 7"),
    "O3_top": (lambda t: t.orders.transform(V.top_rows(["o_totalprice", "o_orderkey"], 50, [False, True], "rank")).select("o_orderkey", "rank"), "SELECT o_orderkey, CAST(row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS INTEGER) AS rank FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 50"),
    "O4_nulls_last": (lambda t: _padded(t).orderBy(F.desc_nulls_last("c_nationkey"), "c_custkey").limit(30).select("c_custkey", "c_nationkey"), f"SELECT c_custkey, c_nationkey FROM {_PADDED} ORDER BY c_nationkey DESC NULLS LAST, c_custkey LIMIT 30"),
    "O5_top_computed": (
        lambda t: t.part.withColumn("v", F.col("p_size") * 1000 + F.col("p_partkey")).orderBy(F.desc("v"), "p_partkey").limit(5).select("p_partkey", "v"),
        "SELECT p_partkey, p_size * 1000 + p_partkey AS v FROM part ORDER BY v DESC, p_partkey LIMIT 5",
    ),
    "D1_distinct": (lambda t: t.lineitem.select("l_returnflag", "l_linestatus").distinct(), "SELECT DISTINCT l_returnflag, l_linestatus FROM lineitem"),
    # scalar functions
    "F1_F2_strings": (lambda t: _padded(t).select("c_custkey", F.concat_ws("/", F.upper(F.trim("c_name")), F.lower("c_mktsegment")).alias("v")), f"SELECT c_custkey, concat_ws('/', upper(trim(c_name)), lower(c_mktsegment)) AS v FROM {_PADDED}"),
    "F3_F4_regex_length": (lambda t: t.part.select("p_partkey", F.col("p_brand").rlike("[13]$").alias("m"), F.length("p_name").alias("n")), "SELECT p_partkey, regexp_matches(p_brand, '[13]$') AS m, CAST(length(p_name) AS INTEGER) AS n FROM part"),
    "F5_parse_dates": (
        lambda t: t.orders.select("o_orderkey", F.when(F.col("o_orderkey") % 3 == 0, F.date_format("o_orderdate", "dd/MM/yyyy")).when(F.col("o_orderkey") % 3 == 1, F.date_format("o_orderdate", "yyyy-MM-dd")).otherwise("never").alias("s")).select("o_orderkey", parse_date("s", ["yyyy-MM-dd", "dd/MM/yyyy"]).alias("d")),
        "SELECT o_orderkey, CASE WHEN o_orderkey % 3 < 2 THEN CAST(o_orderdate AS DATE) END AS d FROM orders",
    ),
    "F5_parse_timestamps": (
        lambda t: t.events.select("event_id", parse_timestamp(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), ["yyyy/MM/dd", "yyyy-MM-dd HH:mm:ss"]).cast("timestamp_ntz").alias("v")),
        "SELECT event_id, date_trunc('second', ts) AS v FROM events",
    ),
    "F6_F8_dates": (
        lambda t: t.orders.select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM").alias("m"), F.year("o_orderdate").cast("long").alias("y"), F.month("o_orderdate").cast("long").alias("mm"), F.dayofmonth("o_orderdate").cast("long").alias("d"), F.datediff(F.lit("2002-01-01").cast("date"), "o_orderdate").cast("long").alias("n")),
        "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m') AS m, year(o_orderdate) AS y, month(o_orderdate) AS mm, day(o_orderdate) AS d, date_diff('day', CAST(o_orderdate AS DATE), DATE '2002-01-01') AS n FROM orders",
    ),
    "F9_timestamps": (
        lambda t: t.orders.withColumn("_now", F.current_timestamp()).select("o_orderkey", (F.abs(F.unix_timestamp(F.current_timestamp()) - F.unix_timestamp("_now")) < 60).alias("same"), (F.col("_now") > "2020-01-01").alias("after")),
        "SELECT o_orderkey, true AS same, true AS after FROM orders",
    ),
    "F10_F11_round_abs": (lambda t: t.customer.select("c_custkey", F.abs("c_acctbal").alias("a"), F.round(F.col("c_acctbal").cast("decimal(12,2)"), 1).cast("double").alias("r")), "SELECT c_custkey, abs(c_acctbal) AS a, CAST(round(CAST(c_acctbal AS DECIMAL(12,2)), 1) AS DOUBLE) AS r FROM customer"),
    "F12_F15_conditions": (
        lambda t: _padded(t).select("c_custkey", F.when(F.col("c_acctbal") < 0, "debt").when(F.col("c_mktsegment").isNull(), "none").otherwise("ok").alias("w"), F.coalesce("c_mktsegment", F.lit("?")).alias("s"), F.col("c_nationkey").isin(1, 2).alias("i"), F.col("c_acctbal").cast("long").alias("n")),
        f"SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 'debt' WHEN c_mktsegment IS NULL THEN 'none' ELSE 'ok' END AS w, coalesce(c_mktsegment, '?') AS s, c_nationkey IN (1, 2) AS i, CAST(trunc(c_acctbal) AS BIGINT) AS n FROM {_PADDED}",
    ),
    "F16_json": (
        lambda t: t.region.select(F.to_json(F.struct("r_regionkey", "r_name")).alias("j")).select(F.from_json("j", "r_regionkey int, r_name string").alias("v")).select("v.*"),
        "SELECT r_regionkey, r_name FROM region",
    ),
    "F17_expr": (lambda t: t.lineitem.select("l_orderkey", F.expr("l_quantity * 2 + l_linenumber").alias("v")), "SELECT l_orderkey, l_quantity * 2 + l_linenumber AS v FROM lineitem"),
    "F18_input_file": (lambda t: t.region.select("r_regionkey", F.input_file_name().endswith("region.parquet").alias("v")), "SELECT r_regionkey, true AS v FROM region"),
    "F19_F20_normalise": (
        lambda t: t.customer.select("c_custkey", _answer().alias("b"), _sex().alias("g")).select("c_custkey", parse_boolean("b").alias("b"), parse_gender("g").alias("g")),
        """SELECT c_custkey, CASE WHEN c_custkey % 4 IN (0, 1) THEN true WHEN c_custkey % 4 = 2 THEN false END AS b,
        CASE WHEN c_mktsegment IS NULL THEN 'U' ELSE CASE c_nationkey % 3 WHEN 0 THEN 'M' WHEN 1 THEN 'F' ELSE 'U' END END AS g FROM customer""",
    ),
}
