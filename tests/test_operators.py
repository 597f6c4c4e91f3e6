from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from silverbrook.errors import SchemaError
from silverbrook.functions.columns import parse_boolean, parse_date, parse_gender
from silverbrook.operators import aggregate as A, clean as P, joins as J, window as V
from silverbrook.plans.pipeline import Pipeline
from silverbrook.sales import gold, silver
from silverbrook.sales.jobs import clean_customers, transform_orders


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*(order or df.columns)).collect()]


def test_cleaning(spark):
    df = spark.createDataFrame([(1, " a ", None), (1, " a ", None), (2, None, 3.0)], "id int, name string, v double")
    assert rows(df.transform(P.trim_strings()).distinct(), "id") == [(1, "a", None), (2, None, 3.0)]
    assert df.transform(P.drop_nulls(thresh=3)).count() == 0
    assert df.transform(P.drop_nulls(["v"])).count() == 1
    assert rows(df.transform(P.fill_nulls({"v": 0.0, "name": "?"})).select("v").distinct()) == [(0.0,), (3.0,)]
    assert df.transform(P.drop_duplicates()).count() == 2
    assert df.transform(P.keep_existing(["v", "nope"])).columns == ["v"]


def test_keep_ranked_keeps_null_keys_and_breaks_ties(spark):
    df = spark.createDataFrame([(None, 1, "a"), (None, 2, "b"), (1, 5, "d"), (1, 5, "c")], "k int, t int, n string")
    assert rows(df.transform(P.keep_ranked(["k"], "t", ties=["n"])), "k") == [(None, 2, "b"), (1, 5, "c")]
    assert rows(df.transform(P.keep_ranked(["k"], "t", keep="last", ties=["n"])), "k") == [(None, 1, "a"), (1, 5, "d")]
    with pytest.raises(ValueError):
        P.keep_ranked(["k"], "t", keep="middle")


def test_schema(spark):
    df = spark.createDataFrame([("1", "x", True)], "a string, b string, extra boolean")
    want = StructType([StructField("a", IntegerType()), StructField("c", StringType())])
    with pytest.raises(SchemaError):
        df.transform(P.enforce_schema(want))
    assert rows(df.transform(P.enforce_schema(want, strict=False, fill_missing=True))) == [(1, None)]
    assert df.transform(P.enforce_schema(want, strict=False)).columns == ["a"]
    assert rows(df.select(F.lit("x").alias("a")).transform(P.cast_columns({"a": "int"}))) == [(None,)]


def test_joins(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id int, name string")
    right = spark.createDataFrame([(1, 10), (2, 20), (4, 40)], "id int, value int")
    assert rows(left.transform(J.join(right, "inner", on=["id"]))) == [(1, "a", 10), (2, "b", 20)]
    assert rows(left.transform(J.join(right, "full", on=["id"])), "id") == [(1, "a", 10), (2, "b", 20), (3, "c", None), (4, None, 40)]
    assert rows(left.transform(J.join(right, "right", on=["id"])), "id")[-1] == (4, None, 40)
    assert rows(J.anti_join(left, right, "id")) == [(3, "c")]
    assert rows(J.semi_join(left, right, "id")) == [(1, "a"), (2, "b")]
    assert left.transform(J.join(right, "cross")).count() == 9
    assert left.transform(J.join(right, conditions=[J.On("id", "id", "<")])).count() == 4
    # conditions and columns both hold; a clash gets the suffix
    same = right.withColumn("name", F.lit("z"))
    out = left.transform(J.join(same, on=["id"], conditions=[J.On("id", "value", "<")]))
    assert out.columns == ["id", "name", "value", "name_right"] and out.count() == 2
    assert rows(left.transform(J.lookup(right, "id", columns=["value"], defaults={"value": -1})), "id") == [(1, "a", 10), (2, "b", 20), (3, "c", -1)]
    with pytest.raises(ValueError):
        J.On("a", "b", "~")
    with pytest.raises(ValueError):
        J.join(right, "sideways", on=["id"])
    with pytest.raises(ValueError):
        J.join(right)


def test_band_join_equals_range_join(spark):
    points = spark.range(0, 200).select((F.col("id") * 1.7 - 50).alias("x"))
    ranges = spark.createDataFrame([("a", -20.0, 30.5), ("b", 30.5, 31.0), ("c", 0.0, 290.0), ("none", 5.0, 5.0)], "name string, low double, high double")
    banded = points.transform(J.band_join(ranges, "x", "low", "high", 10))
    plain = points.transform(J.conditional_join(ranges, lambda a, b: (a("x") >= b("low")) & (a("x") < b("high")), "inner"))
    assert rows(banded) == rows(plain) and banded.count() > 0


def test_aggregates(spark):
    df = spark.createDataFrame([("A", "N", 10), ("A", "S", 20), ("B", "N", 5), (None, "N", 1)], "cat string, region string, sales int")
    assert rows(df.transform(A.aggregate(["cat"], [A.Agg("sales", "sum")], "sales_sum > 5")), "cat") == [("A", 30)]
    assert df.transform(A.cube(["cat", "region"], [A.Agg("sales", "sum")], "g")).where("g = 3").first()[2] == 36
    rolled = df.transform(A.rollup(["cat"], [A.Agg("*", "count", "n")], "g"))
    assert {(r.cat, r.n, r.g) for r in rolled.collect()} == {("A", 2, 0), ("B", 1, 0), (None, 1, 0), (None, 4, 1)}
    assert rows(df.where("cat = 'A'").transform(A.pivot(["cat"], "region", "sales"))) == [("A", 10, 20)]
    for bad in (lambda: A.Agg("x", "nope").expression(), lambda: A.rollup(["a"], [A.Agg("x", "first")]), lambda: A.pivot(["a"], "b", "c", "stddev")):
        with pytest.raises(ValueError):
            bad()


def test_windows(spark):
    df = spark.createDataFrame([("a", 1, 10.0), ("a", 2, 0.0), ("a", 3, 5.0), ("b", 1, 4.0)], "k string, t int, v double")
    assert [r[3] for r in rows(df.transform(V.running_total(["k"], ["t"], "v")), "k", "t")] == [10.0, 10.0, 15.0, 4.0]
    assert [r[3] for r in rows(df.transform(V.growth(["k"], ["t"], "v", "g")), "k", "t")] == [None, -100.0, None, None]
    assert df.transform(V.top_per_group(["k"], ["v"], 1)).count() == 2
    assert rows(df.transform(V.above_percentile("v", 0.5, "hi", 0)).select("v", "hi"), "v")[-1] == (10.0, "Y")
    with pytest.raises(ValueError):
        df.transform(V.windowed(["k"], ["t"], [V.Over("nope", "x")]))


def test_pipeline_and_columns(spark):
    p = Pipeline().add("trim", P.trim_strings()).add("up", P.upper_case(["s"]))
    df = spark.createDataFrame([(" x", "31/12/2020", "OUI", "Femme"), ("y", "2020-13-45", "?", None)], "s string, d string, b string, g string")
    out = rows(p(df).select("s", parse_date("d", ["yyyy-MM-dd", "dd/MM/yyyy"]).alias("d"), parse_boolean("b").alias("b"), parse_gender("g").alias("g")), "s")
    assert len(p) == 2 and out == [("X", dt.date(2020, 12, 31), True, "F"), ("Y", None, None, "U")]


def test_tax_and_discount(spark):
    df = spark.createDataFrame([("o1", "FR", Decimal("100.00")), ("o2", "US", Decimal("100.00")), ("o3", "XX", None)], "order_id string, customer_country string, subtotal decimal(12,2)")
    out = rows(df.transform(silver.add_tax({"FR": "0.20", "US": "0.10"})).select("order_id", "tax_amount", "total_amount"), "order_id")
    assert [(a, float(b), None if c is None else float(c)) for a, b, c in out] == [("o1", 20.0, 120.0), ("o2", 10.0, 110.0), ("o3", 0.0, None)]
    df = spark.createDataFrame([(Decimal("100.00"), Decimal("10.00")), (Decimal("500.00"), Decimal("5.00")), (None, None)], "subtotal decimal(12,2), discount_percent decimal(5,2)")
    assert sorted(float(r[0]) for r in df.transform(silver.add_discount()).select("discount_amount").collect()) == [0.0, 10.0, 25.0]


def test_silver_flags(spark):
    day = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([("o1", "c1", day, 600.0, "delivered"), ("o2", "c1", day + dt.timedelta(1), None, "shipped"), ("o3", "c2", day, 10.0, "odd")], "order_id string, customer_id string, order_date timestamp, total_amount double, order_status string")
    chain = Pipeline([silver.high_value_orders(), silver.repeat_orders(), silver.payment_status(), silver.fulfilment_status(), silver.delivery_time(), silver.margin_percent(), silver.enrich_orders()])
    out = {r.order_id: r for r in df.withColumn("unit_price", F.lit(1)).transform(chain).collect()}
    assert [out[o].is_high_value_order for o in ("o1", "o2", "o3")] == ["Y", "N", "N"]
    assert out["o2"].is_repeat_order == "Y" and out["o2"].customer_order_number == 2
    assert (out["o1"].payment_status, out["o2"].payment_status) == ("completed", "unknown")
    assert out["o2"].fulfillment_status == "in_transit" and out["o1"].days_to_delivery is None
    assert out["o1"].margin_percent == 30.0 and out["o1"].is_vip_customer == "N"


def test_rfm_recency_and_ties(spark):
    day = dt.datetime(2024, 3, 1)
    df = spark.createDataFrame([(i, f"c{i}", i, day - dt.timedelta(i), float(i)) for i in range(1, 11)], "customer_id long, customer_name string, order_id long, order_date timestamp, total_amount double")
    out = {r.customer_id: r for r in gold.rfm(stamp=False)(df).collect()}
    assert out[1].recency_score == 5 and out[10].recency_score == 1 and out[10].monetary_score == 5
    assert out[1].days_since_last_purchase == 0
    literal = {r.customer_id: r for r in gold.rfm(literal=True, stamp=False)(df).collect()}
    assert literal[1].recency_score == 1


def test_orders_and_customers_jobs(spark):
    df = spark.createDataFrame([("o1 ", "c1", 2, 10.0, None, "NEW"), ("o1", "c1", 2, 10.0, None, "NEW"), ("o2", "c2", 1, 50.0, 10.0, None)], "order_id string, customer_id string, quantity int, unit_price double, discount double, status string")
    out = rows(df.transform(transform_orders()).select("order_id", "total_amount", "status"), "order_id")
    assert out == [("o1", 20.0, "new"), ("o2", 45.0, "unknown")]
    df = spark.createDataFrame([("1", " A@X.com", "Ann", "Lee", "2020-01-31", "oui", "f", "fr"), ("1", "b@x.com", "Ann", "Lee", "2021-01-31", "no", "m", "fr"), (None, "c@x.com", "N", "N", "x", "x", "x", "x")], "customer_id string, email string, first_name string, last_name string, registration_date string, is_active string, gender string, country string")
    out = df.transform(clean_customers()).collect()
    assert len(out) == 1 and out[0].email == "b@x.com" and out[0].full_name == "Ann Lee" and out[0].is_active is False and out[0].gender == "M" and out[0].country == "FR"


def test_full_join_gives_pairs_on_as_they_come(spark):
    """Not by Spark's full join, which holds the pairs of a key."""
    left = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (2, "c", 3), (None, "d", 4)], "k int, v string, w int")
    right = spark.createDataFrame([(1, "x", 1), (1, "y", 9), (1 << 40, "z", 3), (None, "n", 4)], "k long, v string, u int")
    for how in ({"on": ["k"]}, {"conditions": [J.On("k", "k")]}, {"on": ["k"], "conditions": [J.On("w", "u", ">=")]}):
        out = left.transform(J.join(right, "full", **how))
        a, b = left.alias("a"), right.alias("b")
        test = (F.col("a.k") == F.col("b.k")) & ((F.col("a.w") >= F.col("b.u")) if len(how) == 2 else F.lit(True))
        key = F.coalesce("a.k", "b.k") if "on" in how else F.col("a.k")
        more = [] if "on" in how else [F.col("b.k").alias("k_right")]
        spark_own = a.join(b, test, "full").select(key.alias("k"), "a.v", "a.w", *more, F.col("b.v").alias("v_right"), "b.u")
        assert out.columns == spark_own.columns and out.dtypes == spark_own.dtypes
        assert sorted(map(repr, out.collect())) == sorted(map(repr, spark_own.collect()))
        assert "FullOuter" not in out._jdf.queryExecution().toString()


def test_full_join_is_written_small(spark, tmp_path):
    """Rows that cycle over a key's long list fill 3 bytes a pair; all pairs are there, and a key's go to several tasks."""
    left, right = spark.range(600).select((F.col("id") % 6).alias("k"), "id"), spark.range(20_000).select((F.col("id") % 5 + 1).alias("k"), F.col("id").alias("other"))
    left.transform(J.join(right, "full", on=["k"])).write.parquet(out := str(tmp_path / "pairs"))
    found = spark.read.parquet(out)
    assert sum(p.stat().st_size for p in (tmp_path / "pairs").glob("*.parquet")) < found.count()
    assert found.count() == found.distinct().count() == 100 + 5 * 100 * 4000
    assert found.where("other is null").count() == 100 and found.where("k <> id % 6 or k <> other % 5 + 1").count() == 0
    one = spark.range(2000).select(F.lit(1).alias("k"), "id").transform(J.join(right, "full", on=["k"]))
    assert one.where("id is not null").select(F.spark_partition_id()).distinct().count() > 2


@pytest.mark.parametrize("most", [-1, 10 << 20])
def test_full_join_holds_no_piece(spark, most):
    """The join isn't in generated code, which would hold a piece's pairs with all rows of the right side."""
    settings = {"spark.sql.autoBroadcastJoinThreshold": str(most), "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        joined = spark.range(600).select((F.col("id") % 6).alias("k"), "id").transform(J.join(spark.range(50).select(F.col("id").alias("k")), "full", on=["k"]))
        plan = joined._jdf.queryExecution().executedPlan().toString().splitlines()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert [x for x in plan if "Generate" in x and "*(" in x]
    assert [x for x in plan if "LeftOuter" in x] and not [x for x in plan if "LeftOuter" in x and "*(" in x]


def test_full_join_of_odd_rows(spark):
    """Signs of zero, maps, structs, repeated rows and rows of nothing but the key come out as they went in."""
    for left, right in (
        ("values (0.0d, 1), (-0.0d, 2), (double('NaN'), 3), (null, 4) t(k, v)", "values (-0.0d, 1), (double('NaN'), 2), (2.5d, 3) t(k, w)"),
        ("values (1, map('a', 1)), (1, null), (null, map('b', 2)) t(k, `v.w`)", "values (1, 'x'), (3, 'y') t(k, w)"),
        ("(select struct(v, 'a') as k from values (1), (1), (null) t(v))", "(select struct(v, 'a') as k, v as w from values (1), (3), (null) t(v))"),
        ("values (1) t(k) where k > 1", "values (1, 'x') t(k, w)"),
        ("values (1) t(k)", "values (1, 'x') t(k, w) where k > 1"),
        ("(select id % 3 as k, 1 as v from range(900))", "(select id % 4 as k, id as w from range(12))"),
    ):
        a, b = spark.sql(f"select * from {left}"), spark.sql(f"select * from {right}")
        rows = lambda df: sorted(map(repr, df.collect()))
        assert rows(a.transform(J.join(b, "full", on=["k"]))) == rows(a.join(b, "k", "full"))


def test_percentile_at_the_edge_of_a_value(spark):
    """Two rows in 400,000 decide between 45 and 46; a sketch can't tell."""
    n = 400_000
    df = spark.range(n).select((F.col("id") % 3).alias("k"), F.when(F.col("id") * 10 < 9 * n - 20, F.col("id") % 45 + 1).otherwise(F.col("id") % 5 + 46).cast("double").alias("v"))
    df = df.unionByName(spark.createDataFrame([(None, 2.0), (None, None), (9, None)], "k long, v double"))
    wanted = [A.Agg("*", "count", "n"), A.Agg("v", "percentile", "p", 0.9), A.Agg("v", "median", "m"), A.Agg("v", "percentile", "low", 0.0), A.Agg("v", "percentile", "high", 1.0)]
    whole = df.where("k < 3").transform(A.aggregate([], wanted)).collect()
    assert [tuple(r) for r in whole] == [(n, 46.0, 25.0, 1.0, 50.0)]
    exact = df.groupBy("k").agg(F.count("*"), *[F.expr(f"percentile_disc({p}) within group (order by v)") for p in (0.9, 0.5, 0.0, 1.0)])
    key = lambda r: (r[0] is None, r[0])
    assert sorted(map(tuple, df.transform(A.aggregate(["k"], wanted)).collect()), key=key) == sorted(map(tuple, exact.collect()), key=key)
    big = spark.createDataFrame([((1 << 60) + 1,)] * 3, "v long").transform(A.aggregate([], [A.Agg("v", "median", "m")]))
    assert big.collect()[0].m == (1 << 60) + 1


@pytest.mark.parametrize("operator", [gold.product_sales(), gold.top_products(), gold.daily_product_sales()])
def test_product_days_fill_no_hash_table(operator, spark):
    """There are nearly as many days of products as lines."""
    lines = spark.createDataFrame([], "order_date timestamp, order_id long, customer_id long, product_id long, product_name string, product_category string, quantity int, total_amount decimal(12,2), margin_percent decimal(9,2), unit_price decimal(12,2), discount_amount decimal(12,2)")
    plan = lines.transform(operator)._jdf.queryExecution().sparkPlan().toString()
    assert "SortAggregate" in plan and "HashAggregate" not in plan
