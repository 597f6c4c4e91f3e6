"""Registered queries of the quality operators (Q): results as rows, with their SQL."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from silverbrook.catalog.tables import Entry, Tables
from silverbrook.quality import report as R
from silverbrook.quality.checks import Checks, Result, results_frame, summary
from silverbrook.quality.expectations import run_expectations
from silverbrook.quality.schema_diff import schema_diff


def _shown(df: DataFrame) -> DataFrame:
    return df.select("check_name", "passed", "total", "valid", F.round("score", 6).alias("score"))


def _results(t: Tables, results: Sequence[Result]) -> DataFrame:
    return _shown(results_frame(t.region, results))


def _row(name: str, table: str, valid: str, total: str = "count(*)", least: float = 1.0, extra: str = "") -> str:
    return f"SELECT '{name}' AS check_name, {valid} >= {least} * {total} AS passed, {total} AS total, {valid} AS valid, round(CASE WHEN {total} = 0 THEN 1.0 ELSE CAST({valid} AS DOUBLE) / {total} END, 6) AS score FROM {table}{extra}"


def _holes(t: Tables) -> DataFrame:
    return t.customer.select("c_custkey", F.nullif("c_mktsegment", F.lit("BUILDING")).alias("seg"), F.nullif("c_nationkey", F.lit(3)).alias("nat"), "c_acctbal", F.concat("c_name", F.when(F.col("c_custkey") % 50 == 0, " at x").otherwise("@mail.com")).alias("email"))


_HOLES = "(SELECT c_custkey, nullif(c_mktsegment, 'BUILDING') AS seg, nullif(c_nationkey, 3) AS nat, c_acctbal, c_name || CASE WHEN c_custkey % 50 = 0 THEN ' at x' ELSE '@mail.com' END AS email FROM customer)"


def _expect(kind: str, **kwargs):
    def run(t: Tables) -> DataFrame:
        o = run_expectations(_holes(t), [{"expectation_type": kind, "kwargs": kwargs}]).outcomes[0]
        return t.spark.createDataFrame([(o.expectation, o.success, o.total, o.passed)], "expectation string, success boolean, total long, passed long")

    return run


def _expect_sql(kind: str, passed: str, mostly: float = 1.0) -> str:
    return f"SELECT '{kind}' AS expectation, {passed} >= {mostly} * count(*) AS success, count(*) AS total, {passed} AS passed FROM {_HOLES}"


_SEGMENTS = ["AUTOMOBILE", "MACHINERY", "FURNITURE", "HOUSEHOLD"]
_IN = "'AUTOMOBILE', 'MACHINERY', 'FURNITURE', 'HOUSEHOLD'"

ENTRIES: dict[str, Entry] = {
    "Q2_not_null": (lambda t: _shown(Checks().not_null("c_custkey", "seg").report(_holes(t))), _row("not_null_c_custkey", _HOLES, "count(c_custkey)") + " UNION ALL " + _row("not_null_seg", _HOLES, "count(seg)")),
    "Q3_unique": (lambda t: _shown(Checks().unique("o_orderkey").unique("o_custkey", "o_orderstatus").report(t.orders)), _row("unique_o_orderkey", "orders", "count(DISTINCT o_orderkey)") + " UNION ALL " + _row("unique_o_custkey_o_orderstatus", "orders", "count(DISTINCT (o_custkey, o_orderstatus))")),
    "Q4_in_set": (lambda t: _shown(Checks().in_set("seg", _SEGMENTS[:2]).report(_holes(t))), _row("in_set_seg", _HOLES, "count(*) FILTER (seg IS NULL OR seg IN ('AUTOMOBILE', 'MACHINERY'))")),
    "Q5_range": (lambda t: _shown(Checks().in_range("c_acctbal", 0, 9000).in_range("nat", 0).report(_holes(t))), _row("in_range_c_acctbal", _HOLES, "count(*) FILTER (c_acctbal BETWEEN 0 AND 9000)") + " UNION ALL " + _row("in_range_nat", _HOLES, "count(*) FILTER (nat IS NULL OR nat >= 0)")),
    "Q6_row_count": (lambda t: _shown(Checks().row_count(1, 10).report(t.region)), "SELECT 'row_count' AS check_name, count(*) BETWEEN 1 AND 10 AS passed, count(*) AS total, count(*) AS valid, 1.0::DOUBLE AS score FROM region"),
    "Q7_custom": (lambda t: Checks().custom("five", lambda d: d.count() == 5).report(t.region).select("check_name", "passed"), "SELECT 'five' AS check_name, count(*) = 5 AS passed FROM region"),
    "Q8_summary": (
        lambda t: t.spark.createDataFrame([(s["checks"], len(s["failed"]), round(s["score"], 6)) for s in [summary(Checks().not_null("seg", "c_custkey").run(_holes(t)))]], "checks long, failed long, score double"),
        f"SELECT 2::BIGINT AS checks, (count(seg) < count(*))::BIGINT AS failed, round((count(seg) / count(*) + 1) / 2, 6) AS score FROM {_HOLES}",
    ),
    "Q9_schema_diff": (
        lambda t: t.spark.createDataFrame([(",".join(d.missing), ",".join(d.extra), ",".join(d.types), d.valid) for d in [schema_diff(t.region, StructType([StructField("r_regionkey", LongType()), StructField("r_comment", StringType())]))]], "missing string, extra string, types string, valid boolean"),
        "SELECT 'r_comment' AS missing, 'r_name' AS extra, 'r_regionkey' AS types, false AS valid",
    ),
    "Q10_Q20_suite": (
        lambda t: t.spark.createDataFrame([(r.suite, r.success, round(r.success_rate, 6), len(r.failures())) for r in [run_expectations(_holes(t), [{"expectation_type": "expect_column_values_to_not_be_null", "kwargs": {"column": c}} for c in ("c_custkey", "c_acctbal", "seg")], "customers")]], "suite string, success boolean, rate double, failures long"),
        f"SELECT 'customers' AS suite, count(seg) = count(*) AS success, CASE WHEN count(seg) = count(*) THEN 1.0 ELSE 0.666667 END::DOUBLE AS rate, (count(seg) < count(*))::BIGINT AS failures FROM {_HOLES}",
    ),
    "Q21_report_score": (
        lambda t: t.spark.createDataFrame([(s["all_passed"], round(s["score"], 6)) for s in [summary(R.evaluate(_holes(t), R.completeness(["c_custkey", "seg"])))]], "all_passed boolean, score double"),
        f"SELECT count(seg) >= 0.95 * count(*) AS all_passed, round((1 + count(seg) / count(*)) / 2, 6) AS score FROM {_HOLES}",
    ),
    "Q11_column_exists": (_expect("expect_column_to_exist", column="absent"), "SELECT 'expect_column_to_exist' AS expectation, false AS success, CAST(NULL AS BIGINT) AS total, CAST(NULL AS BIGINT) AS passed"),
    "Q12_expect_not_null": (_expect("expect_column_values_to_not_be_null", column="seg", mostly=0.7), _expect_sql("expect_column_values_to_not_be_null", "count(seg)", 0.7)),
    "Q13_expect_unique": (_expect("expect_column_values_to_be_unique", column="c_custkey"), _expect_sql("expect_column_values_to_be_unique", "count(DISTINCT c_custkey)")),
    "Q14_expect_in_set": (_expect("expect_column_values_to_be_in_set", column="seg", value_set=_SEGMENTS, mostly=0.5), _expect_sql("expect_column_values_to_be_in_set", f"count(*) FILTER (seg IN ({_IN}))", 0.5)),
    "Q15_expect_between": (_expect("expect_column_values_to_be_between", column="c_acctbal", min_value=0, max_value=9999, mostly=0.9), _expect_sql("expect_column_values_to_be_between", "count(*) FILTER (c_acctbal BETWEEN 0 AND 9999)", 0.9)),
    "Q16_expect_regex": (_expect("expect_column_values_to_match_regex", column="email", regex="@", mostly=0.9), _expect_sql("expect_column_values_to_match_regex", "count(*) FILTER (regexp_matches(email, '@'))", 0.9)),
    "Q17_expect_row_count": (lambda t: _expect("expect_table_row_count_to_be_between", min_value=1)(t).select("expectation", "success", "total"), f"SELECT 'expect_table_row_count_to_be_between' AS expectation, count(*) >= 1 AS success, count(*) AS total FROM {_HOLES}"),
    "Q18_expect_mean": (lambda t: _expect("expect_column_mean_to_be_between", column="c_acctbal", min_value=0, max_value=5000)(t).select("expectation", "success"), f"SELECT 'expect_column_mean_to_be_between' AS expectation, avg(c_acctbal) BETWEEN 0 AND 5000 AS success FROM {_HOLES}"),
    "Q19_expect_type": (lambda t: _expect("expect_column_values_to_be_of_type", column="c_custkey", type_="integer")(t).select("expectation", "success"), "SELECT 'expect_column_values_to_be_of_type' AS expectation, true AS success"),
    "Q22_mean_completeness": (
        lambda t: _results(t, R.complete_on_average(_holes(t), ["c_custkey", "seg", "nat"], ["email", "absent"])),
        f"WITH m AS (SELECT count(*) AS total, (1.0::DOUBLE + count(seg) / count(*) + count(nat) / count(*)) / 3 AS score FROM {_HOLES}) SELECT 'completeness' AS check_name, score >= 0.95 AS passed, total, CAST(floor(total * score) AS BIGINT) AS valid, round(score, 6) AS score FROM m UNION ALL "
        + " UNION ALL ".join(_row(f"completeness_{c}", _HOLES, f"count({c})", least=0.0) for c in ("c_custkey", "seg", "nat", "email")),
    ),
    "Q22_completeness": (lambda t: _results(t, R.evaluate(_holes(t), R.completeness(["c_custkey", "seg", "nat"]))), " UNION ALL ".join(_row(f"completeness_{c}", _HOLES, f"count({c})", least=0.95) for c in ("c_custkey", "seg", "nat"))),
    "Q23_uniqueness": (lambda t: _results(t, R.evaluate(t.lineitem, R.uniqueness("l_orderkey", ["l_orderkey", "l_linenumber"]))), _row("uniqueness_l_orderkey", "lineitem", "count(DISTINCT l_orderkey)") + " UNION ALL " + _row("uniqueness_l_orderkey_l_linenumber", "lineitem", "count(DISTINCT (l_orderkey, l_linenumber))")),
    "Q24_email": (lambda t: _results(t, R.evaluate(_holes(t), [R.emails("email")])), _row("email_email", _HOLES, "count(*) FILTER (regexp_full_match(email, '[A-Za-z0-9._%+#-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{2,}') AND email NOT LIKE '%#%')", "count(email)", 0.95)),
    "Q25_dates": (lambda t: _results(t, R.evaluate(t.orders.withColumn("d", F.to_date("o_orderdate")), [R.dates("d", "1996-01-01", "2001-01-01")])), _row("date_d", "orders", "count(*) FILTER (CAST(o_orderdate AS DATE) BETWEEN DATE '1996-01-01' AND DATE '2001-01-01')", least=0.95)),
    "Q26_numbers": (lambda t: _results(t, R.evaluate(t.lineitem, [R.numbers("l_discount", 0, 0.08), R.numbers("l_quantity", 1)])), _row("number_l_discount", "lineitem", "count(*) FILTER (l_discount BETWEEN 0 AND 0.08::DOUBLE)", least=0.95) + " UNION ALL " + _row("number_l_quantity", "lineitem", "count(*) FILTER (l_quantity >= 1)", least=0.95)),
    "Q27_distribution": (lambda t: R.distribution(t.orders, "o_orderstatus"), 'SELECT o_orderstatus AS value, count(*) AS "rows" FROM orders GROUP BY 1'),
    "Q27_expected_values": (lambda t: _results(t, R.evaluate(t.orders, [R.expected_values("o_orderstatus", ["F", "O"])])), _row("values_o_orderstatus", "orders", "count(*) FILTER (o_orderstatus IN ('F', 'O'))", least=0.95)),
    "Q28_freshness": (lambda t: _results(t, R.evaluate(t.orders, [R.fresh("o_orderdate", "2001-08-01 00:00:00", 24 * 30)])), "SELECT check_name, valid > 0 AS passed, total, valid, score FROM (" + _row("freshness_o_orderdate", "orders", "count(*) FILTER (o_orderdate >= TIMESTAMP '2001-07-02')") + ")"),
    "Q29_consistency": (
        lambda t: _results(t, R.evaluate(t.part.withColumn("twice", F.col("p_size") * 2 + F.when(F.col("p_partkey") % 100 == 0, 1).otherwise(0)), [R.consistent("twice", "p_size + p_size")])),
        _row("consistency_twice", "part", "count(*) FILTER (p_partkey % 100 <> 0)", least=0.99),
    ),
    "Q30_monthly_distribution": (lambda t: R.monthly_distribution(t.orders.where("month(o_orderdate) <> 5"), "o_orderdate"), """SELECT CAST(m AS DATE) AS month, coalesce(n, 0) AS "rows", n IS NULL AS gap FROM (SELECT unnest(generate_series(a, b, INTERVAL 1 MONTH)) AS m FROM (SELECT min(date_trunc('month', o_orderdate))::TIMESTAMP AS a, max(date_trunc('month', o_orderdate))::TIMESTAMP AS b FROM orders WHERE month(o_orderdate) <> 5)) LEFT JOIN (SELECT date_trunc('month', o_orderdate)::TIMESTAMP AS m, count(*) AS n FROM orders WHERE month(o_orderdate) <> 5 GROUP BY 1) USING (m)"""),
    "Q31_foreign_key": (lambda t: _results(t, [R.foreign_key(t.orders, "o_custkey", t.customer.where("c_custkey % 10 <> 0"), "c_custkey")]), _row("foreign_key_o_custkey", "orders", "count(*) FILTER (o_custkey % 10 <> 0 AND o_custkey IN (SELECT c_custkey FROM customer))", least=0.99)),
    "Q31_orphans": (lambda t: R.orphans(t.orders, "o_custkey", t.customer.where("c_custkey % 10 <> 0"), "c_custkey", 10**9).select("o_orderkey"), "SELECT o_orderkey FROM orders WHERE o_custkey % 10 = 0 OR o_custkey NOT IN (SELECT c_custkey FROM customer)"),
    "Q32_rules": (
        lambda t: _results(t, R.apply_rules(_holes(t), [R.Rule("key", "not_null", "c_custkey", severity="critical"), R.Rule("once", "unique", "c_custkey"), R.Rule("mail", "regex", "email", "@", "c_acctbal > 0"), R.Rule("segment", "in_set", "seg", _SEGMENTS, "seg is not null"), R.Rule("owes", "sql", value="c_acctbal > -500")])),
        " UNION ALL ".join([_row("key", _HOLES, "count(c_custkey)"), _row("once", _HOLES, "count(DISTINCT c_custkey)"), _row("mail", _HOLES, "count(*) FILTER (c_acctbal > 0 AND email LIKE '%@%')", "count(*) FILTER (c_acctbal > 0)"), _row("segment", _HOLES, f"count(*) FILTER (seg IN ({_IN}))", "count(seg)"), _row("owes", _HOLES, "count(*) FILTER (c_acctbal > -500)")]),
    ),
}
