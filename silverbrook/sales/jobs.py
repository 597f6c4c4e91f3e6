"""The sales jobs: bronze ingestion, silver orders, gold tables and quality reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession, functions as F

from silverbrook.functions.columns import parse_boolean, parse_date, parse_gender, parse_timestamp
from silverbrook.operators import clean
from silverbrook.plans.jobs import Frames, Job
from silverbrook.plans.pipeline import Operator, Pipeline
from silverbrook.quality import report
from silverbrook.quality.checks import CRITICAL, WARNING, Checks, Result
from silverbrook.sales import gold, silver
from silverbrook.sources.jdbc import Jdbc
from silverbrook.sources.tables import merge_into

# The formats in which dates come.
DATES = ("yyyy-MM-dd", "dd/MM/yyyy", "MM/dd/yyyy", "yyyy/MM/dd")
TIMES = ("yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd")


def ingest_orders(database: Jdbc, table: str, target: str) -> Job:
    """A database table to a bronze folder, stamped and appended."""
    return Job(
        "ingest_orders",
        lambda spark: {"orders": database.read(spark, table)},
        lambda f: {"orders": f["orders"].transform(clean.stamp_ingestion("jdbc", "ingest_orders"))},
        lambda _, df: df.write.mode("append").parquet(target),
        {"orders": Checks().row_count(1).not_null("order_id", severity=CRITICAL)},
    )


def clean_customers() -> Operator:
    """Raw customers: valid rows, parsed dates, flags and genders, a full name, one row per id (the latest)."""

    def typed(df: DataFrame) -> DataFrame:
        made: dict[str, Any] = {}
        for c, f in (("birth_date", lambda x: parse_date(x, DATES)), ("registration_date", lambda x: parse_timestamp(x, TIMES)), ("is_active", parse_boolean), ("gender", parse_gender)):
            if c in df.columns:
                made[c] = f(F.col(c).cast("string"))
        if "email" in df.columns:
            made["email"] = F.lower(F.trim("email"))
        if "country" in df.columns:
            made["country"] = F.upper("country")
        df = df.withColumns(made)
        return df.withColumn("full_name", F.concat_ws(" ", "first_name", "last_name"))

    steps = [("trim", clean.trim_strings()), ("valid", clean.valid_rows(["customer_id"])), ("types", typed), ("latest", clean.keep_ranked(["customer_id"], "registration_date", ties=["email"]))]
    return Pipeline(steps)


CUSTOMER_RULES = (
    report.Rule("customer_id_set", "not_null", "customer_id", severity=CRITICAL),
    report.Rule("customer_id_once", "unique", "customer_id", severity=CRITICAL),
    report.Rule("email_format", "regex", "email", report.EMAIL, "email is not null"),
    report.Rule("gender_known", "in_set", "gender", ("M", "F", "U"), severity=WARNING),
)


def ingest_customers(source, target_sink, rules: Sequence[report.Rule] = CUSTOMER_RULES) -> Job:
    """CSV or JSON customers to bronze Parquet; failed critical rules stop the load."""

    def transform(frames: Frames) -> Frames:
        raw = frames["customers"]
        if "_corrupt_record" in raw.columns:
            raw = raw.where("_corrupt_record is null").drop("_corrupt_record")
        return {"customers": raw.transform(clean_customers()).transform(clean.stamp_ingestion("file", "ingest_customers"))}

    def judged(df: DataFrame) -> bool:
        return all(r.passed or r.severity == WARNING for r in report.apply_rules(df, rules))

    return Job("ingest_customers", lambda spark: {"customers": source.read(spark)}, transform, lambda _, df: target_sink.write(df) and None, {"customers": Checks().custom("rules", judged)})


def transform_orders(mode: str = "percent") -> Operator:
    """Bronze to silver orders: trimmed, one row per order_id, nulls filled, total_amount, status in small letters."""

    def totals(df: DataFrame) -> DataFrame:
        gross = F.col("quantity") * F.col("unit_price")
        off = gross * F.col("discount") / 100 if mode == "percent" else F.col("discount")
        return df.withColumn("total_amount", F.round(gross - off, 2)).withColumn("status", F.lower("status"))

    return Pipeline([("trim", clean.trim_strings()), ("once", clean.drop_duplicates(["order_id"])), ("fill", clean.fill_nulls({"discount": 0, "status": "unknown"})), ("totals", totals)])


def enrich_orders(bronze: str, customers: str, products: str, target: str, rates: Mapping[str, Any], threshold: float = 500) -> Job:
    """Silver orders with customers, products and all silver measures, merged by order_id."""
    steps = Pipeline([("discount", silver.add_discount()), ("tax", silver.add_tax(rates)), ("margin", silver.margin_percent()), ("value", silver.high_value_orders(threshold)), ("repeat", silver.repeat_orders(ties=["order_id"])), ("delivery", silver.delivery_time()), ("payment", silver.payment_status()), ("fulfilment", silver.fulfilment_status())])
    read = lambda spark: {n: spark.read.parquet(p) for n, p in (("orders", bronze), ("customers", customers), ("products", products))}
    transform = lambda f: {"orders": f["orders"].transform(silver.enrich_orders(f["customers"], f["products"])).transform(steps)}

    def load(_: str, df: DataFrame) -> None:
        merge_into(target, df, ["order_id"])

    return Job("enrich_orders", read, transform, load, {"orders": Checks().not_null("order_id", "customer_id", severity=CRITICAL).unique("order_id").in_range("total_amount", 0).in_set("payment_status", ["cancelled", "pending", "completed", "unknown"])})


GOLD: dict[str, Any] = {
    "daily_sales": gold.daily_sales,
    "product_sales": gold.product_sales,
    "customer_sales": gold.customer_sales,
    "monthly_trends": gold.monthly_trends,
    "segment_analysis": gold.segment_analysis,
    "top_products": gold.top_products,
    "rfm": gold.rfm,
    "daily_product_sales": gold.daily_product_sales,
    "monthly_customer_sales": gold.monthly_customer_sales,
    "sales_kpis": gold.sales_kpis,
    "best_products": gold.best_products,
}


def gold_job(silver_path: str, target: str, tables: Sequence[str] = tuple(GOLD)) -> Job:
    """Gold tables from silver orders, each at its own path."""

    def load(name: str, df: DataFrame) -> None:
        df.write.mode("overwrite").parquet(f"{target}/{name}")

    return Job("gold", lambda spark: {"orders": spark.read.parquet(silver_path)}, lambda f: {n: f["orders"].transform(GOLD[n]()) for n in tables}, load, {n: Checks().row_count(1, severity=WARNING) for n in tables})


def quality_job(spark: SparkSession, tables: Mapping[str, DataFrame], measures: Mapping[str, Sequence[report.Measure]], path: str | None = None, least: float | None = None) -> dict[str, list[Result]]:
    """Evaluate each table's measures in one pass each; tables that aren't there are left out.  Writes the results as
    Parquet by table, and raises ValueError where a table's mean score is below ``least``."""
    found = {name: report.evaluate(tables[name], list(ms)) for name, ms in measures.items() if name in tables}
    if path:
        report.write_report(found, spark, path)
    for name, results in found.items():
        scores = [r.score for r in results if r.score is not None]
        if least is not None and scores and sum(scores) / len(scores) < least:
            raise ValueError(f"quality of {name} is {sum(scores) / len(scores):.3f}, below {least}")
    return found
