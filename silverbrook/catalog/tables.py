"""Tables of a scale-factor folder, the sales view over them, and helpers for registered queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DecimalType

Entry = tuple[Callable[["Tables"], DataFrame], str | None]


class Tables:
    """``t.orders`` reads ``orders.parquet``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles, for comparison with other engines."""
    kinds = {f.name: F.col(f.name).cast("double") for f in df.schema if isinstance(f.dataType, DecimalType)}
    return df.withColumns(kinds) if kinds else df


# What the source's status letters stand for.
STATUS = {"F": "delivered", "O": "pending", "P": "cancelled"}
MONEY = "decimal(12,2)"


def sales_orders(t: Tables) -> DataFrame:
    """Order lines under the names of the sales model.  Money is decimal; unit prices are whole cents."""
    status = F.when(F.col("o_orderstatus") == "F", STATUS["F"]).when(F.col("o_orderstatus") == "O", STATUS["O"]).otherwise(STATUS["P"])
    cents = F.round(F.col("l_extendedprice") * 100).cast("long")
    cent = F.lit("0.01").cast("decimal(3,2)")
    return (
        t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .withColumn("_unit", F.floor(cents / F.col("l_quantity").cast("long")).cast("long"))
        .select(
            F.col("l_orderkey").alias("order_id"),
            F.col("o_custkey").alias("customer_id"),
            F.col("l_partkey").alias("product_id"),
            F.col("l_suppkey").alias("supplier_id"),
            F.col("l_linenumber").alias("line"),
            F.col("o_orderdate").alias("order_date"),
            F.col("l_shipdate").alias("delivery_date"),
            F.col("l_quantity").cast("int").alias("quantity"),
            (F.col("_unit") * cent).cast(MONEY).alias("unit_price"),
            (F.floor(F.col("_unit") * 3 / 5).cast("long") * cent).cast(MONEY).alias("cost_price"),
            F.round(F.col("l_discount") * 100).cast("int").cast("decimal(5,2)").alias("discount_percent"),
            (cents * cent).cast(MONEY).alias("subtotal"),
            status.alias("order_status"),
        )
    )


def sales_customers(t: Tables) -> DataFrame:
    country = t.nation.select(F.col("n_nationkey"), F.col("n_name"))
    return t.customer.join(F.broadcast(country), F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("segment"),
        F.col("n_name").alias("country"),
        F.when(F.col("c_acctbal") > 5000, "Y").otherwise("N").alias("is_vip"),
        F.round(F.col("c_acctbal") * 100).cast("long").alias("balance_cents"),
    )


def sales_products(t: Tables) -> DataFrame:
    return t.part.select(F.col("p_partkey").alias("product_id"), F.col("p_name").alias("name"), F.col("p_type").alias("category"), F.col("p_brand").alias("brand"), F.round(F.col("p_retailprice"), 2).cast(MONEY).alias("unit_price"))


#: The view as DuckDB SQL; money is in cents there and becomes a double at the end.
SALES_SQL = """
sales0 AS (
  SELECT l_orderkey AS order_id, o_custkey AS customer_id, l_partkey AS product_id, l_suppkey AS supplier_id, l_linenumber AS line,
    o_orderdate AS order_date, l_shipdate AS delivery_date, CAST(l_quantity AS INTEGER) AS quantity,
    CAST(round(l_extendedprice * 100) AS BIGINT) AS subtotal_c, CAST(round(l_discount * 100) AS BIGINT) AS discount_p,
    CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'pending' ELSE 'cancelled' END AS order_status
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
sales1 AS (SELECT *, subtotal_c // quantity AS unit_c FROM sales0),
sales AS (
  SELECT s.*, unit_c * 3 // 5 AS cost_c, (2 * subtotal_c * discount_p + 100) // 200 AS discount_c,
    c_name AS customer_name, c_mktsegment AS customer_segment, n_name AS customer_country,
    CASE WHEN c_acctbal > 5000 THEN 'Y' ELSE 'N' END AS is_vip_customer, CAST(round(c_acctbal * 100) AS BIGINT) AS balance_c,
    p_name AS product_name, p_type AS product_category, p_brand AS product_brand, CAST(round(p_retailprice * 100) AS BIGINT) AS product_c
  FROM sales1 s LEFT JOIN customer ON customer_id = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN part ON product_id = p_partkey),
taxed0 AS (
  SELECT *, CASE WHEN customer_country = 'FRANCE' THEN 2000 WHEN customer_country = 'UNITED STATES' THEN 1000 WHEN customer_country = 'GERMANY' THEN 1900 ELSE 2000 END AS rate FROM sales),
taxed AS (
  SELECT *, (2 * subtotal_c * rate + 10000) // 20000 AS tax_c, subtotal_c + (2 * subtotal_c * rate + 10000) // 20000 AS total_c,
    CASE WHEN unit_c > 0 THEN (2 * (unit_c - cost_c) * 10000 + unit_c) // (2 * unit_c) ELSE 0 END AS margin_c FROM taxed0),
enriched AS (
  SELECT *, CASE WHEN total_c >= 5000000 THEN 'Y' ELSE 'N' END AS is_high_value_order,
    row_number() OVER (PARTITION BY customer_id ORDER BY order_date, order_id, line, product_id, supplier_id, subtotal_c, delivery_date, quantity, discount_p) AS customer_order_number FROM taxed)
"""

#: Half-up mean of cents, as a double.
MEAN_SQL = "CAST((2 * sum({0}) + count({0})) // (2 * count({0})) AS DOUBLE) / 100"


def mean_sql(column: str) -> str:
    return MEAN_SQL.format(column)


def money_sql(expression: str) -> str:
    return f"CAST({expression} AS DOUBLE) / 100"
