"""Silver: enrichment of order lines.  Each function returns an operator."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window, functions as F

from silverbrook.functions.columns import flag
from silverbrook.operators.joins import lookup
from silverbrook.plans.pipeline import Operator

# The tax rate used for a country without its own, and thresholds and margins by environment.
DEFAULT_TAX_RATE = Decimal("0.20")
HIGH_VALUE = {"dev": 100, "staging": 400, "prod": 500}
DEFAULT_MARGIN = {"dev": 25, "staging": 30, "prod": 35}
# What an order's status means for payment and for fulfilment.
PAYMENT_OF = {"cancelled": "cancelled", "pending": "pending", "processing": "pending", "delivered": "completed"}
FULFILMENT_OF = {"pending": "pending", "confirmed": "processing", "shipped": "in_transit", "delivered": "delivered", "cancelled": "cancelled"}


def _mapped(column: Column, values: Mapping[str, str], otherwise: str) -> Column:
    out = F.when(F.lit(False), otherwise)
    for k, v in values.items():
        out = out.when(column == k, v)
    return out.otherwise(otherwise)


def enrich_orders(customers: DataFrame | None = None, products: DataFrame | None = None, more: Sequence[str] = ()) -> Operator:
    """Add customer_name, customer_segment, customer_country, is_vip_customer, product_name, product_category,
    product_brand and product_price; a side that isn't given has nulls, N and the order's own price.  ``more`` names further
    columns of the customers that come along in the same lookup."""

    def run(df: DataFrame) -> DataFrame:
        if customers is None:
            df = df.withColumns({c: F.lit(None).cast("string") for c in ("customer_name", "customer_segment", "customer_country")} | {"is_vip_customer": F.lit("N")})
        else:
            side = customers.select("customer_id", F.col("name").alias("customer_name"), F.col("segment").alias("customer_segment"), F.col("country").alias("customer_country"), F.col("is_vip").alias("is_vip_customer"), *more)
            df = df.transform(lookup(side, "customer_id"))
        if products is None:
            return df.withColumns({c: F.lit(None).cast("string") for c in ("product_name", "product_category", "product_brand")} | {"product_price": F.col("unit_price")})
        side = products.select("product_id", F.col("name").alias("product_name"), F.col("category").alias("product_category"), F.col("brand").alias("product_brand"), F.col("unit_price").alias("product_price"))
        return df.transform(lookup(side, "product_id"))

    return run


def margin_percent(cost: str = "cost_price", price: str = "unit_price", default: float = 30.0) -> Operator:
    """(price - cost) / price in percent, 0 where the price isn't positive or a value is missing; a constant without a
    cost column."""

    def run(df: DataFrame) -> DataFrame:
        if cost not in df.columns:
            return df.withColumn("margin_percent", F.lit(default))
        value = F.round((F.col(price) - F.col(cost)) / F.nullif(F.col(price), F.lit(0)) * 100, 2)
        return df.withColumn("margin_percent", F.when((F.col(price) > 0) & F.col(cost).isNotNull(), value).otherwise(F.lit(0)))

    return run


def high_value_orders(threshold: float = 500, column: str = "total_amount") -> Operator:
    return lambda df: df.withColumn("is_high_value_order", flag(F.col(column) >= threshold))


def repeat_orders(customer: str = "customer_id", date: str = "order_date", ties: Sequence[str] = ()) -> Operator:
    """Number each customer's orders by date, then by ``ties``; all but the first are repeats."""

    def run(df: DataFrame) -> DataFrame:
        number = F.row_number().over(Window.partitionBy(customer).orderBy(date, *ties))
        return df.withColumn("customer_order_number", number).withColumn("is_repeat_order", flag(F.col("customer_order_number") > 1))

    return run


def delivery_time(delivered: str = "delivery_date", ordered: str = "order_date") -> Operator:
    """Days from order to delivery; null without either."""
    return lambda df: df.withColumn("days_to_delivery", F.datediff(delivered, ordered) if delivered in df.columns else F.lit(None).cast("int"))


def add_tax(rates: Mapping[str, Decimal | str | float], country: str = "customer_country", subtotal: str = "subtotal") -> Operator:
    """tax_amount by the country's rate, 0 without a subtotal, and total_amount, null without one."""

    def run(df: DataFrame) -> DataFrame:
        rate = F.lit(DEFAULT_TAX_RATE).cast("decimal(5,4)")
        for name, value in rates.items():
            rate = F.when(F.col(country) == name, F.lit(str(value)).cast("decimal(5,4)")).otherwise(rate)
        tax = F.round(F.col(subtotal) * rate, 2)
        return df.withColumn("tax_amount", F.coalesce(tax, F.lit(0))).withColumn("total_amount", F.round(F.col(subtotal) + F.col("tax_amount"), 2))

    return run


def add_discount(mode: str = "percent", subtotal: str = "subtotal", discount: str = "discount_percent") -> Operator:
    """discount_amount: a percentage of the subtotal, or with ``mode="amount"`` the column itself; 0 where unknown."""
    if mode not in ("percent", "amount"):
        raise ValueError(f"mode must be percent or amount, not {mode!r}")

    def run(df: DataFrame) -> DataFrame:
        value = F.round(F.col(subtotal) * F.col(discount) / 100, 2) if mode == "percent" else F.col(discount)
        return df.withColumn("discount_amount", F.coalesce(value, F.lit(0)))

    return run


def payment_status(status: str = "order_status") -> Operator:
    return lambda df: df.withColumn("payment_status", _mapped(F.col(status), PAYMENT_OF, "unknown"))


def fulfilment_status(status: str = "order_status") -> Operator:
    return lambda df: df.withColumn("fulfillment_status", _mapped(F.col(status), FULFILMENT_OF, "unknown"))
