"""Schemas of bronze and silver orders, as DDL."""

from __future__ import annotations

from pyspark.sql.types import StructType

# Names and types of the layers' columns.
BRONZE_ORDERS = "order_id string, customer_id string, order_date timestamp, product_id string, quantity int, unit_price decimal(10,2), discount decimal(5,2), status string, created_at timestamp, updated_at timestamp"
SILVER_ORDERS = "order_id string, customer_id string, order_date timestamp, product_id string, quantity int, unit_price decimal(10,2), discount decimal(5,2), total_amount decimal(12,2), status string, processed_at timestamp"


def struct(ddl: str) -> StructType:
    return StructType.fromDDL(ddl)
