"""Gold kept up to date by a stream of silver order lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from silverbrook.operators.aggregate import conditional_count
from silverbrook.plans.pipeline import Operator
from silverbrook.streaming.kafka import start
from silverbrook.streaming.sinks import UpsertFolder

_SUMS = ("orders", "revenue", "discount", "tax", "priced", "items", "high_value", "cancelled", "margin", "with_margin", "vip")


def customer_days() -> Operator:
    """Sums of each day and customer: what daily sales need that can be added up, and a row a customer to count.  The day is
    ``report_date`` where the lines have that column, which may carry a watermark."""

    def run(df: DataFrame) -> DataFrame:
        yes = lambda c: conditional_count(F.col(c) == "Y")
        day = "report_date" if "report_date" in df.columns else F.to_date("order_date").alias("report_date")
        return df.groupBy(day, "customer_id").agg(
            F.count("order_id").alias("orders"),
            F.sum("total_amount").alias("revenue"),
            F.sum("discount_amount").alias("discount"),
            F.sum("tax_amount").alias("tax"),
            F.count("total_amount").alias("priced"),
            F.sum("quantity").alias("items"),
            yes("is_high_value_order").alias("high_value"),
            conditional_count("order_status = 'cancelled'").alias("cancelled"),
            F.sum("margin_percent").alias("margin"),
            F.count("margin_percent").alias("with_margin"),
            yes("is_vip_customer").alias("vip"),
        )

    return run


def daily_from_customer_days(parts: bool = False) -> Operator:
    """The columns of :func:`silverbrook.sales.gold.daily_sales`, from customers' days.  With ``parts`` one may come in several rows, which
    add up: sums go by the day alone, and only the pairs of day and customer are shuffled, to be counted once."""

    def run(df: DataFrame) -> DataFrame:
        people, sums = F.count("customer_id").alias("unique_customers"), [F.sum(c).alias(c) for c in _SUMS]
        if parts:
            pairs = df.select(F.col("report_date").alias("_day"), "customer_id").distinct().groupBy("_day").agg(people)
            days = df.groupBy("report_date").agg(*sums).join(pairs, F.col("report_date").eqNullSafe(F.col("_day")))
        else:
            days = df.groupBy("report_date").agg(people, *sums)
        mean = lambda total, n: F.round(F.try_divide(F.col(total), F.col(n)), 2)
        return days.select(
            "report_date",
            F.col("orders").alias("total_orders"),
            F.col("revenue").alias("total_revenue"),
            F.col("discount").alias("total_discount_given"),
            F.col("tax").alias("total_tax"),
            mean("revenue", "priced").alias("average_order_value"),
            "unique_customers",
            F.col("items").alias("total_items_sold"),
            F.col("high_value").alias("high_value_orders_count"),
            F.col("cancelled").alias("cancelled_orders_count"),
            mean("margin", "with_margin").alias("average_margin_percent"),
            F.col("vip").alias("vip_orders_count"),
        )

    return run


class DailySalesStream:
    """Daily sales from a stream of silver lines.  Each batch writes the sums of its own lines by customer and day to a folder named by its
    number, which it overwrites when it is played again, so nothing counts twice; readers add up all batches.  The stream keeps
    no state, which would hold every customer's days for good.  With ``late`` days are closed, and lines that come after that are left
    out: then state holds the days that are open, and a batch writes those that it has changed, whole."""

    def __init__(self, path: str, late: str | None = None):
        self.table, self.late = UpsertFolder(path, ("report_date", "customer_id")), late

    def _add(self, lines: DataFrame, number: int) -> None:
        lines.transform(customer_days()).write.mode("overwrite").parquet(f"{self.table.path}/batch={number}")

    def start(self, lines: DataFrame, checkpoint: str, every: str | None = None) -> StreamingQuery:
        if not self.late:
            return start(lines.writeStream.foreachBatch(self._add), checkpoint, "append", every)
        # the grouping column itself must carry the watermark, or no day is ever closed
        lines = lines.withColumn("report_date", F.to_date("order_date").cast("timestamp")).withWatermark("report_date", self.late)
        days = lines.transform(customer_days()).withColumn("report_date", F.to_date("report_date"))
        return self.table.start(days, checkpoint, "update", every)

    def read(self, spark: SparkSession) -> DataFrame:
        days = self.table.read(spark) if self.late else spark.read.parquet(self.table.path)
        return days.transform(daily_from_customer_days(parts=not self.late))
