"""The monthly roll-up as a stream: order lines arrive, days are emitted once the watermark has passed their end, and added to their months."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def monthly_stream(lines: DataFrame, product: str, date: str, quantity: str, late: str = "31 days") -> DataFrame:
    """(product, month_end, quantity) of a streaming frame, a row per closed day. State is a sum per product and open day; later lines than ``late`` are left out."""
    timed = lines.select(F.col(product).alias("product"), F.col(date).cast("timestamp").alias("at"), F.col(quantity).alias("quantity")).withWatermark("at", late)
    # Months differ in length, so they are grouped by windows of a day first, and by month end in ``merge_months``.
    days = timed.groupBy("product", F.window("at", "1 day").alias("day")).agg(F.sum("quantity").alias("quantity"))
    return days.select("product", F.last_day(F.col("day.start").cast("date")).alias("month_end"), "quantity")


def merge_months(so_far: DataFrame, closed_days: DataFrame) -> DataFrame:
    """Monthly sums with a batch of closed days added; for ``foreachBatch``."""
    return so_far.unionByName(closed_days).groupBy("product", "month_end").agg(F.sum("quantity").alias("quantity"))
