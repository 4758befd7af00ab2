"""Geographic views (V25-V32). Facts are aggregated by country_key, then
named through the (broadcast, country-bounded) country dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ...functions.measures import dec, ratio
from ..warehouse import Warehouse
from ._common import dated, with_country


def _per_country(wh: Warehouse) -> DataFrame:
    return (wh.fact_sales.groupBy("country_key")
            .agg(F.sum("revenue").alias("total_revenue"),
                 F.count_distinct("invoice_no").alias("order_volume")))


def revenue(wh: Warehouse) -> DataFrame:
    """V25"""
    agg = wh.fact_sales.groupBy("country_key").agg(F.sum("revenue").alias("total_revenue"))
    return with_country(agg, wh).select("country", "total_revenue")


def order_volumes(wh: Warehouse) -> DataFrame:
    """V26"""
    agg = wh.fact_sales.groupBy("country_key").agg(F.count_distinct("invoice_no").alias("order_volume"))
    return with_country(agg, wh).select("country", "order_volume")


def _aov(wh: Warehouse) -> DataFrame:
    return with_country(_per_country(wh), wh).withColumn(
        "average_order_value", ratio(F.col("total_revenue"), dec("order_volume")))


def high_aov(wh: Warehouse, min_orders: int = 10) -> DataFrame:
    """AOV of countries with at least ``min_orders`` orders."""
    return _aov(wh).filter(F.col("order_volume") >= min_orders).select("country", "average_order_value")


def high_volume_low_aov(wh: Warehouse, min_orders: int = 50) -> DataFrame:
    """Orders and AOV where orders > ``min_orders`` (no AOV filter)."""
    return _aov(wh).filter(F.col("order_volume") > min_orders) \
        .select("country", "order_volume", "average_order_value")


def low_volume_high_aov(wh: Warehouse, lo: int = 10, hi: int = 50) -> DataFrame:
    """Orders and AOV where orders BETWEEN lo AND hi."""
    return _aov(wh).filter(F.col("order_volume").between(lo, hi)) \
        .select("country", "order_volume", "average_order_value")


def revenue_share(wh: Warehouse) -> DataFrame:
    """% of total sales revenue per country. The total is rolled up from
    the per-country sums (null country key included, like the reference's
    total over all sales) by a window over that aggregate: at most one row
    per country, and the facts are scanned once."""
    per_key = wh.fact_sales.groupBy("country_key").agg(F.sum("revenue").alias("r"))
    with_total = per_key.withColumn("_t", F.sum("r").over(Window.partitionBy()))
    return with_country(with_total, wh).select(
        "country", F.round(F.col("r") / F.col("_t") * F.lit(100), 2).alias("percentage"))


def revenue_per_customer(wh: Warehouse, min_customers: int = 10) -> DataFrame:
    """Revenue (null-customer rows included), distinct customers, ratio."""
    agg = (wh.fact_sales.groupBy("country_key")
           .agg(F.sum("revenue").alias("total_revenue"),
                F.count_distinct("customer_id").alias("number_of_customers")))
    return (with_country(agg, wh).filter(F.col("number_of_customers") > min_customers)
            .select("country", "total_revenue", "number_of_customers",
                    ratio(F.col("total_revenue"), dec("number_of_customers")).alias("revenue_per_customer")))


def growth_trends(wh: Warehouse) -> DataFrame:
    """Average of the rounded month-over-month % per country, months up
    and down. LAG runs per country over the months present (no gap filling)."""
    timeline = (dated(wh.fact_sales, wh, "year", "month")
                .groupBy("country_key", "year", "month")
                .agg(F.sum("revenue").alias("current_revenue")))
    timeline = with_country(timeline, wh)
    in_order = Window.partitionBy("country").orderBy("year", "month")
    g = timeline.withColumn("previous_revenue", F.lag("current_revenue").over(in_order))
    # ((cur - prev) / prev) * 100: division first, as written in the view.
    growth = F.round((F.col("current_revenue") - F.col("previous_revenue"))
                     / F.nullif(F.col("previous_revenue"), F.lit(0)) * F.lit(100), 2)
    monthly = g.filter(F.col("previous_revenue").isNotNull()).withColumn("growth_percentage", growth)
    return (monthly.groupBy("country")
            .agg(F.round(F.avg("growth_percentage"), 2).alias("avg_monthly_growth_rate"),
                 F.count(F.when(F.col("growth_percentage") > 0, F.lit(1))).alias("months_of_growth"),
                 F.count(F.when(F.col("growth_percentage") < 0, F.lit(1))).alias("months_of_decline")))
