"""Customer views."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ...functions.measures import dec, ratio
from ...operators.ranking import Order, first_tile, percentile_cont
from ...session import stage_table
from ..warehouse import Warehouse
from ._common import dated, known_customers

# Segment labels.
HIGH_HIGH = "High Frequency and High AOV"
LOW_HIGH = "Low Frequency and High AOV"
HIGH_LOW = "High Frequency and Low AOV"
LOW_LOW = "Low Frequency and Low AOV"


def revenue_summary(wh: Warehouse) -> DataFrame:
    """V18"""
    return (known_customers(wh.fact_sales).groupBy("customer_id")
            .agg(F.sum("revenue").alias("total_customer_revenue")))


def order_counts(wh: Warehouse) -> DataFrame:
    """V19"""
    return (known_customers(wh.fact_sales).groupBy("customer_id")
            .agg(F.count_distinct("invoice_no").alias("number_of_orders")))


def average_order_value(wh: Warehouse) -> DataFrame:
    """V20"""
    return (known_customers(wh.fact_sales).groupBy("customer_id")
            .agg(F.sum("revenue").alias("r"), F.count_distinct("invoice_no").alias("n"))
            .select("customer_id", ratio(F.col("r"), dec("n")).alias("average_order_value")))


def _customer_metrics(wh: Warehouse) -> DataFrame:
    """Revenue, distinct orders and distinct active months (date_key div 100)."""
    month = F.expr("date_key div 100").alias("m")
    orders = (known_customers(wh.fact_sales).select("customer_id", "invoice_no", "date_key", "revenue")
              .groupBy("customer_id", "invoice_no", "date_key").agg(F.sum("revenue").alias("r")))
    # Lines become orders before the dates are joined.
    f = dated(orders, wh).select("customer_id", "invoice_no", month, "r")
    return (f.groupBy("customer_id")
            .agg(F.sum("r").cast("decimal(22,2)").alias("total_revenue"),
                 F.count_distinct("invoice_no").alias("total_orders"),
                 F.count_distinct("m").alias("active_months")))


def purchase_frequency(wh: Warehouse) -> DataFrame:
    """V21"""
    return _customer_metrics(wh).select(
        "customer_id", "total_orders", "active_months",
        ratio(dec("total_orders"), dec("active_months")).alias("monthly_purchase_frequency"))


def revenue_concentration(wh: Warehouse, tiles: int = 10) -> DataFrame:
    """Revenue share of the first NTILE(10) by revenue (exact, distributed)."""
    per = stage_table(revenue_summary(wh), "customer-revenue")
    order = [Order("total_customer_revenue", descending=True, nulls_first=True), Order("customer_id")]
    top = F.when(first_tile(per, order, per.count(), tiles), F.col("total_customer_revenue")).otherwise(F.lit(0))
    s = per.agg(F.sum(top).alias("top"), F.sum("total_customer_revenue").alias("total"))
    return s.select(F.round("top", 2).alias("top_10_percent_revenue"),
                    F.round("total", 2).alias("grand_total_revenue"),
                    ratio(F.col("top"), F.col("total"), 2, pct=True).alias("percentage_of_total_revenue"))


def monthly_order_averages(wh: Warehouse) -> DataFrame:
    """Orders, active customers and their ratio per year-month."""
    return (dated(known_customers(wh.fact_sales), wh, "year", "month", "month_name")
            .groupBy("year", "month", "month_name")
            .agg(F.count_distinct("invoice_no").alias("total_orders"),
                 F.count_distinct("customer_id").alias("active_customers"))
            .select("year", "month_name", "total_orders", "active_customers",
                    ratio(dec("total_orders"), dec("active_customers")).alias("avg_order_per_customer")))


def rfm_segments(wh: Warehouse, keep_revenue: bool = False) -> DataFrame:
    """Frequency and AOV against their exact medians; ties go low.
    ``keep_revenue`` keeps total_revenue (the export sorts by it)."""
    m = _customer_metrics(wh).select(
        "customer_id", "total_revenue",
        ratio(dec("total_orders"), dec("active_months")).alias("purchase_frequency"),
        ratio(F.col("total_revenue"), dec("total_orders")).alias("average_order_value"))
    m = stage_table(m, "customer-metrics")  # read twice by the medians, once by the labels
    med_f = percentile_cont(m, "purchase_frequency", 0.5, ["customer_id"])
    med_a = percentile_cont(m, "average_order_value", 0.5, ["customer_id"])
    f = F.col("purchase_frequency").cast("double")
    a = F.col("average_order_value").cast("double")
    hf, ha = f > F.lit(med_f), a > F.lit(med_a)
    lf, la = f <= F.lit(med_f), a <= F.lit(med_a)
    seg = (F.when(hf & ha, F.lit(HIGH_HIGH))
           .when(lf & ha, F.lit(LOW_HIGH))
           .when(hf & la, F.lit(HIGH_LOW))
           .otherwise(F.lit(LOW_LOW)))
    extra = ["total_revenue"] if keep_revenue else []
    return m.select("customer_id", "purchase_frequency", "average_order_value",
                    seg.alias("customer_segment"), *extra)
