"""Sales and revenue views (V1-V5)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ...functions.measures import period_change, with_period
from ..warehouse import Warehouse
from ._common import dated


def total_revenue(wh: Warehouse) -> DataFrame:
    """V1"""
    return wh.fact_sales.agg(F.sum("revenue").alias("total_sales_revenue"))


def revenue_by_month(wh: Warehouse) -> DataFrame:
    """V2: per month number, years merged."""
    return (dated(wh.fact_sales, wh, "month", "month_name")
            .groupBy("month", "month_name")
            .agg(F.sum("revenue").alias("total_sales_revenue"))
            .select("month_name", "total_sales_revenue", "month"))


def revenue_by_year_n_month(wh: Warehouse) -> DataFrame:
    """V3"""
    return (dated(wh.fact_sales, wh, "year", "month", "month_name")
            .groupBy("year", "month", "month_name")
            .agg(F.sum("revenue").alias("total_sales_revenue"))
            .select("year", "month_name", "total_sales_revenue", "month"))


def revenue_trends(wh: Warehouse) -> DataFrame:
    """V4: month revenue, prior month present, MoM % (LAG over month rows)."""
    months = (dated(wh.fact_sales, wh, "year", "month", "month_name")
              .groupBy("year", "month", "month_name")
              .agg(F.sum("revenue").alias("monthly_revenue")))
    out = with_period(period_change(months, "monthly_revenue", "prior_month_revenue",
                                    "mom_growth_pct"))
    return out.select("year", "month_name", "monthly_revenue", "prior_month_revenue",
                      "mom_growth_pct", "month", "year_month_sort", "month_year_label")


def monthly_sales_performance(wh: Warehouse) -> DataFrame:
    """V5"""
    return (dated(wh.fact_sales, wh, "year", "month", "month_name")
            .groupBy("year", "month", "month_name")
            .agg(F.sum("revenue").alias("total_sales_revenue"),
                 F.count("invoice_no").alias("number_of_transactions"),
                 F.sum("quantity").alias("total_items_sold"))
            .select("year", "month_name", "total_sales_revenue", "number_of_transactions",
                    "total_items_sold", "month"))
