"""Adjustment (V40-V42), non-sales (V43-V44) and data-quality (V45-V49) views."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ...functions.measures import dec, period_change, ratio, with_period
from ..warehouse import Warehouse
from ._common import dated, with_description


# --- adjustment -------------------------------------------------------------

def adjustment_frequency(wh: Warehouse) -> DataFrame:
    """V40"""
    return (dated(wh.fact_adjustment, wh, "year", "month").groupBy("year", "month")
            .agg(F.count(F.lit(1)).alias("adjustment_count")))


def adjustment_by_description(wh: Warehouse) -> DataFrame:
    """V41"""
    per_code = wh.fact_adjustment.groupBy("stock_code").agg(F.count(F.lit(1)).alias("n"))
    return (with_description(per_code, wh).groupBy("description")
            .agg(F.sum("n").alias("adjustment_count")))


def adjustment_trend(wh: Warehouse) -> DataFrame:
    """Monthly count, previous month present, MoM %."""
    monthly = (dated(wh.fact_adjustment, wh, "year", "month", "month_name")
               .groupBy("year", "month", "month_name")
               .agg(F.count(F.lit(1)).alias("adjustment_count")))
    out = with_period(period_change(monthly, "adjustment_count", "previous_month_adjustments",
                                    "mom_growth_percentage"))
    return out.select("year", "month", "adjustment_count", "previous_month_adjustments",
                      "mom_growth_percentage", "month_name", "year_month_sort", "month_year_label")


# --- non-sales --------------------------------------------------------------

def transaction_mix(wh: Warehouse) -> DataFrame:
    """V43"""
    return wh.fact_non_sale.groupBy("transaction_type").agg(F.count(F.lit(1)).alias("transaction_count"))


def transaction_trends(wh: Warehouse) -> DataFrame:
    """V44"""
    agg = (dated(wh.fact_non_sale, wh, "year", "month", "month_name")
           .groupBy("year", "month", "month_name", "transaction_type")
           .agg(F.count(F.lit(1)).alias("volume")))
    return with_period(agg).select("year", "month", "month_name", "transaction_type", "volume",
                                   "year_month_sort", "month_year_label")


# --- data quality -----------------------------------------------------------

def duplicate_count(wh: Warehouse) -> DataFrame:
    """V45"""
    return wh.data_quality_potential_duplicates.agg(
        F.count(F.lit(1)).alias("potential_duplicate_transactions"))


def duplicate_groups(wh: Warehouse) -> DataFrame:
    """Distinct invoices with potential duplicates (not clusters)."""
    return wh.data_quality_potential_duplicates.agg(
        F.count_distinct("invoice_no").alias("potential_duplicate_groups"))


def duplicate_clusters(wh: Warehouse) -> DataFrame:
    """Optional beside V46: the number of (invoice, code, quantity) clusters."""
    return (wh.data_quality_potential_duplicates
            .select("invoice_no", "stock_code", "quantity").distinct()
            .agg(F.count(F.lit(1)).alias("potential_duplicate_clusters")))


def duplicate_percentage(wh: Warehouse) -> DataFrame:
    """Audit rows / sales fact rows x 100 (one aggregate over a tagged union)."""
    tagged = (wh.fact_sales.select(F.lit(1).alias("_s"), F.lit(0).alias("_d"))
              .unionByName(wh.data_quality_potential_duplicates.select(
                  F.lit(0).alias("_s"), F.lit(1).alias("_d"))))
    c = tagged.agg(F.sum("_s").cast("long").alias("total_records"),
                   F.sum("_d").cast("long").alias("duplicate_records"))
    return c.select("total_records", "duplicate_records",
                    ratio(dec("duplicate_records"), dec("total_records"), 2, pct=True)
                    .alias("percentage_of_potential_duplicates"))


def issue_mix(wh: Warehouse) -> DataFrame:
    """V48"""
    return wh.data_quality_potential_duplicates.groupBy("issue_type").agg(
        F.count(F.lit(1)).alias("number_of_issues"))


def duplicate_cluster_sizes(wh: Warehouse) -> DataFrame:
    """Rows per cluster size, ordered (the one view with ORDER BY)."""
    return (wh.data_quality_potential_duplicates.groupBy("duplicate_group_count")
            .agg(F.count(F.lit(1)).alias("number_of_rows"))
            .orderBy(F.col("duplicate_group_count").asc_nulls_last()))
