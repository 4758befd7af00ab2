"""Cancellation views (V33-V39). Both sides are aggregated before they are
joined, so a join never multiplies fact rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ...functions.measures import dec, with_period
from ...operators.ranking import Order, first_tile
from ...session import stage_table
from ..warehouse import Warehouse
from ._common import dated, with_country, with_description


def _rate(cancels: str, sales: str) -> F.Column:
    """ROUND(cancels / NULLIF(sales + cancels, 0) * 100, 2) in decimals."""
    c, s = dec(cancels), dec(sales)
    return F.round(c / F.nullif(s + c, F.lit(0)) * F.lit(100), 2)


def products_by_orders(wh: Warehouse) -> DataFrame:
    """Distinct cancelled invoices per description."""
    pairs = wh.fact_cancellations.select("stock_code", "invoice_no").distinct()
    return (with_description(pairs, wh).groupBy("description")
            .agg(F.count_distinct("invoice_no").alias("cancelled_orders")))


def global_rate(wh: Warehouse) -> DataFrame:
    """Distinct sales and cancelled invoices and the cancelled share.
    Both counts come from one aggregate over a tagged union (no subqueries
    evaluated twice, no cross join)."""
    tagged = (wh.fact_sales.select(F.lit(True).alias("_s"), "invoice_no")
              .unionByName(wh.fact_cancellations.select(F.lit(False).alias("_s"), "invoice_no")))
    # One distinct count per tag (nothing is expanded), then two rows become columns.
    per_tag = tagged.groupBy("_s").agg(F.count_distinct("invoice_no").alias("n"))
    of = lambda tag: F.coalesce(F.max(F.when(F.col("_s") == tag, F.col("n"))), F.lit(0)).cast("long")
    counts = per_tag.agg(of(True).alias("total_sales_orders"), of(False).alias("total_cancelled_orders"))
    return counts.select("total_sales_orders", "total_cancelled_orders",
                         _rate("total_cancelled_orders", "total_sales_orders").alias("cancellation_percentage"))


def products_by_volume(wh: Warehouse) -> DataFrame:
    """Cancelled units per description (LEFT join)."""
    per_code = wh.fact_cancellations.groupBy("stock_code").agg(F.sum("quantity").alias("q"))
    return (with_description(per_code, wh, "left").groupBy("description")
            .agg(F.sum("q").alias("cancelled_total")))


def rates_by_country(wh: Warehouse) -> DataFrame:
    """Driven from the sales side; countries with no cancellations get 0."""
    us = wh.fact_sales.groupBy("country_key").agg(F.count_distinct("invoice_no").alias("total_sales"))
    uc = wh.fact_cancellations.groupBy("country_key").agg(
        F.count_distinct("invoice_no").alias("_c"))
    j = us.join(uc, us["country_key"] == uc["country_key"], "left").select(
        us["country_key"], "total_sales", F.coalesce("_c", F.lit(0)).alias("total_cancels"))
    return with_country(j, wh, "left").select(
        "country", "total_sales", "total_cancels",
        _rate("total_cancels", "total_sales").alias("cancellation_rate"))


def _product_sales_and_cancels(wh: Warehouse) -> DataFrame:
    ps = with_description(
        wh.fact_sales.groupBy("stock_code").agg(F.sum("quantity").alias("total_sold"),
                                                F.sum("revenue").alias("total_revenue")), wh)
    pc = wh.fact_cancellations.groupBy("stock_code").agg(F.sum("quantity").alias("_c"))
    return (ps.join(pc, "stock_code", "left")
            .withColumn("total_cancelled", F.coalesce("_c", F.lit(0)).cast("long")).drop("_c"))


def rates_by_product(wh: Warehouse, min_sold: int = 50) -> DataFrame:
    """Unit cancellation rate of products with more than ``min_sold`` units sold."""
    return (_product_sales_and_cancels(wh).filter(F.col("total_sold") > min_sold)
            .select("description", "total_sold", "total_cancelled",
                    _rate("total_cancelled", "total_sold").alias("unit_cancellation_rate")))


def trends_over_time(wh: Warehouse) -> DataFrame:
    """Monthly sales and cancelled invoices; months with only
    cancellations drop out (LEFT join from sales)."""
    ms = (dated(wh.fact_sales, wh, "year", "month", "month_name")
          .groupBy("year", "month", "month_name")
          .agg(F.count_distinct("invoice_no").alias("sales_count")))
    mc = (dated(wh.fact_cancellations, wh, "year", "month")
          .groupBy("year", "month").agg(F.count_distinct("invoice_no").alias("_c")))
    j = ms.join(mc, ["year", "month"], "left").withColumn("cancels_count", F.coalesce("_c", F.lit(0)))
    return with_period(j).select(
        "year", "month_name", "sales_count", "cancels_count",
        _rate("cancels_count", "sales_count").alias("cancellation_rate"),
        "month", "year_month_sort", "month_year_label")


def high_revenue_risk_matrix(wh: Warehouse, tiles: int = 4) -> DataFrame:
    """Products in the first revenue quartile with their cancellation
    rate (the reference's unused second NTILE is not computed)."""
    pm = _product_sales_and_cancels(wh).withColumn(
        "cancellation_rate", _rate("total_cancelled", "total_sold"))
    pm = stage_table(pm, "product-risk")
    order = [Order("total_revenue", descending=True, nulls_first=True), Order("stock_code")]
    return (pm.filter(first_tile(pm, order, pm.count(), tiles))
            .select("description", "total_revenue", "total_sold", "total_cancelled", "cancellation_rate"))
