"""Product views.

Facts are aggregated by stock code first (partial + final hash aggregate),
then joined to the product dimension (one row per code on both sides), then
re-aggregated by description where the view groups by description. Sums
regroup exactly; distinct counts keep the invoice in the first key.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ...functions.measures import before_after, dec, ratio
from ...operators.basket import basket_pairs
from ...operators.ranking import Order, first_tile, top_k_share
from ...session import stage_table
from ..warehouse import Warehouse
from ._common import dated, with_description


def _by_code(wh: Warehouse, **aggs) -> DataFrame:
    return wh.fact_sales.groupBy("stock_code").agg(*[a.alias(n) for n, a in aggs.items()])


def sales_summary(wh: Warehouse) -> DataFrame:
    """V6: per code and description; LEFT join keeps codes without a product."""
    agg = _by_code(wh, total_sales_revenue=F.sum("revenue"), total_quantity_sold=F.sum("quantity"),
                   total_number_transactions=F.count("invoice_no"))
    return with_description(agg, wh, "left").select(
        "stock_code", "description", "total_sales_revenue", "total_quantity_sold",
        "total_number_transactions")


def top_product_by_quantity(wh: Warehouse) -> DataFrame:
    """V16 (export-only query)."""
    agg = _by_code(wh, total_quantity_sold=F.sum("quantity"))
    return with_description(agg, wh, "left").select("stock_code", "description", "total_quantity_sold")


def top_product_by_transactions(wh: Warehouse) -> DataFrame:
    """V17 (export-only query)."""
    agg = _by_code(wh, total_number_of_transactions=F.count(F.lit(1)))
    return with_description(agg, wh, "left").select("stock_code", "description",
                                                    "total_number_of_transactions")


def frequent_low_revenue_per_purchase(wh: Warehouse) -> DataFrame:
    """V7: per product: distinct invoices, revenue per invoice, revenue (no filter)."""
    agg = _by_code(wh, purchase_frequency=F.count_distinct("invoice_no"), total_revenue=F.sum("revenue"))
    return with_description(agg, wh).select(
        "description", "purchase_frequency",
        ratio(F.col("total_revenue"), dec("purchase_frequency")).alias("revenue_per_purchase"),
        F.round("total_revenue", 2).alias("total_revenue"))


def _code_volume_revenue(wh: Warehouse) -> DataFrame:
    agg = _by_code(wh, total_volume=F.sum("quantity"), total_revenue=F.sum("revenue"))
    return with_description(agg, wh)


def high_revenue_low_volume_manual(wh: Warehouse, max_volume: int = 56,
                                   min_revenue: str = "2220.02") -> DataFrame:
    """V8: products with volume <= max_volume and revenue >= min_revenue."""
    return (_code_volume_revenue(wh)
            .filter((F.col("total_volume") <= max_volume)
                    & (F.col("total_revenue") >= F.lit(Decimal(min_revenue))))
            .select("description", "total_volume", F.round("total_revenue", 2).alias("total_revenue")))


def _by_description(wh: Warehouse) -> DataFrame:
    """Volume and revenue per description (codes sharing one merge)."""
    return (_code_volume_revenue(wh).groupBy("description")
            .agg(F.sum("total_volume").alias("total_volume"),
                 F.sum("total_revenue").alias("total_revenue")))


def _quadrant(wh: Warehouse, volume_desc: bool, k: int = 4) -> DataFrame:
    # Cut twice (by volume, by revenue): aggregate the facts once.
    stats = stage_table(_by_description(wh), "description-totals")
    n = stats.count()
    high_first, low_first = {"descending": True, "nulls_first": True}, {}
    volume = first_tile(stats, [Order("total_volume", **(high_first if volume_desc else low_first)), Order("description")], n, k)
    revenue = first_tile(stats, [Order("total_revenue", **(low_first if volume_desc else high_first)), Order("description")], n, k)
    return stats.filter(volume & revenue).select("description", "total_volume", "total_revenue")


def high_volume_low_revenue_quadrant(wh: Warehouse, tiles: int = 4) -> DataFrame:
    """V9: top volume quartile and bottom revenue quartile (of ``tiles``), by description."""
    return _quadrant(wh, volume_desc=True, k=tiles)


def high_revenue_low_volume_quadrant(wh: Warehouse, tiles: int = 4) -> DataFrame:
    """Bottom volume quartile and top revenue quartile (of ``tiles``), by description."""
    return _quadrant(wh, volume_desc=False, k=tiles)


def consistency_trends(wh: Warehouse) -> DataFrame:
    """Distinct active year-months and units per description."""
    per_code_month = (dated(wh.fact_sales, wh, "year", "month")
                      .groupBy("stock_code", "year", "month")
                      .agg(F.sum("quantity").alias("q")))
    return (with_description(per_code_month, wh)
            .groupBy("description")
            .agg(F.count_distinct(F.concat_ws("-", F.col("year").cast("string"),
                                              F.col("month").cast("string"))).alias("unique_months_active"),
                 F.sum("q").alias("total_units_sold")))


def sales_decline(wh: Warehouse) -> DataFrame:
    """Units up to the midpoint day vs after it; declining products.

    The midpoint (min + (max - min) div 2 days) is a scalar subquery.
    """
    days = dated(wh.fact_sales, wh, "full_date")
    bounds = days.agg(F.min("full_date").alias("lo"), F.max("full_date").alias("hi"))
    mid = bounds.select(F.date_add("lo", F.floor(F.datediff("hi", "lo") / 2).cast("int"))).scalar()
    per_code_day = days.groupBy("stock_code", "full_date").agg(F.sum("quantity").alias("q"))
    first, second = before_after(F.col("q"), F.col("full_date"), mid)
    split = per_code_day.select("stock_code", first.alias("a"), second.alias("b"))
    per_desc = (with_description(split.groupBy("stock_code").agg(F.sum("a").alias("a"), F.sum("b").alias("b")), wh)
                .groupBy("description")
                .agg(F.sum("a").alias("first_half_sales"), F.sum("b").alias("second_half_sales")))
    return (per_desc.filter((F.col("second_half_sales") < F.col("first_half_sales"))
                            & (F.col("first_half_sales") > 0))
            .select("description", "first_half_sales", "second_half_sales",
                    (F.col("first_half_sales") - F.col("second_half_sales")).alias("sales_drop")))


def top_product_by_avg_price(wh: Warehouse) -> DataFrame:
    """Revenue / units per description."""
    return _by_description(wh).select(
        "description", ratio(F.col("total_revenue"), dec("total_volume")).alias("avg_selling_price"))


def top_10_revenue_concentration(wh: Warehouse, k: int = 10) -> DataFrame:
    """Share of revenue of the k largest descriptions (top-k, not a global sort)."""
    per_desc = _by_description(wh)
    s = top_k_share(per_desc, "total_revenue", k)
    return s.select(
        F.round("top_sum", 2).alias("top_10_product_revenue"),
        F.round("total", 2).alias("grand_total_revenue"),
        ratio(F.col("top_sum"), F.col("total"), 2, pct=True).alias("percentage_of_total_revenue"))


def affinity_pairs(wh: Warehouse, max_items: int = 100, min_support: int = 20) -> DataFrame:
    """Description pairs bought together (R2)."""
    return basket_pairs(wh.fact_sales, wh.dim_product, max_items=max_items, min_support=min_support)
