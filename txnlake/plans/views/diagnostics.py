"""Diagnostics the reference runs by hand against its views."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..warehouse import Warehouse
from . import cancellation as CA
from . import geographic as GE


def largest_baskets(wh: Warehouse, top: int = 5) -> DataFrame:
    """Invoices with the most distinct stock codes (a top-k report; ties
    by invoice number). ``orderBy().limit`` keeps k rows per task."""
    return (wh.fact_sales.groupBy("invoice_no")
            .agg(F.count_distinct("stock_code").alias("distinct_products"))
            .orderBy(F.col("distinct_products").desc(), F.col("invoice_no").asc())
            .limit(top))


def basket_pair_counts(wh: Warehouse, max_items: int = 100) -> DataFrame:
    """How many code pairs a self-join would emit with and without the
    basket cap: sum of n(n-1)/2 over invoices, from the basket sizes alone
    (no pair is materialized)."""
    n = F.col("n")
    sizes = wh.fact_sales.groupBy("invoice_no").agg(F.count_distinct("stock_code").alias("n"))
    pairs = (n * (n - 1) / 2).cast("long")
    return sizes.agg(
        F.count(F.lit(1)).alias("invoices"),
        F.count_if(n > max_items).alias("invoices_over_cap"),
        F.max(n).alias("largest_basket"),
        F.sum(pairs).alias("pairs_uncapped"),
        F.sum(F.when(n <= max_items, pairs).otherwise(F.lit(0))).alias("pairs_capped"))


def duplicate_flag_check(wh: Warehouse) -> DataFrame:
    """D3: stored cluster sizes of the audit table against sizes recounted
    from the audit rows themselves; a stale flag shows as a mismatch or a
    cluster of one."""
    dq = wh.data_quality_potential_duplicates
    keys = ["invoice_no", "stock_code", "quantity"]
    recount = dq.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(F.count(F.lit(1)).alias("_actual"))
    j = dq.join(recount, [dq[k].eqNullSafe(recount[f"_{k}"]) for k in keys])
    return j.agg(
        F.count(F.lit(1)).alias("flagged_rows"),
        F.count_distinct(F.struct(*keys)).alias("clusters"),
        F.count_if(F.col("duplicate_group_count") != F.col("_actual")).alias("mismatched_rows"),
        F.count_if(F.col("_actual") == 1).alias("clusters_of_one"))


def view_invariants(wh: Warehouse) -> DataFrame:
    """No negative cancelled totals; every sales country appears in the
    cancellation rates with a name (counts equal to the revenue view)."""
    neg = CA.products_by_volume(wh).filter(F.col("cancelled_total") < 0).agg(F.count(F.lit(1))).scalar()
    rates = CA.rates_by_country(wh)
    named = rates.filter(F.col("country").isNotNull()).agg(F.count(F.lit(1))).scalar()
    total = rates.agg(F.count(F.lit(1))).scalar()
    return GE.revenue(wh).agg(F.count(F.lit(1)).alias("revenue_countries")).select(
        neg.alias("negative_cancelled_totals"), total.alias("rate_countries"),
        named.alias("named_rate_countries"), "revenue_countries")
