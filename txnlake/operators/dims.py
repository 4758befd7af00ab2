"""Cleaning and dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import codes as K
from .ranking import global_rank

FIRST_ORDER = ["src_rank", "sub_rank", "_ord"]


def clean(df: DataFrame) -> DataFrame:
    """L1: strip codes, descriptions and countries; fill missing text with
    'Unknown'. Lines without a stock code become one explicit product
    (``MISSING_CODE``), as in the reference, so no product view loses them."""
    out = {}
    if "StockCode" in df.columns:
        out["StockCode"] = K.strip(F.coalesce(F.col("StockCode"), F.lit(K.MISSING_CODE)))
    if "Description" in df.columns:
        out["Description"] = K.strip(F.coalesce(F.col("Description"), F.lit(K.UNKNOWN)))
    if "Country" in df.columns:
        out["Country"] = K.strip(F.coalesce(F.col("Country"), F.lit(K.UNKNOWN)))
    return df.withColumns(out)


def all_transactions(lines: DataFrame) -> DataFrame:
    """L2: the four kinds in the loader's order, as ``src_rank`` 1-4."""
    rank = F.lit(None).cast("int")
    for name, r in K.KIND_RANK.items():
        rank = F.when(F.col("kind") == name, F.lit(r)).otherwise(rank)
    return lines.withColumn("src_rank", rank)


def dim_product(tx: DataFrame) -> DataFrame:
    """L3: first description per stock code (sales, cancellations,
    adjustments, non-sales, then file order). Lines are combined by a hash
    aggregate per code, description and rank; the few rows that are left are
    the only ones sorted for ``min_by``."""
    return (_earliest(tx.filter(F.col("StockCode").isNotNull()), "StockCode", "Description")
            .groupBy(F.col("StockCode").alias("stock_code"))
            .agg(F.min_by("Description", F.struct(*FIRST_ORDER)).alias("description")))


def _earliest(tx: DataFrame, *keys: str) -> DataFrame:
    """The first position of every key and rank (a struct would make it a sort aggregate)."""
    return tx.groupBy(*keys, "src_rank", "sub_rank").agg(F.min("_ord").alias("_ord"))


def dim_customer(tx: DataFrame) -> DataFrame:
    """L4: distinct known customers."""
    return (tx.filter(F.col("CustomerID").isNotNull())
            .select(F.col("CustomerID").cast("int").alias("customer_id")).distinct())


def new_countries(tx: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Countries not yet in the dimension, keyed after the current maximum
    in order of first appearance (existing keys never change).

    Country is free text, so the names are numbered by the distributed rank
    and not by a window in one task.
    """
    first = (_earliest(tx, "Country").groupBy(F.col("Country").alias("country"))
             .agg(F.min(F.struct(*FIRST_ORDER)).alias("_first")))
    base = F.lit(0)
    if existing is not None:
        first = first.join(existing.select("country"), "country", "left_anti")
        base = existing.agg(F.coalesce(F.max("country_key"), F.lit(0))).scalar()
    ranked, _ = global_rank(first, [F.col("_first").asc(), F.col("country").asc()], "_place")
    return ranked.select((F.col("_place") + base).cast("int").alias("country_key"), "country")


def dim_date(tx: DataFrame) -> DataFrame:
    """One row per calendar day present."""
    days = tx.select(F.to_date("InvoiceDate").alias("full_date")).filter(
        F.col("full_date").isNotNull()).distinct()
    d = F.col("full_date")
    return days.select(
        F.date_format(d, "yyyyMMdd").cast("int").alias("date_key"),
        d.alias("full_date"),
        F.year(d).alias("year"),
        F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.weekofyear(d).alias("week"),
        F.dayofmonth(d).alias("day"),
        F.weekday(d).alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
    )
