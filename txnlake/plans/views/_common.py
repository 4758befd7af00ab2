"""Joins shared by the views.

Broadcast policy: only ``dim_date`` (one row per calendar day present) has a
fixed bound and is broadcast by hand. The other dimensions are joined after
the facts are pre-aggregated by key, and Spark picks a broadcast only when
their size is under its threshold.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..warehouse import Warehouse


def dated(fact: DataFrame, wh: Warehouse, *cols: str) -> DataFrame:
    """fact INNER JOIN dim_date ON date_key (broadcast: calendar-bounded)."""
    dd = wh.dim_date.select("date_key", *cols)
    return fact.join(F.broadcast(dd), "date_key")


def with_country(agg_by_key: DataFrame, wh: Warehouse, how: str = "inner") -> DataFrame:
    """Per-country_key aggregate -> country name (one row per country on both sides)."""
    return agg_by_key.join(wh.dim_country.select("country_key", "country"), "country_key", how)


def with_description(agg_by_code: DataFrame, wh: Warehouse, how: str = "inner") -> DataFrame:
    """Per-stock_code aggregate -> description (one row per code on both sides)."""
    return agg_by_code.join(wh.dim_product.select("stock_code", "description"), "stock_code", how)


def known_customers(fact: DataFrame) -> DataFrame:
    """fact INNER JOIN dim_customer. Every non-null customer_id of a fact is
    in dim_customer (the load builds the dimension from the same rows, and
    ``audit_integrity`` checks it), so the join reduces to a null filter."""
    return fact.filter(F.col("customer_id").isNotNull())
