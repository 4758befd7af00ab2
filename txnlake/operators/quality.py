"""Exact and potential duplicates.

Group sizes are taken with ``groupBy().count()`` (partial aggregation, so a
hot key is combined map-side); the repeated groups are joined back null-safely, with AQE's
skew-join handling a key that holds a third of the rows is split across
tasks instead of landing in one window partition.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import codes as K
from ..schemas import RAW_COLUMNS

DUP_KEYS = ["InvoiceNo", "StockCode", "Quantity"]
ROW_COLUMNS = RAW_COLUMNS + ["TransactionType"]


def _null_safe_on(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    cond = None
    for k in keys:
        c = left[k].eqNullSafe(right[k])
        cond = c if cond is None else cond & c
    return cond


def _join_back(df: DataFrame, groups: DataFrame, keys: list[str], extra: list[str], how: str = "inner") -> DataFrame:
    left, right = df.alias("_l"), groups.alias("_g")
    return (left.join(right, _null_safe_on(left, right, keys), how)
            .select(*[F.col(f"_l.{c}") for c in df.columns],
                    *[F.col(f"_g.{c}") for c in extra]))


def flag_exact_duplicates(df: DataFrame, cols: list[str] | None = None,
                          order: str = "_ord") -> DataFrame:
    """T4: ``IsExactDuplicate`` is true on every copy but the first (by ``order``)."""
    cols = cols or [c for c in ROW_COLUMNS if c in df.columns]
    firsts = df.groupBy(*cols).agg(F.min(order).alias("_first"))
    out = _join_back(df, firsts, cols, ["_first"])
    return out.withColumn("IsExactDuplicate", F.col(order) != F.col("_first")).drop("_first")


def drop_exact_duplicates(df: DataFrame, cols: list[str] | None = None,
                          order: str = "_ord") -> DataFrame:
    """T5: one row per identical row, keeping the earliest file position.

    A hash aggregate: copies collapse map-side before the shuffle.
    """
    cols = cols or [c for c in ROW_COLUMNS if c in df.columns]
    aggs = [F.min(order).alias(order)] if order in df.columns else []
    out = df.groupBy(*cols).agg(*aggs) if aggs else df.dropDuplicates(cols)
    return out.withColumn("IsExactDuplicate", F.lit(False))


def flag_potential_duplicates(df: DataFrame, keys: list[str] = DUP_KEYS) -> DataFrame:
    """T6 + T7: >1 row per (invoice, code, quantity), and the group size.

    Nulls count as equal for the flag, but a key with a null gets a null
    group size (the reference's group-by drops null keys).
    """
    # Only repeated groups are joined back: a row without a match is alone in
    # its group, so the right side stays small however many groups there are.
    aggs, repeated = [F.count(F.lit(1)).alias("_grp_n")], F.col("_grp_n") > 1
    if "_ord" in df.columns:
        # Both uses of ``df`` then read the same columns, and Spark computes
        # the de-duplication below them once (reused exchange).
        aggs.append(F.min("_ord").alias("_first"))
        repeated = repeated & F.col("_first").isNotNull()
    groups = df.groupBy(*keys).agg(*aggs).filter(repeated)
    out = _join_back(df, groups, keys, ["_grp_n"], "left")
    all_keys = None
    for k in keys:
        c = F.col(k).isNotNull()
        all_keys = c if all_keys is None else all_keys & c
    return (out.withColumn("IsPotentialDuplicateLine", F.col("_grp_n").isNotNull())
            .withColumn("duplicate_group_count",
                        F.when(all_keys, F.coalesce("_grp_n", F.lit(1))).cast("int"))
            .drop("_grp_n"))


def flag_duplicates(df: DataFrame) -> DataFrame:
    """T5-T7 with one shuffle: ``drop_exact_duplicates`` and
    ``flag_potential_duplicates`` over lines that are dealt by invoice (those
    without one by code and quantity)."""
    alone = F.when(F.col("InvoiceNo").isNull(), F.xxhash64("StockCode", "Quantity"))
    dealt = df.withColumn("_deal", alone).repartition("InvoiceNo", "_deal")
    cols = [c for c in ROW_COLUMNS if c in df.columns]
    lines = drop_exact_duplicates(dealt, [*cols, "_deal"])
    size = F.count(F.lit(1)).over(Window.partitionBy(*DUP_KEYS, "_deal"))
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in DUP_KEYS])
    return (lines.withColumn("_grp_n", size)
            .withColumn("IsPotentialDuplicateLine", F.col("_grp_n") > 1)
            .withColumn("duplicate_group_count", F.when(known, F.col("_grp_n")).cast("int"))
            .drop("_grp_n", "_deal"))


def potential_duplicates(df: DataFrame) -> DataFrame:
    """The audit rows (signed quantity, original type)."""
    return (df.filter(F.col("IsPotentialDuplicateLine"))
            .withColumn("issue_type", F.lit(K.POTENTIAL_DUPLICATE)))
