"""Basket pairs (R2): descriptions bought together in at least
``min_support`` invoices, among invoices with at most ``max_items`` codes.

The item cap is part of the query's definition (invoices above it are left
out of the pairs *and* of the denominator), not a device to escape skew:
after it, one invoice yields at most max_items*(max_items-1)/2 pairs, so no
group grows with the data. On top of it an exact a-priori bound prunes
candidates: a pair can reach ``min_support`` invoices only if each of its
descriptions does, so lines whose description is in fewer invoices are
dropped before the self-join. Every step is a hash aggregate or an
equi-join on the invoice; nothing is collected.

The distinct (invoice, code) items of invoices within the cap are written
once to the shared folder as Parquet; the denominator, the description
support and both sides of the self-join read that copy instead of each
re-deriving it from the fact table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage_table


def basket_pairs(lines: DataFrame, products: DataFrame, max_items: int = 100,
                 min_support: int = 20, invoice: str = "invoice_no",
                 code: str = "stock_code") -> DataFrame:
    """Columns: product_a, product_b, unique_combination, support_percentage."""
    items = lines.select(F.col(invoice).alias("inv"), F.col(code).alias("code")).distinct()
    # Distinct non-null codes per invoice: a partial aggregate, then the cap.
    sizes = items.groupBy("inv").agg(F.count("code").alias("n_codes"))
    normal = sizes.filter(F.col("n_codes") <= max_items).select("inv")
    kept = stage_table(items.join(normal, "inv", "left_semi"), "basket-items")
    # Denominator: distinct invoices within the cap, as a scalar subquery.
    total = kept.agg(F.count_distinct("inv")).scalar()

    named = (kept.filter(F.col("code").isNotNull())
             .join(products.select(F.col("stock_code").alias("code"),
                                   F.col("description").alias("desc")), "code"))
    # A-priori bound: invoices per description must reach min_support.
    frequent = (named.select("inv", "desc").distinct()
                .groupBy("desc").agg(F.count(F.lit(1)).alias("inv_n"))
                .filter(F.col("inv_n") >= min_support).select("desc"))
    cand = named.join(frequent, "desc", "left_semi")

    # Both sides are the same plan, so Spark shuffles the candidates once and
    # reuses the exchange for the other side. A merge join at every size: the
    # items are compact, but their pairs are many and need all tasks.
    a, b = cand.alias("a"), cand.alias("b")
    pairs = (a.join(b.hint("merge"), F.col("a.inv") == F.col("b.inv"))
             .filter(F.col("a.code") < F.col("b.code"))
             .select(F.col("a.inv").alias("inv"), F.col("a.desc").alias("product_a"),
                     F.col("b.desc").alias("product_b"))
             .distinct())
    counted = (pairs.groupBy("product_a", "product_b")
               .agg(F.count(F.lit(1)).alias("unique_combination"))
               .filter(F.col("unique_combination") >= min_support))
    pct = F.round(F.lit(100).cast("decimal(3,0)") * F.col("unique_combination").cast("decimal(20,0)")
                  / total.cast("decimal(20,0)"), 3)
    return counted.select("product_a", "product_b", "unique_combination",
                          pct.alias("support_percentage"))
