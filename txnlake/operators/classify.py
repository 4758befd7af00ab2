"""Row typing, classification and routing.

Everything here is a narrow projection: one pass, no shuffle, all inside
whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import codes as K


# Accepted invoice-date layouts besides ISO (month first, as the
# raw feed writes them, e.g. 12/1/2010 8:26), and their ISO form.
MONTH_FIRST = ((r"^(\d{1,2})/(\d{1,2})/(\d{4})$", "$3-$1-$2"),
               (r"^(\d{1,2})/(\d{1,2})/(\d{4}) (\d{1,2}:\d{2})$", "$3-$1-$2 $4:00"),
               (r"^(\d{1,2})/(\d{1,2})/(\d{4}) (\d{1,2}:\d{2}:\d{2})$", "$3-$1-$2 $4"))


def parse_timestamp(c: Column) -> Column:
    """T1 on a column: text -> timestamp_ntz, ISO or month first; unparseable
    text becomes null, never an error. No step has a time zone, so the result
    does not depend on the session's (a wall-clock time that a zone skips
    stays as written)."""
    iso = F.btrim(c)
    for layout, form in MONTH_FIRST:
        iso = F.regexp_replace(iso, layout, form)
    return iso.try_cast("timestamp_ntz")


def parse_ts(df: DataFrame, col: str = "InvoiceDate") -> DataFrame:
    """Text -> timestamp; unparseable values become null (never raise)."""
    if dict(df.dtypes).get(col) in ("timestamp", "timestamp_ntz"):
        return df
    return df.withColumn(col, parse_timestamp(F.col(col)))


def cast_customer(df: DataFrame, col: str = "CustomerID") -> DataFrame:
    """Nullable integer id; accepts '17850' and '17850.0'."""
    if dict(df.dtypes).get(col) == "int":
        return df
    return df.withColumn(col, F.col(col).try_cast("double").try_cast("int"))


def transaction_type(price: Column, invoice: Column, qty: Column, customer: Column) -> Column:
    """Ordered first-match classification; 'Sale' is the catch-all.

    A null comparison is not taken, like a false mask in the reference.
    """
    return (F.when(price < 0, F.lit(K.ACCOUNT_ADJUSTMENT))
            .when(invoice.startswith(K.CANCELLATION_PREFIX), F.lit(K.CANCELLATION))
            .when((qty < 0) & (price == 0) & customer.isNull(), F.lit(K.INVENTORY_ADJUSTMENT))
            .when((qty > 0) & (price == 0), F.lit(K.ZERO_VALUE))
            .otherwise(F.lit(K.SALE)))


def classify(df: DataFrame) -> DataFrame:
    """T3 on a raw frame: adds ``TransactionType``."""
    return df.withColumn("TransactionType", transaction_type(
        F.col("UnitPrice"), F.col("InvoiceNo"), F.col("Quantity"), F.col("CustomerID")))


def route(df: DataFrame) -> DataFrame:
    """T9-T13 in one projection.

    Adds ``kind`` (sales / cancellations / adjustments / non_sales),
    ``sub_rank`` (1 = native rows of the kind, 2 = moved from sales,
    3 = moved from cancellations; the reference appends moved rows in that
    order), ``revenue`` (signed quantity x unit price, for all but native
    non-sales) and takes the magnitude of cancelled quantities. Reserved
    codes move rows out of sales and cancellations with a new type.
    """
    t = F.col("TransactionType")
    code = F.col("StockCode")
    admin, fin = K.is_admin_code(code), K.is_fin_adj_code(code)
    movable = t.isin(K.SALE, K.CANCELLATION)
    from_rank = F.when(t == K.SALE, F.lit(2)).otherwise(F.lit(3))

    kind = (F.when(movable & admin, F.lit("non_sales"))
            .when(movable & fin, F.lit("adjustments"))
            .when(t == K.SALE, F.lit("sales"))
            .when(t == K.CANCELLATION, F.lit("cancellations"))
            .when(t.isin(K.ACCOUNT_ADJUSTMENT, K.INVENTORY_ADJUSTMENT), F.lit("adjustments"))
            .otherwise(F.lit("non_sales")))
    sub_rank = F.when(movable & (admin | fin), from_rank).otherwise(F.lit(1))
    new_type = (F.when(movable & admin, F.lit(K.ADMINISTRATIVE))
                .when(movable & fin, F.lit(K.FINANCIAL_ADJUSTMENT))
                .otherwise(t))
    # Revenue is taken from the signed quantity, before the magnitude.
    revenue = F.when(t == K.ZERO_VALUE, F.lit(None).cast("double")) \
        .otherwise(F.col("Quantity") * F.col("UnitPrice"))
    qty = F.when(t == K.CANCELLATION, F.abs(F.col("Quantity"))).otherwise(F.col("Quantity"))

    return df.withColumns({
        "kind": kind,
        "sub_rank": sub_rank,
        "revenue": revenue,
        "Quantity": qty,
        "TransactionType": new_type,
    })
