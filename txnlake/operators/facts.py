"""Fact and audit projections, keys, hashes and idempotent inserts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions.expand import expand

NON_SALE_COLUMNS = ["invoice_no", "stock_code", "description", "quantity", "invoice_date",
                    "unit_price", "customer_id", "country_key", "transaction_type", "date_key"]


def row_hash(cols: list[Column]) -> Column:
    """md5 of the values joined with '-'; a null is hashed as 'nan'
    (``concat_ws`` would otherwise skip it)."""
    return F.md5(F.concat_ws("-", *[F.coalesce(c.cast("string"), F.lit("nan")) for c in cols]))


def date_key(ts: Column) -> Column:
    """yyyyMMdd as a number, by arithmetic (a formatter costs more than the rest of a line's keys)."""
    year, day = F.year(ts), F.month(ts) * 100 + F.dayofmonth(ts)
    return year * 10000 + F.when(year < 0, -day).otherwise(day)


def with_keys(tx: DataFrame, dim_country: DataFrame) -> DataFrame:
    """Country -> country_key (left join, so a miss stays visible to
    validation) and timestamp -> date_key. Countries are free text, so the
    dimension has no proven bound: Spark broadcasts the written table while it
    is under its size threshold, and splits a hot country's rows beyond it."""
    dc = dim_country.select(F.col("country").alias("_country"), "country_key")
    return (tx.join(dc, tx["Country"] == dc["_country"], "left")
            .drop("_country")
            .withColumn("date_key", date_key(F.col("InvoiceDate"))))


def _renamed(tx: DataFrame) -> dict[str, Column]:
    return {
        "invoice_no": F.col("InvoiceNo"),
        "stock_code": F.col("StockCode"),
        "description": F.col("Description"),
        "quantity": F.col("Quantity").cast("int"),
        "invoice_date": F.col("InvoiceDate").cast("timestamp_ntz"),
        "raw_price": F.col("UnitPrice"),
        "unit_price": F.col("UnitPrice").cast(S.PRICE),
        "customer_id": F.col("CustomerID").cast("int"),
        "country_key": F.col("country_key"),
        "date_key": F.col("date_key"),
    }


def standard_fact(keyed: DataFrame) -> DataFrame:
    """Sales / cancellations / adjustments projection with row hash and
    revenue (double product of the unrounded price, rounded on store). Keeps
    ``sub_rank`` and ``_ord`` for the first-row-wins insert."""
    r = _renamed(keyed)
    h = row_hash([r["invoice_no"], r["stock_code"], r["description"], r["quantity"],
                  r["invoice_date"], r["raw_price"]])
    return keyed.select(
        h.alias("row_hash"),
        *[r[c].alias(c) for c in ["invoice_no", "stock_code", "quantity", "invoice_date",
                                  "unit_price", "customer_id", "country_key"]],
        F.col("revenue").cast(S.MONEY).alias("revenue"),
        r["date_key"].alias("date_key"),
        "sub_rank", "_ord",
    )


def non_sale_fact(keyed: DataFrame) -> DataFrame:
    """Non-sales keep description and type; no revenue."""
    r = _renamed(keyed)
    r["transaction_type"] = F.col("TransactionType")
    return keyed.select(*[r[c].alias(c) for c in NON_SALE_COLUMNS])


def audit_rows(audit: DataFrame) -> DataFrame:
    """The potential-duplicate audit table (country as text, no keys)."""
    return audit.select(
        F.col("InvoiceNo").alias("invoice_no"),
        F.col("StockCode").alias("stock_code"),
        F.col("Quantity").cast("int").alias("quantity"),
        F.col("Description").alias("description"),
        F.col("InvoiceDate").cast("timestamp_ntz").alias("invoice_date"),
        F.col("UnitPrice").cast(S.PRICE).alias("unit_price"),
        F.col("CustomerID").cast("int").alias("customer_id"),
        F.col("Country").alias("country"),
        F.col("TransactionType").alias("transaction_type"),
        F.col("issue_type"),
        F.col("duplicate_group_count").cast("int"),
    )


def first_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key, the first by ``order`` (S8, batch side). ``min_by``
    over a struct is a partial aggregate, so a key holding a third of the
    rows is combined map-side. Null keys never conflict and all pass."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    has_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    firsts = (df.filter(~has_null).groupBy(*keys)
              .agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_row"))
              .select(*keys, "_row.*"))
    return firsts.unionByName(df.filter(has_null).select(*keys, *rest))


def insert_ignore(batch: DataFrame, target: DataFrame | None, keys: list[str],
                  order: list[str] | None = None) -> DataFrame:
    """Rows of ``batch`` to append: first row per key within the batch,
    minus keys already in ``target``."""
    return not_in(first_per_key(batch, keys, order) if order else batch.dropDuplicates(keys), target, keys)


def not_in(rows: DataFrame, target: DataFrame | None, keys: list[str]) -> DataFrame:
    """S8 for rows whose keys are unique already."""
    return rows if target is None else rows.join(target.select(*keys), keys, "left_anti")


def multiset_insert(batch: DataFrame, target: DataFrame | None, cols: list[str],
                    hash_col: str = "row_hash") -> DataFrame:
    """Idempotent insert of rows with no natural key (non-sales, fix of the
    reference's re-run duplication): identical rows are counted (partial
    aggregate), the copies the target already holds are subtracted, and the
    rest are re-expanded with an occurrence number that enters the hash."""
    counts = batch.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n"))
    if target is not None:
        have = target.groupBy(*cols).agg(F.count(F.lit(1)).alias("_have"))
        cond = reduce(lambda a, b: a & b, [counts[c].eqNullSafe(have[c]) for c in cols])
        counts = (counts.join(have, cond, "left")
                  .select(*[counts[c] for c in cols], "_n", F.coalesce("_have", F.lit(0)).alias("_have")))
    else:
        counts = counts.withColumn("_have", F.lit(0).cast("long"))
    todo = counts.filter(F.col("_n") > F.col("_have")).withColumn("_from", F.col("_have") + 1)
    expanded = expand(todo, "_from", "_n", "_occ")
    return expanded.select(
        row_hash([F.col(c) for c in cols] + [F.col("_occ")]).alias(hash_col),
        *cols)


def with_ids(df: DataFrame, id_col: str, start_after: int = 0) -> DataFrame:
    """Surrogate ids above the current maximum. Unique, not contiguous
    (identity columns have gaps too); assigned without any shuffle."""
    return df.select((F.monotonically_increasing_id() + F.lit(start_after + 1)).alias(id_col), *df.columns)
