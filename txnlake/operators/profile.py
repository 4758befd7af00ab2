"""Profiling checks of the raw feed and the processed tables.

Every check is one aggregate (or a filter plus aggregate) returning a small
DataFrame of metrics, or the offending rows; nothing is collected. Column
lists become rows with ``stack`` so a check over nine columns is one job.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expand import expand
from ..schemas import RAW_COLUMNS

KEY6 = ["InvoiceNo", "StockCode", "Description", "Quantity", "InvoiceDate", "UnitPrice"]
DUP_KEYS = ["InvoiceNo", "StockCode", "Quantity"]


def _c_invoice(df: DataFrame) -> Column:
    return F.coalesce(F.col("InvoiceNo").startswith("C"), F.lit(False))


def _long(one_row: DataFrame, names: list[str], value: str) -> DataFrame:
    """One wide row -> (column_name, value) rows."""
    args = ", ".join(f"'{n}', `{n}`" for n in names)
    return one_row.selectExpr(f"stack({len(names)}, {args}) as (column_name, {value})")


def shape(df: DataFrame) -> DataFrame:
    """Row and column counts (``df.columns`` / ``df.limit(n)`` give names and first rows)."""
    return df.agg(F.count(F.lit(1)).alias("rows")).withColumn("columns", F.lit(len(df.columns)))


def missing_values(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Missing values per column."""
    cols = cols or df.columns
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return _long(wide, cols, "missing")


def duplicate_row_count(df: DataFrame) -> DataFrame:
    """Rows, distinct rows and copies beyond the first."""
    g = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
    return g.agg(F.sum("_n").alias("rows"), F.count(F.lit(1)).alias("distinct_rows"),
                 F.sum(F.col("_n") - 1).alias("duplicate_rows"))


def duplicate_members(df: DataFrame) -> DataFrame:
    """Every member of an exact-duplicate group, sorted. Members of one
    group are identical, so they are re-expanded from the group count (no
    join back, no window over a hot group)."""
    g = (df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1)
         .withColumn("_one", F.lit(1).cast("long")))
    out = expand(g, "_one", "_n", "_i").drop("_n", "_one")
    # The copy's number ends the order, so the copies of a large group spread over the range partitions.
    return out.orderBy(*[F.col(c).asc_nulls_last() for c in df.columns], "_i").drop("_i")


def column_profile(df: DataFrame) -> DataFrame:
    """P5: type and non-null count per column."""
    wide = df.agg(*[F.count(F.col(c)).alias(c) for c in df.columns])
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    long = _long(wide, df.columns, "non_null")
    expr = F.lit(None).cast("string")
    for c, t in types.items():
        expr = F.when(F.col("column_name") == c, F.lit(t)).otherwise(expr)
    return long.withColumn("data_type", expr)


def distinct_counts(df: DataFrame, cols: list[str] | None = None, approx: bool = False) -> DataFrame:
    """Distinct non-null values per column (exact; ``approx=True`` uses HyperLogLog++)."""
    cols = cols or df.columns
    if approx:
        return _long(df.agg(*[F.approx_count_distinct(c).alias(c) for c in cols]), cols, "distinct_count")
    # One pruned single-column distinct per column; counting all columns at
    # once would first expand every row to one row per column.
    each = [df.select(F.col(c).alias("v")).distinct().agg(F.count("v").alias("distinct_count"))
            .select(F.lit(c).alias("column_name"), "distinct_count") for c in cols]
    return reduce(DataFrame.unionByName, each)


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """Distinct values of a column (null is one value)."""
    return df.select(col).distinct()


def sign_checks(df: DataFrame) -> DataFrame:
    """Is every C-invoice quantity negative; is any other quantity negative."""
    neg = F.coalesce(F.col("Quantity") < 0, F.lit(False))
    c = _c_invoice(df)
    return df.agg(
        F.coalesce(F.bool_and(F.when(c, neg)), F.lit(True)).alias("cancellations_all_negative"),
        F.coalesce(F.bool_or(F.when(~c, neg)), F.lit(False)).alias("regular_any_negative"))


def hidden_negatives(df: DataFrame) -> DataFrame:
    """Non-C lines with negative quantity; the slice with no customer,
    no description and zero price; the remainder and its breakdown."""
    hidden = (~_c_invoice(df)) & F.coalesce(F.col("Quantity") < 0, F.lit(False))
    blank = (F.col("CustomerID").isNull() & F.col("Description").isNull()
             & F.coalesce(F.col("UnitPrice") == 0, F.lit(False)))
    rest = hidden & ~blank
    return df.agg(
        F.count_if(hidden).alias("hidden_negatives"),
        F.count_if(hidden & blank).alias("missing_id_description_price"),
        F.count_if(rest).alias("remaining"),
        F.count_if(rest & F.coalesce(F.col("UnitPrice") == 0, F.lit(False))).alias("remaining_price_zero"),
        F.count_if(rest & F.col("CustomerID").isNull()).alias("remaining_no_customer"),
        F.count_distinct(F.when(rest, F.col("Description"))).alias("remaining_descriptions"))


def hidden_negative_remainder(df: DataFrame) -> DataFrame:
    """P10: hidden negatives minus the blank slice, by row identity (a
    null-safe negated predicate, no join)."""
    hidden = (~_c_invoice(df)) & F.coalesce(F.col("Quantity") < 0, F.lit(False))
    blank = (F.col("CustomerID").isNull() & F.col("Description").isNull()
             & F.coalesce(F.col("UnitPrice") == 0, F.lit(False)))
    return df.filter(hidden & ~blank)


def cancellation_gaps(df: DataFrame) -> DataFrame:
    """C-invoice lines missing customer, description, price (jointly and each)."""
    c = _c_invoice(df)
    zero = F.coalesce(F.col("UnitPrice") == 0, F.lit(False))
    return df.agg(
        F.count_if(c & F.col("CustomerID").isNull() & F.col("Description").isNull() & zero).alias("all_missing"),
        F.count_if(c & F.col("CustomerID").isNull()).alias("no_customer"),
        F.count_if(c & F.col("Description").isNull()).alias("no_description"),
        F.count_if(c & zero).alias("price_zero"))


def date_range(df: DataFrame, col: str = "InvoiceDate") -> DataFrame:
    """First and last timestamp, unparseable (null) count."""
    return df.agg(F.min(col).alias("first_date"), F.max(col).alias("last_date"),
                  F.count_if(F.col(col).isNull()).alias("unparseable"))


def predicate_slices(df: DataFrame) -> DataFrame:
    """The six slices that motivated the classification rules."""
    q, p, nocust = F.col("Quantity"), F.col("UnitPrice"), F.col("CustomerID").isNull()
    c = _c_invoice(df)
    f = lambda e: F.coalesce(e, F.lit(False))
    return df.agg(
        F.count_if(f(p < 0)).alias("negative_price"),
        F.count_if(f(nocust & (q > 0))).alias("no_customer_positive_qty"),
        F.count_if(f(nocust & c & (q < 0))).alias("no_customer_cancellations"),
        F.count_if(f(nocust & (p == 0) & (q < 0))).alias("no_customer_inventory_adjustments"),
        F.count_if(f(nocust & (p < 0))).alias("no_customer_account_adjustments"),
        F.count_if(f((q > 0) & (p == 0))).alias("zero_price_positive_qty"))


def value_frequencies(df: DataFrame, col: str, n: int = 30) -> DataFrame:
    """The n most frequent values, nulls included (ties by value)."""
    return (df.groupBy(col).agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.col("count").desc(), F.col(col).asc_nulls_first()).limit(n))


def rows_per_class(df: DataFrame) -> DataFrame:
    """P16"""
    return df.groupBy("TransactionType").agg(F.count(F.lit(1)).alias("rows"))


def _repeated(df: DataFrame) -> DataFrame:
    """(invoice, code, quantity) groups of more than one line (nulls equal), with their size."""
    return df.groupBy(*DUP_KEYS).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1)


def within_invoice_clusters(df: DataFrame) -> DataFrame:
    """(invoice, code, quantity) groups of more than one line (null keys dropped)."""
    return (df.dropna(subset=DUP_KEYS).groupBy(*DUP_KEYS)
            .agg(F.count(F.lit(1)).alias("appearance_count"))
            .filter(F.col("appearance_count") > 1))


def _spans(df: DataFrame) -> DataFrame:
    """Per (code, quantity) of the repeated groups: their lines and distinct known invoices."""
    return _repeated(df).groupBy("StockCode", "Quantity").agg(
        F.sum("_n").alias("lines"), F.count("InvoiceNo").alias("unique_invoice_count"))


def cross_invoice_spans(df: DataFrame) -> DataFrame:
    """(code, quantity) of clustered lines appearing on several invoices."""
    return (_spans(df).dropna(subset=["StockCode", "Quantity"]).filter(F.col("unique_invoice_count") > 1)
            .select("StockCode", "Quantity", "unique_invoice_count"))


def cluster_summary(df: DataFrame) -> DataFrame:
    """Rows in clusters, within-invoice clusters, cross-invoice spans,
    from one scan and one chain of aggregates."""
    known = F.col("StockCode").isNotNull() & F.col("Quantity").isNotNull()
    return _spans(df).agg(
        F.coalesce(F.sum("lines"), F.lit(0)).alias("rows_in_duplicates"),
        F.coalesce(F.sum(F.when(known, F.col("unique_invoice_count"))), F.lit(0)).alias("within_invoice_clusters"),
        F.count_if(known & (F.col("unique_invoice_count") > 1)).alias("cross_invoice_spans"))


def ids_whole(df: DataFrame, col: str = "CustomerID") -> DataFrame:
    """P20: are all ids whole numbers."""
    return df.agg(F.coalesce(F.bool_and(F.col(col).cast("double") % 1 == 0), F.lit(True)).alias("all_whole"))


def candidate_key_check(lines: DataFrame, by: str = "kind") -> DataFrame:
    """Per processed table, distinct 6-column combinations and rows in
    repeated combinations."""
    g = lines.groupBy(by, *KEY6).agg(F.count(F.lit(1)).alias("_n"))
    return g.groupBy(by).agg(
        F.count(F.lit(1)).alias("unique_combinations"),
        F.sum(F.when(F.col("_n") > 1, F.col("_n")).otherwise(F.lit(0))).alias("duplicate_rows"))


def stock_code_checks(sales: DataFrame) -> DataFrame:
    """Non-numeric codes, POST/DOT rows, and codes not starting with a digit."""
    code = F.col("StockCode")
    non_num = ~F.coalesce(code.rlike("^[0-9]+$"), F.lit(False))
    unparsable = code.try_cast("double").isNull() & code.isNotNull()
    system = unparsable & ~F.coalesce(code.rlike("^[0-9]"), F.lit(False))
    return sales.agg(
        F.count_distinct(F.when(non_num, code)).alias("non_numeric_codes"),
        F.count_if(F.coalesce(code.isin("POST", "DOT"), F.lit(False))).alias("post_dot_rows"),
        F.count_distinct(F.when(unparsable, code)).alias("unparsable_codes"),
        F.count_distinct(F.when(system, code)).alias("system_codes"))


def post_split_audit(lines: DataFrame, by: str = "kind") -> DataFrame:
    """Per processed table: rows, types, invoice prefixes, distinct codes."""
    return lines.groupBy(by).agg(
        F.count(F.lit(1)).alias("rows"),
        F.concat_ws(",", F.array_sort(F.collect_set("TransactionType"))).alias("types"),
        F.concat_ws(",", F.array_sort(F.collect_set(F.substring("InvoiceNo", 1, 1)))).alias("invoice_prefixes"),
        F.count_distinct("StockCode").alias("stock_codes"))


def sale_rows_in_adjustments(lines: DataFrame) -> DataFrame:
    """Adjustments still typed 'Sale' (expected none)."""
    adj = lines.filter((F.col("kind") == "adjustments") & (F.col("TransactionType") == "Sale"))
    return adj.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("StockCode").alias("stock_codes"))


# --- SQL statements of the same checks over the raw table ``r`` -------------

def oracle_sql(wrap: Callable[[str], str]) -> dict[str, str]:
    cols9 = RAW_COLUMNS + ["TransactionType"]
    union = lambda sel: " UNION ALL ".join(sel.format(c=c) for c in cols9)
    cinv = "coalesce(starts_with(InvoiceNo, 'C'), false)"
    return {
        "P2_missing": wrap(union("SELECT '{c}' AS column_name, COUNT(*) FILTER (WHERE {c} IS NULL) AS missing FROM r")),
        "P3_duplicate_rows": wrap(f"""SELECT CAST(SUM(n) AS BIGINT) AS rows, COUNT(*) AS distinct_rows,
                                     CAST(SUM(n - 1) AS BIGINT) AS duplicate_rows FROM
                                     (SELECT COUNT(*) AS n FROM r GROUP BY {', '.join(cols9)})"""),
        "P6_distinct_counts": wrap(union("SELECT '{c}' AS column_name, COUNT(DISTINCT {c}) AS distinct_count FROM r")),
        "P8_sign_checks": wrap(f"""SELECT coalesce(bool_and(CASE WHEN {cinv} THEN coalesce(Quantity < 0, false) END), true)
                                          AS cancellations_all_negative,
                                      coalesce(bool_or(CASE WHEN NOT {cinv} THEN coalesce(Quantity < 0, false) END), false)
                                          AS regular_any_negative FROM r"""),
        "P13_date_range": wrap("""SELECT MIN(InvoiceDate) AS first_date, MAX(InvoiceDate) AS last_date,
                                      COUNT(*) FILTER (WHERE InvoiceDate IS NULL) AS unparseable FROM r"""),
        "P14_slices": wrap(f"""SELECT COUNT(*) FILTER (WHERE UnitPrice < 0) AS negative_price,
                 COUNT(*) FILTER (WHERE CustomerID IS NULL AND Quantity > 0) AS no_customer_positive_qty,
                 COUNT(*) FILTER (WHERE CustomerID IS NULL AND {cinv} AND Quantity < 0) AS no_customer_cancellations,
                 COUNT(*) FILTER (WHERE CustomerID IS NULL AND UnitPrice = 0 AND Quantity < 0) AS no_customer_inventory_adjustments,
                 COUNT(*) FILTER (WHERE CustomerID IS NULL AND UnitPrice < 0) AS no_customer_account_adjustments,
                 COUNT(*) FILTER (WHERE Quantity > 0 AND UnitPrice = 0) AS zero_price_positive_qty FROM r"""),
        "P16_class_counts": wrap("SELECT TransactionType, COUNT(*) AS rows FROM r GROUP BY TransactionType"),
        "P17_clusters": wrap("""SELECT InvoiceNo, StockCode, Quantity, COUNT(*) AS appearance_count FROM r
                                WHERE InvoiceNo IS NOT NULL AND StockCode IS NOT NULL AND Quantity IS NOT NULL
                                GROUP BY InvoiceNo, StockCode, Quantity HAVING COUNT(*) > 1"""),
        "P19_cluster_summary": wrap("""WITH d AS (SELECT * FROM (SELECT *, COUNT(*) OVER (PARTITION BY InvoiceNo, StockCode, Quantity) AS n FROM r) WHERE n > 1),
              w AS (SELECT COUNT(*) AS k FROM (SELECT 1 FROM r WHERE InvoiceNo IS NOT NULL AND StockCode IS NOT NULL
                    AND Quantity IS NOT NULL GROUP BY InvoiceNo, StockCode, Quantity HAVING COUNT(*) > 1)),
              s AS (SELECT COUNT(*) AS k FROM (SELECT 1 FROM d WHERE StockCode IS NOT NULL AND Quantity IS NOT NULL
                    GROUP BY StockCode, Quantity HAVING COUNT(DISTINCT InvoiceNo) > 1))
              SELECT (SELECT COUNT(*) FROM d) AS rows_in_duplicates, (SELECT k FROM w) AS within_invoice_clusters,
                     (SELECT k FROM s) AS cross_invoice_spans"""),
        "P21_candidate_key": wrap("""SELECT kind, COUNT(*) AS unique_combinations,
                       CAST(SUM(CASE WHEN n > 1 THEN n ELSE 0 END) AS BIGINT) AS duplicate_rows
                FROM (SELECT kind, COUNT(*) AS n FROM tx
                      GROUP BY kind, InvoiceNo, StockCode, Description, Quantity, InvoiceDate, UnitPrice) GROUP BY kind"""),
        "P22_stock_codes": wrap("""SELECT COUNT(DISTINCT CASE WHEN NOT coalesce(regexp_full_match(StockCode, '[0-9]+'), false) THEN StockCode END) AS non_numeric_codes,
                   COUNT(*) FILTER (WHERE StockCode IN ('POST', 'DOT')) AS post_dot_rows,
                   COUNT(DISTINCT CASE WHEN TRY_CAST(StockCode AS DOUBLE) IS NULL THEN StockCode END) AS unparsable_codes,
                   COUNT(DISTINCT CASE WHEN TRY_CAST(StockCode AS DOUBLE) IS NULL
                         AND NOT coalesce(regexp_matches(StockCode, '^[0-9]'), false) THEN StockCode END) AS system_codes
                   FROM tx WHERE kind = 'sales'"""),
        "P23_post_split": wrap("""SELECT kind, COUNT(*) AS rows, string_agg(DISTINCT TransactionType, ',' ORDER BY TransactionType) AS types,
                   string_agg(DISTINCT left(InvoiceNo, 1), ',' ORDER BY left(InvoiceNo, 1)) AS invoice_prefixes,
                   COUNT(DISTINCT StockCode) AS stock_codes FROM tx GROUP BY kind"""),
        "P24_sale_in_adjustments": wrap("""SELECT COUNT(*) AS rows, COUNT(DISTINCT StockCode) AS stock_codes FROM tx
                                          WHERE kind = 'adjustments' AND TransactionType = 'Sale'"""),
        "P9_hidden_negatives": wrap("""SELECT COUNT(*) FILTER (WHERE h) AS hidden_negatives,
                   COUNT(*) FILTER (WHERE h AND b) AS missing_id_description_price,
                   COUNT(*) FILTER (WHERE h AND NOT b) AS remaining,
                   COUNT(*) FILTER (WHERE h AND NOT b AND coalesce(UnitPrice = 0, false)) AS remaining_price_zero,
                   COUNT(*) FILTER (WHERE h AND NOT b AND CustomerID IS NULL) AS remaining_no_customer,
                   COUNT(DISTINCT CASE WHEN h AND NOT b THEN Description END) AS remaining_descriptions
                   FROM (SELECT *, NOT coalesce(starts_with(InvoiceNo, 'C'), false) AND coalesce(Quantity < 0, false) AS h,
                         CustomerID IS NULL AND Description IS NULL AND coalesce(UnitPrice = 0, false) AS b FROM r)"""),
        "P12_cancellation_gaps": wrap(f"""SELECT
                   COUNT(*) FILTER (WHERE {cinv} AND CustomerID IS NULL AND Description IS NULL AND coalesce(UnitPrice = 0, false)) AS all_missing,
                   COUNT(*) FILTER (WHERE {cinv} AND CustomerID IS NULL) AS no_customer,
                   COUNT(*) FILTER (WHERE {cinv} AND Description IS NULL) AS no_description,
                   COUNT(*) FILTER (WHERE {cinv} AND coalesce(UnitPrice = 0, false)) AS price_zero FROM r"""),
        "P15_zero_value_descriptions": wrap("""SELECT Description, COUNT(*) AS count FROM r WHERE Quantity > 0 AND UnitPrice = 0
                   GROUP BY Description ORDER BY count DESC, Description ASC NULLS FIRST LIMIT 30"""),
        "P20_ids_whole": wrap("SELECT coalesce(bool_and(CAST(CustomerID AS DOUBLE) % 1 = 0), true) AS all_whole FROM r"),
        "P1_shape": wrap("SELECT COUNT(*) AS rows, 9 AS columns FROM r"),
        "P4_duplicate_members": wrap(f"""SELECT {', '.join(cols9)} FROM
                   (SELECT *, COUNT(*) OVER (PARTITION BY {', '.join(cols9)}) AS n FROM r) WHERE n > 1"""),
        "P5_column_profile": wrap(" UNION ALL ".join(
            f"SELECT '{c}' AS column_name, COUNT({c}) AS non_null, '{t}' AS data_type FROM r"
            for c, t in zip(cols9, ["string", "string", "string", "int", "timestamp_ntz", "double", "int",
                                    "string", "string"]))),
        "P7_distinct_countries": wrap("SELECT DISTINCT Country FROM r"),
        "P10_hidden_remainder": wrap(f"""SELECT * FROM r WHERE NOT {cinv} AND coalesce(Quantity < 0, false)
                   AND NOT (CustomerID IS NULL AND Description IS NULL AND coalesce(UnitPrice = 0, false))"""),
        "P18_cross_invoice_spans": wrap("""SELECT StockCode, Quantity, COUNT(DISTINCT InvoiceNo) AS unique_invoice_count
                   FROM (SELECT *, COUNT(*) OVER (PARTITION BY InvoiceNo, StockCode, Quantity) AS n FROM r) WHERE n > 1
                   AND StockCode IS NOT NULL AND Quantity IS NOT NULL GROUP BY StockCode, Quantity
                   HAVING COUNT(DISTINCT InvoiceNo) > 1"""),
    }
