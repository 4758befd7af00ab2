"""Registered operator-level queries (T, L, R and P operators) and their SQL.

Each reads the driver's tables through the adapter (or the warehouse built
from them) and returns a result that an independent DuckDB statement over
the same tables reproduces.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import oracle as O
from ..operators import classify as C
from ..operators import profile as P
from ..operators.facts import with_keys
from ..operators.ranking import global_rank, ntile_global
from ..session import COMPRESSION, drop_path, scratch_path, shuffles_dropped
from ..sources.files import read_raw
from . import snapshots
from .catalog import BY_ID, export_all
from .etl import processed_for, raw_for, run, warehouse_for
from .published import attach_views, publish_views
from .views import diagnostics as DG
from .warehouse import FACT_TABLES, FOREIGN_KEYS, ID_COLUMNS, MONTH, NOT_NULL, UNIQUE_KEYS, audit_integrity, reset, validation_report


def _dbl(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(f.name).cast("double").alias(f.name)
                       if isinstance(f.dataType, T.DecimalType) else F.col(f.name)
                       for f in df.schema.fields])


def _routing(spark: SparkSession, sf: str) -> DataFrame:
    lines = processed_for(spark, sf).lines
    return (lines.groupBy("kind", "TransactionType", "OriginalType", "sub_rank")
            .agg(F.count(F.lit(1)).alias("rows"),
                 F.sum("Quantity").alias("quantity"),
                 F.sum("SignedQuantity").alias("signed_quantity"),
                 F.count_if("IsPotentialDuplicateLine").alias("flagged"),
                 F.sum(F.col("revenue").cast("decimal(12,2)")).cast("double").alias("revenue")))


def _table(name: str, drop: tuple[str, ...] = ()) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return _dbl(getattr(warehouse_for(spark, sf), name).drop(*drop))
    return run


def _rank(spark: SparkSession, sf: str) -> DataFrame:
    per = warehouse_for(spark, sf).fact_sales.filter(F.col("customer_id").isNotNull()) \
        .groupBy("customer_id").agg(F.sum("revenue").alias("r"))
    ranked, _ = global_rank(per, [F.col("r").desc_nulls_first(), F.col("customer_id").asc()], "rank")
    return ranked.select("customer_id", "rank")


def _ntile(spark: SparkSession, sf: str) -> DataFrame:
    per = warehouse_for(spark, sf).fact_sales.groupBy("stock_code").agg(F.sum("quantity").alias("q"))
    return ntile_global(per, 7, [F.col("q").desc_nulls_first(), F.col("stock_code").asc()], "tile") \
        .select("stock_code", "tile")


def _raw(spark: SparkSession, sf: str) -> DataFrame:
    """Classified raw lines, read from the raw feed the session wrote once."""
    return C.classify(raw_for(spark, sf)).drop("_ord")


def _exact_flags(spark: SparkSession, sf: str) -> DataFrame:
    from ..operators import quality as Q
    flagged = Q.flag_exact_duplicates(C.classify(raw_for(spark, sf)))
    return (flagged.groupBy("TransactionType", "IsExactDuplicate")
            .agg(F.count(F.lit(1)).alias("rows")))


_PARTS: dict[tuple, object] = {}


def _loaded_in_parts(spark: SparkSession, sf: str):
    """A warehouse loaded incrementally: even raw lines, then odd ones, then
    the even ones again (which must add nothing). Copies and near copies of a
    line are spread over the parts."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _PARTS:
        raw, path = raw_for(spark, sf), scratch_path(spark, "warehouse-parts")
        for part in (0, 1, 0):
            _PARTS[key] = run(spark, raw.filter(F.col("_ord") % 2 == part), path)
    return _PARTS[key]


def _incremental_fact(name: str, *drop: str, loaded=None) -> Callable[[SparkSession, str], DataFrame]:
    """A fact without its id, with the country's name (keys depend on the order of loading)."""
    def query(spark: SparkSession, sf: str) -> DataFrame:
        wh = (loaded or _loaded_in_parts)(spark, sf)
        return _dbl(getattr(wh, name).join(wh.dim_country, "country_key").drop("country_key", *drop))
    return query


def _resumed(spark: SparkSession, sf: str):
    """Even raw lines are loaded; two loads of the odd ones die, one after it
    wrote its facts and one after it also moved them into place; then the odd
    lines are loaded."""
    raw, path = raw_for(spark, sf), scratch_path(spark, "warehouse-resumed")
    wh = run(spark, raw.filter(F.col("_ord") % 2 == 0), path)
    for moved in (False, True):
        dead = snapshots.Attempt(spark, path)
        for name in FACT_TABLES:
            rows = getattr(wh, name).withColumn(MONTH, (F.col("date_key") / 100).cast("int"))
            rows.write.partitionBy(MONTH).parquet(dead.target(name))
        if moved:
            dead.settle(*FACT_TABLES)
    return run(spark, raw.filter(F.col("_ord") % 2 == 1), path)


def _after_reset(spark: SparkSession, sf: str):
    """Odd lines, a reset, then even lines and odd lines."""
    raw, path = raw_for(spark, sf), scratch_path(spark, "warehouse-reset")
    run(spark, raw.filter(F.col("_ord") % 2 == 1), path)
    reset(spark, path)
    run(spark, raw.filter(F.col("_ord") % 2 == 0), path)
    return run(spark, raw.filter(F.col("_ord") % 2 == 1), path)


def _across_months(spark: SparkSession, sf: str):
    """Groups that span months, also those of the null invoice, loaded in two
    parts: lines with an odd number of pence are forty days later."""
    raw, path = raw_for(spark, sf), scratch_path(spark, "warehouse-months")
    later = "make_dt_interval(if(cast(round(UnitPrice * 100) as bigint) % 2 <> 0, 40, 0))"
    moved = raw.withColumns({"InvoiceNo": F.expr("CASE WHEN InvoiceNo NOT LIKE '%2' THEN InvoiceNo END"),
                             "InvoiceDate": F.expr(f"CAST(InvoiceDate + {later} AS timestamp_ntz)")})
    run(spark, moved.filter(F.col("_ord") % 2 == 0), path)
    return run(spark, moved.filter(F.col("_ord") % 2 == 1), path)


def _audit_of(loaded) -> Callable[[SparkSession, str], DataFrame]:
    return lambda s, sf: _dbl(loaded(s, sf).data_quality_potential_duplicates.drop("quality_issue_id"))


def _ids(spark: SparkSession, sf: str) -> DataFrame:
    """L14 after three loads: ids are unique, and later loads' ids lie above earlier ones'."""
    wh = _loaded_in_parts(spark, sf)
    parts = [getattr(wh, n).select(F.lit(n).alias("table_name"), F.col(c).alias("id")) for n, c in ID_COLUMNS.items()]
    each = reduce(DataFrame.unionByName, parts).groupBy("table_name", "id").count()
    return each.groupBy("table_name").agg(F.sum("count").alias("rows"), F.max("count").alias("rows_per_id"), (F.min("id") > 0).alias("positive"))


def _validation(spark: SparkSession, sf: str) -> DataFrame:
    """L12 where it finds something: the processed lines, some without a date, keyed by half of the countries."""
    lines = processed_for(spark, sf).lines
    undated = lines.withColumn("InvoiceDate", F.when(F.col("Quantity") % 7 != 0, F.col("InvoiceDate")))
    known = warehouse_for(spark, sf).dim_country.filter(F.col("country") < "J")
    return validation_report(with_keys(undated, known)).drop("months")


def _published(spark: SparkSession, sf: str) -> DataFrame:
    """Two views published, then joined by SQL under their own names in another session."""
    path = scratch_path(spark, "views")
    publish_views(warehouse_for(spark, sf), path, only=["V19", "V24"])
    other = spark.newSession()
    names = attach_views(other, path)
    joined = other.sql("SELECT r.*, o.number_of_orders FROM customer.rfm_segments r JOIN customer.order_counts o USING (customer_id)")
    for name in names:  # sessions share the catalog; the files stay
        other.sql(f"DROP TABLE {name}")
    return _dbl(joined)


def _exported(spark: SparkSession, sf: str) -> DataFrame:
    """A view exported to one CSV file, read back."""
    path = scratch_path(spark, "export")
    report = export_all(warehouse_for(spark, sf), path, only=["V19"], single_file=True)
    if report["failed"] or report["folders"]:
        raise RuntimeError(f"export: {report}")
    return spark.read.option("header", True).schema("customer_id int, number_of_orders long").csv(f"{path}/{BY_ID['V19'].export}")


def _raw_files(spark: SparkSession, sf: str, tail: str = ' 36" wide, "large" \\', multi_line: bool = False) -> DataFrame:
    """S1 + S2: the raw feed written as two CSV files with quotes, commas and
    ``6.0`` numbers (and line ends), read back through the raw reader."""
    raw = raw_for(spark, sf)
    path = scratch_path(spark, "raw-files")
    told = raw.withColumn("Description", F.concat("Description", F.lit(tail)))
    # One file each: the two files are aligned by row position.
    order_path = scratch_path(spark, "ordered")
    ordered = staged_order(told, order_path)
    ids = ordered.select("InvoiceNo", "StockCode")
    rest = ordered.select("Description", F.col("Quantity").cast("double").alias("Quantity"), "InvoiceDate", "UnitPrice",
                          F.col("CustomerID").cast("double").alias("CustomerID"), "Country")
    for df, name in ((ids, "ids"), (rest, "data")):
        df.write.options(header=True, escape='"').csv(f"{path}/{name}")
    drop_path(spark, order_path)  # the files hold its rows
    return read_raw(spark, f"{path}/ids", f"{path}/data", multi_line=multi_line).drop("_ord")


def staged_order(raw: DataFrame, path: str | None = None) -> DataFrame:
    """The feed in file order, written so that both files are cut alike."""
    path = path or scratch_path(raw.sparkSession, "ordered")
    with shuffles_dropped(raw.sparkSession):
        raw.repartitionByRange("_ord").sortWithinPartitions("_ord").write.option("compression", COMPRESSION).parquet(path)
    return raw.sparkSession.read.parquet(path)


_TEXT_DATES = ("yyyy-MM-dd HH:mm:ss", "M/d/yyyy H:mm", "M/d/yyyy H:mm:ss")


def _types(spark: SparkSession, sf: str) -> DataFrame:
    """T1 + T2 over text: dates written in three layouts, ids as ``17850.0``, and texts that are neither."""
    raw = raw_for(spark, sf)
    kind = F.col("Quantity") % 4
    text = F.when(kind == 3, F.lit("32/13/2011 9:00"))
    for i, layout in enumerate(_TEXT_DATES):
        text = text.when(kind == i, F.date_format("InvoiceDate", layout))
    ids = F.when(kind == 1, F.concat(F.col("CustomerID").cast("string"), F.lit(".0"))).when(kind == 2, F.lit("x1")).otherwise(F.col("CustomerID").cast("string"))
    typed = C.cast_customer(C.parse_ts(raw.select("InvoiceNo", "Quantity", text.alias("InvoiceDate"), ids.alias("CustomerID"))))
    return typed.groupBy("InvoiceDate", "CustomerID").agg(F.count(F.lit(1)).alias("rows"))


def _violations(spark: SparkSession, sf: str) -> DataFrame:
    """L13 over a warehouse with planted violations of each kind."""
    wh = warehouse_for(spark, sf)
    none = F.lit(None)
    broken = replace(
        wh, dim_customer=wh.dim_customer.filter("customer_id % 7 <> 0"),
        dim_product=wh.dim_product.unionByName(wh.dim_product.filter("stock_code LIKE '%7'")),
        fact_cancellations=wh.fact_cancellations.withColumn("stock_code", F.when(F.col("quantity") % 5 == 0, none).otherwise(F.col("stock_code"))))
    return audit_integrity(broken).filter("violations > 0")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "T13_routing": _routing,
        "L3_dim_product": _table("dim_product"),
        "L4_dim_customer": _table("dim_customer"),
        "L5_dim_country": _table("dim_country"),
        "L6_dim_date": _table("dim_date"),
        "L9_fact_sales": _table("fact_sales", ("sale_id",)),
        "L9_fact_cancellations": _table("fact_cancellations", ("cancel_id",)),
        "L9_fact_adjustment": _table("fact_adjustment", ("adjustment_id",)),
        "L10_fact_non_sale": _table("fact_non_sale", ("non_sale_id", "row_hash")),
        "L11_audit_table": _table("data_quality_potential_duplicates", ("quality_issue_id",)),
        "L12_validation": _validation,
        "L13_integrity": lambda s, sf: audit_integrity(warehouse_for(s, sf)),
        "L13_planted_violations": _violations,
        "L14_ids": _ids,
        "L15_incremental_sales": _incremental_fact("fact_sales", "sale_id"),
        "L15_incremental_non_sales": _incremental_fact("fact_non_sale", "non_sale_id", "row_hash"),
        "L15_incremental_audit": _audit_of(_loaded_in_parts),
        "L15_incremental_cancellations": _incremental_fact("fact_cancellations", "cancel_id"),
        "L15_incremental_adjustments": _incremental_fact("fact_adjustment", "adjustment_id"),
        "L15_resumed_sales": _incremental_fact("fact_sales", "sale_id", loaded=_resumed),
        "L15_after_reset_audit": _audit_of(_after_reset),
        "L15_groups_across_months": _audit_of(_across_months),
        "S9_published_views": _published,
        "S10_single_file_export": _exported,
        "S1_S2_raw_files": _raw_files,
        "S1_quoted_line_ends": lambda s, sf: _raw_files(s, sf, ' two\n\n"lines",\nend', multi_line=True),
        "T1_T2_types": _types,
        "R1_global_rank": _rank,
        "R1_ntile": _ntile,
        "P2_missing": lambda s, sf: P.missing_values(_raw(s, sf)),
        "P3_duplicate_rows": lambda s, sf: P.duplicate_row_count(_raw(s, sf)),
        "P6_distinct_counts": lambda s, sf: P.distinct_counts(_raw(s, sf)),
        "P8_sign_checks": lambda s, sf: P.sign_checks(_raw(s, sf)),
        "P13_date_range": lambda s, sf: P.date_range(_raw(s, sf)),
        "P14_slices": lambda s, sf: P.predicate_slices(_raw(s, sf)),
        "P16_class_counts": lambda s, sf: P.rows_per_class(_raw(s, sf)),
        "P17_clusters": lambda s, sf: P.within_invoice_clusters(_raw(s, sf)),
        "P19_cluster_summary": lambda s, sf: P.cluster_summary(_raw(s, sf)),
        "P1_shape": lambda s, sf: P.shape(_raw(s, sf)),
        "P4_duplicate_members": lambda s, sf: P.duplicate_members(_raw(s, sf)),
        "P5_column_profile": lambda s, sf: P.column_profile(_raw(s, sf)),
        "P7_distinct_countries": lambda s, sf: P.distinct_values(_raw(s, sf), "Country"),
        "P10_hidden_remainder": lambda s, sf: P.hidden_negative_remainder(_raw(s, sf)),
        "P18_cross_invoice_spans": lambda s, sf: P.cross_invoice_spans(_raw(s, sf)),
        "T3_classify": lambda s, sf: _raw(s, sf),
        "D1_largest_baskets": lambda s, sf: DG.largest_baskets(warehouse_for(s, sf)),
        "D2_basket_pair_counts": lambda s, sf: DG.basket_pair_counts(warehouse_for(s, sf)),
        "D3_duplicate_flag_check": lambda s, sf: DG.duplicate_flag_check(warehouse_for(s, sf)),
        "D4_view_invariants": lambda s, sf: DG.view_invariants(warehouse_for(s, sf)),
        "T4_exact_duplicates": _exact_flags,
        "P9_hidden_negatives": lambda s, sf: P.hidden_negatives(_raw(s, sf)),
        "P12_cancellation_gaps": lambda s, sf: P.cancellation_gaps(_raw(s, sf)),
        "P15_zero_value_descriptions": lambda s, sf: P.value_frequencies(
            _raw(s, sf).filter((F.col("Quantity") > 0) & (F.col("UnitPrice") == 0)), "Description"),
        "P20_ids_whole": lambda s, sf: P.ids_whole(_raw(s, sf)),
        "P21_candidate_key": lambda s, sf: P.candidate_key_check(_clean_lines(s, sf)),
        "P22_stock_codes": lambda s, sf: P.stock_code_checks(
            _clean_lines(s, sf).filter(F.col("kind") == "sales")),
        "P23_post_split": lambda s, sf: P.post_split_audit(_clean_lines(s, sf)),
        "P24_sale_in_adjustments": lambda s, sf: P.sale_rows_in_adjustments(_clean_lines(s, sf)),
    }


def _clean_lines(spark: SparkSession, sf: str) -> DataFrame:
    from ..operators.dims import clean
    return clean(processed_for(spark, sf).lines)


_RAW = "SELECT * EXCLUDE (" + O._ORD + ") FROM cl"


def oracle_sql() -> dict[str, str]:
    return {
        "T3_classify": O.sql(_RAW),
        "D1_largest_baskets": O.sql("""WITH lines AS (SELECT DISTINCT invoice_no, stock_code FROM fact_sales),
            sized AS (SELECT invoice_no, COUNT(stock_code) AS distinct_products FROM lines GROUP BY ALL)
            SELECT * FROM sized QUALIFY row_number() OVER (ORDER BY distinct_products DESC, invoice_no) <= 5"""),
        "D2_basket_pair_counts": O.sql("""SELECT COUNT(*) AS invoices, COUNT(*) FILTER (WHERE n > 100) AS invoices_over_cap,
            MAX(n) AS largest_basket, CAST(SUM(n * (n - 1) // 2) AS BIGINT) AS pairs_uncapped,
            CAST(SUM(CASE WHEN n <= 100 THEN n * (n - 1) // 2 ELSE 0 END) AS BIGINT) AS pairs_capped
            FROM (SELECT invoice_no, COUNT(DISTINCT stock_code) AS n FROM fact_sales GROUP BY invoice_no)"""),
        "D3_duplicate_flag_check": O.sql("""SELECT COUNT(*) AS flagged_rows,
            COUNT(DISTINCT (invoice_no, stock_code, quantity)) AS clusters,
            COUNT(*) FILTER (WHERE duplicate_group_count <> a) AS mismatched_rows,
            COUNT(*) FILTER (WHERE a = 1) AS clusters_of_one
            FROM (SELECT *, COUNT(*) OVER (PARTITION BY invoice_no, stock_code, quantity) AS a FROM dq)"""),
        "D4_view_invariants": O.sql("""SELECT
            (SELECT COUNT(*) FROM (SELECT dp.description, SUM(fc.quantity) AS t FROM fact_cancellations fc
               LEFT JOIN dim_product dp ON fc.stock_code = dp.stock_code GROUP BY dp.description) WHERE t < 0)
               AS negative_cancelled_totals,
            (SELECT COUNT(DISTINCT country_key) FROM fact_sales) AS rate_countries,
            (SELECT COUNT(*) FROM (SELECT DISTINCT fs.country_key FROM fact_sales fs
               JOIN dim_country dc ON fs.country_key = dc.country_key)) AS named_rate_countries,
            (SELECT COUNT(DISTINCT dc.country) FROM fact_sales fs JOIN dim_country dc
               ON fs.country_key = dc.country_key) AS revenue_countries"""),
        "T4_exact_duplicates": O.sql(f"""
            SELECT TransactionType, rn > 1 AS IsExactDuplicate, COUNT(*) AS rows FROM
              (SELECT *, row_number() OVER (PARTITION BY InvoiceNo, StockCode, Description, Quantity, InvoiceDate,
                      UnitPrice, CustomerID, Country ORDER BY {O._ORD}) AS rn FROM cl)
            GROUP BY TransactionType, rn > 1"""),
        "T13_routing": O.sql("""
            SELECT kind, TransactionType, OriginalType, sub_rank, COUNT(*) AS rows,
                   CAST(SUM(Quantity) AS BIGINT) AS quantity, CAST(SUM(SignedQuantity) AS BIGINT) AS signed_quantity,
                   COUNT(*) FILTER (WHERE is_pot) AS flagged,
                   CAST(SUM(CAST(revenue AS DECIMAL(12,2))) AS DOUBLE) AS revenue
            FROM tx GROUP BY kind, TransactionType, OriginalType, sub_rank"""),
        "L3_dim_product": O.sql("SELECT * FROM dim_product"),
        "L4_dim_customer": O.sql("SELECT * FROM dim_customer"),
        "L5_dim_country": O.sql("SELECT * FROM dim_country"),
        "L6_dim_date": O.sql("SELECT * FROM dim_date"),
        "L9_fact_sales": O.sql("SELECT * REPLACE (CAST(unit_price AS DOUBLE) AS unit_price, "
                               "CAST(revenue AS DOUBLE) AS revenue) FROM fact_sales"),
        "L9_fact_cancellations": O.sql("SELECT * REPLACE (CAST(unit_price AS DOUBLE) AS unit_price, "
                                       "CAST(revenue AS DOUBLE) AS revenue) FROM fact_cancellations"),
        "L9_fact_adjustment": O.sql("SELECT * REPLACE (CAST(unit_price AS DOUBLE) AS unit_price, "
                                    "CAST(revenue AS DOUBLE) AS revenue) FROM fact_adjustment"),
        "L10_fact_non_sale": O.sql("SELECT * REPLACE (CAST(unit_price AS DOUBLE) AS unit_price) FROM fact_non_sale"),
        "L11_audit_table": O.sql("SELECT * REPLACE (CAST(unit_price AS DOUBLE) AS unit_price) FROM dq"),
        "L12_validation": O.sql("""SELECT CASE kind WHEN 'sales' THEN 'fact_sales' WHEN 'cancellations' THEN 'fact_cancellations'
              WHEN 'adjustments' THEN 'fact_adjustment' WHEN 'non_sales' THEN 'fact_non_sales' END AS "table", COUNT(*) AS rows,
            COUNT(*) FILTER (WHERE Country IS NULL OR Country >= 'J') AS missing_country_keys,
            COUNT(*) FILTER (WHERE Quantity % 7 = 0) AS missing_date_keys FROM tx GROUP BY ALL"""),
        "L13_integrity": O.sql(_integrity_sql()),
        "L13_planted_violations": O.sql(_planted_sql()),
        "L14_ids": O.sql(" UNION ALL ".join(f"SELECT '{n}' AS table_name, COUNT(*) AS rows, CAST(1 AS BIGINT) AS rows_per_id, true AS positive FROM {t}"
                                           for n, t in _ID_TABLES.items())),
        **{key: O.sql(f"""SELECT f.* EXCLUDE (country_key) REPLACE (CAST(unit_price AS DOUBLE) AS unit_price,
            CAST(revenue AS DOUBLE) AS revenue), country FROM {fact} f JOIN dim_country USING (country_key)""")
           for key, fact in (("L15_incremental_sales", "fact_sales"), ("L15_resumed_sales", "fact_sales"),
                             ("L15_incremental_cancellations", "fact_cancellations"), ("L15_incremental_adjustments", "fact_adjustment"))},
        "L15_incremental_non_sales": O.sql("""SELECT f.* EXCLUDE (country_key) REPLACE (CAST(unit_price AS DOUBLE) AS unit_price),
            country FROM fact_non_sale f JOIN dim_country USING (country_key)"""),
        "L15_incremental_audit": O.sql("SELECT * REPLACE (CAST(unit_price AS DOUBLE) AS unit_price) FROM dq"),
        "L15_after_reset_audit": O.sql("SELECT * REPLACE (CAST(unit_price AS DOUBLE) AS unit_price) FROM dq"),
        "L15_groups_across_months": O.sql("SELECT * REPLACE (CAST(unit_price AS DOUBLE) AS unit_price) FROM dq", moved=True),
        "S9_published_views": O.sql(f"""SELECT r.*, o.number_of_orders FROM ({O.VIEW_SQL['V24']}) r
            JOIN (SELECT customer_id, COUNT(DISTINCT invoice_no) AS number_of_orders FROM fact_sales GROUP BY ALL) o USING (customer_id)"""),
        "S10_single_file_export": O.sql("""SELECT customer_id, COUNT(DISTINCT invoice_no) AS number_of_orders
            FROM fact_sales WHERE customer_id IS NOT NULL GROUP BY ALL"""),
        "S1_S2_raw_files": O.sql("""SELECT InvoiceNo, StockCode, Description || ' 36" wide, "large" \\' AS Description,
            Quantity, InvoiceDate, UnitPrice, CustomerID, Country FROM raw"""),
        "S1_quoted_line_ends": O.sql("""SELECT InvoiceNo, StockCode, Description || ' two' || chr(10) || chr(10) || '"lines",' || chr(10) || 'end' AS Description,
            Quantity, InvoiceDate, UnitPrice, CustomerID, Country FROM raw"""),
        "T1_T2_types": O.sql("""SELECT CASE WHEN Quantity % 4 IN (0, 1, 2) THEN InvoiceDate END AS InvoiceDate,
            CASE WHEN Quantity % 4 <> 2 THEN CustomerID END AS CustomerID, COUNT(*) AS rows FROM raw GROUP BY ALL"""),
        "R1_global_rank": O.sql("""
            SELECT customer_id, row_number() OVER (ORDER BY r DESC NULLS FIRST, customer_id) AS rank
            FROM (SELECT customer_id, SUM(revenue) AS r FROM fact_sales WHERE customer_id IS NOT NULL
                  GROUP BY customer_id)"""),
        "R1_ntile": O.sql("""
            SELECT stock_code, CAST(NTILE(7) OVER (ORDER BY q DESC NULLS FIRST, stock_code) AS INT) AS tile
            FROM (SELECT stock_code, SUM(quantity) AS q FROM fact_sales GROUP BY stock_code)"""),
        **P.oracle_sql(lambda body: O.sql(f"WITH r AS ({_RAW}) {body}" if not body.strip().upper().startswith("WITH")
                                          else f"WITH r AS ({_RAW}), {body.strip()[4:]}")),
    }


_ID_TABLES = {"fact_sales": "fact_sales", "fact_cancellations": "fact_cancellations", "fact_adjustment": "fact_adjustment",
              "fact_non_sale": "fact_non_sale", "data_quality_potential_duplicates": "dq"}


def _planted_sql() -> str:
    """What ``_violations`` plants, counted from its definition."""
    orphans = " UNION ALL ".join(f"SELECT '{f}' AS table_name, 'foreign_key' AS check_type, 'customer_id' AS column_name, "
                                 f"COUNT(*) AS violations FROM {f} WHERE customer_id % 7 = 0" for f in FACT_TABLES)
    return f"""SELECT * FROM ({orphans} UNION ALL
        SELECT 'dim_product', 'unique', 'stock_code', 2 * COUNT(*) FROM dim_product WHERE ends_with(stock_code, '7') UNION ALL
        SELECT 'fact_cancellations', 'not_null', 'stock_code', COUNT(*) FROM fact_cancellations WHERE quantity % 5 = 0) WHERE violations > 0"""


def _integrity_sql() -> str:
    """The constraint audit over the oracle's tables (ids and non-sale hashes
    do not exist there; those unique checks are 0 by construction)."""
    tables = {"data_quality_potential_duplicates": "dq"}
    parts = []
    for fact, col, dim, dcol in FOREIGN_KEYS:
        parts.append(f"""SELECT '{fact}' AS table_name, 'foreign_key' AS check_type, '{col}' AS column_name,
            COUNT(*) AS violations FROM {fact} f WHERE f.{col} IS NOT NULL
            AND NOT EXISTS (SELECT 1 FROM {dim} d WHERE d.{dcol} = f.{col})""")
    for table, col in UNIQUE_KEYS:
        if col.endswith("_id") and col != "customer_id" or (table == "fact_non_sale" and col == "row_hash"):
            parts.append(f"SELECT '{table}', 'unique', '{col}', CAST(0 AS BIGINT)")
            continue
        parts.append(f"""SELECT '{table}', 'unique', '{col}', CAST(COALESCE(SUM(n), 0) AS BIGINT) FROM
            (SELECT COUNT(*) AS n FROM {tables.get(table, table)} WHERE {col} IS NOT NULL GROUP BY {col} HAVING COUNT(*) > 1)""")
    for fact, col in NOT_NULL:
        parts.append(f"SELECT '{fact}', 'not_null', '{col}', COUNT(*) FILTER (WHERE {col} IS NULL) FROM {fact}")
    return " UNION ALL ".join(parts)
