"""The star schema: build it lazily, load it idempotently, open it."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, fields
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas as S
from ..operators import dims as D
from ..operators import facts as X
from ..operators import quality as Q
from ..operators.transform import Processed
from ..session import COMPRESSION, drop_path, scratch_path, shuffles_dropped
from . import snapshots as V


@dataclass
class Warehouse:
    dim_product: DataFrame
    dim_customer: DataFrame
    dim_country: DataFrame
    dim_date: DataFrame
    fact_sales: DataFrame
    fact_cancellations: DataFrame
    fact_adjustment: DataFrame
    fact_non_sale: DataFrame
    data_quality_potential_duplicates: DataFrame
    path: str | None = None  # set when opened from written tables
    by_month: dict[str, DataFrame] | None = None  # then also: tables with their partition column

    def tables(self) -> dict[str, DataFrame]:
        return {f.name: getattr(self, f.name) for f in fields(self) if f.name not in ("path", "by_month")}


# Facts are stored partitioned by month (date_key div 100). A row hash covers
# the invoice timestamp, so a batch row can only conflict with existing rows
# of its own month: insert-ignore reads just the months the batch touches.
MONTH = "month_key"
AUDIT = "data_quality_potential_duplicates"
FACT_TABLES = ["fact_sales", "fact_cancellations", "fact_adjustment", "fact_non_sale"]
PARTITIONED = FACT_TABLES + [AUDIT]


FACT_KINDS = {  # table -> (processed kind, id column)
    "fact_sales": ("sales", "sale_id"),
    "fact_cancellations": ("cancellations", "cancel_id"),
    "fact_adjustment": ("adjustments", "adjustment_id"),
}


class ValidationError(ValueError):
    pass


FACT_OF_KIND = {"sales": "fact_sales", "cancellations": "fact_cancellations",
                "adjustments": "fact_adjustment", "non_sales": "fact_non_sales"}


def validation_report(keyed: DataFrame) -> DataFrame:
    """Rows, missing country keys and missing date keys per fact table, in
    one pass over the keyed lines, with the months present and their rows (at
    most one value per calendar month)."""
    table = F.lit(None).cast("string")
    for kind, name in FACT_OF_KIND.items():
        table = F.when(F.col("kind") == kind, F.lit(name)).otherwise(table)
    monthly = keyed.select(table.alias("table"), (F.col("date_key") / 100).cast("int").alias("month"), "country_key", "date_key") \
        .groupBy("table", "month").agg(
            F.count(F.lit(1)).alias("rows"),
            F.count_if(F.col("country_key").isNull()).alias("missing_country_keys"),
            F.count_if(F.col("date_key").isNull()).alias("missing_date_keys"))
    return monthly.groupBy("table").agg(
        *[F.sum(c).alias(c) for c in ("rows", "missing_country_keys", "missing_date_keys")],
        F.collect_list(F.when(F.col("month").isNotNull(), F.struct("month", "rows"))).alias("months"))


def validate_facts(keyed: DataFrame) -> dict[str, dict[int, int]]:
    """The months of the keyed lines and their rows, per fact table; raises,
    naming the first table with a missing key."""
    rows = validation_report(keyed).collect()  # one row per fact table
    for r in rows:
        if r["missing_country_keys"]:
            raise ValidationError(f"{r['table']}: {r['missing_country_keys']} of {r['rows']} rows have no country key")
        if r["missing_date_keys"]:
            raise ValidationError(f"{r['table']}: {r['missing_date_keys']} of {r['rows']} rows have no date key")
    return {r["table"]: {m["month"]: m["rows"] for m in r["months"]} for r in rows}


def _months(keyed: DataFrame) -> list[int]:
    """Months present in a batch: at most one value per calendar month."""
    return [r[0] for r in keyed.select((F.col("date_key") / 100).cast("int").alias("m"))
            .filter(F.col("m").isNotNull()).distinct().collect()]


@dataclass
class DimensionRows:
    dim_product: DataFrame
    dim_customer: DataFrame
    dim_country: DataFrame
    dim_date: DataFrame


def _tx(processed: Processed) -> DataFrame:
    return D.all_transactions(D.clean(processed.lines))


def stage_dimensions(processed: Processed, existing: Warehouse | None = None,
                     dim_country: DataFrame | None = None) -> DimensionRows:
    """New dimension rows (L3-L6), insert-ignore against ``existing``. Numbering
    the new countries is a job of its own, unless ``dim_country`` holds them."""
    tx, old = _tx(processed), existing
    # Each is one row per key by its own aggregate.
    return DimensionRows(
        dim_product=X.not_in(D.dim_product(tx), old and old.dim_product, ["stock_code"]),
        dim_customer=X.not_in(D.dim_customer(tx), old and old.dim_customer, ["customer_id"]),
        dim_country=dim_country if dim_country is not None else D.new_countries(tx, old and old.dim_country),
        dim_date=X.not_in(D.dim_date(tx), old and old.dim_date, ["date_key"]),
    )


def stage(processed: Processed, existing: Warehouse | None = None,
          validate: bool = True, dim_country: DataFrame | None = None) -> Warehouse:
    """Rows each table receives from ``processed`` (L15 without the writes and the ids).

    Dimensions and facts are insert-ignore against ``existing``; the audit
    rows are those of ``processed``. With ``existing=None`` the result *is*
    the warehouse. ``dim_country`` is the full country dimension to key facts
    with (by default: existing rows plus the new ones, which are numbered at once).
    """
    if dim_country is None:
        dims = stage_dimensions(processed, existing)
        known = dims.dim_country if existing is None else existing.dim_country.unionByName(dims.dim_country)
        return Warehouse(**vars(dims), **stage_facts(processed, known, existing, validate))
    fresh = dim_country if existing is None else dim_country.join(existing.dim_country.select("country"), "country", "left_anti")
    dims = stage_dimensions(processed, existing, fresh)
    return Warehouse(**vars(dims), **stage_facts(processed, dim_country, existing, validate))


def stage_facts(processed: Processed, dim_country: DataFrame, existing: Warehouse | None = None,
                validate: bool = True, by_range: bool = False) -> dict[str, DataFrame]:
    """The rows of the facts and the audit table. ``by_range``: equal rows (of
    the batch and, in a later load, of the existing months) are found in runs
    of months, so what is written by month needs no shuffle of its own; these
    tables carry their month, and their row hash as bytes (``_numbered`` writes
    it as text)."""
    tx, old = _tx(processed), existing
    keyed = X.with_keys(tx, dim_country)
    seen = validate_facts(keyed) if validate else None
    months = None
    if old is not None and old.path:
        months = sorted({m for sizes in seen.values() for m in sizes}) if seen is not None else _months(keyed)

    def target_of(table: str) -> DataFrame | None:
        """Existing rows that a row of the batch can conflict with."""
        if months is None:
            return None if old is None else getattr(old, table)
        return old.by_month[table].filter(F.col(MONTH).isin(months)).drop(MONTH)

    facts: dict[str, DataFrame] = {}
    for table, (kind, id_col) in FACT_KINDS.items():
        rows = X.standard_fact(keyed.filter(F.col("kind") == kind))
        columns = [c for c in S.WAREHOUSE_SCHEMAS[table].fieldNames() if c != id_col]
        if by_range and seen is not None and (old is None or months is not None):
            present = None if old is None else old.by_month[table].filter(F.col(MONTH).isin(months))
            facts[table] = _first_by_month(rows, seen.get(table, {}), present).select(*columns, MONTH)
        else:
            facts[table] = X.insert_ignore(rows, target_of(table), ["row_hash"], ["sub_rank", "_ord"]).select(*columns)
    ns = X.non_sale_fact(keyed.filter(F.col("kind") == "non_sales"))
    facts["fact_non_sale"] = X.multiset_insert(ns, target_of("fact_non_sale"), X.NON_SALE_COLUMNS)
    facts[AUDIT] = X.audit_rows(D.clean(processed.audit))
    return facts


#: Rows of a fact that make a write task of their own.
_TASK_ROWS = 100_000


def _first_by_month(rows: DataFrame, sizes: dict[int, int], present: DataFrame | None = None) -> DataFrame:
    """One row per row hash that ``present`` (existing rows with their month)
    does not hold, the first by file order, dealt to the tasks in even runs of
    months (``sizes``: rows per month, as validation has counted them, so
    nothing is sampled) and sorted by month and hash. Equal hashes have equal
    timestamps, so equal months. Hashes move as 16 bytes; of existing rows
    nothing else moves but the timestamp."""
    rows = rows.withColumn(MONTH, (F.col("date_key") / 100).cast("int"))
    if present is not None:
        sizes = dict(sizes)
        for m, n in present.groupBy(MONTH).count().collect():  # a calendar's worth
            sizes[m] = sizes.get(m, 0) + n
        there = present.select("row_hash", "invoice_date", MONTH, F.lit(True).alias("_there"))
        rows = rows.withColumn("_there", F.lit(False)).unionByName(there, allowMissingColumns=True)
    total = max(sum(sizes.values()), 1)
    tasks = min(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // _TASK_ROWS))
    known, before = sorted(sizes), 0
    starts = []
    for m in known:
        starts.append(before)
        before += sizes[m]
    at = lambda values: F.element_at(F.map_from_arrays(F.lit(known), F.lit(values)), F.col(MONTH))
    share = F.pmod(F.xxhash64("row_hash"), F.lit(1 << 20)) / F.lit(float(1 << 20))  # the row's place in its month
    place = F.floor((at(starts) + share * at([sizes[m] for m in known])) * F.lit(tasks / total)).cast("int")
    task = F.greatest(F.least(place, F.lit(tasks - 1)), F.lit(0)) if known else F.lit(0)
    dealt = (rows.withColumn("row_hash", F.unhex("row_hash")).withColumn("_task", task)
             .drop("date_key", MONTH).repartitionById(tasks, "_task").withColumn(MONTH, month_of("invoice_date")))
    rest = [c for c in dealt.columns if c not in ("row_hash", MONTH, "_task", "sub_rank", "_ord", "_there")]
    first = F.min_by(F.struct(*rest), F.struct("sub_rank", "_ord")).alias("_row")
    keys = dealt.groupBy(MONTH, "row_hash", "_task")
    new = keys.agg(first) if present is None else keys.agg(first, F.bool_or("_there").alias("_there")).filter(~F.col("_there"))
    return new.select(MONTH, "row_hash", "_row.*").withColumn("date_key", X.date_key(F.col("invoice_date")))


def _conform(df: DataFrame, name: str, *extra: str) -> DataFrame:
    schema = S.WAREHOUSE_SCHEMAS[name]
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields], *extra)


def _files(spark: SparkSession, path: str, name: str, schema: T.StructType, snapshot: V.Snapshot,
           months: list[int] | None = None) -> DataFrame:
    """The rows of a table's files in one version (of some months only)."""
    files = snapshot.paths(path, name, None if months is None else {f"{MONTH}={m}" for m in months})
    if not files:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", f"{path}/{name}").parquet(*files)


def read_table(spark: SparkSession, path: str, name: str, with_partition: bool = False,
               snapshot: V.Snapshot | None = None) -> DataFrame:
    """One written table with its declared schema, as of ``snapshot`` (by
    default the newest version); fact tables carry the ``month_key``
    partition column only when asked for (partition pruning)."""
    schema = S.WAREHOUSE_SCHEMAS[name]
    snapshot = snapshot or V.current(spark, path) or V.Snapshot()
    if name not in PARTITIONED:
        return _files(spark, path, name, schema, snapshot)
    full = T.StructType(list(schema.fields) + [T.StructField(MONTH, T.IntegerType())])
    df = _files(spark, path, name, full, snapshot)
    return df if with_partition else df.select(*schema.fieldNames())


def open_warehouse(spark: SparkSession, path: str, snapshot: V.Snapshot | None = None) -> Warehouse:
    """The nine tables of a written warehouse, all of one version. Tables
    without files (nothing was ever published, or the table is empty) read as empty."""
    snapshot = snapshot or V.current(spark, path) or V.Snapshot()
    tables = {n: read_table(spark, path, n, with_partition=True, snapshot=snapshot) for n in S.WAREHOUSE_SCHEMAS}
    return Warehouse(path=path, by_month={n: tables[n] for n in PARTITIONED},
                     **{n: df.select(*S.WAREHOUSE_SCHEMAS[n].fieldNames()) for n, df in tables.items()})


def _read_or_empty(spark: SparkSession, path: str, name: str,
                   with_partition: bool = False) -> DataFrame | None:
    return read_table(spark, path, name, with_partition) if V.exists(spark, path) else None


def try_open(spark: SparkSession, path: str) -> Warehouse | None:
    """The warehouse at ``path``, or None when no load was ever published there."""
    return open_warehouse(spark, path) if V.exists(spark, path) else None


ID_COLUMNS = {name: schema.fieldNames()[0] for name, schema in S.WAREHOUSE_SCHEMAS.items() if name in PARTITIONED}


def _numbered(rows: DataFrame, name: str, start_after: int) -> DataFrame:
    """Rows ready for a month-partitioned write, with surrogate ids.

    The REBALANCE hint shuffles by month so each task writes few month
    folders, and AQE splits a month that is too large into several tasks (and
    merges small ones). Ids come after that shuffle, in a fixed order within
    the writing task: nothing is moved afterwards, and only one attempt of a
    task is committed, so a lost executor cannot make an id repeat. Rows that
    come with their month (``_first_by_month``) are dealt already.
    """
    day = X.date_key(F.col("invoice_date")) if name == AUDIT else F.col("date_key")
    order = "row_hash" if name != AUDIT else "invoice_no"
    if MONTH in rows.columns:
        dealt = rows.sortWithinPartitions(MONTH, order)  # as the aggregate leaves them
        numbered = X.with_ids(dealt, ID_COLUMNS[name], start_after).withColumn("row_hash", F.lower(F.hex("row_hash")))
    else:
        dealt = rows.withColumn(MONTH, (day / 100).cast("int")).hint("rebalance", MONTH).sortWithinPartitions(MONTH, order)
        numbered = X.with_ids(dealt, ID_COLUMNS[name], start_after)
    return _conform(numbered, name, MONTH)


def _write_all(jobs: list[tuple[DataFrame, str, str]], parallel: int = 4) -> dict[str, tuple[int, int]]:
    """Independent table writes submitted as concurrent Spark jobs (the
    scheduler interleaves their tasks); errors propagate. Returns the rows
    and the largest id that each write reports."""
    def one(job):
        df, mode, target = job
        name = target.rsplit("/", 1)[-1]
        seen = Observation(name)
        top = F.max(ID_COLUMNS[name]) if name in ID_COLUMNS else F.max(F.lit(0))
        w = df.observe(seen, F.count(F.lit(1)).alias("rows"), F.coalesce(top, F.lit(0)).cast("long").alias("top")).write.mode(mode)
        if MONTH in df.columns:
            w = w.option("partitionOverwriteMode", "dynamic").partitionBy(MONTH)
        w.option("compression", COMPRESSION).parquet(target)
        return name, (seen.get["rows"], seen.get["top"])
    with ThreadPoolExecutor(max_workers=parallel) as pool:
        return dict(f.result() for f in [pool.submit(one, j) for j in jobs])


DIMENSIONS = ["dim_product", "dim_customer", "dim_country", "dim_date"]
FACTS = FACT_TABLES

LINES = "_lines"
GROUPS = "_line_groups"
GROUP_HASH = "group_hash"
_GROUPS_SCHEMA = T.StructType([T.StructField(GROUP_HASH, T.LongType()), T.StructField(MONTH, T.IntegerType())])
#: Columns that make two lines exact copies (T5), as processed lines hold them.
_IDENTITY = ["InvoiceNo", "StockCode", "Description", "SignedQuantity", "InvoiceDate", "UnitPrice", "CustomerID", "Country", "OriginalType"]
_GROUP = ["InvoiceNo", "StockCode", "SignedQuantity"]


def month_of(timestamp: str) -> Column:
    return (X.date_key(F.col(timestamp)) / 100).cast("int")


def _line_key() -> Column:
    """The digest of a line's identity."""
    return F.md5(F.to_json(F.struct(*_IDENTITY), {"ignoreNullFields": "false"}))


def _grouped(lines: DataFrame) -> DataFrame:
    return lines.withColumn(GROUP_HASH, F.xxhash64(*_GROUP))


def _keyed_lines(lines: DataFrame) -> DataFrame:
    """Processed lines with their group's hash and their month."""
    return _grouped(lines).withColumn(MONTH, month_of("InvoiceDate"))


def _touched(spark: SparkSession, path: str, snapshot: V.Snapshot, groups: DataFrame) -> DataFrame:
    """The stored groups (group_hash, month) that are among ``groups``: a join
    with the narrow index; lines are not read. (A Bloom filter of each month
    would let nearly all months through as soon as a batch has some hundred
    groups, so there is none.)"""
    return _files(spark, path, GROUPS, _GROUPS_SCHEMA, snapshot).join(groups, GROUP_HASH, "left_semi")


def touched_months(spark: SparkSession, path: str, snapshot: V.Snapshot, groups: DataFrame) -> list[int]:
    """Months that hold stored lines of any of ``groups`` (column group_hash)."""
    return [r[0] for r in _touched(spark, path, snapshot, groups).select(MONTH).distinct().collect()]  # a calendar's worth


#: log2 of the most bits that stand for the groups a batch shares with the stored lines (16 MB).
MARK_BITS = 27


def _mark_bits(groups: int) -> int:
    return max(15, min(MARK_BITS, (64 * max(groups, 1)).bit_length()))


def _mark_place(bits: int) -> Column:
    return F.shiftrightunsigned(F.col(GROUP_HASH), 64 - bits) + 1


def _marks(hashes: DataFrame, bits: int) -> DataFrame:
    """Bitmaps of 4 KB that stand for the group hashes, at most ``2 ** MARK_BITS`` bits together."""
    return hashes.select(_mark_place(bits).alias("_place")).groupBy(F.bitmap_bucket_number("_place").alias("_bucket")) \
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("_place")).alias("_bitmap"))


def _may_share(rows: DataFrame, marks: DataFrame, bits: int) -> DataFrame:
    """``rows`` (with their group's hash) and ``_may``: false only for rows whose group is not marked."""
    at = rows.withColumns({"_bucket": F.bitmap_bucket_number(_mark_place(bits)),
                           "_bit": F.bitmap_bit_position(_mark_place(bits)).cast("int")})
    byte = "cast(conv(hex(substring(_bitmap, _bit div 8 + 1, 1)), 16, 10) as int)"
    may = F.expr(f"coalesce(shiftright({byte}, _bit % 8) & 1, 0) = 1")
    return at.join(F.broadcast(marks), "_bucket", "left").withColumn("_may", may).drop("_bucket", "_bit", "_bitmap")


def _stored_lines(spark: SparkSession, path: str, snapshot: V.Snapshot, months: list[int], like: DataFrame) -> DataFrame:
    schema = T.StructType([f for f in like.schema.fields if f.name != MONTH] + [T.StructField(MONTH, T.IntegerType())])
    return _files(spark, path, LINES, schema, snapshot, months)


#: What the audit table is made of.
_AUDITED = ["InvoiceNo", "StockCode", "Quantity", "Description", "InvoiceDate", "UnitPrice", "CustomerID", "Country",
            "TransactionType", "issue_type", "duplicate_group_count"]


def _against_stored(spark: SparkSession, processed: Processed, path: str, snapshot: V.Snapshot,
                    scratch: str | None = None) -> tuple[Processed, DataFrame]:
    """The batch's lines that are not stored yet, with the audit rows of all
    groups (invoice, code, quantity) they belong to; and the keys of the groups
    that had stored lines.

    An exact copy of a line is in its group too, so only groups that the index
    holds can have stored lines. Lines of all other groups stay where they are,
    with the batch's own flags: bitmaps of bounded size tell them apart, and
    the few of another group that pass as well are compared like the rest.
    The lines that pass meet the stored lines of such groups, read from the
    months that hold them, whichever these are: known copies are left out (the
    rest is written to ``scratch`` once), and the groups' audit rows are
    recomputed over stored and new lines.
    """
    scratch = scratch or scratch_path(spark, "load")
    _touched(spark, path, snapshot, _grouped(processed.lines).select(GROUP_HASH).distinct()) \
        .write.option("compression", COMPRESSION).parquet(f"{scratch}/touched")
    touched = spark.read.schema(_GROUPS_SCHEMA).parquet(f"{scratch}/touched")
    months = [r[0] for r in touched.select(MONTH).distinct().collect()]  # a calendar's worth
    bits = _mark_bits(touched.count())
    marks = _marks(touched, bits)
    marks.write.parquet(f"{scratch}/marks")
    marks = spark.read.schema(marks.schema).parquet(f"{scratch}/marks")

    batch = _may_share(_grouped(processed.lines), marks, bits)
    stored = _stored_lines(spark, path, snapshot, months, processed.lines.select(*_IDENTITY))
    stored = _may_share(_grouped(stored), marks, bits).filter("_may").select(*_IDENTITY)
    # Digests move as 16 bytes.
    known = stored.select(F.unhex(_line_key()).alias("_known"))
    met = batch.filter("_may").select(*processed.lines.columns)
    met = met.withColumn("_key", F.unhex(_line_key())).join(known, F.col("_key") == F.col("_known"), "left_anti").drop("_key")
    met.write.option("compression", COMPRESSION).parquet(f"{scratch}/lines")
    met = spark.read.schema(met.schema).parquet(f"{scratch}/lines")
    groups = met.select(*[F.col(c).alias(f"_{c}") for c in _GROUP]).distinct()
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in _GROUP])
    around = stored.join(groups, same, "left_semi").unionByName(met.select(*_IDENTITY))
    flagged = Q.flag_potential_duplicates(around.withColumnRenamed("SignedQuantity", "Quantity"))
    audit = Q.potential_duplicates(flagged.withColumnRenamed("OriginalType", "TransactionType"))
    own = _may_share(processed.audit.withColumn(GROUP_HASH, F.xxhash64("InvoiceNo", "StockCode", "Quantity")), marks, bits)
    alone = batch.filter(~F.col("_may")).select(*processed.lines.columns)
    return Processed(lines=alone.unionByName(met), audit=own.filter(~F.col("_may")).select(*_AUDITED).unionByName(audit.select(*_AUDITED))), groups


def _audit_months(old: DataFrame, rows: DataFrame, groups: DataFrame) -> tuple[DataFrame, list[int]]:
    """The audit table's months of ``rows`` after replacing the given groups, and those months."""
    months = [r[0] for r in rows.select((X.date_key(F.col("invoice_date")) / 100).cast("int").alias("m")).distinct().collect()]
    keys = D.clean(groups.select(F.col("_InvoiceNo").alias("InvoiceNo"), F.col("_StockCode").alias("StockCode"),
                                 F.col("_SignedQuantity").alias("quantity"))).withColumnsRenamed({"InvoiceNo": "i", "StockCode": "s", "quantity": "q"})
    gone = F.col("invoice_no").eqNullSafe(F.col("i")) & F.col("stock_code").eqNullSafe(F.col("s")) & F.col("quantity").eqNullSafe(F.col("q"))
    stay = old.filter(F.col(MONTH).isin(months)).drop(MONTH, ID_COLUMNS[AUDIT]).join(keys, gone, "left_anti")
    return stay.unionByName(rows), months


def load(spark: SparkSession, processed: Processed, path: str, fresh: bool = False, keep_lines: bool = True) -> Warehouse:
    """Append new dimension and fact rows (insert-ignore, so loading the
    same input twice changes nothing), bring the audit table up to date, reopen.

    As in the reference, dimensions come first and the facts are keyed from
    the dimension as written. Everything is written into the folder of this
    attempt; one rename publishes all tables as the next version. A load that
    dies at any point before changes nothing, and can be run again.
    Independent tables are written concurrently. ``fresh`` says that ``path``
    is a new, empty folder.

    A later load reads the history's touched months only. The processed lines
    are kept beside the tables (``keep_lines``; without them later loads see
    their own lines only), with an index from groups to months, so exact
    copies are found across loads and the audit rows of every touched group
    are recomputed, in whichever months its lines lie; other audit rows stay.
    ``LAST_LOAD_REPORT`` holds the rows inserted per table, as the writes
    count them.
    """
    with shuffles_dropped(spark):
        _load(spark, processed, path, fresh, keep_lines)
    return open_warehouse(spark, path)


def _load(spark: SparkSession, processed: Processed, path: str, fresh: bool, keep_lines: bool) -> None:
    if not fresh:
        V.sweep(spark, path)
    attempt = V.Attempt(spark, path)
    base = attempt.base
    # After a reset there are no rows to compare with: a first load again.
    existing = open_warehouse(spark, path, base) if any(base.files.values()) else None
    # A history without stored lines stays without: they would be incomplete.
    stored = bool(base.files.get(LINES))
    keep_lines = keep_lines and (stored or not any(base.files.get(n) for n in FACTS))
    groups, scratch = None, scratch_path(spark, "load") if stored else None
    if stored:
        processed, groups = _against_stored(spark, processed, path, base, scratch)

    dims = stage_dimensions(processed, existing)
    # Few rows, many partitions: AQE merges them into few files.
    done = _write_all([(_conform(getattr(dims, n), n).hint("rebalance"), "append", attempt.target(n)) for n in DIMENSIONS])
    countries = spark.read.schema(S.DIM_COUNTRY).parquet(attempt.target("dim_country"))
    if existing is not None:
        countries = existing.dim_country.unionByName(countries)
    rows = stage_facts(processed, countries, existing, by_range=True)
    if groups is not None:
        rows[AUDIT].write.parquet(f"{scratch}/{AUDIT}")
        found = spark.read.schema(rows[AUDIT].schema).parquet(f"{scratch}/{AUDIT}")
        rows[AUDIT], months = _audit_months(existing.by_month[AUDIT], found, groups)
        attempt.replace(AUDIT, {f"{MONTH}={m}" for m in months})
    jobs = [(_numbered(df, n, base.top_ids.get(n, 0)), "append", attempt.target(n)) for n, df in rows.items()]
    if keep_lines:
        # Digests and hashes of stored lines follow from the lines. Repeated entries of the
        # index change no result, so it is not made distinct by a shuffle of its own.
        lines = _keyed_lines(processed.lines)
        jobs.append((lines.select(*_IDENTITY, MONTH).hint("rebalance", MONTH), "append", attempt.target(LINES)))
        jobs.append((lines.select(GROUP_HASH, MONTH).hint("rebalance", MONTH), "append", attempt.target(GROUPS)))
    done |= _write_all(jobs)
    for name, (n, _) in done.items():
        if not n:  # an empty table may still have a file
            drop_path(spark, attempt.target(name))
    attempt.publish({n: r for n, (r, _) in done.items()}, {n: top for n, (r, top) in done.items() if r and n in ID_COLUMNS})
    LAST_LOAD_REPORT.clear()
    LAST_LOAD_REPORT.update({n: done.get(n, (0, 0))[0] for n in S.WAREHOUSE_SCHEMAS})
    if scratch is not None:
        drop_path(spark, scratch)


LAST_LOAD_REPORT: dict[str, int] = {}


def compact(spark: SparkSession, path: str, name: str, months: list[int]) -> None:
    """Rewrite months of a table that many small loads have cut into small
    files: a version of its own. The old files are deleted at once, so open
    warehouses must be opened again."""
    attempt = V.Attempt(spark, path)
    old = read_table(spark, path, name, with_partition=True, snapshot=attempt.base).filter(F.col(MONTH).isin(months))
    _write_all([(old.hint("rebalance", MONTH), "append", attempt.target(name))])
    attempt.replace(name, {f"{MONTH}={m}" for m in months})
    attempt.publish({}, {}, drop_replaced=True)


def build(processed: Processed, validate: bool = True) -> Warehouse:
    """A fresh warehouse as lazy DataFrames (no writes)."""
    staged = stage(processed, None, validate=validate)
    return Warehouse(**{n: _conform(X.with_ids(df, ID_COLUMNS[n]) if n in ID_COLUMNS else df, n) for n, df in staged.tables().items()})


def reset(spark: SparkSession, path: str) -> None:
    """A version in which all nine tables and the stored lines are empty;
    ids start again. The files are deleted, and later loads start afresh."""
    V.sweep(spark, path)
    attempt = V.Attempt(spark, path)
    for name, folders in attempt.base.files.items():
        attempt.replace(name, set(folders))
    attempt.publish({}, dict.fromkeys(ID_COLUMNS, 0), drop_replaced=True)


# Foreign keys and unique keys the reference declares in its DDL; Spark does
# not enforce them, so they are audited.
FOREIGN_KEYS = [
    (fact, col, dim, col)
    for fact in ("fact_sales", "fact_cancellations", "fact_adjustment", "fact_non_sale")
    for col, dim in (("stock_code", "dim_product"), ("customer_id", "dim_customer"),
                     ("country_key", "dim_country"), ("date_key", "dim_date"))
]
UNIQUE_KEYS = [
    ("dim_product", "stock_code"), ("dim_customer", "customer_id"), ("dim_country", "country_key"),
    ("dim_country", "country"), ("dim_date", "date_key"),
    ("fact_sales", "sale_id"), ("fact_sales", "row_hash"),
    ("fact_cancellations", "cancel_id"), ("fact_cancellations", "row_hash"),
    ("fact_adjustment", "adjustment_id"), ("fact_adjustment", "row_hash"),
    ("fact_non_sale", "non_sale_id"), ("fact_non_sale", "row_hash"),
    ("data_quality_potential_duplicates", "quality_issue_id"),
]


NOT_NULL = [(fact, col) for fact in FACT_TABLES for col in ("stock_code", "country_key", "date_key")]


def _key_counts(table: DataFrame, columns: list[str]) -> DataFrame:
    """column_name, key (as text), n: how often each value of each column
    occurs, in one scan. The partial aggregate combines a hot key before the shuffle."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("key")) for c in columns])
    return table.select(F.explode(pairs).alias("p")).select("p.*").groupBy("column_name", "key").agg(F.count(F.lit(1)).alias("n"))


def audit_integrity(wh: Warehouse) -> DataFrame:
    """One row per declared constraint with its number of violating rows.

    Foreign key: non-null fact keys missing from the dimension. Unique key:
    rows whose non-null key value occurs more than once. Not null: rows
    without the key. Each table is scanned once: its keys are counted per
    column and value, and the counts are joined with the dimension's keys.
    """
    t = wh.tables()
    dims = reduce(DataFrame.unionByName, [
        t[dim].select(F.lit(col).alias("column_name"), F.col(col).cast("string").alias("key"))
        for _, col, dim, _ in FOREIGN_KEYS[:4]]).distinct().withColumn("known", F.lit(True))
    parts = []
    for name in t:
        checked = {c: [k for k, pairs in (("foreign_key", [(f, k) for f, k, _, _ in FOREIGN_KEYS]),
                                          ("unique", UNIQUE_KEYS), ("not_null", NOT_NULL)) if (name, c) in pairs]
                   for c in dict.fromkeys([k for f, k, _, _ in FOREIGN_KEYS if f == name] + [k for f, k in UNIQUE_KEYS if f == name])}
        counts = _key_counts(t[name], list(checked)).join(dims, ["column_name", "key"], "left")
        found = F.col("key").isNotNull()
        sums = counts.groupBy("column_name").agg(
            F.sum(F.when(found & F.col("known").isNull(), F.col("n"))).alias("foreign_key"),
            F.sum(F.when(found & (F.col("n") > 1), F.col("n"))).alias("unique"),
            F.sum(F.when(~found, F.col("n"))).alias("not_null"))
        # One row per check also for an empty table.
        wanted = wh.dim_country.sparkSession.createDataFrame(
            [(name, kind, c) for c, kinds in checked.items() for kind in kinds], "table_name string, check_type string, column_name string")
        value = F.when(F.col("check_type") == "foreign_key", F.col("foreign_key")) \
            .when(F.col("check_type") == "unique", F.col("unique")).otherwise(F.col("not_null"))
        parts.append(wanted.join(sums, "column_name", "left").select(
            "table_name", "check_type", "column_name", F.coalesce(value, F.lit(0)).cast("long").alias("violations")))
    return reduce(DataFrame.unionByName, parts)
