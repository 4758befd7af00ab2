"""Adapter: the driver's TPC-H-style tables -> the raw invoice-line layout.

lineitem joined with orders, customer, nation and part yields one invoice line
per lineitem. Reserved stock codes, missing fields, returns, zero and negative
prices and duplicate lines are derived from the keys so that every branch of
classification and routing is exercised at every scale factor.

File order is the full lineitem row plus a copy number, a total order the SQL
oracle can reproduce. ``_ord`` carries it either as that struct or as a long
that increases in the same order, like the positional index of a raw file:
the order key and the line's place in its order (``raw_feed``) or, where these
do not fit a long, a position found by a global sort (``long_ordinal``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Fixed values of the adapter (shared with the SQL oracle).
POSTAGE_EVERY = 97       # l_partkey % 97 == 0  -> StockCode 'POST'
MANUAL_EVERY = 89        # l_partkey % 89 == 0  -> StockCode 'M'
GIFT_EVERY = 83          # l_partkey % 83 == 0  -> StockCode 'gift_0001_20'
NO_CODE_EVERY = 79       # l_partkey % 79 == 0  -> StockCode null
NO_DESCRIPTION_EVERY = 53  # l_partkey % 53 == 0 -> Description null
EXACT_COPY_EVERY = 50    # l_orderkey % 50 == 0 -> line repeated unchanged
NEAR_COPY_EVERY = 61     # l_orderkey % 61 == 0 -> line repeated, price + 0.01
NO_CUSTOMER_PRIORITY = "4-NOT SPECIFIED"

ORDINAL_FIELDS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                  "l_quantity", "l_extendedprice", "l_discount", "l_tax",
                  "l_returnflag", "l_linestatus", "l_shipdate"]


def _half_up_price(ext: Column, qty: Column) -> Column:
    """round(ext / qty, 2) half-up, computed in decimals so no engine's
    binary rounding leaks into the price."""
    return F.round(ext.cast("decimal(14,2)") / qty.cast("decimal(10,0)"), 2).cast("double")


_PLACE_BITS = 20  # of a long ``_ord``: the line's place in its order
_MOST_COPIES = 3  # of one line


def _lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(*ORDINAL_FIELDS)


def _most_per_key(table: DataFrame, key: str) -> int:
    counts = table.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(F.coalesce(F.max("n"), F.lit(0))).first()[0]


def _fits_a_long(spark: SparkSession, sf_dir: str) -> bool:
    """Whether order keys leave ``_PLACE_BITS`` bits of a long for every
    order's lines, however often keys repeat in the tables they are joined with."""
    most = _MOST_COPIES
    for table, key in (("lineitem", "l_orderkey"), ("orders", "o_orderkey"), ("customer", "c_custkey"), ("nation", "n_nationkey"), ("part", "p_partkey")):
        most *= max(_most_per_key(spark.read.parquet(f"{sf_dir}/{table}.parquet"), key), 1)
    key = F.col("l_orderkey")
    low, high = spark.read.parquet(f"{sf_dir}/lineitem.parquet").agg(F.coalesce(F.min(key), F.lit(0)), F.coalesce(F.max(key), F.lit(0))).first()
    return most < 1 << _PLACE_BITS and -(1 << (63 - _PLACE_BITS)) <= low and high < 1 << (63 - _PLACE_BITS)


def raw_feed(spark: SparkSession, sf_dir: str, describe: str = "name") -> DataFrame:
    """``raw_lines`` with a long ``_ord``: ``numbered_feed``, or all lines sorted
    where it has none (then write the result once and read it back)."""
    numbered = numbered_feed(spark, sf_dir, describe)
    return numbered if numbered is not None else long_ordinal(raw_lines(spark, sf_dir, describe))


def numbered_feed(spark: SparkSession, sf_dir: str, describe: str = "name") -> DataFrame | None:
    """Lines are numbered within their order by the shuffle that joins them with
    the orders; an order has so few lines (checked) that its sort is small.
    Deterministic, so it may be read without being written first."""
    return raw_lines(spark, sf_dir, describe, numbered=True) if _fits_a_long(spark, sf_dir) else None


def raw_lines(spark: SparkSession, sf_dir: str, describe: str = "name", numbered: bool = False) -> DataFrame:
    """Raw invoice lines with an ``_ord`` file-order column (``numbered``: a long, see ``raw_feed``).

    ``describe='name'`` uses the part name (few names shared by many codes);
    ``describe='item'`` uses ``'ITEM ' || l_partkey div 2`` (two codes per
    description), which gives the quartile views something to select.
    """
    # One scan emits the original line plus its copies: no union, no re-read.
    copies = F.array_compact(F.array(
        F.lit(0),
        F.when(F.col("l_orderkey") % EXACT_COPY_EVERY == 0, F.lit(1)),
        F.when(F.col("l_orderkey") % NEAR_COPY_EVERY == 0, F.lit(2)),
    ))
    li = _lineitem(spark, sf_dir).filter(F.col("l_orderkey").isNotNull()).withColumn("copy_no", F.explode(copies))
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet").select(
        "c_custkey", "c_nationkey")
    # nation is 25 rows by the TPC-H definition: a proven broadcast bound.
    nation = spark.read.parquet(f"{sf_dir}/nation.parquet").select(
        "n_nationkey", "n_name")

    # Orders are enriched first (the smaller side), so lineitem is shuffled
    # once on the part key and then on the order key, by which it is numbered.
    oc = (orders.join(customer, orders.o_custkey == customer.c_custkey)
          .join(F.broadcast(nation), F.col("c_nationkey") == F.col("n_nationkey"))
          .select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority", "n_name"))
    if describe == "name":
        part = spark.read.parquet(f"{sf_dir}/part.parquet").select("p_partkey", "p_name")
        li = li.join(part, li.l_partkey == part.p_partkey)
        desc = F.col("p_name")
    elif describe == "item":
        desc = F.concat(F.lit("ITEM "), F.expr("cast(l_partkey div 2 as string)"))
    else:
        raise ValueError(f"unknown describe mode {describe!r}")
    j = li.join(oc, F.col("l_orderkey") == F.col("o_orderkey"))
    ordinal = F.struct(*[F.col(c) for c in ORDINAL_FIELDS], F.col("copy_no"))
    if numbered:
        # Where keys repeat, the joined columns tell lines apart: every run numbers them alike.
        place = F.row_number().over(Window.partitionBy("l_orderkey").orderBy(
            *ORDINAL_FIELDS[1:], "copy_no", "o_custkey", "o_orderdate", "o_orderpriority", "n_name", desc))
        j = j.withColumn("_place", F.col("l_orderkey") * (1 << _PLACE_BITS) + place)
        ordinal = F.col("_place")

    partkey, orderkey = F.col("l_partkey"), F.col("l_orderkey")
    line7 = F.col("l_linenumber") == 7
    disc = F.col("l_discount")
    returned = F.col("l_returnflag") == "R"

    price = _half_up_price(F.col("l_extendedprice"), F.col("l_quantity"))
    price = (F.when(line7 & disc.isin(0.09, 0.10), F.lit(0.0))
             .when(line7 & (F.col("l_tax") == 0.08) & (disc == 0.0), -price)
             .otherwise(price))
    price = F.when(F.col("copy_no") == 2, price + F.lit(0.01)).otherwise(price)

    qty = F.col("l_quantity").cast("int")
    qty = F.when(returned | (line7 & (disc == 0.10)), -qty).otherwise(qty)

    stock = (F.when(partkey % POSTAGE_EVERY == 0, F.lit("POST"))
             .when(partkey % MANUAL_EVERY == 0, F.lit("M"))
             .when(partkey % GIFT_EVERY == 0, F.lit("gift_0001_20"))
             .when(partkey % NO_CODE_EVERY == 0, F.lit(None).cast("string"))
             .otherwise(partkey.cast("string")))

    customer_id = F.when(
        (F.col("o_orderpriority") == NO_CUSTOMER_PRIORITY) | (line7 & (disc == 0.10)),
        F.lit(None).cast("int")).otherwise(F.col("o_custkey").cast("int"))

    return j.select(
        F.concat(F.when(returned, F.lit("C")).otherwise(F.lit("")),
                 orderkey.cast("string")).alias("InvoiceNo"),
        stock.alias("StockCode"),
        F.when(partkey % NO_DESCRIPTION_EVERY == 0, F.lit(None).cast("string"))
         .otherwise(desc).alias("Description"),
        qty.alias("Quantity"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("InvoiceDate"),
        price.alias("UnitPrice"),
        customer_id.alias("CustomerID"),
        F.col("n_name").alias("Country"),
        ordinal.alias("_ord"),
    )


def long_ordinal(raw: DataFrame, num_partitions: int | None = None) -> DataFrame:
    """Replace the struct ``_ord`` by a long that increases in file order:
    range-partition on the struct, sort within partitions, then
    ``monotonically_increasing_id`` (partition index in the high bits, so
    ids grow across the ordered partitions). Nondeterministic until written:
    write the result once and read it back."""
    n = num_partitions or int(raw.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (raw.repartitionByRange(n, "_ord").sortWithinPartitions("_ord")
            .withColumn("_ord", F.monotonically_increasing_id()))
