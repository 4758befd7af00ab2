"""Exact global rank, NTILE, median and top-k share.

Views that only ask where a tile or a median lies do not rank at all: the row
at a position is selected in a few passes (``rows_at``), and the rows up to
it are a plain filter (``up_to``). The rest of this text is about ranks.

A window with no PARTITION BY plans ``Exchange SinglePartition``: one task
sorts everything. Here the rows are range-partitioned on the full order
(callers append a unique tie-break key, so a heavily tied value is still
split across partitions), sorted within partitions and numbered locally.
The numbered frame is checkpointed to the shared checkpoint folder, so the
per-partition counts and the final ranks see the very same partitions (range
bounds are sampled, and must not be re-sampled). Only one count per
partition reaches the driver.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import checkpoint_dir, shuffles_dropped

_LOCAL_BITS = 33  # monotonically_increasing_id: partition index << 33 | row index
_LOCAL_MASK = (1 << _LOCAL_BITS) - 1


def global_rank(df: DataFrame, order: list[Column], rank_col: str = "rank",
                num_partitions: int | None = None) -> tuple[DataFrame, int]:
    """Adds a 1-based ``rank_col`` following ``order``; returns (frame, N).

    ``order`` must be a total order for the result to be deterministic.
    """
    spark = df.sparkSession
    checkpoint_dir(spark)
    # Without an explicit count AQE may coalesce the range partitions; it only
    # merges neighbouring ranges, so partition order is still the sort order.
    with shuffles_dropped(spark):
        ranged = df.repartitionByRange(num_partitions, *order) if num_partitions \
            else df.repartitionByRange(*order)
        numbered = (ranged
                    .sortWithinPartitions(*order)
                    .withColumn("_mid", F.monotonically_increasing_id())
                    .checkpoint(eager=True))
        pid = F.shiftright(F.col("_mid"), _LOCAL_BITS)
        sizes = sorted((r[0], r[1]) for r in
                       numbered.groupBy(pid.alias("_pid")).count().collect())
    offsets, running = [], 0
    for p, c in sizes:
        offsets.append((int(p), running))
        running += int(c)
    if not offsets:
        return numbered.drop("_mid").withColumn(rank_col, F.lit(None).cast("long")), 0
    # One row per non-empty partition: bounded by the partition count.
    off = spark.createDataFrame(offsets, "_pid long, _off long")
    ranked = (numbered.withColumn("_pid", pid)
              .join(F.broadcast(off), "_pid")
              .withColumn(rank_col, F.col("_off") + F.col("_mid").bitwiseAND(F.lit(_LOCAL_MASK)) + 1)
              .drop("_pid", "_off", "_mid"))
    return ranked, running


def ntile_of(rank: Column, n: int, k: int) -> Column:
    """NTILE(k) from a 1-based rank over N=n rows: the first n mod k tiles
    hold one row more."""
    q, m = divmod(n, k)
    big = (q + 1) * m
    if q == 0:
        return rank.cast("int")
    return F.when(rank <= big, F.floor((rank - 1) / (q + 1)) + 1) \
        .otherwise(F.floor((rank - 1 - big) / q) + m + 1).cast("int")


def ntile_global(df: DataFrame, k: int, order: list[Column], col: str = "tile") -> DataFrame:
    """Exact NTILE(k) OVER (ORDER BY order) without a single-partition window."""
    ranked, n = global_rank(df, order, rank_col="_rank")
    return ranked.withColumn(col, ntile_of(F.col("_rank"), n, k)).drop("_rank")


def row_number_global(df: DataFrame, order: list[Column], col: str = "row_number") -> DataFrame:
    """Exact ROW_NUMBER() OVER (ORDER BY order) without a single-partition window."""
    return global_rank(df, order, rank_col=col)[0]


@dataclass(frozen=True)
class Order:
    """One column of a total order."""
    name: str
    descending: bool = False
    nulls_first: bool = False

    def column(self) -> Column:
        c = F.col(self.name)
        if self.descending:
            return c.desc_nulls_first() if self.nulls_first else c.desc_nulls_last()
        return c.asc_nulls_first() if self.nulls_first else c.asc_nulls_last()

    def before(self, value) -> Column:
        """Whether a row's value precedes ``value``."""
        c = F.col(self.name)
        if value is None:
            return F.lit(False) if self.nulls_first else c.isNotNull()
        ahead = F.coalesce(c > F.lit(value) if self.descending else c < F.lit(value), F.lit(False))
        return (ahead | c.isNull()) if self.nulls_first else ahead


def up_to(order: list[Order], row, inclusive: bool = True) -> Column:
    """Rows that come no later than ``row`` (whose fields the order names)."""
    found = F.lit(inclusive)
    for o in reversed(order):
        found = o.before(row[o.name]) | (F.col(o.name).eqNullSafe(F.lit(row[o.name])) & found)
    return found


SMALL = 20_000  # rows that one sort may see, and size of the samples


def rows_at(df: DataFrame, order: list[Order], position: int, n: int, rows: int = 1, small: int = SMALL) -> list:
    """The order's columns of the rows at 1-based ``position`` and after
    (``rows`` of them) among the ``n`` rows of ``df``, a written table.

    A sample brackets the position, exact counts below and inside the bracket
    confirm it (or move on to the side that holds it), and so on inside the
    bracket, until it is small enough for a top-k. Nothing is sorted or
    shuffled but the sample and the last bracket; ties are no matter, since
    the order is total.
    """
    names = [o.name for o in order]
    inside, seed, width = df.select(*names), 0, 3.0
    while n > small:
        seed += 1
        sample = inside.sample(min(1.0, small / n), seed=seed).orderBy(*[o.column() for o in order]).limit(2 * small).collect()
        share = position / n  # its place in the sample, within three standard deviations
        middle, margin = share * len(sample), width * (len(sample) * share * (1 - share)) ** 0.5 + 1
        low, high = int(middle - margin), int(middle + margin + rows * len(sample) / n)
        skip = up_to(order, sample[low]) if 0 <= low < len(sample) else F.lit(False)
        keep = up_to(order, sample[high]) if 0 <= high < len(sample) else F.lit(True)
        start, end = inside.agg(F.count_if(skip), F.count_if(keep)).first()
        before = n
        if start < position and position + rows - 1 <= end:
            inside, position, n = inside.filter(~skip & keep), position - start, end - start
        elif position + rows - 1 <= start:  # the sample misled: before the bracket
            inside, n = inside.filter(skip), start
        elif position > end:
            inside, position, n = inside.filter(~keep), position - end, n - end
        # Where the rows straddle a bound, or nothing was cut off: sample again.
        width = 3.0 if n < before else width / 2 if (start, end) == (0, n) else width + 1
    return inside.orderBy(*[o.column() for o in order]).offset(position - 1).limit(rows).collect()


def first_tile(df: DataFrame, order: list[Order], n: int, k: int) -> Column:
    """Rows of the first NTILE(k) of ``df``, a written table of ``n`` rows."""
    size = n // k + (1 if n % k else 0)
    return up_to(order, rows_at(df, order, size, n)[0]) if size else F.lit(False)


def percentile_cont(df: DataFrame, value: str, fraction: float = 0.5,
                    tie_break: list[str] | None = None) -> float | None:
    """Exact PERCENTILE_CONT(fraction) WITHIN GROUP (ORDER BY value), nulls
    ignored, linear interpolation, as a double.

    Built on selection over a written table: the driver receives the two
    neighbouring values (and a sample, if the table is large).
    """
    vals = df.select(value, *(tie_break or [])).filter(F.col(value).isNotNull())
    n = vals.count()
    if n == 0:
        return None
    pos = (n - 1) * fraction
    lo = int(pos)
    both = 2 if pos > lo and lo + 1 < n else 1
    got = rows_at(vals, [Order(value), *[Order(c) for c in tie_break or []]], lo + 1, n, both)
    lo_v, hi_v = float(got[0][value]), float(got[-1][value])
    return lo_v + (hi_v - lo_v) * (pos - lo)


def top_k_share(df: DataFrame, value: str, k: int) -> DataFrame:
    """One row (top_sum, total) for the k largest ``value`` rows.

    ``orderBy().limit(k)`` plans TakeOrderedAndProject: every partition keeps
    k rows, so nothing global is sorted. Both sums come out of one aggregate
    over a tagged union; no cross join.
    """
    top = df.orderBy(F.col(value).desc_nulls_first()).limit(k) \
        .select(F.lit(True).alias("_top"), F.col(value).alias("_v"))
    every = df.select(F.lit(False).alias("_top"), F.col(value).alias("_v"))
    both = top.unionByName(every)
    return both.agg(
        F.sum(F.when(F.col("_top"), F.col("_v")).otherwise(F.lit(0))).alias("top_sum"),
        F.sum(F.when(~F.col("_top"), F.col("_v"))).alias("total"),
    )
