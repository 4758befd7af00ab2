"""Operator 8, mixing sources to target weights (DataFrame operations only).

Sizes are words. They are summed per source by a partial aggregate, so a
source with a third of all rows is combined before the shuffle. Sources in
code point order (null last) weigh 5, 2, 1, repeating. Targets share all
words by weight, stop at three times the source's size, and the excess is
shared again by weight until none is above. Each document is emitted
floor(rate) times, plus once with the rate's fraction as probability, drawn
from a hash of a seed, its id, its text and its number among equal rows, so
reruns agree and a source's draws are independent even if all its ids are
null or equal. Equal rows are counted by a partial aggregate and numbered
when the counts are expanded again; ``mix`` does so for repeated ids and
texts only, all other texts are not shuffled.

The per-source table (one small row per source) is ranked by the library's
distributed rank and joined back; Spark broadcasts it only under its size
threshold, and otherwise splits a hot source by its skew join.

Defined results: a null text has size 0; documents of a source without any
word get target 0 and no copy; rows of equal id and text that differ in
another column draw alike, rows equal in every column do not; repeated rows
are mixed row by row; an empty table gives no rows; other columns are kept by ``mix``
and not read otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expand import expand
from ..operators.ranking import global_rank
from .common import TOKEN, staged, uniform

WEIGHTS = (5, 2, 1)
CAP = 3


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(TOKEN)), F.lit(0)).cast("long")


def source_targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """sized(source, size) -> source, source_size, target, rate."""
    per_source = sized.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    ranked, _ = global_rank(per_source, [F.col("source").asc_nulls_last()], "position")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), ((F.col("position") - 1) % len(weights) + 1).cast("int"))
    table = staged(ranked.select("source", "source_size", weight.cast("long").alias("weight")), "source-weights")
    # Water filling: each round caps the sources that would exceed their cap
    # and shares the rest again. Only four sums reach the driver per round.
    big = "decimal(19,0)"
    total = table.agg(F.sum("source_size")).first()[0] or 0
    spent, free, n_capped = 0, table.agg(F.sum("weight")).first()[0] or 0, 0
    while True:
        room = F.col("source_size").cast(big) * F.lit(cap).cast(big)
        above = (F.col("source_size").cast(big) * F.lit(cap * free).cast(big)
                 < F.lit(total - spent).cast(big) * F.col("weight").cast(big))
        row = table.agg(F.sum(F.when(above, room)).alias("spent"),
                        F.sum(F.when(~above, F.col("weight"))).alias("free"),
                        F.count(F.when(above, 1)).alias("n")).first()
        if row.n == n_capped:
            break
        spent, free, n_capped = int(row.spent), int(row.free or 0), row.n
    share = (F.lit(total - spent) * F.col("weight")).cast("double") / F.lit(float(max(free, 1)))
    target = F.when(above, (F.col("source_size") * cap).cast("double")).otherwise(share)
    return table.select("source", "source_size", target.alias("target"),
                        F.when(F.col("source_size") > 0, target / F.col("source_size")).otherwise(F.lit(0.0)).alias("rate"))


def copies(rate: Column, seed: str, doc_id: Column, body: Column, occurrence: Column) -> Column:
    """floor(rate), plus one with the fraction's probability."""
    whole = F.floor(rate)
    return (whole + F.when(uniform(seed, doc_id, body, occurrence) < rate - whole, 1).otherwise(0)).cast("int")


def _body(text: Column) -> Column:
    return F.md5(text.cast("binary"))


def _counted(docs: DataFrame) -> DataFrame:
    """doc_id, source, size, body (the text's digest), rows: equal rows counted; a written, narrow table."""
    every = F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns])
    narrow = docs.select("doc_id", "source", size_of(F.col("text")).alias("size"), _body(F.col("text")).alias("body"), every.alias("every"))
    return staged(narrow.groupBy("doc_id", "source", "size", "body", "every").agg(F.count(F.lit(1)).alias("rows")).drop("every"), "sizes")


def _targets(counted: DataFrame, weights: tuple[int, ...], cap: int) -> DataFrame:
    return source_targets(counted.select("source", (F.col("size") * F.col("rows")).alias("size")), weights, cap)


def _numbered(counted: DataFrame) -> DataFrame:
    """One row per counted row, with its number as ``occurrence``; only repeated ones are dealt anew."""
    once = counted.filter("rows = 1").withColumn("occurrence", F.lit(1).cast("long"))
    more = expand(counted.filter("rows > 1").withColumn("first", F.lit(1).cast("long")), "first", "rows", "occurrence")
    return once.unionByName(more.drop("first"))


def mix_plan(docs: DataFrame, seed: str = "mix", weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """Per document: doc_id, size, source_size, target, copies, taken."""
    counted = _counted(docs)
    goal = _targets(counted, weights, cap)
    d, s = _numbered(counted).alias("d"), goal.alias("s")
    joined = d.join(s, F.col("d.source").eqNullSafe(F.col("s.source")))
    n = copies(F.col("rate"), seed, F.col("doc_id"), F.col("body"), F.col("occurrence"))
    return joined.select("doc_id", "size", "source_size", "target", n.alias("copies"),
                         (F.col("size") * n).cast("long").alias("taken"))


def mix(docs: DataFrame, seed: str = "mix", weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """The documents themselves, each as often as the mix takes it."""
    counted = _counted(docs)
    goal = _targets(counted, weights, cap)
    repeated = staged(counted.groupBy("doc_id", "body").agg(F.sum("rows").alias("n")).filter("n > 1")
                      .select(F.col("doc_id").alias("_id"), F.col("body").alias("_body")), "repeated-rows")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")).withColumn("body", _body(F.col("row.text")))
    rows = rows.withColumn("occurrence", F.lit(1).cast("long"))
    if not repeated.isEmpty():
        same = F.col("row.doc_id").eqNullSafe(F.col("_id")) & F.col("body").eqNullSafe(F.col("_body"))
        again = rows.join(repeated, same, "left_semi").groupBy("row", "body").agg(F.count(F.lit(1)).alias("rows"))
        again = expand(again.withColumn("first", F.lit(1).cast("long")), "first", "rows", "occurrence")
        rows = rows.join(repeated, same, "left_anti").unionByName(again.drop("first", "rows"))
    joined = rows.join(goal.select("source", "rate"), F.col("row.source").eqNullSafe(F.col("source")))
    n = copies(F.col("rate"), seed, F.col("row.doc_id"), F.col("body"), F.col("occurrence"))
    each = F.explode(F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>")))
    return joined.select("row", each.alias("copy")).select(*[F.col("row").getField(c).alias(c) for c in docs.columns])


#: DuckDB: per-source targets of table ``d(source, size)``; the capped sources are a prefix by size / weight.
TARGETS_SQL = """
per_source AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
weighted AS (SELECT *, [5, 2, 1][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS INTEGER)] AS weight FROM per_source),
placed AS (SELECT *, sum(source_size) OVER () AS total,
  coalesce(sum(3 * source_size) OVER (ORDER BY source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
  sum(weight) OVER (ORDER BY source_size / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest FROM weighted),
capped_or_not AS (SELECT *, 3 * source_size * rest < (total - before) * weight AS capped FROM placed),
sums AS (SELECT coalesce(sum(3 * source_size) FILTER (capped), 0) AS spent, sum(weight) FILTER (NOT capped) AS free FROM capped_or_not),
goals AS (SELECT source, source_size, CASE WHEN capped THEN CAST(3 * source_size AS DOUBLE)
  ELSE CAST((total - spent) * weight AS DOUBLE) / CAST(free AS DOUBLE) END AS target FROM capped_or_not, sums),
rated AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS rate FROM goals)
"""

UNIFORM_SQL = """CAST(CAST('0x' || substr(md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), 'null') || ':' || coalesce(md5(text), 'null') || ':'
  || row_number() OVER (PARTITION BY doc_id, text, sized.source)), 1, 13) AS BIGINT) AS DOUBLE) / 4503599627370496.0"""

MIX_SQL = r"""
WITH sized AS (SELECT doc_id, source, text, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size FROM documents),
""" + TARGETS_SQL + f""",
drawn AS (SELECT doc_id, size, source_size, target,
  CAST(floor(rate) + CASE WHEN {UNIFORM_SQL} < rate - floor(rate) THEN 1 ELSE 0 END AS INTEGER) AS copies
  FROM sized JOIN rated ON sized.source IS NOT DISTINCT FROM rated.source)
SELECT doc_id, size, source_size, target, copies, CAST(size * copies AS BIGINT) AS taken FROM drawn
"""
