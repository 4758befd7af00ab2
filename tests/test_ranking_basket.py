"""R1 (distributed rank / NTILE / median), R7 and R2 against plain forms."""

import random

import duckdb
import pytest
from builders import line, raw_rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from txnlake.operators.basket import basket_pairs
from txnlake.operators.ranking import global_rank, ntile_global, percentile_cont, top_k_share
from txnlake.operators.transform import transform
from txnlake.plans.views import product as PR
from txnlake.plans.warehouse import build


@pytest.mark.parametrize("n,k", [(1003, 4), (1001, 10), (7, 10), (37, 4), (10, 4)])
def test_ntile_matches_window(spark, n, k):
    rnd = random.Random(n)
    df = spark.createDataFrame([(i, rnd.randint(0, 50)) for i in range(n)], "id long, v long")
    order = [F.col("v").desc(), F.col("id").asc()]
    ours = {r["id"]: r["t"] for r in ntile_global(df, k, order, "t").collect()}
    plain = {r["id"]: r["t"] for r in df.select("id", F.ntile(k).over(Window.orderBy(*order)).alias("t")).collect()}
    assert ours == plain
    if n == 10:
        sizes = sorted([list(ours.values()).count(t) for t in range(1, k + 1)], reverse=True)
        assert sizes == [3, 3, 2, 2]


def test_rank_is_contiguous_and_has_no_single_partition_exchange(spark):
    df = spark.range(0, 5000).withColumn("v", (F.col("id") * 7919) % 1000)
    ranked, n = global_rank(df, [F.col("v").asc(), F.col("id").asc()], "r")
    assert n == 5000
    rows = ranked.select("r").collect()
    assert sorted(r[0] for r in rows) == list(range(1, 5001))
    plan = ranked._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan


def test_nulls_first_when_descending(spark):
    df = spark.createDataFrame([(1, None), (2, 5), (3, 7)], "id int, v int")
    ranked, _ = global_rank(df, [F.col("v").desc_nulls_first(), F.col("id")], "r")
    assert {r["id"]: r["r"] for r in ranked.collect()} == {1: 1, 3: 2, 2: 3}


@pytest.mark.parametrize("vals", [[1.0, 2.0, 3.0, 4.0], [5.0], [1.0, 1.01], [3.0, 1.0, 2.0, 10.0, 7.0]])
def test_percentile_cont_exact(spark, vals):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "id int, v double")
    ours = percentile_cont(df, "v", 0.5, ["id"])
    expected = duckdb.sql(f"SELECT percentile_cont(0.5) WITHIN GROUP (ORDER BY v) FROM "
                          f"(SELECT CAST(unnest({vals}) AS DOUBLE) AS v)").fetchall()[0][0]
    assert ours == pytest.approx(expected, abs=0)


def test_top_k_share(spark):
    df = spark.createDataFrame([(i, float(i)) for i in range(1, 21)], "id int, v double")
    r = top_k_share(df, "v", 3).collect()[0]
    assert (r["top_sum"], r["total"]) == (57.0, 210.0)


def _naive_pairs(rows, max_items, min_support):
    """Brute force: invoices -> distinct codes -> ordered code pairs -> descriptions."""
    inv = {}
    for i, c, d in rows:
        inv.setdefault(i, {})[c] = d
    ok = {i: codes for i, codes in inv.items() if len(codes) <= max_items}
    support = {}
    for i, codes in ok.items():
        seen = set()
        for a in codes:
            for b in codes:
                if a < b:
                    seen.add((codes[a], codes[b]))
        for p in seen:
            support[p] = support.get(p, 0) + 1
    total = len(ok)
    return {p: (n, round(100.0 * n / total, 3)) for p, n in support.items() if n >= min_support}


def test_basket_pairs_vs_brute_force(spark):
    rnd = random.Random(3)
    rows = []
    for inv in range(300):
        size = 120 if inv == 0 else (101 if inv == 1 else (100 if inv == 2 else rnd.randint(1, 8)))
        codes = rnd.sample(range(200), size) if size > 8 else rnd.sample(range(12), min(size, 12))
        for c in codes:
            rows.append((f"I{inv}", f"C{c:03d}", f"D{c % 9}"))
    lines = spark.createDataFrame([(i, c) for i, c, _ in rows], "invoice_no string, stock_code string")
    prods = spark.createDataFrame(sorted({(c, d) for _, c, d in rows}), "stock_code string, description string")
    got = {(r["product_a"], r["product_b"]): (r["unique_combination"], float(r["support_percentage"]))
           for r in basket_pairs(lines, prods, max_items=100, min_support=5).collect()}
    assert got == _naive_pairs(rows, 100, 5)


def test_quadrants_small(spark):
    rows = []
    for i in range(12):
        rows.append(line(str(i), f"S{i}", 100 - i * 8, 1.0 + i, 1, Description=f"P{i}"))
    wh = build(transform(raw_rows(spark, rows)))
    hv = {r["description"] for r in PR.high_volume_low_revenue_quadrant(wh).collect()}
    hr = {r["description"] for r in PR.high_revenue_low_volume_quadrant(wh).collect()}
    # top-volume quartile P0-P2, bottom-revenue quartile: revenue (100-8i)(1+i) smallest
    rev = sorted(range(12), key=lambda i: ((100 - i * 8) * (1 + i), f"P{i}"))
    assert hv == {f"P{i}" for i in range(3)} & {f"P{i}" for i in rev[:3]}
    assert hr == {f"P{i}" for i in range(9, 12)} & {f"P{i}" for i in rev[::-1][:3]}


def test_expand_chunks_cover_range_exactly(spark):
    from txnlake.functions.expand import expand
    df = spark.createDataFrame([("a", 1, 10), ("b", 3, 3), ("c", 5, 4)], "k string, lo long, hi long")
    got = sorted((r["k"], r["i"]) for r in expand(df, "lo", "hi", "i", chunk=3).collect())
    assert got == [("a", i) for i in range(1, 11)] + [("b", 3)]


def test_rank_spreads_a_heavily_tied_value(spark):
    """A third of the rows share one value: the tie-break key still splits
    them over several range partitions, and ranks stay exact."""
    n = 3000
    df = spark.range(0, n).withColumn("v", F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")))
    ranked, total = global_rank(df, [F.col("v").asc(), F.col("id").asc()], "r", num_partitions=6)
    parts = [r[0] for r in ranked.groupBy(F.spark_partition_id()).count().collect()]
    assert total == n and max(parts) < n / 3
    plain = {r["id"]: r["r"] for r in df.select("id", F.row_number().over(
        Window.orderBy("v", "id")).alias("r")).collect()}
    assert {r["id"]: r["r"] for r in ranked.collect()} == plain


def test_basket_pairs_with_a_hot_invoice(spark):
    """One invoice holds a third of all lines (many copies of 30 codes)."""
    rows = [("HOT", f"C{i % 30:03d}", f"D{i % 30}") for i in range(3000)]
    rows += [(f"I{j}", f"C{(j + k) % 30:03d}", f"D{(j + k) % 30}") for j in range(200) for k in range(3)]
    lines = spark.createDataFrame([(i, c) for i, c, _ in rows], "invoice_no string, stock_code string")
    prods = spark.createDataFrame(sorted({(c, d) for _, c, d in rows}), "stock_code string, description string")
    got = {(r["product_a"], r["product_b"]): (r["unique_combination"], float(r["support_percentage"]))
           for r in basket_pairs(lines, prods, max_items=100, min_support=5).collect()}
    assert got == _naive_pairs(rows, 100, 5)
