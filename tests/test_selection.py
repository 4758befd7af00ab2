"""Selection of rows by position, against a full sort."""

from __future__ import annotations

import random
from decimal import Decimal

import pytest

from txnlake.operators import ranking as R


def _frame(spark, n, values, seed):
    rng = random.Random(seed)
    rows = [(rng.choice(values), i, f"k{i:05d}") for i in range(n)]
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "v decimal(12,2), i long, s string"), rows


def _sorted(rows, descending, nulls_first, key):
    nulls = sorted((r for r in rows if r[0] is None), key=lambda r: r[key])
    rest = sorted((r for r in rows if r[0] is not None), key=lambda r: ((-r[0] if descending else r[0]), r[key]))
    return nulls + rest if nulls_first else rest + nulls


@pytest.mark.parametrize("descending,nulls_first", [(False, False), (True, True), (True, False), (False, True)])
def test_rows_at_any_position(spark, descending, nulls_first):
    """Heavy ties and nulls; brackets of at most 60 rows, so several passes."""
    values = [None, Decimal("1.00"), Decimal("1.00"), Decimal("1.00"), Decimal("-2.50"), Decimal("7.25")]
    df, rows = _frame(spark, 900, values, 4)
    want = _sorted(rows, descending, nulls_first, 2)
    order = [R.Order("v", descending, nulls_first), R.Order("s")]
    for position in (1, 2, 449, 899, 900):
        got = R.rows_at(df, order, position, 900, small=60)
        assert [(g.v, g.s) for g in got] == [(want[position - 1][0], want[position - 1][2])]
        first = {r.s for r in df.filter(R.up_to(order, got[0])).collect()}
        assert first == {r[2] for r in want[:position]}
    two = R.rows_at(df, order, 450, 900, rows=2, small=60)
    assert [g.s for g in two] == [r[2] for r in want[449:451]]


@pytest.mark.parametrize("n,k", [(0, 4), (3, 4), (4, 4), (10, 4), (57, 10)])
def test_first_tile_is_ntile_one(spark, n, k):
    from pyspark.sql import Window
    from pyspark.sql import functions as F
    df, _ = _frame(spark, n, [Decimal(1), Decimal(2), None], 9)
    order = [R.Order("v", True, True), R.Order("i")]
    got = {r.i for r in df.filter(R.first_tile(df, order, n, k)).collect()}
    w = Window.orderBy(F.col("v").desc_nulls_first(), "i")
    assert got == {r.i for r in df.withColumn("t", F.ntile(k).over(w)).filter("t = 1").collect()}


def test_views_cut_without_a_sort_or_checkpoint(spark):
    """No range partitioning, no checkpointed scan, no window."""
    from builders import line, raw_rows

    from txnlake.operators.transform import transform
    from txnlake.plans.views import cancellation as CA
    from txnlake.plans.views import customer as CU
    from txnlake.plans.views import product as PR
    from txnlake.plans.warehouse import build
    wh = build(transform(raw_rows(spark, [line(str(i), f"P{i % 9}", i % 5 + 1, 1.5 * i + 1, i % 6, Description=f"D{i % 9}") for i in range(40)])))
    for view in (PR.high_volume_low_revenue_quadrant, PR.high_revenue_low_volume_quadrant, CU.revenue_concentration,
                 CU.rfm_segments, CA.high_revenue_risk_matrix):
        plan = view(wh)._jdf.queryExecution().executedPlan().toString()
        assert "rangepartitioning" not in plan and "ExistingRDD" not in plan and "Window" not in plan, view
