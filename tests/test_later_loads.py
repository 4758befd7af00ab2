"""Later loads (L15) move only what can meet stored rows, with the same results."""

from __future__ import annotations

import datetime as dt
import random

from builders import line, raw_rows

from txnlake.plans import snapshots as V
from txnlake.plans import warehouse as W
from txnlake.plans.etl import process

DAYS = [dt.datetime(2011, m, 5, 9, 0) for m in (1, 2, 3)]


def _rows(n=120):
    """Copies, near copies and groups over months, also of missing invoices, codes and quantities."""
    rng = random.Random(5)
    return [line(rng.choice([None, "1", "2", "C3", "4", "5"]), rng.choice([None, "A", "B", "POST", "D"]), rng.choice([None, 1, 2, -1]),
                 rng.choice([0.0, 1.0, 2.5]), rng.choice([None, 7, 8]), InvoiceDate=rng.choice(DAYS)) for _ in range(n)]


def _content(wh):
    return {n: sorted((tuple(r) for r in df.drop(*[W.ID_COLUMNS[n]] if n in W.ID_COLUMNS else []).collect()), key=repr)
            for n, df in wh.tables().items()}


def _in_parts(spark, rows, path):
    # The second part repeats lines of the first one and brings other ones.
    for part in (rows[:70], rows[40:]):
        wh = W.load(spark, process(spark, raw_rows(spark, part)), path)
    return _content(wh)


def _shuffles(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.count("Exchange") - plan.count("BroadcastExchange")


def test_parts_equal_the_whole_however_many_lines_the_marks_let_through(spark, tmp_dir, monkeypatch):
    rows = _rows()
    whole = _content(W.load(spark, process(spark, raw_rows(spark, rows)), f"{tmp_dir}/whole"))
    parts = _in_parts(spark, rows, f"{tmp_dir}/parts")
    assert whole[W.AUDIT] and parts[W.AUDIT] == whole[W.AUDIT]
    for fact in ("fact_sales", "fact_cancellations", "fact_adjustment"):
        hashes = [r[0] for r in parts[fact]]
        assert hashes and sorted(hashes) == sorted(r[0] for r in whole[fact])
    monkeypatch.setattr(W, "_mark_bits", lambda groups: 1)
    assert _in_parts(spark, rows, f"{tmp_dir}/all") == parts


def test_only_lines_of_stored_groups_are_compared(spark, tmp_dir):
    path, scratch = f"{tmp_dir}/wh", f"{tmp_dir}/scratch"
    W.load(spark, process(spark, raw_rows(spark, [line("1", "A", 1, 1.0, 1), line("2", "B", 1, 1.0, 1)])), path)
    batch = [line("1", "A", 1, 9.0, 1), line("2", "B", 1, 1.0, 1)] + [line(f"n{i}", "A", 1, 1.0 + k, 1) for i in range(30) for k in (0, 1)]
    fresh, groups = W._against_stored(spark, process(spark, raw_rows(spark, batch)), path, V.current(spark, path), scratch)
    assert [tuple(r) for r in groups.collect()] == [("1", "A", 1)]
    assert spark.read.parquet(f"{scratch}/lines").count() == 1  # the known copy is gone, the others stay where they are
    assert fresh.lines.count() == 61 and fresh.audit.count() == 62


def test_a_later_load_shuffles_its_facts_once(spark, tmp_dir):
    path = f"{tmp_dir}/wh"
    old = W.load(spark, process(spark, raw_rows(spark, [line("1", "A", 1, 1.0, 1), line("2", "E", 1, 1.0, 1)])), path)
    batch = process(spark, raw_rows(spark, [line("2", "E", 1, 1.0, 9), line("3", "E", 1, 1.0, 1), line("3", "E", 1, 1.0, 2)]))
    facts = W.stage_facts(batch, old.dim_country, old, by_range=True)
    sales = facts["fact_sales"]
    assert _shuffles(W._numbered(sales, "fact_sales", 0)) == 1
    assert [(r.invoice_no, r.customer_id) for r in sales.collect()] == [("3", 1)]


def test_the_load_after_a_reset_is_a_first_load(spark, tmp_dir, monkeypatch):
    path, met, real = f"{tmp_dir}/wh", [], W.stage_facts
    W.load(spark, process(spark, raw_rows(spark, [line("1", "A", 1, 1.0, 1)])), path)
    W.reset(spark, path)
    monkeypatch.setattr(W, "stage_facts", lambda p, c, existing=None, *a, **k: met.append(existing) or real(p, c, existing, *a, **k))
    wh = W.load(spark, process(spark, raw_rows(spark, [line("1", "A", 1, 1.0, 1)])), path)
    assert met == [None] and wh.fact_sales.count() == 1


def test_lines_are_stored_without_what_follows_from_them(spark, tmp_dir):
    path = f"{tmp_dir}/wh"
    W.load(spark, process(spark, raw_rows(spark, [line("1", "A", 1, 1.0, 1), line("1", "A", 1, 2.0, 1)])), path)
    assert spark.read.parquet(f"{path}/{W.LINES}").columns == [*W._IDENTITY, W.MONTH]
