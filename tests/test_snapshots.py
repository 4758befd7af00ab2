"""Atomic loads: crashes at every write, resets, groups across months, versions."""

from __future__ import annotations

import datetime as dt
import glob
import os

import pytest
from builders import line, raw_rows
from pyspark.sql import functions as F

from txnlake.plans import snapshots as V
from txnlake.plans import warehouse as W
from txnlake.plans.etl import process

JAN, FEB, MAR = (dt.datetime(2011, m, 5, 9, 0) for m in (1, 2, 3))


class Crash(Exception):
    pass


def content(wh):
    """Every table's rows without surrogate ids."""
    out = {}
    for name, df in wh.tables().items():
        drop = [W.ID_COLUMNS[name]] if name in W.ID_COLUMNS else []
        out[name] = sorted((tuple(r) for r in df.drop(*drop).collect()), key=repr)
    return out


def batches(spark):
    first = [line("1", "A", 1, 1.0, 1), line("2", "B", 2, 1.0, 1), line("C3", "A", -1, 1.0, 2), line("4", "POST", 1, 3.0, 1),
             line("5", "D", 1, 0.0, 1), line("6", "E", 1, 2.0, 1), line("6", "E", 1, 3.0, 1)]
    second = [line("1", "A", 1, 9.0, 1, Country="France"), line("7", "F", 1, 1.0, 3), line("C8", "F", -1, 1.0, 3),
              line("9", "POST", 1, 3.0, 1), line("10", "D", 1, 0.0, 1), line("2", "B", 2, 1.0, 1)]
    return [process(spark, raw_rows(spark, rows)) for rows in (first, second)]


def test_a_load_that_dies_after_a_write_changes_nothing(spark, tmp_dir, monkeypatch):
    a, b = batches(spark)
    W.load(spark, a, f"{tmp_dir}/clean")
    want = content(W.load(spark, b, f"{tmp_dir}/clean"))
    path = f"{tmp_dir}/wh"
    before = content(W.load(spark, a, path))
    real, names = W._write_all, []

    def dying(after):
        count = [0]

        def one_by_one(jobs, parallel=4):
            done = {}
            for job in jobs:
                done |= real([job])
                count[0] += 1
                names.append(job[2].rsplit("/", 1)[-1])
                if count[0] == after:
                    raise Crash
            return done
        return one_by_one

    deaths = 0
    for after in range(1, 30, 2):  # every other write: dimensions, facts, audit, lines, index
        monkeypatch.setattr(W, "_write_all", dying(after))
        try:
            W.load(spark, b, path)
        except Crash:
            deaths += 1
            assert list(V.versions(spark, path))[-1] == 1
            if after == 9:
                assert content(W.open_warehouse(spark, path)) == before
            continue
        break  # more writes than a load makes: this one was published
    monkeypatch.setattr(W, "_write_all", real)
    assert deaths == 6 and {"_lines", "_line_groups", W.AUDIT, *W.FACTS, *W.DIMENSIONS} <= set(names)
    assert content(W.open_warehouse(spark, path)) == want
    assert glob.glob(f"{path}/_attempts/*") == []


@pytest.mark.parametrize("late", [False, True])
def test_a_load_that_dies_while_publishing(spark, tmp_dir, monkeypatch, late):
    """Files were moved beside the tables', but the version was not renamed (or just was)."""
    a, b = batches(spark)
    path, real = f"{tmp_dir}/wh", V.publish

    def dying(*args):
        if late:
            real(*args)
        raise Crash
    W.load(spark, a, path)
    before = content(W.open_warehouse(spark, path))
    monkeypatch.setattr(V, "publish", dying)
    with pytest.raises(Crash):
        W.load(spark, b, path)
    monkeypatch.setattr(V, "publish", real)
    seen = content(W.open_warehouse(spark, path))
    assert (seen == before) != late
    again = content(W.load(spark, b, path))
    W.load(spark, a, f"{tmp_dir}/clean")
    assert again == content(W.load(spark, b, f"{tmp_dir}/clean"))
    # No file that belongs to no version is left.
    now = V.current(spark, path)
    listed = {p for t in now.files for p in now.paths(path, t)} | {f"{path}/{t}/{d}/{f}" for t, d, f in now.replaced}
    found = {f for f in glob.glob(f"{path}/*/**/*.parquet", recursive=True) if os.path.basename(f)[0] not in "._"}
    assert found == listed


def test_two_loads_of_one_version_do_not_both_win(spark, tmp_dir):
    path = f"{tmp_dir}/wh"
    one, two = V.Attempt(spark, path), V.Attempt(spark, path)
    one.publish({}, {})
    with pytest.raises(V.ConcurrentLoad):
        two.publish({}, {})


def test_an_open_warehouse_keeps_its_version(spark, tmp_dir):
    a, b = batches(spark)
    path = f"{tmp_dir}/wh"
    old = W.load(spark, a, path)
    before = content(old)
    W.load(spark, b, path)
    assert content(old) == before


def test_loads_after_a_reset_see_each_other(spark, tmp_dir):
    path = f"{tmp_dir}/wh"
    W.load(spark, process(spark, raw_rows(spark, [line("1", "A", 1, 1.0, 1)])), path)
    W.reset(spark, path)
    W.load(spark, process(spark, raw_rows(spark, [line("3", "C", 1, 1.0, 1)])), path)
    wh = W.load(spark, process(spark, raw_rows(spark, [line("3", "C", 1, 2.0, 1)])), path)
    assert [r.duplicate_group_count for r in wh.data_quality_potential_duplicates.collect()] == [2, 2]
    assert wh.fact_sales.count() == 2 and wh.fact_sales.agg(F.min("sale_id")).first()[0] == 1


def test_groups_across_months_equal_one_load(spark, tmp_dir):
    """One invoice and the null invoice over several months, in parts and at once."""
    parts = [[line("1", "A", 1, 1.0, 1, InvoiceDate=JAN), line(None, "B", 2, 1.0, 1, InvoiceDate=JAN), line("8", "X", 1, 1.0, 1, InvoiceDate=JAN)],
             [line("1", "A", 1, 2.0, 1, InvoiceDate=FEB), line("9", "Y", 1, 1.0, 1, InvoiceDate=FEB)],
             [line(None, "B", 2, 1.5, 1, InvoiceDate=MAR), line("1", "A", 1, 1.0, 1, InvoiceDate=JAN), line("1", "A", 1, 3.0, 1, InvoiceDate=MAR)]]
    for rows in parts:
        wh = W.load(spark, process(spark, raw_rows(spark, rows)), f"{tmp_dir}/parts")
    whole = W.load(spark, process(spark, raw_rows(spark, [r for rows in parts for r in rows])), f"{tmp_dir}/whole")
    got, want = content(wh), content(whole)
    assert [r for r in want[W.AUDIT]] and got[W.AUDIT] == want[W.AUDIT]
    assert len(got["fact_sales"]) == len(want["fact_sales"]) + len(want["fact_non_sale"]) - len(got["fact_non_sale"])


def test_only_touched_months_are_read(spark, tmp_dir):
    path = f"{tmp_dir}/wh"
    rows = [line(str(i), "A", 1, 1.0, 1, InvoiceDate=d) for i, d in enumerate((JAN, FEB, MAR))]
    W.load(spark, process(spark, raw_rows(spark, rows)), path)
    snapshot = V.current(spark, path)

    def months(*invoices):
        batch = W._keyed_lines(process(spark, raw_rows(spark, [line(i, "A", 1, 7.0, 1, InvoiceDate=MAR) for i in invoices])).lines)
        return sorted(W.touched_months(spark, path, snapshot, batch.select(W.GROUP_HASH)))
    assert months("0") == [201101] and months("77") == [] and months("0", "2", "77") == [201101, 201103]
    batch = process(spark, raw_rows(spark, [line("0", "A", 1, 7.0, 1, InvoiceDate=MAR)]))
    fresh, _ = W._against_stored(spark, batch, path, snapshot)
    files = [f for f in fresh.audit.inputFiles() if "/_lines/" in f]
    assert files and all("month_key=201101" in f for f in files)


def test_countries_are_numbered_once_per_load(spark, tmp_dir, monkeypatch):
    from txnlake.operators import dims as D
    calls, real = [], D.new_countries
    monkeypatch.setattr(D, "new_countries", lambda *a: calls.append(1) or real(*a))
    a, b = batches(spark)
    W.load(spark, a, f"{tmp_dir}/wh")
    W.load(spark, b, f"{tmp_dir}/wh")
    assert len(calls) == 2
    assert len(glob.glob(f"{tmp_dir}/wh/dim_country/*.parquet")) == 2  # one small file per load
