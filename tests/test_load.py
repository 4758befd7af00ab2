"""Dimensions, facts, validation and idempotent loads (FIXTURES.md section 4)."""

import datetime as dt

import pytest
from builders import line, raw_rows
from pyspark.sql import functions as F

from txnlake.operators.transform import transform
from txnlake.plans.etl import process
from txnlake.plans.warehouse import ValidationError, audit_integrity, build, load


def _rows():
    return [
        line("C1", "A1", -1, 2.0, 7, Description="from cancellation"),   # cancellations rank 2
        line("2", "A1", 1, 2.0, 7, Description="from sale"),             # sales rank 1 wins
        line("3", "B1", 1, 3.0, None, Description=None, Country=None),
        line("4", "C1", 1, 1.0, 8, Description="  padded  ", Country="  France "),
        line("5", "D1", 1, 1.0, 8, InvoiceDate=dt.datetime(2011, 1, 1, 10, 0)),
        line("6", "E1", 5, 0.0, None),                                    # zero-value -> non-sales
        line("6", "E1", 5, 0.0, None, InvoiceDate=dt.datetime(2010, 12, 2)),
    ]


def test_dimensions(spark):
    wh = build(transform(raw_rows(spark, _rows())))
    prod = {r["stock_code"]: r["description"] for r in wh.dim_product.collect()}
    assert prod["A1"] == "from sale"
    assert prod["B1"] == "Unknown"
    assert prod["C1"] == "padded"
    countries = {r["country"]: r["country_key"] for r in wh.dim_country.collect()}
    assert set(countries) == {"United Kingdom", "Unknown", "France"}
    assert sorted(countries.values()) == [1, 2, 3]
    d = {r["date_key"]: r for r in wh.dim_date.collect()}[20110101]
    assert (d["week"], d["day_of_week"], d["month_name"], d["day_name"], d["year"], d["month"], d["day"]) == \
        (52, 5, "January", "Saturday", 2011, 1, 1)
    assert {r["customer_id"] for r in wh.dim_customer.collect()} == {7, 8}


def _counts(wh):
    return {n: df.count() for n, df in wh.tables().items()}


def test_load_twice_changes_nothing(spark, tmp_dir):
    raw = raw_rows(spark, _rows())
    first = _counts(load(spark, process(spark, raw), f"{tmp_dir}/wh"))
    second = _counts(load(spark, process(spark, raw), f"{tmp_dir}/wh"))
    assert first == second
    assert first["fact_non_sale"] == 2


def test_second_load_new_country_keeps_keys(spark, tmp_dir):
    wh1 = load(spark, process(spark, raw_rows(spark, _rows())), f"{tmp_dir}/wh")
    keys1 = {r["country"]: r["country_key"] for r in wh1.dim_country.collect()}
    more = _rows() + [line("9", "Z1", 1, 1.0, 9, Country="Japan")]
    wh2 = load(spark, process(spark, raw_rows(spark, more)), f"{tmp_dir}/wh")
    keys2 = {r["country"]: r["country_key"] for r in wh2.dim_country.collect()}
    assert {k: keys2[k] for k in keys1} == keys1
    assert keys2["Japan"] == max(keys1.values()) + 1
    assert wh2.fact_sales.filter(F.col("invoice_no") == "9").count() == 1
    assert wh2.fact_sales.count() == wh1.fact_sales.count() + 1
    ids = [r[0] for r in wh2.fact_sales.select("sale_id").collect()]
    assert len(ids) == len(set(ids))


def test_sticky_dimension_rows(spark, tmp_dir):
    load(spark, process(spark, raw_rows(spark, [line("1", "A", 1, 1.0, 1, Description="old")])), f"{tmp_dir}/wh")
    wh = load(spark, process(spark, raw_rows(spark, [line("2", "A", 1, 1.0, 1, Description="new")])), f"{tmp_dir}/wh")
    assert [r["description"] for r in wh.dim_product.collect()] == ["old"]


def test_missing_date_fails_validation(spark):
    rows = _rows() + [line("10", "A1", 1, 1.0, 1, InvoiceDate=None)]
    with pytest.raises(ValidationError, match="fact_sales: 1 of . rows have no date key"):
        build(transform(raw_rows(spark, rows)))


def test_integrity_audit_clean(spark):
    wh = build(transform(raw_rows(spark, _rows())))
    bad = [r for r in audit_integrity(wh).collect() if r["violations"]]
    assert bad == []


def test_rerun_after_interrupted_load_adds_no_duplicates(spark, tmp_dir):
    """A load that stopped after writing the dimensions is completed by the
    next run, and the dimensions are not appended twice."""
    from txnlake.plans.warehouse import DIMENSIONS, _conform, _write_all, stage_dimensions
    processed = process(spark, raw_rows(spark, _rows()))
    dims = stage_dimensions(processed)
    _write_all([(_conform(getattr(dims, n), n), "append", f"{tmp_dir}/wh/{n}") for n in DIMENSIONS])
    wh = load(spark, processed, f"{tmp_dir}/wh")
    clean = load(spark, processed, f"{tmp_dir}/clean")
    assert _counts(wh) == _counts(clean)


def test_reset_empties_all_tables_and_reload_works(spark, tmp_dir):
    from txnlake.plans.warehouse import open_warehouse, reset
    processed = process(spark, raw_rows(spark, _rows()))
    first = _counts(load(spark, processed, f"{tmp_dir}/wh"))
    reset(spark, f"{tmp_dir}/wh")
    assert all(v == 0 for v in _counts(open_warehouse(spark, f"{tmp_dir}/wh")).values())
    assert _counts(load(spark, processed, f"{tmp_dir}/wh")) == first


def test_processed_tables_as_csv(spark, tmp_dir):
    from txnlake.sources import files as IO
    lines = transform(raw_rows(spark, _rows())).lines.drop("_ord")
    IO.write_processed(lines, f"{tmp_dir}/csv", fmt="csv")
    back = spark.read.option("header", True).csv(f"{tmp_dir}/csv")
    assert back.count() == lines.count()
    assert {r["kind"] for r in back.select("kind").distinct().collect()} == \
        {r["kind"] for r in lines.select("kind").distinct().collect()}


def _audit(wh):
    return sorted((r.invoice_no, r.unit_price, r.duplicate_group_count) for r in wh.data_quality_potential_duplicates.collect())


def test_audit_stays_whole_over_incremental_loads(spark, tmp_dir):
    path = f"{tmp_dir}/wh"
    first = [line("1", "A", 1, 1.0, 1), line("2", "B", 2, 1.0, 1)]
    load(spark, process(spark, raw_rows(spark, first)), path)
    pair = load(spark, process(spark, raw_rows(spark, [line("3", "C", 1, 1.0, 1), line("3", "C", 1, 2.0, 1)])), path)
    assert [a[0] for a in _audit(pair)] == ["3", "3"]
    # One unrelated line, and the second half of a pair with an earlier load.
    both = load(spark, process(spark, raw_rows(spark, [line("4", "D", 1, 1.0, 1), line("1", "A", 1, 9.0, 1)])), path)
    assert [(a[0], a[2]) for a in _audit(both)] == [("1", 2), ("1", 2), ("3", 2), ("3", 2)]
    # A third member grows the group; loading it again changes nothing.
    for _ in range(2):
        wh = load(spark, process(spark, raw_rows(spark, [line("3", "C", 1, 3.0, 1)])), path)
        assert [(a[0], a[2]) for a in _audit(wh)] == [("1", 2), ("1", 2), ("3", 3), ("3", 3), ("3", 3)]
    for table, key in (("fact_sales", "sale_id"), ("data_quality_potential_duplicates", "quality_issue_id")):
        ids = [r[0] for r in getattr(wh, table).select(key).collect()]
        assert len(ids) == len(set(ids))


def test_empty_batches_leave_no_files(spark, tmp_dir):
    import glob

    from txnlake.plans.warehouse import LAST_LOAD_REPORT
    processed = process(spark, raw_rows(spark, _rows()))
    load(spark, processed, f"{tmp_dir}/wh")
    files = lambda: {f for f in glob.glob(f"{tmp_dir}/wh/*/**/*.parquet", recursive=True) if "/_load_log/" not in f}
    before = files()
    load(spark, processed, f"{tmp_dir}/wh")
    assert files() == before and set(LAST_LOAD_REPORT.values()) == {0}


def test_compaction_keeps_the_rows(spark, tmp_dir):
    import glob

    from txnlake.plans.warehouse import compact, open_warehouse
    for i in range(3):
        load(spark, process(spark, raw_rows(spark, [line(str(i), "A", 1, 1.0, 1)])), f"{tmp_dir}/wh")
    before = open_warehouse(spark, f"{tmp_dir}/wh").fact_sales.collect()
    compact(spark, f"{tmp_dir}/wh", "fact_sales", [201012])
    assert sorted(open_warehouse(spark, f"{tmp_dir}/wh").fact_sales.collect()) == sorted(before)
    assert len(glob.glob(f"{tmp_dir}/wh/fact_sales/month_key=201012/*.parquet")) == 1


def test_unreadable_table_is_not_taken_for_absent(spark, tmp_dir):
    from pyspark.errors import AnalysisException

    from txnlake.plans import warehouse as W
    load(spark, process(spark, raw_rows(spark, _rows())), f"{tmp_dir}/wh")
    real = W.read_table
    W.read_table = lambda *a, **k: spark.sql("SELECT no_such_column")
    try:
        with pytest.raises(AnalysisException):
            W._read_or_empty(spark, f"{tmp_dir}/wh", "fact_sales")
    finally:
        W.read_table = real


def test_lines_without_a_stock_code_stay_in_the_product_views(spark):
    from txnlake.plans.views import product as PR
    wh = build(transform(raw_rows(spark, [line("1", "A", 1, 2.0, 1), line("2", None, 1, 10.0, 1), line("3", None, 1, 10.0, 2)])))
    assert sum(r.total_sales_revenue for r in PR.sales_summary(wh).collect()) == 22
    assert wh.dim_product.filter("stock_code = 'nan'").count() == 1
