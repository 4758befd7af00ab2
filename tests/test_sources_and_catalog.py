"""File sources (S1, S2), export (S10), view registration (S9), profiling."""

import datetime as dt
import os

import pytest
from builders import line, raw_rows

from txnlake.operators import profile as P
from txnlake.operators.classify import classify
from txnlake.operators.transform import transform
from txnlake.plans import catalog
from txnlake.plans.warehouse import build
from txnlake.sources import files as IO


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def test_zip_columns_follows_file_position(spark, tmp_dir):
    n = 2500
    ids = "InvoiceNo,StockCode\n" + "".join(f"{'C' if i % 7 == 0 else ''}{i},{i % 13}\n" for i in range(n))
    feats = ("Description,Quantity,InvoiceDate,UnitPrice,CustomerID,Country\n"
             + "".join(f"item {i},{i % 5 + 1},12/1/2010 8:26,{i}.5,{'' if i % 3 == 0 else str(i) + '.0'},UK\n"
                       for i in range(n)))
    _write(f"{tmp_dir}/ids.csv", ids)
    _write(f"{tmp_dir}/data.csv", feats)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")  # several splits per file
    try:
        raw = IO.read_raw(spark, f"{tmp_dir}/ids.csv", f"{tmp_dir}/data.csv")
        rows = raw.collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(rows) == n
    for r in rows:
        i = r["_ord"]
        assert r["InvoiceNo"].lstrip("C") == str(i)
        assert r["Description"] == f"item {i}"
        assert r["CustomerID"] == (None if i % 3 == 0 else i)
    assert {r["InvoiceDate"] for r in rows} == {dt.datetime(2010, 12, 1, 8, 26)}  # month-first layout


def test_zip_columns_rejects_unequal_files(spark, tmp_dir):
    _write(f"{tmp_dir}/a.csv", "InvoiceNo,StockCode\n1,A\n2,B\n")
    _write(f"{tmp_dir}/b.csv", "Description,Quantity,InvoiceDate,UnitPrice,CustomerID,Country\nx,1,,1.0,,UK\n")
    with pytest.raises(ValueError, match="row counts differ"):
        IO.read_raw(spark, f"{tmp_dir}/a.csv", f"{tmp_dir}/b.csv")


def _wh(spark):
    rows = [line(str(i), f"S{i % 4}", 1 + i % 3, 2.0 + i, i % 3 + 1) for i in range(30)]
    return build(transform(raw_rows(spark, rows)))


def test_export_all_and_report(spark, tmp_dir):
    wh = _wh(spark)
    report = catalog.export_all(wh, f"{tmp_dir}/out", only=["V1", "V3", "V24", "V49"])
    assert report["failed"] == [] and len(report["succeeded"]) == 4
    header = [ln for f in os.listdir(f"{tmp_dir}/out/customer_rfm_segments.csv") if f.endswith(".csv")
              for ln in open(f"{tmp_dir}/out/customer_rfm_segments.csv/{f}").readlines()[:1]]
    assert header and "total_revenue" not in header[0]


def test_register_views_sql(spark):
    wh = _wh(spark)
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup()
    names = catalog.register_views(spark, wh)
    assert spark.sparkContext.statusTracker().getJobIdsForGroup() == jobs  # registering runs nothing
    assert len(names) == len(catalog.VIEWS) - len(catalog.RANKED)
    top = catalog.query(spark, wh, "SELECT percentage_of_total_revenue AS p FROM customer.revenue_concentration").collect()
    assert top[0].p == catalog.BY_ID["V22"].fn(wh).collect()[0]["percentage_of_total_revenue"]
    assert "sales_total_revenue" in names
    total = spark.sql("SELECT total_sales_revenue FROM sales_total_revenue").collect()[0][0]
    assert total == spark.sql("SELECT SUM(revenue) FROM fact_sales").collect()[0][0]


def test_export_rejects_duplicate_names(spark, monkeypatch):
    v = catalog.VIEWS[0]
    monkeypatch.setattr(catalog, "VIEWS", [v, v])
    with pytest.raises(ValueError, match="several views export"):
        catalog.export_all(None, "/tmp/unused")


def test_profiling_checks(spark):
    rows = [line("C1", "A", -1, 1.0, 1), line("2", "B", -3, 0.0, None, Description=None),
            line("3", "C", 2, 0.0, None), line("3", "C", 2, 0.0, None), line("4", "85123A", 1, 1.0, 2)]
    df = classify(raw_rows(spark, rows)).drop("_ord")
    miss = {r["column_name"]: r["missing"] for r in P.missing_values(df).collect()}
    assert miss["CustomerID"] == 3 and miss["Description"] == 1
    dup = P.duplicate_row_count(df).collect()[0]
    assert (dup["rows"], dup["distinct_rows"], dup["duplicate_rows"]) == (5, 4, 1)
    assert P.duplicate_members(df).count() == 2
    signs = P.sign_checks(df).collect()[0]
    assert signs["cancellations_all_negative"] and signs["regular_any_negative"]
    hid = P.hidden_negatives(df).collect()[0]
    assert (hid["hidden_negatives"], hid["missing_id_description_price"]) == (1, 1)
    cls = {r["TransactionType"]: r["rows"] for r in P.rows_per_class(df).collect()}
    assert cls == {"Cancellation": 1, "Inventory Adjustment": 1, "Zero-Value Transaction": 2, "Sale": 1}
    assert P.within_invoice_clusters(df).count() == 1
    types = {r["column_name"]: r["data_type"] for r in P.column_profile(df).collect()}
    assert types["Quantity"] == "int"


def test_command_line_run_and_rerun(spark, tmp_dir):
    from txnlake.__main__ import main
    _write(f"{tmp_dir}/ids.csv", "InvoiceNo,StockCode\n536365,85123A\nC536379,22556\n536366,POST\n536365,85123A\n")
    _write(f"{tmp_dir}/data.csv",
           "Description,Quantity,InvoiceDate,UnitPrice,CustomerID,Country\n"
           "LANTERN,6,2010-12-01 08:26:00,2.55,17850.0,United Kingdom\n"
           "TEA CUP,-12,2010-12-01 09:00:00,1.65,14527.0,United Kingdom\n"
           "postage,1,2010-12-01 10:00:00,18.0,,France\n"
           "LANTERN,6,2010-12-01 08:26:00,2.55,17850.0,United Kingdom\n")
    args = ["run", "--ids", f"{tmp_dir}/ids.csv", "--features", f"{tmp_dir}/data.csv",
            "--warehouse", f"{tmp_dir}/wh", "--out", f"{tmp_dir}/out", "--only", "V1,V43"]
    first = main(args, spark=spark)
    assert first["inserted"]["fact_sales"] == 1 and first["inserted"]["fact_cancellations"] == 1
    assert first["inserted"]["fact_non_sale"] == 1 and first["export"]["failed"] == []
    again = main(args, spark=spark)
    assert all(v == 0 for k, v in again["inserted"].items() if k != "data_quality_potential_duplicates")
    assert main(["audit", "--warehouse", f"{tmp_dir}/wh"], spark=spark)["violations"] == {}


def test_timestamp_layouts_and_bad_values(spark):
    from pyspark.sql import functions as F

    from txnlake.operators.classify import parse_timestamp
    df = spark.createDataFrame([("2010-12-01 08:26:00",), ("12/1/2010 8:26",), ("1/13/2011 17:05",),
                                ("not a date",), (None,)], "s string")
    got = [r[0] for r in df.select(parse_timestamp(F.col("s"))).collect()]
    assert got == [dt.datetime(2010, 12, 1, 8, 26), dt.datetime(2010, 12, 1, 8, 26),
                   dt.datetime(2011, 1, 13, 17, 5), None, None]


IDS = "InvoiceNo,StockCode\n"
FEATS = "Description,Quantity,InvoiceDate,UnitPrice,CustomerID,Country\n"
PLAIN = ",2,2010-12-01 08:26:00,1.5,17850.0,UK\n"


def _read(spark, tmp_dir, ids, feats, **options):
    _write(f"{tmp_dir}/ids.csv", IDS + ids)
    _write(f"{tmp_dir}/data.csv", FEATS + feats)
    return IO.read_raw(spark, f"{tmp_dir}/ids.csv", f"{tmp_dir}/data.csv", **options).orderBy("_ord").collect()


def test_csv_quotes_backslashes_and_whole_numbers(spark, tmp_dir):
    texts = ['"NECKL 36"" BLACK"', '"NECKL 36"" BLACK, LONG"', '"ends\\"', "ends\\", '"a, b"', '"""all"""']
    rows = _read(spark, tmp_dir, "".join(f"{i},A\n" for i in range(len(texts) + 1)),
                 "".join(t + PLAIN for t in texts) + "x,6.0,12/1/2010 8:26,2,12,UK\n")
    assert [r.Description for r in rows] == ['NECKL 36" BLACK', 'NECKL 36" BLACK, LONG', "ends\\", "ends\\", "a, b", '"all"', "x"]
    assert [r.Quantity for r in rows] == [2] * 6 + [6] and rows[0].CustomerID == 17850 and rows[6].UnitPrice == 2.0
    assert {r.InvoiceDate for r in rows} == {dt.datetime(2010, 12, 1, 8, 26)}


def test_csv_missing_texts_are_null(spark, tmp_dir):
    rows = _read(spark, tmp_dir, "NA,\n1,null\n", "NA,N/A,NaT,nan,,None\n" + '""' + PLAIN)
    assert tuple(rows[0])[:8] == (None,) * 8
    assert rows[1].StockCode is None and rows[1].Description is None and rows[1].Country == "UK"


def test_csv_quoted_line_ends_need_multi_line(spark, tmp_dir):
    feats = '"two\nlines"' + PLAIN + "b" + PLAIN
    rows = _read(spark, tmp_dir, "1,A\n2,B\n", feats, multi_line=True)
    assert [r.Description for r in rows] == ["two\nlines", "b"]
    with pytest.raises(ValueError):
        _read(spark, tmp_dir, "1,A\n2,B\n", feats)


@pytest.mark.parametrize("bad", ["x,6.5,2010-12-01,1.0,,UK", "x,six,2010-12-01,1.0,,UK", "x,1,2010-12-01,1.0.0,,UK",
                                 "x,1,2010-12-01,1.0", "x,1,2010-12-01,1.0,,UK,more", "x,99999999999,2010-12-01,1.0,,UK"])
def test_csv_rows_that_do_not_parse_are_counted(spark, tmp_dir, bad):
    with pytest.raises(IO.RawDataError, match="0 rows of the first file and 1 of the second"):
        _read(spark, tmp_dir, "1,A\n2,B\n", "b" + PLAIN + bad + "\n")
    assert len(_read(spark, tmp_dir, "1,A\n2,B\n", "b" + PLAIN + bad + "\n", on_bad="null")) == 2


def test_dates_do_not_depend_on_the_session_zone(spark):
    from pyspark.sql import functions as F

    from txnlake.operators.classify import parse_timestamp
    df = spark.createDataFrame([("2011-03-27 01:30:00",), ("3/27/2011 1:30",), ("2011-03-27T01:30:00",)], "s string")
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Europe/London")  # 01:30 does not exist there
        got = {r[0] for r in df.select(parse_timestamp(F.col("s")).cast("string")).collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert got == {"2011-03-27 01:30:00"}


def test_csv_processed_tables_load(spark, tmp_dir):
    from txnlake.__main__ import main
    n = 40
    _write(f"{tmp_dir}/ids.csv", IDS + "".join(f"{'C' if i % 9 == 0 else ''}{i},{'POST' if i % 7 == 0 else i % 5}\n" for i in range(n)))
    _write(f"{tmp_dir}/data.csv", FEATS + "".join(f'"item ""{i}"", big",{i % 4 + 1},12/1/2010 8:26,{i}.5,{"" if i % 3 else 17850.0},UK\n' for i in range(n)))
    counts = {}
    for fmt in ("csv", "parquet"):
        main(["transform", "--ids", f"{tmp_dir}/ids.csv", "--features", f"{tmp_dir}/data.csv", "--out", f"{tmp_dir}/{fmt}", "--format", fmt], spark)
        counts[fmt] = main(["load", "--processed", f"{tmp_dir}/{fmt}", "--warehouse", f"{tmp_dir}/wh-{fmt}"], spark)["inserted"]
    assert counts["csv"] == counts["parquet"] and counts["csv"]["fact_sales"] > 0
    tables = [spark.read.parquet(f"{tmp_dir}/wh-{fmt}/fact_sales").drop("sale_id") for fmt in counts]
    assert tables[0].exceptAll(tables[1]).count() == 0
