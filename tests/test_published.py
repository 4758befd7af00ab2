"""S9 published views and S10 export to single files."""

import csv
import os

import pytest
from builders import line, raw_rows
from pyspark.sql import functions as F

from txnlake.operators.transform import transform
from txnlake.plans import catalog
from txnlake.plans.published import attach_views, newest, publish_views
from txnlake.plans.warehouse import build
from txnlake.sources import single_csv


@pytest.fixture(scope="module")
def wh(spark):
    rows = [line(f"{'C' if i % 7 == 3 else ''}{i}", f"S{i % 4}", (-1 if i % 7 == 3 else 1) * (1 + i % 3), 2.0 + i, i % 3 + 1)
            for i in range(40)]
    return build(transform(raw_rows(spark, rows)))


@pytest.fixture(autouse=True)
def no_schemas_left(spark):
    yield
    for name in {v.namespace for v in catalog.VIEWS}:
        spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")


def _rows(df):
    return sorted(map(str, df.collect()))


def test_published_views_are_there_for_another_session(spark, wh, tmp_dir):
    publish_views(wh, tmp_dir, only=["V1", "V22", "V24"])
    other = spark.newSession()
    assert set(attach_views(other, tmp_dir)) == {"sales.total_revenue", "customer.revenue_concentration", "customer.rfm_segments"}
    for vid, name in (("V24", "customer.rfm_segments"), ("V22", "customer.revenue_concentration")):
        assert _rows(other.sql(f"SELECT * FROM {name}")) == _rows(catalog.BY_ID[vid].fn(wh))


def test_refresh_moves_to_the_new_version_and_sweeps(spark, wh, tmp_dir):
    for expected in (1, 2, 3):
        assert publish_views(wh, tmp_dir, only=["V1"]) == expected
        attach_views(spark, tmp_dir)
        assert spark.sql("SELECT count(*) FROM sales.total_revenue").first()[0] == 1
    assert [n for n in sorted(os.listdir(tmp_dir)) if n.startswith("v")] == ["v000000000002", "v000000000003"]


def test_a_refresh_that_fails_stays_invisible(spark, wh, tmp_dir, monkeypatch):
    publish_views(wh, tmp_dir, only=["V1"])
    broken = catalog.View("V1", "sales", "total_revenue", lambda w: w.fact_sales.select("nothing"), "x.csv")
    monkeypatch.setattr(catalog, "VIEWS", [broken])
    with pytest.raises(Exception, match="nothing"):
        publish_views(wh, tmp_dir)
    assert newest(spark, tmp_dir) == 1 and attach_views(spark, tmp_dir) == ["sales.total_revenue"]


def test_a_table_of_somebody_else_is_not_replaced(spark, wh, tmp_dir):
    publish_views(wh, f"{tmp_dir}/views", only=["V1"])
    spark.sql(f"CREATE DATABASE sales LOCATION '{tmp_dir}/own'")
    spark.range(3).write.saveAsTable("sales.total_revenue")
    with pytest.raises(ValueError, match="not a published view"):
        attach_views(spark, f"{tmp_dir}/views")
    assert spark.table("sales.total_revenue").count() == 3


def test_attach_without_views(spark, tmp_dir):
    with pytest.raises(FileNotFoundError):
        attach_views(spark, tmp_dir)


def test_query_runs_the_text_as_it_is(spark, wh):
    got = catalog.query(spark, wh, "SELECT 'sales.total_revenue' AS name, count(*) AS n FROM customer.rfm_segments -- sales.revenue_trends").first()
    assert got["name"] == "sales.total_revenue" and got["n"] == catalog.BY_ID["V24"].fn(wh).count()
    both = catalog.query(spark, wh, "SELECT a.total_sales_revenue = b.total_sales_revenue AS same FROM sales.total_revenue a, sales_total_revenue b")
    assert both.first()["same"]


def test_export_to_single_files(spark, wh, tmp_dir):
    report = catalog.export_all(wh, tmp_dir, single_file=True)
    assert report["failed"] == [] and report["folders"] == [] and len(report["succeeded"]) == len(catalog.VIEWS) == 49
    assert all(os.path.isfile(f"{tmp_dir}/{v.export}") for v in catalog.VIEWS)
    assert not [n for n in os.listdir(tmp_dir) if os.path.isdir(f"{tmp_dir}/{n}")]  # no scratch is left
    with open(f"{tmp_dir}/customer_order_counts.csv") as f:
        rows = list(csv.DictReader(f))
    counts = [int(r["number_of_orders"]) for r in rows]
    assert counts == sorted(counts, reverse=True) and len(rows) == catalog.BY_ID["V19"].fn(wh).count()
    again = catalog.export_all(wh, tmp_dir, only=["V19"], single_file=True)  # replaces the file
    assert again["failed"] == [] and len(list(csv.DictReader(open(f"{tmp_dir}/customer_order_counts.csv")))) == len(rows)


def test_a_failing_view_stops_no_other(wh, tmp_dir, monkeypatch):
    def fail(_):
        raise RuntimeError("broken view")
    views = [catalog.BY_ID["V1"], catalog.View("VX", "sales", "broken", fail, "broken.csv"), catalog.BY_ID["V3"]]
    monkeypatch.setattr(catalog, "VIEWS", views)
    report = catalog.export_all(wh, tmp_dir, single_file=True)
    assert report["succeeded"] == ["total_revenue_sales.csv", "revenue_by_year_n_month.csv"]
    assert [name for name, _ in report["failed"]] == ["broken.csv"] and "broken view" in report["failed"][0][1]


def test_parts_are_joined_in_order_with_one_header(spark, tmp_dir):
    df = spark.range(1000).select("id", F.concat(F.lit('a "q", '), "id").alias("text")).repartitionByRange(13, "id").sortWithinPartitions("id")
    assert single_csv.write_single_csv(df, f"{tmp_dir}/x.csv")
    with open(f"{tmp_dir}/x.csv") as f:
        lines = f.read().splitlines()
    assert lines[0] == "id,text" and len(lines) == 1001
    assert [int(x.split(",")[0]) for x in lines[1:]] == list(range(1000))
    assert not single_csv.write_single_csv(df, f"{tmp_dir}/x.csv", merge_limit=100)  # too large: the folder of parts
    assert spark.read.option("header", True).csv(f"{tmp_dir}/x.csv").count() == 1000
    assert single_csv.write_single_csv(df.limit(0), f"{tmp_dir}/x.csv")
    assert open(f"{tmp_dir}/x.csv").read() == "id,text\n"
