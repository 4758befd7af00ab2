"""Incremental (streaming) load equals the batch load and is idempotent."""

import os

from txnlake.plans.warehouse import open_warehouse
from txnlake.streaming import incremental

HEADER = "InvoiceNo,StockCode,Description,Quantity,InvoiceDate,UnitPrice,CustomerID,Country\n"


def _csv(path, lines):
    with open(path, "w") as f:
        f.write(HEADER + "".join(lines))


def test_stream_loads_new_files(spark, tmp_dir):
    raw = f"{tmp_dir}/raw"
    os.makedirs(raw)
    _csv(f"{raw}/a.csv", ["1,A,apple,2,2010-12-01 08:26:00,1.5,17850.0,UK\n",
                          "C2,A,apple,-1,2010-12-01 09:00:00,1.5,17850.0,UK\n",
                          "3,POST,postage,1,2010-12-02 10:00:00,18.0,,France\n"])
    q = incremental.start(spark, raw, f"{tmp_dir}/wh", f"{tmp_dir}/ckpt", available_now=True)
    q.awaitTermination(300)
    wh = open_warehouse(spark, f"{tmp_dir}/wh")
    assert (wh.fact_sales.count(), wh.fact_cancellations.count(), wh.fact_non_sale.count()) == (1, 1, 1)
    # A second file, repeating one line and adding one: only the new line lands.
    _csv(f"{raw}/b.csv", ["1,A,apple,2,2010-12-01 08:26:00,1.5,17850.0,UK\n",
                          "4,BX,banana,3,2010-12-03 10:00:00,2.0,12345.0,Japan\n"])
    q = incremental.start(spark, raw, f"{tmp_dir}/wh", f"{tmp_dir}/ckpt", available_now=True)
    q.awaitTermination(300)
    wh = open_warehouse(spark, f"{tmp_dir}/wh")
    assert wh.fact_sales.count() == 2
    assert {r["country"] for r in wh.dim_country.collect()} == {"UK", "France", "Japan"}


def test_rows_that_do_not_parse_are_set_aside(spark, tmp_dir):
    raw = f"{tmp_dir}/raw"
    os.makedirs(raw)
    _csv(f"{raw}/a.csv", ["1,A,apple,2,2010-12-01 08:26:00,1.5,17850.0,UK\n",
                          "2,A,apple,2,no date,1.5,17850.0,UK\n",
                          "3,A,apple,two,2010-12-01 08:26:00,1.5,17850.0,UK\n"])
    q = incremental.start(spark, raw, f"{tmp_dir}/wh", f"{tmp_dir}/ckpt", available_now=True)
    q.awaitTermination(300)
    assert q.exception() is None
    assert open_warehouse(spark, f"{tmp_dir}/wh").fact_sales.count() == 1
    assert spark.read.parquet(f"{tmp_dir}/wh/_rejected").count() == 2
    assert sum(incremental.REJECTED.values()) >= 2
