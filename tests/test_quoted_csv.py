"""Line ends inside quotes, read by splits: compared with Python's csv module."""

from __future__ import annotations

import csv
import io
import random

import pytest
from pyspark.sql import types as T

from txnlake.sources import files as IO
from txnlake.sources import quoted_csv as Q

SCHEMA = T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.StringType()), T.StructField("n", T.IntegerType())])


def _rows(rng, n):
    cell = lambda: "".join(rng.choice(['x', 'é', ',', '"', '\n', '\r\n', ' ', 'word ']) for _ in range(rng.randrange(1, 14))) + "."
    return [(cell(), cell(), rng.randrange(1000)) for _ in range(n)]


def _text(rows, end):
    out = io.StringIO()
    w = csv.writer(out, lineterminator=end)
    w.writerow(["a", "b\nheader", "n"])
    w.writerows(rows)
    return out.getvalue()


@pytest.fixture()
def small_splits(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "97", "spark.sql.files.openCostInBytes": "1"}
    old = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_records_cut_anywhere(spark, tmp_dir, small_splits, end):
    rng = random.Random(6)
    files = {f"{tmp_dir}/in/{i}.csv": _rows(rng, n) for i, n in enumerate((60, 1, 0, 45))}
    import os
    os.mkdir(f"{tmp_dir}/in")
    for path, rows in files.items():
        with open(path, "w", newline="", encoding="utf-8") as f:
            f.write(_text(rows, end) + end + "  " + end)  # blank lines at the end
    df, total = IO.read_quoted_csv(spark, f"{tmp_dir}/in", SCHEMA)
    assert Q.physical_lines(spark, f"{tmp_dir}/in").rdd.getNumPartitions() > 20
    got = [(r.a, r.b, r.n) for r in df.orderBy("_ord").collect()]
    want = [r for rows in files.values() for r in rows]
    assert total == len(want) and [g[2] for g in got] == [w[2] for w in want]
    assert got == want
    assert sorted(r._ord for r in df.collect()) == list(range(total))


def test_one_record_over_many_splits(spark, tmp_dir, small_splits):
    long = "\n".join(f"line {i}" for i in range(200))
    with open(f"{tmp_dir}/a.csv", "w", newline="") as f:
        f.write(_text([("x", "y", 1), (long, long, 2), ("z", "", 3)], "\n"))
    df, total = IO.read_quoted_csv(spark, f"{tmp_dir}/a.csv", SCHEMA)
    assert total == 3 and [(r.a, r.b, r.n) for r in df.orderBy("_ord").collect()] == [("x", "y", 1), (long, long, 2), ("z", None, 3)]


def test_open_quote_and_bad_rows(spark, tmp_dir):
    with open(f"{tmp_dir}/open.csv", "w") as f:
        f.write('a,b,n\n1,"never closed,2\n3,4,5\n')
    with pytest.raises(Q.UnclosedQuoteError):
        IO.read_quoted_csv(spark, f"{tmp_dir}/open.csv", SCHEMA)
    with open(f"{tmp_dir}/bad.csv", "w") as f:
        f.write('a,b,n\n1,"two\nlines",2\n1,2\n1,2,3,4\n1,2,x\n')
    df, total = IO.read_quoted_csv(spark, f"{tmp_dir}/bad.csv", SCHEMA)
    assert total == 4 and [r._bad for r in df.orderBy("_ord").collect()] == [False, True, True, True]


def test_plan_has_no_python_and_no_multi_line(spark, tmp_dir):
    with open(f"{tmp_dir}/a.csv", "w") as f:
        f.write('a,b,n\n1,"two\nlines",2\n')
    plan = IO.read_quoted_csv(spark, f"{tmp_dir}/a.csv", SCHEMA)[0]._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "multiLine" not in plan


def test_lines_are_neither_shuffled_nor_sorted(spark, tmp_dir):
    with open(f"{tmp_dir}/a.csv", "w") as f:
        f.write('a,b,n\n1,"two\nlines",2\n')
    plan = Q.records(spark, f"{tmp_dir}/a.csv")[0]._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "SortMergeJoin" not in plan
    assert plan.count("Exchange hashpartitioning") == 1 and "Exchange hashpartitioning(file" in plan  # pieces at the edges of splits


def test_batches_cut_records_anywhere(spark, tmp_dir):
    rng = random.Random(7)
    want = _rows(rng, 80)
    with open(f"{tmp_dir}/a.csv", "w", newline="", encoding="utf-8") as f:
        f.write(_text(want, "\n"))
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        got = IO.read_quoted_csv(spark, f"{tmp_dir}/a.csv", SCHEMA)[0].orderBy("_ord").collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    assert [(r.a, r.b, r.n) for r in got] == want
