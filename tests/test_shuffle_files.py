"""Stages leave none of their shuffle files on disk."""

from __future__ import annotations

import time
from concurrent.futures import ThreadPoolExecutor

import pytest
from builders import line, raw_rows
from pyspark.sql import functions as F

from txnlake.operators.ranking import global_rank
from txnlake.plans import checks, etl
from txnlake.plans.published import publish_views
from txnlake.session import shuffles_dropped

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def _shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = (files.apply(i).getName() for i in range(files.size()))
    return {n for n in names if n.startswith("shuffle_")}


def _left(spark, before):
    """Shuffle files that came since and stay (they are deleted in the background)."""
    end = time.time() + 20
    while (left := _shuffle_files(spark) - before) and time.time() < end:
        time.sleep(0.2)
    return left


def _raw(spark):
    return raw_rows(spark, [line(f"{500 + i % 9}", f"c{i % 5}", 1 + i % 3, 2.5, 100 + i % 4) for i in range(60)])


def test_loads_leave_no_shuffle_files(spark, tmp_dir):
    raw, before = _raw(spark), _shuffle_files(spark)
    for part in (0, 1):
        wh = etl.run(spark, raw.filter(F.col("_ord") % 2 == part), f"{tmp_dir}/wh")
    assert not _left(spark, before)
    publish_views(wh, f"{tmp_dir}/views", only=["V24"])
    assert not _left(spark, before)
    assert wh.fact_sales.count() > 0


def test_a_rank_leaves_no_shuffle_files(spark):
    before = _shuffle_files(spark)
    ranked, n = global_rank(spark.range(1000).withColumn("v", F.col("id") % 7), [F.col("v").desc(), F.col("id").asc()])
    assert not _left(spark, before) and n == 1000
    for _ in range(2):  # what is returned may be evaluated again
        assert [r["id"] for r in ranked.orderBy("rank").limit(3).collect()] == [6, 13, 20]


def test_the_ordered_copy_goes_with_its_shuffle_files(spark, tmp_dir, monkeypatch):
    before, paths = _shuffle_files(spark), []
    monkeypatch.setattr(checks, "raw_for", lambda s, sf: _raw(s))
    monkeypatch.setattr(checks, "scratch_path", lambda s, name: paths.append(f"{tmp_dir}/{name}") or paths[-1])
    monkeypatch.setattr(checks, "read_raw", lambda s, ids, data, multi_line: s.read.csv(ids).withColumn("_ord", F.lit(0)))
    assert len(checks._raw_files(spark, "").collect()) > 60
    assert not _left(spark, before)
    from txnlake.session import path_exists

    assert {p: path_exists(spark, p) for p in paths} == {f"{tmp_dir}/raw-files": True, f"{tmp_dir}/ordered": False}


def test_the_setting_is_restored(spark):
    was = spark.conf.get(CLEANUP)
    with pytest.raises(KeyError), shuffles_dropped(spark):
        raise KeyError

    def one(i):
        with shuffles_dropped(spark):
            time.sleep(0.01 * (i % 3))
            return spark.conf.get(CLEANUP)

    with ThreadPoolExecutor(4) as pool:
        assert set(pool.map(one, range(12))) == {"true"}
    assert spark.conf.get(CLEANUP) == was
