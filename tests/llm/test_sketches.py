"""Operator 11 against plain Python: sketches, neighbours, merging and estimates."""

from __future__ import annotations

import hashlib
import random
import re

import pytest
from helpers import corner_rows, documents, prose
from pyspark.sql import functions as F

from txnlake.llm import sketches as S

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.translate(LOWER))
    return {hashlib.md5(" ".join(w[i:i + 5]).encode()).hexdigest()[:12] for i in range(max(1, len(w) - 4))} if w else set()


def alike(x, y, k):
    union = sorted(set(x) | set(y))[:k]
    return len([h for h in union if h in x and h in y]) / len(union) if union else 1.0


def brute(rows, k):
    order = sorted(((r[0] is None, -(r[0] or 0), hashlib.md5((r[1] or "").encode()).hexdigest()[:16], r[0], r[1] or "") for r in rows),
                   key=lambda t: t[:3])
    texts = [(t[3], t[4]) for t in order]
    out = []
    for i, (doc_id, text) in enumerate(texts):
        after = texts[(i + 1) % len(texts)][1]
        half = len(text) // 2
        edited = text[:len(text) - half] + after[:half]
        a, b, c = (sorted(shingles(t))[:k] for t in (text, edited, after))
        out.append((doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), "".join(a), "".join(b), alike(a, b, k), alike(a, c, k)))
    return sorted(out, key=repr)


def texts(n=120):
    rng = random.Random(5)
    rows = [(i, prose(rng, rng.randrange(0, 60), 30)) for i in range(n)]
    rows += [(i, rows[i - 1000][1]) for i in range(1000, 1030)]  # copies
    return rows + [(i, rows[i % n][1] + " and some more words at the end") for i in range(2000, 2030)]


@pytest.mark.parametrize("range_bytes", [S.RANGE_BYTES, 150])
def test_fingerprints_match_brute_force(spark, range_bytes):
    rows = texts() + corner_rows()
    got = S.fingerprints(documents(spark, rows, clash=True), k=16, range_bytes=range_bytes).drop("contained_edited", "n_shingles")
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(rows, 16)


def test_fingerprints_of_small_tables(spark):
    assert S.fingerprints(documents(spark, [])).collect() == []
    one = S.fingerprints(documents(spark, [(7, "a b c d e f")])).collect()
    assert len(one) == 1 and one[0].near_next == 1.0 and one[0].n_chars == 11
    empty = S.fingerprints(documents(spark, [(7, None), (8, "")])).collect()
    assert [(r.fingerprint, r.near_edited, r.near_next) for r in empty] == [("", 1.0, 1.0)] * 2


def test_neighbours_with_one_id_on_a_third_of_the_rows(spark):
    rng = random.Random(9)
    rows = [(5, prose(rng, 20)) for _ in range(100)] + [(None, prose(rng, 20)) for _ in range(50)] + [(i, prose(rng, 20)) for i in range(150)]
    got = S.fingerprints(documents(spark, rows), k=16, range_bytes=500).drop("contained_edited", "n_shingles")
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(rows, 16)


def test_sketches_of_parts_merge(spark):
    rng = random.Random(3)
    parts = [(g, prose(rng, 200, 5000)) for g in (1, 1, 1, 2, 2, 3)] + [(4, ""), (3, None)]
    df = S.with_sketch(spark.createDataFrame(parts, "g long, text string").fillna(""), "text", "sketch", k=32)
    got = {r.g: r.sketch for r in S.merged_sketches(df, ["g"], "sketch", k=32).collect()}
    want = {g: sorted(set().union(*[shingles(t or "") for h, t in parts if h == g]))[:32] for g in (1, 2, 3, 4)}
    assert got == want
    two = df.filter("g = 2").collect()
    pair = spark.createDataFrame([(two[0].sketch, two[1].sketch)], "a array<string>, b array<string>")
    assert pair.select(S.merge(F.col("a"), F.col("b"), 32).alias("m")).first().m == want[2]


def test_estimates_stay_near_the_truth(spark):
    """200 pairs with known sets: mean error near 0, spread as the theory says."""
    rng = random.Random(12)
    rows, truth = [], []
    for i in range(200):
        base = prose(rng, 1500, 100_000).split(" ")
        cut = rng.randrange(300, 1400)
        x, y = " ".join(base), " ".join(base[:cut] + prose(rng, 1500 - cut, 100_000).split(" "))
        rows.append((i, x, y))
        a, b = shingles(x), shingles(y)
        truth.append((len(a & b) / len(a | b), len(a & b) / len(a), len(a)))
    df = S.with_sketch(S.with_sketch(spark.createDataFrame(rows, "i long, x string, y string"), "x", "a"), "y", "b")
    got = df.select("i", S.resemblance(F.col("a"), F.col("b")).alias("j"), S.containment(F.col("a"), F.col("b")).alias("c"),
                    S.distinct_shingles(F.col("a")).alias("n")).orderBy("i").collect()
    off = [r.j - t[0] for r, t in zip(got, truth)]
    assert abs(sum(off)) / 200 < 0.012 and max(map(abs, off)) < 4.5 * 0.0442
    assert sum(abs(r.c - t[1]) for r, t in zip(got, truth)) / 200 < 0.07
    assert sum(abs(r.n / t[2] - 1) for r, t in zip(got, truth)) / 200 < 0.1


def test_plan_is_native_with_one_shuffle_of_texts(spark):
    plan = S.fingerprints(documents(spark, texts()))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
    assert plan.count("Exchange") == 1
    # The words of a text are listed before they are looked up, not once per shingle.
    assert not [x for x in plan.splitlines() if "transform(" in x and "regexp_extract_all" in x]


def test_very_long_text(spark):
    rng = random.Random(1)
    rows = [(1, prose(rng, 400_000, 50_000)), (2, "x" * 3_000_000)]
    got = S.fingerprints(documents(spark, rows)).drop("contained_edited", "n_shingles")
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(rows, S.K)
