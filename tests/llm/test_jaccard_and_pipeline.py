"""The n-gram Jaccard join and the pipeline against brute force and DuckDB."""

from __future__ import annotations

import random
import re
from collections import defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from helpers import collected, corner_rows, documents, prose
from txnlake.llm import jaccard_join as J

SF = "/root/testdata/sf0.001"
TABLES = ["documents", "benchmark", "pages"]


def shingle_set(text):
    w = re.findall(rb"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (text or "").encode().lower())
    k = min(5, len(w))
    return frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if w else frozenset()


def brute_classes(rows):
    """(doc_id, class_id, class_size, n_links) of every row."""
    nodes = defaultdict(list)
    for i, (_, t) in enumerate(rows):
        if s := shingle_set(t):
            nodes[s].append(i)
    sets = list(nodes)
    near = [[len(a & b) >= 0.8 * len(a | b) - 1e-9 and a is not b for b in sets] for a in sets]
    label = list(range(len(sets)))
    while (new := [min([label[j] for j in range(len(sets)) if near[i][j]] + [label[i]]) for i in range(len(sets))]) != label:
        label = new
    members = defaultdict(list)
    for i, s in enumerate(sets):
        members[label[i]] += nodes[s]
    out = [(d, d, 1, 0) for d, _ in rows]
    for i, s in enumerate(sets):
        group = members[label[i]]
        ids = [rows[m][0] for m in group if rows[m][0] is not None]
        for m in nodes[s]:
            out[m] = (rows[m][0], min(ids, default=None), len(group), sum(near[i]))
    return out


def near_rows(seed=0, groups=25, size=6, words=60):
    rng = random.Random(seed)
    rows, at = [], 0
    for _ in range(groups):
        base = prose(rng, words, 2000).split()
        for _ in range(rng.randrange(1, size)):
            copy = list(base)
            for _ in range(rng.randrange(4)):
                copy[rng.randrange(len(copy))] = f"x{rng.randrange(50)}"
            rows.append((at, " ".join(copy)))
            at += 1
    return rows


def test_join_matches_brute_force(spark):
    rows = [(i + 500, t) for i, t in near_rows()] + [(i + 1000, t) for i, t in near_rows(1, 10, 5, 12)] + [r[:2] for r in corner_rows()] + [(2000 + i, "one two") for i in range(30)]
    got = J.jaccard_join(documents(spark, rows, clash=True).repartition(4), recall=0.9999)
    assert collected(got.drop("kept")) == sorted(brute_classes(rows), key=repr)
    classes = defaultdict(int)
    for r in got.collect():
        classes[r.class_id, r.class_size] += r.kept
    assert all(v == 1 for (c, n), v in classes.items() if n > 1)


def test_large_buckets_are_dealt_as_blocks(spark, monkeypatch):
    """A large group of near copies, and common passages in unlike texts, with tiny blocks."""
    monkeypatch.setattr(J, "BLOCK_ROWS", 8)
    rng = random.Random(9)
    base, passage = prose(rng, 150, 3000).split(), prose(rng, 12, 3000)
    rows = []
    for i in range(70):
        copy = list(base)
        for _ in range(2):
            copy[rng.randrange(len(copy))] = f"y{i}"
        rows.append((i, " ".join(copy)))
    rows += [(100 + i, prose(rng, 8, 3000) + " " + passage) for i in range(60)]
    rows += [(1000 + i, t) for i, t in near_rows(3, 10)]
    got = J.jaccard_join(documents(spark, rows), recall=0.9999)
    assert collected(got.drop("kept")) == sorted(brute_classes(rows), key=repr)


def test_split_buckets_lose_no_links_at_the_production_recall(spark, monkeypatch):
    """Pairs at exactly 0.8 that share only passages of many other documents: they meet at full depth or not at all."""
    monkeypatch.setattr(J, "BLOCK_ROWS", 8)
    rng = random.Random(18)  # eight runs lose four of the pairs
    passages = [prose(rng, 40, 5000) for _ in range(12)]
    rows = []
    for i in range(0, 400, 2):
        body = rng.sample(passages, 4)
        rows += [(i + j, " ".join(f"{p} own{i + j}x{k}" for k, p in enumerate(body)) + f" own{i + j}y own{i + j}z") for j in range(2)]
    got = J.jaccard_join(documents(spark, rows))
    assert collected(got.drop("kept")) == sorted(brute_classes(rows), key=repr)


def test_recall_of_pairs_at_the_threshold():
    """Pairs at exactly 0.8 meet in the walk at least as often as promised."""
    rng = np.random.default_rng(5)
    runs, met, trials = J.runs_for(), 0, 300
    for _ in range(trials):
        a = np.unique(rng.integers(0, 2 ** 64, 100, dtype=np.uint64))
        b = a[:80] if rng.random() < 0.5 else np.r_[a[:90], rng.integers(0, 2 ** 64, 12, dtype=np.uint64)]
        ends = [set(J.tree(np.sort(x), runs, J.DEPTH)[-1][1].tolist()) for x in (a, b)]
        met += bool(ends[0] & ends[1])
    assert met >= (J.RECALL - 0.03) * trials


def test_sets_survive_packing():
    rng = np.random.default_rng(1)
    for n in (0, 1, 5, 3000):
        tokens = np.unique(rng.integers(0, 2 ** 64, n, dtype=np.uint64))
        assert (J.unpack(J.pack(tokens)) == (tokens >> np.uint64(32)).astype(np.uint32)).all()


def test_without_near_copies_keeps_one_of_each_class(spark):
    rows = [(i + 500, t) for i, t in near_rows(6)] + [r[:2] for r in corner_rows()]
    df = documents(spark, rows, clash=True)
    got = J.without_near_copies(df, recall=0.9999)
    assert got.columns == df.columns
    classes = defaultdict(list)
    for (d, t), c in zip(rows, brute_classes(rows)):
        classes[(c[1], c[2]) if shingle_set(t) else (d, t, len(classes))].append(d)
    want = sorted((min((d for d in ds if d is not None), default=None) for ds in classes.values()), key=repr)
    assert sorted((r.doc_id for r in got.select("doc_id").collect()), key=repr) == want


def test_join_empty_tables(spark):
    none = documents(spark, [(1, "a")]).limit(0)
    assert J.jaccard_join(none).count() == 0 and J.without_near_copies(none).count() == 0
    blank = documents(spark, [(1, None), (1, ""), (2, "?")])
    assert collected(J.jaccard_join(blank)) == [(1, 1, 1, 0, True), (1, 1, 1, 0, True), (2, 2, 1, 0, True)]
    assert J.without_near_copies(blank).count() == 3


@pytest.mark.parametrize("edges", [[], [(1, 2)], [(i, i + 1) for i in range(40)], [(0, i) for i in range(1, 30)] + [(50, 51), (51, 52)]])
def test_components(spark, edges):
    df = spark.createDataFrame([(max(e), min(e)) for e in edges], "a long, b long")
    label = {x: x for e in edges for x in e}
    for _ in label:
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    assert {r.node: r.label for r in J.components(df).collect()} == label


def test_pipeline_matches_duckdb(spark):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got = corpus_pipeline.run(spark, SF)
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert collected(got) == sorted(con.execute(corpus_pipeline.ORACLE_SQL).fetchall(), key=repr)


def test_pipeline_stages_take_corner_cases(spark):
    df = documents(spark, corner_rows() + [(100 + i, t) for i, t in near_rows(2, 5)])
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, df, SF)
        assert out.columns == df.columns, name
        out.collect()
        assert stage(spark, df.limit(0), SF).count() == 0, name


@pytest.mark.parametrize("lang", [None, "und"])
def test_language_stage_keeps_lettered_texts_whatever_the_labels(spark, lang):
    rows = [(*r[:3], lang) for r in corner_rows()]
    stage = dict(corpus_pipeline.STAGES)["language_id"]
    got = stage(spark, documents(spark, rows), SF).select("doc_id", "text", "source")
    assert collected(got) == sorted((r[:3] for r in rows if re.search(r"[^\W\d_]", r[1] or "")), key=repr)


def test_similarity_of_large_buckets_makes_no_row_per_member_and_byte(spark):
    rng = np.random.default_rng(2)
    rows = [(i, bytes(rng.integers(0, 4, J.SKETCH, dtype=np.uint8))) for i in range(60)]
    members = [(i, key) for i in range(60) for key in (1, 2) if key == 1 or i % 3]
    sets = spark.createDataFrame([(i, bytearray(s)) for i, s in rows], "row long, sketch binary")
    got = J._alike(spark.createDataFrame(members, "rep long, key long"), sets)
    assert "Generate" not in got._jdf.queryExecution().executedPlan().toString()
    for r in got.collect():
        held = [s for i, s in rows if (i, r["key"]) in members]
        shares = [sum(a[b] == c[b] for a in held for c in held) / len(held) ** 2 for b in range(0, J.SKETCH, J.SKETCH // 4)]
        assert abs(r["alike"] - sum(shares) / 4) < 1e-12
    assert got.count() == 2


def test_small_buckets_are_compared_together(monkeypatch):
    """Buckets that cross batches, parts of a large one, earlier shared buckets: as pair by pair, and many at once."""
    rng = np.random.default_rng(4)
    rows, bases = [], rng.integers(0, 5, (6, J.SKETCH), dtype=np.uint8)
    for key in range(300):
        cross = key % 3 == 0
        for rep in range(rng.integers(1, 7) if key != 150 else 90):
            s = bases[rng.integers(6)].copy()
            s[rng.integers(0, J.SKETCH, 20)] = rng.integers(0, 5, 20)
            rows.append({"key": key, "pair": key % 2, "cross": cross, "rep": rep, "n": int(rng.integers(40, 60)), "part": int(rng.integers(2)),
                         "sketch": s.tobytes(), "keys": sorted({key, *rng.integers(0, 300, 12).tolist()})})

    def likely(x, y):
        a, b = (np.frombuffer(r["sketch"], np.uint8) for r in (x, y))
        return (x["key"] == y["key"] and x["rep"] != y["rep"] and not (x["cross"] and x["part"] == y["part"])
                and min(x["n"], y["n"]) >= J.THRESHOLD * max(x["n"], y["n"]) - 1e-9
                and ((a == b) & (a > 0)).sum() >= J.LIKELY * (J.SKETCH - ((a == 0) & (b == 0)).sum())
                and not any(k < x["key"] for k in set(x["keys"]) & set(y["keys"])))

    calls = []
    pairs = getattr(J, "_alike_pairs", None)  # one call for many buckets
    monkeypatch.setattr(J, "_alike_pairs", lambda *a: calls.append(1) or pairs(*a), raising=False)
    schema = pa.schema([("key", pa.int64()), ("pair", pa.int64()), ("cross", pa.bool_()), ("rep", pa.int64()), ("n", pa.int64()),
                        ("part", pa.int32()), ("sketch", pa.binary()), ("keys", pa.list_(pa.int64()))])
    table = pa.Table.from_pylist(rows, schema=schema)
    got = [(r["key"], r["rep"]) for b in J._likely(iter(table.to_batches(max_chunksize=37))) for r in b.to_pylist()]
    want = [(x["key"], x["rep"]) for x in rows if any(likely(x, y) for y in rows)]
    assert 100 < len(want) < len(rows) and got == want
    calls.clear()
    list(J._likely(iter(table.to_batches())))
    assert len(calls) == 2  # the last bucket comes alone
