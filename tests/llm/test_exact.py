"""URL filters, decontamination, mixing, line and exact de-duplication."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from helpers import CLASHING, collected, corner_rows, documents, prose
from txnlake.llm import decontaminate, exact_dedup, line_dedup, mixing, url_filter
from txnlake.llm.golomb import rice_decode, rice_encode
from txnlake.llm.registry import URL_RULES

RULES = "host string, path string, verdict string"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# ---- operator 1

def brute_url(url, rules, default="allow"):
    if url is None or "://" not in url:
        return "", "", None, default
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    host = host.translate(LOWER)
    fits = [(len(h + p), v, h + p) for h, p, v in rules if path.startswith(p) and (host == h or host.endswith("." + h))]
    best = max(fits, default=(0, default, None))
    return host, path, best[2], best[1]


URLS = [None, "", "example.org/es/", "http://", "http://EXAMPLE.org/es/x", "http://a.example.org/en/12", "http://example.org/en/2",
        "https://notexample.org/es/", "https://x.com/fr/?a=/de/", "https://x.com/de/#/fr/", "ftp://org?x", "ftp://org/", "a://b://c.com/de/",
        "http://example.org:80/es/", "http://com/de/" + "long/" * 5000, "http://" + "a." * 500 + "com/fr/", "http://ÉX.com/de/", "http://.com/de/"]


def test_url_filter_matches_brute_force(spark):
    rows = [(i, u) for i, u in enumerate(URLS)] + [(0, URLS[4]), (None, URLS[5]), (None, URLS[5])]
    pages = spark.createDataFrame(rows, "page_id long, url string").selectExpr("*", "'x' AS host", "'y' AS rule", "1 AS prefix")
    got = url_filter.url_filter(pages, spark.createDataFrame(URL_RULES, RULES))
    assert collected(got) == sorted(((i, *brute_url(u, URL_RULES)) for i, u in rows), key=repr)


def test_url_filter_rule_corner_cases(spark):
    rules = [("a.com", "/", "allow"), ("a.com", "/", "block"), ("A.com", "/x", "allow"), (None, "/", "block"), ("", "/", "block"), ("b.com", None, "block")]
    pages = spark.createDataFrame([(1, "u://a.com/"), (2, "u://a.com/xy"), (3, "u://b.com"), (4, "u://c.com/")], "page_id long, url string")
    got = {r.page_id: (r.rule, r.verdict) for r in url_filter.url_filter(pages, spark.createDataFrame(rules, RULES)).collect()}
    assert got == {1: ("a.com/", "block"), 2: ("a.com/x", "allow"), 3: ("b.com", "block"), 4: (None, "allow")}


def test_url_filter_empty_tables(spark):
    pages = spark.createDataFrame([(1, "u://a.com/")], "page_id long, url string")
    none = spark.createDataFrame([], RULES)
    assert collected(url_filter.url_filter(pages, none)) == [(1, "a.com", "/", None, "allow")]
    assert url_filter.url_filter(pages.limit(0), spark.createDataFrame(URL_RULES, RULES)).count() == 0


# ---- operator 6

WORDS = re.compile(rb"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def brute_hits(text, items):
    w = WORDS.findall((text or "").encode().lower())
    hit, found = set(), set()
    for item, t in items:
        v = WORDS.findall((t or "").encode().lower())
        if not v:
            continue
        m = min(10, len(v))
        windows = {tuple(v[i:i + m]) for i in range(len(v) - m + 1)}
        for i in range(len(w) - m + 1):
            if tuple(w[i:i + m]) in windows:
                hit.update(range(i, i + m))
                found |= set() if item is None else {str(item)}
    return len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)


def planted(seed=1):
    rng = random.Random(seed)
    items = [(i, prose(rng, rng.choice([1, 2, 3, 7, 9, 10, 11, 25]), 30)) for i in range(12)] + [(None, "w1 w2"), (50, None), (51, "!!"), (3, "again Über")]
    docs = []
    for i in range(60):
        parts = [prose(rng, rng.randrange(15), 30)]
        for _ in range(rng.randrange(3)):
            parts += [rng.choice(items)[1] or "", prose(rng, rng.randrange(6), 30)]
        docs.append((i, rng.choice([" ", ", ", "\n"]).join(parts).upper() if i % 3 else " ".join(parts)))
    return docs, items


@pytest.mark.parametrize("chunk", [decontaminate.CHUNK_WINDOWS, 20])
def test_decontamination_matches_brute_force(spark, chunk):
    docs, items = planted()
    docs += [(i, t) for i, t, *_ in corner_rows()]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.decontamination(documents(spark, docs, clash=True), bench, chunk_windows=chunk)
    assert collected(got) == sorted(((i, *brute_hits(t, items)) for i, t in docs), key=repr)


def test_without_contaminated_keeps_columns_and_rows(spark):
    docs, items = planted(2)
    df = documents(spark, docs + [(None, None), (99, "")], clash=True)
    got = decontaminate.without_contaminated(df, spark.createDataFrame(items, "item_id long, text string"))
    assert got.columns == df.columns
    assert collected(got) == [r for r in collected(df) if not brute_hits(r[1], items)[-1]]


def test_decontamination_empty_tables(spark):
    docs = documents(spark, [(1, "a b c")])
    none = spark.createDataFrame([], "item_id long, text string")
    assert [tuple(r)[1:4] for r in decontaminate.decontamination(docs, none).collect()] == [(3, 0, 0)]
    assert decontaminate.decontamination(docs.limit(0), none).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=40), st.lists(st.lists(st.integers(0, 3), min_size=1, max_size=6), max_size=4))
def test_wu_manber_finds_every_occurrence(text, items):
    words = [b"%d" % x for x in text]
    tables = decontaminate.matchers([(str(i), " ".join(map(str, x))) for i, x in enumerate(items)], width=4)
    hit, found = np.zeros(len(words), bool), set()
    for t in tables:
        t.search(words, hit, found)
    want, who = np.zeros(len(words), bool), set()
    for i, item in enumerate(items):
        m = min(4, len(item))
        for a in range(len(item) - m + 1):
            for b in range(len(text) - m + 1):
                if text[b:b + m] == item[a:a + m]:
                    want[b:b + m] = True
                    who.add(str(i))
    assert (hit == want).all() and found == who


# ---- operator 8

def brute_targets(sizes):
    """Targets by capping and sharing again, with fractions left to floats."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, capped = sum(sizes.values()), set()
    while True:
        free = sum(weight[s] for s in names if s not in capped)
        left = total - sum(3 * sizes[s] for s in capped)
        new = {s for s in names if s not in capped and left * weight[s] > 3 * sizes[s] * free}
        if not new:
            return {s: 3.0 * sizes[s] if s in capped else left * weight[s] / free for s in names}
        capped |= new


def mixing_rows(n=400, seed=3):
    rng = random.Random(seed)
    return [(i, prose(rng, rng.randrange(1, 60)), rng.choice(["a"] * 30 + ["b", "B", "é", None, "zz"])) for i in range(n)] + \
           [(1000, None, "empty"), (1001, " ", "empty"), (1002, None, None), (None, "x y", "a"), (None, "x y", "a")]


def test_mix_reaches_targets_and_agrees_on_reruns(spark):
    rows = mixing_rows()
    plan = mixing.mix_plan(documents(spark, rows, clash=True))
    got = plan.collect()
    assert collected(mixing.mix_plan(documents(spark, rows[::-1]).repartition(5))) == collected(plan)
    sizes = defaultdict(int)
    for _, t, s in rows:
        sizes[s] += len((t or "").split())
    want = brute_targets(sizes)
    by_size = {}
    for r in got:
        assert r.size == 0 or r.taken % r.size == 0 and r.taken <= 3 * r.size
        by_size.setdefault((r.source_size, r.target), 0)
        by_size[(r.source_size, r.target)] += r.taken
    assert len(got) == len(rows)
    assert Counter(by_size.keys()) == Counter({(sizes[s], want[s]): 1 for s in sizes})
    for (size, target), taken in by_size.items():
        assert abs(taken - target) <= 4 * spread([r for r in got if (r.source_size, r.target) == (size, target)])


def spread(plan):
    """Standard deviation of a source's taken words, from the draws' variance."""
    part = [r.target / r.source_size % 1 if r.source_size else 0 for r in plan]
    return sum(r.size ** 2 * f * (1 - f) for r, f in zip(plan, part)) ** 0.5 + 1e-6


def test_null_and_equal_ids_draw_apart(spark):
    """Sources of null ids, of one id, and of one repeated row come near their targets all the same."""
    rng = random.Random(8)
    rows = [(None, prose(rng, rng.randrange(4, 12)), "a") for _ in range(600)] + [(7, prose(rng, rng.randrange(4, 12)), "b") for _ in range(900)] + \
           [(8, "one row again and again", "c")] * 700 + [(None, None, "c")] * 5 + [(i, prose(rng, 8), "d") for i in range(100)]
    docs = documents(spark, rows)
    plan = mixing.mix_plan(docs).collect()
    assert len(plan) == len(rows)
    for key in {(r.source_size, r.target) for r in plan}:
        own = [r for r in plan if (r.source_size, r.target) == key]
        assert abs(sum(r.taken for r in own) - key[1]) <= 4 * spread(own)
    got = Counter(r.doc_id for r in mixing.mix(docs).collect())
    want = Counter()
    for r in plan:
        want[r.doc_id] += r.copies
    assert got == +want


def test_mix_emits_the_planned_copies(spark):
    docs = documents(spark, mixing_rows(), clash=True)
    out = mixing.mix(docs)
    assert out.columns == docs.columns
    got = Counter(r.doc_id for r in out.collect())
    want = Counter()
    for r in mixing.mix_plan(docs).collect():
        want[r.doc_id] += r.copies
    assert got == +want


def test_mix_empty_table(spark):
    none = documents(spark, [(1, "a")]).limit(0)
    assert mixing.mix_plan(none).count() == 0 and mixing.mix(none).count() == 0


def test_mix_plan_is_native(spark):
    plan = mixing.mix(documents(spark, mixing_rows(20)))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# ---- operator 9

def brute_lines(rows, sites):
    spread, first = defaultdict(set), {}
    for i, t, s in rows:
        for line in (t or "").split("\n") if t is not None else []:
            line = line.strip(line_dedup.BLANKS)
            if line:
                spread[line].add((s,))
                if line not in first or first[line] is None or i is not None and i < first[line]:
                    first[line] = i
    out = []
    for i, t, s in rows:
        lines = t.split("\n") if t is not None else []
        kept = [x for x in lines if not (len(spread.get(x.strip(line_dedup.BLANKS), ())) >= sites and first[x.strip(line_dedup.BLANKS)] != i)]
        text = None if t is None else "\n".join(kept)
        gone = len(kept) < len(lines) and not any(x.strip(line_dedup.BLANKS) for x in kept)
        out.append((i, len(lines), len(lines) - len(kept), gone, None if text is None else hashlib.sha256(text.encode()).hexdigest(), text))
    return out


def line_rows():
    rng = random.Random(5)
    common = [prose(rng, 5) for _ in range(6)]
    rows = []
    for i in range(120):
        lines = [prose(rng, 4) for _ in range(rng.randrange(4))] + rng.sample(common, rng.randrange(4))
        rng.shuffle(lines)
        rows.append((i, "\n".join(f" {x}\r" if rng.random() < 0.3 else x for x in lines), rng.choice(["a", "b", "c", "d", "e", "f", None])))
    return rows + [r[:3] for r in corner_rows()] + [(200, common[0], "a"), (201, f"{common[0]}\n\n{common[1]}", "b"), (None, common[2], "c"), (7, "\n\n", "a")]


@pytest.mark.parametrize("sites", [2, 5, 7])
def test_line_dedup_matches_brute_force(spark, sites):
    rows = line_rows()
    got = line_dedup.line_dedup(documents(spark, rows, clash=True), sites)
    assert collected(got) == sorted((r[:5] for r in brute_lines(rows, sites)), key=repr)


def test_without_boilerplate_returns_documents(spark):
    rows = line_rows()
    df = documents(spark, rows, clash=True)
    got = line_dedup.without_boilerplate(df, 5)
    assert got.columns == df.columns
    want = [(r[0], r[5], None if r[5] is None else len(r[5])) for r in brute_lines(rows, 5) if not r[3]]
    assert collected(got.select("doc_id", "text", "n_chars")) == sorted(want, key=repr)
    assert line_dedup.line_dedup(df.limit(0)).count() == 0


def test_line_dedup_plan_is_native(spark):
    plan = line_dedup.without_boilerplate(documents(spark, line_rows()))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# ---- operator 10

def brute_dedup(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[(t or "").translate(LOWER)].append(i)
    out = []
    for t, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        stays = [i == keep for i in ids]
        if keep in ids:
            first = ids.index(keep)
            stays = [j == first for j in range(len(ids))]
        out += [(i, keep, len(ids), s, hashlib.sha256(t.encode()).hexdigest()) for i, s in zip(ids, stays)]
    return sorted(out, key=repr)


def test_exact_dedup_matches_brute_force(spark):
    rng = random.Random(11)
    texts = [prose(rng, rng.randrange(1, 4), 5) for _ in range(200)]
    rows = [(i, t.upper() if i % 2 else t) for i, t in enumerate(texts)] + [r[:2] for r in corner_rows()] + [(i, "hot") for i in range(300, 400)] + [(None, "n"), (None, "N"), (5, "É"), (6, "é")]
    assert collected(exact_dedup.exact_dedup(documents(spark, rows, clash=True).repartition(7))) == brute_dedup(rows)


def test_exact_dedup_empty_table(spark):
    assert exact_dedup.exact_dedup(documents(spark, [(1, "a")]).limit(0)).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 2 ** 64 - 1), max_size=60), st.integers(0, 60))
def test_rice_round_trip(values, shift):
    v = np.sort(np.array([x >> shift for x in values], np.uint64))
    assert (rice_decode(rice_encode(v)) == v).all()


def test_rice_code_is_near_the_entropy():
    v = np.sort(np.random.default_rng(0).integers(0, 2 ** 63, 20_000, dtype=np.uint64))
    assert len(rice_encode(v)) * 8 / len(v) < np.log2(2 ** 63 / 20_000) + 2.1


def test_helpers_cover_clashes():
    assert {"row", "body", "cut", "rate", "fp", "sid"} <= set(CLASHING)


def test_exact_dedup_shuffles_suspects_only(spark, monkeypatch):
    """A full bit table lets every text through and a sparse one few others: same rows."""
    from txnlake.llm import bits

    rng = random.Random(8)
    rows = [(i, prose(rng, 30)) for i in range(400)]
    rows += [(1000 + i, rows[i % 40][1].upper()) for i in range(120)] + [(5000, None), (5001, "")]
    df, want = documents(spark, rows).repartition(5), brute_dedup(rows)
    left = []
    pick = exact_dedup._suspect_texts

    def counted(table):
        left.append(sum(bits.passes(table.value, exact_dedup._leading([hashlib.sha256((t or "").lower().encode()).digest()]))[0]
                        for _, t in rows))
        return pick(table)

    monkeypatch.setattr(exact_dedup, "_suspect_texts", counted)
    assert collected(exact_dedup.exact_dedup(df)) == want
    monkeypatch.setattr(exact_dedup, "bit_table", lambda *_: (48, np.full(1 << 13, 255, np.uint8)))
    assert collected(exact_dedup.exact_dedup(df)) == want
    assert 162 <= left[0] <= 170 and left[1] == len(rows)  # 40 texts with 120 copies, and the two empty ones


def test_line_dedup_marks_little_more_than_the_documents_with_cuts(spark):
    from pyspark.sql import functions as F

    rows = [(i, f"own line {i}\nshared" if i % 20 == 0 else f"own line {i}", f"s{i % 200}") for i in range(2000)]
    rows += [(None, "shared", "x"), (None, None, None)]
    docs = documents(spark, rows)
    own = docs.select(F.struct(*docs.columns).alias("row"), F.xxhash64("text").alias("body"))
    found = line_dedup.cuts(docs).select(F.col("doc_id").alias("id"), F.col("body").alias("of"), "cut")
    may = {(r.row.doc_id, r.row.text) for r in line_dedup._marked(own, found).filter("may").collect()}
    cut = {(i, t) for i, t, _ in rows if "shared" in (t or "") and i != 0}
    assert found.count() == len(cut) and cut <= may and len(may) <= len(cut) + 80
    none = found.limit(0)
    assert line_dedup._marked(own, none).filter("may").count() == 0 and line_dedup._marked(own, none).count() == len(rows)
