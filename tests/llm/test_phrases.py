"""Operator 13 against plain counting, with collisions forced and parts cut small."""

from __future__ import annotations

import collections
import random
import re

import pytest
from helpers import collected, corner_rows, documents, prose

from txnlake.llm import fingerprints, phrases

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, min_count, top=2000, percent=100):
    counts, totals = collections.Counter(), collections.Counter()
    for r in rows:
        lang = r[3] if len(r) > 3 else "en"
        lang = "und" if lang is None else lang
        totals[lang] += 0
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (r[1] or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(w)
            for m in range(1, 6):
                for i in range(len(w) - m + 1):
                    counts[lang, tuple(w[i:i + m])] += 1
    cand = {k: f for k, f in counts.items() if len(k[1]) >= 2 and f >= min_count}
    out = collections.defaultdict(list)
    for (lang, p), a in cand.items():
        inside = any(q_lang == lang and len(q) > len(p) and 100 * f >= percent * a
                     and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1)) for (q_lang, q), f in cand.items())
        if inside:
            continue
        cuts = []
        for k in range(1, len(p)):
            left, right = counts[lang, p[:k]], counts[lang, p[k:]]
            cuts.append((1000 * a * totals[lang] // (left * right), k, left, right))
        score, _, left, right = min(cuts)
        out[lang].append((-score, -a, " ".join(p).encode(), left, right))
    rows = []
    for lang, found in out.items():
        for rank, (score, a, p, left, right) in enumerate(sorted(found)[:top], 1):
            rows.append((lang, rank, p.decode(), -a, left, right, totals[lang], -score))
    return sorted(rows, key=repr)


def texts(seed=3, n=150):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        words = [rng.choice("Ab ab É x1 _ - \x1c ü. c, d e\t f g; h\n i".split(" ")) for _ in range(rng.randrange(0, 60))]
        lang = rng.choice(["en", "de", None, "und", ""])
        rows.append((i, rng.choice([" ", "  ", "\t"]).join(words) + " new york city hall" * (i % 3), "a", lang))
    return rows


@pytest.mark.parametrize("bits", [64, 9])
def test_phrases_match_brute_force(spark, bits):
    """With 9-bit fingerprints nearly all phrases collide and are counted by their text."""
    rows = texts() + corner_rows()[:-1]
    got = phrases.collocations(documents(spark, rows, clash=bits == 64), min_count=9, bits=bits)
    want = brute(rows, 9)
    assert len(want) > 60
    assert collected(got) == want


def test_phrases_top_and_subsumption(spark):
    rows = texts(5, 120)
    got = phrases.collocations(documents(spark, rows), min_count=6, top=7, subsumed_percent=60)
    assert collected(got) == brute(rows, 6, 7, 60)


def test_phrases_of_parts_of_long_texts(spark, monkeypatch):
    """Slices of 64 bytes: almost every phrase crosses a cut."""
    monkeypatch.setattr(fingerprints, "SLICE", 64)
    rng = random.Random(11)
    rows = [(i, prose(rng, 3_000, 6) + "y" * 500 + " " + prose(rng, 300, 6)) for i in range(3)] + texts(8, 20)
    got = phrases.collocations(documents(spark, rows), min_count=20)
    assert collected(got) == brute(rows, 20)


def test_every_gram_lies_in_one_slice():
    rng = random.Random(2)
    text = " ".join("".join(rng.choice("abc.") for _ in range(rng.randrange(1, 40))) for _ in range(4000)).encode()
    old, fingerprints.SLICE = fingerprints.SLICE, 100
    try:
        for n in (1, 2, 5):
            slicer = fingerprints.Slicer(phrases.SPACES, phrases.BREAKS, n - 1)
            got = [w.text(i, n) for w in slicer([text]) for i in range(len(w) - n + 1) if w.whole(n)[i]]
            want = []
            for piece in re.split(r"[.,;:!?\x0A-\x0D]", text.decode()):
                ws = piece.split()
                want += [" ".join(ws[i:i + n]) for i in range(len(ws) - n + 1)]
            assert sorted(got) == sorted(want)
    finally:
        fingerprints.SLICE = old


def test_exact_scores_beyond_64_bits(spark):
    """1000 * a * n passes 2 ** 63 in the products; the expression is the operator's own."""
    a, n, left, right = 10 ** 11 + 7, 10 ** 13 + 3, 10 ** 12 + 1, 10 ** 12 + 9
    df = spark.createDataFrame([(a, n, left, right)], "a long, n long, l long, r long")
    assert df.select(phrases.exact_score().alias("s")).first().s == 1000 * a * n // (left * right)


def test_phrases_of_nothing(spark):
    assert phrases.collocations(documents(spark, [])).collect() == []
    assert phrases.collocations(documents(spark, [(1, None), (2, "too few words")])).collect() == []


def test_each_length_is_counted_in_one_pass(spark, monkeypatch):
    """A pass sends what the a-priori rule lets through, whether it turns out frequent or not: no row count jumps with the threshold."""
    passes = []
    count = phrases._count
    monkeypatch.setattr(phrases, "_count", lambda n, *a: passes.append(n) or count(n, *a))
    monkeypatch.setattr(phrases, "_count_buckets", lambda n, *a: pytest.fail("a second pass"), raising=False)
    rows = texts(7, 60)
    got = phrases.collocations(documents(spark, rows), min_count=9)
    assert collected(got) == brute(rows, 9)
    assert passes == [1, 2, 3, 4, 5]
