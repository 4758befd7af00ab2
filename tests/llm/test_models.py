"""Language ID, language model, toxicity and quality: brute force or held-out accuracy, and corner cases."""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import collected, corner_rows, documents, prose
from txnlake.llm import language_id, lm_score, quality, toxicity
from txnlake.llm.tokens import TOKEN_BYTES, WORD_BYTES, WordHasher

SF = "/root/testdata/sf0.01"


def left(i, m=5):
    return zlib.crc32(str(i).encode()) % m


# ---- operator 2

def test_language_id_on_held_out_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = language_id.language_id(docs).join(docs.select("doc_id", "lang", "text"), "doc_id").collect()
    held = [r for r in got if r.held_out and r.lang is not None]
    assert len(held) > 100 and sum(r.lang == r.lang_pred for r in held) >= 0.98 * len(held)
    for r in got:
        assert r.held_out == (left(r.doc_id) == 0) and 0 <= r.score <= 1
        assert (r.lang_pred == "und") == (not re.search(r"[^\W\d_]", r.text or ""))


def test_language_id_reads_text_only(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(300).cache()
    model = language_id.learn(docs)
    blind = docs.withColumn("lang", F.lit(None).cast("string")).withColumn("source", F.lit("?"))
    a, b = (language_id.predictions(d, model, ["doc_id"]).select("row.doc_id", "lang_pred", "score") for d in (docs, blind))
    assert collected(a) == collected(b)


def test_language_id_corner_cases(spark):
    rows = corner_rows()
    df = documents(spark, rows, clash=True)
    got = language_id.language_id(df).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.held_out == (r.doc_id is not None and left(r.doc_id) == 0)
    und = {r.doc_id for r in got if r.lang_pred == "und"}
    assert und == {1, 2, 3, 7}
    kept = language_id.recognised(df)
    assert kept.columns == df.columns and kept.count() == len(rows) - 4
    assert language_id.language_id(df.limit(0)).count() == 0
    unlabelled = language_id.language_id(df.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {(r.lang_pred, r.score) for r in unlabelled} == {("und", 0.0)}
    one = language_id.language_id(df.withColumn("lang", F.lit("xx"))).filter("lang_pred <> 'und'").collect()
    assert {(r.lang_pred, r.score, r.ambiguous) for r in one} == {("xx", 1.0, False)}


def test_language_id_learns_every_language(spark, monkeypatch):
    """More languages than were once learned, and than a task holds at a time."""
    monkeypatch.setattr(language_id, "HELD_LANGUAGES", 7)
    rng = random.Random(3)
    rows = []
    for k in range(80):
        words = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(6)) for _ in range(25)]
        rows += [(20 * k + i, " ".join(rng.choices(words, k=40)), "a", f"l{k}") for i in range(10 if k < 40 else 20)]
    docs = documents(spark, rows)
    assert language_id.learn(docs).languages == sorted({r[3] for r in rows})
    truth = {r[0]: r[3] for r in rows}
    held = language_id.language_id(docs).filter("held_out").collect()
    assert len({truth[r.doc_id] for r in held}) > 64
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.95 * len(held)


@pytest.mark.parametrize("n", [2, 3, 4, 5, 6, 12])
def test_codewords_differ_and_every_bit_splits(n):
    code = language_id.codewords(n)
    assert len({tuple(r) for r in code}) == n
    assert all(-n < c < n for c in code.sum(0))


def test_loss_weighted_decoding_corrects_a_wrong_bit():
    code = language_id.codewords(4)
    model = language_id.Model(list("abcd"), code, np.zeros((language_id.BUCKETS, code.shape[1])), np.ones(code.shape))
    margins = 3.0 * code[2].astype(float)
    margins[0] *= -1
    model.margins = lambda text: margins
    assert model.probabilities("x").argmax() == 2


# ---- operator 4

def brute_lm(docs, backoff):
    tokens = {i: [*re.findall(rb"[^\x20\x09-\x0d]+", (t or "").encode().lower()), None] for i, (_, t) in enumerate(docs)}
    train = [d is not None and left(d) != 1 for d, _ in docs]
    words, pairs, starts = Counter(), Counter(), sum(train)
    for i, w in tokens.items():
        if train[i]:
            words.update(w)
            pairs.update(zip(["<s>", *w[:-1]], w))
    n, v = sum(words.values()), len(words)
    out = []
    for i, (d, _) in enumerate(docs):
        base = full = 0.0
        for h, t in zip(["<s>", *tokens[i][:-1]], tokens[i]):
            root = (words[t] + 0.5) / (n + 0.5 * (v + 1))
            visits = starts if h == "<s>" else words[h]
            b = backoff[int(math.log2(visits))] if visits else 1.0
            base += math.log10(root)
            full += math.log10((1 - b) * pairs[h, t] / visits + b * root if visits else root)
        out.append((d, d is not None and left(d) == 1, len(tokens[i]), sum(words[t] > 0 for t in tokens[i]), n, base, full))
    return out


def same_scores(got, want):
    key = lambda r: (repr(r[:5]), round(r[5], 4))
    got, want = sorted(map(tuple, got), key=key), sorted(want, key=key)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    assert np.allclose([r[5:] for r in got], [r[5:] for r in want], rtol=1e-9, atol=1e-7)


@pytest.mark.parametrize("block_bytes", [lm_score.BLOCK_BYTES, 2000])
def test_lm_score_matches_brute_force(spark, monkeypatch, block_bytes):
    rng = random.Random(4)
    docs = [(i, prose(rng, rng.randrange(60), 80) + rng.choice(["", "\n\tEnd", "  Ünd "])) for i in range(150)]
    docs += [(i, t) for i, t, *_ in corner_rows() if len(t or "") < 50_000]
    fitted = []
    fit = lm_score.fit_backoff
    monkeypatch.setattr(lm_score, "fit_backoff", lambda t: fitted.append(fit(t)) or fitted[-1])
    monkeypatch.setattr(lm_score, "BLOCK_BYTES", block_bytes)
    got = lm_score.lm_score(documents(spark, docs, clash=True).repartition(3)).collect()
    same_scores(got, brute_lm(docs, fitted[0]))


def brute_weights(docs):
    """The weights fitted on every training token of every document."""
    tokens = [[*re.findall(rb"[^\x20\x09-\x0d]+", (t or "").encode().lower()), None]
              for d, t in docs if d is not None and left(d) != 1]
    words, pairs = Counter(w for ts in tokens for w in ts), Counter(p for ts in tokens for p in zip(["<s>", *ts[:-1]], ts))
    n, v, table = sum(words.values()), len(words), np.zeros((lm_score.CLASSES, lm_score.RATIOS))
    for (h, t), seen in pairs.items():
        visits = len(tokens) if h == "<s>" else words[h]
        ratio = (seen - 1) / max(visits - 1, 1) / ((words[t] + 0.5) / (n + 0.5 * (v + 1)))
        at = min(max(int(2 * np.log2(ratio) + lm_score.RATIOS // 2), 1), lm_score.RATIOS - 1) if ratio > 0 else 0
        table[int(math.log2(visits)), at] += seen
    return lm_score.fit_backoff(table)


def test_lm_weights_are_fitted_on_every_block(spark, monkeypatch):
    """Dozens of blocks of two kinds of text; the weights do not depend on the split."""
    rng = random.Random(11)
    docs = [(i, prose(rng, 60, 30 if i < 100 else 3000)) for i in range(200)]
    want, fitted = brute_weights(docs), []
    fit = lm_score.fit_backoff
    monkeypatch.setattr(lm_score, "fit_backoff", lambda t: fitted.append(fit(t)) or fitted[-1])
    monkeypatch.setattr(lm_score, "BLOCK_BYTES", 1000)
    for parts in (1, 5):
        lm_score.lm_score(documents(spark, docs).repartition(parts))
    assert np.allclose(fitted, [want, want], rtol=1e-6)


def test_lm_probabilities_sum_to_one():
    """Over the V words and the unknown one, from a state with and without arcs."""
    rng = random.Random(1)
    texts = [prose(rng, 30, 12) for _ in range(20)]
    words = sorted({w for t in texts for w in t.split()})
    hasher = WordHasher(TOKEN_BYTES)

    def block(lines, train):
        raw = [hasher.spaced(t) for t in lines]
        return lm_score.Block([len(r) for r in raw], zlib.compress(b"".join(raw)), [train] * len(lines))

    trained = block(texts, True)
    counts = dict(zip(trained.words.tolist(), trained.own_counts()[0].tolist()))
    pairs = dict(zip(trained.bigrams.tolist(), trained.own_counts()[1].tolist()))
    n, v = sum(counts.values()), len(counts)
    for history in (words[0], "unseen"):
        b = block([f"{history} {w}" for w in [*words, "never"]] + [history], False)
        reply = {"owner": 0, "words": lm_score._planes(np.array([counts.get(x, 0) for x in b.words.tolist()], np.uint64)),
                 "bigrams": lm_score._planes(np.array([pairs.get(x, 0) for x in b.bigrams.tolist()], np.uint64))}
        p = 10 ** lm_score.Automaton(b, [reply], 20, n, v).traverse(np.full(lm_score.CLASSES, 0.4))
        second = (np.cumsum(b.sizes) - b.sizes) + 1  # every word, the unknown one, and the end
        assert abs(p[second].sum() - 1) < 1e-9


def test_lm_score_beats_the_base_on_held_out_text(spark):
    got = lm_score.lm_score(spark.read.parquet(f"{SF}/documents.parquet")).filter("held_out").collect()
    assert sum(r.score for r in got) > sum(r.base_score for r in got)


def test_lm_score_without_training_or_rows(spark):
    one = next(i for i in range(50) if left(i) == 1)
    df = documents(spark, [(one, "a b"), (None, None)])
    assert {(r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in lm_score.lm_score(df).collect()} == {
        (3, 0, 0, 0.0, 0.0), (1, 0, 0, 0.0, 0.0)}
    assert lm_score.lm_score(df.limit(0)).count() == 0


def test_word_hashes_do_not_depend_on_the_piece(monkeypatch):
    from txnlake.llm import tokens

    rng = random.Random(2)
    text = prose(rng, 500) + " " + "y" * 300 + " tail"
    whole = WordHasher(WORD_BYTES)(text)
    monkeypatch.setattr(tokens, "PIECE", 64)
    assert (WordHasher(WORD_BYTES)(text) == whole).all()
    words = text.split()
    assert len(set(whole.tolist())) == len(set(words)) and len(whole) == len(words)


# ---- operators 5 and 7

CATEGORIES = {"low_quality": "1 - quality", "toxic": "toxic"}


def test_toxicity_on_documents_outside_the_sample(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    known = labels.filter("toxic = 0 OR toxic = 1")
    train, rest = known.filter("crc32(cast(doc_id as string)) % 2 = 0"), known.filter("crc32(cast(doc_id as string)) % 2 = 1")
    got = toxicity.toxicity(docs.join(rest.select("doc_id"), "doc_id").unionByName(docs.join(train.select("doc_id"), "doc_id")),
                            train, CATEGORIES, sample=2000).join(rest, "doc_id").collect()
    hits = sum(r.is_toxic and r.toxic == 1 for r in got)
    assert hits >= 0.9 * sum(r.toxic == 1 for r in got)
    assert sum(r.is_toxic and r.toxic == 0 for r in got) <= 0.02 * len(got)


def test_toxicity_corner_cases(spark):
    rows = corner_rows()
    df = documents(spark, rows, clash=True)
    labels = spark.createDataFrame([(4, 1, 1), (5, 0, 0), (5, 0, 0), (None, 1, 1), (8, None, 0), (99, 1, 1), (10, 1, 0)],
                                   "doc_id long, quality int, toxic int").withColumn("text", F.lit("clash"))
    got = toxicity.toxicity(df, labels, CATEGORIES)
    assert got.count() == len(rows) and got.columns == ["doc_id", "p_low_quality", "p_toxic", "is_toxic"]
    assert all(0 <= r.p_toxic <= 1 for r in got.collect())
    none = toxicity.toxicity(df, labels.limit(0), CATEGORIES).collect()
    assert len(none) == len(rows) and not any(r.is_toxic for r in none)
    assert toxicity.toxicity(df.limit(0), labels, CATEGORIES).count() == 0


def test_quality_agrees_with_labels_it_never_saw(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    got = quality.quality(docs).join(labels, "doc_id").collect()
    good, bad = ([r for r in got if r.quality == q] for q in (1, 0))
    assert sum(r.is_good for r in good) >= 0.97 * len(good)
    assert sum(not r.is_good for r in bad) >= 0.9 * len(bad)


def test_quality_estimates_recover_planted_accuracies():
    rng = np.random.default_rng(0)
    good = rng.random(20_000) < 0.7
    right = np.array([0.95, 0.9, 0.85, 0.8, 0.9, 0.95, 0.9, 0.85, 0.9, 0.9])[:len(quality.LABELLERS)]
    cast = np.where(rng.random((len(good), len(right))) < right, good[:, None], ~good[:, None])
    seen = Counter("".join("-+"[int(v)] for v in row) for row in cast)
    posterior, table, share = quality.estimate(list(seen), np.array(list(seen.values()), float))
    assert abs(share - 0.7) < 0.02
    assert np.abs(table[:, 1, 2] - right).max() < 0.03 and np.abs(table[:, 0, 0] - right).max() < 0.03


def test_quality_corner_cases(spark):
    rows = corner_rows()
    df = documents(spark, rows, clash=True)
    got = quality.quality(df).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and 0 <= r.p_weak <= 1 for r in got)
    assert quality.quality(df.limit(0)).count() == 0
