"""Language ID, toxicity chain and weak labels against plain loops over a few texts."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from helpers import documents, prose
from txnlake.llm import language_id, quality, toxicity


def sigmoid(z):
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def adam(features, dense, target, scale, steps=150, rate=0.1, ridge=1e-4):
    """Weights by feature (of the scaled features) and [bias, dense weights], one number at a time."""
    names = sorted({f for row in features for f in row})
    w = {("w", f): 0.0 for f in names} | {("x", j): 0.0 for j in range(1 + len(dense[0]))}
    m, v = dict.fromkeys(w, 0.0), dict.fromkeys(w, 0.0)
    for step in range(1, steps + 1):
        grad = {k: ridge * x if k[0] == "w" else 0.0 for k, x in w.items()}
        for row, extra, y in zip(features, dense, target):
            inputs = [1.0, *extra]
            z = sum(w["w", f] * scale(f) for f in row) + sum(w["x", j] * x for j, x in enumerate(inputs))
            error = (sigmoid(z) - y) / len(target)
            for f in row:
                grad["w", f] += error * scale(f)
            for j, x in enumerate(inputs):
                grad["x", j] += error * x
        for k, g in grad.items():
            m[k] += 0.1 * (g - m[k])
            v[k] += 0.01 * (g * g - v[k])
            w[k] -= rate * (m[k] / (1 - 0.9 ** step)) / (math.sqrt(v[k] / (1 - 0.99 ** step)) + 1e-8)
    return {f: w["w", f] * scale(f) for f in names}, [w["x", j] for j in range(1 + len(dense[0]))]


def score(row, extra, model):
    words, more = model
    return sigmoid(sum(words.get(f, 0.0) for f in row) + sum(a * b for a, b in zip(more, [1.0, *extra])))


# ---- operator 2

def gram_buckets(text):
    data = bytes(c if chr(c).isalpha() and c < 128 or c >= 128 else 32 for c in f" {text.lower()} ".encode())
    for n in (2, 3, 4):
        for i in range(len(data) - n + 1):
            h = n
            for c in data[i:i + n]:
                h = (h * 0x9E3779B1 + c) % 2 ** 32
            yield ((h ^ h >> 15) * 0x85EBCA77 % 2 ** 32) >> 18


def brute_language(rows):
    train = [(t, lang) for d, t, _, lang in rows if d is not None and zlib.crc32(str(d).encode()) % 5 and t is not None and lang]
    langs = sorted({lang for _, lang in train})
    code, size = language_id.codewords(len(langs)), language_id.BUCKETS
    bits = range(code.shape[1])
    counts = {lang: Counter(g for t, x in train if x == lang for g in gram_buckets(t)) for lang in langs}
    totals = {lang: sum(counts[lang].values()) for lang in langs}

    def weight(bucket, bit):
        sides = defaultdict(list)
        for i, lang in enumerate(langs):
            sides[code[i][bit]].append((counts[lang][bucket] + 0.5) / (totals[lang] + 0.5 * size))
        return math.log(sum(sides[1]) / len(sides[1])) - math.log(sum(sides[-1]) / len(sides[-1]))

    def margins(text):
        grams = list(gram_buckets(text))
        return [sum(weight(g, b) for g in grams) / math.sqrt(max(1, len(grams))) for b in bits]

    trust = []
    for i, lang in enumerate(langs):
        own = [margins(t) for t, x in train if x == lang]
        right = [max(sum(m[b] * code[i][b] > 0 for m in own) / len(own) - 0.5, 0.01) for b in bits]
        trust.append([x / sum(right) * len(right) for x in right])
    out = []
    for d, t, *_ in rows:
        if not re.search(r"[^\W\d_]", t or ""):
            out.append((d, "und", 0.0, 0.0))
            continue
        m = margins(t)
        loss = [sum(math.log1p(math.exp(-code[i][b] * m[b])) * trust[i][b] for b in bits) for i in range(len(langs))]
        p = [math.exp(min(loss) - x) for x in loss]
        ranked = sorted((x / sum(p) for x in p), reverse=True)
        out.append((d, langs[p.index(max(p))], ranked[0], ranked[0] - ranked[1]))
    return out


@pytest.mark.parametrize("n_languages", [2, 3, 6])
def test_language_id_matches_plain_loops(spark, n_languages):
    rng = random.Random(n_languages)
    rows = [(None, "Übung ohne Nummer", "a", "l0"), (900, None, "a", "l1"), (901, "12 !", "a", "l1"), (902, "x" * 300, "a", None)]
    for k in range(n_languages):
        letters = "".join(rng.sample("abcdefghijklmnopqrstuvwxyzäöüß", 12))
        words = ["".join(rng.choices(letters, k=5)) for _ in range(15)]
        rows += [(100 * k + i, " ".join(rng.choices(words, k=rng.randint(1, 12))).title(), "a", f"l{k}") for i in range(12)]
    got = {r.doc_id: r for r in language_id.language_id(documents(spark, rows).repartition(3)).collect()}
    assert len(got) == len(rows)
    for doc_id, lang, probability, lead in brute_language(rows):
        r = got[doc_id]
        assert r.score == pytest.approx(probability, abs=1e-4)
        if lead > 1e-3 or lang == "und":
            assert r.lang_pred == lang
        if abs(lead - language_id.AMBIGUOUS_LEAD) > 1e-3 and lang != "und":
            assert r.ambiguous == (lead < language_id.AMBIGUOUS_LEAD)


# ---- operator 5

def drawn(seed, doc_id):
    return int(hashlib.md5(f"{seed}:{doc_id}".encode()).hexdigest()[:13], 16) / 2 ** 52


def words_of(text):
    return sorted({zlib.crc32(w) % toxicity.BUCKETS for w in re.findall(rb"[0-9a-z\x80-\xff]+", (text or "").lower().encode())})


def brute_chain(train, texts):
    """train: id -> (text, labels). The full chain's probabilities of each text, and the last cut-off."""
    ids = sorted(train)
    fold = {i: int(drawn("fold", i) * toxicity.FOLDS) for i in ids}
    earlier, full, cut = {i: [] for i in ids}, [], 0.5
    for c in range(2):
        models, out = {}, []
        for left_out in [*range(toxicity.FOLDS), None]:
            rows = [i for i in ids if fold[i] != left_out]
            y = [float(train[i][1][c]) for i in rows]
            feats = [words_of(train[i][0]) for i in rows]
            seen, hits = Counter(f for r in feats for f in r), Counter(f for r, t in zip(feats, y) if t for f in r)

            def scale(f):
                odds = (math.log((hits[f] + 1) / (sum(y) + 2)) - math.log((seen[f] - hits[f] + 1) / (len(y) - sum(y) + 2)))
                return odds * seen[f] / (seen[f] + 3) if seen[f] >= 3 else 0.0
            values = {f: scale(f) for f in seen}
            assert 0 < sum(y) < len(y)
            models[left_out] = adam(feats, [earlier[i] for i in rows], y, values.get)
            out += [(score(words_of(train[i][0]), earlier[i], models[left_out]), train[i][1][c]) for i in ids if fold[i] == left_out]
        for i in ids:
            earlier[i] = [*earlier[i], score(words_of(train[i][0]), earlier[i], models[fold[i]])]
        full.append(models[None])
        out.sort(reverse=True)
        hits = [sum(y for _, y in out[:k + 1]) for k in range(len(out))]
        f1 = [2 * h / (k + 1 + sum(y for _, y in out)) for k, h in enumerate(hits)]
        best = f1.index(max(f1))
        cut = (out[best][0] + (out[best + 1][0] if best + 1 < len(out) else 0.0)) / 2
    result = []
    for t in texts:
        p = []
        for model in full:
            p.append(score(words_of(t), p, model))
        result.append(p)
    return result, cut


def test_toxicity_chain_matches_plain_loops(spark):
    rng = random.Random(5)
    texts, labels = {}, []
    for i in range(45):
        bad, toxic = rng.random() < 0.4, rng.random() < 0.4
        words = prose(rng, 12, 30).split() + ["junk"] * (bad and rng.random() < 0.9) + ["vile", "Vile!"] * (toxic and rng.random() < 0.9)
        texts[i] = " ".join(rng.sample(words, len(words)))
        labels.append((i, 1 - bad, int(toxic)))
    # Conflicting labels of one id: the maximum counts. An id of two texts: the least.
    labels += [(3, 1, 1), (3, 0, 0), (7, 1, 0), (7, 0, 1)]
    rows = [*texts.items(), (7, "a first text"), (100, "a vile text without labels"), (101, None), (102, "")]
    train = {i: (texts[i], [1 - good, toxic]) for i, good, toxic in labels[:45]}
    train[3], train[7] = (texts[3], [1, 1]), (min(texts[7], "a first text"), [1, 1])
    want, cut = brute_chain(train, [t for _, t in rows])
    labels_df = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = toxicity.toxicity(documents(spark, rows, clash=True), labels_df, {"low_quality": "1 - quality", "toxic": "toxic"})
    made = sorted((r.doc_id, round(r.p_low_quality, 6), r.p_low_quality, r.p_toxic, r.is_toxic) for r in got.collect())
    brute = sorted((d, round(p[0], 6), *p, p[1] >= cut) for (d, _), p in zip(rows, want))
    assert len(made) == len(brute)
    for a, b in zip(made, brute):
        assert a[0] == b[0] and a[2] == pytest.approx(b[2], abs=1e-4) and a[3] == pytest.approx(b[3], abs=1e-4)
        assert a[4] == b[4] or abs(b[3] - cut) < 1e-4


# ---- operator 7

def brute_em(patterns, steps=200):
    """Posterior of 'good' by vote pattern, one document at a time."""
    good = {p: 0.1 if "-" in p else 0.9 for p in patterns}
    n_labellers = len(patterns[0])
    for _ in range(steps):
        share = (sum(good[p] for p in patterns) + 1) / (len(patterns) + 2)
        table = []
        for label in range(n_labellers):
            row = {}
            for kind in (0, 1):
                mass = {v: 1.0 for v in "-0+"}
                for p in patterns:
                    mass[p[label]] += good[p] if kind else 1 - good[p]
                row[kind] = {v: x / sum(mass.values()) for v, x in mass.items()}
            table.append(row)
        good = {p: sigmoid(math.log(share / (1 - share)) + sum(math.log(table[i][1][v] / table[i][0][v]) for i, v in enumerate(p)))
                for p in good}
    return good


def test_quality_matches_plain_loops(spark):
    rng = random.Random(6)
    texts = []
    for i in range(50):
        kind = rng.randrange(4)
        words = ["".join(rng.choices("abcdefghij", k=rng.randint(3, 8))) for _ in range(rng.randint(5, 60))]
        texts.append(" ".join(words) + "." if kind < 2 else " ".join(words).upper() + "!!! $$ ##" if kind == 2 else "spam $ " * rng.randint(3, 9))
    texts += [texts[0], texts[1], "", None]
    stats = [quality.statistics(t or "") for t in texts]
    patterns = [quality.pattern(s) for s in stats]
    posterior = brute_em(patterns)
    distinct = list(dict.fromkeys(zip(texts, patterns, map(str, stats))))
    feats = [quality.features(t or "", quality.statistics(t or "")).tolist() for t, *_ in distinct]
    model = adam(feats, [[] for _ in feats], [posterior[p] for _, p, _ in distinct], lambda f: 1.0)
    got = {r.doc_id: r for r in quality.quality(documents(spark, list(enumerate(texts)), clash=True).repartition(3)).collect()}
    for i, t in enumerate(texts):
        assert got[i].p_weak == pytest.approx(posterior[patterns[i]], abs=1e-6)
        want = score(quality.features(t or "", stats[i]).tolist(), [], model)
        assert got[i].score == pytest.approx(want, abs=1e-3)
        assert got[i].is_good == (want >= quality.CUT) or abs(want - quality.CUT) < 1e-3


def test_statistics_of_a_text():
    s = quality.statistics("One two THREE! one two THREE! $ x")
    assert s["words"] == 8 and s["symbols"] == 1 / 8 and s["marks"] == s["stops"] == 2 / 8 and s["single"] == 2 / 8
    assert s["fresh"] == 6 / 6 and s["shout"] == 11 / 23 and s["length"] == 33 / 8 and s["vocabulary"] == 6 / 8 ** 0.75
    assert s["plain"] == 7 / 8
