"""Operator 7, quality by a weak-label model and a hashed linear scorer.

Overlapping heuristic labellers vote good, bad or nothing on every document.
Votes are counted by pattern (at most 3 ** labellers patterns, whatever the
input) over all documents; expectation-maximisation on those counts
estimates how each labeller votes on good and on bad documents, and so each
pattern's posterior. The posteriors of a bounded sample of documents train a
linear scorer on hashed byte pairs and hashed statistics, which scores every
document.

Defined results: a null text counts as empty; an empty text is scored like
any other; repeated rows are scored alike; an empty table gives no rows;
other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .linear import Rows, fit, sigmoid

BUCKETS = 1 << 14
SAMPLE = 4000
CUT = 0.5
_SYMBOLS = b"#$%&*|{}<>~^=_\\@"
_UPPER = bytes(range(65, 91))
_LOWER = bytes(range(97, 123))


def statistics(text: str) -> dict[str, float]:
    data = text.encode("utf-8", "surrogatepass")
    words = text.split()
    n = max(1, len(words))
    upper, lower = (len(data) - len(data.translate(None, x)) for x in (_UPPER, _LOWER))
    triples = list(zip(words, words[1:], words[2:]))
    return {
        "words": len(words),
        "symbols": (len(data) - len(data.translate(None, _SYMBOLS))) / n,
        "shout": upper / max(1, upper + lower),
        "marks": data.count(b"!") / n,
        "fresh": len(set(triples)) / len(triples) if triples else 1.0,
        "stops": sum(data.count(c) for c in (b".", b"?", b"!")) / n,
        "length": len(text) / n,
        "single": sum(len(w) == 1 for w in words) / n,
        "vocabulary": len(set(words)) / n ** 0.75,
        "plain": sum(w.rstrip(".,;:!?").isalnum() and not w.endswith("!!") for w in words) / n,
    }


def _vote(good: bool, bad: bool) -> int:
    return 1 if good else -1 if bad else 0


#: Each labeller: 1 good, -1 bad, 0 abstains.
LABELLERS = {
    "symbols": lambda s: _vote(s["symbols"] < 0.05, s["symbols"] > 0.2),
    "case": lambda s: _vote(s["shout"] < 0.3, s["shout"] > 0.6),
    "marks": lambda s: _vote(s["marks"] < 0.05, s["marks"] > 0.2),
    "repeats": lambda s: _vote(s["words"] >= 3 and s["fresh"] > 0.7, s["fresh"] < 0.5),
    "sentences": lambda s: _vote(0.005 < s["stops"] < 0.4, s["words"] >= 20 and not 0.005 < s["stops"] < 0.6),
    "word_length": lambda s: _vote(3 < s["length"] < 12, s["words"] > 0 and not 2 < s["length"] < 15),
    "single": lambda s: _vote(s["single"] < 0.15, s["single"] > 0.3),
    "vocabulary": lambda s: _vote(s["words"] >= 20 and s["vocabulary"] > 0.8, s["words"] >= 20 and s["vocabulary"] < 0.4),
    "plain": lambda s: _vote(s["plain"] > 0.85, s["plain"] < 0.7),
    "length": lambda s: _vote(s["words"] >= 30, s["words"] == 0),
}


def pattern(stats: dict[str, float]) -> str:
    """The labellers' votes as one string of -, 0 and +."""
    return "".join("-0+"[label(stats) + 1] for label in LABELLERS.values())


def features(text: str, stats: dict[str, float]) -> np.ndarray:
    """Hashed distinct byte pairs and hashed bins of the statistics."""
    b = np.frombuffer(f" {text} ".encode("utf-8", "surrogatepass"), np.uint8).astype(np.int64)
    pairs = np.unique(b[:-1] << 8 | b[1:])
    bins = [(i + 1) * 40503 + int(np.clip(np.log2(v + 1e-3) * 2, -20, 40)) + 20
            for i, v in enumerate(stats.values())]
    h = np.concatenate([pairs, np.array(bins) + (1 << 20)]).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return np.unique(h >> np.uint64(50)).astype(np.int64)


def _votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        cast = pa.array([pattern(statistics(t.as_py() or "")) for t in batch.column(0)], pa.string())
        yield pa.RecordBatch.from_arrays([cast], names=["votes"])


def estimate(patterns: list[str], counts: np.ndarray, steps: int = 200) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """EM over vote patterns: (posterior of 'good' per pattern, vote
    probabilities [labeller, class, vote], share of good)."""
    if not patterns:
        return np.empty(0), np.full((len(LABELLERS), 2, 3), 1 / 3), np.array(0.5)
    cast = np.array([["-0+".index(c) for c in p] for p in patterns])
    onehot = np.eye(3)[cast]  # patterns x labellers x votes
    # Bad documents are bad in different ways, so one vote against starts a pattern as bad.
    good = np.where((cast == 0).any(1), 0.1, 0.9)
    for _ in range(steps):
        by_class = np.stack([1 - good, good]) * counts  # classes x patterns
        table = np.einsum("cp,plv->lcv", by_class, onehot) + 1
        table /= table.sum(2, keepdims=True)
        share = (by_class[1].sum() + 1) / (counts.sum() + 2)
        lean = np.log(table[:, 1] / table[:, 0])
        good = sigmoid(np.log(share / (1 - share)) + np.einsum("plv,lv->p", onehot, lean))
    return good, table, share


def _train(posterior: dict[str, float]):
    def train(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["votes", "features"], key=lambda c: c.map(lambda f: tuple(f[:20])), kind="stable")
        w, extra = fit(Rows([np.asarray(f) for f in group["features"]]),
                       np.array([posterior[v] for v in group["votes"]]), BUCKETS)
        return pd.DataFrame({"weights": [np.r_[extra, w].astype(np.float32).tobytes()]})
    return train


def learn(docs: DataFrame, sample: int = SAMPLE) -> tuple[dict[str, float], np.ndarray]:
    """(posterior of 'good' per vote pattern, [bias, weights] of the linear scorer)."""
    seen = docs.select("text").mapInArrow(_votes, "votes string").groupBy("votes").count().orderBy("votes").collect()  # at most 3 ** labellers
    good, _, _ = estimate([r.votes for r in seen], np.array([r["count"] for r in seen], float))
    posterior = {r.votes: float(g) for r, g in zip(seen, good)}
    n = sum(r["count"] for r in seen)
    some = F.pmod(F.xxhash64("text", F.lit("quality")), F.lit(1 << 30)) < int(min(1.0, sample / max(n, 1)) * (1 << 30))
    drawn = docs.filter(some).select("text").distinct()
    rows = drawn.mapInArrow(_vote_and_features, "votes string, features array<bigint>")
    got = rows.groupBy(F.lit(0).alias("all")).applyInPandas(_train(posterior), "weights binary").collect()  # one sample, one row
    model = np.frombuffer(got[0].weights, np.float32) if got else np.zeros(BUCKETS + 1, np.float32)
    return posterior, model


def _vote_and_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [t.as_py() or "" for t in batch.column(0)]
        stats = [statistics(t) for t in texts]
        yield pa.RecordBatch.from_pydict({
            "votes": pa.array([pattern(s) for s in stats], pa.string()),
            "features": pa.array([features(t, s).tolist() for t, s in zip(texts, stats)], pa.list_(pa.int64()))})


def _score(posterior: dict[str, float], model: np.ndarray, cut: float):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t.as_py() or "" for t in batch.column(1)]
            stats = [statistics(t) for t in texts]
            weak = [posterior[pattern(s)] for s in stats]
            p = np.array([float(sigmoid(model[0] + model[1:][features(t, s)].sum())) for t, s in zip(texts, stats)])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(weak, pa.float64()), pa.array(p, pa.float64()),
                                              pa.array(p >= cut, pa.bool_())],
                                             names=["doc_id", "p_weak", "score", "is_good"])
    return score


def quality(docs: DataFrame, sample: int = SAMPLE, cut: float = CUT) -> DataFrame:
    """doc_id, p_weak (posterior of its votes), score, is_good."""
    posterior, model = learn(docs, sample)
    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("p_weak", T.DoubleType()),
                           T.StructField("score", T.DoubleType()), T.StructField("is_good", T.BooleanType())])
    return docs.select("doc_id", "text").mapInArrow(_score(posterior, model, cut), schema)
