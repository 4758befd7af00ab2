"""Operator 5, toxicity by a classifier chain.

Categories are predicted in order. Each category's model is logistic
regression on hashed distinct words, scaled by their log odds, plus the
probabilities of all earlier categories. A category is trained with out-of-fold probabilities of the
earlier ones: for each fold a model that has not seen it. All models of one
category are trained in parallel tasks (one group per model), on a bounded
labelled sample (``sample`` rows, about); every document is then scored in one
narrow pass by the full models, of ``BUCKETS`` numbers per category.

The cut-off of the last category is the one with the best F1 on its
out-of-fold probabilities.

Defined results: a null text has no words; null labels and labels of unknown
documents are left out; of several labels of one id the maximum of each
category counts, and an id of several texts trains with the least of them (null
only if all are null); repeated rows are scored alike; without both classes
in the sample a category has its constant rate; an empty table gives no
rows; other columns are not read.
"""

from __future__ import annotations

import pickle
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import staged, uniform
from .linear import Rows, fit, log_odds, sigmoid

BUCKETS = 1 << 18
FOLDS = 3
SAMPLE = 10_000
_SPACED = bytes(c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def features(text: str | None) -> np.ndarray:
    """Hashed distinct words of the lower-cased text."""
    words = set((text or "").lower().encode("utf-8", "surrogatepass").translate(_SPACED).split())
    return np.unique(np.fromiter(map(zlib.crc32, words), np.int64, len(words)) & (BUCKETS - 1))


def _featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        made = [features(t.as_py()).tolist() for t in batch.column(2)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(made, pa.list_(pa.int64()))],
                                         names=["fold", "labels", "features"])


def labelled_sample(docs: DataFrame, labels: DataFrame, categories: dict[str, str],
                    sample: int = SAMPLE) -> DataFrame:
    """fold, labels, features of about ``sample`` labelled documents, drawn by id:
    one row per id, of its least text and the maximum of each of its labels."""
    own = F.array(*[F.expr(c).cast("int") for c in categories.values()])
    known = labels.select("doc_id", own.alias("own")).filter(F.col("doc_id").isNotNull() & ~F.exists("own", lambda x: x.isNull()))
    once = known.groupBy("doc_id").agg(F.array(*[F.max(F.col("own")[i]) for i in range(len(categories))]).alias("labels"))
    n = once.count()
    drawn = once.filter(uniform("toxicity", F.col("doc_id")) < sample / max(n, 1))
    fold = F.floor(uniform("fold", F.col("doc_id")) * FOLDS).cast("int").alias("fold")
    # About ``sample`` ids: small enough to broadcast by construction. Rows that
    # repeat an id are combined before the shuffle, so a hot id stays one row.
    found = (docs.select("doc_id", "text").join(F.broadcast(drawn), "doc_id")
             .groupBy("doc_id", "labels").agg(F.min("text").alias("text")).select(fold, "labels", "text"))
    return staged(found.mapInArrow(_featurise, "fold int, labels array<int>, features array<bigint>"), "toxicity-sample")


def _chain_inputs(rows: Rows, models: list[dict], pick) -> np.ndarray:
    """Probabilities of the earlier categories; ``pick`` chooses a category's model."""
    got = np.empty((len(rows.lengths), 0))
    for per_fold in models:
        p = np.empty(len(rows.lengths))
        for key, chosen in pick(per_fold):
            w, extra = per_fold[key]
            rows.dense = got
            p[chosen] = sigmoid(rows.scores(w, extra))[chosen]
        got = np.c_[got, p]
    return got


def _train(category: int, earlier: list[dict]):
    def train(group: pd.DataFrame) -> pd.DataFrame:
        # One group per model: it leaves out fold ``model`` (FOLDS: none).
        group = group.sort_values("features", key=lambda c: c.map(lambda f: (len(f), *f[:3])), kind="stable")
        model, folds = int(group["model"].iloc[0]), group["fold"].to_numpy()
        rows = Rows([np.asarray(f) for f in group["features"]])
        chain = _chain_inputs(rows, earlier, lambda per: [(k, folds == k) for k in range(FOLDS)])
        target = np.array([y[category] for y in group["labels"]], float)
        seen = folds != model
        chosen = Rows([np.asarray(f) for f, s in zip(group["features"], seen) if s], chain[seen])
        y = target[seen]
        if len(y) == 0 or y.min() == y.max():
            rate = float(y.mean()) if len(y) else 0.0
            w, extra = np.zeros(BUCKETS), np.zeros(1 + chain.shape[1])
            extra[0] = np.log((rate + 1e-6) / (1 - rate + 1e-6))
        else:
            w, extra = fit(chosen, y, BUCKETS, scale=log_odds(chosen, y, BUCKETS))
        rows.dense = chain
        p = sigmoid(rows.scores(w, extra))
        out = folds == model
        return pd.DataFrame({"model": [model], "weights": [pickle.dumps((w.astype(np.float32), extra))],
                             "p": [p[out].tolist()], "y": [target[out].tolist()]})
    return train


def _best_cut(p: np.ndarray, y: np.ndarray) -> float:
    if len(p) == 0 or y.sum() == 0:
        return 0.5
    order = np.argsort(-p)
    hits = np.cumsum(y[order])
    f1 = 2 * hits / (np.arange(1, len(p) + 1) + y.sum())
    best = int(f1.argmax())
    below = p[order][best + 1] if best + 1 < len(p) else 0.0
    return float((p[order][best] + below) / 2)


def learn(docs: DataFrame, labels: DataFrame, categories: dict[str, str], sample: int = SAMPLE) -> tuple[list[dict], float]:
    """The chain's models (per category, by left-out fold) and the last category's cut-off."""
    data = labelled_sample(docs, labels, categories, sample)
    each = data.withColumn("model", F.explode(F.array(*[F.lit(i) for i in range(FOLDS + 1)])))
    chain: list[dict] = []
    cut = 0.5
    for i in range(len(categories)):
        got = each.groupBy("model").applyInPandas(
            _train(i, chain), "model int, weights binary, p array<double>, y array<double>").collect()  # FOLDS + 1 rows
        empty = (np.zeros(BUCKETS, np.float32), np.r_[-10.0, np.zeros(i)])
        chain.append({k: empty for k in range(FOLDS + 1)} | {r.model: pickle.loads(r.weights) for r in got})
        cut = _best_cut(np.array([x for r in got for x in r.p]), np.array([x for r in got for x in r.y]))
    return chain, cut


def _score(chain: list[dict], cut: float, names: list[str]):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = Rows([features(t.as_py()) for t in batch.column(1)])
            p = _chain_inputs(rows, chain, lambda per: [(FOLDS, slice(None))])
            made = {"doc_id": batch.column(0)} | {f"p_{n}": pa.array(p[:, i]) for i, n in enumerate(names)}
            made[f"is_{names[-1]}"] = pa.array(p[:, -1] >= cut)
            yield pa.RecordBatch.from_arrays(list(made.values()), names=list(made))
    return score


def toxicity(docs: DataFrame, labels: DataFrame, categories: dict[str, str], sample: int = SAMPLE) -> DataFrame:
    """doc_id, p_<category> of each category, is_<last category>. ``categories``
    gives each category's 0/1 label as an SQL expression over ``labels``, in the chain's order."""
    chain, cut = learn(docs, labels, categories, sample)
    names = list(categories)
    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType)]
                          + [T.StructField(f"p_{n}", T.DoubleType()) for n in names]
                          + [T.StructField(f"is_{names[-1]}", T.BooleanType())])
    return docs.select("doc_id", "text").mapInArrow(_score(chain, cut, names), schema)
