"""Operator 2, language identification by error-correcting output codes.

Every language gets a codeword; a binary n-gram classifier per bit tells the
languages with a 1 from those with a 0. The classifiers are linear: the
log-odds of hashed byte 2-, 3- and 4-grams of the lower-cased letters, from
counts over all training documents (one distributed pass, summed by language
and bucket and made into weights there; the model is bits x ``BUCKETS``
numbers and a codeword per language, whatever the input). Decoding sums
each codeword's logistic losses, weighted by how often that bit is right for
that language on a bounded labelled sample; the nearest codeword wins, and a
small lead flags the document as ambiguous.

Training uses text and non-null lang of documents whose remainder
crc32(doc_id) mod 5 is not 0 (a null id has none: neither held out nor
learned from). Every lang value among them is learned. Prediction reads the
text alone.

Defined results: a null text or one without a letter is ``und`` with score
0; so is every text if nothing can be learned; one learned language wins
with score 1; repeated rows are predicted alike; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import remainder, staged, uniform

BUCKETS = 1 << 14
ORDERS = (2, 3, 4)
WEIGHT_SAMPLE = 4000  # labelled documents, about, that the loss weights are measured on
LEAST_SAMPLE = 60  # of them for each language, about, however many there are
HELD_LANGUAGES = 512  # languages that a task counts before it passes their sums on
BUCKET_GROUP = 64
CODE_WORK = 2_000_000_000  # multiplications, about, of the search for codewords
AMBIGUOUS_LEAD = 0.2

_LETTERS = bytes(c if 65 <= c <= 90 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_ASCII_LETTER = re.compile("[A-Za-z]")


def has_letter(text: str | None) -> bool:
    return bool(text) and (_ASCII_LETTER.search(text) is not None or any(map(str.isalpha, text)))


def grams(text: str, piece: int = 1 << 20) -> Iterator[np.ndarray]:
    """Bucket numbers of the text's byte n-grams, in pieces of bounded size."""
    data = np.frombuffer((" " + text.lower() + " ").encode("utf-8", "surrogatepass").translate(_LETTERS), np.uint8)
    for start in range(0, len(data), piece):
        b = data[start:start + piece + max(ORDERS) - 1].astype(np.uint32)
        for n in ORDERS:
            last = min(piece, len(data) - start - n + 1)
            if last <= 0:
                continue
            h = np.full(last, n, np.uint32)
            for i in range(n):
                h = h * np.uint32(0x9E3779B1) + b[i:i + last]
            h ^= h >> np.uint32(15)
            h *= np.uint32(0x85EBCA77)
            yield (h >> np.uint32(18)).astype(np.int64)


def gram_counts(text: str) -> np.ndarray:
    out = np.zeros(BUCKETS, np.int64)
    for g in grams(text):
        out += np.bincount(g, minlength=BUCKETS)
    return out


def codewords(n: int) -> np.ndarray:
    """n codewords of -1 / +1: exhaustive up to five languages, otherwise the
    best of some seeded random codes by least distance."""
    if n <= 5:
        cols = [[1] + [1 if m >> i & 1 else -1 for i in range(n - 1)] for m in range((1 << (n - 1)) - 1)]
        return np.array(cols, int).reshape(len(cols), n).T
    rng = np.random.default_rng(n)
    best, score = None, -1
    bits = int(np.ceil(10 * np.log2(n)))
    for trial in range(1, 201):
        m = rng.choice([-1, 1], (n, bits))
        least = _least_distance(m)
        if least > score and (np.abs(m.sum(0)) < n).all():
            best, score = m, least
        if best is not None and trial * n * n * bits > CODE_WORK:
            break
    return best


def _least_distance(m: np.ndarray, piece: int = 1024) -> int:
    f, most = m.astype(np.float32), -m.shape[1]
    for at in range(0, len(f), piece):
        same = f[at:at + piece] @ f.T
        same[np.arange(len(same)), at + np.arange(len(same))] = -m.shape[1]
        most = max(most, int(same.max()))
    return (m.shape[1] - most) // 2


@dataclass
class Model:
    languages: list[str]
    code: np.ndarray  # languages x bits
    weights: np.ndarray  # buckets x bits
    trust: np.ndarray  # languages x bits, rows sum to the number of bits

    def margins(self, text: str) -> np.ndarray:
        counts = gram_counts(text)
        return counts.astype(np.float32) @ self.weights / np.sqrt(max(1, counts.sum()))

    def probabilities(self, text: str) -> np.ndarray:
        loss = np.logaddexp(0, -self.code * self.margins(text)[None, :]) * self.trust
        loss = loss.sum(1)
        p = np.exp(loss.min() - loss)
        return p / p.sum()


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def passed_on() -> Iterator[pa.RecordBatch]:
        for x, total in sums.items():
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_pydict({"lang": pa.array([x] * len(at), pa.string()),
                                              "bucket": pa.array(at, pa.int32()), "n": pa.array(total[at])})
        sums.clear()

    sums: dict[str, np.ndarray] = {}
    for batch in batches:
        for text, lang in zip(batch.column(0), batch.column(1).to_pylist()):
            if lang not in sums:
                if len(sums) == HELD_LANGUAGES:
                    yield from passed_on()
                sums[lang] = np.zeros(BUCKETS, np.int64)
            sums[lang] += gram_counts(text.as_py())
    yield from passed_on()


def _bit_weights(counts: np.ndarray, totals: np.ndarray, code: np.ndarray) -> np.ndarray:
    """buckets x bits, from languages x buckets counts."""
    share = (counts + 0.5) / (totals[:, None] + 0.5 * BUCKETS)
    out = np.zeros((counts.shape[1], code.shape[1]), np.float32)
    for b in range(code.shape[1]):
        out[:, b] = np.log(share[code[:, b] > 0].mean(0)) - np.log(share[code[:, b] < 0].mean(0))
    return out


def _weigh(languages: list[str], totals: np.ndarray, code: np.ndarray):
    def weigh(group: pd.DataFrame) -> pd.DataFrame:
        place = {x: i for i, x in enumerate(languages)}
        first = int(group["bucket"].iloc[0]) // BUCKET_GROUP * BUCKET_GROUP
        counts = np.zeros((len(languages), BUCKET_GROUP))
        counts[group["lang"].map(place).to_numpy(), group["bucket"].to_numpy() - first] = group["n"]
        return pd.DataFrame({"bucket": np.arange(first, first + BUCKET_GROUP, dtype=np.int32),
                             "weights": list(_bit_weights(counts, totals, code))})
    return weigh


def _check(model: Model):
    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = {x: i for i, x in enumerate(model.languages)}
        for batch in batches:
            for text, lang in zip(batch.column(0), batch.column(1).to_pylist()):
                right = model.margins(text.as_py()) * model.code[place[lang]] > 0
                yield pa.RecordBatch.from_pydict({"lang": [lang], "right": [right.astype(float).tolist()]})
    return check


def learn(docs: DataFrame, sample: int = WEIGHT_SAMPLE) -> Model | None:
    """Fit on the labelled documents that are not held out; None without any."""
    labelled = docs.select("doc_id", "text", "lang").filter(
        (remainder(F.col("doc_id"), 5) != 0) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = {r["lang"]: r["count"] for r in labelled.groupBy("lang").count().collect()}  # a row per language
    if not sizes:
        return None
    languages = sorted(sizes)
    place = {x: i for i, x in enumerate(languages)}
    code = codewords(len(languages))
    weights = np.zeros((BUCKETS, code.shape[1]), np.float32)
    model = Model(languages, code, weights, np.ones(code.shape))
    if len(languages) == 1:
        return model
    sums = staged(labelled.select("text", "lang").mapInArrow(_count, "lang string, bucket int, n long")
                  .groupBy("lang", "bucket").agg(F.sum("n").alias("n")), "gram-counts")
    totals = np.zeros(len(languages))
    for r in sums.groupBy("lang").agg(F.sum("n").alias("n")).collect():
        totals[place[r["lang"]]] = r["n"]
    weights[:] = _bit_weights(np.zeros((len(languages), 1)), totals, code)  # of buckets that never occur
    found = (sums.groupBy(F.floor(F.col("bucket") / BUCKET_GROUP).alias("group"))
             .applyInPandas(_weigh(languages, totals, code), "bucket int, weights array<float>")).toArrow()  # bits x BUCKETS
    weights[found["bucket"].to_numpy()] = found["weights"].combine_chunks().flatten().to_numpy().reshape(-1, code.shape[1])
    each = max(sample / len(languages), LEAST_SAMPLE)
    chances = docs.sparkSession.createDataFrame([(x, min(1.0, each / n)) for x, n in sizes.items()], "lang string, chance double")
    checked = (labelled.join(F.broadcast(chances), "lang")  # a row per language
               .filter(uniform("loss-weights", F.col("doc_id")) < F.col("chance")).select("text", "lang")
               .mapInArrow(_check(model), "lang string, right array<double>"))
    for row in checked.groupBy("lang").agg(
            F.array(*[F.avg(F.col("right")[b]) for b in range(code.shape[1])]).alias("right")).collect():
        trust = np.maximum(np.array(row["right"]) - 0.5, 0.01)
        model.trust[place[row["lang"]]] = trust / trust.sum() * len(trust)
    return model


def _predict(model: Model | None, lead: float):
    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, scores, unsure, lettered = [], [], [], []
            row = batch.column("row")
            for cell in batch.column("text") if "text" in batch.schema.names else row.field("text"):
                text = cell.as_py()
                lettered.append(has_letter(text))
                if model is None or not lettered[-1]:
                    langs.append("und"), scores.append(0.0), unsure.append(False)
                    continue
                p = model.probabilities(text)
                order = np.argsort(-p, kind="stable")
                langs.append(model.languages[order[0]])
                scores.append(float(p[order[0]]))
                unsure.append(bool(len(p) > 1 and p[order[0]] - p[order[1]] < lead))
            yield pa.RecordBatch.from_arrays(
                [row, pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(unsure, pa.bool_()),
                 pa.array(lettered, pa.bool_())], names=["row", "lang_pred", "score", "ambiguous", "lettered"])
    return predict


def predictions(docs: DataFrame, model: Model | None, keep: list[str], lead: float = AMBIGUOUS_LEAD) -> DataFrame:
    """row (a struct of the ``keep`` columns), lang_pred, score, ambiguous, lettered."""
    row = F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row")
    asked = docs.select(row, *([] if "text" in keep else ["text"]))
    schema = T.StructType([asked.schema["row"], T.StructField("lang_pred", T.StringType()),
                           T.StructField("score", T.DoubleType()), T.StructField("ambiguous", T.BooleanType()),
                           T.StructField("lettered", T.BooleanType())])
    return asked.mapInArrow(_predict(model, lead), schema)


def language_id(docs: DataFrame, **options) -> DataFrame:
    """doc_id, held_out, lang_pred, score, ambiguous."""
    held = F.coalesce(remainder(F.col("row.doc_id"), 5) == 0, F.lit(False))
    return predictions(docs, learn(docs, **options), ["doc_id"]).select(
        "row.doc_id", held.alias("held_out"), "lang_pred", "score", "ambiguous")


def recognised(docs: DataFrame, **options) -> DataFrame:
    """The documents with a letter, all columns kept; null and letterless texts
    go. No language is a reason to drop a document, nor an ambiguous one, nor
    that none could be learned."""
    return (predictions(docs, learn(docs, **options), docs.columns).filter("lettered")
            .select(*[F.col("row").getField(c).alias(c) for c in docs.columns]))
