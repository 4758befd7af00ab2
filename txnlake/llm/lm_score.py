"""Operator 4, language-model scoring with a weighted backoff automaton.

The model is a bigram model over words and an end token. Its states are
histories (the previous word, or the start), an arc leaves a state for every
word seen after it in training, and a failure arc leads to the root, which
has an arc for every word:

    p(w | v) = (1 - b(v)) * c(v w) / c(v) + b(v) * p1(w)    arc v -> w, if seen
    p(w | v) = b(v) * p1(w)                                 failure arc, then root
    p1(w)    = (c(w) + 0.5) / (N + 0.5 * (V + 1))           root

It sums to one over the V words and one unknown word. b depends on v by the
power of two of c(v); these few dozen weights are fitted by leaving out each
training token once (deleted interpolation): every block counts its own
tokens in a small table, and the tables are added up. All counts cover all
training documents.

Nobody holds the whole model. Documents are packed into blocks of some
megabytes. Each block asks the owners of its distinct words and bigrams (by
ranges of their hash) for their counts, and sends its own training counts
along in the same message; owners add up and answer. A block thus receives
the part of the automaton that its own texts can reach, bounded by its size,
and each text is traversed once from left to right, carrying the state. A
frequent word costs its owner one entry per block, not one per occurrence.

Training documents are those whose remainder crc32(doc_id) mod 5 is not 1 (a
null id has none: neither held out nor learned from). Defined results: a
null text is empty and scores its end token; without training text every
probability is that of the unknown word, 1; repeated rows are scored alike
and each is learned from; an empty table gives no rows; other columns are
not read. Words are compared by 64-bit hashes.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import remainder, shuffle_partitions, staged
from .tokens import TOKEN_BYTES, WordHasher, mix

BLOCK_BYTES = 4 << 20
CLASSES = 48  # powers of two of a history's count
RATIOS = 128  # half powers of two of the leave-one-out ratio, the first for 0
_START, _END = np.uint64(1), np.uint64(2)


def _pack_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of (doc_id, train, held_out, text) -> one row per block."""
    from pyspark import TaskContext

    hasher, number = WordHasher(TOKEN_BYTES), TaskContext.get().partitionId() << 32
    id_type = None

    def block(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([number], pa.int64()), pa.array([[r[0] for r in rows]], pa.list_(id_type)),
             pa.array([[r[1] for r in rows]], pa.list_(pa.bool_())), pa.array([[r[2] for r in rows]], pa.list_(pa.bool_())),
             pa.array([[len(r[3]) for r in rows]], pa.list_(pa.int64())),
             pa.array([zlib.compress(b"".join(r[3] for r in rows), 1)], pa.binary())],
            names=["block", "doc_ids", "train", "held_out", "lengths", "texts"])

    rows, size = [], 0
    for batch in batches:
        id_type = batch.schema.field(0).type
        for i in range(len(batch)):
            text = hasher.spaced(batch.column(3)[i].as_py())
            if rows and size + len(text) > BLOCK_BYTES:
                yield block(rows)
                number, rows, size = number + 1, [], 0
            rows.append((batch.column(0)[i].as_py(), batch.column(1)[i].as_py(), batch.column(2)[i].as_py(), text))
            size += len(text)
    if rows:
        yield block(rows)


def blocks(docs: DataFrame) -> DataFrame:
    left = remainder(F.col("doc_id"), 5)
    asked = docs.select("doc_id", F.coalesce(left != 1, F.lit(False)).alias("train"),
                        F.coalesce(left == 1, F.lit(False)).alias("held_out"), "text")
    flags = T.ArrayType(T.BooleanType())
    schema = T.StructType([T.StructField("block", T.LongType()), T.StructField("doc_ids", T.ArrayType(docs.schema["doc_id"].dataType)),
                           T.StructField("train", flags), T.StructField("held_out", flags),
                           T.StructField("lengths", T.ArrayType(T.LongType())), T.StructField("texts", T.BinaryType())])
    return staged(asked.mapInArrow(_pack_blocks, schema), "text-blocks")


class Block:
    """The words and bigrams of a block, by local numbers."""

    def __init__(self, lengths: list[int], texts: bytes, train: list[bool]) -> None:
        hasher, data, at, parts = WordHasher(TOKEN_BYTES), zlib.decompress(texts), 0, []
        for n in lengths:
            parts.append(np.append(hasher.of(data[at:at + n]), _END))
            at += n
        self.sizes = np.array([len(p) for p in parts])
        self.doc = np.repeat(np.arange(len(parts)), self.sizes)
        word = np.concatenate(parts)
        history = np.empty_like(word)
        history[1:] = word[:-1]
        firsts = np.cumsum(self.sizes) - self.sizes
        history[firsts] = _START
        self.train = np.array(train, bool)[self.doc]
        self.words, self.word = np.unique(word, return_inverse=True)
        self.bigrams, self.bigram = np.unique(mix(history * np.uint64(0x9E3779B97F4A7C15) + word), return_inverse=True)
        #: The state before each token: number of the previous word, -1 at the start.
        self.state = np.empty(len(word), np.int64)
        self.state[1:] = self.word[:-1]
        self.state[firsts] = -1

    def own_counts(self) -> tuple[np.ndarray, np.ndarray]:
        return (np.bincount(self.word[self.train], minlength=len(self.words)),
                np.bincount(self.bigram[self.train], minlength=len(self.bigrams)))


def _planes(values: np.ndarray) -> bytes:
    """Unsigned integers byte plane by byte plane, as many planes as needed, deflated."""
    values = values.astype("<u8")
    width = max(1, (int(values.max()).bit_length() + 7) // 8) if len(values) else 1
    return bytes([width]) + zlib.compress(np.ascontiguousarray(values.view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes(), 1)


def _unplanes(data: bytes) -> np.ndarray:
    width = data[0]
    planes = np.frombuffer(zlib.decompress(data[1:]), np.uint8).reshape(width, -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, :width] = planes.T
    return out.view("<u8").ravel().astype(np.uint64)


def _gaps(keys: np.ndarray) -> np.ndarray:
    return np.diff(keys, prepend=np.uint64(0))


def _cuts(keys: np.ndarray, owners: int) -> np.ndarray:
    """Bounds of the owners' ranges in sorted keys."""
    return np.searchsorted((keys >> np.uint64(32)) * np.uint64(owners) >> np.uint64(32), np.arange(owners + 1))


def _ask(owners: int):
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                row = batch.slice(i, 1).to_pylist()[0]
                b = Block(row["lengths"], row["texts"], row["train"])
                counts = b.own_counts()
                cuts = [_cuts(b.words, owners), _cuts(b.bigrams, owners)]
                for o in range(owners):
                    w, g = (slice(c[o], c[o + 1]) for c in cuts)
                    if w.start < w.stop or g.start < g.stop:
                        yield pa.RecordBatch.from_pydict({
                            "owner": pa.array([o], pa.int32()), "block": pa.array([row["block"]], pa.int64()),
                            "words": [_planes(_gaps(b.words[w]))], "word_counts": [_planes(counts[0][w])],
                            "bigrams": [_planes(_gaps(b.bigrams[g]))], "bigram_counts": [_planes(counts[1][g])]})
    return ask


def _add_up(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray]:
    """(total count of each key, list by list; totals of the distinct keys)."""
    _, number = np.unique(np.concatenate(keys), return_inverse=True)
    totals = np.bincount(number, np.concatenate(counts).astype(np.float64)).astype(np.uint64)  # exact below 2 ** 53
    return np.split(totals[number], np.cumsum([len(k) for k in keys])[:-1]), totals


def _answer(group: pd.DataFrame) -> pd.DataFrame:
    made = {}
    for kind in ("word", "bigram"):
        keys = [np.cumsum(_unplanes(x), dtype=np.uint64) for x in group[f"{kind}s"]]
        made[kind], totals = _add_up(keys, [_unplanes(x) for x in group[f"{kind}_counts"]])
        if kind == "word":
            tokens, types = int(totals.sum()), int((totals > 0).sum())
    first = np.arange(len(group)) == 0
    return pd.DataFrame({"block": group["block"], "owner": group["owner"], "words": [_planes(x) for x in made["word"]],
                         "bigrams": [_planes(x) for x in made["bigram"]],
                         "tokens": np.where(first, tokens, 0), "types": np.where(first, types, 0)})


def answers(packed: DataFrame) -> DataFrame:
    """block, owner, words, bigrams (total counts in the asked order), and shares of N and V."""
    owners = shuffle_partitions(packed.sparkSession)
    asked = packed.select("block", "lengths", "texts", "train").mapInArrow(
        _ask(owners), "owner int, block bigint, words binary, word_counts binary, bigrams binary, bigram_counts binary")
    return staged(asked.groupBy("owner").applyInPandas(
        _answer, "block bigint, owner int, words binary, bigrams binary, tokens bigint, types bigint"), "ngram-counts")


def _class(count: np.ndarray) -> np.ndarray:
    return np.minimum(np.log2(np.maximum(count, 1)).astype(np.int64), CLASSES - 1)


class Automaton:
    """The part of the model that one block can reach."""

    def __init__(self, b: Block, replies: list[dict], starts: int, tokens: int, types: int) -> None:
        replies = sorted(replies, key=lambda r: r["owner"])
        self.words, self.bigrams = (np.concatenate([_unplanes(r[k]) for r in replies]).astype(np.float64)
                                    for k in ("words", "bigrams"))
        self.b, self.root = b, (self.words + 0.5) / (tokens + 0.5 * (types + 1))
        self.visits = np.append(self.words, starts)  # of each state; the start is number -1

    def leave_one_out(self) -> np.ndarray:
        """How often, by class of the state's count, a training token's
        bigram share without itself has which ratio to its root probability."""
        b, table = self.b, np.zeros((CLASSES, RATIOS))
        visits, seen = self.visits[b.state[b.train]], self.bigrams[b.bigram[b.train]]
        ratio = (seen - 1) / np.maximum(visits - 1, 1) / self.root[b.word[b.train]]
        at = np.where(ratio > 0, np.clip(2 * np.log2(np.maximum(ratio, 1e-30)) + RATIOS // 2, 1, RATIOS - 1), 0)
        np.add.at(table, (_class(visits), at.astype(np.int64)), 1)
        return table

    def traverse(self, backoff: np.ndarray) -> np.ndarray:
        """log10 probability of every token, left to right: from the state
        that the previous token led to, its arc if there is one, or else the
        failure arc and the root's arc."""
        b = self.b
        fail = np.where(self.visits > 0, backoff[_class(self.visits)], 1.0)[b.state]
        visits, seen, root = self.visits[b.state], self.bigrams[b.bigram], self.root[b.word]
        arc = np.where(visits > 0, (1 - fail) * seen / np.maximum(visits, 1), 0.0)
        return np.log10(arc + fail * root)


def fit_backoff(table: np.ndarray) -> np.ndarray:
    """Backoff weight per class of counts, by expectation-maximisation."""
    ratio = np.append(0.0, 2.0 ** ((np.arange(1, RATIOS) - RATIOS // 2) / 2))
    weight = np.full(len(table), 0.9)
    for _ in range(200):
        back = weight[:, None] / ((1 - weight[:, None]) * ratio + weight[:, None])
        weight = ((table * back).sum(1) + 0.9) / (table.sum(1) + 1)
    return np.clip(weight, 1e-4, 1 - 1e-4)


def _with_answers(packed: DataFrame, replies: DataFrame) -> DataFrame:
    got = replies.groupBy("block").agg(F.collect_list(F.struct("owner", "words", "bigrams")).alias("replies"))
    return packed.join(got, "block")


def _rows(batches: Iterator[pa.RecordBatch], *stats: int) -> Iterator[tuple[dict, Block, Automaton]]:
    for batch in batches:
        for i in range(len(batch)):
            row = batch.slice(i, 1).to_pylist()[0]
            b = Block(row["lengths"], row["texts"], row["train"])
            yield row, b, Automaton(b, row["replies"], *stats)


def _measure(*stats: int):
    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros((CLASSES, RATIOS))
        for _, _, automaton in _rows(batches, *stats):
            table += automaton.leave_one_out()
        at = np.flatnonzero(table)
        yield pa.RecordBatch.from_pydict({"cell": pa.array(at, pa.int32()), "n": pa.array(table.ravel()[at].astype(np.int64))})
    return measure


def leave_one_out(packed: DataFrame, replies: DataFrame, *stats: int) -> np.ndarray:
    """The summed tables of all blocks, CLASSES x RATIOS."""
    cells = (_with_answers(packed, replies).mapInArrow(_measure(*stats), "cell int, n bigint")
             .groupBy("cell").agg(F.sum("n").alias("n")).collect())  # at most CLASSES x RATIOS rows
    table = np.zeros(CLASSES * RATIOS)
    table[[r["cell"] for r in cells]] = [r["n"] for r in cells]
    return table.reshape(CLASSES, RATIOS)


def _score(backoff: np.ndarray, id_type: pa.DataType, *stats: int):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, b, automaton in _rows(batches, *stats):
            n = len(b.sizes)
            known = np.bincount(b.doc, automaton.words[b.word] > 0, minlength=n)
            base = np.bincount(b.doc, np.log10(automaton.root)[b.word], minlength=n)
            full = np.bincount(b.doc, automaton.traverse(backoff), minlength=n)
            yield pa.RecordBatch.from_arrays(
                [pa.array(row["doc_ids"], id_type), pa.array(row["held_out"]), pa.array(b.sizes.astype(np.int64)),
                 pa.array(known.astype(np.int64)), pa.array(np.full(n, stats[1], np.int64)), pa.array(base), pa.array(full)],
                names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])
    return score


def lm_score(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    packed = blocks(docs)
    replies = answers(packed)
    sums = replies.agg(F.sum("tokens"), F.sum("types")).first()
    starts = packed.select(F.explode("train").alias("t")).filter("t").count()
    stats = (starts, int(sums[0] or 0), int(sums[1] or 0))
    backoff = fit_backoff(leave_one_out(packed, replies, *stats))
    from pyspark.sql.pandas.types import to_arrow_type

    kind = docs.schema["doc_id"].dataType
    schema = T.StructType([T.StructField("doc_id", kind), T.StructField("held_out", T.BooleanType())]
                          + [T.StructField(c, T.LongType()) for c in ("n_tokens", "n_known", "train_tokens")]
                          + [T.StructField(c, T.DoubleType()) for c in ("base_score", "score")])
    return _with_answers(packed, replies).mapInArrow(_score(backoff, to_arrow_type(kind), *stats), schema)
