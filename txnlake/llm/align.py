"""Operator 12, cross-tokenizer alignment by merge-path partitioning.

Two tokenizers cut the same bytes. Where tokens of both end, the text is cut
into groups; all token pairs of a group are linked. The sorted end offsets of
both sides are merged along merge paths: a binary search on each diagonal
divides the merge into independent pieces of equal work, each piece finds
the ends that both its sides have, and a pair of equal ends that a boundary
separates is stitched afterwards. Documents of a task are merged as one
stream, since their ends are common ends.

A pass tokenizes every text once and writes blocks: per document its totals
and its distinct id pairs, per block the distinct pairs with the number of
documents that hold them. A shuffle sums these by pair and finds the best
count of each first id; every block gets the counts of its own pairs back
(a frequent pair costs a row per block, never one per link), and a last pass
sums them per document. Nothing is broadcast.

A task holds a slice of texts (half a MB, or one longer text) and a block of
at most some two million pairs; the links of a large group are made from its
distinct ids, a bounded number at a time. However many blocks a task meets, it
holds one or two: blocks are written as row groups of their own, and in the last
pass each comes behind the counts of its pairs, sorted and never collected.

Defined results: texts that are null, empty, or that a tokenizer does not
give back byte by byte have no tokens: zeros, and '' as digest. Strings of
special tokens are plain text. Repeated rows count as documents of their own;
an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import shuffle_partitions, staged

FIRST = "/opt/tokenizers/byte_bpe_50k.json"
SECOND = "/opt/tokenizers/piece_bpe_32k.model"
#: Fixed value: the split pattern of the byte-level pre-tokenizer.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
PIECE_WORK = 1 << 15  # ends merged by one piece
SLICE = 1 << 19  # characters tokenized at a time
BLOCK_PAIRS = 1 << 21  # (document, pair) entries of a block
LINKS = 1 << 21  # links made at a time
_ID_BITS = 17
_MASK = (1 << _ID_BITS) - 1


def byte_alphabet() -> dict[str, int]:
    """Byte-level tokens: printable bytes stand for themselves, the others for 256, 257, ..."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class First:
    """The byte-level BPE of a ``tokenizers`` file. Its entries are in merge
    order, so tiktoken encodes alike, several times as fast."""

    def __init__(self, path: str) -> None:
        import tiktoken

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        alphabet, special = byte_alphabet(), {t["content"] for t in spec["added_tokens"]}
        ranks = {bytes(alphabet[c] for c in t): i for t, i in spec["model"]["vocab"].items() if t not in special}
        self.path, self.bytes = path, [b""] * (max(ranks.values()) + 1)
        for t, i in ranks.items():
            self.bytes[i] = t
        self.encoding = tiktoken.Encoding("first", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> np.ndarray:
        try:
            return np.asarray(self.encoding.encode_ordinary(text), np.int64)
        except BaseException as e:  # the pattern's engine gives up on millions of spaces
            if type(e).__name__ not in ("PanicException", "ValueError"):
                raise
            from tokenizers import Tokenizer

            plain = Tokenizer.from_file(self.path)
            plain.encode_special_tokens = True
            return np.asarray(plain.encode(text, add_special_tokens=False).ids, np.int64)


class Second:
    """A sentencepiece BPE; it adds the leading space itself."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.bytes = [bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode()
                      for i, p in enumerate(pieces)]

    def encode(self, text: str) -> np.ndarray:
        return np.asarray(self.model.encode(text), np.int64)


def merge_path(a: np.ndarray, b: np.ndarray, diagonals: np.ndarray) -> np.ndarray:
    """How many of the first d elements of the merge of a and b come from a
    (equal elements: a first), for every diagonal d, by binary search."""
    low, high = np.maximum(0, diagonals - len(b)), np.minimum(diagonals, len(a))
    while True:
        open_ = low < high
        if not open_.any():
            return low
        mid = (low + high) >> 1
        from_a = np.zeros(len(low), bool)
        from_a[open_] = a[mid[open_]] <= b[(diagonals - 1 - mid)[open_]]
        low = np.where(open_ & from_a, mid + 1, low)
        high = np.where(open_ & ~from_a, mid, high)


def piece_cuts(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions after which both sides of a piece end (numbers of a and b elements)."""
    if not len(a) or not len(b):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.searchsorted(b, a)
    same = b[np.minimum(at, len(b) - 1)] == a
    return np.flatnonzero(same) + 1, at[same] + 1


def common_ends(a: np.ndarray, b: np.ndarray, work: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Both sides' token numbers at the common ends of two strictly ascending lists."""
    total, work = len(a) + len(b), work or PIECE_WORK
    diagonals = np.append(np.arange(0, total, work), total)
    i = merge_path(a, b, diagonals)
    j = diagonals - i
    in_a, in_b = [], []
    for p in range(len(diagonals) - 1):
        # Stitching: the boundary may separate an end of a from the equal one of b.
        if 0 < i[p] and j[p] < len(b) and a[i[p] - 1] == b[j[p]]:
            in_a.append(np.array([i[p]]))
            in_b.append(np.array([j[p] + 1]))
        x, y = piece_cuts(a[i[p]:i[p + 1]], b[j[p]:j[p + 1]])
        in_a.append(x + i[p])
        in_b.append(y + j[p])
    return (np.concatenate(in_a), np.concatenate(in_b)) if in_a else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def _packed(doc: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (doc << (2 * _ID_BITS)) | (a << _ID_BITS) | b


def _tallied(keys: np.ndarray, weights: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys with the sums of their weights (their number if None)."""
    order = np.argsort(keys, kind="stable") if weights is not None else None
    keys = keys[order] if order is not None else np.sort(keys)
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    sizes = np.add.reduceat(weights[order], first) if weights is not None and len(keys) else np.diff(np.append(first, len(keys)))
    return keys[first], sizes


def links(doc: np.ndarray, ids_a: np.ndarray, ids_b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (document, id, id) with their numbers of links; doc, size_a and size_b are per group."""
    start_a, start_b = np.cumsum(size_a) - size_a, np.cumsum(size_b) - size_b
    product = size_a * size_b
    parts: list[tuple[np.ndarray, np.ndarray]] = []
    large = product > LINKS
    run = np.cumsum(np.where(large, 0, product)) // LINKS
    for r in np.unique(run[~large]):
        g = np.flatnonzero((run == r) & ~large)
        of_a = np.repeat(g, size_a[g])
        at_a = np.arange(len(of_a)) - np.repeat(np.cumsum(size_a[g]) - size_a[g], size_a[g]) + start_a[of_a]
        n = size_b[of_a]
        at_b = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + np.repeat(start_b[of_a], n)
        parts.append(_tallied(_packed(np.repeat(doc[of_a], n), np.repeat(ids_a[at_a], n), ids_b[at_b]), None))
    for g in np.flatnonzero(large).tolist():
        # A large group: the product of its distinct ids, some rows of it at a time.
        ua, ca = np.unique(ids_a[start_a[g]:start_a[g] + size_a[g]], return_counts=True)
        ub, cb = np.unique(ids_b[start_b[g]:start_b[g] + size_b[g]], return_counts=True)
        step = max(1, LINKS // len(ub))
        for i in range(0, len(ua), step):
            a, c = ua[i:i + step], ca[i:i + step]
            parts.append((_packed(np.int64(doc[g]), np.repeat(a, len(ub)), np.tile(ub, len(a))), np.repeat(c, len(ub)) * np.tile(cb, len(c))))
    if len(parts) < 2:
        return parts[0] if parts else (np.zeros(0, np.int64), np.zeros(0, np.int64))
    return _tallied(np.concatenate([k for k, _ in parts]), np.concatenate([n for _, n in parts]))


class Aligner:
    """Tokenizes slices of texts and finds their groups."""

    def __init__(self, first: str, second: str) -> None:
        self.a, self.b = First(first), Second(second)
        self.length_a = np.array([len(t) for t in self.a.bytes], np.int64)
        self.length_b = np.array([len(t) for t in self.b.bytes], np.int64)
        self.names = [f"{i}{s}" for n, last in ((len(self.a.bytes), "|"), (len(self.b.bytes), ";")) for i in range(n) for s in (",", last)]

    def tokens(self, text: str | None) -> tuple[np.ndarray, np.ndarray] | None:
        if not text:
            return None
        whole = (" " + text).encode("utf-8", "surrogatepass")
        a, b = self.a.encode(" " + text), self.b.encode(text)
        for ids, table in ((a, self.a.bytes), (b, self.b.bytes)):
            if b"".join([table[i] for i in ids.tolist()]) != whole:
                return None
        return a, b

    def __call__(self, texts: list[str | None]) -> dict:
        """Per text n_a, n_b, n_groups, n_links, sha; and the distinct linked pairs."""
        found = [self.tokens(t) for t in texts]
        held = np.array([i for i, f in enumerate(found) if f is not None], np.int64)
        zeros = np.zeros(len(texts), np.int64)
        out = {"n_a": zeros.copy(), "n_b": zeros.copy(), "n_groups": zeros.copy(), "n_links": zeros.copy(), "sha": [""] * len(texts)}
        if not len(held):
            return out | {"keys": zeros[:0], "sizes": zeros[:0]}
        ids_a = np.concatenate([found[i][0] for i in held.tolist()])
        ids_b = np.concatenate([found[i][1] for i in held.tolist()])
        out["n_a"][held] = n_a = np.array([len(found[i][0]) for i in held.tolist()])
        out["n_b"][held] = n_b = np.array([len(found[i][1]) for i in held.tolist()])
        cut_a, cut_b = common_ends(np.cumsum(self.length_a[ids_a]), np.cumsum(self.length_b[ids_b]))
        size_a, size_b = np.diff(cut_a, prepend=0), np.diff(cut_b, prepend=0)
        end_a, end_b = np.cumsum(n_a), np.cumsum(n_b)
        doc = np.searchsorted(end_a, cut_a)  # of each group, among the held texts
        out["n_groups"][held] = np.bincount(doc, minlength=len(held))
        first = np.searchsorted(doc, np.arange(len(held)))
        out["n_links"][held] = np.add.reduceat(size_a * size_b, first)
        # Tokens in the order of the listing: each group's a tokens, then its b tokens.
        total = len(ids_a) + len(ids_b)
        listing = np.empty(total, np.int64)
        last_a, last_b = np.zeros(len(ids_a), np.int64), np.zeros(len(ids_b), np.int64)
        last_a[cut_a - 1] = last_b[cut_b - 1] = 1
        listing[np.arange(len(ids_a)) + np.repeat(cut_b - size_b, size_a)] = 2 * ids_a + last_a
        listing[np.arange(len(ids_b)) + np.repeat(cut_a, size_b)] = 2 * (ids_b + len(self.a.bytes)) + last_b
        at = 0
        for i, end in zip(held.tolist(), (end_a + end_b).tolist()):
            names = self.names
            out["sha"][i] = hashlib.sha256("".join([names[t] for t in listing[at:end].tolist()])[:-1].encode()).hexdigest()
            at = end
        keys, sizes = links(held[doc], ids_a, ids_b, size_a, size_b)
        return out | {"keys": keys, "sizes": sizes}


_BLOCK = "block long, pairs array<long>, held array<int>, body binary"
#: Columns of the table of documents in a block's body, and how many entries each document has.
_DOCS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "entries"]


def _narrow(numbers: np.ndarray) -> bytes:
    """The numbers in as few bytes each as the largest needs (1, 2, 4 or 8)."""
    return numbers.astype(np.min_scalar_type(int(numbers.max(initial=0)))).tobytes()


def _wide(data: memoryview, n: int) -> np.ndarray:
    """The ``n`` numbers of ``_narrow``."""
    return np.frombuffer(data, f"u{len(data) // n}").astype(np.int64) if n else np.zeros(0, np.int64)


def _body(docs: pa.RecordBatch, places: bytes, sizes: bytes) -> bytes:
    """One value (a row of many columns costs a task several times as much): lengths, documents, places, sizes."""
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, docs.schema) as out:
        out.write_batch(docs)
    table = sink.getvalue().to_pybytes()
    return np.array([len(table), len(places)], np.int64).tobytes() + table + places + sizes


def _unpacked(body: memoryview) -> tuple[pa.RecordBatch, memoryview, memoryview]:
    table, places = np.frombuffer(body[:16], np.int64).tolist()
    with pa.ipc.open_stream(pa.py_buffer(body[16:16 + table])) as source:
        docs = source.read_next_batch()
    return docs, body[16 + table:16 + table + places], body[16 + table + places:]


def _block(number: int, docs: list[dict]) -> pa.RecordBatch:
    """One row: the documents of a block and their pairs as places in its list of pairs."""
    pair = np.concatenate([d["keys"] & ((1 << 2 * _ID_BITS) - 1) for d in docs])
    pairs, place = np.unique(pair, return_inverse=True)
    entries = np.concatenate([np.bincount(d["keys"] >> (2 * _ID_BITS), minlength=len(d["doc_ids"])) for d in docs])
    columns = [pa.array([i for d in docs for i in d["doc_ids"]], pa.int64())]
    columns += [pa.array(np.concatenate([d[n] for d in docs])) for n in ("n_a", "n_b", "n_groups", "n_links")]
    columns += [pa.array([s for d in docs for s in d["sha"]], pa.string()), pa.array(entries, pa.int64())]
    sizes = np.concatenate([d["sizes"] for d in docs])
    row = {"block": pa.array([number], pa.int64()), "pairs": pa.array([pairs], pa.list_(pa.int64())),
           "held": pa.array([np.bincount(place, minlength=len(pairs)).astype(np.int32)], pa.list_(pa.int32())),
           "body": pa.array([_body(pa.RecordBatch.from_arrays(columns, names=_DOCS), _narrow(place), _narrow(sizes))], pa.binary())}
    return pa.RecordBatch.from_arrays(list(row.values()), names=list(row))


def _tokenize(first: str, second: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, number = None, TaskContext.get().partitionId() << 32
        block: list[dict] = []
        ids: list = []
        texts: list = []
        size = 0

        def close() -> None:
            nonlocal ids, texts, size
            block.append(aligner(texts) | {"doc_ids": ids})
            ids, texts, size = [], [], 0

        for batch in batches:
            aligner = aligner or Aligner(first, second)
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                value = text.as_py()
                ids.append(doc_id)
                texts.append(value)
                size += len(value or "") + 64
                if size >= SLICE:
                    close()
                    if sum(len(d["keys"]) for d in block) >= BLOCK_PAIRS:
                        yield _block(number, block)
                        number += 1
                        block.clear()
        if ids:
            close()
        if block:
            yield _block(number, block)
    return run


_RESULT = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")


def _summed(body: memoryview, n_pairs: int, held: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    """Sums over the links of each of a block's documents; ``held``: places and values (twice the count, and best) of its pairs."""
    value = np.zeros(n_pairs, np.int64)
    for at, values in held:
        value[at] = values
    docs, places, sizes = _unpacked(body)
    entries = docs.column("entries").to_numpy()
    ends = np.cumsum(entries)
    n = int(entries.sum())
    place, size = _wide(places, n), _wide(sizes, n)
    sums = {}
    for name, each in (("n_best", value & 1), ("count_sum", value >> 1)):
        up_to = np.concatenate([[0], np.cumsum(size * each[place])])
        sums[name] = pa.array(up_to[ends] - up_to[ends - entries], pa.int64())
    names = [c.split(" ")[0] for c in _RESULT.split(", ")]
    return pa.RecordBatch.from_arrays([sums[c] if c in sums else docs.column(c) for c in names], names=names)


def _answered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows: the answers of a block's pairs, then the block (``place`` is null, ``value`` its number of pairs)."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    for batch in batches:
        place, value = batch.column("place"), batch.column("value")
        start = 0
        for row in [*np.flatnonzero(place.is_null().to_numpy(zero_copy_only=False)).tolist(), batch.num_rows]:
            if row > start:  # copies: a slice would keep its batch, with the blocks in it
                held.append(tuple(c.slice(start, row - start).to_numpy(zero_copy_only=False).copy() for c in (place, value)))
            if row < batch.num_rows:
                yield _summed(memoryview(batch.column("body")[row].as_buffer()), value[row].as_py(), held)
                held.clear()
            start = row + 1


def linked_pairs(blocks: DataFrame) -> DataFrame:
    """pair, a, b, n (documents that hold it linked), best (n is the highest of its a)."""
    each = blocks.select("held", F.posexplode("pairs").alias("place", "pair")).select("pair", F.get("held", F.col("place")).alias("held"))
    counts = each.groupBy("pair").agg(F.sum("held").alias("n")) \
        .select("pair", F.shiftright("pair", _ID_BITS).alias("a"), F.col("pair").bitwiseAND(F.lit(_MASK)).alias("b"), "n")
    counts = staged(counts, "linked-pairs")
    tops = counts.groupBy("a").agg(F.max("n").alias("top"))
    return counts.join(tops, "a").select("pair", "a", "b", "n", (F.col("n") == F.col("top")).alias("best"))


def token_blocks(docs: DataFrame, first: str = FIRST, second: str = SECOND) -> DataFrame:
    """Every document tokenized and aligned, in blocks; a written table."""
    blocks = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_tokenize(first, second), _BLOCK)
    # A writer holds a row group (100 rows before it looks at their size), and a reader decodes its rows at once.
    return staged(blocks, "token-blocks", **{"parquet.block.row.count.limit": "1"})


def alignment(docs: DataFrame, first: str = FIRST, second: str = SECOND) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    blocks = token_blocks(docs, first, second)
    pairs = linked_pairs(blocks).select("pair", (F.col("n") * 2 + F.col("best").cast("int")).alias("value"))
    asked = blocks.select("block", F.posexplode("pairs").alias("place", "pair"))
    bodies = blocks.select("block", F.size("pairs").cast("long").alias("value"), "body")
    rows = asked.join(pairs, "pair").drop("pair").unionByName(bodies, allowMissingColumns=True)
    # A task for every block, so that what a task reads does not grow with the input.
    tasks = max(shuffle_partitions(docs.sparkSession), blocks.count())
    dealt = rows.repartition(tasks, "block").sortWithinPartitions("block", F.col("place").asc_nulls_last())
    return dealt.select("place", "value", "body").mapInArrow(_answered, _RESULT)
