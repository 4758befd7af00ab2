"""Operator 3, n-gram Jaccard join by chosen paths.

Documents are sets of five-word shingles; documents with equal sets are one
node. Every node walks down a random tree in each run: at a tree node it
chooses those of its shingles whose hash, seeded by the path so far, falls
below 1 / (LAMBDA * size), 1.25 on average, and each chosen shingle leads to
a child. Similar sets choose the same shingles, so they meet in a bucket.
Buckets that are small are compared by brute force; larger ones are split
again, unless their members are alike already (average similarity of their
sketches) or the tree is at its full depth: those are compared in blocks of
bounded size, block by block, so nothing is capped. ``runs_for`` gives the
runs for a target recall.

Buckets first compare one-permutation sketches (64 bytes a row). Rows with a
likely partner fetch their sets, and the exact Jaccard similarity decides.
A pair that meets in several buckets counts in the smallest one only: every
row carries its buckets, so link counts are exact without listing pairs.
Each bucket emits one row per member (its links and the root of its linked
group), never its pairs; the groups are then connected across buckets by
repeated least labels with pointer jumping.

Hot cases: copies are one node by a partial aggregate; a bucket of any size
is dealt as blocks; the members of a large bucket that share a smaller large
bucket are not compared again with one another.

Defined results: a null text, or one without words, is linked with nothing
and is its own class; fewer than five words make one shingle; repeated rows
are copies; the class id is the least doc_id of the class (null only if all
are null); an empty table gives no rows; other columns are not read.
Exact up to hash collisions (64 bits per shingle, 32 when compared).
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import shuffle_partitions, staged
from .tokens import WORD_BYTES, WordHasher, mix, shingles

SHINGLE = 5
THRESHOLD = 0.8
LAMBDA = 0.8
DEPTH = 3
RECALL = 0.9999
SKETCH = 64
LIKELY = 0.55  # sketch estimate from which a pair is compared exactly: five standard errors below 0.8
BLOCK_ROWS = 512
BLOCK_SHINGLES = 1 << 20
ALIKE = 0.5
_PAIRS = 1 << 18  # pairs of rows listed at a time (more only for one bucket)


def runs_for(recall: float = RECALL, depth: int = DEPTH) -> int:
    """Runs until a pair at the threshold meets at full depth with this
    probability (a branching process with one shared child on average)."""
    meets = 1.0
    for _ in range(depth):
        meets = 1 - math.exp(-meets)
    return math.ceil(math.log(1 - recall) / math.log(1 - meets))


def chosen(tokens: np.ndarray, paths: np.ndarray, bound: np.uint64) -> tuple[np.ndarray, np.ndarray]:
    """(parent, path) of the children that a set has below each of ``paths``."""
    parents, children = [], []
    step = max(1, (1 << 20) // max(1, len(tokens)))
    for at in range(0, len(paths), step):
        h = tokens[None, :] ^ paths[at:at + step, None]
        h *= np.uint64(0x9FB21C651E98DF25)
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
        i, j = np.nonzero(h < bound)
        parents.append(paths[at + i])
        children.append(mix(h[i, j] + paths[at + i]))
    return np.concatenate(parents or [tokens[:0]]), np.concatenate(children or [tokens[:0]])


def tree(tokens: np.ndarray, runs: int, depth: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per level, the set's parent paths and paths."""
    bound = np.uint64(min((1 << 64) - 1, int((1 << 64) / (LAMBDA * max(1, len(tokens))))))
    levels, paths = [], mix(np.arange(1, runs + 1, dtype=np.uint64))
    for _ in range(depth):
        levels.append(chosen(tokens, paths, bound))
        paths = levels[-1][1]
    return levels


def sketch(tokens: np.ndarray) -> bytes:
    """One-permutation sketch: per bin of the (sorted) hashes a byte of its least one, 0 if empty."""
    bins = (tokens >> np.uint64(58)).astype(np.int64)
    at, first = np.unique(bins, return_index=True)
    out = np.zeros(SKETCH, np.uint8)
    out[at] = ((tokens[first] >> np.uint64(8)) % np.uint64(255)).astype(np.uint8) + 1
    return out.tobytes()


def pack(tokens: np.ndarray) -> bytes:
    """Sorted 32-bit parts as gaps, byte plane by byte plane (the high planes compress)."""
    low = (tokens >> np.uint64(32)).astype(np.uint32)
    return np.diff(low, prepend=np.uint32(0)).astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def unpack(data: bytes) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(4, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u4").ravel(), dtype=np.uint32)


def _paths(levels: list[tuple[np.ndarray, np.ndarray]]) -> pa.Array:
    """Lists of (parent, path) as an Arrow list column; uint64 stored as bigint."""
    offsets = np.cumsum([0] + [len(p) for p, _ in levels]).astype(np.int32)
    parent, key = (pa.array(np.concatenate([x[i] for x in levels]).view(np.int64)) for i in (0, 1))
    return pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays([parent, key], names=["parent", "key"]))


def _sets(runs: int, depth: int):
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher(WORD_BYTES)
        for whole in batches:
            for at in range(0, len(whole), 256):
                batch = whole.slice(at, 256)
                made: dict[str, list] = {k: [] for k in ("sid", "n", "tokens", "sketch")}
                levels: list[list] = [[] for _ in range(depth)]
                for text in batch.column("text"):
                    tokens = shingles(hasher(text.as_py()), SHINGLE)
                    made["sid"].append(hashlib.blake2b(tokens.tobytes(), digest_size=16).digest() if len(tokens) else None)
                    made["n"].append(len(tokens))
                    made["tokens"].append(pack(tokens))
                    made["sketch"].append(sketch(tokens))
                    for level, paths in zip(levels, tree(tokens, runs, depth)):
                        level.append(paths)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), batch.column("body"), pa.array(made["sid"], pa.binary()), pa.array(made["n"], pa.int64()),
                     pa.array(made["tokens"], pa.binary()), pa.array(made["sketch"], pa.binary()), *map(_paths, levels)],
                    names=["doc_id", "body", "sid", "n", "tokens", "sketch", *[f"level{i}" for i in range(depth)]])
    return sets


def shingle_sets(docs: DataFrame, runs: int, depth: int) -> DataFrame:
    """The written table of sets: row, doc_id, body, sid, n, tokens, sketch, level0.. (paths)."""
    node = T.ArrayType(T.StructType([T.StructField("parent", T.LongType()), T.StructField("key", T.LongType())]))
    fields = {"doc_id": docs.schema["doc_id"].dataType, "body": T.LongType(), "sid": T.BinaryType(), "n": T.LongType(),
              "tokens": T.BinaryType(), "sketch": T.BinaryType()} | {f"level{i}": node for i in range(depth)}
    schema = T.StructType([T.StructField(name, kind) for name, kind in fields.items()])
    made = docs.select("doc_id", F.xxhash64("text").alias("body"), "text").mapInArrow(_sets(runs, depth), schema)
    # The row number is fixed by the write.
    return staged(made.withColumn("row", F.monotonically_increasing_id()), "shingle-sets")


def _alike(members: DataFrame, sets: DataFrame) -> DataFrame:
    """key, alike: average similarity of the bucket's members, from how often
    four sketch bytes agree (a sum of squared counts per bucket and byte).
    Members stay one row each; a byte's counts are taken per bucket."""
    places = range(0, SKETCH, SKETCH // 4)
    seen = staged(members.join(sets.select(F.col("row").alias("rep"), "sketch"), "rep")
                  .select("key", *[F.substring("sketch", i + 1, 1).alias(f"byte{i}") for i in places]), "bucket-bytes")
    agree = [seen.groupBy("key", f"byte{i}").agg(F.count(F.lit(1)).cast("double").alias("c"))
             .groupBy("key").agg((F.sum(F.col("c") * F.col("c")) / F.pow(F.sum("c"), 2)).alias("s")) for i in places]
    return reduce(DataFrame.unionByName, agree).groupBy("key").agg(F.avg("s").alias("alike"))


def leaves(sets: DataFrame, reps: DataFrame, depth: int) -> DataFrame:
    """rep, key, blocks: the buckets of at least two nodes in which each node is compared."""
    found, opened = None, None
    for level in range(depth):
        paths = sets.select(F.col("row").alias("rep"), "n", F.col(f"level{level}").alias("paths"))
        if opened is None:
            # Merge joins at every size: the sets are the large side, and so
            # are in the end the representatives.
            drawn = paths.join(reps.select("rep").hint("merge"), "rep", "left_semi")
        else:  # only the children of buckets that are split
            drawn = (paths.join(opened.hint("merge"), "rep")
                     .withColumn("paths", F.filter("paths", lambda p: F.array_contains("open", p["parent"]))))
        nodes = staged(drawn.select("rep", "n", F.explode("paths").alias("path")).select("rep", "n", "path.key"), f"tree-level{level}")
        sizes = staged(nodes.groupBy("key").agg(F.count(F.lit(1)).alias("size"), F.sum("n").alias("shingles"))
                       .filter("size > 1"), f"bucket-sizes{level}")
        small = (F.col("size") <= BLOCK_ROWS) & (F.col("shingles") <= BLOCK_SHINGLES)
        blocks = F.greatest(F.ceil(F.col("size") / BLOCK_ROWS), F.ceil(F.col("shingles") / BLOCK_SHINGLES)).cast("int")
        big = sizes.filter(~small)
        if level + 1 < depth:
            alike = _alike(nodes.select("rep", "key").join(big.select("key"), "key", "left_semi"), sets)
            big = staged(big.join(alike, "key", "left").withColumn("split", F.coalesce(F.col("alike") < ALIKE, F.lit(True))),
                         f"large-buckets{level}")
            split = nodes.join(big.filter("split").select("key"), "key", "left_semi")
            opened = staged(split.groupBy("rep").agg(F.collect_list("key").alias("open")), f"split-buckets{level}")
            big = big.filter("NOT split")
        kept = sizes.filter(small).select("key", F.lit(1).alias("blocks")).unionByName(big.select("key", blocks.alias("blocks")))
        part = nodes.join(kept.hint("merge"), "key").select("rep", "key", "blocks")
        found = part if found is None else found.unionByName(part)
    return staged(found, "leaves")


def _links(rows: list[dict], key: int, cross: bool) -> tuple[np.ndarray, np.ndarray]:
    """(pairs to link, pairs owned here) of a bucket, as boolean matrices."""
    n = np.array([r["n"] for r in rows], np.int64)
    size = len(rows)
    near = np.minimum(n[:, None], n[None, :]) >= THRESHOLD * np.maximum(n[:, None], n[None, :]) - 1e-9
    np.fill_diagonal(near, False)
    if cross:
        part = np.array([r["part"] for r in rows])
        near &= part[:, None] != part[None, :]
    s = np.frombuffer(b"".join(r["sketch"] for r in rows), np.uint8).reshape(size, SKETCH)
    same, empty = np.zeros((size, size), np.int16), np.zeros((size, size), np.int16)
    for c in range(SKETCH):
        v, filled = s[:, c], s[:, c] > 0
        same += (v[:, None] == v[None, :]) & filled[:, None]
        empty += ~(filled[:, None] | filled[None, :])
    near &= same >= LIKELY * (SKETCH - empty)
    # Buckets that both members share and that come before this one.
    lists = [[k for k in r["keys"] if k < key] for r in rows]
    number = {k: i for i, k in enumerate(sorted({k for ks in lists for k in ks}))}
    earlier = np.zeros((size, len(number)), np.float32)
    for i, ks in enumerate(lists):
        earlier[i, [number[k] for k in ks]] = 1
    owned = near & (earlier @ earlier.T == 0)
    if not owned.any():
        return owned, owned
    sets = [unpack(r["tokens"]) for r in rows]
    flat = np.concatenate(sets)
    _, number_of, times = np.unique(flat, return_inverse=True, return_counts=True)
    row_of = np.repeat(np.arange(size), [len(x) for x in sets])
    column = np.full(len(times), -1)
    column[times > 1] = np.arange((times > 1).sum())
    at = column[number_of]
    row_of, at = row_of[at >= 0], at[at >= 0]
    order = np.argsort(at, kind="stable")
    row_of, at = row_of[order], at[order]
    both = np.zeros((size, size), np.float32)
    width = 8192
    for start in range(0, int((times > 1).sum()), width):
        part = slice(*np.searchsorted(at, [start, start + width]))
        a = np.zeros((size, width), np.float32)
        a[row_of[part], at[part] - start] = 1
        both += a @ a.T
    joint = n[:, None] + n[None, :] - both
    linked = near & (both >= THRESHOLD * joint - 1e-6)
    return linked, linked & owned


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, list[dict]]]:
    """Buckets of rows that come sorted by bucket, across batches."""
    at, rows = None, []
    for whole in batches:
        for start in range(0, len(whole), 512):
            for r in whole.slice(start, 512).to_pylist():
                here = (r["key"], r["pair"], r["cross"])
                if here != at:
                    if rows:
                        yield at, rows
                    at, rows = here, []
                rows.append(r)
    if rows:
        yield at, rows


def _whole_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """(rows, the buckets' starts), cut where a bucket ends."""
    def starts(batch: pa.RecordBatch) -> np.ndarray:
        new = np.ones(len(batch), bool)
        new[1:] = False
        for name in ("key", "pair", "cross"):
            v = batch.column(name).to_numpy(zero_copy_only=False)
            new[1:] |= v[1:] != v[:-1]
        return np.flatnonzero(new)

    def joined(parts: list[pa.RecordBatch]) -> tuple[pa.RecordBatch, np.ndarray]:
        whole = pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
        return whole, starts(whole)

    held: list[pa.RecordBatch] = []
    for batch in batches:
        last = int(starts(batch)[-1]) if len(batch) else 0
        if last:
            yield joined([*held, batch.slice(0, last)])
            held = []
        if len(batch):
            held.append(batch.slice(last))
    if held:
        yield joined(held)


def _alike_pairs(end: np.ndarray, n: np.ndarray, part: np.ndarray, sketches: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (i < j) of rows whose sizes and sketches allow a link, in order of
    i. Row i is paired with the rows before ``end[i]`` of another part (-1: of any)."""
    partners = end - np.arange(len(end)) - 1
    i = np.repeat(np.arange(len(end)), partners)
    j = i + 1 + np.arange(len(i)) - (np.cumsum(partners) - partners)[i]
    near = np.minimum(n[i], n[j]) >= THRESHOLD * np.maximum(n[i], n[j]) - 1e-9
    near &= (part[i] < 0) | (part[i] != part[j])
    i, j = i[near], j[near]
    ok = np.zeros(len(i), bool)
    for at in range(0, len(i), 1 << 14):  # 1 MB of sketches
        a, b = sketches[i[at:at + (1 << 14)]], sketches[j[at:at + (1 << 14)]]
        same, empty = np.count_nonzero((a == b) & (a > 0), axis=1), np.count_nonzero((a | b) == 0, axis=1)
        ok[at:at + (1 << 14)] = same >= LIKELY * (SKETCH - empty)
    return i[ok], j[ok]


def _owned(i: np.ndarray, j: np.ndarray, key: int, keys: Callable[[int], np.ndarray]) -> np.ndarray:
    """Which pairs of a bucket share no bucket that comes before it (``keys``: a row's buckets)."""
    rows, at = np.unique(np.concatenate([i, j]), return_inverse=True)
    lists = [ks[ks < key] for ks in map(keys, rows.tolist())]
    known, number = np.unique(np.concatenate(lists), return_inverse=True)
    earlier = np.zeros((len(rows), len(known)), np.float32)
    earlier[np.repeat(np.arange(len(rows)), [len(ks) for ks in lists]), number] = 1
    return (earlier @ earlier.T == 0)[at[:len(i)], at[len(i):]]


def _likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Members with a likely partner that this bucket owns. All pairs of many
    small buckets are compared at once."""
    for batch, start in _whole_buckets(batches):
        key, n = batch.column("key").to_numpy(), batch.column("n").to_numpy()
        cross = batch.column("cross").to_numpy(zero_copy_only=False)
        part = np.where(cross, batch.column("part").to_numpy(), -1)
        sketches = np.frombuffer(b"".join(batch.column("sketch").to_pylist()), np.uint8).reshape(-1, SKETCH)
        values, offsets = batch.column("keys").values.to_numpy(), batch.column("keys").offsets.to_numpy()
        size = np.diff(np.append(start, len(batch)))
        pairs = np.cumsum(size * (size - 1) // 2)
        keep, at = np.zeros(len(batch), bool), 0
        while at < len(start):  # whole buckets, as many as have some pairs
            to = max(at + 1, int(np.searchsorted(pairs, (pairs[at - 1] if at else 0) + _PAIRS, "right")))
            low, high = int(start[at]), int(start[to - 1] + size[to - 1])
            span = slice(low, high)
            i, j = _alike_pairs(np.repeat(start[at:to] + size[at:to] - low, size[at:to]), n[span], part[span], sketches[span])
            bucket = np.searchsorted(start, i + low, "right")
            for some in np.split(np.arange(len(i)), np.flatnonzero(np.diff(bucket)) + 1) if len(i) else []:
                a, b = i[some] + low, j[some] + low
                owned = _owned(a, b, int(key[a[0]]), lambda r: values[offsets[r]:offsets[r + 1]])
                keep[a[owned]] = keep[b[owned]] = True
            at = to
        if keep.any():
            yield batch.filter(pa.array(keep))


_LIKELY = "key bigint, pair bigint, cross boolean, rep bigint, n bigint, part int, sketch binary, keys array<bigint>"


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """rep, links owned here, root: least member of its linked group here."""
    for (key, _, cross), rows in _groups(batches):
        linked, owned = _links(rows, key, cross)
        some = linked.any(1)
        if not some.any():
            continue
        reps = np.array([r["rep"] for r in rows], np.int64)
        root = reps.copy()
        while True:  # least label of the neighbours until nothing changes
            least = np.minimum(root, np.where(linked, root[None, :], np.iinfo(np.int64).max).min(1))
            if (least == root).all():
                break
            root = least
        yield pa.RecordBatch.from_arrays([pa.array(reps[some]), pa.array(owned.sum(1)[some].astype(np.int64)), pa.array(root[some])],
                                         names=["rep", "links", "root"])


def _buckets(rows: DataFrame) -> DataFrame:
    """Each bucket's rows side by side in one partition. The number of
    partitions is fixed: comparing costs more than the few bytes suggest by
    which they would be merged."""
    return rows.repartition(shuffle_partitions(rows.sparkSession), "key", "pair").sortWithinPartitions("key", "pair", "cross", "rep")


def _dealt(members: DataFrame) -> DataFrame:
    """Rows of the buckets to compare. A small bucket is one group. A large
    one is dealt into blocks, and each pair of blocks is a group. Members
    that share an earlier large bucket are compared there: each such class
    is dealt on its own and never paired with itself."""
    one = members.filter("blocks = 1").select("key", F.lit(0).cast("long").alias("pair"), F.lit(False).alias("cross"),
                                              "rep", "n", F.lit(0).alias("part"), "sketch", "keys")
    large = members.filter("blocks > 1").select(
        "key", "rep", "n", "sketch", "keys", F.array_min("large_keys").alias("home"), "blocks")
    # Blocks by class, sized by the class's own share of the bucket.
    shares = large.groupBy("key", "home").agg(F.count(F.lit(1)).alias("class_rows"), F.sum("n").alias("class_n"), F.first("blocks").alias("blocks"))
    dealt = shares.select("key", "home", F.greatest(F.ceil(F.col("class_rows") / BLOCK_ROWS), F.ceil(F.col("class_n") / BLOCK_SHINGLES))
                          .cast("int").alias("own"))
    plan = (dealt.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("home", "own"))).alias("classes")))
    # Classes per bucket: one for each other large bucket its members are in.
    each = large.select("key", "rep", "n", "sketch", "keys", "home").join(plan, "key")
    own = F.element_at(F.map_from_entries("classes"), F.col("home"))
    before = F.aggregate(F.filter("classes", lambda c: c["home"] < F.col("home")), F.lit(0), lambda a, c: a + c["own"])
    each = each.withColumn("first_block", before).withColumn("own", own) \
        .withColumn("total", F.aggregate("classes", F.lit(0), lambda a, c: a + c["own"])) \
        .withColumn("part", (F.col("first_block") + F.pmod(F.xxhash64("rep"), F.col("own"))).cast("int"))
    native = F.col("home") == F.col("key")
    others = F.filter(F.sequence(F.lit(0), F.col("total") - 1),
                      lambda b: native | (b < F.col("first_block")) | (b >= F.col("first_block") + F.col("own")))
    lo, hi = F.least("part", "other"), F.greatest("part", "other")
    paired = (each.withColumn("other", F.explode(others))
              .select("key", (lo.cast("long") * (1 << 31) + hi).alias("pair"), (lo != hi).alias("cross"), "rep", "n", "part", "sketch", "keys"))
    return one.unionByName(paired)


def links(docs: DataFrame, recall: float = RECALL, depth: int = DEPTH) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(sets table, reps: sid, rep, links per bucket: rep, links, root)."""
    runs = runs_for(recall, depth)
    sets = shingle_sets(docs, runs, depth)
    reps = staged(sets.filter("sid IS NOT NULL").groupBy("sid").agg(F.min("row").alias("rep")), "set-representatives")
    found = leaves(sets, reps, depth)
    large = F.when(F.col("blocks") > 1, F.col("key"))
    lists = found.groupBy("rep").agg(F.array_sort(F.collect_list("key")).alias("keys"), F.collect_list(large).alias("large_keys"),
                                     F.collect_list(F.struct("key", "blocks")).alias("mine"))
    members = (lists.hint("merge").join(sets.select(F.col("row").alias("rep"), "n", "sketch"), "rep")
               .select("rep", "n", "sketch", "keys", "large_keys", F.explode("mine").alias("m"))
               .select("rep", "n", "sketch", "keys", "large_keys", "m.key", "m.blocks"))
    active = staged(_buckets(_dealt(members)).mapInArrow(_likely, _LIKELY), "likely-members")
    with_sets = active.hint("merge").join(sets.select(F.col("row").alias("rep"), "tokens"), "rep")
    verified = _buckets(with_sets).mapInArrow(_verify, "rep bigint, links bigint, root bigint")
    return sets, reps, staged(verified, "bucket-links")


def components(edges: DataFrame) -> DataFrame:
    """node, label: the least node of each connected component of edges(a, b)."""
    both = staged(edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = staged(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("label")).withColumnRenamed("a", "node"), "labels")
    while True:
        around = both.join(labels, F.col("b") == F.col("node")).groupBy("a").agg(F.min("label").alias("around"))
        closer = labels.join(around, F.col("node") == F.col("a")).select("node", "label", F.least("label", "around").alias("next"))
        jump = labels.select(F.col("node").alias("at"), F.col("label").alias("further"))
        moved = staged(closer.join(jump, F.col("next") == F.col("at"), "left")
                       .select("node", "label", F.least("next", F.coalesce("further", "next")).alias("next")), "labels")
        labels = moved.select("node", F.col("next").alias("label"))
        if moved.filter("next <> label").limit(1).count() == 0:
            return labels


def _classes(docs: DataFrame, **options) -> tuple[DataFrame, DataFrame]:
    """(sets table, per node: sid, n_links, label)."""
    sets, reps, verified = links(docs, **options)
    counted = verified.groupBy("rep").agg(F.sum("links").cast("long").alias("n_links"))
    labels = components(verified.filter("rep <> root").select(F.col("rep").alias("a"), F.col("root").alias("b")))
    nodes = (reps.join(counted, "rep", "left").join(labels.withColumnRenamed("node", "rep"), "rep", "left")
             .select("sid", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("label", "rep").alias("label")))
    return sets, nodes


def _members(docs: DataFrame, **options) -> DataFrame:
    """row, doc_id, body, n_links, label, class_id, class_size of every document."""
    sets, nodes = _classes(docs, **options)
    rows = staged(sets.select("row", "doc_id", "body", "sid").join(nodes, "sid", "left")
                  .select("row", "doc_id", "body", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), "label"), "members")
    named = rows.filter("label IS NOT NULL").groupBy("label").agg(
        F.min("doc_id").alias("class_id"), F.count(F.lit(1)).alias("class_size"),
        F.min_by("row", F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("keeper"))
    # Only classes of several documents are looked up.
    return (rows.join(named.filter("class_size > 1"), "label", "left")
            .select("row", "doc_id", "body", "n_links", F.coalesce("class_id", "doc_id").alias("class_id"),
                    F.coalesce("class_size", F.lit(1)).cast("long").alias("class_size"),
                    F.coalesce(F.col("keeper") == F.col("row"), F.lit(True)).alias("kept")))


def jaccard_join(docs: DataFrame, **options) -> DataFrame:
    """doc_id, class_id, class_size (documents), n_links (other texts at 0.8 or more), kept (one of each class)."""
    return _members(docs, **options).select("doc_id", "class_id", "class_size", "n_links", "kept")


def without_near_copies(docs: DataFrame, **options) -> DataFrame:
    """One document of each class, the one with the least doc_id, all columns kept."""
    decided = _members(docs, **options)
    # Equal (doc_id, text) rows are told apart by number, not by content.
    gone = decided.groupBy("doc_id", "body").agg(F.sum(F.col("kept").cast("int")).alias("stay"), F.count(F.lit(1)).alias("rows"))
    some = staged(gone.filter("stay < rows"), "near-copies").select("doc_id", "body", (F.col("stay") > 0).alias("one_stays"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                       F.col("doc_id").alias("own_id"), F.xxhash64("text").alias("own_body"))
    marked = rows.join(some, F.col("own_id").eqNullSafe(F.col("doc_id")) & (F.col("own_body") == F.col("body")), "left")
    plain = marked.filter("body IS NULL").select("row")
    repeated = marked.filter("one_stays").dropDuplicates(["own_id", "own_body"]).select("row")
    return plain.unionByName(repeated).select(*[F.col("row").getField(c).alias(c) for c in docs.columns])


#: DuckDB: shingle sets, links and classes of table ``numbered(r, doc_id, text)``.
CLASSES_CTES = r"""
shingled AS (SELECT r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM numbered),
grams AS (SELECT DISTINCT r, array_to_string(w[i:i + least(len(w), 5) - 1], ' ') AS gram FROM shingled, range(1, greatest(len(w) - 4, 1) + 1) t(i) WHERE len(w) > 0),
bags AS (SELECT r, count(*) AS n, md5(string_agg(gram, '|' ORDER BY gram)) AS bag FROM grams GROUP BY r),
shared AS (SELECT x.r AS a, y.r AS b, count(*) AS c FROM grams x JOIN grams y ON x.gram = y.gram AND x.r <> y.r GROUP BY ALL),
linked AS (SELECT a, b, y.bag AS other, x.bag <> y.bag AS differs FROM shared JOIN bags x ON x.r = a JOIN bags y ON y.r = b WHERE c >= 0.8 * (x.n + y.n - c)),
reach(a, b) AS (SELECT a, b FROM linked UNION SELECT reach.a, linked.b FROM reach JOIN linked ON reach.b = linked.a),
class_of AS (SELECT numbered.r, min(m.doc_id) AS class_id, count(DISTINCT m.r) AS class_size, arg_min(m.r, (m.doc_id IS NULL, m.doc_id, m.r)) AS keeper
  FROM numbered JOIN (SELECT a, b FROM reach UNION SELECT r, r FROM numbered) g ON g.a = numbered.r JOIN numbered m ON m.r = g.b GROUP BY numbered.r),
link_counts AS (SELECT a AS r, count(DISTINCT other) FILTER (differs) AS n_links FROM linked GROUP BY a)
"""

JOIN_SQL = "WITH RECURSIVE numbered AS (SELECT row_number() OVER () AS r, * FROM documents)," + CLASSES_CTES + """
SELECT doc_id, class_id, class_size, coalesce(n_links, 0) AS n_links, keeper = r AS kept
FROM numbered JOIN class_of USING (r) LEFT JOIN link_counts USING (r)
"""
