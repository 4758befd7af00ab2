"""Operator 10, exact de-duplication by a Golomb-coded fingerprint exchange.

1. One pass over the texts writes a narrow table: id, SHA-256 of the
   normalised text (A-Z lower-cased, null as empty) and its first 8 bytes as
   fingerprint.
2. Each partition of it sends every owner (a range of the fingerprint space)
   its sorted, distinct, Golomb-Rice-coded fingerprints, with a bit for those
   it holds more than once. Equal fingerprints meet at their owner at most
   once per partition, so a text that fills a third of the rows stays small.
3. Owners answer with one bit per fingerprint: seen elsewhere or twice.
4. Partitions turn the bits into suspect fingerprints, which set the bits of
   a table of at most 16 MB. The texts are read again, and only those whose
   fingerprint passes the table leave the reading task, grouped by their
   normalised bytes: the byte verification. It is a partial aggregate, so
   copies collapse before the shuffle, and what passes by chance is a group of
   one. (From some ten million suspects on the table fills up and more passes;
   results do not change.)

Of equal texts the row with the largest doc_id stays (exactly one row, also
among repeated rows of the same id; a null id only if all are null).

Defined results: null text counts as empty; repeated rows count in
``group_size``; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.expand import expand
from .bits import bit_table, passes
from .common import shuffle_partitions, staged
from .golomb import rice_decode, rice_encode

PIECE = 256  # rows of a batch whose suspects are passed on together


def _normal(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass").lower()  # bytes.lower() touches A-Z only


def _leading(digests: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(d[:8] for d in digests), ">u8").astype(np.uint64)


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        digests = [hashlib.sha256(_normal(t.as_py())).digest() for t in batch.column(1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(_leading(digests).view(np.int64)), pa.array(digests, pa.binary())],
                                         names=["doc_id", "fp", "digest"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, fp, digest of every row."""
    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType),
                           T.StructField("fp", T.LongType()), T.StructField("digest", T.BinaryType())])
    return docs.select("doc_id", "text").mapInArrow(_fingerprints, schema)


def _owner(fp: np.ndarray, owners: int) -> np.ndarray:
    return ((fp >> np.uint64(32)) * np.uint64(owners) >> np.uint64(32)).astype(np.int64)


def _send(owners: int):
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        sender = TaskContext.get().partitionId()
        held = [b.column(0).to_numpy(zero_copy_only=False).view(np.uint64) for b in batches]
        fps, times = np.unique(np.concatenate(held) if held else np.empty(0, np.uint64), return_counts=True)
        cuts = np.searchsorted(_owner(fps, owners), np.arange(owners + 1))
        for o in range(owners):
            part = slice(cuts[o], cuts[o + 1])
            if cuts[o] < cuts[o + 1]:
                yield pa.RecordBatch.from_pydict({
                    "owner": pa.array([o], pa.int32()), "sender": pa.array([sender], pa.int32()),
                    "coded": [rice_encode(fps[part])], "twice": [np.packbits(times[part] > 1).tobytes()]})
    return send


def _answer(group: pd.DataFrame) -> pd.DataFrame:
    """Owner: one duplicate bitmap for each sender."""
    sent = [rice_decode(c) for c in group.coded]
    seen, times = np.unique(np.concatenate(sent), return_counts=True)
    common = seen[times > 1]
    bits = []
    for fps, twice in zip(sent, group.twice):
        local = np.unpackbits(np.frombuffer(twice, np.uint8), count=len(fps)).astype(bool)
        bits.append(np.packbits(local | np.isin(fps, common, assume_unique=True)).tobytes())
    return pd.DataFrame({"owner": group.owner, "sender": group.sender, "duplicate": bits})


def _suspects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for coded, bits in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            fps = rice_decode(coded)
            marked = np.unpackbits(np.frombuffer(bits, np.uint8), count=len(fps)).astype(bool)
            yield pa.RecordBatch.from_arrays([pa.array(fps[marked].view(np.int64))], names=["fp"])


def suspect_fingerprints(prints: DataFrame) -> DataFrame:
    """Fingerprints held by more than one row, by the Golomb-coded exchange."""
    owners = shuffle_partitions(prints.sparkSession)
    sent = staged(prints.select("fp").mapInArrow(
        _send(owners), "owner int, sender int, coded binary, twice binary"), "coded-fingerprints")
    answers = sent.groupBy("owner").applyInPandas(_answer, "owner int, sender int, duplicate binary")
    return (sent.join(answers, ["owner", "sender"]).select("coded", "duplicate")
            .mapInArrow(_suspects, "fp long").distinct())


def _suspect_texts(table):
    """digest and bytes of the normalised texts whose fingerprint passes ``table``."""
    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, PIECE):  # only suspects' texts are held, a piece at a time
                ids, texts = (c.slice(start, PIECE) for c in batch.columns)
                digests = [hashlib.sha256(_normal(t.as_py())).digest() for t in texts]
                at = np.flatnonzero(passes(table.value, _leading(digests)))
                if len(at):
                    yield pa.RecordBatch.from_arrays(
                        [ids.take(pa.array(at)), pa.array([digests[i] for i in at], pa.binary()),
                         pa.array([_normal(texts[i].as_py()) for i in at], pa.binary())], names=["doc_id", "digest", "normal"])
    return pick


def exact_dedup(docs: DataFrame) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256, one row per row of ``docs``."""
    prints = staged(fingerprints(docs), "fingerprints")
    suspects = staged(suspect_fingerprints(prints), "suspects")
    table = docs.sparkSession.sparkContext.broadcast(bit_table(suspects, "fp", 64, suspects.count()))
    schema = T.StructType([docs.schema["doc_id"], T.StructField("digest", T.BinaryType()),
                           T.StructField("normal", T.BinaryType())])
    groups = (docs.select("doc_id", "text").mapInArrow(_suspect_texts(table), schema)
              .groupBy("digest", "normal")  # equal bytes, not only equal digests
              .agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
              .filter("group_size > 1").select("digest", "keep_id", "group_size"))
    rows = prints.groupBy("doc_id", "digest").agg(F.count(F.lit(1)).alias("_n"))
    r, g = rows.alias("r"), groups.alias("g")
    joined = r.join(g, "digest", "left").select(
        "doc_id", F.coalesce("g.keep_id", "r.doc_id").alias("keep_id"),
        F.coalesce("g.group_size", F.lit(1)).cast("long").alias("group_size"),
        F.lower(F.hex("digest")).alias("text_sha256"), F.col("_n"))
    joined = staged(joined, "verified")
    single = joined.filter("_n = 1").withColumn("_copy", F.lit(1).cast("long"))
    repeated = expand(joined.filter("_n > 1").withColumn("_first", F.lit(1).cast("long")), "_first", "_n", "_copy")
    return single.unionByName(repeated.drop("_first")).select(
        "doc_id", "keep_id", "group_size",
        ((F.col("_copy") == 1) & F.col("doc_id").eqNullSafe(F.col("keep_id"))).alias("kept"), "text_sha256")


DEDUP_SQL = """
WITH normal AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
ranked AS (SELECT doc_id, sha256(t) AS text_sha256, max(doc_id) OVER (PARTITION BY t) AS keep_id,
  count(*) OVER (PARTITION BY t) AS group_size, row_number() OVER (PARTITION BY t ORDER BY doc_id DESC NULLS LAST) AS place FROM normal)
SELECT doc_id, keep_id, group_size, place = 1 AS kept, text_sha256 FROM ranked
"""
