"""Operator 6, benchmark decontamination by Wu-Manber multi-pattern search.

Patterns are windows of ten consecutive item words; a shorter item is one
window. A search over words, one table set per window length m: the shift of
a block of up to three words says how far the window may jump; blocks that
end a pattern have shift 0 and open their bucket of patterns, which are
filtered by their first word and compared word by word.

Documents are scanned in one narrow pass, whole texts, without any shuffle.
The patterns travel with the tasks in chunks of at most ``chunk_windows``
windows, a checked bound: a benchmark beyond it is matched chunk by chunk
over a written table that carries the hits found so far.

Defined results: null text or one without words has no hits; items without
words are ignored; words inside an item with a null id are hit, but such
items are not counted or listed; repeated item ids count once; an empty table
gives no rows; every document row is judged on its own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import staged

WINDOW = 10
BLOCK = 3
CHUNK_WINDOWS = 200_000

#: Every byte that is not part of a word (a-z, 0-9, beyond ASCII) becomes a space.
_SPACED = bytes(c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def words(text: str | None) -> list[bytes]:
    """Words of the A-Z lower-cased text, as UTF-8."""
    return (text or "").encode("utf-8", "surrogatepass").lower().translate(_SPACED).split()


def windows(item: list[bytes], width: int = WINDOW) -> list[tuple[bytes, ...]]:
    if not item:
        return []
    return [tuple(item[i:i + width]) for i in range(max(1, len(item) - width + 1))]


class WuManber:
    """Search of word patterns of one length."""

    def __init__(self, length: int, block: int = BLOCK) -> None:
        self.m, self.b = length, min(block, length)
        self.default = length - self.b + 1
        self.shift: dict[bytes, int] = {}
        self.bucket: dict[bytes, list[tuple[bytes, tuple[bytes, ...], list]]] = {}
        self.known: dict[tuple[bytes, ...], list] = {}

    def add(self, pattern: tuple[bytes, ...], item) -> None:
        if pattern in self.known:
            self.known[pattern].append(item)
            return
        self.known[pattern] = owners = [item]
        for end in range(self.b, self.m + 1):
            key = b" ".join(pattern[end - self.b:end])
            self.shift[key] = min(self.shift.get(key, self.default), self.m - end)
        self.bucket.setdefault(b" ".join(pattern[-self.b:]), []).append((pattern[0], pattern, owners))

    def search(self, text: list[bytes], hit: np.ndarray, items: set) -> None:
        m, b, shift, bucket, default = self.m, self.b, self.shift, self.bucket, self.default
        at, n = m, len(text)  # the window is text[at - m:at]
        while at <= n:
            key = b" ".join(text[at - b:at])
            jump = shift.get(key, default)
            if jump == 0:
                first = text[at - m]
                for start, pattern, owners in bucket[key]:
                    if start == first and pattern == tuple(text[at - m:at]):
                        hit[at - m:at] = True
                        items.update(owners)
                jump = 1
            at += jump


def matchers(rows: list[tuple], width: int = WINDOW) -> list[WuManber]:
    """Search tables for (item_id, text) rows, one for each window length."""
    by_length: dict[int, WuManber] = {}
    for item_id, text in rows:
        for pattern in windows(words(text), width):
            by_length.setdefault(len(pattern), WuManber(len(pattern))).add(pattern, item_id)
    return list(by_length.values())


def _scan(rows: list[tuple], width: int, with_text: bool):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = matchers(rows, width)
        for batch in batches:
            n_words, n_hit, bits, found = [], [], [], []
            for text, old, before in zip(batch.column("text"), batch.column("hit_bits").to_pylist(),
                                         batch.column("items").to_pylist()):
                w = words(text.as_py())
                hit, items = np.zeros(len(w), bool), set(before)
                if old:
                    hit |= np.unpackbits(np.frombuffer(old, np.uint8), count=len(w)).astype(bool)
                for t in tables:
                    t.search(w, hit, items)
                n_words.append(len(w))
                n_hit.append(int(hit.sum()))
                bits.append(np.packbits(hit).tobytes() if n_hit[-1] else b"")
                items.discard(None)
                found.append(sorted(items))
            made = {"row": batch.column("row"), "text": batch.column("text"), "n_words": pa.array(n_words, pa.int64()),
                    "n_hit": pa.array(n_hit, pa.int64()), "hit_bits": pa.array(bits, pa.binary()),
                    "items": pa.array(found, pa.list_(pa.string()))}
            if not with_text:
                del made["text"]
            yield pa.RecordBatch.from_arrays(list(made.values()), names=list(made))
    return scan


def _chunks(benchmark: DataFrame, limit: int, width: int = WINDOW) -> Iterator[list[tuple]]:
    """Items in driver-sized chunks of at most ``limit`` words each (a word
    starts at most one window); a longer item is cut into parts that overlap
    by all but one word of a window, so no window is lost."""
    items = benchmark.filter("text IS NOT NULL").select(
        F.col("item_id").cast("string").alias("item_id"), "text").distinct()
    chunk, size = [], 0
    step = max(1, limit - width + 1)
    for row in items.toLocalIterator():
        w = words(row.text)
        for at in range(0, max(1, len(w) - width + 1), step):
            part = w[at:at + step + width - 1]
            if chunk and size + len(part) > limit:
                yield chunk
                chunk, size = [], 0
            chunk.append((row.item_id, b" ".join(part).decode("utf-8", "surrogatepass")))
            size += len(part)
    yield chunk


def find_hits(docs: DataFrame, benchmark: DataFrame, keep: list[str], width: int = WINDOW,
              chunk_windows: int = CHUNK_WINDOWS, with_text: bool = False) -> DataFrame:
    """row (a struct of the ``keep`` columns), text if asked for, n_words,
    n_hit, hit_bits (a bit per word), items (ids with occurring windows)."""
    zero = F.lit(0).cast("long")
    state = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), "text", zero.alias("n_words"),
                        zero.alias("n_hit"), F.lit(b"").alias("hit_bits"), F.array().cast("array<string>").alias("items"))
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in state.schema.fields])
    narrow = T.StructType([f for f in schema.fields if f.name != "text"])
    rows = None
    for following in _chunks(benchmark, chunk_windows, width):
        if rows is not None:
            state = staged(state.mapInArrow(_scan(rows, width, True), schema), "benchmark-hits")
        rows = following
    return state.mapInArrow(_scan(rows, width, with_text), schema if with_text else narrow)


def decontamination(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    found = find_hits(docs, benchmark, ["doc_id"], **options)
    listed = F.array_join(F.array_sort("items"), ",")
    return found.select("row.doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(listed, 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def without_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents in which no benchmark window occurs, all columns kept."""
    rest = [c for c in docs.columns if c != "text"]
    found = find_hits(docs, benchmark, rest, with_text=True, **options).filter("n_hit = 0")
    return found.select(*[F.col("text") if c == "text" else F.col("row").getField(c).alias(c) for c in docs.columns])


#: DuckDB: occurrences of benchmark windows in table ``numbered(r, doc_id, text)``.
FOUND_CTES = r"""
dw AS (SELECT r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM numbered),
bw AS (SELECT DISTINCT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE text IS NOT NULL),
patterns AS (SELECT DISTINCT item, least(len(w), 10) AS m, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS p FROM bw, range(1, greatest(len(w) - 9, 1) + 1) t(i) WHERE len(w) > 0),
spots AS (SELECT r, m, i, array_to_string(w[i:i + m - 1], ' ') AS p FROM dw, (SELECT DISTINCT m FROM patterns) k, range(1, len(w) - m + 2) t(i)),
found AS (SELECT r, m, i, item FROM spots JOIN patterns USING (m, p))
"""

DECONTAMINATION_SQL = "WITH numbered AS (SELECT row_number() OVER () AS r, * FROM documents)," + FOUND_CTES + """,
hits AS (SELECT r, count(DISTINCT j) AS n_hit FROM (SELECT r, unnest(range(i, i + m)) AS j FROM found) GROUP BY r),
items AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS list FROM (SELECT DISTINCT r, item FROM found WHERE item IS NOT NULL) GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(list, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM dw LEFT JOIN hits USING (r) LEFT JOIN items USING (r)
"""
