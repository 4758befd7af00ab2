"""Operator 13, phrase collocation mining by Rabin-Karp fingerprints.

Phrases are counted by length, in one pass of the texts each. Numpy prefix
polynomials fingerprint every n-gram. A pass sends, for each fingerprint of
which both (n-1)-grams may be frequent (the a-priori rule), its count, a check
value and an occurrence pointer (the hash of a document that has it), combined
in the task, and a shuffle aggregates them. Which (n-1)-grams are frequent,
tasks read from a bit table of at most 16 MB without false negatives; where it
is saturated more is sent, and nothing is lost.

Collisions are verified against the text: fingerprints of frequent groups
whose check values differ are looked up in the texts again and counted phrase
by phrase. All others are frequent phrases; only these are read, each from
the one document that its pointer names. Parts of phrases are fingerprints of
their own, so their counts are joined, and the rest is SQL.

No group is collected, counts are combined in the task before they move, and a task
holds a slice of texts: long texts are hashed in parts that overlap by four
words (only a word of many MB is held whole).

Defined results: null text is empty; null lang counts as ``und``, together
with a lang of that name; doc_id is not read; repeated rows count as often as
they occur; an empty table gives no rows; other columns are not read. Ties
are broken by score, then a, then the phrase's bytes, so ranks are unique.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .bits import bit_table, passes
from .common import staged
from .fingerprints import Slicer, Words

MIN_COUNT = 100
LONGEST = 5
TOP = 2000
SUBSUMED_PERCENT = 100
SPACES, BREAKS = b"\x20\x09", b".,;:!?\x0A\x0B\x0C\x0D"
WORDS = r"[^\x20\x09.,;:!?\x0A-\x0D]+"
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_FLUSH = 1 << 20  # n-grams that a task aggregates at a time
_ROWS = 1024  # texts that a task decodes at a time
_POINTER_BITS, _BUCKET_BITS = 32, 40

_COUNTS = "fp long, tag long, n long"  # tag: check value and pointer, 32 bits each
_FOUND = "fp long, check int, words int, n long, lang string, phrase string, cuts array<struct<k:int,lf:long,lc:int,rf:long,rc:int>>"


def prepared(docs: DataFrame) -> DataFrame:
    """lang, text, seeds of the language, and the document's pointer."""
    lang, text = F.coalesce(F.col("lang"), F.lit("und")), F.coalesce(F.col("text"), F.lit(""))
    return docs.select(lang.alias("lang"), text.alias("text")).select(
        "lang", "text", F.xxhash64("lang").alias("seed"), F.xxhash64("lang", F.lit(1)).alias("seed2"),
        F.shiftrightunsigned(F.xxhash64("text", "lang"), 64 - _POINTER_BITS).alias("doc"))


def _texts(batch: pa.RecordBatch) -> list[bytes]:
    return [t.translate(_LOWER) for t in batch.column("text").cast(pa.binary()).to_pylist()]


def _numbers(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).to_numpy().view(np.uint64)


def _seeds(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    return _numbers(batch, "seed"), _numbers(batch, "seed2")


def _bucket(fp: np.ndarray, bits: int) -> np.ndarray:
    """The leading bits of fingerprints."""
    return (fp << np.uint64(64 - bits)) >> np.uint64(64 - _BUCKET_BITS)


def _runs(*keys: np.ndarray) -> np.ndarray:
    """Starts of the runs of equal rows (of one or more sorted arrays)."""
    differ = np.ones(len(keys[0]), bool)
    differ[1:] = False
    for k in keys:
        differ[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(differ)


def _slices(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[tuple[Words, tuple, np.ndarray]]:
    slicer = Slicer(SPACES, BREAKS, n - 1)
    for whole in batches:
        for at in range(0, len(whole), _ROWS):
            batch = whole.slice(at, _ROWS)
            seeds, pointer = _seeds(batch), _numbers(batch, "doc")
            for words in slicer(_texts(batch)):
                yield words, seeds, pointer


def _flushed(found: Iterator[tuple[np.ndarray, ...]], row) -> Iterator[pa.RecordBatch]:
    """Some million n-grams at a time, aggregated by ``row``."""
    parts, held = [], 0
    for arrays in found:
        parts.append(arrays)
        held += len(arrays[0])
        if held >= _FLUSH:
            yield row(*(np.concatenate(p) for p in zip(*parts)))
            parts, held = [], 0
    if held:
        yield row(*(np.concatenate(p) for p in zip(*parts)))


def _count(n: int, bits: int, shorter):
    """Counts the n-grams of which both (n-1)-grams pass ``shorter``."""
    def row(fp: np.ndarray, tag: np.ndarray) -> pa.RecordBatch:
        order = np.argsort(fp)
        fp, tag = fp[order], tag[order]
        first = _runs(fp, tag >> np.uint64(_POINTER_BITS))
        size = np.diff(np.append(first, len(fp)))
        arrays = [fp[first].view(np.int64), np.minimum.reduceat(tag, first).view(np.int64), size.astype(np.int64)]
        return pa.RecordBatch.from_arrays([pa.array(a) for a in arrays], names=["fp", "tag", "n"])

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
        for words, seeds, pointer in _slices(batches, n):
            ok = words.whole(n)
            if shorter is not None and len(ok):
                may = passes(shorter.value, _bucket(words.grams(n - 1, seeds, bits)[0], bits))
                ok &= may[:-1] & may[1:]
            fp, check = words.grams(n, seeds, bits)
            at = np.flatnonzero(ok)
            tag = check[at] << np.uint64(_POINTER_BITS)
            yield fp[at], tag | pointer[words.doc[at]] if n > 1 else tag  # single words are never read

    return lambda batches: _flushed(found(batches), row)


def _describe(words: Words, n: int, at: np.ndarray, counts: np.ndarray, seeds, bits: int, langs: list[str]) -> Iterator[tuple]:
    """Rows of ``_FOUND`` for the n-grams at the given positions."""
    made = {m: words.grams(m, seeds, bits) for m in range(1, n + 1)}

    def key(m: int, i: int) -> tuple[int, int]:
        fp, check = made[m]
        return int(fp[i].view(np.int64)), int(check[i].astype(np.uint32).view(np.int32))

    for i, count in zip(at.tolist(), counts.tolist()):
        cuts = [(k, *key(k, i), *key(n - k, i + k)) for k in range(1, n)]
        yield (*key(n, i), n, count, langs[int(words.doc[i])], words.text(i, n), cuts)


def _found(rows: list[tuple]) -> pa.RecordBatch:
    cut = pa.struct([("k", pa.int32()), ("lf", pa.int64()), ("lc", pa.int32()), ("rf", pa.int64()), ("rc", pa.int32())])
    types = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.string(), pa.string(), pa.list_(cut)]
    columns = list(zip(*rows))
    columns[6] = [[dict(zip(("k", "lf", "lc", "rf", "rc"), c)) for c in cuts] for cuts in columns[6]]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)],
                                      names=["fp", "check", "words", "n", "lang", "phrase", "cuts"])


def _occurrences(n: int, bits: int, table):
    """A pass that writes out every n-gram whose fingerprint passes ``table``, counted by slice."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slicer = Slicer(SPACES, BREAKS, n - 1)
        for batch in batches:
            seeds, langs = _seeds(batch), batch.column("lang").to_pylist()
            for words in slicer(_texts(batch)):
                fp, check = words.grams(n, seeds, bits)
                at = np.flatnonzero(words.whole(n) & passes(table.value, _bucket(fp, bits)))
                if len(at):
                    groups: dict[tuple, list[int]] = {}
                    for i in at.tolist():
                        groups.setdefault((langs[int(words.doc[i])], words.text(i, n)), []).append(i)
                    first = np.array([g[0] for g in groups.values()])
                    sizes = np.array([len(g) for g in groups.values()])
                    yield _found(list(_describe(words, n, first, sizes, seeds, bits, langs)))
    return run


def _pointed(table):
    """Keeps the documents whose pointer passes ``table``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = passes(table.value, _numbers(batch, "doc"))
            if keep.any():
                yield batch.filter(pa.array(keep))
    return run


def _locate(longest: int, bits: int):
    """Reads the phrases that each document is to show (lists of fingerprints by length)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seeds, langs = _seeds(batch), batch.column("lang").to_pylist()
            texts, wanted = _texts(batch), batch.column("wanted").to_pylist()
            for n in range(2, longest + 1):
                asked = [np.array(sorted({w["fp"] for w in ws if w["words"] == n}), np.int64).view(np.uint64) for ws in wanted]
                mine = [i for i, a in enumerate(asked) if len(a)]
                slicer, done = Slicer(SPACES, BREAKS, n - 1), set()
                for i in mine:
                    own = tuple(s[i:i + 1] for s in seeds)
                    for words in slicer([texts[i]]):
                        fp, _ = words.grams(n, own, bits)
                        hit = np.flatnonzero(words.whole(n) & np.isin(fp, asked[i]))
                        values, first = np.unique(fp[hit], return_index=True)
                        new = [int(hit[f]) for v, f in zip(values.tolist(), first) if (i, v) not in done]
                        done.update((i, v) for v in values.tolist())
                        if new:
                            yield _found(list(_describe(words, n, np.array(new), np.zeros(len(new), np.int64), own, bits, [langs[i]])))
    return run


def frequent_phrases(docs: DataFrame, min_count: int = MIN_COUNT, longest: int = LONGEST, bits: int = 64) -> tuple[DataFrame, DataFrame]:
    """(known, phrases): fp, check, a of every frequent n-gram, single words
    included; and fp, check, a, words, lang, phrase, cuts of those of two or more words.

    ``bits`` is the width of the fingerprints (less only to try collisions).
    """
    spark, source = docs.sparkSession, prepared(docs)
    clean_key = (F.col("low") == F.col("high"))
    marks, known, alone, written = None, [], [], []
    for n in range(1, longest + 1):
        # The tasks have combined their rows; dealt as they are, they are narrower than partial aggregates.
        check = [f(F.shiftright("tag", _POINTER_BITS).cast("int")).alias(c) for f, c in ((F.min, "low"), (F.max, "high"))]
        counted = source.mapInArrow(_count(n, bits, marks), _COUNTS).repartition("fp").groupBy("fp").agg(
            F.sum("n").alias("a"), *check, F.min(F.col("tag").bitwiseAND((1 << _POINTER_BITS) - 1)).alias("doc"))
        level = staged(counted.filter(F.col("a") >= min_count).withColumn("words", F.lit(n)), f"phrases-{n}")
        if marks is not None:
            marks.unpersist()
        seen = level.agg(F.count(F.lit(1)).alias("all"), F.count_if(~clean_key).alias("shared")).first()
        if not seen["all"]:
            break
        bucket = F.shiftrightunsigned(F.shiftleft("fp", 64 - bits), 64 - _BUCKET_BITS).alias("bucket")
        if n < longest:
            marks = spark.sparkContext.broadcast(bit_table(level.select(bucket), "bucket", _BUCKET_BITS, seen["all"]))
        clean = level.filter(clean_key).select("fp", F.col("low").alias("check"), "a", "words", "doc")
        known.append(clean.select("fp", "check", "a"))
        if n > 1:
            alone.append(clean)
        if seen["shared"]:
            # Collisions: every occurrence is read and counted by its text.
            shared = level.filter(~clean_key).select("fp")
            collided = spark.sparkContext.broadcast(bit_table(shared.select(bucket), "bucket", _BUCKET_BITS, seen["shared"]))
            read = source.mapInArrow(_occurrences(n, bits, collided), _FOUND).join(shared, "fp", "left_semi")
            by_text = read.groupBy("fp", "check", "words", "lang", "phrase", "cuts").agg(F.sum("n").alias("a")).filter(F.col("a") >= min_count)
            by_text = staged(by_text, f"phrases-{n}-by-text")
            known.append(by_text.select("fp", "check", "a"))
            if n > 1:
                written.append(by_text.select("fp", "check", "a", "words", "lang", "phrase", "cuts"))
    none = spark.createDataFrame([], "fp long, check int, a long, words int, doc long")
    known = reduce(DataFrame.unionByName, known) if known else none.select("fp", "check", "a")
    pointed = reduce(DataFrame.unionByName, alone) if alone else none
    phrases = _materialised(source, pointed, longest, bits)
    return known, reduce(DataFrame.unionByName, [phrases, *written])


def _materialised(source: DataFrame, pointed: DataFrame, longest: int, bits: int) -> DataFrame:
    """The text of each phrase, read from the document its pointer names."""
    spark = source.sparkSession
    asked = pointed.groupBy("doc").agg(F.collect_list(F.struct("words", "fp")).alias("wanted"))
    asked = staged(asked, "phrase-pointers")  # a document's list is no longer than its text
    marks = spark.sparkContext.broadcast(bit_table(asked, "doc", _POINTER_BITS, asked.count()))
    # Copies collapse before the join: a text is read once.
    texts = source.mapInArrow(_pointed(marks), source.schema).withColumn("other", F.xxhash64("text", F.lit(2)))
    texts = texts.dropDuplicates(["doc", "other", "lang"]).drop("other")
    found = texts.join(asked, "doc").select("lang", "text", "seed", "seed2", "wanted").mapInArrow(_locate(longest, bits), _FOUND)
    counts = pointed.select("fp", "check", "a")
    return found.drop("n").join(counts, ["fp", "check"]).dropDuplicates(["fp", "check"]) \
        .select("fp", "check", "a", "words", "lang", "phrase", "cuts")


def exact_score() -> Column:
    """floor(1000 * a * n / (l * r)) in decimals of 38 digits."""
    return F.expr("""(CAST(1000 AS decimal(4,0)) * CAST(a AS decimal(16,0)) * CAST(n AS decimal(17,0)))
                     div (CAST(l AS decimal(18,0)) * CAST(r AS decimal(18,0)))""").cast("long")


def collocations(docs: DataFrame, min_count: int = MIN_COUNT, longest: int = LONGEST, top: int = TOP,
                 subsumed_percent: int = SUBSUMED_PERCENT, bits: int = 64) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the best phrases of each language."""
    known, phrases = frequent_phrases(docs, min_count, longest, bits)
    phrases = staged(phrases, "phrases")
    totals = docs.select(F.coalesce(F.col("lang"), F.lit("und")).alias("lang"),
                         F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORDS)).alias("size")) \
        .groupBy("lang").agg(F.sum("size").cast("long").alias("n"))
    # A longer phrase with (nearly) all occurrences swallows its two halves
    # one word shorter; counts fall with length, so these two cases suffice.
    ends = F.array(F.struct(F.element_at("cuts", -1)["lf"].alias("fp"), F.element_at("cuts", -1)["lc"].alias("check")),
                   F.struct(F.element_at("cuts", 1)["rf"].alias("fp"), F.element_at("cuts", 1)["rc"].alias("check")))
    longer = phrases.filter(F.col("words") > 2).select(F.explode(ends).alias("e"), "a").groupBy("e.fp", "e.check") \
        .agg(F.max("a").alias("longer"))
    left = phrases.join(longer, ["fp", "check"], "left").filter(
        F.col("longer").isNull() | (F.col("longer") * 100 < F.col("a") * subsumed_percent))
    halves = left.select("lang", "phrase", "a", F.explode("cuts").alias("c")).select(
        "lang", "phrase", "a", "c.*")
    part = known.select(F.col("fp"), F.col("check"), F.col("a"))
    halves = halves.join(part.withColumnsRenamed({"fp": "lf", "check": "lc", "a": "l"}), ["lf", "lc"]) \
        .join(part.withColumnsRenamed({"fp": "rf", "check": "rc", "a": "r"}), ["rf", "rc"]).join(totals, "lang")
    scored = halves.withColumn("score", exact_score())
    best = scored.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("s"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    ranked = best.select("lang", "phrase", "a", "s.l", "s.r", "n", "s.score").withColumn("rank", F.row_number().over(order))
    return ranked.filter(F.col("rank") <= top).select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


COLLOCATIONS_SQL = r"""
WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
lists AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM lists GROUP BY lang),
counts AS (SELECT lang, m, array_to_string(w[i:i + m - 1], ' ') AS phrase, count(*) AS f
  FROM lists, range(1, 6) s(m), range(1, len(w) - m + 2) t(i) GROUP BY ALL),
cand AS (SELECT * FROM counts WHERE m >= 2 AND f >= 100),
words AS (SELECT lang, m, phrase, f, string_split(phrase, ' ') AS w FROM cand),
inner_parts AS (SELECT DISTINCT lang, f AS longer, array_to_string(w[i:i + k - 1], ' ') AS phrase
  FROM words, range(2, 5) s(k), range(1, m - k + 2) t(i) WHERE k < m),
left_over AS (SELECT * FROM words WHERE NOT EXISTS (SELECT 1 FROM inner_parts p
  WHERE p.lang = words.lang AND p.phrase = words.phrase AND 100 * p.longer >= 100 * words.f)),
cuts AS (SELECT o.lang, o.phrase, o.f AS a, k, x.f AS l, y.f AS r, n,
  CAST(1000::HUGEINT * o.f * n // (x.f::HUGEINT * y.f) AS BIGINT) AS score
  FROM left_over o, range(1, 5) s(k), counts x, counts y, totals t WHERE k < o.m AND t.lang = o.lang
  AND x.lang = o.lang AND x.phrase = array_to_string(w[1:k], ' ') AND y.lang = o.lang AND y.phrase = array_to_string(w[k + 1:o.m], ' ')),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM best QUALIFY rank <= 2000
"""
