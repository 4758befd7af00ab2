"""Operator 11, document fingerprints: bottom-k sketches (DataFrame functions only).

A shingle is five consecutive words (lower-cased; a text of fewer words is one
shingle), its hash the first 48 bits of its MD5, written as 12 hexadecimal
digits. A sketch is the sorted list of the k least distinct hashes. Sketches
of parts merge into the sketch of the whole (``merge`` for two columns,
``merged_sketches`` for groups), and estimate the number of distinct shingles
(``distinct_shingles``), resemblance and containment; with fewer than k
shingles all three are exact. The standard error of a resemblance J is
sqrt(J (1 - J) / k), at most 4.4 % with k = 128.

``fingerprints`` compares each document with its edited text and its
neighbour. The neighbour in descending order of ids is found without one
global sort: a range partitioning of the small keys gives exact bounds, one
row per range to the driver (a range is some 64 MB of texts, 65,536 ranges at
most); texts are shuffled once, by range, and each range also receives a copy
of the first text of the range after it.

Memory: the shingles of one text (some hundred bytes a word) and a window's
spillable buffer. Defined results: null text is empty; texts without words
have the empty sketch, '' as fingerprint and resemblance 1 with each other;
null ids come last; equal ids follow the MD5 of their texts; repeated rows
(equal id and text) follow each other and are kept in one range; the only row
of a table is its own neighbour; an empty table gives no rows; other columns
are not read.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, ascii_lower, shuffle_partitions, staged

K = 128
WIDTH = 5
DIGITS = 12
RANGE_BYTES = 64 << 20
MOST_RANGES = 1 << 16


def with_sketch(df: DataFrame, text: str, name: str, k: int = K, width: int = WIDTH) -> DataFrame:
    """Adds the sketch of column ``text`` (array of hexadecimal hashes)."""
    words = F.regexp_extract_all(ascii_lower(F.col(text)), F.lit(WORD), F.lit(0))
    # A projection of its own, so that the words are found once, not once per shingle.
    listed = df.withColumn("_words", words)
    w, n = F.col("_words"), F.size("_words")

    def digest(shingle: Column) -> Column:
        return F.substring(F.md5(shingle.cast("binary")), 1, DIGITS)

    each = F.transform(F.sequence(F.lit(0), n - width), lambda i: digest(F.concat_ws(" ", *[F.get(w, i + j) for j in range(width)])))
    hashes = F.when(n >= width, each).when(n > 0, F.array(digest(F.array_join(w, " ")))).otherwise(F.array().cast("array<string>"))
    return listed.withColumn(name, F.slice(F.sort_array(F.array_distinct(hashes)), 1, k)).drop("_words")


def merge(a: Column, b: Column, k: int = K) -> Column:
    """The sketch of the union of two sets of shingles."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def merged_sketches(df: DataFrame, keys: list[str], sketch: str, k: int = K) -> DataFrame:
    """keys, sketch: the sketch of each group's union. Hashes are made distinct
    by a partial aggregate, and every task keeps k of a group before the shuffle."""
    hashes = df.select(*keys, F.explode_outer(sketch).alias("_hash")).distinct()
    least = Window.partitionBy(*keys).orderBy(F.col("_hash").asc_nulls_last())
    kept = hashes.withColumn("_place", F.row_number().over(least)).filter(F.col("_place") <= k)
    return kept.groupBy(*keys).agg(F.sort_array(F.collect_list("_hash")).alias(sketch))


def _share(last: Column) -> Column:
    """A hash as a number in (0, 1]."""
    return (F.conv(last, 16, 10).cast("double") + 1) / F.lit(float(1 << (4 * DIGITS)))


def distinct_shingles(sketch: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles (exact below k)."""
    return F.when(F.size(sketch) < k, F.size(sketch).cast("double")).otherwise(F.lit(float(k - 1)) / _share(F.element_at(sketch, k)))


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated Jaccard similarity: the share of the union's k least hashes that both have."""
    return _resemblance(merge(a, b, k), a, b)


def _resemblance(union: Column, a: Column, b: Column) -> Column:
    both = F.size(F.array_intersect(union, F.array_intersect(a, b)))
    return F.when(F.size(union) == 0, F.lit(1.0)).otherwise(both.cast("double") / F.size(union))


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of a's shingles that b has (1 for an empty a)."""
    common = resemblance(a, b, k) * distinct_shingles(merge(a, b, k), k)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), common / distinct_shingles(a, k)))


def _key(doc_id: Column, text: Column) -> Column:
    """Ascending keys follow descending ids (null last), then the text's digest."""
    number = doc_id.cast("long")
    return F.struct(F.when(number.isNull(), 1).otherwise(0).alias("z"), F.coalesce(F.bitwise_not(number), F.lit(0)).cast("long").alias("d"),
                    F.substring(F.md5(text.cast("binary")), 1, 16).alias("h"))


def _first_keys(docs: DataFrame, range_bytes: int) -> list:
    """The first key of each range of the documents: one row per range."""
    keys = staged(docs.select(_key(F.col("doc_id"), F.col("text")).alias("key"), F.octet_length("text").alias("size")).select("key.*", "size"), "order-keys")
    total = keys.agg(F.sum("size")).first()[0] or 0
    ranges = min(MOST_RANGES, max(shuffle_partitions(docs.sparkSession), -(-total // range_bytes)))
    firsts = keys.repartitionByRange(ranges, "z", "d", "h").groupBy(F.spark_partition_id().alias("p")).agg(F.min(F.struct("z", "d", "h")).alias("key"))
    return sorted(tuple(r.key) for r in firsts.collect())


def _place(key: Column, firsts: list) -> tuple[Column, Column]:
    """(range of a key, whether the key is its range's first), by binary search."""
    text = json.dumps([{"z": z, "d": d, "h": h} for z, d, h in firsts])
    table = F.from_json(F.lit(text), "array<struct<z:int,d:bigint,h:string>>")
    steps = F.array(*[F.lit(1 << b) for b in reversed(range(max(1, len(firsts).bit_length())))])
    found = F.aggregate(steps, F.lit(0), lambda at, step: F.when(F.get(table, at + step - 1) <= key, at + step).otherwise(at))
    return found - 1, F.get(table, F.col("range")) == key


def with_next(docs: DataFrame, columns: list[str], range_bytes: int = RANGE_BYTES) -> DataFrame:
    """doc_id, own (text and ``columns``), next (the same of the next document)."""
    firsts = _first_keys(docs, range_bytes)
    place, is_first = _place(F.col("key"), firsts)
    keyed = docs.select("doc_id", F.struct("text", *columns).alias("own"), _key(F.col("doc_id"), F.col("text")).alias("key")) \
        .withColumn("range", place)
    here = F.struct(F.col("range"), F.lit(False).alias("guard"))
    before = F.struct(F.pmod(F.col("range") - 1, F.lit(max(1, len(firsts)))).alias("range"), F.lit(True).alias("guard"))
    # Outer, so that no filter on the list is derived (it would be computed twice).
    dealt = keyed.select("doc_id", "own", "key", F.explode_outer(F.when(is_first, F.array(here, before)).otherwise(F.array(here))).alias("at"))
    order = Window.partitionBy("range").orderBy("guard", "key")
    return dealt.select("doc_id", "own", "key", "at.*").withColumn("next", F.lead("own").over(order)).filter(~F.col("guard")) \
        .select("doc_id", "own", "next")


def fingerprints(docs: DataFrame, k: int = K, width: int = WIDTH, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next, contained_edited, n_shingles (estimates)."""
    texts = with_sketch(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")), "text", "sketch", k, width)
    paired = with_next(texts, ["sketch"], range_bytes)
    n = F.length("own.text")
    half = F.floor(n / 2).cast("int")
    edited = paired.select("doc_id", n.cast("long").alias("n_chars"), F.col("own.sketch").alias("a"), F.col("next.sketch").alias("c"),
                           F.concat(F.substring("own.text", F.lit(1), n - half), F.substring("next.text", F.lit(1), half)).alias("edited"))
    a, b, c = F.col("a"), F.col("b"), F.col("c")
    both = with_sketch(edited, "edited", "b", k, width) \
        .withColumns({"ab": merge(a, b, k), "ac": merge(a, c, k), "n_shingles": distinct_shingles(a, k)}) \
        .withColumns({"near_edited": _resemblance(F.col("ab"), a, b), "near_next": _resemblance(F.col("ac"), a, c),
                      "n_union": distinct_shingles(F.col("ab"), k)})
    contained = F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), F.col("near_edited") * F.col("n_union") / F.col("n_shingles")))
    return both.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), F.array_join(a, "").alias("fingerprint"),
                       F.array_join(b, "").alias("edited_fingerprint"), "near_edited", "near_next",
                       contained.alias("contained_edited"), "n_shingles")


FINGERPRINTS_SQL = r"""
WITH ordered AS (SELECT doc_id, coalesce(text, '') AS text, row_number() OVER (ORDER BY doc_id DESC NULLS LAST, substr(md5(coalesce(text, '')), 1, 16)) AS r FROM documents),
paired AS (SELECT doc_id, r, text, coalesce(lead(text) OVER (ORDER BY r), first(text) OVER (ORDER BY r)) AS after,
  coalesce(lead(r) OVER (ORDER BY r), 1) AS after_r FROM ordered),
edits AS (SELECT *, substr(text, 1, length(text) - length(text) // 2) || substr(after, 1, length(text) // 2) AS edited FROM paired),
listed AS (SELECT r, kind, regexp_extract_all(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM (SELECT r, 'own' AS kind, text AS t FROM edits UNION ALL SELECT r, 'edited', edited FROM edits)),
sketches AS (SELECT r, kind, list_sort(list_distinct([substr(md5(array_to_string(w[i:i + 4], ' ')), 1, 12) for i in range(1, greatest(len(w) - 4, least(len(w), 1)) + 1)]))[1:128] AS s FROM listed),
joined AS (SELECT e.*, x.s AS a, y.s AS b, z.s AS c FROM edits e JOIN sketches x ON x.r = e.r AND x.kind = 'own'
  JOIN sketches y ON y.r = e.r AND y.kind = 'edited' JOIN sketches z ON z.r = e.after_r AND z.kind = 'own'),
unions AS (SELECT *, list_sort(list_distinct(list_concat(a, b)))[1:128] AS ab, list_sort(list_distinct(list_concat(a, c)))[1:128] AS ac FROM joined),
near AS (SELECT *, CASE WHEN len(ab) = 0 THEN 1.0::DOUBLE ELSE len(list_filter(ab, lambda h: list_contains(a, h) AND list_contains(b, h)))::DOUBLE / len(ab) END AS near_edited,
  CASE WHEN len(ac) = 0 THEN 1.0::DOUBLE ELSE len(list_filter(ac, lambda h: list_contains(a, h) AND list_contains(c, h)))::DOUBLE / len(ac) END AS near_next,
  CASE WHEN len(a) < 128 THEN len(a)::DOUBLE ELSE 127.0::DOUBLE / ((CAST('0x' || a[128] AS BIGINT)::DOUBLE + 1) / 281474976710656.0::DOUBLE) END AS n_shingles,
  CASE WHEN len(ab) < 128 THEN len(ab)::DOUBLE ELSE 127.0::DOUBLE / ((CAST('0x' || ab[128] AS BIGINT)::DOUBLE + 1) / 281474976710656.0::DOUBLE) END AS n_union FROM unions)
SELECT doc_id, length(text) AS n_chars, sha256(edited) AS edited_sha256, array_to_string(a, '') AS fingerprint, array_to_string(b, '') AS edited_fingerprint,
  near_edited, near_next, CASE WHEN len(a) = 0 THEN 1.0::DOUBLE ELSE least(1.0::DOUBLE, near_edited * n_union / n_shingles) END AS contained_edited, n_shingles
FROM near
"""
