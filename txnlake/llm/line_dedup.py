"""Operator 9, line de-duplication by distinct-site spread (DataFrame operations only).

A line (trimmed of blanks, never empty) that occurs on at least
``min_sites`` distinct sources is boilerplate. Its spread is estimated by a
HyperLogLog sketch per line hash, merged by the aggregation; lines whose
estimate lies near the threshold get an exact distinct count. A boilerplate
line stays in the document with the smallest doc_id that holds it and is cut
from all others, so no text is lost altogether.

All grouping is by the line's 128-bit hash or by document, with partial
aggregates, so a line in a third of all documents is combined before the
shuffle. A document is put together again without regrouping its lines: only
documents that may have cuts (by a bitmap of bounded size) are shuffled, to
meet the positions to cut; all others stay in the task that read them.

Defined results: a null text has no lines and stays null; a null source is a
site of its own; null ids never keep a boilerplate line unless all are null;
a line repeated within the keeping document stays there; repeated rows are
treated alike; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import staged

MIN_SITES = 5
SKETCH_BITS = 12  # 4096 registers: relative standard error 1.6 %
MARK_BITS = 27  # at most, 16 MB: beyond some ten million documents with cuts, more of the others are shuffled too
MARGIN = 0.05  # three standard errors; at least one site
BLANKS = " \t\r\x0b\x0c"


def _lines(docs: DataFrame) -> DataFrame:
    """One row per non-blank line: doc_id, body (a hash of the text), site, pos, line."""
    each = docs.select("doc_id", F.xxhash64("text").alias("body"),
                       F.coalesce(F.concat(F.lit("s:"), "source"), F.lit("null")).alias("site"),
                       F.posexplode(F.split("text", "\n")).alias("pos", "raw"))
    line = F.btrim("raw", F.lit(BLANKS))
    return (each.select("doc_id", "body", "site", "pos", line.alias("line")).filter("line <> ''")
            .select("doc_id", "body", "site", "pos", F.unhex(F.md5("line")).alias("line")))


def boilerplate(docs: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """line, keeper: hashes of the boilerplate lines and the doc_id that keeps each."""
    lines = _lines(docs)
    near = max(1.0, MARGIN * min_sites)
    spread = lines.groupBy("line").agg(F.hll_sketch_agg("site", F.lit(SKETCH_BITS)).alias("sketch"),
                                       F.min("doc_id").alias("keeper"))
    likely = staged(spread.select("line", "keeper", F.hll_sketch_estimate("sketch").alias("sites"))
                    .filter(F.col("sites") >= min_sites - near), "likely-boilerplate")
    unsure = likely.filter(F.col("sites") <= min_sites + near)
    exact = (lines.join(unsure.select("line"), "line", "left_semi")
             .groupBy("line").agg(F.count_distinct("site").alias("sites"))
             .filter(F.col("sites") >= min_sites).select("line"))
    sure = likely.filter(F.col("sites") > min_sites + near).select("line", "keeper")
    return sure.unionByName(unsure.join(exact, "line", "left_semi").select("line", "keeper"))


def cuts(docs: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """doc_id, body, cut: positions of the lines to cut, of documents that have any."""
    known = staged(boilerplate(docs, min_sites), "boilerplate")
    return (_lines(docs).join(known, "line").filter(~F.col("doc_id").eqNullSafe(F.col("keeper")))
            .groupBy("doc_id", "body").agg(F.collect_set("pos").alias("cut")))


def _kept_text(lines: Column, cut: Column) -> Column:
    places = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), cut)
    return F.array_join(F.transform(places, lambda p: F.get(lines, p)), "\n")


def _with_cuts(docs: DataFrame, min_sites: int) -> DataFrame:
    """All columns of ``docs`` as struct ``row``, and ``lines`` and ``cut``, null where nothing is cut."""
    own = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                      F.xxhash64("text").alias("body"))
    found = staged(cuts(docs, min_sites), "line-cuts").select(F.col("doc_id").alias("id"), F.col("body").alias("of"), "cut")
    marked = _marked(own, found)
    touched = marked.filter("may").select("row", "body")
    cut = touched.join(found, F.col("row.doc_id").eqNullSafe(F.col("id")) & (F.col("body") == F.col("of")), "left")
    # Documents without a mark stay where they were read.
    joined = cut.select("row", "cut").unionByName(marked.filter("not may").select("row", F.lit(None).cast("array<int>").alias("cut")))
    return joined.select("row", "cut", F.when(F.col("cut").isNotNull(), F.split("row.text", "\n")).alias("lines"))


def _marked(own: DataFrame, found: DataFrame) -> DataFrame:
    """``own`` and ``may``: false only for documents that are not in ``found``. The
    marks are bitmaps of 4 KB, at most ``2 ** MARK_BITS`` bits together, whatever the input."""
    bits = max(15, min(MARK_BITS, (64 * max(found.count(), 1)).bit_length()))

    def place(doc_id: str, body: str) -> Column:
        return F.shiftrightunsigned(F.xxhash64(doc_id, body), 64 - bits) + 1
    marks = (found.select(place("id", "of").alias("place")).groupBy(F.bitmap_bucket_number("place").alias("bucket"))
             .agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bitmap")))
    at = own.select("*", place("row.doc_id", "body").alias("place"))
    at = at.select("row", "body", F.bitmap_bucket_number("place").alias("bucket"),
                   F.bitmap_bit_position("place").cast("int").alias("bit"))
    byte = "cast(conv(hex(substring(bitmap, bit div 8 + 1, 1)), 16, 10) as int)"
    may = F.expr(f"coalesce(shiftright({byte}, bit % 8) & 1, 0) = 1")
    return at.join(F.broadcast(marks), "bucket", "left").select("row", "body", may.alias("may"))


def _cleaned(docs: DataFrame, min_sites: int) -> DataFrame:
    text = F.when(F.col("cut").isNull(), F.col("row.text")).otherwise(_kept_text(F.col("lines"), F.col("cut")))
    return _with_cuts(docs, min_sites).select("row", "cut", text.alias("kept_text"))


def _emptied() -> Column:
    return F.coalesce(F.col("cut").isNotNull() & (F.regexp_replace("kept_text", r"[ \t\r\x0b\x0c\n]", "") == ""), F.lit(False))


def line_dedup(docs: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """doc_id, n_lines, n_cut, emptied, text_sha256 (of the text that stays; null for null)."""
    return _cleaned(docs, min_sites).select(
        "row.doc_id", F.coalesce(F.size(F.split("row.text", "\n")), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.size("cut"), F.lit(0)).cast("long").alias("n_cut"),
        _emptied().alias("emptied"), F.sha2("kept_text", 256).alias("text_sha256"))


def without_boilerplate(docs: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """The documents with boilerplate cut, all columns kept; n_chars, if there
    is one, follows the text. A document of nothing but boilerplate kept
    elsewhere goes."""
    clean = _cleaned(docs, min_sites).filter(~_emptied())
    new = {"text": F.col("kept_text"),
           "n_chars": F.when(F.col("cut").isNull(), F.col("row.n_chars")).otherwise(F.length("kept_text"))
           if "n_chars" in docs.columns else None}
    return clean.select(*[(new[c] if c in new else F.col("row").getField(c)).cast(docs.schema[c].dataType).alias(c)
                          for c in docs.columns])


LINES_CTES = r"""
lines AS (SELECT r, doc_id, site, pos, trim(raw, ' ' || chr(9) || chr(13) || chr(11) || chr(12)) AS line, raw FROM
  (SELECT r, doc_id, coalesce('s:' || source, 'null') AS site, unnest(string_split(text, chr(10))) AS raw,
    unnest(range(len(string_split(text, chr(10))))) AS pos FROM numbered)),
spread AS (SELECT line, min(doc_id) AS keeper FROM lines WHERE line <> '' GROUP BY line HAVING count(DISTINCT site) >= 5),
marked AS (SELECT lines.*, spread.line IS NOT NULL AND doc_id IS DISTINCT FROM keeper AS is_cut FROM lines LEFT JOIN spread ON lines.line = spread.line),
rebuilt AS (SELECT r, count(*) AS n_lines, count(*) FILTER (is_cut) AS n_cut, coalesce(string_agg(raw, chr(10) ORDER BY pos) FILTER (NOT is_cut), '') AS kept_text,
  count(*) FILTER (NOT is_cut AND line <> '') AS n_left FROM marked GROUP BY r)
"""

LINE_DEDUP_SQL = "WITH numbered AS (SELECT row_number() OVER () AS r, * FROM documents)," + LINES_CTES + """
SELECT doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_cut, 0) AS n_cut, coalesce(n_cut > 0 AND n_left = 0, false) AS emptied,
  sha256(kept_text) AS text_sha256 FROM numbered LEFT JOIN rebuilt USING (r)
"""
