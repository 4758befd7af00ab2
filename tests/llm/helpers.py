"""Documents that try the corner cases, shared by the tests of this folder."""

from __future__ import annotations

import random

from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType())])
#: Columns that operators use inside under the same names.
CLASHING = ["row", "size", "site", "line", "kept", "n", "block", "body", "cut", "keeper", "items", "rate", "target",
            "labels", "fold", "score", "words", "key", "pair", "rep", "sid", "digest", "fp", "copies", "n_hit", "lang_pred"]


def prose(rng: random.Random, n: int, vocabulary: int = 400) -> str:
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def documents(spark, rows, clash=False):
    """rows: (doc_id, text[, source[, lang]])."""
    full = [(r[0], r[1], r[3] if len(r) > 3 else "en", r[2] if len(r) > 2 else "a",
             len(r[1]) if r[1] is not None else None) for r in rows]
    df = spark.createDataFrame(full, DOCS)
    if clash:
        from pyspark.sql import functions as F

        for c in CLASHING:
            df = df.withColumn(c, F.lit("x"))
    return df


def corner_rows():
    """Nulls in every column, empty and long texts, ties, repeated rows."""
    rng = random.Random(7)
    long = prose(rng, 30_000, 5_000)
    return [(1, None, "a", "en"), (2, "", "b", "en"), (3, "   \n\t ", None, None), (None, "some words without an id", "a", "fr"),
            (None, "some words without an id", "a", "fr"), (4, "Zwölf Boxkämpfer", "b", "de"), (4, "zwölf boxkämpfer", "b", "de"),
            (5, long, "c", "en"), (6, long + " more", "c", None), (7, "12 34 !!", None, "en"), (8, "tie\nline", "d", "en"),
            (9, "tie\nline", "e", "en"), (9, "tie\nline", "e", "en"), (10, "x" * 100_000, "a", "en")]


def collected(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
