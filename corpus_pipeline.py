"""A training-corpus pipeline of five stages over the table ``documents``.

Each stage works on all that its predecessor kept. ``run`` writes every
stage's result to the shared folder and reads it back as the next one's
input, so a lost executor costs at most one stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from txnlake.llm import decontaminate, jaccard_join, language_id, line_dedup, mixing
from txnlake.llm.common import drop_staged, staged, table


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: documents without a recognisable language go."""
    return language_id.recognised(docs)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: boilerplate lines are cut; documents of nothing else go."""
    return line_dedup.without_boilerplate(docs)


def join_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: of each group of near copies the least doc_id stays."""
    return jaccard_join.without_near_copies(docs)


def decontaminate_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: documents in which a benchmark window occurs go."""
    return decontaminate.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: documents as often as their source's target asks for."""
    return mixing.mix(docs)


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", dedup_lines),
    ("jaccard_join", join_near_copies),
    ("decontamination", decontaminate_benchmark),
    ("mixing", mix_sources),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, last = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
        if last is not None:
            drop_staged(last)
        last = docs
    return docs


ORACLE_SQL = "WITH RECURSIVE spoken AS (SELECT * FROM documents WHERE regexp_matches(text, '\\p{L}'))," + \
    line_dedup.LINES_CTES.replace("numbered", "spoken_rows").join([
        "spoken_rows AS (SELECT row_number() OVER () AS r, * FROM spoken),", ""]) + """,
cleaned AS (SELECT doc_id, CASE WHEN n_cut > 0 THEN kept_text ELSE text END AS text, lang, source,
  CASE WHEN n_cut > 0 THEN length(kept_text) ELSE n_chars END AS n_chars
  FROM spoken_rows JOIN rebuilt USING (r) WHERE NOT (n_cut > 0 AND n_left = 0)),
numbered AS (SELECT row_number() OVER () AS r, * FROM cleaned),""" + jaccard_join.CLASSES_CTES + """,
apart AS (SELECT numbered.* FROM numbered JOIN class_of USING (r) WHERE keeper = r),""" + \
    decontaminate.FOUND_CTES.replace("numbered", "apart") + """,
clean AS (SELECT * FROM apart WHERE r NOT IN (SELECT r FROM found)),
sized AS (SELECT *, CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size FROM clean),""" + \
    mixing.TARGETS_SQL + f""",
drawn AS (SELECT sized.*, CAST(floor(rate) + CASE WHEN {mixing.UNIFORM_SQL} < rate - floor(rate) THEN 1 ELSE 0 END AS INTEGER) AS copies
  FROM sized JOIN rated ON sized.source IS NOT DISTINCT FROM rated.source)
SELECT doc_id, text, lang, source, n_chars FROM drawn, range(copies) t(i)
"""
