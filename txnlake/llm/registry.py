"""The queries of this subpackage and their DuckDB statements."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import align, decontaminate, exact_dedup, jaccard_join, language_id, line_dedup, lm_score, mixing, phrases, quality, sketches, toxicity, url_filter
from .common import table

URL_RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
             ("com", "/fr/", "allow"), ("com", "/de/", "block")]


def _op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_filter.url_filter(table(spark, sf_dir, "pages"), rules)


def _op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.language_id(table(spark, sf_dir, "documents"))


def _op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_join(table(spark, sf_dir, "documents"))


def _op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.lm_score(table(spark, sf_dir, "documents"))


def _op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    categories = {"low_quality": "1 - quality", "toxic": "toxic"}
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), categories)


def _op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.decontamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def _op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"))


def _op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_plan(table(spark, sf_dir, "documents"))


def _op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_dedup(table(spark, sf_dir, "documents"))


def _op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


def _op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sketches.fingerprints(table(spark, sf_dir, "documents"))


def _op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.alignment(table(spark, sf_dir, "documents"))


def _op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


URL_SQL = r"""
WITH rest AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r FROM pages),
parts AS (SELECT page_id, translate(regexp_extract(r, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
rules(rule_host, rule_path, verdict) AS (VALUES """ + ", ".join(str(r) for r in URL_RULES) + r"""),
fits AS (SELECT host, path, rule_host || rule_path AS rule, verdict FROM (SELECT DISTINCT host, path FROM parts), rules
  WHERE starts_with(path, rule_path) AND (host = rule_host OR ends_with(host, '.' || rule_host))),
best AS (SELECT host, path, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict FROM fits GROUP BY host, path)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM parts LEFT JOIN best USING (host, path)
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_url_filter": _op1,
        "op2_language_id": _op2,
        "op3_jaccard_join": _op3,
        "op4_lm_score": _op4,
        "op5_toxicity": _op5,
        "op6_decontamination": _op6,
        "op7_quality": _op7,
        "op8_mixing": _op8,
        "op9_line_dedup": _op9,
        "op10_exact_dedup": _op10,
        "op11_fingerprints": _op11,
        "op12_alignment": _op12,
        "op13_phrases": _op13,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_url_filter": URL_SQL,
        "op3_jaccard_join": jaccard_join.JOIN_SQL,
        "op6_decontamination": decontaminate.DECONTAMINATION_SQL,
        "op8_mixing": mixing.MIX_SQL,
        "op9_line_dedup": line_dedup.LINE_DEDUP_SQL,
        "op10_exact_dedup": exact_dedup.DEDUP_SQL,
        "op11_fingerprints": sketches.FINGERPRINTS_SQL,
        "op13_phrases": phrases.COLLOCATIONS_SQL,
    }
