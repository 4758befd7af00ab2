"""Operator 1, URL filters.

Every URL is expanded into (host suffix, path prefix) expressions, only of
the label counts and path lengths that some rule has. Expressions and rules
are equi-joined on the first four bytes of their SHA-256, the full digests
are compared, and the longest fitting rule wins.

Distinct (host, path) pairs are judged once and joined back to the rows, so
a host that holds a third of all rows is combined before the shuffle. No row
numbers are needed, so a recomputed task cannot mix up rows.

Defined results: a null URL or one without ``://`` has an empty host and
path; no rule gives a null ``rule`` and the default verdict; repeated rows
are judged alike, one output row each; other columns of the input are not
read; rules with a null or empty host are ignored, a null path counts as
empty, and of equally long fitting rules ``block`` wins, then the greater
rule text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower

PREFIX_HEX = 8  # four bytes
_SEP = "\u0000"


def split_url(url: Column) -> tuple[Column, Column]:
    """(host, path) of a URL."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    host = ascii_lower(F.regexp_extract(rest, r"^([^/?#]*)", 1))
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def _labels(host: Column) -> Column:
    return F.size(F.split(host, r"\.", -1))


def prepare_rules(rules: DataFrame) -> DataFrame:
    """rules(host, path, verdict) -> one row per rule text with its digest."""
    host, path = ascii_lower(F.col("host")), F.coalesce(F.col("path"), F.lit(""))
    keyed = rules.filter(F.length("host") > 0).select(
        F.concat(host, path).alias("rule"), _labels(host).alias("labels"), F.length(path).alias("path_len"),
        F.sha2(F.concat_ws(_SEP, host, path), 256).alias("rule_digest"), "verdict")
    return (keyed.groupBy("rule", "labels", "path_len", "rule_digest")
            .agg(F.max("verdict").alias("verdict"))  # 'block' > 'allow'
            .withColumn("prefix", F.substring("rule_digest", 1, PREFIX_HEX)))


def expressions(host: Column, path: Column, shapes: list[tuple[int, int]]) -> Column:
    """Digests of the suffix/prefix pairs of the given (label count, path length) shapes."""
    n = _labels(host)
    made = [F.when((n >= k) & (F.length(path) >= length),
                   F.sha2(F.concat_ws(_SEP, F.substring_index(host, ".", -k), F.substring(path, 1, length)), 256))
            for k, length in shapes]
    return F.array_compact(F.array(*made))


def url_filter(pages: DataFrame, rules: DataFrame, default: str = "allow",
               key: str = "page_id", url: str = "url") -> DataFrame:
    """key, host, path, rule, verdict of every row of ``pages``."""
    host, path = split_url(F.col(url))
    urls = pages.select(F.col(key).alias("page_id"), host.alias("host"), path.alias("path"))
    known = prepare_rules(rules)
    # One row per distinct shape: bounded by label counts times path lengths.
    shapes = sorted((r.labels, r.path_len) for r in known.select("labels", "path_len").distinct().collect())
    if not shapes:
        return urls.withColumns({"rule": F.lit(None).cast("string"), "verdict": F.lit(default)})
    asked = (urls.select("host", "path").distinct()
             .select("host", "path", F.explode(expressions(F.col("host"), F.col("path"), shapes)).alias("digest"))
             .withColumn("prefix", F.substring("digest", 1, PREFIX_HEX)))
    # Catalyst broadcasts the rules while they are under its size threshold
    # and shuffles both sides on the prefix beyond it.
    fitting = asked.join(known, "prefix").filter(F.col("digest") == F.col("rule_digest"))
    best = (fitting.groupBy("host", "path")
            .agg(F.max(F.struct(F.length("rule").alias("len"), "verdict", "rule")).alias("best"))
            .select("host", "path", F.col("best.rule").alias("rule"), F.col("best.verdict").alias("found")))
    return (urls.join(best, ["host", "path"], "left")
            .select("page_id", "host", "path", "rule", F.coalesce("found", F.lit(default)).alias("verdict")))
