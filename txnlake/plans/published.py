"""Views that stay, under their own names in catalog schemas.

``publish_views`` writes the views of a warehouse as one version of a folder
(a marker file, written last, makes it valid); ``attach_views`` creates the
schemas and one external table per view, so that plain SQL such as ``SELECT *
FROM customer.rfm_segments`` works, in a persistent catalog for every later
session, otherwise after one call that only touches metadata. The ranked views
are computed once per refresh instead of once per query.

A table of the same name that was not attached from the same folder is never
replaced. The version before the newest stays for readers that are still
running; older ones go.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession

from ..session import drop_path, shuffles_dropped
from . import catalog
from . import snapshots as V
from .warehouse import Warehouse

COMPLETE = "_complete"
KEPT = 2


def _versions(spark: SparkSession, path: str) -> list[int]:
    return sorted(int(n[1:]) for n in V._names(spark, path) if n.startswith("v") and n[1:].isdigit())


def _folder(path: str, version: int) -> str:
    return f"{path}/v{version:012d}"


def newest(spark: SparkSession, path: str) -> int | None:
    """The newest version that was written to the end."""
    done = [v for v in _versions(spark, path) if COMPLETE in V._names(spark, _folder(path, v))]
    return done[-1] if done else None


def publish_views(wh: Warehouse, path: str, only: list[str] | None = None, parallel: int = 4) -> int:
    """Write the views as the next version below ``path``; its number. A view
    that fails fails the version: readers stay on the one before."""
    spark = wh.fact_sales.sparkSession
    path = path.rstrip("/")
    version = max(_versions(spark, path), default=0) + 1
    folder = _folder(path, version)
    chosen = [v for v in catalog.VIEWS if not only or v.vid in only]

    def write(v: catalog.View) -> str:
        v.fn(wh).write.parquet(f"{folder}/{v.namespace}/{v.name}")
        return f"{v.namespace}.{v.name}"

    with shuffles_dropped(spark), ThreadPoolExecutor(max_workers=parallel) as pool:
        names = list(pool.map(write, chosen))
    V._write_text(spark, f"{folder}/{COMPLETE}", "\n".join(names))
    done = [v for v in _versions(spark, path) if COMPLETE in V._names(spark, _folder(path, v))]
    for old in done[:-KEPT]:
        drop_path(spark, _folder(path, old))
    return version


def _location(spark: SparkSession, table: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").filter("col_name = 'Location'").collect()
    return rows[0]["data_type"] if rows else ""


def attach_table(spark: SparkSession, namespace: str, name: str, location: str, root: str) -> None:
    """An external table over ``location``; only tables below ``root`` are replaced."""
    where = V._fs(spark, root)
    root_uri = where[0].makeQualified(where[1]).toString()
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{namespace}` LOCATION '{root}/_schemas/{namespace}'")
    table = f"`{namespace}`.`{name}`"
    if spark.catalog.tableExists(f"{namespace}.{name}"):
        if not _location(spark, table).startswith(root_uri + "/"):
            raise ValueError(f"{namespace}.{name} exists and is not a published view of {root}")
        spark.sql(f"DROP TABLE {table}")  # external: its files stay
    spark.catalog.createTable(f"{namespace}.{name}", path=location, source="parquet")


def attach_views(spark: SparkSession, path: str) -> list[str]:
    """Schemas and tables of the newest complete version; their names. Runs no job on the views' rows."""
    path = path.rstrip("/")
    version = newest(spark, path)
    if version is None:
        raise FileNotFoundError(f"no published views in {path}")
    folder = _folder(path, version)
    names = V._read_text(spark, f"{folder}/{COMPLETE}").split("\n")
    for full in filter(None, names):
        namespace, name = full.split(".")
        attach_table(spark, namespace, name, f"{folder}/{namespace}/{name}", path)
    return names
