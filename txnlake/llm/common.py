"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
TOKEN = r"[^\x20\x09-\x0D]+"  # a word: no ASCII white space
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"  # letters, digits and everything beyond ASCII


def ascii_lower(c: Column) -> Column:
    """A-Z lower-cased, every other character as it is."""
    return F.translate(c, UPPER, LOWER)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write ``df`` to a fresh table in the shared folder and read it back:
    it is computed once, its lineage is cut, and a lost executor only costs
    the tasks that read it. ``options`` are the writer's."""
    path = scratch_path(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_staged(df: DataFrame) -> None:
    """Delete the files of a ``staged`` table that nothing reads any more."""
    spark = df.sparkSession
    hadoop = spark._jvm.org.apache.hadoop.fs
    for parent in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = hadoop.Path(parent)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def remainder(doc_id: Column, m: int) -> Column:
    """crc32 of the id's text modulo ``m``; null for a null id."""
    return F.crc32(doc_id.cast("string")) % m


def uniform(seed: str, *parts: Column) -> Column:
    """A number in [0, 1) drawn from a hash of ``seed`` and ``parts`` (null as 'null')."""
    text = F.concat_ws(":", F.lit(seed), *[F.coalesce(p.cast("string"), F.lit("null")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long").cast("double") / F.lit(float(1 << 52))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
