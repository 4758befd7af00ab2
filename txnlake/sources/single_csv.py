"""The ordered CSV parts of one result as one named file.

Spark writes the rows, in order, as parts with a header each. The file system
then joins the parts byte by byte: nothing is parsed again, no row is held, and
the buffer is fixed. What the driver copies is bounded by ``MERGE_LIMIT``; a
larger result keeps its folder of ordered parts, and the caller is told so.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession

from ..session import drop_path

MERGE_LIMIT = 1 << 30  # bytes that are joined by one stream
BUFFER = 1 << 20
_PART = re.compile(r"part-(\d+)")


def _parts(fs, where) -> list:
    """(part number, status) of the data files of a folder, in the order of the rows."""
    found = [(int(m.group(1)), s) for s in fs.listStatus(where) if (m := _PART.match(s.getPath().getName()))]
    return sorted(found, key=lambda p: p[0])


def write_single_csv(df: DataFrame, target: str, merge_limit: int = MERGE_LIMIT) -> bool:
    """Write ``df`` (ordered or not) with a header to the file ``target``,
    replacing a file or folder of that name only when all rows are written.
    False: the result exceeds ``merge_limit`` and ``target`` is a folder."""
    spark: SparkSession = df.sparkSession
    hadoop = spark._jvm.org.apache.hadoop
    folder, _, name = target.rpartition("/")
    work = f"{folder}/.{name}-{uuid.uuid4().hex[:12]}"
    to = hadoop.fs.Path(target)
    fs = to.getFileSystem(spark._jsc.hadoopConfiguration())
    try:
        df.write.option("header", True).csv(f"{work}/parts")
        parts = _parts(fs, hadoop.fs.Path(f"{work}/parts"))
        whole = sum(s.getLen() for _, s in parts) <= merge_limit
        made = hadoop.fs.Path(f"{work}/parts")
        if whole:
            made = hadoop.fs.Path(f"{work}/whole")
            header = len((",".join(df.columns) + "\n").encode())  # view columns are plain names: never quoted
            out = fs.create(made, True)
            try:
                for i, (_, status) in enumerate(parts):
                    part = fs.open(status.getPath())
                    try:
                        if i:
                            part.seek(header)
                        hadoop.io.IOUtils.copyBytes(part, out, BUFFER, False)
                    finally:
                        part.close()
            finally:
                out.close()
        fs.delete(to, True)
        if not fs.rename(made, to):
            raise OSError(f"{target} could not be written")
        return whole
    finally:
        drop_path(spark, work)
