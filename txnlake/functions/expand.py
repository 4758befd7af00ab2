"""Re-expanding counted groups into rows without a hot task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHUNK = 1 << 20  # rows generated by one chunk


def expand(df: DataFrame, first: str, last: str, out: str, chunk: int = CHUNK) -> DataFrame:
    """One row per integer in [first, last] for every input row, as ``out``.

    A group counted by a partial aggregate can be as large as a third of
    the data; exploding its count in place would make one task emit all of
    it. The range is first cut into chunks of ``chunk`` numbers, the chunk
    rows (few: count / chunk) are hash-spread over the shuffle partitions, and
    each task expands only its own chunks.
    """
    n = F.col(last) - F.col(first) + 1
    chunks = df.filter(n > 0).withColumn(
        "_chunk", F.explode(F.sequence(F.lit(0).cast("long"), ((n - 1) / chunk).cast("long"))))
    spread = chunks.repartition(*[F.col(c) for c in df.columns], F.col("_chunk"))
    lo = F.col(first) + F.col("_chunk") * chunk
    hi = F.least(lo + (chunk - 1), F.col(last))
    return spread.withColumn(out, F.explode(F.sequence(lo.cast("long"), hi.cast("long")))).drop("_chunk")
