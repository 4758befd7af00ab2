"""Incremental load of raw files arriving in a folder (Structured Streaming).

Each micro-batch is one load run: the batch's lines are transformed and
loaded with the same insert-ignore rules as a batch load. Because the load is
idempotent, a micro-batch replayed after a failure adds nothing twice. Rows
that do not parse, or have no date, do not stop the stream: they are written
to ``_rejected`` beside the warehouse's tables, by batch, and counted in
``REJECTED``.

File order inside a batch is (batch id, file path, block start, row order
within the split), carried as a struct ordinal.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pyspark.sql.types import StructType

from .. import schemas as S
from ..operators.classify import parse_timestamp
from ..plans.etl import run
from ..sources.files import as_text, csv_options, customer_id, typed

# One raw file holds the eight raw columns (dates and ids as text).
RAW_FILE_SCHEMA = StructType(S.IDS_FILE_SCHEMA.fields + S.FEATURES_FILE_SCHEMA.fields)

REJECTED: dict[int, int] = {}  # rows set aside, by batch id


def _typed(batch: DataFrame, batch_id: int) -> DataFrame:
    rows = typed(batch, RAW_FILE_SCHEMA, F.col("_file"), F.col("_block"))
    return rows.select(
        "InvoiceNo", "StockCode", "Description", "Quantity",
        parse_timestamp(F.col("InvoiceDate")).alias("InvoiceDate"),
        "UnitPrice", customer_id(F.col("CustomerID")).alias("CustomerID"), "Country",
        F.struct(F.lit(batch_id).cast("long").alias("batch"), F.col("_file"), F.col("_block"),
                 F.monotonically_increasing_id().alias("row")).alias("_ord"), "_bad")


def start(spark: SparkSession, raw_dir: str, warehouse_path: str, checkpoint: str, available_now: bool = False,
          max_files_per_trigger: int | None = None, multi_line: bool = False) -> StreamingQuery:
    """Watch ``raw_dir`` for headered raw CSV files and load each micro-batch."""
    reader = spark.readStream.schema(as_text(RAW_FILE_SCHEMA)).options(**csv_options(multi_line))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.csv(raw_dir).select(
        "*", F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"))

    def one(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        rows = _typed(batch, batch_id)
        wrong = F.col("_bad") | F.col("InvoiceDate").isNull()
        rejected = f"{warehouse_path}/_rejected/batch={batch_id}"
        rows.filter(wrong).drop("_bad").write.mode("overwrite").parquet(rejected)
        REJECTED[batch_id] = batch.sparkSession.read.parquet(rejected).count()
        run(spark, rows.filter(~wrong).drop("_bad"), warehouse_path)

    w = stream.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
