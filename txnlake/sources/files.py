"""File sources and sinks.

The reference's raw feed is two CSV files aligned by row position; S2 glues
them on a contiguous row index derived without RDDs or a global sort.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas as S
from ..functions.codes import KINDS
from ..operators.classify import parse_timestamp
from ..session import COMPRESSION, scratch_path
from . import quoted_csv

_LOCAL_BITS = 33


#: Texts that the reference's CSV reader takes for a missing value.
MISSING_TEXTS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A",
                 "NA", "NULL", "NaN", "None", "n/a", "nan", "null")

_CORRUPT = "_corrupt"


class RawDataError(ValueError):
    """Rows of the raw files that do not parse."""


def as_text(schema: T.StructType) -> T.StructType:
    """Every column as text, and one for rows with a wrong number of fields."""
    return T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields] + [T.StructField(_CORRUPT, T.StringType())])


def csv_options(multi_line: bool = False) -> dict[str, str]:
    """Quotes are doubled inside quotes, a backslash is a character like any
    other. ``multi_line`` (of a reader that takes whole files) lets quoted
    fields hold line ends; ``quoted_csv`` does so and still splits files."""
    return {"header": "true", "mode": "PERMISSIVE", "quote": '"', "escape": '"', "multiLine": str(multi_line).lower(),
            "columnNameOfCorruptRecord": _CORRUPT, "columnPruning": "false"}


def typed(df: DataFrame, schema: T.StructType, *keep: Column, bad: str = "_bad") -> DataFrame:
    """Text columns -> the declared types, and ``bad``: the row has the wrong
    number of fields, or a text that is no number where one belongs. Whole
    numbers may be written as ``6.0``; missing-value texts become null."""
    # Spark refuses to count by the corrupt column alone, so a data column is read with it.
    out, wrong = [], F.col(_CORRUPT).isNotNull() & (F.coalesce(F.length(schema.fieldNames()[0]), F.lit(0)) >= 0)
    for f in schema.fields:
        text = F.when(~F.col(f.name).isin(*MISSING_TEXTS), F.col(f.name))
        if isinstance(f.dataType, T.StringType):
            out.append(text.alias(f.name))
            continue
        number = F.btrim(text).try_cast("double")
        ok = number.isNotNull()
        if isinstance(f.dataType, T.IntegerType):
            ok = ok & (number == F.floor(number)) & number.between(-2147483648, 2147483647)
        out.append(F.when(ok, number).cast(f.dataType).alias(f.name))
        wrong = wrong | (text.isNotNull() & ~F.coalesce(ok, F.lit(False)))
    return df.select(*out, wrong.alias(bad), *keep)


def read_quoted_csv(spark: SparkSession, path: str, schema: T.StructType, col: str = "_ord") -> tuple[DataFrame, int]:
    """S1 with line ends inside quotes, by splits: typed rows with their file
    position ``col`` and ``_bad``, and the number of rows."""
    rows, total = quoted_csv.records(spark, path)
    options = {k: v for k, v in csv_options().items() if k not in ("header", "multiLine", "columnPruning")}
    return typed(quoted_csv.parsed(rows, as_text(schema), options), schema, F.col("_ord").alias(col)), total


def read_raw_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A headered CSV with a declared schema (no inference), as the
    reference's reader takes it; ``_bad`` marks rows that do not parse."""
    scan = spark.read.schema(as_text(schema)).options(**csv_options()).csv(path)
    return typed(scan, schema, F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"))


def with_row_index(df: DataFrame, col: str = "_ord") -> tuple[DataFrame, int, int]:
    """Contiguous 0-based file position of every row of ``read_raw_csv``, the
    number of rows, and the number of rows that do not parse.

    Rows get ``monotonically_increasing_id`` (partition << 33 | row). One
    aggregate gives each (file, block, partition) segment its first id, size
    and bad rows; it is written, and a running sum over the segments ordered
    by file path then block start gives each segment's offset. That window
    runs over one row per file split, never over data rows. Offsets are
    joined back on a compact key (partition number and a hash of the file);
    Spark broadcasts them while the written table is under its threshold.
    The scan is deterministic, so every branch sees the same ids.
    """
    tagged = df.withColumn("_mid", F.monotonically_increasing_id())
    pid = F.shiftright("_mid", _LOCAL_BITS)
    path = scratch_path(df.sparkSession, "segments")
    (tagged.groupBy("_file", "_block", pid.alias("_pid"))
     .agg(F.min("_mid").alias("_first"), F.count(F.lit(1)).alias("_n"), F.count_if("_bad").alias("_wrong"))
     .write.parquet(path))
    segs = df.sparkSession.read.parquet(path)
    before = Window.orderBy("_file", "_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = segs.select(F.xxhash64("_file", "_block").alias("_split"), "_pid",
                          (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"))
    total, wrong = segs.agg(F.coalesce(F.sum("_n"), F.lit(0)), F.coalesce(F.sum("_wrong"), F.lit(0))).first()
    out = (tagged.withColumns({"_pid": pid, "_split": F.xxhash64("_file", "_block")})
           .join(offsets, ["_split", "_pid"])
           .withColumn(col, F.col("_mid") + F.col("_shift"))
           .drop("_file", "_block", "_split", "_pid", "_mid", "_shift"))
    return out, int(total), int(wrong)


def zip_columns(left: DataFrame, right: DataFrame, col: str = "_ord", on_bad: str = "raise") -> DataFrame:
    """Positional column concat of two row-aligned file scans.

    Unlike a positional concat that pads the shorter side with missing
    values, unequal lengths are an error. So are rows that do not parse
    (``on_bad="raise"``); ``"null"`` keeps them with nulls in the fields
    that failed.
    """
    return _zip(with_row_index(left, col), with_row_index(right, col), col, on_bad)


def _zip(left: tuple[DataFrame, int, int], right: tuple[DataFrame, int, int], col: str, on_bad: str) -> DataFrame:
    (li, n_left, bad_left), (ri, n_right, bad_right) = left, right
    if on_bad == "raise" and bad_left + bad_right:
        raise RawDataError(f"{bad_left} rows of the first file and {bad_right} of the second do not parse")
    if n_left != n_right:
        raise ValueError(f"row counts differ: {n_left} vs {n_right}")
    return li.drop("_bad").join(ri.drop("_bad"), col)


def customer_id(c: Column) -> Column:
    """T2 on a column: '17850' or '17850.0' -> 17850."""
    return c.try_cast("double").try_cast("int")


def read_raw(spark: SparkSession, ids_path: str, features_path: str, multi_line: bool = False,
             on_bad: str = "raise") -> DataFrame:
    """S1 + S2 + T1 + T2: the raw feed with its file position in ``_ord``.
    ``multi_line``: quoted fields may hold line ends (files are split all the same)."""
    files = ((ids_path, S.IDS_FILE_SCHEMA), (features_path, S.FEATURES_FILE_SCHEMA))
    sides = []
    for path, schema in files:
        if multi_line:
            rows, total = read_quoted_csv(spark, path, schema)
            wrong = rows.agg(F.count_if("_bad")).first()[0] if on_bad == "raise" else 0
        else:
            rows, total, wrong = with_row_index(read_raw_csv(spark, path, schema))
        sides.append((_as_raw(rows), total, wrong))
    return _zip(*sides, "_ord", on_bad).select(
        "InvoiceNo", "StockCode", "Description", "Quantity", "InvoiceDate", "UnitPrice", "CustomerID", "Country", "_ord")


def _as_raw(rows: DataFrame) -> DataFrame:
    """T1 + T2 on one file's rows, before they are joined: a timestamp and a number move in fewer bytes than their texts."""
    kinds = {"InvoiceDate": parse_timestamp, "CustomerID": customer_id}
    return rows.withColumns({c: parse(F.col(c)) for c, parse in kinds.items() if c in rows.columns})


def write_processed(lines: DataFrame, path: str, fmt: str = "parquet") -> None:
    """S3: the processed tables as one table partitioned by kind (a reader of
    one kind prunes the others), written in one job. A task keeps one file of
    each kind open, so its lines are not sorted by kind."""
    w = lines.write.mode("overwrite").partitionBy("kind")
    conf, key = lines.sparkSession.conf, "spark.sql.maxConcurrentOutputFileWriters"
    before = conf.get(key)
    conf.set(key, str(len(KINDS)))
    try:
        if fmt == "csv":
            w.options(header=True, escape='"', quoteAll=False, emptyValue='""', nullValue="").csv(path)
        else:
            w.option("compression", COMPRESSION).parquet(path)
    finally:
        conf.set(key, before)


def _holds(spark: SparkSession, path: str, pattern: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = where.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(spark._jvm.org.apache.hadoop.fs.Path(path, pattern))
    return bool(found)


def read_processed(spark: SparkSession, path: str, fmt: str | None = None) -> DataFrame:
    """Processed lines back, in the declared schema. ``fmt`` None: CSV
    where the kind folders hold CSV files, Parquet otherwise."""
    if fmt is None:
        fmt = "csv" if _holds(spark, path, "kind=*/*.csv*") else "parquet"
    if fmt == "csv":
        return spark.read.schema(S.PROCESSED_SCHEMA).options(header=True, escape='"', multiLine=True, nullValue="", emptyValue="") \
            .csv(path)
    return spark.read.parquet(path)


def append(df: DataFrame, path: str) -> None:
    """Append; the writer's tasks are the chunks."""
    df.write.mode("append").parquet(path)


def overwrite(df: DataFrame, path: str) -> None:
    """Replace the table's contents."""
    df.write.mode("overwrite").parquet(path)
