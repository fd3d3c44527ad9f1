"""File sources and sinks."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from txnwatch.functions.contract import na_to_null
from txnwatch.operators.ordinal import with_ordinal
from txnwatch.session import checkpoint_path

TOP_ROWS = 100_000
BROADCAST_FILES = 500_000
_ROW_BITS = 33  # bits of monotonically_increasing_id() that count rows in a task
_FILE_BITS = 44  # bits of seq that hold a position in a file


def _plain(uri: Column) -> Column:
    """One spelling of file:/x and file:///x."""
    return F.regexp_replace(uri, "^file:/+", "file:/")


def _file_numbers(spark: SparkSession, path: str) -> DataFrame:
    """_name, _file: the files of a path in name order.  Spark lists them; no content is read
    and no list passes through the driver."""
    names = spark.read.format("binaryFile").load(path).select(_plain(F.col("_metadata.file_path")).alias("_name"))
    numbers = with_ordinal(names, ["_name"], "_file")
    return F.broadcast(numbers) if numbers.count() <= BROADCAST_FILES else numbers


def with_file_order(df: DataFrame, path: str, row_index: bool = False) -> DataFrame:
    """Add ``seq``: a unique bigint that increases with (file name, position in file).

    The position is the row index where the format has one (Parquet), else the
    split's first byte plus the row's number in its task; a row has at least a byte,
    so splits of a file cannot meet.  The data is read once and, but for very many files,
    not shuffled: up to ``BROADCAST_FILES`` file numbers are broadcast.
    """
    row = F.col("_metadata.row_index") if row_index else (
        F.col("_metadata.file_block_start")
        + F.monotonically_increasing_id().bitwiseAND(F.lit((1 << _ROW_BITS) - 1)))
    marked = df.select("*", _plain(F.col("_metadata.file_path")).alias("_path"), row.alias("_row"))
    joined = marked.join(_file_numbers(df.sparkSession, path), F.col("_path") == F.col("_name"))
    return joined.withColumn("seq", F.shiftleft("_file", _FILE_BITS) + F.col("_row")).drop("_path", "_row", "_name", "_file")


def scan_csv(spark: SparkSession, path: str, max_rows: int | None = None,
             na_tokens: bool = True, add_seq: bool = True) -> DataFrame:
    """Header CSV, every column read as a string (no inference: bank
    codes keep leading zeros).  pandas' missing-value tokens become null."""
    df = spark.read.option("header", True).option("inferSchema", False).csv(path)
    if na_tokens:
        df = df.select(*[na_to_null(F.col(f"`{c}`")).alias(c) for c in df.columns])
    if add_seq and "seq" not in df.columns:
        df = with_file_order(df, path)
    return limit_rows(df, max_rows) if max_rows else df


def scan_parquet(spark: SparkSession, path: str, max_rows: int | None = None, add_seq: bool = True) -> DataFrame:
    """Parquet scan (column pruning and filters reach the reader), in file order."""
    df = spark.read.parquet(path)
    if add_seq and "seq" not in df.columns:
        df = with_file_order(df, path, row_index=True)
    return limit_rows(df, max_rows) if max_rows else df


def scan_transactions(spark: SparkSession, path: str, max_rows: int | None = None) -> DataFrame:
    """Parquet by suffix, else CSV (the reference's reader rule)."""
    if path.rstrip("/").lower().endswith(".parquet"):
        return scan_parquet(spark, path, max_rows)
    return scan_csv(spark, path, max_rows)


def limit_rows(df: DataFrame, max_rows: int, order_col: str = "seq") -> DataFrame:
    """S3: the first ``max_rows`` rows in file order.  Up to ``TOP_ROWS`` that is a top-k; beyond,
    the order column alone is ranked over all tasks and rows up to the last one's value stay."""
    n = int(max_rows)
    if n <= TOP_ROWS:
        return df.orderBy(order_col).limit(n)
    last = with_ordinal(df.select(order_col), [order_col], "_at").where(F.col("_at") == n - 1).select(order_col).first()
    return df if last is None else df.where(F.col(order_col) <= F.lit(last[0]))


def sink_csv(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """CSV with a header row."""
    df.write.mode(mode).option("header", True).csv(path)
    return path


def sink_parquet(df: DataFrame, path: str, partition_by: str | None = "dt",
                 ts_col: str = "timestamp", mode: str = "overwrite") -> str:
    """Parquet, partitioned by UTC day so date filters prune files."""
    if partition_by and partition_by not in df.columns and ts_col in df.columns:
        df = df.withColumn(partition_by, F.to_date(ts_col))
    w = df.write.mode(mode)
    if partition_by and partition_by in df.columns:
        w = w.partitionBy(partition_by)
    w.parquet(path)
    return path


def sink_report_json(report: DataFrame, path: str) -> str:
    """A small report (one row) as JSON."""
    report.coalesce(1).write.mode("overwrite").json(path)
    return path


def scan_report_json(spark: SparkSession, path: str, schema=None) -> DataFrame | None:
    """Read a JSON report; missing or unreadable -> None."""
    try:
        if schema is None:
            r = spark.read.json(path)
            return None if "_corrupt_record" in r.columns else r
        bad = T.StructField("_corrupt_record", T.StringType())
        r = spark.read.schema(T.StructType([*schema.fields, bad])).json(path).cache()  # reports are small
        unreadable = not r.where("_corrupt_record IS NOT NULL").isEmpty()
        return None if unreadable else r.drop("_corrupt_record")
    except AnalysisException:
        return None


def scan_report_csv(spark: SparkSession, path: str, limit: int | None = None, schema=None,
                    order_col: str | None = None) -> DataFrame:
    """Read a CSV report; missing -> empty frame.  A ``limit`` is a page of the
    report and needs the column that orders it."""
    if limit is not None and order_col is None:
        raise ValueError("a limited report needs order_col")
    try:
        reader = spark.read.option("header", True)
        df = reader.schema(schema).csv(path) if schema is not None else reader.option("inferSchema", True).csv(path)
    except AnalysisException:
        return spark.createDataFrame([], schema or "value string")
    return df.orderBy(order_col).limit(limit) if limit is not None else df


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder."""
    return checkpoint_path(spark, f"{name}-{uuid.uuid4().hex[:12]}")
