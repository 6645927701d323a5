"""Writing reports: files, tables and the checks around them.

Writers run in parallel and leave one folder of part files.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adstrata.functions.times import time_text
from adstrata.operators.logextract import text_columns

# File formats of a delivery and their separators.
SEPARATORS = {"csv": ",", "psv": "|"}


def write_files(
    df: DataFrame, path: str, file_format: str = "csv", compress: bool = False, mode: str = "overwrite"
) -> str:
    """Delivery as csv, psv or parquet, optionally gzipped (text formats only)."""
    writer = df.write.mode(mode)
    if file_format == "parquet":
        writer.parquet(path)
    elif file_format in SEPARATORS:
        writer = writer.option("header", True).option("sep", SEPARATORS[file_format])
        if compress:
            writer = writer.option("compression", "gzip")
        writer.csv(path)
    else:
        raise ValueError(f"Unknown format: {file_format}")
    return path


def dated_name(prefix: str, day: date) -> str:
    return f"{prefix}_{day:%Y%m%d}.psv.gz"


def psv_gz(df: DataFrame, folder: str, prefix: str, day: date) -> str:
    """Gzipped pipe-separated part files in a dated folder, written in parallel."""
    return write_files(df, f"{folder.rstrip('/')}/{dated_name(prefix, day)}", "psv", compress=True)


def append_or_overwrite(
    df: DataFrame, table: str, mode: str = "append", sample: bool = False, path: str | None = None
) -> str:
    """Report table with text times. Samples always replace the table.

    Without ``path`` its files lie in the session's warehouse.
    """
    replace = sample or (mode or "").lower() == "overwrite"
    writer = time_text(df).write.mode("overwrite" if replace else "append")
    (writer.option("path", path) if path else writer).saveAsTable(table)
    return table


def string_table(df: DataFrame, path: str) -> str:
    """Replace a table whose columns are all text; nulls become empty text."""
    text_columns(df).write.mode("overwrite").parquet(path)
    return path


def append_evolving(df: DataFrame, path: str) -> str:
    """Append rows that may bring new columns; ``read_evolving`` sees the union of columns."""
    df.write.mode("append").parquet(path)
    return path


def read_evolving(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("mergeSchema", True).parquet(path)


def audit_by_date(df: DataFrame, path: str, date_column: str = "date") -> str:
    """Replace the dates that are in ``df`` and leave all others; a rerun changes nothing."""
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(date_column)
        .parquet(path)
    )
    return path


def append_run(df: DataFrame, path: str, run: str, column: str = "run_id") -> str:
    """Append the rows of one run, which may bring new columns; the same run again replaces its own rows.

    A run that failed half-way, or is repeated, leaves no row doubled and does not touch other runs.
    """
    if not run:
        raise ValueError("a run needs an id")
    return audit_by_date(df.withColumn(column, F.lit(run)), path, column)


def as_table(df: DataFrame, name: str, path: str | None = None) -> str:
    writer = df.write.mode("overwrite")
    (writer.option("path", path) if path else writer).saveAsTable(name)
    return name


def as_view(df: DataFrame, name: str) -> str:
    df.createOrReplaceTempView(name)
    return name


def event_log_by_day(events: DataFrame, path: str, time: str = "request_time") -> str:
    """Store a log partitioned by ``event_date``, the layout the readers prune on.

    Rows are dealt to writers by date. Adaptive execution splits a busy day into as many tasks
    and files as its size asks for, and puts quiet days together.
    """
    dated = events.withColumn("event_date", F.col(time).cast("date"))
    dated.hint("rebalance", "event_date").write.mode("overwrite").partitionBy("event_date").parquet(path)
    return path


def verify(df: DataFrame, read_back: DataFrame) -> DataFrame:
    """Rows written and rows read back, with a flag; one row."""
    written = df.agg(F.count(F.lit(1)).alias("rows_written"))
    found = read_back.agg(F.count(F.lit(1)).alias("rows_found"))
    return written.withColumn("rows_found", found.scalar()).withColumn(
        "is_complete", F.col("rows_written") == F.col("rows_found")
    )


def deliver(df: DataFrame, destination: str, target: str, **options) -> str:
    """Hand a report to the writer of its destination."""
    writers: dict[str, Callable[..., str]] = {
        "csv": lambda: write_files(df, target, "csv", **options),
        "psv_gz": lambda: psv_gz(df, target, **options),
        "parquet": lambda: write_files(df, target, "parquet", **options),
        "table": lambda: append_or_overwrite(df, target, **options),
        "string_table": lambda: string_table(df, target),
    }
    if destination not in writers:
        raise ValueError(f"Invalid destination: {destination}")
    return writers[destination]()
