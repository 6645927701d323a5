"""Reading event logs, dimension tables, files and snapshots."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from adstrata.functions.times import local_day_bounds
from adstrata.operators.logextract import in_time_range

# Folder levels of a snapshot, from the outside in.
SNAPSHOT_LEVELS = ("year", "month", "day", "hour")


def event_day(spark: SparkSession, path: str, day: date) -> DataFrame:
    """One day of a log partitioned by ``event_date``; the other days are not opened."""
    return spark.read.parquet(path).where(F.col("event_date") == F.lit(day))


def event_range(
    spark: SparkSession, path: str, start_utc: datetime, end_utc: datetime
) -> DataFrame:
    """Log rows in ``[start, end)``. The date predicate prunes partitions, the time
    predicate cuts the first and last day."""
    last_day = (end_utc - timedelta(microseconds=1)).date()
    return (
        spark.read.parquet(path)
        .where(F.col("event_date").between(F.lit(start_utc.date()), F.lit(last_day)))
        .where(in_time_range(start_utc, end_utc))
    )


def local_days(
    spark: SparkSession, path: str, first_day: date, last_day: date, zone: str
) -> DataFrame:
    """Log rows of whole local days."""
    return event_range(spark, path, *local_day_bounds(first_day, last_day, zone))


def dimension(spark: SparkSession, path: str, columns: Iterable[str] | None = None) -> DataFrame:
    table = spark.read.parquet(path)
    return table.select(*columns) if columns else table


def dimension_jdbc(spark: SparkSession, url: str, query: str, **options: str) -> DataFrame:
    """Dimension rows from an operational database; the query runs there."""
    return spark.read.format("jdbc").options(url=url, query=query, **options).load()


def delimited(
    spark: SparkSession, path: str, schema: StructType | str, separator: str = ","
) -> DataFrame:
    """Delimited text with a header. The schema is given, so nothing is read to infer it."""
    return spark.read.schema(schema).option("header", True).option("sep", separator).csv(path)


def crosswalk(spark: SparkSession, path: str, luid: str, key: str) -> DataFrame:
    """Pipe-separated crosswalk as raw ``(luid, key)`` text columns, found by header name."""
    raw = spark.read.option("header", True).option("sep", "|").csv(path)
    return raw.select(luid, key)


def identity_graph(spark: SparkSession, path: str) -> DataFrame:
    schema = "luid string, duids array<struct<id: string>>"
    return spark.read.schema(schema).parquet(path)


def _children(spark: SparkSession, path: str) -> list[str]:
    """Names directly below a folder, from file system metadata."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(hadoop):
        return []
    return [status.getPath().getName() for status in fs.listStatus(hadoop)]


def run_folders(spark: SparkSession, folder: str) -> list[str]:
    """Names of the folders that runs have left below ``folder``, unfinished ones included."""
    return sorted(_children(spark, folder))


def latest_snapshot_path(spark: SparkSession, root: str) -> str:
    """Folder of the newest snapshot below ``year=/month=/day=/hour=``.

    At each level the largest number wins; the search stops where a level is missing. Only
    folder names are listed, one level at a time.
    """
    path = root.rstrip("/")
    for level in SNAPSHOT_LEVELS:
        found = [
            name for name in _children(spark, path) if name.startswith(f"{level}=")
        ]
        if not found:
            break
        path = f"{path}/{max(found, key=lambda name: int(name.split('=', 1)[1]))}"
    return path


def latest_snapshot(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(latest_snapshot_path(spark, root))


def single_file(spark: SparkSession, folder: str, suffix: str) -> str:
    """Path of the only file with this ending; none or several are an error."""
    found = sorted(name for name in _children(spark, folder) if name.endswith(suffix))
    if len(found) != 1:
        raise ValueError(f"Expected exactly one {suffix} file, found {len(found)}: {found}")
    return f"{folder.rstrip('/')}/{found[0]}"


def exists(spark: SparkSession, path: str) -> bool:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop)


def has_output(spark: SparkSession, folder: str, suffix: str = ".csv", besides: str | None = None) -> bool:
    """Whether the folder itself holds a finished delivery (what is in subfolders does not count).

    A delivery is a file with that ending, or a folder with it in which Spark has marked its job as
    done: what a failed run has left is no delivery. ``besides`` names one that does not count.
    """
    for name in _children(spark, folder):
        if name.endswith(suffix) and name != besides:
            inside = _children(spark, f"{folder.rstrip('/')}/{name}")
            if inside == [name] or "_SUCCESS" in inside:  # listing a file gives the file itself
                return True
    return False
