"""The run that is due for a client: its window follows from what has been delivered."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession

from adstrata.functions.times import pull_window, time_text
from adstrata.operators import logextract
from adstrata.sources import readers, writers

SAMPLE_FOLDER = "sample"


@dataclass(frozen=True)
class DueRun:
    """Local window with an exclusive end, whether only a sample is due, and where the run writes."""

    start: datetime
    end: datetime
    sample: bool
    target: str


def due_run(
    spark: SparkSession, folder: str, as_of: date, start_date: date, repull: bool = False, prefix: str = "report"
) -> DueRun:
    """What a client's folder asks for on the day ``as_of``.

    A folder that is not there yet gets a sample, in a folder of its own, so that the shape can be looked
    at. Without a finished delivery the run takes everything since ``start_date``, afterwards yesterday.
    The delivery of the day itself is no earlier one: the same run again takes the same window, and
    replaces it. Only names in the folder are listed.
    """
    folder = folder.rstrip("/")
    name = f"{prefix}_{as_of:%Y%m%d}.csv"
    delivered = readers.has_output(spark, folder, ".csv", besides=name)
    sample = not readers.exists(spark, folder)
    start, end = pull_window(as_of, start_date, delivered, repull)
    return DueRun(start, end, sample, f"{folder}/{SAMPLE_FOLDER if sample else name}")


def deliver_due(
    log: DataFrame,
    request: logextract.LogRequest,
    folder: str,
    as_of: date,
    start_date: date,
    hierarchy: logextract.Hierarchy | None = None,
    lookups: logextract.Lookups | None = None,
    repull: bool = False,
    sample_order: Sequence[str] = ("request_time", "auction_id"),
) -> DueRun:
    """Build and write the run that is due; the window of ``request`` is replaced by it.

    ``sample_order`` are columns of the report. Times are written as text.
    """
    run = due_run(log.sparkSession, folder, as_of, start_date, repull)
    request = replace(request, start=run.start, end=run.end)
    report = logextract.build_report(log, request, hierarchy, lookups or logextract.Lookups())
    if run.sample:
        report = logextract.sample_rows(report, sample_order)
    writers.deliver(time_text(report), "csv", run.target)
    return run
