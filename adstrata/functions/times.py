"""Time zones, truncation and the text form of time columns."""

from __future__ import annotations

import re
from datetime import date, datetime, timedelta, timezone
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adstrata.functions.scalars import ColumnLike, as_column

TIME_TEXT = "yyyy-MM-dd HH:mm:ss"

# Time columns known by their full name.
KNOWN_TIME_COLUMNS = {
    "request_time",
    "request_date",
    "request_hour",
    "timestamp",
    "ltconv_start_time",
    "ltconv_end_time",
    "email_event_timestamp",
    "email_sent_timestamp",
    "local_visit_timestamp",
    "stats_click_time",
    "stats_imp_time",
}


def to_local(ts: ColumnLike, zone: ColumnLike, source_zone: str = "UTC") -> Column:
    """Wall-clock time in ``zone`` for a zone-less UTC timestamp.

    ``zone`` is a zone name or a column holding one per row.
    """
    zone = F.lit(zone) if isinstance(zone, str) else zone
    return F.convert_timezone(F.lit(source_zone), zone, as_column(ts).cast("timestamp_ntz"))


def local_trunc(unit: str, ts: ColumnLike, zone: ColumnLike) -> Column:
    """Start of the local day or hour."""
    return F.date_trunc(unit, to_local(ts, zone)).cast("timestamp_ntz")


def utc_bounds(start: str | datetime, end: str | datetime, zone: str) -> tuple[datetime, datetime]:
    """Local bounds as zone-less UTC literals, ready for a predicate that reaches the scan."""

    def convert(value: str | datetime) -> datetime:
        if isinstance(value, str):
            value = datetime.fromisoformat(value)
        return value.replace(tzinfo=ZoneInfo(zone)).astimezone(timezone.utc).replace(tzinfo=None)

    return convert(start), convert(end)


def local_day_bounds(first_day: date, last_day: date, zone: str) -> tuple[datetime, datetime]:
    """Half-open UTC bounds of the local days ``first_day`` .. ``last_day``."""
    midnight = datetime.min.time()
    return utc_bounds(
        datetime.combine(first_day, midnight),
        datetime.combine(last_day + timedelta(days=1), midnight),
        zone,
    )


def pull_window(
    as_of: date, start_date: date, output_exists: bool, repull: bool = False
) -> tuple[datetime, datetime]:
    """Local pull window: everything since ``start_date`` on a first run or a repull,
    otherwise yesterday only. Both end with yesterday: the second time is the midnight after it,
    which is not part of the window."""
    yesterday = as_of - timedelta(days=1)
    first_day = start_date if repull or not output_exists else yesterday
    return (
        datetime.combine(first_day, datetime.min.time()),
        datetime.combine(as_of, datetime.min.time()),
    )


def is_time_column(name: str) -> bool:
    """Known names, whole words time/date/timestamp, and the endings _time and _date."""
    name = name.lower()
    return (
        name in KNOWN_TIME_COLUMNS
        or name.endswith(("_time", "_date"))
        or re.search(r"\b(time|date|timestamp)\b", name) is not None
    )


def readable_share(df: DataFrame, parsed: Column) -> Column:
    """Share of the rows of ``df`` with a readable time, as a scalar subquery.

    Catalyst merges the subqueries of several columns into one aggregate.
    """
    return df.agg(F.avg(parsed.isNotNull().cast("int"))).scalar()


def time_text(df: DataFrame, share: float = 0.7) -> DataFrame:
    """Write every time column as ``yyyy-MM-dd HH:mm:ss`` text.

    Text and numbers (microseconds since the epoch) are converted only where more than
    ``share`` of the whole column can be read as a time.
    """
    readable: dict[str, Column] = {}
    typed: list[str] = []
    for field in df.schema.fields:
        if not is_time_column(field.name):
            continue
        if isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType, T.DateType)):
            typed.append(field.name)
        elif isinstance(field.dataType, T.StringType):
            readable[field.name] = F.try_to_timestamp(F.col(field.name))
        elif isinstance(field.dataType, T.NumericType):
            readable[field.name] = F.timestamp_micros(F.col(field.name).try_cast("bigint"))

    columns = []
    for field in df.schema.fields:
        name = field.name
        if name in typed:
            columns.append(F.date_format(F.col(name), TIME_TEXT).alias(name))
        elif name in readable:
            parsed = readable[name]
            columns.append(
                F.when(readable_share(df, parsed) > share, F.date_format(parsed, TIME_TEXT))
                .otherwise(F.col(name).cast("string"))
                .alias(name)
            )
        else:
            columns.append(F.col(name))
    return df.select(*columns)
