"""Null-aware arithmetic, exact sums and formatting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Column | str

MICROS = 1_000_000


def as_column(value: ColumnLike) -> Column:
    return F.col(value) if isinstance(value, str) else value


def ratio(numerator: ColumnLike, denominator: ColumnLike) -> Column:
    """Double division that gives null for a zero or null denominator."""
    return F.try_divide(
        as_column(numerator).cast("double"), as_column(denominator).cast("double")
    )


def nonzero(value: ColumnLike) -> Column:
    return F.nullif(as_column(value), F.lit(0))


def exact_sum(value: ColumnLike, scale: int = 6) -> Column:
    """Sum in decimal arithmetic, so that the result does not depend on row order."""
    return F.sum(as_column(value).cast(f"decimal(38,{scale})")).cast("double")


def _if_all_present(columns: tuple[ColumnLike, ...], result: Column) -> Column:
    present = as_column(columns[0]).isNotNull()
    for column in columns[1:]:
        present = present & as_column(column).isNotNull()
    return F.when(present, result)


def strict_greatest(*columns: ColumnLike) -> Column:
    """``greatest`` that is null as soon as one argument is null."""
    return _if_all_present(columns, F.greatest(*map(as_column, columns)))


def strict_least(*columns: ColumnLike) -> Column:
    return _if_all_present(columns, F.least(*map(as_column, columns)))


def whole_units(unit: str, start: ColumnLike, end: ColumnLike) -> Column:
    """Complete hours or days elapsed from ``start`` to ``end``."""
    return F.timestamp_diff(unit, as_column(start), as_column(end))


def days_between(start: ColumnLike, end: ColumnLike) -> Column:
    """Calendar days from ``start`` to ``end`` as bigint."""
    return F.datediff(as_column(end), as_column(start)).cast("bigint")


def floored_at_zero(value: ColumnLike) -> Column:
    """Negative values become 0, null stays null."""
    value = as_column(value)
    return F.when(value < 0, F.lit(0)).otherwise(value)


def from_micros(value: ColumnLike) -> Column:
    """Micro currency units to units; text that is no number gives null."""
    return as_column(value).try_cast("double") / F.lit(float(MICROS))


def number_or_zero(value: ColumnLike, target: str = "double") -> Column:
    return F.coalesce(as_column(value).try_cast(target), F.lit(0).cast(target))


def trimmed_or(value: ColumnLike, default: str) -> Column:
    """Trimmed text with a default for null. An empty string stays empty."""
    return F.coalesce(F.trim(as_column(value)), F.lit(default))


def true_only(condition: ColumnLike) -> Column:
    """Two-valued logic: null counts as false."""
    return F.coalesce(as_column(condition), F.lit(False))


def percent_text(share: ColumnLike) -> Column:
    """0.1234 as ``12.3%``."""
    return F.format_string("%.1f%%", as_column(share) * 100)


def joined_list(value: ColumnLike, separator: str = " / ") -> Column:
    """Aggregate: the distinct values in order, joined into one string.

    ``collect_set`` merges map-side and holds each value once, so the state is as large
    as the string that comes out.
    """
    return F.array_join(F.array_sort(F.collect_set(as_column(value))), separator)
