"""Table health checks. Every check is a DataFrame with one row per result:

``check_name, table_name, status, failed_rows, detail``. Nothing is computed until the
combined report is read.
"""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adstrata.functions.scalars import (
    days_between,
    exact_sum,
    percent_text,
    ratio,
    true_only,
)
from adstrata.operators import keys

RESULT_COLUMNS = ["check_name", "table_name", "status", "failed_rows", "detail"]

# Alert level per kind of check.
SEVERITY = {
    "missing_values": "WARNING",
    "required_field_not_null": "WARNING",
    "required_field_exists": "WARNING",
    "referential_integrity": "CRITICAL",
    "duplicate_primary_key": "CRITICAL",
    "freshness": "WARNING",
    "valid_values": "CRITICAL",
    "revenue_reconciliation": "CRITICAL",
    "reconciliation": "CRITICAL",
}


def _status(passed: Column) -> Column:
    return F.when(passed, F.lit("pass")).otherwise(F.lit("fail"))


def _result(
    df: DataFrame, check: str, table: Column | str, passed: Column, failed: Column, detail: Column
) -> DataFrame:
    """Shape a one-row aggregate into a check result."""
    table = F.lit(table) if isinstance(table, str) else table
    return df.select(
        F.lit(check).alias("check_name"),
        table.alias("table_name"),
        _status(passed).alias("status"),
        F.when(passed, F.lit(0)).otherwise(failed).cast("bigint").alias("failed_rows"),
        detail.alias("detail"),
    )


@dataclass(frozen=True)
class ColumnCheck:
    """A check that needs one aggregate over the table.

    ``measures`` are the aggregates by name, ``results`` the result rows built from them.
    """

    measures: dict[str, Column]
    results: list[Column]


def _row(check: str, passed: Column, failed: Column, detail: Column) -> Column:
    return F.struct(
        F.lit(check).alias("check_name"),
        _status(passed).alias("status"),
        F.when(passed, F.lit(0)).otherwise(failed).cast("bigint").alias("failed_rows"),
        detail.alias("detail"),
    )


def run_checks(df: DataFrame, table: str, *checks: ColumnCheck) -> DataFrame:
    """All column checks of a table from one pass over it."""
    measures = {name: value for check in checks for name, value in check.measures.items()}
    measured = df.agg(*[value.alias(name) for name, value in measures.items()])
    results = F.array(*[row for check in checks for row in check.results])
    return measured.select(F.explode(results).alias("_r")).select(
        "_r.check_name", F.lit(table).alias("table_name"), "_r.status", "_r.failed_rows", "_r.detail"
    )


def fields_present(columns: Collection[str], fields: Sequence[str]) -> ColumnCheck:
    """One result per field: it must be among the columns and hold no null."""
    measures, results = {}, []
    for field in fields:
        name = f"nulls in {field}"
        failed = F.col(f"`{name}`")
        if field in columns:
            measures[name] = F.count_if(F.col(field).isNull())
            detail = F.format_string(f"{field} has %d missing value(s).", failed)
            results.append(_row("required_field_not_null", failed == 0, failed, detail))
        else:
            measures[name] = F.count(F.lit(1))
            results.append(
                _row("required_field_exists", F.lit(False), failed, F.lit(f"{field} is missing."))
            )
    return ColumnCheck(measures, results)


def fresh(column: str, max_age_days: int, as_of: str) -> ColumnCheck:
    """The newest record may be ``max_age_days`` old; otherwise every row counts as failed.

    A table without any time fails as well.
    """
    newest, total = f"newest {column}", f"rows with {column}"
    age = days_between(F.col(f"`{newest}`"), F.lit(as_of).cast("date"))
    detail = F.when(age.isNull(), F.lit("No record has a time.")).otherwise(
        F.format_string("Newest record is %d day(s) old.", age)
    )
    return ColumnCheck(
        {newest: F.max(column), total: F.count(F.lit(1))},
        [_row("freshness", true_only(age <= max_age_days), F.col(f"`{total}`"), detail)],
    )


def required_fields(df: DataFrame, table: str, fields: Sequence[str]) -> DataFrame:
    return run_checks(df, table, fields_present(df.columns, fields))


def freshness(df: DataFrame, table: str, column: str, max_age_days: int, as_of: str) -> DataFrame:
    return run_checks(df, table, fresh(column, max_age_days, as_of))


def invalid_values(df: DataFrame, column: str, allowed: Collection[str]) -> DataFrame:
    """Values outside the allowed set with their rows; null is one of them."""
    value = F.col(column)
    return (
        df.where(~true_only(value.isin(sorted(allowed))))
        .groupBy(value.cast("string").alias("value"))
        .agg(F.count(F.lit(1)).alias("rows"))
    )


def valid_values(df: DataFrame, table: str, column: str, allowed: Collection[str]) -> DataFrame:
    """Rows outside the allowed set; null counts as invalid.

    The detail gives the rows and the number of kinds of values; ``invalid_values`` lists them.
    """
    counted = invalid_values(df, column, allowed).agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("failed"), F.count(F.lit(1)).alias("kinds")
    )
    failed, kinds = F.col("failed"), F.col("kinds")
    detail = F.format_string(f"{column} has %d invalid row(s) of %d value(s).", failed, kinds)
    return _result(counted, "valid_values", table, failed == 0, failed, detail)


def duplicate_key(df: DataFrame, table: str, key: str | Sequence[str]) -> DataFrame:
    """All members of repeated keys count as failed; null keys are equal to each other."""
    columns = [key] if isinstance(key, str) else list(key)
    counted = keys.repeated_keys(df, columns).agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("failed")
    )
    failed = F.col("failed")
    detail = F.format_string(f"{', '.join(columns)} has %d duplicated row(s).", failed)
    return _result(counted, "duplicate_primary_key", table, failed == 0, failed, detail)


def _amounts(df: DataFrame, key: str, amount: str) -> DataFrame:
    """Amounts per key with their number of rows.

    A key that is repeated many times on both sides would pair up row by row; equal amounts
    are merged before that.
    """
    return df.groupBy(F.col(key).alias("_key"), F.col(amount).alias("_amount")).agg(
        F.count(F.lit(1)).alias("_rows")
    )


def revenue_mismatches(reported: DataFrame, source: DataFrame, tolerance: float = 1.0) -> DataFrame:
    """Reported amounts that differ from the source by more than the tolerance.

    A missing amount counts as 0. Repeated ids pair up with each other; ``source_rows`` says
    how many source rows of this amount stand behind a row.
    """
    booked = _amounts(source, "opportunity_id", "amount_source").select(
        F.col("_key").alias("opportunity_id"),
        F.col("_amount").alias("amount_source"),
        F.col("_rows").alias("source_rows"),
    )
    joined = reported.join(booked, "opportunity_id", "left").withColumns(
        {
            "amount_reporting": F.coalesce("amount_reporting", F.lit(0)),
            "amount_source": F.coalesce("amount_source", F.lit(0)),
            "source_rows": F.coalesce("source_rows", F.lit(1).cast("bigint")),
        }
    )
    difference = F.col("amount_reporting") - F.col("amount_source")
    return joined.withColumn("revenue_difference", difference).where(
        F.abs("revenue_difference") > tolerance
    )


def largest_mismatches(mismatches: DataFrame, n: int = 20) -> DataFrame:
    """The ``n`` mismatches with the largest difference, for the report."""
    size = mismatches.withColumn("_size", F.abs("revenue_difference"))
    ties = ["opportunity_id", "amount_reporting", "amount_source"]
    return keys.top_rows(size, "_size", n, *ties).drop("_size")


def revenue_reconciliation(
    reported: DataFrame, source: DataFrame, table: str = "opportunities", tolerance: float = 1.0
) -> DataFrame:
    """Number of mismatches, counted per pair of a reported and a source row."""
    merged = _amounts(reported, "opportunity_id", "amount_reporting").select(
        F.col("_key").alias("opportunity_id"),
        F.col("_amount").alias("amount_reporting"),
        F.col("_rows").alias("reported_rows"),
    )
    pairs = F.col("reported_rows") * F.col("source_rows")
    counted = revenue_mismatches(merged, source, tolerance).agg(
        F.coalesce(F.sum(pairs), F.lit(0)).alias("failed")
    )
    failed = F.col("failed")
    detail = F.format_string("%d revenue mismatches found.", failed)
    return _result(counted, "revenue_reconciliation", table, failed == 0, failed, detail)


def revenue_reconciliation_strict(
    sales: DataFrame,
    billing: DataFrame,
    sales_key: str,
    billing_key: str,
    sales_amount: str,
    billing_amount: str,
    tolerance: float = 0.01,
) -> DataFrame:
    """Records both systems know must agree to the cent; reports the total delta."""
    left = _amounts(sales, sales_key, sales_amount)
    right = _amounts(billing, billing_key, billing_amount).select(
        "_key", F.col("_amount").alias("_billed"), F.col("_rows").alias("_billed_rows")
    )
    delta = F.abs(F.col("_amount") - F.col("_billed"))
    pairs = F.col("_rows") * F.col("_billed_rows")
    counted = (
        left.join(right, "_key")
        .where(delta > tolerance)
        .agg(
            F.coalesce(F.sum(pairs), F.lit(0)).alias("failed"),
            exact_sum(delta * pairs).alias("total"),
        )
    )
    failed = F.col("failed")
    detail = F.when(failed == 0, F.lit("")).otherwise(
        F.format_string("Revenue mismatch: $%.2f across %d records", F.col("total"), failed)
    )
    return _result(counted, "reconciliation", "revenue", failed == 0, failed, detail)


def row_count_drop(history: DataFrame, threshold: float = 0.20) -> DataFrame:
    """Latest snapshot of each table against the one before it.

    A previous count of 0, or no previous snapshot, is no drop. The history holds one row per
    table and snapshot, so a table's window is as long as its calendar.
    """
    by_time = Window.partitionBy("table_name").orderBy("snapshot_date")
    latest = (
        history.withColumns(
            {
                "previous": F.lag("row_count").over(by_time),
                "next_date": F.lead("snapshot_date").over(by_time),
            }
        )
        .where(F.col("next_date").isNull())
        .withColumn(
            "drop_share",
            F.coalesce(ratio(F.col("previous") - F.col("row_count"), "previous"), F.lit(0.0)),
        )
    )
    detail = F.concat(F.lit("Row count changed by "), percent_text("drop_share"))
    return _result(
        latest,
        "row_count_drop",
        F.col("table_name"),
        F.col("drop_share") <= threshold,
        F.col("row_count"),
        detail,
    )


def referential_integrity(
    child: DataFrame, parent: DataFrame, table: str, key: str, parent_key: str | None = None
) -> DataFrame:
    """Rows that point to no parent row. A null key points to nothing."""
    parents = parent.select(F.col(parent_key or key).alias(key))
    counted = keys.unmatched(child.select(key), parents, [key]).agg(
        F.count(F.lit(1)).alias("failed")
    )
    failed = F.col("failed")
    detail = F.when(failed == 0, F.lit("")).otherwise(
        F.format_string(f"Found %d {table} with non-existent {key}", failed)
    )
    return _result(counted, "referential_integrity", table, failed == 0, failed, detail)


def missing_profile(df: DataFrame, table: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Missing count and percentage of each column, from one pass."""
    names = list(columns or df.columns)
    counted = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(F.col(n).isNull()).alias(f"_n{i}") for i, n in enumerate(names)],
    )
    entries = [
        F.struct(F.lit(n).alias("column_name"), F.col(f"_n{i}").alias("missing_count"))
        for i, n in enumerate(names)
    ]
    return counted.select("_rows", F.explode(F.array(*entries)).alias("_e")).select(
        F.lit(table).alias("table_name"),
        "_e.*",
        (ratio("_e.missing_count", "_rows") * 100).alias("missing_pct"),
    )


def missing_values(profile: DataFrame) -> DataFrame:
    """One result over the missing-value profiles of several tables."""
    has_gap = F.col("missing_count") > 0
    counted = profile.agg(
        F.coalesce(F.sum("missing_count"), F.lit(0)).alias("failed"),
        F.count_if(has_gap).alias("gaps"),
    )
    failed = F.col("failed")
    detail = F.when(failed == 0, F.lit("")).otherwise(
        F.format_string("Found missing values in %d column(s)", F.col("gaps"))
    )
    return _result(counted, "missing_values", "structural", failed == 0, failed, detail)


def row_delta(before: DataFrame, after: DataFrame, table: str, max_share: float = 0.05) -> DataFrame:
    """Rows (or a weight column ``row_count``) before and after a step may differ by 5 %."""
    counts = _row_total(before, "before").unionByName(_row_total(after, "after")).agg(
        F.sum(F.when(F.col("side") == "before", F.col("n"))).alias("before"),
        F.sum(F.when(F.col("side") == "after", F.col("n"))).alias("after"),
    )
    change = F.abs(F.col("after") - F.col("before"))
    share = F.coalesce(ratio(change, "before"), F.lit(0.0))
    detail = F.concat(F.lit("Row count changed by "), percent_text(share))
    return _result(counts, "row_count_delta", table, share <= max_share, change, detail)


def _row_total(df: DataFrame, side: str) -> DataFrame:
    total = F.sum("row_count") if "row_count" in df.columns else F.count(F.lit(1))
    return df.agg(F.coalesce(total, F.lit(0)).alias("n")).withColumn("side", F.lit(side))


def rows_preserved(before: DataFrame, after: DataFrame, table: str) -> DataFrame:
    """A join that only adds columns must keep every row exactly once."""
    same = row_delta(before, after, table, max_share=0.0)
    return same.withColumn("check_name", F.lit("rows_preserved"))


def not_empty(df: DataFrame, what: str = "data") -> DataFrame:
    """Stop a run that has nothing to deliver; reads at most one row."""
    if df.isEmpty():
        raise ValueError(f"No {what} returned for the requested window.")
    return df


def combine(*results: DataFrame) -> DataFrame:
    """All results as one frame, one row per check."""
    stacked = results[0].select(*RESULT_COLUMNS)
    for result in results[1:]:
        stacked = stacked.unionByName(result.select(*RESULT_COLUMNS))
    return stacked


def health_score(results: DataFrame) -> DataFrame:
    """Passed and failed checks, the score in percent and the names of failed checks."""
    passed = F.count_if(F.col("status") == "pass")
    failed_name = F.when(
        F.col("status") == "fail", F.concat_ws(".", F.col("table_name"), F.col("check_name"))
    )
    total = F.count(F.lit(1))
    return results.agg(
        total.alias("total_checks"),
        passed.alias("passed_checks"),
        (total - passed).alias("failed_checks"),
        F.coalesce(F.bround(ratio(passed, total) * 100, 1), F.lit(0.0)).alias("health_score"),
        F.array_join(F.array_sort(F.collect_set(failed_name)), ", ").alias("failed_list"),
    )


def with_severity(results: DataFrame, levels: Mapping[str, str] = SEVERITY) -> DataFrame:
    """Alert level of each failed check; checks that pass, or have no level, get null."""
    level = F.lit(None).cast("string")
    for check, name in levels.items():
        level = F.when(F.col("check_name") == check, F.lit(name)).otherwise(level)
    return results.withColumn("severity", F.when(F.col("status") == "fail", level))
