"""Cursors, lookback, retention and freshness as batch functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Steps of the lookback rule, in minutes of cursor age and in percent
# of duplicates.
AGE_STEPS = ((20, 2), (60, 5), (360, 10))
OLD_CURSOR_MINIMUM = 15
MANY_DUPLICATES = ((30.0, 2), (15.0, 5))
FEW_DUPLICATES = ((3.0, 5), (7.0, 2))
FIXED_LOOKBACK_MINUTES = 180
SHORT_PAGE_ROWS = 79_000


def lookback_minutes(age_minutes: Column, dup_pct: Column, base: int, longest: int) -> Column:
    """Minutes to read again, from the cursor's age and the last duplicate share."""
    by_age = F.lit(min(longest, max(base, OLD_CURSOR_MINIMUM)))
    for limit, minutes in reversed(AGE_STEPS):
        by_age = F.when(age_minutes <= limit, F.lit(min(base, minutes))).otherwise(by_age)
    (most, most_cap), (more, more_cap) = MANY_DUPLICATES
    (least, least_add), (less, less_add) = FEW_DUPLICATES
    adjusted = (
        F.when(dup_pct >= most, F.least(by_age, F.lit(most_cap)))
        .when(dup_pct >= more, F.least(by_age, F.lit(more_cap)))
        .when(dup_pct <= least, F.least(F.lit(longest), by_age + least_add))
        .when(dup_pct <= less, F.least(F.lit(longest), by_age + less_add))
        .otherwise(by_age)
    )
    return F.when(age_minutes.isNull(), F.lit(base)).otherwise(F.greatest(adjusted, F.lit(0)))


def age_in_minutes(cursor: Column, as_of: Column) -> Column:
    """Whole minutes from the cursor to ``as_of``, never negative."""
    return F.greatest(F.floor((F.unix_micros(as_of) - F.unix_micros(cursor)) / 60_000_000), F.lit(0))


def max_cursor(df: DataFrame, columns: list[str], by: list[str] | None = None, first_only: bool = True) -> DataFrame:
    """Greatest cursor per group: first filled column of a row, or the greatest of all."""
    times = [F.col(c) for c in columns]
    per_row = F.coalesce(*times) if first_only or len(times) == 1 else F.greatest(*times)
    return df.groupBy(*(by or [])).agg(F.max(per_row).alias("cursor"))


def advance_cursor(cursors: DataFrame, batch: DataFrame, job: str = "job_name") -> DataFrame:
    """Cursors after a batch; a job without new rows keeps its cursor."""
    moved = batch.where(F.col("cursor").isNotNull()).select(job, F.col("cursor").alias("__new"))
    joined = cursors.join(moved, job, "full")
    return joined.select(job, F.coalesce(F.greatest("cursor", "__new"), "cursor", "__new").alias("cursor"))


def stalled(before: Column, after: Column, rows: Column) -> Column:
    """A backfill ends on an empty or short page, or when the cursor did not move."""
    return (rows < SHORT_PAGE_ROWS) | ~(after > before) | after.isNull()


def needs_retry(report_date: Column, expected: Column) -> Column:
    """A report is fetched again when missing or older than expected."""
    return report_date.isNull() | (report_date < expected)
