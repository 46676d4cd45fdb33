"""Run log, failed jobs and cursors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeloom.functions.labels import JOB_ACTIONS
from tradeloom.functions.text import lookup_key


def is_bad(status: str = "status") -> Column:
    return ~F.lower(F.coalesce(status, F.lit(""))).isin("ok", "running")


def recent_runs(runs: DataFrame, limit: int = 20, as_of: Column | None = None, hours: int | None = None) -> DataFrame:
    """Newest runs, of the last hours when given; limit 1..500, hours 1..168."""
    if as_of is not None and hours is not None:
        span = F.make_dt_interval(hours=F.lit(max(1, min(hours, 168))))
        runs = runs.where(F.col("started_at") >= as_of - span)
    return (
        runs.orderBy(F.col("id").desc())
        .limit(max(1, min(limit, 500)))
        .withColumns(
            {
                "error": F.substring(F.coalesce("error", F.lit("")), 1, 240),
                "action_key": lookup_key("job_name", JOB_ACTIONS),
            }
        )
    )


def failed_jobs(runs: DataFrame, as_of: Column, names: dict[str, str] | None = None, limit: int = 200) -> DataFrame:
    """Distinct actions of the failed runs of the last day, latest failure first.

    A job without an alias that is named like an action stands for that action.
    """
    names = names or JOB_ACTIONS
    since = as_of - F.make_dt_interval(hours=F.lit(24))
    bad = runs.where((F.col("started_at") >= since) & is_bad()).orderBy(F.col("id").desc()).limit(limit)
    own = {key: key for key in names.values()}
    action = F.coalesce(lookup_key("job_name", names), lookup_key("job_name", own))
    known = bad.withColumn("action_key", action).where(F.col("action_key").isNotNull())
    return (
        known.groupBy("action_key")
        .agg(F.max("id").alias("last_id"), F.count(F.lit(1)).alias("failures"))
        .orderBy(F.col("last_id").desc())
    )
