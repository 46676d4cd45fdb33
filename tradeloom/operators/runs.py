"""Runs that count themselves: the counters of a run-log row are gathered while the run writes.

``observe`` collects them in the tasks that do the work, so nothing is scanned a second time.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradeloom.operators.keyed import dedupe_latest
from tradeloom.operators.quality import run_log_row
from tradeloom.sources.tables import has_run, read_runs, versioned_upsert, write_run

RUN_ROW = T.StructType(
    [
        T.StructField("job_name", T.StringType()),
        T.StructField("started_at", T.TimestampType()),
        T.StructField("finished_at", T.TimestampType()),
        T.StructField("status", T.StringType()),
        T.StructField("api_rows", T.LongType()),
        T.StructField("raw_new", T.LongType()),
        T.StructField("norm_upserted", T.LongType()),
        T.StructField("duplicates", T.LongType()),
        T.StructField("dup_pct", T.DoubleType()),
        T.StructField("cursor_old", T.TimestampType()),
        T.StructField("cursor_used", T.TimestampType()),
        T.StructField("cursor_new", T.TimestampType()),
        T.StructField("error", T.StringType()),
    ]
)


class RunCounters:
    """Counters of one run. Each marked frame must be computed once by what the run writes."""

    def __init__(self) -> None:
        self.received, self.kept, self.added = (Observation() for _ in range(3))
        self.marked: set[Observation] = set()

    def _mark(self, df: DataFrame, observation: Observation, *metrics) -> DataFrame:
        self.marked.add(observation)
        return df.observe(observation, *metrics)

    def receive(self, df: DataFrame, time: str) -> DataFrame:
        return self._mark(df, self.received, F.count(F.lit(1)).alias("api_rows"), F.max(time).cast("timestamp").alias("cursor_new"))

    def keep(self, df: DataFrame) -> DataFrame:
        """The rows that go on after deduplication; all of them are upserted."""
        return self._mark(df, self.kept, F.count(F.lit(1)).alias("deduped"))

    def add(self, df: DataFrame) -> DataFrame:
        """The versions that are appended."""
        return self._mark(df, self.added, F.count(F.lit(1)).alias("raw_new"))

    def values(self) -> dict:
        """Call it after the writes; what was not marked counts 0."""
        found = {"api_rows": 0, "deduped": 0, "raw_new": 0, "cursor_new": None}
        for observation in self.marked:
            found |= {k: v for k, v in observation.get.items() if v is not None}
        return found | {"norm_upserted": found["deduped"]}


def last_cursor(spark: SparkSession, runs_path: str, job_name: str) -> datetime | None:
    """Where the job's successful runs have come to."""
    runs = read_runs(spark, runs_path, RUN_ROW).where((F.col("job_name") == job_name) & (F.col("status") == "ok"))
    return runs.agg(F.max("cursor_new")).first()[0]


def logged_upsert(
    spark: SparkSession,
    read: Callable[[datetime | None], DataFrame],
    paths: tuple[str, str, str],
    keys: Sequence[str],
    time: str,
    arrival: Sequence[str],
    compare: Sequence[str],
    schema: T.StructType,
    job_name: str,
    run_id: str,
    lookback: timedelta = timedelta(0),
    buckets: int = 64,
    now: Callable[[], datetime] = datetime.now,
) -> dict:
    """One incremental run: read from the cursor less ``lookback``, deduplicate, append versions, upsert, log the run.

    ``read`` gives the feed from a time on (None: from the start). ``paths`` are those of the
    state, the version log and the run log. The cursor moves only if rows arrived. A run that
    fails is logged with its error, does not move the cursor, and its error is raised again.
    A successful run that is repeated finds its log row and does nothing. Gives the row.
    """
    state, log, runs = paths
    name = f"{job_name}-{run_id}"
    if has_run(spark, runs, name):
        done = read_runs(spark, runs, RUN_ROW).where((F.col("run_id") == name) & (F.col("status") == "ok")).first()
        if done:
            return done.asDict()
    old = last_cursor(spark, runs, job_name)
    used, started, counters = None if old is None else old - lookback, now(), RunCounters()
    failed = None
    try:
        newest = counters.keep(dedupe_latest(counters.receive(read(used), time), keys, time, arrival))
        versioned_upsert(state, log, newest, keys, compare, schema, name, buckets, mark=counters.add)
        values = counters.values()
    except Exception as error:
        failed, values = error, {"api_rows": 0, "deduped": 0, "raw_new": 0, "norm_upserted": 0, "cursor_new": None}
    found = spark.createDataFrame(
        [(values["api_rows"], values["deduped"], values["raw_new"], values["norm_upserted"], old, used, values["cursor_new"] or old)],
        "api_rows bigint, deduped bigint, raw_new bigint, norm_upserted bigint, cursor_old timestamp, cursor_used timestamp, cursor_new timestamp",
    )
    row = run_log_row(
        found, job_name, name, "ok" if failed is None else "error", F.lit(started).cast("timestamp"), F.lit(now()).cast("timestamp"),
        None if failed is None else str(failed),
    ).select(*RUN_ROW.fieldNames())
    write_run(row.coalesce(1), runs, name)
    if failed is not None:
        raise failed
    return row.first().asDict() | {"run_id": name}
