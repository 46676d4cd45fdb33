"""Streaming queries: events read as a stream to its end, then the written table."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradeloom.bindings import load
from tradeloom.catalogue import query
from tradeloom.session import scratch_path
from tradeloom.sources.tables import read_runs, read_table
from tradeloom.streaming import streams

STATE = T.StructType(
    [
        T.StructField("user_id", T.LongType()),
        T.StructField("event_id", T.LongType()),
        T.StructField("status", T.StringType()),
        T.StructField("at", T.TimestampType()),
    ]
)


def _stream(spark, path, schema):
    return streams.with_event_time(streams.read_stream(spark, path, schema), "ts", F.col("ts").cast("timestamp"))


def _events(spark, sf_dir):
    # a pattern, because the stream source takes folders and patterns but no single file
    return _stream(spark, f"{sf_dir}/events.parque[t]", load(spark, sf_dir, "events").schema)


@query("stream_dedupe", "SELECT DISTINCT user_id, event_type FROM events")
def stream_dedupe(spark, sf_dir):
    """First event per user and type; the re-read window covers the whole log."""
    out, state = scratch_path(spark, "dedupe"), scratch_path(spark, "dedupe-state")
    unique = streams.dedupe_stream(_events(spark, sf_dir), ["user_id", "event_type"], "ts")
    streams.write_batches(unique, out, state).awaitTermination()
    return spark.read.parquet(out).select("user_id", "event_type")


def _upserted(spark, sf_dir):
    """Events landed in three parts by time; after each part the stream runs to its end and stops."""
    landed, state, log, checkpoint = (scratch_path(spark, n) for n in ("landed", "state", "log", "upsert-state"))
    table = load(spark, sf_dir, "events")
    borders = ["2000-01-01", "2024-01-11", "2024-01-21", "2100-01-01"]
    for since, until in zip(borders, borders[1:], strict=False):
        part = (F.col("ts") >= F.lit(since).cast("timestamp_ntz")) & (F.col("ts") < F.lit(until).cast("timestamp_ntz"))
        table.where(part).write.mode("append").parquet(landed)
        feed = _stream(spark, landed, table.schema)
        feed = feed.select("user_id", "event_id", F.col("event_type").alias("status"), F.col("ts").alias("at"))
        streams.upsert_stream(
            feed, state, log, checkpoint, ["user_id"], "at", ["event_id"], ["status"], STATE, buckets=4
        ).awaitTermination()
    return read_table(spark, state, STATE), read_runs(spark, log, STATE)


@query(
    "stream_upsert_state",
    "SELECT user_id, ARG_MAX(event_type, ts) AS status FROM events GROUP BY 1",
)
def stream_upsert_state(spark, sf_dir):
    """Last status per user after one micro-batch per landed part."""
    return _upserted(spark, sf_dir)[0].select("user_id", "status")


@query(
    "stream_upsert_log",
    """
    WITH b AS (SELECT *, CASE WHEN ts < TIMESTAMP '2024-01-11' THEN 0 WHEN ts < TIMESTAMP '2024-01-21' THEN 1 ELSE 2 END AS part FROM events),
    n AS (SELECT user_id, part, ARG_MAX(event_type, ts) AS status, ARG_MAX(event_id, ts) AS event_id FROM b GROUP BY 1, 2)
    SELECT user_id, event_id, status FROM (SELECT *, LAG(status) OVER (PARTITION BY user_id ORDER BY part) AS prev FROM n) WHERE prev IS DISTINCT FROM status
    """,
)
def stream_upsert_log(spark, sf_dir):
    """The versions the micro-batches appended: a part's last status that differs from the state before it."""
    return _upserted(spark, sf_dir)[1].select("user_id", "event_id", "status")


@query(
    "stream_hourly_counts",
    """
    SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M') AS hour, event_type, COUNT(*)::BIGINT AS rows FROM events
    WHERE date_trunc('hour', ts) + INTERVAL 1 HOUR <= (SELECT MAX(ts) FROM events) - INTERVAL 1 HOUR GROUP BY 1, 2
    """,
)
def stream_hourly_counts(spark, sf_dir):
    """Closed hours only: an hour is written once the watermark has passed it."""
    out, state = scratch_path(spark, "hourly"), scratch_path(spark, "hourly-state")
    counts = streams.hourly_counts(_events(spark, sf_dir), "ts", "event_type")
    streams.write_batches(counts, out, state).awaitTermination()
    return spark.read.parquet(out).select(F.date_format("hour", "yyyy-MM-dd HH:mm").alias("hour"), "event_type", "rows")
