"""The incremental operators on Structured Streaming.

State survives lost executors in the checkpoint folder; every sink partitions by
batch id, so a repeated batch replaces its own output.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tradeloom.operators.keyed import dedupe_latest
from tradeloom.sources.tables import versioned_upsert, write_slice

REREAD_WINDOW = "31 days"


def read_stream(spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def dedupe_stream(df: DataFrame, keys: Sequence[str], time: str, window: str = REREAD_WINDOW) -> DataFrame:
    """First row of each key; repeats inside the re-read window are dropped."""
    return df.withWatermark(time, window).dropDuplicatesWithinWatermark(list(keys))


def hourly_counts(df: DataFrame, time: str, by: str, late: str = "1 hour") -> DataFrame:
    """Rows per hour and value of ``by``."""
    return (
        df.withWatermark(time, late)
        .groupBy(F.window(time, "1 hour").alias("hour"), by)
        .agg(F.count(F.lit(1)).alias("rows"))
        .select(F.col("hour.start").alias("hour"), by, "rows")
    )


def write_batches(df: DataFrame, path: str, checkpoint: str, output_mode: str = "append") -> StreamingQuery:
    """Every micro-batch as its own partition of a parquet table."""
    def write(batch: DataFrame, batch_id: int) -> None:
        write_slice(batch.withColumn("batch_id", F.lit(batch_id)), path, "batch_id")

    return (
        df.writeStream.outputMode(output_mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(write)
        .start()
    )


def upsert_stream(
    df: DataFrame,
    state_path: str,
    log_path: str,
    checkpoint: str,
    keys: Sequence[str],
    time: str,
    arrival: Sequence[str],
    compare: Sequence[str],
    schema: T.StructType,
    buckets: int = 16,
) -> StreamingQuery:
    """Keep the current state and the version log of a keyed feed up to date."""
    def merge(batch: DataFrame, batch_id: int) -> None:
        newest = dedupe_latest(batch, keys, time, arrival, null_time="oldest")
        versioned_upsert(state_path, log_path, newest, keys, compare, schema, f"batch-{batch_id:012d}", buckets)

    return (
        df.writeStream.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(merge)
        .start()
    )


def with_event_time(df: DataFrame, time: str, as_utc: Column) -> DataFrame:
    """Streams need TIMESTAMP event time; TIMESTAMP_NTZ columns are replaced."""
    return df.withColumn(time, as_utc)
