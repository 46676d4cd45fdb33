"""Landed API pages and record lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradeloom.sources.delimited import file_lines

PAGE_SCHEMA = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("page_no", T.LongType()),
        T.StructField("method", T.StringType()),
        T.StructField("request", T.StringType()),
        T.StructField("status_code", T.IntegerType()),
        T.StructField("payload", T.StringType()),
        T.StructField("payload_sha256", T.StringType()),
        T.StructField("duration_ms", T.LongType()),
        T.StructField("attempt", T.IntegerType()),
        T.StructField("error", T.StringType()),
    ]
)


def read_api_pages(
    spark: SparkSession, path: str, method: str | None = None, run_id: str | None = None, fmt: str = "parquet"
) -> DataFrame:
    """Landed pages, narrowed to one method and one run when given."""
    pages = spark.read.schema(PAGE_SCHEMA).format(fmt).load(path)
    if method is not None:
        pages = pages.where(F.col("method") == method)
    if run_id is not None:
        pages = pages.where(F.col("run_id") == run_id)
    return pages


def read_landing(spark: SparkSession, path: str) -> DataFrame:
    """A list of records, one JSON object per line: (file, row_number, payload).

    ``row_number`` is the line's place in its file, however the file is split, so that the
    first arrival of a key is the same in every run. Lines that are not objects are dropped.
    """
    lines = file_lines(spark, path).withColumnRenamed("value", "payload")
    return lines.where(F.ltrim("payload").startswith("{"))


def explode_pages(pages: DataFrame, array_path: str, carry: dict[str, str] | None = None) -> DataFrame:
    """Records of the array at ``array_path`` of each page, in page and array order.

    ``carry`` copies page-level values into the records (column name to JSON path).
    Elements that are not objects are dropped.
    """
    raw = F.get_json_object("payload", array_path)
    records = F.when(raw.startswith("["), F.from_json(raw, "array<string>"))
    carried = {name: F.get_json_object("payload", path) for name, path in (carry or {}).items()}
    return (
        pages.select("run_id", "page_no", *[c.alias(n) for n, c in carried.items()], F.posexplode(records).alias("position", "record"))
        .where(F.ltrim("record").startswith("{"))
        .withColumnRenamed("record", "payload")
    )


def flatten_campaigns(pages: DataFrame) -> DataFrame:
    """Campaign groups to campaigns with the status and type of their group."""
    shape = "array<struct<status string, type string, advert_list array<string>>>"
    groups = pages.select(F.explode(F.from_json(F.get_json_object("payload", "$.adverts"), shape)).alias("g"))
    ads = groups.select(F.col("g.status"), F.col("g.type"), F.explode("g.advert_list").alias("payload"))
    campaign = F.get_json_object("payload", "$.advertId").try_cast("bigint")
    return ads.select(
        campaign.alias("advert_id"),
        F.col("status").try_cast("int").alias("status"),
        F.col("type").try_cast("int").alias("type"),
        F.get_json_object("payload", "$.changeTime").try_cast("timestamp").alias("change_time"),
        "payload",
    ).where(F.coalesce(F.col("advert_id"), F.lit(0)) != 0)


def in_period(df: DataFrame, time: str, date_from: Column, date_to: Column) -> DataFrame:
    """Rows from 00:00 of the first day to 23:59:59 of the last."""
    return df.where((F.col(time) >= date_from) & (F.col(time) < F.date_add(date_to, 1)))


def union_sources(frames: Sequence[DataFrame]) -> DataFrame:
    """Several sources of one entity in the given order, with the source number."""
    result = frames[0].withColumn("source_no", F.lit(0))
    for number, frame in enumerate(frames[1:], start=1):
        result = result.unionByName(frame.withColumn("source_no", F.lit(number)), allowMissingColumns=True)
    return result
