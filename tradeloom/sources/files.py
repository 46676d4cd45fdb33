"""Files as data: newest file, digests, kept originals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def list_files(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """(path, modificationTime, length) of matching files; contents are not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
    return files.select("path", "modificationTime", "length")


def latest_file(spark: SparkSession, folder: str, patterns: Sequence[str], preferred: bool = False) -> DataFrame:
    """Newest file of all patterns, or of the first pattern that matches when ``preferred``."""
    files = None
    for rank, pattern in enumerate(patterns):
        part = list_files(spark, folder, pattern).withColumn("rank", F.lit(rank if preferred else 0))
        files = part if files is None else files.unionByName(part)
    return files.orderBy("rank", F.col("modificationTime").desc(), "path").limit(1).drop("rank")


def file_digests(spark: SparkSession, path: str) -> DataFrame:
    """SHA-256 and size per file."""
    files = spark.read.format("binaryFile").load(path)
    return files.select("path", "length", F.sha2("content", 256).alias("file_sha256"))


def keep_originals(spark: SparkSession, path: str, report_code: str) -> DataFrame:
    """File bytes under a report code, to be written with ``write_slice``."""
    files = spark.read.format("binaryFile").load(path)
    return files.select(
        F.lit(report_code).alias("report_code"), F.element_at(F.split("path", "/"), -1).alias("file_name"),
        "content", F.sha2("content", 256).alias("file_sha256"),
    )
