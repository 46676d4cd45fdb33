"""Session builder and the shared working folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(
    app_name: str = "tradeloom",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Session with UTC dates, ANSI SQL and adaptive execution.

    On a cluster leave ``shuffle_partitions`` unset and let AQE coalesce from a
    high initial number; local runs pass their core count.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "4000",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.sql.streaming.stateStore.providerClass": (
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
        ),
        "spark.ui.enabled": "false",
        METHOD_SETTING: METHOD_BYTES,
    }
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
        settings["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


#: generated methods above this size are left to the interpreter by HotSpot
METHOD_SETTING, METHOD_BYTES = "spark.sql.codegen.hugeMethodLimit", "8000"


def limit_methods(spark: SparkSession) -> None:
    """Let wide projections run as several methods that HotSpot compiles, unless the session has a limit of its own.

    A projection of dozens of parsers becomes one generated method of more than 8,000 bytes,
    which is never compiled. With the limit Spark takes its path of split methods instead.
    """
    if spark.conf.get(METHOD_SETTING, None) in (None, "65535"):
        spark.conf.set(METHOD_SETTING, METHOD_BYTES)


def is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only a local master may go without it; then a folder of this process is used.
    """
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not is_local(spark):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    folder = os.environ.get("TRADELOOM_LOCAL_WORK")
    if not folder:
        folder = tempfile.mkdtemp(prefix="tradeloom-")
        os.environ["TRADELOOM_LOCAL_WORK"] = folder
    return folder


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Make ``DataFrame.checkpoint`` usable and return the folder."""
    folder = shared_folder(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder for one table of one run."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
