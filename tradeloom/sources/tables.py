"""Keyed tables on plain parquet folders.

A current-state table is partitioned by a hash bucket of its key. An upsert writes the
buckets it touches, one file each, as a new generation ``generation=N/key_bucket=B``; the
``_SUCCESS`` file that Spark writes last commits it. Readers take of every bucket the newest
committed generation, so a job that dies at any point leaves the state before it, and
nothing is deleted while it can be read. ``vacuum`` removes what no reader needs.

A log has a folder for each run, committed in the same way. There is one writer at a time.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from tradeloom.operators import keyed
from tradeloom.session import ensure_checkpoint_dir

BUCKET = "key_bucket"


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A table of any layout, or an empty frame of its schema when nothing was written yet."""
    if _listed(spark, f"{path}/generation=*"):
        return read_generations(spark, path, schema)
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return spark.createDataFrame([], schema)


def write_slice(df: DataFrame, path: str, column: str) -> None:
    """Replace exactly the partitions of ``column`` present in ``df``."""
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(column)
        .parquet(path)
    )


def append_rows(df: DataFrame, path: str, partition: str | None = None) -> None:
    writer = df.write.mode("append")
    (writer.partitionBy(partition) if partition else writer).parquet(path)


def _listed(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a pattern, in whatever store the table is."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sorted(str(s.getPath()) for s in fs.globStatus(at) or [])


def _delete(spark: SparkSession, path: str) -> None:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def _generation(path: str) -> int:
    return int(path.rsplit("generation=", 1)[1].split("/", 1)[0])


def committed(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the complete generations of a table, ascending."""
    return [_generation(p) for p in _listed(spark, f"{path}/generation=*/_SUCCESS")]


def next_generation(spark: SparkSession, path: str) -> int:
    """A number above those of all generations, complete or not."""
    return max([_generation(p) for p in _listed(spark, f"{path}/generation=*")], default=0) + 1


def _folder(path: str, generation: int) -> str:
    return f"{path}/generation={generation:012d}"


def write_generation(df: DataFrame, path: str, by: str) -> int:
    """Write the partitions of ``by`` in ``df`` as a new generation, one file each; gives its number."""
    number = next_generation(df.sparkSession, path)
    df.repartition(by).write.mode("error").partitionBy(by).parquet(_folder(path, number))
    return number


def newest_folders(spark: SparkSession, path: str, by: str, as_of: int | None = None) -> dict[str, str]:
    """Value of ``by`` to the folder of its newest complete generation (up to ``as_of``)."""
    done = {n for n in committed(spark, path) if as_of is None or n <= as_of}
    folders = [f for f in _listed(spark, f"{path}/generation=*/{by}=*") if _generation(f) in done]
    return {f.rsplit("=", 1)[1]: f for f in sorted(folders, key=_generation)}


def read_generations(
    spark: SparkSession, path: str, schema: T.StructType, by: str = BUCKET, only: Sequence[object] | None = None, as_of: int | None = None
) -> DataFrame:
    """The table as its newest complete generations give it; empty when nothing was written yet.

    ``only`` names the partitions to read, ``as_of`` a generation whose state is wanted.
    """
    folders = newest_folders(spark, path, by, as_of)
    wanted = list(folders.values()) if only is None else [folders[str(v)] for v in only if str(v) in folders]
    if not wanted:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(*wanted).select(*schema.fieldNames())


def vacuum(spark: SparkSession, path: str, by: str = BUCKET, keep: int = 2) -> int:
    """Delete what the newest ``keep`` states do not use and what older dead writes left; gives the deleted folders."""
    done = committed(spark, path)
    if not done:
        return 0
    used = {f for n in done[-keep:] for f in newest_folders(spark, path, by, n).values()}
    kept = {_generation(f) for f in used} | set(done[-keep:])
    gone = [f for f in _listed(spark, f"{path}/generation=*") if _generation(f) not in kept and _generation(f) < done[-1]]
    gone += [f for f in _listed(spark, f"{path}/generation=*/{by}=*") if f not in used and _generation(f) in kept and _generation(f) in done]
    for folder in gone:
        _delete(spark, folder)
    return len(gone)


def replace_all(df: DataFrame, path: str, generation: int | None = None) -> int:
    """Write a whole table as a new generation; readers switch when it is complete.

    A number that is already complete is not written again, as it may be what ``df`` reads;
    the next free one is taken. Gives the number used.
    """
    spark = df.sparkSession
    if generation is None or generation in committed(spark, path):
        generation = next_generation(spark, path)
    df.write.mode("overwrite").parquet(_folder(path, generation))
    return generation


def read_newest(spark: SparkSession, path: str) -> DataFrame:
    """The newest complete generation of a replaced table."""
    done = committed(spark, path)
    if not done:
        raise FileNotFoundError(path)
    return spark.read.parquet(_folder(path, done[-1]))


def _run_folder(path: str, run_id: str) -> str:
    return f"{path}/run_id={quote(run_id, safe=' -_.')}"


def write_run(df: DataFrame, path: str, run_id: str) -> None:
    """Write the log of a run; what a dead attempt left of it is replaced."""
    df.write.mode("overwrite").parquet(_run_folder(path, run_id))


def has_run(spark: SparkSession, path: str, run_id: str) -> bool:
    return bool(_listed(spark, f"{_run_folder(path, run_id)}/_SUCCESS"))


def read_runs(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The complete runs of a log, with ``run_id``; empty when nothing was written yet."""
    logged = T.StructType([*schema.fields, T.StructField("run_id", T.StringType())])
    done = [p.rsplit("/", 1)[0] for p in _listed(spark, f"{path}/run_id=*/_SUCCESS")]
    if not done:
        return spark.createDataFrame([], logged)
    return spark.read.schema(logged).option("basePath", path).parquet(*done)


def bucket_of(keys: Sequence[str], buckets: int):
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def _touched(
    path: str, incoming: DataFrame, keys: Sequence[str], schema: T.StructType, buckets: int
) -> tuple[DataFrame, DataFrame]:
    """The batch with its buckets, kept in the checkpoint folder, and the state of those buckets."""
    spark = incoming.sparkSession
    ensure_checkpoint_dir(spark)
    batch = keyed.one_per_key(incoming.select(*schema.fieldNames()), keys).withColumn(BUCKET, bucket_of(keys, buckets)).checkpoint()
    # at most ``buckets`` values
    touched = [row[0] for row in batch.select(BUCKET).distinct().collect()]
    stored = T.StructType([*schema.fields, T.StructField(BUCKET, T.IntegerType())])
    return batch, read_generations(spark, path, stored, BUCKET, touched)


def _merge(
    path: str, batch: DataFrame, state: DataFrame, keys: Sequence[str], compare: Sequence[str] | None
) -> None:
    if compare is None:
        merged = keyed.upsert(state, batch, keys)
    else:
        merged = keyed.upsert_changed(state, batch, keys, compare)
    write_generation(merged, path, BUCKET)


def upsert_table(
    path: str,
    incoming: DataFrame,
    keys: Sequence[str],
    schema: T.StructType,
    buckets: int = 64,
    compare: Sequence[str] | None = None,
) -> None:
    """Upsert rows into a bucketed table, rewriting touched buckets only.

    Rows without a key are left out, and of rows of one key the first by all columns
    counts; a batch with a time is brought to its newest rows before (``dedupe_latest``).
    Repeating a batch gives the same table, so a failed write is simply run again. Choose
    ``buckets`` so that one bucket of the table stays a few hundred megabytes. Call ``vacuum``
    from time to time.
    """
    batch, state = _touched(path, incoming, keys, schema, buckets)
    _merge(path, batch, state, keys, compare)


def versioned_upsert(
    state_path: str,
    log_path: str,
    incoming: DataFrame,
    keys: Sequence[str],
    compare: Sequence[str],
    schema: T.StructType,
    run_id: str,
    buckets: int = 64,
    mark: Callable[[DataFrame], DataFrame] | None = None,
) -> None:
    """Append the run's versions, then upsert the current state.

    ``mark`` is given the versions before they are written, to observe them.

    The log is written before the state. If the job dies in between, the repeated run
    finds its complete log and keeps it, because the state may already hold the new rows.
    """
    batch, state = _touched(state_path, incoming, keys, schema, buckets)
    if not has_run(incoming.sparkSession, log_path, run_id):
        versions = keyed.append_versions(state, batch, keys, compare).drop(BUCKET)
        write_run(versions if mark is None else mark(versions), log_path, run_id)
    _merge(state_path, batch, state, keys, compare)


def drop_old_partitions(spark: SparkSession, path: str, column: str, keep_from: str) -> int:
    """Delete date partitions older than ``keep_from`` of an append-only table."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    folder = hadoop.Path(path)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    dropped = 0
    for status in fs.globStatus(hadoop.Path(f"{path}/{column}=*")) or []:
        if status.getPath().getName().split("=", 1)[1] < keep_from:
            fs.delete(status.getPath(), True)
            dropped += 1
    return dropped
