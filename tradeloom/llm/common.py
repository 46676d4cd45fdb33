"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeloom.session import ensure_checkpoint_dir, scratch_path

BLOCK_BYTES = 2 << 20
BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def bound_batches(spark: SparkSession) -> None:
    """Arrow batches of ``BLOCK_BYTES`` from Spark to the workers, unless the session says otherwise.

    The default counts records only up to a large size, so batches of long texts would
    take much memory on both sides.
    """
    if spark.conf.get(BATCH_SETTING, None) is None:
        spark.conf.set(BATCH_SETTING, str(BLOCK_BYTES))


CACHES: dict[str, Callable[[], None]] = {}


def begin(owner: str) -> None:
    """Empty what the tasks of other operators have remembered in this worker."""
    for name, clear in CACHES.items():
        if name != owner:
            clear()


def give_back() -> None:
    """Return freed memory to the system, so that a reused worker starts its next task small."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], owner: str) -> Callable:
    """The function of a task, which holds no memory of other operators' tasks and leaves none of its own."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin(owner)
        try:
            yield from run(batches)
        finally:
            give_back()

    return task


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    bound_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """The rows as a checkpoint in the shared folder, so that later jobs start from files."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def narrow(df: DataFrame, *columns: str) -> DataFrame:
    """The named columns only; every other column, whatever its name, is left out."""
    return df.select(*[F.col(f"`{c}`") for c in columns])


def blocks(sizes: Sequence[int], limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Consecutive row ranges of at most ``limit`` bytes; a larger row is a range of its own.

    Bounds the working memory of array code, whatever the length of a batch of texts.
    """
    start, total = 0, 0
    for i, size in enumerate(sizes):
        if i > start and total + size > limit:
            yield start, i
            start, total = i, 0
        total += size
    if start < len(sizes):
        yield start, len(sizes)


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut by the bytes of a column, so that only so much is held as Python objects at once."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        for a, b in blocks(sizes, limit):
            yield batch.slice(a, b - a)


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """Texts of a batch; null is the empty text."""
    return [x or "" for x in batch.column(column).to_pylist()]


def stored(df: DataFrame, label: str, options: dict[str, str] | None = None) -> DataFrame:
    """The rows as a Parquet table in the shared folder, written with the options.

    Unlike a checkpoint it keeps no partitioning, so a join with it exchanges both sides
    and the adaptive skew rule can split a hot key.
    """
    bound_batches(df.sparkSession)
    path = scratch_path(df.sparkSession, label)
    df.write.options(**options or {}).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
