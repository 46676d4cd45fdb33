"""Keys that hold a large share of the rows, and joins that spread them.

A frequent-items sketch names such keys in one aggregate pass. It keeps ``TRACKED`` items,
so it misses no key above a few times ``1 / TRACKED`` of the rows, and what it names is at
most ``1 / SHARE`` keys: the only thing that is broadcast. Sketches are merged in two steps,
so that no task receives one from every task before it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SALT, HEAVY = "__salt", "__heavy"
TRACKED = 16_384
BRANCHES = 64
#: a key with this share of the rows counts as heavy
SHARE = 1 / 1024
#: tasks over which a key of all rows is spread; others by their share
SALTS = 1024


def key_hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(*keys)


def heavy_keys(df: DataFrame, keys: Sequence[str], share: float = SHARE) -> DataFrame:
    """Hashes of the heavy keys with their rows and all rows: (``__heavy``, ``heavy_rows``, ``all_rows``).

    At most ``1 / share`` rows. Null is a key like any other.
    """
    items = df.select(key_hash(keys).alias("item"), F.pmod(F.spark_partition_id(), F.lit(BRANCHES)).alias("branch"))
    sketches = items.groupBy("branch").agg(
        F.expr(f"approx_top_k_accumulate(item, {TRACKED})").alias("sketch"), F.count(F.lit(1)).alias("rows")
    )
    # grouped, because an empty table has no sketch to merge
    merged = sketches.groupBy(F.col("branch").isNull().alias("none")).agg(F.expr(f"approx_top_k_combine(sketch, {TRACKED})").alias("sketch"), F.sum("rows").alias("rows"))
    top = F.expr(f"approx_top_k_estimate(sketch, {int(1 / share)})")
    found = merged.select("rows", F.explode(top).alias("top"))
    return found.where(F.col("top.count") >= F.col("rows") * share).select(
        F.col("top.item").alias(HEAVY), F.col("top.count").alias("heavy_rows"), F.col("rows").alias("all_rows")
    )


def salted_join(
    rows: DataFrame,
    lookup: DataFrame,
    keys: Sequence[str],
    salt_by: Column,
    how: str = "left",
    heavy: DataFrame | None = None,
) -> DataFrame:
    """Join rows to a lookup that has few rows per key; only heavy keys are spread over several tasks.

    ``heavy`` are the heavy keys of the rows, found here if not given. Lookup rows of a heavy
    key are repeated once for each of its salts, all others stay as they are, so the lookup
    grows by at most ``SALTS`` rows and one for each heavy key, times its rows per key.
    """
    heavy = heavy_keys(rows, keys) if heavy is None else heavy
    salts = F.ceil(F.col("heavy_rows") * F.lit(SALTS) / F.col("all_rows")).cast("int")
    spread = F.broadcast(heavy.select(HEAVY, salts.alias("__salts")))
    own = F.when(F.col("__salts").isNull(), 0).otherwise(F.pmod(F.xxhash64(salt_by), F.col("__salts"))).cast("int")
    salted = rows.join(spread, key_hash(keys) == F.col(HEAVY), "left").withColumn(SALT, own).drop(HEAVY, "__salts")
    copies = F.sequence(F.lit(0), F.coalesce(F.col("__salts"), F.lit(1)) - 1)
    repeated = lookup.join(spread, key_hash(keys) == F.col(HEAVY), "left").withColumn(SALT, F.explode(copies))
    return salted.join(repeated.drop(HEAVY, "__salts"), [*keys, SALT], how).drop(SALT)
