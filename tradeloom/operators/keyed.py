"""Keyed tables: deduplicate, upsert, version log, replace, retention.

Every function takes the state as a DataFrame and returns the next state; writing
is left to :mod:`tradeloom.sources.tables`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradeloom.functions.jsonpath import canonical_json, payload_sha

RANK = "__rank"


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row of each key by ``order``, which must be total.

    The rank filter lets Spark keep one row per key before the exchange, so many
    copies of one key never meet in a task.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(RANK, F.row_number().over(window)).where(F.col(RANK) == 1).drop(RANK)


def has_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Drop rows with a null or empty key part."""
    for key in keys:
        df = df.where(F.col(key).isNotNull() & (F.col(key).cast("string") != ""))
    return df


def dedupe_latest(
    df: DataFrame,
    keys: Sequence[str],
    time: str | Sequence[str],
    arrival: Sequence[str],
    null_time: str = "drop",
) -> DataFrame:
    """Newest row per key; equal times keep the first arrival.

    The time of a row is its first filled ``time`` column. ``null_time="drop"`` ignores
    rows without a time, ``"oldest"`` keeps them as the oldest.
    """
    at = F.col(time) if isinstance(time, str) else F.coalesce(*time)
    rows = has_keys(df, keys)
    if null_time == "drop":
        rows = rows.where(at.isNotNull())
    order = [at.desc_nulls_last(), *[F.col(a).asc_nulls_last() for a in arrival]]
    return first_per_key(rows, keys, order)


def dedupe_metrics(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Received, unique and duplicate rows with the duplicate share in percent."""
    per_key = has_keys(df, keys).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    counts = per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("received"),
        F.count(F.lit(1)).cast("bigint").alias("unique_rows"),
    )
    duplicates = F.col("received") - F.col("unique_rows")
    # percent with two decimals, halves up, in whole numbers
    share = F.when(
        F.col("received") > 0,
        F.floor((duplicates * 20000 + F.col("received")) / (F.col("received") * 2)) / 100,
    ).otherwise(F.lit(0.0))
    return counts.withColumn("duplicates", duplicates).withColumn("dup_pct", share.cast("double"))


def latest_by(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Row with the greatest ``order`` per key."""
    return first_per_key(df, keys, [F.col(c).desc_nulls_last() for c in order])


def append_new(
    target: DataFrame, incoming: DataFrame, keys: Sequence[str], arrival: Sequence[str]
) -> DataFrame:
    """Incoming rows whose key the target lacks, first arrival of each key.

    Both sides are reduced to one row per key before they meet.
    """
    first = first_per_key(incoming, keys, [F.col(a).asc_nulls_last() for a in arrival])
    known = target.select(*keys).distinct()
    return first.join(known, list(keys), "left_anti").select(*incoming.columns)


def one_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column] | None = None) -> DataFrame:
    """First row of each filled key by ``order``, by default the values of all columns."""
    return first_per_key(has_keys(df, keys), keys, order or [F.col(f"`{c}`").asc_nulls_last() for c in df.columns])


def upsert(
    current: DataFrame, incoming: DataFrame, keys: Sequence[str], order: Sequence[Column] | None = None
) -> DataFrame:
    """Incoming rows replace current rows of the same key; keys absent from it stay.

    Rows without a key are left out, and of rows of one key the first by ``order`` counts
    (see :func:`one_per_key`).
    """
    incoming = one_per_key(incoming, keys, order)
    kept = current.join(incoming.select(*keys), list(keys), "left_anti").select(*current.columns)
    return kept.unionByName(incoming, allowMissingColumns=True)


def _differs(left: str, right: str, columns: Sequence[str]) -> Column:
    changed = F.lit(False)
    for c in columns:
        changed = changed | ~F.col(left)[c].eqNullSafe(F.col(right)[c])
    return changed


def compare_states(
    current: DataFrame, incoming: DataFrame, keys: Sequence[str], compare: Sequence[str]
) -> DataFrame:
    """One row per key with both sides and a verdict: new, changed, same or kept."""
    old = current.select(*keys, F.struct(*current.columns).alias("old"))
    new = incoming.select(*keys, F.struct(*incoming.columns).alias("new"))
    verdict = (
        F.when(F.col("new").isNull(), "kept")
        .when(F.col("old").isNull(), "new")
        .when(_differs("old", "new", compare), "changed")
        .otherwise("same")
    )
    return old.join(new, list(keys), "full").withColumn("verdict", verdict)


def upsert_changed(
    current: DataFrame, incoming: DataFrame, keys: Sequence[str], compare: Sequence[str]
) -> DataFrame:
    """Upsert that leaves a row alone when its ``compare`` columns did not change."""
    wins = F.col("verdict").isin("new", "changed")
    picked = F.when(wins, F.col("new")).otherwise(F.col("old"))
    return compare_states(current, incoming, keys, compare).select(picked.alias("row")).select("row.*")


def seen_in_run(state: DataFrame, incoming: DataFrame, keys: Sequence[str], run_id: str) -> DataFrame:
    """Record the last run in which each key arrived, to tell vanished rows apart."""
    seen = incoming.select(*keys, F.lit(run_id).alias("__seen")).distinct()
    joined = state.join(seen, list(keys), "left")
    previous = F.col("last_seen_run") if "last_seen_run" in state.columns else F.lit(None).cast("string")
    return joined.withColumn("last_seen_run", F.coalesce("__seen", previous)).drop("__seen")


def append_versions(
    current: DataFrame, incoming: DataFrame, keys: Sequence[str], compare: Sequence[str]
) -> DataFrame:
    """Version rows of one batch: keys that are new or differ from the current state.

    A return to an older payload is a new event, because only the current state is
    compared.
    """
    old = current.select(*keys, F.struct(*compare).alias("old"))
    new = incoming.withColumn("new", F.struct(*compare))
    return (
        new.join(old, list(keys), "left")
        .where(F.col("old").isNull() | _differs("old", "new", compare))
        .select(*incoming.columns)
    )


def rebuild_versions(log: DataFrame, replay: DataFrame, run_id: str, run_column: str = "run_id") -> DataFrame:
    """The log with all rows of one run replaced by its replay."""
    kept = log.where(~F.col(run_column).eqNullSafe(F.lit(run_id)))
    return kept.unionByName(replay.withColumn(run_column, F.lit(run_id)))


def seed_versions(log: DataFrame, current: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A first version for every current key that has none."""
    return current.join(log.select(*keys).distinct(), list(keys), "left_anti").select(*current.columns)


def replace_slice(table: DataFrame, rows: DataFrame, column: str, value: object) -> DataFrame:
    """The table with the slice ``column = value`` replaced by ``rows``."""
    kept = table.where(~F.col(column).eqNullSafe(F.lit(value)))
    return kept.unionByName(rows.withColumn(column, F.lit(value)).select(*table.columns))


def append_snapshot(rows: DataFrame, snapped_at: Column) -> DataFrame:
    """Rows stamped with the snapshot time and its date, the partition of the table."""
    return rows.withColumn("snapped_at", snapped_at).withColumn("snapped_on", F.to_date("snapped_at"))


def retain(df: DataFrame, time: str, as_of: Column, days: int) -> DataFrame:
    """Rows not older than ``days`` before ``as_of``; rows without a time stay."""
    limit = as_of - F.make_dt_interval(days=F.lit(days))
    return df.where(F.col(time).isNull() | (F.col(time) >= limit))


def with_fingerprint(df: DataFrame, payload: str = "payload") -> DataFrame:
    """Canonical payload text and its SHA-256, so later steps compare the hash only."""
    return df.withColumn(payload, canonical_json(payload)).withColumn("payload_sha256", payload_sha(payload))


def backfill(df: DataFrame, parsed: dict[str, Column]) -> DataFrame:
    """Typed columns filled from the payload; an unreadable value keeps the old one."""
    return df.withColumns({name: F.coalesce(value, F.col(name)) for name, value in parsed.items()})


def update_from(base: DataFrame, source: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Take ``columns`` from a unique-keyed source where it has a value."""
    s = source.select(*keys, *[F.col(c).alias(f"__new_{c}") for c in columns])
    joined = base.join(s, list(keys), "left")
    updated = joined.withColumns({c: F.coalesce(F.col(f"__new_{c}"), F.col(c)) for c in columns})
    return updated.select(*base.columns)


def changed_sources(now: DataFrame, stored: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Sources to load: never seen, other digest, or empty before and filled now.

    Both sides carry ``file_sha256`` and ``row_count``; ``stored`` also ``loaded_at``
    and ``id``.
    """
    last = latest_by(stored, keys, ["loaded_at", "id"]).select(
        *keys, F.col("file_sha256").alias("__sha"), F.col("row_count").alias("__rows")
    )
    filled = (F.coalesce("__rows", F.lit(0)) == 0) & (F.col("row_count") > 0)
    test = F.col("__sha").isNull() | (F.col("__sha") != F.col("file_sha256")) | filled
    return now.join(last, list(keys), "left").where(test).select(*now.columns)


def prefer_primary(primary: DataFrame, secondary: DataFrame, block: str) -> DataFrame:
    """Primary rows, and secondary rows of the blocks the primary lacks."""
    missing = secondary.join(primary.select(block).distinct(), block, "left_anti")
    return primary.unionByName(missing.select(*primary.columns))
