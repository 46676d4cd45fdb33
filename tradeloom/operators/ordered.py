"""Ordered calculations within a key that may hold a large share of all rows.

A window over the whole key would put that key on one task. Here a heavy key, named by a
frequent-items sketch, is cut into ranges of its order. Bounds are whole order tuples taken
from a sample of the key, so ties of the leading column are cut as well. The window runs
inside a range; one small row a range carries what the ranges before it add up to, and it
comes back by an equality join. Rows are shuffled once, for the window. All other keys are
one range, and there is no other way beside this one.

Heavy keys, bounds and range totals are broadcast. There are at most ``1 / SHARE`` heavy keys
and ``RANGES`` ranges more than that, whatever the number of rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradeloom.operators.skew import HEAVY, heavy_keys, key_hash
from tradeloom.session import ensure_checkpoint_dir

RANGE, KEY = "__range", "__key"
#: ranges into which a key of all rows is cut; others by their share
RANGES = 4096
#: a range holds about so many rows at least
PER_RANGE = 1_000_000
#: sampled rows a range
SAMPLES = 16


def _ranged(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows in evenly filled partitions sorted by ``columns``: ``__part`` and ``__pos`` give the place.

    The result is kept in the checkpoint folder, so the sampled partition bounds are the
    same for everything read from it.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return (
        df.repartitionByRange(*_sort(columns))
        .sortWithinPartitions(*_sort(columns))
        .withColumn("__at", F.monotonically_increasing_id())
        .checkpoint()
        .withColumn("__part", F.shiftright("__at", 33))
        .withColumn("__pos", F.col("__at").bitwiseAND(F.lit((1 << 33) - 1)))
        .drop("__at")
    )


def _sort(order: Sequence[str]) -> list[Column]:
    """Sort columns by name; a name after ``-`` falls. Nulls come last either way."""
    return [F.col(c[1:]).desc_nulls_last() if c.startswith("-") else F.col(c).asc_nulls_last() for c in order]


def _place(order: Sequence[str]) -> Column:
    """The order columns as one value that compares like them, nulls last."""
    return F.struct(*[part.alias(f"p{i}") for i, part in enumerate(x for c in order for x in (F.col(c).isNull(), F.col(c)))])


def _bounds(df: DataFrame, keys: Sequence[str], order: Sequence[str], per_range: int) -> DataFrame:
    """Lower bounds of the ranges of each heavy key but its first: (``__heavy``, ``__bounds``, ``__steps``)."""
    most = F.ceil(F.col("heavy_rows") * F.lit(RANGES) / F.col("all_rows"))
    ranges = F.least(F.floor(F.col("heavy_rows") / F.lit(per_range)), most).cast("int")
    cut = heavy_keys(df, keys).withColumn("ranges", ranges).where("ranges > 1")
    cut = cut.withColumn("every", F.greatest(F.floor(F.col("heavy_rows") / (F.col("ranges") * SAMPLES)), F.lit(1)))
    rows = df.select(key_hash(keys).alias(HEAVY), _place(order).alias("place"), F.xxhash64(*order).alias("draw"))
    sample = rows.join(F.broadcast(cut), HEAVY).where(F.pmod("draw", "every") == 0)
    drawn = sample.groupBy(HEAVY).agg(F.array_sort(F.collect_list("place")).alias("drawn"), F.first("ranges").alias("ranges"))
    pick = lambda i: F.get("drawn", F.floor(i * F.size("drawn") / F.col("ranges")).cast("int"))
    bounds = F.array_distinct(F.transform(F.sequence(F.lit(1), F.col("ranges") - 1), pick))
    return drawn.select(HEAVY, bounds.alias("__bounds")).withColumn("__steps", F.ceil(F.log2(F.size("__bounds") + 1)).cast("int"))


def _in_ranges(df: DataFrame, keys: Sequence[str], order: Sequence[str], per_range: int) -> DataFrame:
    """The rows with ``__range``, 0 for keys that are not cut, and ``__key``, the hash of a key that is."""
    known = df.join(F.broadcast(_bounds(df, keys, order, per_range)), key_hash(keys) == F.col(HEAVY), "left")

    def step(at: Column, left: Column) -> Column:
        """One step of a binary search for the number of bounds that are not above the row."""
        next_at = at + F.pow(F.lit(2), left - 1).cast("int")
        return F.when(F.get("__bounds", next_at - 1) <= _place(order), next_at).otherwise(at)

    found = F.aggregate(F.sequence(F.col("__steps"), F.lit(1), F.lit(-1)), F.lit(0), step)
    ranged = known.withColumn(RANGE, F.when(F.col(HEAVY).isNull(), 0).otherwise(found))
    return ranged.withColumnRenamed(HEAVY, KEY).drop("__bounds", "__steps")


def _carried(rows: DataFrame, keys: Sequence[str], totals: Sequence[Column], carry: dict[str, Column]) -> DataFrame:
    """One row for each range of a cut key with what the ranges before it give."""
    ranges = rows.where(F.col(KEY).isNotNull()).groupBy(KEY, *keys, RANGE).agg(*totals)
    named = ranges.select(
        F.col(KEY).alias("__own_key"), F.col(RANGE).alias("__own_range"), *[F.col(k).alias(f"__k_{k}") for k in keys],
        *[c.alias(n) for n, c in carry.items()],
    )
    return F.broadcast(named)


def _rejoin(rows: DataFrame, carried: DataFrame, keys: Sequence[str]) -> DataFrame:
    on = (rows[KEY] == carried["__own_key"]) & (rows[RANGE] == carried["__own_range"])
    for k in keys:
        on = on & rows[k].eqNullSafe(carried[f"__k_{k}"])
    return rows.join(carried, on, "left").drop("__own_key", "__own_range", KEY, RANGE, *[f"__k_{k}" for k in keys])


def version_numbers(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    previous: dict[str, str] | None = None,
    number: str = "version_no",
    per_range: int = PER_RANGE,
) -> DataFrame:
    """Number the rows of each key by ``order`` and add previous values.

    ``previous`` maps a new column to the column whose previous value it takes. ``order``
    must be total within a key; null comes last.
    """
    previous = previous or {}
    rows = _in_ranges(df, keys, order, per_range)
    inside = Window.partitionBy(*keys, RANGE).orderBy(*_sort(order))
    marked = rows.withColumn(number, F.row_number().over(inside).cast("bigint"))
    for name, source in previous.items():
        marked = marked.withColumn(name, F.lag(source).over(inside))
    along = Window.partitionBy(KEY, *keys).orderBy(RANGE)
    totals, sources = [F.count(F.lit(1)).alias("__rows")], sorted(set(previous.values()))
    carry = {"__offset": F.sum("__rows").over(along.rowsBetween(Window.unboundedPreceding, -1))}
    if sources:
        totals.append(F.max_by(F.struct(*sources), _place(order)).alias("__last"))
        carry["__before"] = F.lag("__last").over(along)
    joined = _rejoin(marked, _carried(rows, keys, totals, carry), keys)
    for name, source in previous.items():
        joined = joined.withColumn(name, F.when(F.col(number) == 1, F.col("__before")[source]).otherwise(F.col(name)))
    return joined.withColumn(number, F.col(number) + F.coalesce("__offset", F.lit(0))).drop(*carry)


def running_total(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, name: str, per_range: int = PER_RANGE
) -> DataFrame:
    """Sum of ``value`` from the first row of the key to this row, inclusive; rows as in :func:`version_numbers`."""
    rows = _in_ranges(df, keys, order, per_range)
    inside = Window.partitionBy(*keys, RANGE).orderBy(*_sort(order)).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = rows.withColumn(name, F.sum(value).over(inside))
    before = Window.partitionBy(KEY, *keys).orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    carried = _carried(rows, keys, [F.sum(value).alias("__sum")], {"__offset": F.sum("__sum").over(before)})
    joined = _rejoin(summed, carried, keys)
    total = F.when(F.col(name).isNull(), F.col("__offset")).otherwise(F.col(name) + F.coalesce("__offset", F.lit(0)))
    return joined.withColumn(name, total).drop("__offset")


def dense_ordinal(df: DataFrame, columns: Sequence[str], name: str = "ordinal") -> DataFrame:
    """Number all rows 1..n by ``columns``, whatever their number and gaps; ``-name`` sorts down."""
    ranged = _ranged(df, columns)
    sizes = ranged.groupBy("__part").agg(F.count(F.lit(1)).alias("__rows"))
    # one row per partition of the range exchange
    before = Window.partitionBy(F.lit(0)).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("__part", F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__offset"))
    numbered = ranged.join(F.broadcast(offsets), "__part")
    return numbered.withColumn(name, F.col("__offset") + F.col("__pos") + 1).drop("__part", "__pos", "__offset")


def id_chunks(df: DataFrame, column: str, size: int) -> DataFrame:
    """Distinct sorted ids cut into chunks of ``size``: (id, ordinal, chunk)."""
    ids = df.select(column).where(F.col(column).isNotNull()).distinct()
    chunk = F.floor((F.col("ordinal") - 1) / F.lit(size)).cast("bigint")
    return dense_ordinal(ids, [column]).withColumn("chunk", chunk)
