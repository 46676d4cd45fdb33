"""Bring a published table up to date with the fewest row changes.

Both sides are DataFrames with a unique ``position`` (row number below the header)
and the same cell columns. The key is the first ``key_columns`` cells, compared by
normalized text; rows with an empty key part never match.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradeloom.functions.dates import month_start_back
from tradeloom.functions.text import normalize_cell
from tradeloom.operators.keyed import first_per_key
from tradeloom.operators.ordered import dense_ordinal, version_numbers
from tradeloom.session import ensure_checkpoint_dir
from tradeloom.sources.tables import replace_all


@dataclass(frozen=True)
class BlockSpec:
    """One published block: headers, formats, source columns, order, and how its rows are matched.

    ``sort`` names columns of the source, falling ones after ``-``; ``months`` is the default
    period: so many months before the current one, up to today.
    """

    name: str
    headers: tuple[str, ...]
    formats: tuple[str, ...]
    columns: tuple[str, ...]
    sort: tuple[str, ...]
    key_columns: int = 1
    mode: str = "upsert"
    replace_on_order_change: bool = False
    months: int | None = None


# Headers and number formats of the published blocks.
BLOCKS = {
    spec.name: spec
    for spec in (
        BlockSpec(
            "orders", ("Дата", "Артикул", "Кол-во", "Сумма"), ("date", "text", "int", "money"),
            ("order_date", "article", "quantity", "amount"), ("-order_date", "-newest", "article"), 2, months=2,
        ),
        BlockSpec(
            "placement",
            ("Артикул", "Платно, шт", "Платно, л", "Списано в день, RUB", "Дней до первой платности"),
            ("text", "int", "volume", "money", "int"),
            ("article", "paid_qty", "paid_liters", "daily_writeoff_rub", "days_until_first_paid"), ("article",),
        ),
        BlockSpec("erp-sales", ("Артикул", "Кол-во"), ("text", "int"), ("article", "sales_count"), ("article",)),
        BlockSpec("source-cost", ("Артикул", "С/с BYN"), ("text", "money"), ("article", "unit_cost_byn"), ("article",)),
        BlockSpec(
            "production-inventory",
            ("Артикул", "СМП", "ОСН", "СОХ", "СВХ", "ТС"),
            ("text", "quantity", "quantity", "quantity", "quantity", "quantity"),
            ("article", "smp_qty", "osn_qty", "soh_qty", "svh_qty", "ts_qty"), ("article",),
        ),
        BlockSpec(
            "supply-pipeline",
            ("Артикул", "СОГЛ Заказа", "В ПРОИЗВ", "ГОТОВ", "В ПУТИ", "МИНСК"),
            ("text", "int", "int", "int", "int", "date"),
            ("article", "approved_order_qty", "in_production_qty", "ready_qty", "in_way_qty", "minsk_date"), ("article",),
        ),
        BlockSpec(
            "supply-order-specs", ("Артикул", "LOT", "Дата производства"), ("text", "text", "date"),
            ("article", "specification", "production_date"), ("source_sheet", "source_row_number", "article"), 3,
        ),
    )
}


def number_text(value: Column, scale: int) -> Column:
    """Rounded half up; whole numbers without a fraction, others without trailing zeros."""
    rounded = F.round(value.cast(f"decimal(28,{scale + 2})"), scale).cast(f"decimal(28,{scale})")
    return F.regexp_replace(F.regexp_replace(rounded.cast("string"), r"(\.[0-9]*?)0+$", "$1"), r"\.$", "")


def shape_cell(value: Column, kind: str) -> Column:
    """Typed value to the text a published cell shows; null is empty text."""
    if kind == "date":
        text = F.date_format(value, "dd.MM.yyyy")
    elif kind == "money":
        text = number_text(value, 2)
    elif kind == "volume":
        text = number_text(value, 3)
    elif kind == "quantity":
        text = F.nullif(number_text(value, 3), F.lit("0"))
    else:
        text = value.cast("string")
    return F.coalesce(text, F.lit(""))


def shape_for_publish(df: DataFrame, columns: Sequence[str], block: BlockSpec) -> DataFrame:
    """Cells ``c1..cn`` of a block from typed columns; other columns pass through."""
    cells = {
        f"c{i}": shape_cell(F.col(c), kind)
        for i, (c, kind) in enumerate(zip(columns, block.formats, strict=True), start=1)
    }
    rest = [c for c in df.columns if c not in columns]
    return df.withColumns(cells).select(*rest, *cells)


def default_period(block: BlockSpec, today: Column) -> tuple[Column, Column] | None:
    """First and last day that a block shows when none are asked for."""
    return None if block.months is None else (month_start_back(today, block.months), today)


def block_rows(df: DataFrame, block: BlockSpec, limit: int | None = None) -> DataFrame:
    """The target of a block: (position, c1..cn) in the block's order, the first ``limit`` rows of it if given."""
    rows = dense_ordinal(df.select(*dict.fromkeys([*block.columns, *[c.removeprefix("-") for c in block.sort]])), block.sort, name="position")
    rows = rows if limit is None else rows.where(F.col("position") <= limit)
    return shape_for_publish(rows.select("position", *block.columns), block.columns, block)


def _side(df: DataFrame, cells: Sequence[str], key_columns: int, alone: Column) -> DataFrame:
    """Rows with normalized cells and what they match by: their key, or ``alone`` if a key part is empty."""
    normal = df.select("position", F.struct(*cells).alias("cells"), *[normalize_cell(F.col(c)).alias(c) for c in cells])
    valid = F.lit(True)
    for c in cells[:key_columns]:
        valid = valid & (F.col(c) != "")
    own = F.when(valid, F.lit(0)).otherwise(alone).cast("bigint").alias("alone")
    return normal.select("position", "cells", F.struct(*cells).alias("normal"), F.struct(*cells[:key_columns], own).alias("match"))


def _sides(existing: DataFrame, target: DataFrame, cells: Sequence[str], key_columns: int) -> tuple[DataFrame, DataFrame]:
    # rows without a key have numbers of their own on either side, so that they meet no row at all
    own = F.abs("position") + 1
    return _side(existing, cells, key_columns, -own), _side(target, cells, key_columns, own)


def classify_rows(
    existing: DataFrame, target: DataFrame, cells: Sequence[str], key_columns: int = 1
) -> DataFrame:
    """Every target row as unchanged, changed or appended, and every stale existing key.

    Columns: action, position (of the target, null for stale), row_number (of the
    existing row, null for appended), cells. One full join of the existing rows, reduced to
    the first of each key, with the target rows.
    """
    old, new = _sides(existing, target, cells, key_columns)
    old = old.groupBy("match").agg(F.min_by(F.struct("position", "normal", "cells"), "position").alias("old"))
    joined = new.join(old, "match", "full")
    action = (
        F.when(F.col("position").isNull(), F.when(F.col("match.alone") == 0, "stale"))
        .when(F.col("old").isNull(), "appended")
        .when(F.col("old.normal") == F.col("normal"), "unchanged")
        .otherwise("changed")
    )
    rows = joined.select(
        action.alias("action"), "position", F.col("old.position").alias("row_number"), F.coalesce("cells", "old.cells").alias("cells")
    )
    return rows.where(F.col("action").isNotNull())


#: target positions that one group of the order test spans, so it has at most as many rows
SPAN = 65_536


def order_breaks(
    existing: DataFrame, target: DataFrame, cells: Sequence[str], key_columns: int = 1
) -> DataFrame:
    """One row ``breaks``: 0 if both key sequences are the same.

    The n-th row of a key on one side is that key's n-th row on the other. The sequences are
    equal if every row has such a partner and existing positions rise along target
    positions. That is tested inside spans of target positions, whose first and last
    existing positions are then tested across their bounds, one small row a span.
    """
    pairs = []
    for side, name in zip(_sides(existing, target, cells, key_columns), ("old", "new")):
        keyed = side.where("match.alone = 0").select("match", "position")
        numbered = version_numbers(keyed, ["match"], ["position"], number="nth")
        pairs.append(numbered.select("match", "nth", F.col("position").alias(name)))
    both = pairs[0].join(pairs[1], ["match", "nth"], "full")
    span = both.groupBy(F.when(F.col("old").isNotNull(), F.floor(F.col("new") / SPAN)).alias("span")).agg(
        F.count_if(F.col("old").isNull() | F.col("new").isNull()).alias("alone"),
        F.array_sort(F.collect_list(F.when(F.col("old").isNotNull() & F.col("new").isNotNull(), F.struct("new", "old")))).alias("rows"),
    )
    falls = F.size(F.filter("rows", lambda x, i: (i > 0) & (x["old"] < F.get("rows", i - 1)["old"])))
    span = span.select(
        "span", (F.col("alone") + falls).alias("inside"), F.get("rows", F.lit(0))["old"].alias("first"),
        F.try_element_at("rows", F.lit(-1))["old"].alias("last"),
    )
    along = Window.partitionBy(F.lit(0)).orderBy("span")
    across = span.where("first is not null").select(
        "inside", F.when(F.col("first") < F.lag("last").over(along), 1).otherwise(0).alias("across")
    )
    lonely = span.where("first is null").select("inside", F.lit(0).alias("across"))
    return across.unionByName(lonely).agg(F.coalesce(F.sum(F.col("inside") + F.col("across")), F.lit(0)).cast("bigint").alias("breaks"))


def order_mismatches(
    existing: DataFrame, target: DataFrame, cells: Sequence[str], key_columns: int = 1
) -> DataFrame:
    """Ordinals at which the two key sequences differ."""
    def ranked(df: DataFrame, name: str) -> DataFrame:
        side = _side(df, cells, key_columns, F.lit(1)).where("match.alone = 0")
        keyed = side.select("position", F.struct(*[F.col("match")[c].alias(c) for c in cells[:key_columns]]).alias(name))
        return dense_ordinal(keyed, ["position"]).select("ordinal", name)

    both = ranked(existing, "old_key").join(ranked(target, "new_key"), "ordinal", "full")
    return both.where(~F.col("old_key").eqNullSafe(F.col("new_key")))


def plan_summary(
    existing: DataFrame,
    target: DataFrame,
    cells: Sequence[str],
    key_columns: int = 1,
    mode: str = "upsert",
    replace_on_order_change: bool = False,
    header_matches: bool = True,
) -> DataFrame:
    """One row of counts and the mode the publish will take; nothing is written."""
    width = len(cells)
    names = ("unchanged", "changed", "appended", "stale")
    rows = existing.agg(F.count(F.lit(1)).alias("n")).scalar()
    if mode == "replace":
        counts = target.agg(F.count(F.lit(1)).alias("appended")).withColumns({n: F.lit(0).cast("bigint") for n in names if n != "appended"})
        chosen = F.lit("replace")
    else:
        actions = classify_rows(existing, target, cells, key_columns)
        counts = actions.agg(*[F.count_if(F.col("action") == n).alias(n) for n in names])
        chosen = F.when(F.col("stale") > 0, "replace-stale")
        if replace_on_order_change:
            breaks = order_breaks(existing, target, cells, key_columns).scalar()
            chosen = chosen.when(breaks > 0, "replace-order")
        chosen = chosen.otherwise("upsert")
    counts = counts.withColumn("existing", rows)
    prepared = F.col("unchanged") + F.col("changed") + F.col("appended")
    replaced = F.col("mode") != "upsert"
    header = F.lit(not header_matches)
    cells_upsert = (F.col("changed") + F.col("appended")) * width + F.when(header, F.lit(width)).otherwise(F.lit(0))
    return (
        counts.withColumn("mode", chosen)
        .select(
            "mode",
            prepared.alias("prepared_rows"),
            F.col("existing").alias("existing_rows"),
            F.when(replaced, F.lit(0)).otherwise(F.col("unchanged")).cast("bigint").alias("unchanged_rows"),
            F.when(replaced, prepared).otherwise(F.col("changed")).alias("changed_rows"),
            F.when(replaced, prepared).otherwise(F.col("appended")).alias("appended_rows"),
            F.when(F.col("mode") == "replace", F.lit(0)).otherwise(F.col("stale")).cast("bigint").alias("stale_rows"),
            (replaced | header).alias("header_updated"),
            replaced.alias("cleared"),
            F.when(replaced, (prepared + 1) * width).otherwise(cells_upsert).alias("updated_cells"),
        )
    )


def update_ranges(actions: DataFrame, existing_rows: int, header_row: int = 1) -> DataFrame:
    """Sheet row of every row to write: changed rows in place, appended ones below."""
    ensure_checkpoint_dir(actions.sparkSession)
    # read several times below, each of which would compare both tables again
    actions = actions.where(F.col("action").isin("changed", "appended")).checkpoint()
    changed = actions.where(F.col("action") == "changed").select(
        "action", (F.col("row_number") + header_row).alias("sheet_row"), "cells"
    )
    added = dense_ordinal(actions.where(F.col("action") == "appended"), ["position"])
    added = added.select(
        "action", (F.col("ordinal") + header_row + existing_rows).alias("sheet_row"), "cells"
    )
    return changed.unionByName(added)


def apply_plan(
    existing: DataFrame, target: DataFrame, cells: Sequence[str], key_columns: int, replace: bool
) -> DataFrame:
    """The published table after the plan: (position, cells).

    With ``replace`` it is the target. Otherwise changed rows take the target's cells
    in place and appended rows follow in target order.
    """
    if replace:
        return target.select("position", *cells)
    ensure_checkpoint_dir(existing.sparkSession)
    actions = classify_rows(existing, target, cells, key_columns).checkpoint()  # read three times below
    # the last target row of a key is written last and stays
    writes = first_per_key(
        actions.where(F.col("action") == "changed").select("position", "row_number", F.col("cells").alias("new")),
        ["row_number"],
        [F.col("position").desc()],
    ).select("row_number", "new")
    kept = existing.select("position", F.struct(*cells).alias("cells")).join(
        writes, F.col("position") == F.col("row_number"), "left"
    ).select("position", F.coalesce("new", "cells").alias("cells"))
    last = existing.agg(F.coalesce(F.max("position"), F.lit(0)).alias("last")).scalar()
    added = dense_ordinal(actions.where(F.col("action") == "appended"), ["position"])
    added = added.select((F.col("ordinal") + last).alias("position"), "cells")
    return kept.unionByName(added).select("position", "cells.*")


def publish(
    existing: DataFrame,
    target: DataFrame,
    cells: Sequence[str],
    path: str,
    generation: int,
    key_columns: int = 1,
    mode: str = "upsert",
    replace_on_order_change: bool = False,
    header_matches: bool = True,
) -> dict:
    """Carry out the plan on a published table and return its summary.

    The new content is written as the next generation of the table, so readers see
    either the old or the new one. Nothing is written when nothing changes.
    """
    plan = plan_summary(existing, target, cells, key_columns, mode, replace_on_order_change, header_matches)
    summary = plan.first().asDict()
    if summary["updated_cells"]:
        replace_all(apply_plan(existing, target, cells, key_columns, summary["cleared"]), path, generation)
    return summary
