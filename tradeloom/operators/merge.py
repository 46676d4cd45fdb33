"""Grouped merges that keep the first usable value of an attribute."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Counters and attributes of a marketplace stock row.
STOCK_COUNTERS = (
    "available_stock_count", "requested_stock_count", "transit_stock_count",
    "return_from_customer_stock_count", "in_way_to_warehouse_count", "valid_stock_count",
    "other_stock_count", "return_to_seller_stock_count", "stock_defect_stock_count",
    "transit_defect_stock_count", "expiring_stock_count", "waiting_docs_stock_count",
    "waiting_docs_to_export_stock_count", "excess_stock_count",
)
STOCK_ATTRIBUTES = (
    "cluster_name", "ads", "ads_cluster", "idc", "idc_cluster", "days_without_sales",
    "days_without_sales_cluster", "turnover_grade", "turnover_grade_cluster",
    "macrolocal_cluster_id", "warehouse_id", "warehouse_name", "placement_zone", "name",
    "item_tags_count",
)

# Warehouse names and the inventory column of each.
INVENTORY_WAREHOUSES = {
    "ДЛЯ МАРКЕТПЛЕЙСОВ": "smp_qty",
    "основной": "osn_qty",
    "Ответственное хранение Великий камень": "soh_qty",
    "Склад СВХ Великий камень": "svh_qty",
    "Таможенный склад (Великий камень)": "ts_qty",
}


def first_non_empty(column: str, arrival: Column) -> Column:
    """Aggregate: value of the earliest row where the column is neither null nor ''."""
    usable = F.col(column).isNotNull() & (F.col(column).cast("string") != "")
    return F.min_by(F.col(column), F.when(usable, arrival))


def merge_rows(
    df: DataFrame,
    keys: Sequence[str],
    sums: Sequence[str],
    attributes: Sequence[str],
    arrival: Column,
) -> DataFrame:
    """Sum the counters and keep the first usable attribute of each key."""
    return df.groupBy(*keys).agg(
        *[F.sum(F.coalesce(F.col(c), F.lit(0))).alias(c) for c in sums],
        *[first_non_empty(c, arrival).alias(c) for c in attributes],
        F.count(F.lit(1)).alias("merged_rows"),
    )


def merge_stock(df: DataFrame, arrival: Column) -> DataFrame:
    """Stock rows of one (sku, offer, cluster) merged.

    The payloads of a key stay rows of the landed table, see :func:`merged_payloads`;
    ``merged_rows`` tells how many there are.
    """
    keyed = df.where(F.col("sku").isNotNull()).withColumns(
        {
            "offer_id": F.coalesce("offer_id", F.lit("")),
            "cluster_id": F.coalesce("cluster_id", F.lit(0).cast("bigint")),
        }
    )
    return merge_rows(keyed, ["sku", "offer_id", "cluster_id"], STOCK_COUNTERS, STOCK_ATTRIBUTES, arrival)


def merged_payloads(df: DataFrame) -> DataFrame:
    """The payload rows behind each merged key, one row each."""
    return df.where(F.col("sku").isNotNull()).select(
        "sku",
        F.coalesce("offer_id", F.lit("")).alias("offer_id"),
        F.coalesce("cluster_id", F.lit(0).cast("bigint")).alias("cluster_id"),
        "payload",
    )


def merge_costs(df: DataFrame) -> DataFrame:
    """Cost rows by (article, warehouse): summed, unit cost recalculated when possible."""
    arrival = F.col("row_number")
    others = [c for c in ("code", "product_name", "tnved_code") if c in df.columns]
    grouped = (
        df.where((F.col("article") != "") & (F.col("warehouse_name") != ""))
        .groupBy("article", "warehouse_name")
        .agg(
            F.sum("quantity").alias("quantity"),
            F.sum("total_cost_byn").alias("total_cost_byn"),
            F.min_by("unit_cost_byn", arrival).alias("__first_unit"),
            F.min("row_number").alias("row_number"),
            *[F.min_by(c, arrival).alias(c) for c in others],
        )
    )
    both = (F.col("quantity") != 0) & (F.col("total_cost_byn") != 0)
    unit = F.when(both, F.try_divide("total_cost_byn", "quantity")).otherwise(F.col("__first_unit"))
    return grouped.withColumn("unit_cost_byn", unit.cast("decimal(18,4)")).drop("__first_unit")


def sum_inventory(df: DataFrame) -> DataFrame:
    """Five warehouse columns summed per article; rows with all five at 0 are ignored."""
    columns = list(INVENTORY_WAREHOUSES.values())
    filled = F.lit(False)
    for c in columns:
        filled = filled | (F.col(c) != 0)
    return (
        df.where((F.col("article") != "") & filled)
        .groupBy("article")
        .agg(*[F.sum(c).alias(c) for c in columns])
    )


def pivot_inventory(costs: DataFrame, warehouses: dict[str, str] | None = None) -> DataFrame:
    """Quantity per article with one column per known warehouse, 0 where absent."""
    names = warehouses or INVENTORY_WAREHOUSES
    return (
        costs.where(F.col("warehouse_name").isin(*names))
        .groupBy("article")
        .agg(
            *[
                F.coalesce(F.sum(F.when(F.col("warehouse_name") == w, F.col("quantity"))), F.lit(0)).alias(c)
                for w, c in names.items()
            ]
        )
    )


def pivot_cells(cells: DataFrame, keys: Sequence[str], columns: dict[str, Column]) -> DataFrame:
    """Cells to wide rows: each output is the greatest value under its condition."""
    return cells.groupBy(*keys).agg(*[F.max(value).alias(name) for name, value in columns.items()])


def unpivot_payload(df: DataFrame, keys: Sequence[str], payload: str, strict: bool = False) -> DataFrame:
    """One row per member of a JSON object, numbered in document order."""
    from tradeloom.functions.numbers import numeric_cell

    members = F.map_entries(F.from_json(F.col(payload), "map<string,string>"))
    cells = df.select(*keys, F.posexplode(members).alias("__pos", "__cell"))
    return cells.select(
        *keys,
        (F.col("__pos") + 1).alias("column_number"),
        F.col("__cell.key").alias("column_name"),
        F.col("__cell.value").alias("value_text"),
        numeric_cell("__cell.value", strict=strict).alias("value_numeric"),
    )
