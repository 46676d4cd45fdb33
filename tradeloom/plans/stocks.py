"""Stock, inventory, supply and unit cost."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Warehouses that make up each cost group.
COST_GROUPS = {
    "ozon": ("OZON - товар, переданный на склад МП",),
    "wb": ("Wildberries- товар, переданный на склад МП",),
    "general": ("основной", "ДЛЯ МАРКЕТПЛЕЙСОВ", "Ответственное хранение Великий камень"),
}


def cost_group(warehouse: str, groups: dict[str, tuple[str, ...]] | None = None) -> Column:
    result = None
    for name, members in (groups or COST_GROUPS).items():
        test = F.col(warehouse).isin(*members)
        result = F.when(test, F.lit(name)) if result is None else result.when(test, F.lit(name))
    return result


def half_up_ratio(numerator: Column, denominator: Column, scale: int = 2) -> Column:
    """Exact quotient of two decimals rounded half away from zero, null for denominator 0."""
    quotient = F.try_divide(numerator.cast("decimal(24,4)"), denominator.cast("decimal(14,4)"))
    return F.round(quotient, scale).cast(f"decimal(14,{scale})")


def marketplace_cost(costs: DataFrame, groups: dict[str, tuple[str, ...]] | None = None) -> DataFrame:
    """Unit cost per cost group and article: total by quantity, else weighted unit cost."""
    grouped = (
        costs.withColumn("marketplace", cost_group("warehouse_name", groups))
        .where(F.col("marketplace").isNotNull() & (F.col("quantity") != 0))
        .groupBy("marketplace", "article")
        .agg(
            F.sum("quantity").alias("quantity"),
            F.sum("total_cost_byn").alias("total"),
            F.sum(F.col("unit_cost_byn") * F.col("quantity")).alias("weighted"),
        )
    )
    numerator = F.when(F.col("total") != 0, F.col("total").cast("decimal(28,6)")).otherwise(
        F.col("weighted").cast("decimal(28,6)")
    )
    return grouped.select(
        "marketplace", "article", half_up_ratio(numerator, F.col("quantity")).alias("unit_cost_byn"), "quantity"
    )


def net_sales(rows: DataFrame) -> DataFrame:
    """Sold pieces per article, articles without any left out."""
    return rows.groupBy("article").agg(F.sum("sales_count").alias("sales_count")).where(F.col("sales_count") != 0)


def inventory_latest(snapshots: DataFrame, time: str = "snapped_at") -> DataFrame:
    """Rows of the newest snapshot."""
    return snapshots.where(F.col(time) == snapshots.agg(F.max(time)).scalar())


def latest_run_rows(rows: DataFrame, time: str, run: str) -> DataFrame:
    """Rows of the run that loaded last."""
    newest = rows.orderBy(F.col(time).desc_nulls_last(), F.col(run).desc()).limit(1).select(run)
    return rows.where(F.col(run) == newest.scalar())


def supply_stages(rows: DataFrame) -> DataFrame:
    return rows.select(
        "article", "approved_order_qty", "in_production_qty", "ready_qty", "in_way_qty", "minsk_date"
    ).orderBy("article")


def supply_specs(rows: DataFrame) -> DataFrame:
    return rows.orderBy("source_sheet", "source_row_number", "article").select(
        "article", "specification", "production_date"
    )


def top_stock(rows: DataFrame, limit: int = 20) -> DataFrame:
    """Articles with the most pieces."""
    totals = rows.groupBy("nm_id").agg(F.sum("quantity").alias("total_qty"))
    return totals.orderBy(F.col("total_qty").desc_nulls_last(), "nm_id").limit(limit)


def stock_locations(rows: DataFrame) -> DataFrame:
    """Pieces per article and location."""
    return rows.groupBy("article", "location").agg(
        F.sum("quantity").alias("quantity"), F.sum("in_way_qty").alias("in_way_qty")
    )


def stock_summary(rows: DataFrame) -> DataFrame:
    """Pieces, locations and in-way pieces per article."""
    return stock_locations(rows).groupBy("article").agg(
        F.sum("quantity").alias("quantity"),
        F.sum("in_way_qty").alias("in_way_qty"),
        F.count("location").alias("locations"),
    )
