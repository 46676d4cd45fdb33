"""Products: flat view, identity, daily facts and the current overview."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeloom.functions.numbers import ratio
from tradeloom.operators.keyed import first_per_key


def products_flat(info: DataFrame, listed: DataFrame) -> DataFrame:
    """Product details with the list flags of the same product."""
    extra = listed.select("product_id", *[c for c in listed.columns if c not in info.columns])
    return info.join(extra, "product_id", "left").drop("payload")


def product_identity(cards: DataFrame, erp: DataFrame) -> DataFrame:
    """Article, name and series from the newest card or ERP row of the article."""
    rows = cards.select("article", "product_name", F.lit(None).cast("string").alias("series"), "updated_at", F.lit(0).alias("rank"))
    rows = rows.unionByName(
        erp.select("article", F.col("name_1s").alias("product_name"), F.col("series_name").alias("series"), "updated_at", F.lit(1).alias("rank"))
    )
    order = [F.col("updated_at").desc_nulls_last(), F.col("rank"), F.col("product_name").asc_nulls_last()]
    newest = first_per_key(rows, ["article"], order).select("article", "product_name")
    series = first_per_key(rows.where(F.col("series").isNotNull()), ["article"], [F.col("updated_at").desc_nulls_last(), F.col("series")])
    return newest.join(series.select("article", "series"), "article", "left")


def product_daily(lines: DataFrame) -> DataFrame:
    """Orders, sales, revenue and cancelled pieces per marketplace, article and day."""
    live = ~F.coalesce("cancelled", F.lit(False))
    return lines.groupBy("marketplace", "article", "fact_date").agg(
        F.sum("quantity").alias("orders_qty"),
        F.coalesce(F.sum(F.when(live, F.col("quantity"))), F.lit(0)).alias("sales_qty"),
        F.coalesce(F.sum(F.when(live, F.col("amount"))), F.lit(0)).alias("revenue"),
        F.coalesce(F.sum(F.when(~live, F.col("quantity"))), F.lit(0)).alias("cancelled_qty"),
    )


def marketplace_current(
    products: DataFrame,
    stock: DataFrame,
    costs: DataFrame,
    daily: DataFrame,
    ads: DataFrame,
    as_of: Column,
    green: float = 30.0,
    yellow: float = 10.0,
) -> DataFrame:
    """Price, stock, in-way pieces, 28-day ads, turnover, margin and a light per article.

    ``green`` and ``yellow`` are the least margin percentages of those lights.
    """
    sold = daily.where(F.col("fact_date") > F.date_sub(as_of, 30)).groupBy("article").agg(F.sum("sales_qty").alias("sold_30d"))
    spent = ads.where(F.col("fact_date") > F.date_sub(as_of, 28)).groupBy("article").agg(F.sum("spend").alias("ads_28d"))
    rows = (
        products.join(stock, "article", "left")
        .join(costs.select("article", "unit_cost_byn"), "article", "left")
        .join(sold, "article", "left")
        .join(spent, "article", "left")
    )
    margin = ratio((F.col("price") - F.col("unit_cost_byn")) * 100, "price")
    light = (
        F.when(F.col("margin_pct").isNull(), "gray")
        .when(F.col("margin_pct") >= green, "green")
        .when(F.col("margin_pct") >= yellow, "yellow")
        .otherwise("red")
    )
    return rows.select(
        "article", "product_name", F.col("price").alias("current_price"), margin.alias("margin_pct"),
        F.coalesce("quantity", F.lit(0)).alias("available_stock"),
        F.coalesce("in_way_qty", F.lit(0)).alias("in_way_qty"),
        F.coalesce("ads_28d", F.lit(0)).alias("ads_28d"),
        ratio("quantity", "sold_30d").alias("turnover_30d"),
    ).withColumn("status_light", light)
