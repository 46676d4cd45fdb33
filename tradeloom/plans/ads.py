"""Advertising results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeloom.functions.numbers import ratio

AD_COUNTERS = ("views", "clicks", "atbs", "orders", "shks")
ACTIVE_STATUSES = (7, 9, 11)


def ads_daily(rows: DataFrame) -> DataFrame:
    """Metrics per campaign, item and day over all apps; days without spend and views left out."""
    return (
        rows.groupBy("advert_id", "nm_id", "stat_date")
        .agg(
            F.round(F.sum("spend_rub"), 2).alias("spend_rub"),
            *[F.sum(c).alias(c) for c in AD_COUNTERS],
            F.round(F.sum("sum_price"), 2).alias("sum_price"),
        )
        .where((F.col("spend_rub") > 0) | (F.col("views") > 0))
    )


def ads_period(daily: DataFrame, begin: Column, end: Column) -> DataFrame:
    """Spend per campaign and item over a period, dated the day after it."""
    return (
        daily.where(F.col("stat_date").between(begin, end))
        .groupBy("advert_id", "nm_id")
        .agg(F.round(F.sum("spend_rub"), 2).alias("spend_rub"))
        .where(F.col("spend_rub") > 0)
        .withColumn("report_date", F.date_add(end, 1))
        .orderBy("advert_id", "nm_id")
    )


def ads_ratios(rows: DataFrame) -> DataFrame:
    """Click rate, cost per click and order rate, null where undefined."""
    return rows.withColumns(
        {
            "ctr": ratio("clicks", "views"),
            "cpc": ratio("spend_rub", "clicks"),
            "cr": ratio("orders", "clicks"),
        }
    )


def active_campaigns(campaigns: DataFrame, statuses: tuple = ACTIVE_STATUSES) -> DataFrame:
    """Campaigns in the wanted statuses, newest change first, unknown change last."""
    return campaigns.where(F.col("status").isin(*statuses)).orderBy(F.col("change_time").desc_nulls_last(), "advert_id")


def advertising_daily(ads: DataFrame, revenue: DataFrame) -> DataFrame:
    """Spend per article and day with its share of the day's revenue."""
    spend = ads.groupBy("article", "fact_date").agg(F.sum("spend").alias("spend"), F.sum("orders_qty").alias("orders_qty"))
    earned = revenue.groupBy("article", "fact_date").agg(F.sum("revenue").alias("revenue"))
    return spend.join(earned, ["article", "fact_date"], "left").withColumn("ad_share", ratio("spend", "revenue"))
