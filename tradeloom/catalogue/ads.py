"""Advertising queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tradeloom.bindings import load, load_spread, money, text, whole
from tradeloom.catalogue import query
from tradeloom.operators.normalize import ad_statistics
from tradeloom.plans import ads as plans
from tradeloom.sources.landing import flatten_campaigns


def _statistics(spark, sf_dir):
    """Every line item as one campaign answer with two days, two app types and both item spellings."""
    item = F.struct(
        F.col("l_partkey").alias("nmId"), text("l_extendedprice").alias("sum"), F.col("l_linenumber").alias("views"),
        whole("l_quantity").alias("clicks"), F.lit(1).alias("orders"),
    )
    second = F.struct(
        text("l_partkey").alias("nmId"), F.lit(None).cast("string").alias("sum"), F.lit(2).alias("views"), F.lit(None).cast("bigint").alias("clicks"),
        F.lit(0).alias("orders"),
    )
    no_item = F.struct(
        F.lit("0").alias("nmId"), F.lit("9").alias("sum"), F.lit(2).alias("views"), F.lit(1).cast("bigint").alias("clicks"), F.lit(0).alias("orders")
    )
    day = F.date_format("l_shipdate", "yyyy-MM-dd'T'00:00:00'Z'")
    app = F.concat(
        F.lit('{"nm":['), F.to_json(item), F.lit("]},"),
        F.lit('{"nm":[],"nms":['), F.to_json(second), F.lit(","), F.to_json(no_item), F.lit("]}"),
    )
    payload = F.concat(
        F.lit('{"advertId":'), text("l_suppkey"), F.lit(',"days":[{"date":"'), day, F.lit('","apps":['), app,
        F.lit(']},{"date":"","apps":['), app, F.lit("]}]}"),
    )
    return load_spread(spark, sf_dir, "lineitem").select(payload.alias("payload"))


SQL_DAILY = """
    daily AS (SELECT l_suppkey AS advert_id, l_partkey AS nm_id, l_shipdate::DATE AS stat_date,
                     SUM(l_extendedprice::DECIMAL(18,2)) AS spend, SUM(l_linenumber + 2) AS views, SUM(l_quantity::BIGINT) AS clicks, COUNT(*) AS orders
              FROM lineitem WHERE l_suppkey <> 0 AND l_partkey <> 0 GROUP BY 1, 2, 3)
"""


@query(
    "nested_explode_agg",
    f"""
    WITH {SQL_DAILY} SELECT advert_id, nm_id, stat_date, spend::DOUBLE AS spend_rub, views::BIGINT AS views, clicks::BIGINT AS clicks, orders::BIGINT AS orders
    FROM daily
    """,
)
def nested_explode_agg(spark, sf_dir):
    daily = plans.ads_daily(ad_statistics(_statistics(spark, sf_dir)))
    return daily.select("advert_id", "nm_id", "stat_date", F.col("spend_rub").cast("double").alias("spend_rub"), "views", "clicks", "orders")


@query(
    "ads_period",
    """
    SELECT user_id AS advert_id, json_extract_string(props, '$.k')::BIGINT AS nm_id,
           SUM(CASE WHEN event_type = 'purchase' THEN value::DECIMAL(12,2) ELSE 0 END)::DOUBLE AS spend_rub, DATE '2024-01-31' AS report_date
    FROM events WHERE ts::DATE BETWEEN DATE '2024-01-01' AND DATE '2024-01-30'
    GROUP BY 1, 2 HAVING SUM(CASE WHEN event_type = 'purchase' THEN value::DECIMAL(12,2) ELSE 0 END) > 0
    """,
)
def ads_period(spark, sf_dir):
    daily = load(spark, sf_dir, "events").select(
        F.col("user_id").alias("advert_id"), F.get_json_object("props", "$.k").cast("bigint").alias("nm_id"),
        F.to_date("ts").alias("stat_date"),
        F.when(F.col("event_type") == "purchase", money("value")).otherwise(0).cast("decimal(12,2)").alias("spend_rub"),
    )
    period = plans.ads_period(daily, F.lit("2024-01-01").cast("date"), F.lit("2024-01-30").cast("date"))
    return period.withColumn("spend_rub", F.col("spend_rub").cast("double"))


@query(
    "ads_ratios",
    """
    WITH m AS (SELECT user_id, json_extract_string(props, '$.k') AS k, COUNT(*) FILTER (WHERE event_type = 'view') AS views,
                      COUNT(*) FILTER (WHERE event_type = 'click') AS clicks, COUNT(*) FILTER (WHERE event_type = 'purchase') AS orders,
                      COUNT(*) FILTER (WHERE event_type = 'error') AS spend_rub FROM events GROUP BY 1, 2)
    SELECT user_id, k, views, clicks, orders, spend_rub, CASE WHEN views <> 0 THEN clicks::DOUBLE / views END AS ctr,
           CASE WHEN clicks <> 0 THEN spend_rub::DOUBLE / clicks END AS cpc, CASE WHEN clicks <> 0 THEN orders::DOUBLE / clicks END AS cr FROM m
    """,
)
def ads_ratios(spark, sf_dir):
    counts = {"views": "view", "clicks": "click", "orders": "purchase", "spend_rub": "error"}
    rows = load(spark, sf_dir, "events").groupBy("user_id", F.get_json_object("props", "$.k").alias("k")).agg(
        *[F.count_if(F.col("event_type") == kind).alias(name) for name, kind in counts.items()]
    )
    return plans.ads_ratios(rows)


@query(
    "campaign_active",
    "SELECT event_id AS advert_id, event_type AS status FROM events WHERE event_type IN ('view', 'click', 'purchase')",
)
def campaign_active(spark, sf_dir):
    campaigns = load(spark, sf_dir, "events").select(
        F.col("event_id").alias("advert_id"), F.col("event_type").alias("status"), F.when(F.col("value") > 10, F.col("ts")).alias("change_time")
    )
    return plans.active_campaigns(campaigns, ("view", "click", "purchase")).select("advert_id", "status")


@query(
    "campaign_flatten",
    """
    SELECT o_orderkey AS advert_id, 9 AS status, 4 AS type, o_orderdate::DATE AS change_date FROM orders WHERE o_orderkey <> 0
    UNION ALL SELECT o_custkey + 1000000, 9, 4, NULL FROM orders
    """,
)
def campaign_flatten(spark, sf_dir):
    """Every order as a page with one group of three campaigns, one of them without an id."""
    page = F.concat(
        F.lit('{"adverts":[{"status":9,"type":4,"advert_list":[{"advertId":'), text("o_orderkey"),
        F.lit(',"changeTime":"'), F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss"), F.lit('Z"},{"advertId":'),
        (F.col("o_custkey") + 1000000).cast("string"), F.lit('},{"changeTime":"x"}]},{"status":7,"type":4,"advert_list":[]}]}'),
    )
    rows = flatten_campaigns(load(spark, sf_dir, "orders").select(page.alias("payload")))
    return rows.select("advert_id", "status", "type", F.to_date("change_time").alias("change_date"))


@query(
    "advertising_daily",
    """
    WITH a AS (SELECT json_extract_string(props, '$.k') AS article, ts::DATE AS fact_date, SUM(value::DECIMAL(12,2)) AS spend, COUNT(*) AS orders_qty
               FROM events WHERE event_type = 'click' GROUP BY 1, 2),
    r AS (SELECT json_extract_string(props, '$.k') AS article, ts::DATE AS fact_date, SUM(value::DECIMAL(12,2)) AS revenue
          FROM events WHERE event_type = 'purchase' GROUP BY 1, 2)
    SELECT article, fact_date, spend::DOUBLE AS spend, orders_qty::BIGINT AS orders_qty, revenue::DOUBLE AS revenue,
           CASE WHEN revenue <> 0 THEN spend::DOUBLE / revenue::DOUBLE END AS ad_share
    FROM a LEFT JOIN r USING (article, fact_date)
    """,
)
def advertising_daily(spark, sf_dir):
    rows = load(spark, sf_dir, "events").select(
        F.get_json_object("props", "$.k").alias("article"), F.to_date("ts").alias("fact_date"), money("value").alias("amount"), "event_type"
    )
    ads = rows.where(F.col("event_type") == "click").select("article", "fact_date", F.col("amount").alias("spend"), F.lit(1).alias("orders_qty"))
    revenue = rows.where(F.col("event_type") == "purchase").select("article", "fact_date", F.col("amount").alias("revenue"))
    daily = plans.advertising_daily(ads, revenue)
    return daily.withColumns({c: F.col(c).cast("double") for c in ("spend", "revenue")})
