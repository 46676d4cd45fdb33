"""Product queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tradeloom.bindings import load, money, text, whole
from tradeloom.catalogue import query
from tradeloom.plans import products as plans


@query(
    "products_flat",
    """
    SELECT p_partkey::VARCHAR AS product_id, p_name AS name, p_retailprice::DOUBLE AS price, s.n AS orders_count FROM part LEFT JOIN
        (SELECT l_partkey, COUNT(*)::BIGINT AS n FROM lineitem WHERE l_returnflag = 'R' AND l_linestatus = 'F' GROUP BY 1) s ON l_partkey = p_partkey
    """,
)
def products_flat(spark, sf_dir):
    info = load(spark, sf_dir, "part").select(
        text("p_partkey").alias("product_id"), F.col("p_name").alias("name"), F.col("p_retailprice").alias("price"), F.lit("{}").alias("payload")
    )
    returned = load(spark, sf_dir, "lineitem").where((F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F"))
    listed = returned.groupBy(text("l_partkey").alias("product_id")).agg(F.count(F.lit(1)).alias("orders_count"))
    return plans.products_flat(info, listed)


@query(
    "product_identity",
    """
    WITH r AS (SELECT p_brand AS article, p_name AS product_name, NULL AS series, p_partkey AS updated_at, 0 AS rank FROM part
               UNION ALL SELECT p_brand, p_type, CASE WHEN p_size > 25 THEN p_type END, p_size * 100, 1 FROM part),
    n AS (SELECT article, product_name FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY article ORDER BY updated_at DESC, rank, product_name) AS rn FROM r) WHERE rn = 1),
    s AS (SELECT article, series FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY article ORDER BY updated_at DESC, series) AS rn FROM r
                                       WHERE series IS NOT NULL) WHERE rn = 1)
    SELECT article, product_name, series FROM n LEFT JOIN s USING (article)
    """,
)
def product_identity(spark, sf_dir):
    part = load(spark, sf_dir, "part")
    cards = part.select(F.col("p_brand").alias("article"), F.col("p_name").alias("product_name"), F.col("p_partkey").alias("updated_at"))
    erp = part.select(
        F.col("p_brand").alias("article"), F.col("p_type").alias("name_1s"),
        F.when(F.col("p_size") > 25, F.col("p_type")).alias("series_name"), (F.col("p_size") * 100).cast("bigint").alias("updated_at"),
    )
    return plans.product_identity(cards, erp)


def _daily(spark, sf_dir):
    return plans.product_daily(
        load(spark, sf_dir, "lineitem").select(
            F.when(F.col("l_linestatus") == "O", "wb").otherwise("ozon").alias("marketplace"), text("l_partkey").alias("article"),
            F.to_date("l_shipdate").alias("fact_date"), whole("l_quantity").alias("quantity"), money("l_extendedprice").alias("amount"),
            (F.col("l_returnflag") == "R").alias("cancelled"),
        )
    )


@query(
    "product_daily",
    """
    SELECT CASE WHEN l_linestatus = 'O' THEN 'wb' ELSE 'ozon' END AS marketplace, l_partkey::VARCHAR AS article, l_shipdate::DATE AS fact_date,
           SUM(l_quantity::BIGINT)::BIGINT AS orders_qty, COALESCE(SUM(l_quantity::BIGINT) FILTER (WHERE l_returnflag <> 'R'), 0)::BIGINT AS sales_qty,
           COALESCE(SUM(l_extendedprice::DECIMAL(12,2)) FILTER (WHERE l_returnflag <> 'R'), 0)::DOUBLE AS revenue,
           COALESCE(SUM(l_quantity::BIGINT) FILTER (WHERE l_returnflag = 'R'), 0)::BIGINT AS cancelled_qty
    FROM lineitem GROUP BY 1, 2, 3
    """,
)
def product_daily(spark, sf_dir):
    return _daily(spark, sf_dir).withColumn("revenue", F.col("revenue").cast("double"))


@query(
    "marketplace_current",
    """
    WITH st AS (SELECT l_partkey, SUM(CASE WHEN l_linestatus = 'O' THEN l_quantity::BIGINT ELSE 0 END) AS quantity,
                       SUM(CASE WHEN l_linestatus = 'F' THEN l_quantity::BIGINT ELSE 0 END) AS in_way FROM lineitem GROUP BY 1),
    sold AS (SELECT l_partkey, SUM(l_quantity::BIGINT) FILTER (WHERE l_returnflag <> 'R') AS q FROM lineitem
             WHERE l_shipdate::DATE > DATE '1999-06-30' - 30 GROUP BY 1),
    ads AS (SELECT l_partkey, SUM(l_extendedprice::DECIMAL(12,2)) AS spend FROM lineitem
            WHERE l_returnflag = 'A' AND l_shipdate::DATE > DATE '1999-06-30' - 28 GROUP BY 1),
    r AS (SELECT p_partkey::VARCHAR AS article, p_name AS product_name, p_retailprice::DECIMAL(12,2)::DOUBLE AS current_price,
                 CASE WHEN p_size <= 40 THEN ((p_retailprice::DECIMAL(12,2) - p_size * 25) * 100)::DOUBLE / p_retailprice::DECIMAL(12,2)::DOUBLE END AS margin_pct,
                 COALESCE(quantity, 0)::BIGINT AS available_stock, COALESCE(in_way, 0)::BIGINT AS in_way_qty, COALESCE(spend, 0)::DOUBLE AS ads_28d,
                 CASE WHEN COALESCE(q, 0) <> 0 THEN quantity::DOUBLE / q END AS turnover_30d
          FROM part LEFT JOIN st ON st.l_partkey = p_partkey LEFT JOIN sold ON sold.l_partkey = p_partkey LEFT JOIN ads ON ads.l_partkey = p_partkey)
    SELECT *, CASE WHEN margin_pct IS NULL THEN 'gray' WHEN margin_pct >= 30 THEN 'green' WHEN margin_pct >= 10 THEN 'yellow' ELSE 'red' END AS status_light
    FROM r
    """,
)
def marketplace_current(spark, sf_dir):
    part = load(spark, sf_dir, "part")
    products = part.select(text("p_partkey").alias("article"), F.col("p_name").alias("product_name"), money("p_retailprice").alias("price"))
    costs = part.where(F.col("p_size") <= 40).select(
        text("p_partkey").alias("article"), (F.col("p_size") * 25).cast("decimal(12,2)").alias("unit_cost_byn")
    )
    lines = load(spark, sf_dir, "lineitem")
    stock = lines.groupBy(text("l_partkey").alias("article")).agg(
        F.sum(F.when(F.col("l_linestatus") == "O", whole("l_quantity")).otherwise(0)).alias("quantity"),
        F.sum(F.when(F.col("l_linestatus") == "F", whole("l_quantity")).otherwise(0)).alias("in_way_qty"),
    )
    ads = lines.where(F.col("l_returnflag") == "A").select(
        text("l_partkey").alias("article"), F.to_date("l_shipdate").alias("fact_date"), money("l_extendedprice").alias("spend")
    )
    daily = _daily(spark, sf_dir)
    rows = plans.marketplace_current(products, stock, costs, daily, ads, F.lit("1999-06-30").cast("date"))
    return rows.withColumns({c: F.col(c).cast("double") for c in ("current_price", "ads_28d")})
