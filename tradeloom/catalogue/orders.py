"""Order queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tradeloom.bindings import load, money, order_lines, piece_orders, status_log, text, whole
from tradeloom.catalogue import query
from tradeloom.functions.labels import status_label, status_tone
from tradeloom.operators.ordered import running_total
from tradeloom.plans import orders as plans
from tradeloom.session import scratch_path


def _all_days():
    return F.lit("1990-01-01").cast("date"), F.lit("2030-12-31").cast("date")


@query(
    "daily_order_export",
    """
    SELECT l_shipdate::DATE AS order_date, l_partkey::VARCHAR AS article, COUNT(*)::BIGINT AS quantity,
           SUM(COALESCE(CASE WHEN l_linestatus = 'O' THEN l_extendedprice::DECIMAL(12,2) END,
                        CASE WHEN l_returnflag = 'N' THEN l_extendedprice::DECIMAL(12,2) + 1 END,
                        l_extendedprice::DECIMAL(12,2) + 2))::DOUBLE AS amount
    FROM lineitem WHERE l_returnflag <> 'R' GROUP BY 1, 2
    """,
)
def daily_order_export(spark, sf_dir):
    daily = plans.piece_orders_daily(piece_orders(spark, sf_dir), *_all_days())
    return plans.export_order(daily).select("order_date", "article", "quantity", F.col("amount").cast("double").alias("amount"))


@query(
    "daily_order_export_items",
    """
    SELECT o_orderdate::DATE AS order_date,
           CASE WHEN l_returnflag = 'R' THEN l_suppkey::VARCHAR ELSE l_partkey::VARCHAR END AS article,
           SUM(l_quantity::BIGINT)::BIGINT AS quantity,
           SUM(l_extendedprice::DECIMAL(12,2) * l_quantity::BIGINT)::DOUBLE AS amount
    FROM lineitem LEFT JOIN orders ON o_orderkey = l_orderkey
    WHERE COALESCE(o_orderstatus, '') <> 'P' AND o_orderdate IS NOT NULL
    GROUP BY 1, 2
    """,
)
def daily_order_export_items(spark, sf_dir):
    daily = plans.item_orders_daily(order_lines(spark, sf_dir), *_all_days())
    return daily.select("order_date", "article", "quantity", F.col("amount").cast("double").alias("amount"))


@query(
    "orders_day_summary",
    """
    SELECT (o_orderdate + INTERVAL '24 hours 30 minutes')::DATE AS order_date,
           COUNT(DISTINCT o_custkey)::BIGINT AS orders_count,
           COUNT(DISTINCT NULLIF(o_orderpriority, '5-LOW'))::BIGINT AS articles_count,
           COUNT(*)::BIGINT AS quantity,
           SUM(o_totalprice::DECIMAL(12,2))::DOUBLE AS amount,
           COUNT(DISTINCT CASE WHEN o_orderstatus = 'F' THEN o_custkey END)::BIGINT AS cancelled_orders_count
    FROM orders GROUP BY 1
    """,
)
def orders_day_summary(spark, sf_dir):
    lines = load(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("order_group_key"),
        F.nullif("o_orderpriority", F.lit("5-LOW")).alias("article"),
        F.lit(1).alias("quantity"),
        money("o_totalprice").alias("price"),
        (F.col("o_orderstatus") == "F").alias("cancelled"),
        (F.col("o_orderdate").cast("timestamp") + F.expr("INTERVAL '21:30' HOUR TO MINUTE")).alias("placed_at"),
    )
    return plans.day_summary(lines).withColumn("amount", F.col("amount").cast("double"))


@query(
    "monthly_orders",
    """
    SELECT DATE_TRUNC('month', l_shipdate)::DATE AS month, COUNT(*)::BIGINT AS orders,
           SUM(CASE WHEN l_linestatus = 'O' THEN l_extendedprice::DECIMAL(12,2) END)::DOUBLE AS revenue,
           COUNT(*) FILTER (WHERE l_returnflag = 'R')::BIGINT AS cancels
    FROM lineitem GROUP BY 1
    """,
)
def monthly_orders(spark, sf_dir):
    return plans.monthly_orders(piece_orders(spark, sf_dir)).withColumn("revenue", F.col("revenue").cast("double"))


@query(
    "change_history",
    """
    SELECT event_id, user_id, event_type AS status,
           ROW_NUMBER() OVER w AS version_no, LAG(event_type) OVER w AS previous_status,
           LAG(event_type) OVER w IS DISTINCT FROM event_type AS status_changed
    FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)
    """,
)
def change_history(spark, sf_dir):
    history = plans.change_history(status_log(spark, sf_dir), "user_id", ["status"], ["event_id"])
    return history.select("event_id", "user_id", "status", "version_no", "previous_status", "status_changed")


@query(
    "posting_history",
    """
    WITH v AS (SELECT event_id, user_id::VARCHAR AS posting_number, ts, event_type AS status,
                      CASE WHEN value > 20 THEN event_type || '-big' END AS substatus,
                      'W' || (json_extract_string(props, '$.k')::INT // 10) AS warehouse_name
               FROM events)
    SELECT event_id, posting_number, 'N' || posting_number AS order_number,
           ROW_NUMBER() OVER w AS version_no,
           LAG(status) OVER w AS previous_status, status,
           LAG(substatus) OVER w AS previous_substatus, substatus,
           LAG(warehouse_name) OVER w AS previous_warehouse_name, warehouse_name,
           LAG(status) OVER w IS DISTINCT FROM status AS status_changed,
           LAG(substatus) OVER w IS DISTINCT FROM substatus AS substatus_changed,
           LAG(warehouse_name) OVER w IS DISTINCT FROM warehouse_name AS warehouse_changed
    FROM v WINDOW w AS (PARTITION BY posting_number ORDER BY ts, event_id)
    """,
)
def posting_history(spark, sf_dir):
    tenth = F.floor(F.get_json_object("props", "$.k").cast("int") / 10).cast("string")
    versions = status_log(spark, sf_dir).select(
        "event_id", text("user_id").alias("posting_number"), "changed_at", "status",
        F.when(F.col("value") > 20, F.concat("status", F.lit("-big"))).alias("substatus"),
        F.lpad(text("event_id"), 12, "0").alias("run_id"),
        F.to_json(
            F.struct(
                F.concat(F.lit("N"), text("user_id")).alias("order_number"),
                F.struct(F.concat(F.lit("W"), tenth).alias("warehouse_name")).alias("analytics_data"),
            )
        ).alias("payload"),
    )
    return plans.posting_history(versions).drop("changed_at", "run_id")


@query(
    "feed_history",
    """
    WITH v AS (SELECT event_id, user_id::VARCHAR AS srid, ts, event_type AS status,
                      CASE WHEN event_type = 'error' THEN 'by-' || (value > 10)::VARCHAR END AS cancel_type
               FROM events)
    SELECT event_id, srid, ROW_NUMBER() OVER w AS version_no,
           LAG(status) OVER w AS previous_status, status,
           LAG(cancel_type) OVER w AS previous_cancel_type, cancel_type,
           LAG(status) OVER w IS DISTINCT FROM status AS status_changed,
           LAG(cancel_type) OVER w IS DISTINCT FROM cancel_type AS cancel_type_changed
    FROM v WINDOW w AS (PARTITION BY srid ORDER BY ts, event_id)
    """,
)
def feed_history(spark, sf_dir):
    versions = status_log(spark, sf_dir).select(
        "event_id", text("user_id").alias("srid"), "changed_at", "status",
        F.when(F.col("status") == "error", F.concat(F.lit("by-"), (F.col("value") > 10).cast("string"))).alias("cancel_type"),
        F.lpad(text("event_id"), 12, "0").alias("run_id"), F.col("props").alias("payload"),
    )
    return plans.feed_history(versions).drop("changed_at", "run_id")


@query(
    "order_feed_page",
    """
    WITH lines AS (SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice, o_orderdate,
                          COALESCE(CASE WHEN o_orderpriority <> '5-LOW' THEN o_custkey::VARCHAR END, l_orderkey::VARCHAR)
                            AS order_group_key
                   FROM lineitem LEFT JOIN orders ON o_orderkey = l_orderkey),
    page AS (SELECT order_group_key, MAX(o_orderdate) AS group_date FROM lines GROUP BY 1
             ORDER BY group_date DESC NULLS LAST, order_group_key LIMIT 50 OFFSET 10)
    SELECT order_group_key, group_date::DATE AS group_date, l_orderkey AS order_key, l_linenumber, l_partkey, l_extendedprice
    FROM lines JOIN page USING (order_group_key)
    """,
)
def order_feed_page(spark, sf_dir):
    lines = order_lines(spark, sf_dir).withColumns(
        {"order_group_key": F.coalesce("order_number", "posting_number"), "sort_date": F.coalesce("in_process_at", "created_at")}
    )
    return plans.feed_page(lines, limit=50, offset=10, ties=("order_key", "l_linenumber", "l_partkey")).select(
        "order_group_key", F.to_date("group_date").alias("group_date"), "order_key", "l_linenumber", "l_partkey", "l_extendedprice"
    )


SQL_GROUPS = """
    lines AS (SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice, o_orderdate,
                     COALESCE(CASE WHEN o_orderpriority <> '5-LOW' THEN o_custkey::VARCHAR END, l_orderkey::VARCHAR) AS order_group_key
              FROM lineitem LEFT JOIN orders ON o_orderkey = l_orderkey),
    grouped AS (SELECT order_group_key, MAX(o_orderdate) AS group_date FROM lines GROUP BY 1)
"""


@query(
    "order_feed_seek",
    f"""
    WITH {SQL_GROUPS},
    page AS (SELECT * FROM grouped ORDER BY group_date DESC NULLS LAST, order_group_key LIMIT 60 OFFSET (SELECT (COUNT(*) * 3 // 4)::BIGINT FROM grouped)),
    ends AS (SELECT * FROM page ORDER BY group_date, order_group_key DESC LIMIT 1),
    next AS (SELECT g.* FROM grouped g, ends e WHERE g.group_date < e.group_date OR (g.group_date = e.group_date AND g.order_group_key > e.order_group_key)
             ORDER BY g.group_date DESC NULLS LAST, g.order_group_key LIMIT 20)
    SELECT 'offset' AS way, order_group_key, l_orderkey AS order_key, l_linenumber, l_partkey, l_extendedprice FROM lines JOIN page USING (order_group_key)
    UNION ALL SELECT 'after', order_group_key, l_orderkey, l_linenumber, l_partkey, l_extendedprice FROM lines JOIN next USING (order_group_key)
    """,
)
def order_feed_seek(spark, sf_dir):
    """A page three quarters down the feed, found by day, and the page after its last group."""
    lines = order_lines(spark, sf_dir).withColumns(
        {"order_group_key": F.coalesce("order_number", "posting_number"), "sort_date": F.coalesce("in_process_at", "created_at")}
    )
    index = scratch_path(spark, "feed-index")
    plans.write_feed_index(lines, index)
    groups = spark.read.parquet(index).count()
    page = plans.seek_groups(spark, index, limit=60, offset=groups * 3 // 4)
    last = page.orderBy("group_date", F.col("order_group_key").desc()).first()
    after = plans.groups_after(spark, index, F.lit(last.group_date).cast("timestamp_ntz"), last.order_group_key, limit=20)
    both = [plans.page_lines(lines, p, ("order_key",)).withColumn("way", F.lit(way)) for way, p in (("offset", page), ("after", after))]
    return both[0].unionByName(both[1]).select("way", "order_group_key", "order_key", "l_linenumber", "l_partkey", "l_extendedprice")


def _cards(spark, sf_dir):
    return load(spark, sf_dir, "part").select(
        text("p_partkey").alias("article"),
        F.col("p_size").cast("bigint").alias("marketplace_sku"),
        F.col("p_partkey").alias("updated_at"),
        F.concat_ws("/", "p_brand", "p_partkey").alias("primary_image"),
        F.array("p_brand", "p_type").alias("images"),
        F.col("p_name").alias("product_name"),
    )


@query(
    "card_newest_lookup",
    """
    WITH hit AS (
        SELECT l_partkey, l_suppkey, p_partkey AS card FROM lineitem JOIN part ON p_partkey = l_partkey
        UNION ALL
        SELECT l_partkey, l_suppkey, s.card FROM lineitem JOIN
            (SELECT p_size, MAX(p_partkey) AS card FROM part GROUP BY p_size) s ON s.p_size = l_suppkey),
    best AS (SELECT l_partkey, l_suppkey, MAX(card) AS card FROM hit GROUP BY 1, 2)
    SELECT l.l_orderkey AS order_key, l.l_linenumber, l.l_partkey, l.l_suppkey, best.card AS card, p_name AS product_name,
           p_brand || '/' || p_partkey AS primary_image
    FROM lineitem l LEFT JOIN best USING (l_partkey, l_suppkey) LEFT JOIN part ON p_partkey = best.card
    """,
)
def card_newest_lookup(spark, sf_dir):
    lines = load(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_key"), "l_linenumber", "l_partkey", "l_suppkey", text("l_partkey").alias("article"),
        F.col("l_suppkey").alias("marketplace_sku"),
    )
    return plans.newest_card(lines, _cards(spark, sf_dir)).select(
        "order_key", "l_linenumber", "l_partkey", "l_suppkey", F.col("card.updated_at").alias("card"),
        F.col("card.product_name").alias("product_name"), F.col("card.primary_image").alias("primary_image"),
    )


@query(
    "order_feed_decorated",
    """
    WITH best AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag, l_extendedprice,
                         GREATEST(p.p_partkey, s.card) AS card
                  FROM lineitem LEFT JOIN part p ON p.p_partkey = l_partkey
                  LEFT JOIN (SELECT p_size, MAX(p_partkey) AS card FROM part GROUP BY p_size) s ON s.p_size = l_suppkey)
    SELECT l_orderkey AS order_key, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
           CASE WHEN l_returnflag = 'R' THEN 'Отменён' ELSE 'Активный' END AS status_label,
           p_name AS product_name, p_brand || '/' || p_partkey AS image_url,
           p_brand || '/' || p_partkey || '|' || p_brand || '|' || p_type AS image_urls
    FROM best LEFT JOIN part ON p_partkey = card
    """,
)
def order_feed_decorated(spark, sf_dir):
    lines = load(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_key"), "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice",
        text("l_partkey").alias("article"), F.col("l_suppkey").alias("marketplace_sku"), F.lit(None).cast("string").alias("product_name"),
        F.when(F.col("l_returnflag") == "R", "cancelled").otherwise("active").alias("status"),
    )
    rows = plans.decorate(plans.newest_card(lines, _cards(spark, sf_dir)), "wb")
    return rows.select(
        "order_key", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "status_label", "product_name", "image_url",
        F.array_join("image_urls", "|").alias("image_urls"),
    )


@query(
    "order_detail",
    """
    WITH newest AS (SELECT o_custkey::VARCHAR AS k FROM orders WHERE o_orderpriority <> '5-LOW'
                    ORDER BY o_orderdate DESC, o_orderkey LIMIT 1)
    SELECT l_orderkey AS order_key, l_linenumber, l_partkey, l_extendedprice
    FROM lineitem JOIN orders ON o_orderkey = l_orderkey, newest
    WHERE l_orderkey::VARCHAR = k OR (o_orderpriority <> '5-LOW' AND o_custkey::VARCHAR = k)
    """,
)
def order_detail(spark, sf_dir):
    """All lines of the customer number of the newest order, found by any of the three keys."""
    newest = (
        load(spark, sf_dir, "orders").where(F.col("o_orderpriority") != "5-LOW")
        .orderBy(F.col("o_orderdate").desc(), "o_orderkey").limit(1).select(text("o_custkey"))
    )
    lines = order_lines(spark, sf_dir).withColumnRenamed("order_key", "number").withColumns(
        {"order_key": F.col("posting_number"), "order_group_key": F.coalesce("order_number", "posting_number")}
    )
    return plans.order_detail(lines, newest.scalar()).select(
        F.col("number").alias("order_key"), "l_linenumber", "l_partkey", "l_extendedprice"
    )


@query(
    "order_history_recent",
    """
    WITH h AS (SELECT user_id, ts, event_type AS status, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS version_no
               FROM events)
    SELECT user_id, status, version_no FROM h
    WHERE user_id IN (SELECT user_id FROM events WHERE event_type = 'purchase' AND value > 100)
    ORDER BY ts DESC, user_id, version_no DESC LIMIT 30
    """,
)
def order_history_recent(spark, sf_dir):
    log = status_log(spark, sf_dir)
    history = plans.change_history(log, "user_id", ["status"], ["event_id"])
    keys = log.where((F.col("status") == "purchase") & (F.col("value") > 100))
    return plans.recent_history(history, keys, "user_id").select("user_id", "status", "version_no")


def _group_lines(spark, sf_dir):
    return order_lines(spark, sf_dir).select(
        F.col("order_number").alias("order_group_key"), F.lit(None).cast("string").alias("order_number"),
        F.col("posting_number").alias("order_key"), F.col("product_quantity").alias("quantity"),
        F.col("product_price_amount").alias("price"), F.to_date("created_at").alias("order_date"),
        F.nullif("product_offer_id", F.lit("")).alias("article"), text("product_sku").alias("product_name"),
        F.struct("posting_number", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice").alias("arrival"),
        "status",
    )


@query(
    "order_groups",
    """
    WITH l AS (SELECT COALESCE(CASE WHEN o_orderpriority <> '5-LOW' THEN o_custkey::VARCHAR END, l_orderkey::VARCHAR) AS order_group,
                      l_quantity::BIGINT AS q, l_extendedprice::DECIMAL(12,2) AS p,
                      CASE WHEN o_orderstatus = 'P' THEN 'cancelled' ELSE o_orderstatus END AS status,
                      CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderdate::DATE END AS d,
                      ROW_NUMBER() OVER (ORDER BY l_orderkey::VARCHAR, l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS pos
               FROM lineitem LEFT JOIN orders ON o_orderkey = l_orderkey)
    SELECT order_group, SUM(q)::BIGINT AS total_quantity, SUM(q * p)::DOUBLE AS total_amount, COUNT(*)::BIGINT AS line_count,
           ARG_MIN(d, pos) FILTER (WHERE d IS NOT NULL) AS order_date, ARG_MIN(status, pos) AS status
    FROM l GROUP BY 1
    """,
)
def order_groups(spark, sf_dir):
    groups = plans.order_groups(_group_lines(spark, sf_dir), F.col("arrival"))
    return groups.select(
        "order_group", "total_quantity", F.col("total_amount").cast("double").alias("total_amount"), "line_count", "order_date", "status"
    )


@query(
    "product_groups",
    """
    SELECT CASE WHEN l_returnflag = 'R' THEN l_suppkey::VARCHAR ELSE l_partkey::VARCHAR END AS product_group,
           SUM(l_quantity::BIGINT)::BIGINT AS total_quantity,
           SUM(l_quantity::BIGINT * l_extendedprice::DECIMAL(12,2))::DOUBLE AS total_amount, COUNT(*)::BIGINT AS line_count
    FROM lineitem GROUP BY 1
    """,
)
def product_groups(spark, sf_dir):
    groups = plans.product_groups(_group_lines(spark, sf_dir), F.col("arrival"))
    return groups.select("product_group", "total_quantity", F.col("total_amount").cast("double").alias("total_amount"), "line_count")


@query(
    "product_group_images",
    """
    SELECT DISTINCT l_partkey::VARCHAR AS product_group, UNNEST(['s' || l_suppkey, 'f' || l_returnflag]) AS image_url
    FROM lineitem
    """,
)
def product_group_images(spark, sf_dir):
    lines = load(spark, sf_dir, "lineitem").select(
        text("l_partkey").alias("article"), F.lit(None).cast("string").alias("product_name"), "l_orderkey", "l_linenumber",
        F.array(F.concat(F.lit("s"), text("l_suppkey")), F.concat(F.lit("f"), "l_returnflag"), F.lit("")).alias("image_urls"),
    )
    images = plans.product_group_images(lines, F.struct("l_orderkey", "l_linenumber"))
    return images.select("product_group", "image_url")


@query(
    "status_labels",
    """
    SELECT o_orderkey,
           CASE o_orderstatus WHEN 'F' THEN 'Доставлен' WHEN 'O' THEN 'Ожидает отгрузки' ELSE 'hold-' || o_orderpriority END AS status_label,
           CASE o_orderstatus WHEN 'F' THEN 'good' WHEN 'O' THEN 'warn' ELSE 'info' END AS status_tone
    FROM orders
    """,
)
def status_labels(spark, sf_dir):
    status = (
        F.when(F.col("o_orderstatus") == "F", " Delivered")
        .when(F.col("o_orderstatus") == "O", "awaiting_deliver")
        .otherwise(F.concat(F.lit("hold-"), "o_orderpriority"))
    )
    rows = load(spark, sf_dir, "orders").select("o_orderkey", status_label(status, "ozon").alias("status_label"))
    return rows.withColumn("status_tone", status_tone("status_label"))


@query(
    "items_with_header",
    """
    SELECT l_orderkey::VARCHAR AS posting_number, l_linenumber, l_partkey, l_extendedprice, o_orderstatus AS header_status,
           o_custkey AS customer
    FROM lineitem LEFT JOIN (SELECT * FROM orders WHERE o_orderstatus <> 'P') o ON o.o_orderkey = l_orderkey
    """,
)
def items_with_header(spark, sf_dir):
    items = load(spark, sf_dir, "lineitem").select(text("l_orderkey").alias("posting_number"), "l_linenumber", "l_partkey", "l_extendedprice")
    headers = load(spark, sf_dir, "orders").where(F.col("o_orderstatus") != "P").select(
        text("o_orderkey").alias("posting_number"), F.col("o_orderstatus").alias("header_status"), F.col("o_custkey").alias("customer")
    )
    return plans.items_with_header(items, headers)


@query(
    "running_free_qty",
    """
    SELECT l_partkey AS article, l_orderkey, l_linenumber, l_suppkey, l_extendedprice,
           SUM(l_quantity::BIGINT) OVER (PARTITION BY l_partkey
               ORDER BY l_shipdate, l_orderkey, l_linenumber, l_suppkey, l_extendedprice
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)::BIGINT AS expired_qty
    FROM lineitem
    """,
)
def running_free_qty(spark, sf_dir):
    rows = load(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("article"), "l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice", "l_shipdate",
        whole("l_quantity").alias("qty"),
    )
    order = ["l_shipdate", "l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice"]
    total = running_total(rows, ["article"], order, "qty", "expired_qty")
    return total.select("article", "l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice", "expired_qty")
