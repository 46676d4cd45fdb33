"""Stock, inventory and cost queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tradeloom.bindings import load, money, text, whole
from tradeloom.catalogue import query
from tradeloom.operators import merge
from tradeloom.plans import stocks as plans

SQL_ARRIVAL = "l_shipdate, l_orderkey, l_linenumber, l_suppkey, l_extendedprice"


def _arrival():
    return F.struct("l_shipdate", "l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice")


@query(
    "stock_merge",
    f"""
    WITH s AS (SELECT *, ROW_NUMBER() OVER (ORDER BY {SQL_ARRIVAL}) AS pos,
                      NULLIF(CASE WHEN l_linestatus = 'O' THEN 'W' || l_suppkey ELSE '' END, '') AS w,
                      CASE WHEN l_returnflag <> 'R' THEN l_linenumber END AS d FROM lineitem)
    SELECT l_partkey AS sku, CASE WHEN l_returnflag = 'A' THEN 'A' ELSE '' END AS offer_id, 0::BIGINT AS cluster_id,
           SUM(l_quantity::BIGINT)::BIGINT AS available, SUM(CASE WHEN l_returnflag = 'N' THEN l_linenumber ELSE 0 END)::BIGINT AS transit,
           ARG_MIN(w, pos) FILTER (WHERE w IS NOT NULL) AS warehouse_name, ARG_MIN(d, pos) FILTER (WHERE d IS NOT NULL) AS days_without_sales,
           COUNT(*)::BIGINT AS merged_rows
    FROM s GROUP BY 1, 2
    """,
)
def stock_merge(spark, sf_dir):
    zero = F.lit(0).cast("bigint")
    known = {
        "sku": F.col("l_partkey"),
        "offer_id": F.when(F.col("l_returnflag") == "A", "A"),
        "cluster_id": F.lit(None).cast("bigint"),
        "available_stock_count": whole("l_quantity"),
        "transit_stock_count": F.when(F.col("l_returnflag") == "N", F.col("l_linenumber").cast("bigint")),
        "warehouse_name": F.when(F.col("l_linestatus") == "O", F.concat(F.lit("W"), text("l_suppkey"))).otherwise(""),
        "days_without_sales": F.when(F.col("l_returnflag") != "R", F.col("l_linenumber")),
    }
    rest = {c: zero for c in merge.STOCK_COUNTERS if c not in known}
    rest |= {c: F.lit(None).cast("string") for c in merge.STOCK_ATTRIBUTES if c not in known}
    rows = load(spark, sf_dir, "lineitem").withColumns({**known, **rest})
    return merge.merge_stock(rows, _arrival()).select(
        "sku", "offer_id", "cluster_id", F.col("available_stock_count").alias("available"),
        F.col("transit_stock_count").alias("transit"), "warehouse_name", "days_without_sales", "merged_rows",
    )


@query(
    "merged_payloads",
    """
    SELECT l_partkey AS sku, CASE WHEN l_returnflag = 'A' THEN 'A' ELSE '' END AS offer_id, 0::BIGINT AS cluster_id,
           l_orderkey || '-' || l_linenumber AS payload FROM lineitem
    """,
)
def merged_payloads(spark, sf_dir):
    rows = load(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("sku"), F.when(F.col("l_returnflag") == "A", "A").alias("offer_id"),
        F.lit(None).cast("bigint").alias("cluster_id"), F.concat_ws("-", "l_orderkey", "l_linenumber").alias("payload"),
    )
    return merge.merged_payloads(rows)


def _cost_rows(spark, sf_dir):
    """Line items as cost rows: five warehouses, some rows without a total."""
    names = list(merge.INVENTORY_WAREHOUSES)
    warehouse = F.element_at(F.array(*[F.lit(n) for n in names]), (F.col("l_suppkey") % 5 + 1).cast("int"))
    return load(spark, sf_dir, "lineitem").select(
        text("l_partkey").alias("article"), warehouse.alias("warehouse_name"), whole("l_quantity").alias("quantity"),
        F.when(F.col("l_returnflag") == "R", F.lit(0)).otherwise(money("l_extendedprice")).cast("decimal(12,2)").alias("total_cost_byn"),
        F.col("l_tax").cast("decimal(8,2)").alias("unit_cost_byn"),
        F.struct("l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice").alias("row_number"),
    )


@query(
    "cost_by_warehouse",
    """
    WITH c AS (SELECT l_partkey::VARCHAR AS article, l_suppkey % 5 AS w, l_quantity::BIGINT AS q,
                      CASE WHEN l_returnflag = 'R' THEN 0 ELSE l_extendedprice::DECIMAL(12,2) END AS t, l_tax::DECIMAL(8,2) AS u,
                      ROW_NUMBER() OVER (ORDER BY l_orderkey, l_linenumber, l_suppkey, l_extendedprice) AS pos FROM lineitem),
    g AS (SELECT article, w, SUM(q)::BIGINT AS quantity, SUM(t) AS total, ARG_MIN(u, pos) AS first_unit FROM c GROUP BY 1, 2)
    SELECT article, ['ДЛЯ МАРКЕТПЛЕЙСОВ', 'основной', 'Ответственное хранение Великий камень', 'Склад СВХ Великий камень',
                     'Таможенный склад (Великий камень)'][w + 1] AS warehouse_name, quantity, total::DOUBLE AS total_cost_byn,
           CASE WHEN total <> 0 THEN (2 * (total * 10000)::HUGEINT + quantity) // (2 * quantity) ELSE (first_unit * 10000)::HUGEINT END::BIGINT
             AS unit_cost_e4
    FROM g
    """,
)
def cost_by_warehouse(spark, sf_dir):
    costs = merge.merge_costs(_cost_rows(spark, sf_dir))
    return costs.select(
        "article", "warehouse_name", "quantity", F.col("total_cost_byn").cast("double").alias("total_cost_byn"),
        (F.col("unit_cost_byn") * 10000).cast("bigint").alias("unit_cost_e4"),
    )


@query(
    "weighted_unit_cost",
    """
    WITH g AS (SELECT CASE WHEN l_suppkey % 5 IN (0, 1, 2) THEN 'general' WHEN l_suppkey % 5 = 3 THEN 'wb' WHEN l_suppkey % 5 = 4 THEN 'ozon' END AS marketplace,
                      l_partkey::VARCHAR AS article, SUM(l_quantity::BIGINT)::BIGINT AS quantity,
                      SUM(CASE WHEN l_returnflag = 'R' THEN 0 ELSE l_extendedprice::DECIMAL(12,2) END) AS total,
                      SUM(l_tax::DECIMAL(8,2) * l_quantity::BIGINT) AS weighted
               FROM lineitem GROUP BY 1, 2)
    SELECT marketplace, article, quantity,
           CASE WHEN total <> 0 THEN (2 * (total * 100)::HUGEINT + quantity) // (2 * quantity)
                ELSE (2 * (weighted * 100)::HUGEINT + quantity) // (2 * quantity) END::BIGINT AS unit_cost_cents
    FROM g WHERE marketplace IS NOT NULL
    """,
)
def weighted_unit_cost(spark, sf_dir):
    names = list(merge.INVENTORY_WAREHOUSES)
    groups = {"ozon": (names[4],), "wb": (names[3],), "general": tuple(names[:3])}
    cost = plans.marketplace_cost(_cost_rows(spark, sf_dir), groups)
    return cost.select("marketplace", "article", "quantity", (F.col("unit_cost_byn") * 100).cast("bigint").alias("unit_cost_cents"))


@query(
    "inventory_pivot",
    """
    SELECT l_partkey::VARCHAR AS article,
           COALESCE(SUM(l_quantity::BIGINT) FILTER (WHERE l_suppkey % 5 = 0), 0)::BIGINT AS smp_qty,
           COALESCE(SUM(l_quantity::BIGINT) FILTER (WHERE l_suppkey % 5 = 1), 0)::BIGINT AS osn_qty,
           COALESCE(SUM(l_quantity::BIGINT) FILTER (WHERE l_suppkey % 5 = 2), 0)::BIGINT AS soh_qty,
           COALESCE(SUM(l_quantity::BIGINT) FILTER (WHERE l_suppkey % 5 = 3), 0)::BIGINT AS svh_qty,
           COALESCE(SUM(l_quantity::BIGINT) FILTER (WHERE l_suppkey % 5 = 4), 0)::BIGINT AS ts_qty
    FROM lineitem GROUP BY 1
    """,
)
def inventory_pivot(spark, sf_dir):
    return merge.pivot_inventory(_cost_rows(spark, sf_dir))


@query(
    "inventory_sum",
    """
    SELECT l_partkey::VARCHAR AS article, SUM(CASE WHEN l_returnflag = 'A' THEN l_quantity::BIGINT ELSE 0 END)::BIGINT AS smp_qty,
           SUM(CASE WHEN l_linestatus = 'O' THEN l_linenumber ELSE 0 END)::BIGINT AS osn_qty, 0::BIGINT AS soh_qty, 0::BIGINT AS svh_qty,
           SUM(CASE WHEN l_tax > 0.04 THEN 1 ELSE 0 END)::BIGINT AS ts_qty
    FROM lineitem WHERE l_returnflag = 'A' OR l_linestatus = 'O' OR l_tax > 0.04 GROUP BY 1
    """,
)
def inventory_sum(spark, sf_dir):
    zero = F.lit(0).cast("bigint")
    rows = load(spark, sf_dir, "lineitem").select(
        text("l_partkey").alias("article"),
        F.when(F.col("l_returnflag") == "A", whole("l_quantity")).otherwise(zero).alias("smp_qty"),
        F.when(F.col("l_linestatus") == "O", F.col("l_linenumber").cast("bigint")).otherwise(zero).alias("osn_qty"),
        zero.alias("soh_qty"), zero.alias("svh_qty"),
        F.when(F.col("l_tax") > 0.04, F.lit(1)).otherwise(0).cast("bigint").alias("ts_qty"),
    )
    return merge.sum_inventory(rows)


@query(
    "inventory_latest",
    "SELECT l_partkey::VARCHAR AS article, l_orderkey, l_linenumber, l_quantity::BIGINT AS qty FROM lineitem WHERE l_shipdate = (SELECT MAX(l_shipdate) FROM lineitem)",
)
def inventory_latest(spark, sf_dir):
    rows = plans.inventory_latest(load(spark, sf_dir, "lineitem"), "l_shipdate")
    return rows.select(text("l_partkey").alias("article"), "l_orderkey", "l_linenumber", whole("l_quantity").alias("qty"))


@query(
    "sales_nonzero",
    """
    SELECT l_partkey::VARCHAR AS article, SUM(CASE WHEN l_returnflag = 'R' THEN -1 ELSE 1 END * (l_linenumber - 3))::BIGINT AS sales_count
    FROM lineitem GROUP BY 1 HAVING SUM(CASE WHEN l_returnflag = 'R' THEN -1 ELSE 1 END * (l_linenumber - 3)) <> 0
    """,
)
def sales_nonzero(spark, sf_dir):
    sign = F.when(F.col("l_returnflag") == "R", -1).otherwise(1)
    rows = load(spark, sf_dir, "lineitem").select(
        text("l_partkey").alias("article"), (sign * (F.col("l_linenumber") - 3)).cast("bigint").alias("sales_count")
    )
    return plans.net_sales(rows)


@query(
    "top_stock",
    "SELECT l_partkey AS nm_id, SUM(l_quantity::BIGINT)::BIGINT AS total_qty FROM lineitem GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20",
)
def top_stock(spark, sf_dir):
    rows = load(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("nm_id"), whole("l_quantity").alias("quantity"))
    return plans.top_stock(rows)


@query(
    "latest_run_rows",
    """
    SELECT event_id, user_id, event_type FROM events
    WHERE user_id = (SELECT user_id FROM events ORDER BY ts DESC, user_id DESC LIMIT 1)
    """,
)
def latest_run_rows(spark, sf_dir):
    return plans.latest_run_rows(load(spark, sf_dir, "events"), "ts", "user_id").select("event_id", "user_id", "event_type")


def _location_rows(spark, sf_dir):
    return load(spark, sf_dir, "lineitem").select(
        text("l_partkey").alias("article"), text("l_suppkey").alias("location"),
        F.when(F.col("l_linestatus") == "O", whole("l_quantity")).otherwise(0).alias("quantity"),
        F.when(F.col("l_linestatus") == "F", whole("l_quantity")).otherwise(0).alias("in_way_qty"),
    )


@query(
    "stock_locations",
    """
    SELECT l_partkey::VARCHAR AS article, l_suppkey::VARCHAR AS location,
           SUM(CASE WHEN l_linestatus = 'O' THEN l_quantity::BIGINT ELSE 0 END)::BIGINT AS quantity,
           SUM(CASE WHEN l_linestatus = 'F' THEN l_quantity::BIGINT ELSE 0 END)::BIGINT AS in_way_qty
    FROM lineitem GROUP BY 1, 2
    """,
)
def stock_locations(spark, sf_dir):
    return plans.stock_locations(_location_rows(spark, sf_dir))


@query(
    "stock_summary",
    """
    SELECT l_partkey::VARCHAR AS article, COUNT(DISTINCT l_suppkey)::BIGINT AS locations,
           SUM(CASE WHEN l_linestatus = 'O' THEN l_quantity::BIGINT ELSE 0 END)::BIGINT AS quantity,
           SUM(CASE WHEN l_linestatus = 'F' THEN l_quantity::BIGINT ELSE 0 END)::BIGINT AS in_way_qty
    FROM lineitem GROUP BY 1
    """,
)
def stock_summary(spark, sf_dir):
    return plans.stock_summary(_location_rows(spark, sf_dir))


@query(
    "supply_stages",
    """
    SELECT l_partkey::VARCHAR AS article, SUM(CASE WHEN l_returnflag = 'A' THEN l_quantity::BIGINT ELSE 0 END)::BIGINT AS approved_order_qty,
           SUM(CASE WHEN l_returnflag = 'N' THEN l_quantity::BIGINT ELSE 0 END)::BIGINT AS in_production_qty,
           SUM(CASE WHEN l_returnflag = 'R' THEN l_quantity::BIGINT ELSE 0 END)::BIGINT AS ready_qty,
           SUM(CASE WHEN l_linestatus = 'F' THEN l_quantity::BIGINT ELSE 0 END)::BIGINT AS in_way_qty, MAX(l_shipdate)::DATE AS minsk_date
    FROM lineitem GROUP BY 1
    """,
)
def supply_stages(spark, sf_dir):
    def part(column, value):
        return F.sum(F.when(F.col(column) == value, whole("l_quantity")).otherwise(0))

    rows = load(spark, sf_dir, "lineitem").groupBy(text("l_partkey").alias("article")).agg(
        part("l_returnflag", "A").alias("approved_order_qty"), part("l_returnflag", "N").alias("in_production_qty"),
        part("l_returnflag", "R").alias("ready_qty"), part("l_linestatus", "F").alias("in_way_qty"),
        F.to_date(F.max("l_shipdate")).alias("minsk_date"),
    )
    return plans.supply_stages(rows)


@query(
    "supply_specs",
    """
    SELECT p_partkey::VARCHAR AS article, p_brand AS specification, CASE WHEN p_size > 25 THEN DATE '2026-01-01' + p_size END AS production_date FROM part
    """,
)
def supply_specs(spark, sf_dir):
    rows = load(spark, sf_dir, "part").select(
        text("p_partkey").alias("article"), F.col("p_brand").alias("specification"), F.col("p_type").alias("source_sheet"),
        F.col("p_partkey").alias("source_row_number"),
        F.when(F.col("p_size") > 25, F.date_add(F.lit("2026-01-01").cast("date"), F.col("p_size"))).alias("production_date"),
    )
    return plans.supply_specs(rows)
