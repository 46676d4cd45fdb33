"""Plans of the registered queries keep the shapes that hold at scale."""

import __spark_entry__ as entry
from pyspark.sql import functions as F

from tradeloom import catalogue
from tradeloom.bindings import piece_orders
from tradeloom.operators import keyed
from tradeloom.plans import orders

SF = "/root/testdata/sf0.001"
# these run streams or write files while they are built
EAGER = ("stream_", "delimited_", "landed_", "table_upserts", "table_replaced", "run_log_runs", "file_", "api_pages", "order_feed_seek", "publish_generations")
# the page of at most 100 groups, the row per partition of a range exchange, heavy keys and their ranges in a subquery
BOUNDED_BROADCAST = {"order_feed_page", "id_chunks", "publish_apply", "publish_update_ranges", "publish_order_check", "publish_blocks", "publish_replace_order"}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def unbounded_broadcasts(plan):
    """Broadcasts that do not come out of a frequent-items sketch, whose result has at most a fixed number of rows."""
    lines = plan.splitlines()
    depth = [next((i for i, c in enumerate(x) if c.isalnum() or c == "*"), 0) for x in lines]
    found = []
    for n, line in enumerate(lines):
        if "BroadcastExchange" in line:
            end = next((m for m in range(n + 1, len(lines)) if depth[m] <= depth[n]), len(lines))
            if not any("approx_top_k" in x for x in lines[n:end]):
                found.append(line)
    return found


def test_every_query_has_a_check():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(entry.queries()) >= 120


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["order_date", "article", "quantity", "amount"] and df.count() > 0


def test_no_plan_multiplies_rows_or_leaves_the_jvm(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        catalogue.load_all()
        for name, query in catalogue.QUERIES.items():
            if name.startswith(EAGER):
                continue
            plan = plan_of(query(spark, SF))
            for node in ("BroadcastNestedLoopJoin", "CartesianProduct", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
                assert node not in plan, (name, node)
            if name not in BOUNDED_BROADCAST:
                assert not unbounded_broadcasts(plan), name
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_copies_of_a_key_are_reduced_before_the_exchange(spark):
    rows = spark.read.parquet(f"{SF}/lineitem.parquet")
    plan = plan_of(keyed.dedupe_latest(rows, ["l_orderkey"], "l_shipdate", ["l_linenumber", "l_partkey"]))
    partial, exchange, final = plan.rfind("WindowGroupLimit"), plan.find("Exchange"), plan.find("WindowGroupLimit")
    assert final < exchange < partial


def test_filters_and_columns_reach_the_scan(spark, tmp_path):
    piece_orders(spark, SF).write.parquet(str(tmp_path / "orders"))
    stored = spark.read.parquet(str(tmp_path / "orders"))
    first, last = F.lit("1996-01-01").cast("date"), F.lit("1996-02-01").cast("date")
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    plan = plan_of(orders.piece_orders_daily(stored, first, last, "Europe/Moscow"))
    pushed = plan.split("PushedFilters: ")[1].split("ReadSchema")[0]
    for part in ("is_cancel", "GreaterThanOrEqual(date_ts,1995-12-31", "LessThan(date_ts,1996-02-03"):
        assert part in pushed, pushed
    schema = plan.split("ReadSchema: ")[1]
    assert "srid" not in schema


def test_card_lookup_is_two_equality_joins(spark):
    lines = spark.createDataFrame([(1, "a", 7), (2, "b", 7), (3, "x", 9), (4, None, None)], "n int, article string, marketplace_sku long")
    cards = spark.createDataFrame(
        [("a", 1, 1, "old"), ("a", 2, 5, "new a"), ("z", 7, 6, "by sku"), ("b", 8, 9, "by article")],
        "article string, marketplace_sku long, updated_at int, product_name string",
    ).withColumns({"primary_image": F.lit("i"), "images": F.array(F.lit("i"))})
    got = orders.newest_card(lines, cards)
    assert {r.n: r.card.product_name if r.card else None for r in got.collect()} == {1: "by sku", 2: "by article", 3: None, 4: None}
    assert "NestedLoop" not in plan_of(got)
