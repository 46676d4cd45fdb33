from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tradeloom.operators import publish, quality
from tradeloom.sources import tables

SLOW = settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def block(spark, rows, width=None):
    width = width or len(rows[0])
    schema = "position long, " + ", ".join(f"c{i + 1} string" for i in range(width))
    return spark.createDataFrame([(n, *[str(v) for v in row]) for n, row in enumerate(rows, start=1)], schema)


def summary(spark, existing, target, key=1, width=None, **options):
    width = width or len((existing or target)[0])
    cells = [f"c{i + 1}" for i in range(width)]
    return publish.plan_summary(block(spark, existing, width), block(spark, target, width), cells, key, **options).first()


def test_change_and_append(spark):
    got = summary(spark, [("a", "1", "x"), ("b", "1", "x")], [("a", "1", "x"), ("b", "1", "y"), ("c", "1", "z")], 2)
    assert (got.mode, got.unchanged_rows, got.changed_rows, got.appended_rows, got.stale_rows, got.updated_cells) == ("upsert", 1, 1, 1, 0, 6)
    assert not got.cleared and not got.header_updated and got.existing_rows == 2


def test_stale_key_replaces_all(spark):
    got = summary(spark, [("OLD", "1")], [("NEW", "1")])
    assert (got.mode, got.stale_rows, got.changed_rows, got.appended_rows, got.updated_cells, got.cleared) == ("replace-stale", 1, 1, 1, 4, True)


def test_order_change(spark):
    old, new = [("a", 1, 1, 1), ("b", 1, 1, 1)], [("b", 1, 1, 1), ("a", 1, 1, 1)]
    assert summary(spark, old, new).mode == "upsert"
    got = summary(spark, old, new, replace_on_order_change=True)
    assert (got.mode, got.updated_cells) == ("replace-order", 12)
    assert summary(spark, old, old, replace_on_order_change=True).mode == "upsert"


def test_order_breaks_equal_a_comparison_of_lists(spark, monkeypatch):
    import random

    rng = random.Random(1)
    monkeypatch.setattr(publish, "SPAN", 4)
    for _ in range(12):
        old = [rng.choice("abcdef ") for _ in range(rng.randint(0, 14))]
        new = list(old) if rng.random() < 0.5 else [rng.choice("abcdef ") for _ in old]
        if rng.random() < 0.4 and new:
            new.insert(rng.randrange(len(new)), " ")  # rows without a key do not count
        breaks = publish.order_breaks(block(spark, old, 1), block(spark, new, 1), ["c1"]).first().breaks
        assert (breaks > 0) == ([x for x in old if x != " "] != [x for x in new if x != " "]), (old, new)


def test_a_plan_has_one_join_and_few_exchanges(spark):
    one = block(spark, [("a", "1"), ("b", "1")]).repartition(2)
    plan = publish.classify_rows(one, one, ["c1", "c2"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Join") == 1 and plan.count("Exchange hashpartitioning(match") == 2


def test_values_compare_as_numbers(spark):
    got = summary(spark, [("А1", "617,5"), ("2", "1 000")], [("А1", "617.50"), ("2.0", "1000")])
    assert (got.unchanged_rows, got.updated_cells) == (2, 0)


def test_blank_keys_and_duplicates(spark):
    # a blank key never matches; of equal existing keys the first counts
    got = summary(spark, [("a", "1"), ("a", "2"), ("", "3")], [("a", "1"), (" ", "3")])
    assert (got.unchanged_rows, got.appended_rows, got.stale_rows, got.existing_rows) == (1, 1, 0, 3)


def test_header_and_replace(spark):
    got = summary(spark, [("a", "1")], [("a", "1"), ("b", "2")], header_matches=False)
    assert (got.appended_rows, got.updated_cells, got.header_updated) == (1, 4, True)
    got = summary(spark, [("a", "1")], [("b", "2")], mode="replace")
    assert (got.mode, got.stale_rows, got.updated_cells) == ("replace", 0, 4)


def test_ranges(spark):
    old, new = [("a", "1"), ("b", "1")], [("c", "1"), ("b", "2"), ("d", "1"), ("a", "1")]
    actions = publish.classify_rows(block(spark, old), block(spark, new), ["c1", "c2"])
    got = publish.update_ranges(actions, existing_rows=2).collect()
    assert sorted((r.sheet_row, r.cells.c1) for r in got) == [(3, "b"), (4, "c"), (5, "d")]


ROWS = st.dictionaries(st.sampled_from("abcdef"), st.integers(0, 2), min_size=1, max_size=6)


@SLOW
@given(ROWS, ROWS)
def test_applied_plan_holds_the_target(spark, old, extra):
    target = {k: v + 1 for k, v in old.items()} | extra
    existing = block(spark, list(old.items()))
    wanted = block(spark, list(target.items()))
    after = publish.apply_plan(existing, wanted, ["c1", "c2"], 1, replace=False).collect()
    assert {r.c1: r.c2 for r in after} == {k: str(v) for k, v in target.items()}
    assert sorted(r.position for r in after) == list(range(1, len(target) + 1))
    # keys stay where they were
    assert [r.c1 for r in sorted(after, key=lambda r: r.position)][: len(old)] == list(old)


def test_publish_writes_the_next_generation(spark, tmp_path):
    path = str(tmp_path / "block")
    first = block(spark, [("a", "1"), ("b", "1")])
    done = publish.publish(first.limit(0), first, ["c1", "c2"], path, 1)
    assert (done["mode"], done["appended_rows"], done["updated_cells"]) == ("upsert", 2, 4)
    second = block(spark, [("a", "1"), ("b", "2"), ("c", "3")])
    publish.publish(tables.read_newest(spark, path), second, ["c1", "c2"], path, 2)
    same = publish.publish(tables.read_newest(spark, path), second, ["c1", "c2"], path, 3)
    assert same["updated_cells"] == 0
    third = block(spark, [("c", "3"), ("b", "2")])
    gone = publish.publish(tables.read_newest(spark, path), third, ["c1", "c2"], path, 4)
    assert gone["mode"] == "replace-stale" and gone["stale_rows"] == 1
    assert [(r.c1, r.c2) for r in tables.read_newest(spark, path).orderBy("position").collect()] == [("c", "3"), ("b", "2")]


def test_shape(spark):
    df = spark.sql("SELECT DATE '2026-07-01' AS d, 'a' AS article, 3 AS q, CAST('10.50' AS DECIMAL(14,2)) AS m")
    row = publish.shape_for_publish(df, ["d", "article", "q", "m"], publish.BLOCKS["orders"]).first()
    assert tuple(row) == ("01.07.2026", "a", "3", "10.5")
    got = spark.range(1).select(
        publish.shape_cell(F.lit(Decimal("0.0004")), "quantity").alias("a"), publish.shape_cell(F.lit(Decimal("1.2500")), "quantity").alias("b"),
        publish.shape_cell(F.lit(None).cast("int"), "int").alias("c"), publish.shape_cell(F.lit(Decimal("100")), "money").alias("d"),
        publish.shape_cell(F.lit(Decimal("0")), "money").alias("e"), publish.shape_cell(F.lit(Decimal("1.0005")), "volume").alias("f"),
    ).first()
    assert tuple(got) == ("", "1.25", "", "100", "0", "1.001")


def test_warnings_and_quality(spark):
    plan = publish.plan_summary(block(spark, [("a", "1")]), block(spark, [("b", "1")]), ["c1", "c2"])
    warned = quality.export_warnings(plan, F.lit("2026-01-01").cast("date"), F.lit("2026-01-02").cast("date")).first()
    assert warned.rows_added and warned.rows_stale and warned.report_outdated
    assert quality.missing_tables(["a"], ["b", "a"]) == ["b"]
    pages = spark.createDataFrame([("r", 1), ("r", 2), ("s", 1)], "run_id string, snapshot_time int")
    assert [r.run_id for r in quality.one_snapshot_time(pages).collect()] == ["r"]
    rules = {"marketplace": F.col("m").isin(*quality.MARKETPLACES), "light": F.col("l").isin(*quality.STATUS_LIGHTS)}
    rows = spark.createDataFrame([(1, "wb", None), (2, "x", "blue")], "id int, m string, l string")
    assert sorted((r.id, r.rule) for r in quality.domain_violations(rows, rules, ["id"]).collect()) == [(2, "light"), (2, "marketplace")]


def test_blocks_are_sorted_and_cut(spark):
    rows = spark.createDataFrame(
        [("2026-03-01", "b", 1, "1.50", 5), ("2026-03-02", "a", 2, "2", 1), ("2026-03-01", "a", 3, "0", 9), ("2026-03-01", "c", 4, None, 5)],
        "d string, article string, quantity int, m string, newest int",
    ).select(F.to_date("d").alias("order_date"), "article", "quantity", F.col("m").cast("decimal(14,2)").alias("amount"), "newest")
    orders = publish.BLOCKS["orders"]
    got = [tuple(r) for r in publish.block_rows(rows, orders).orderBy("position").collect()]
    assert got == [(1, "02.03.2026", "a", "2", "2"), (2, "01.03.2026", "a", "3", "0"), (3, "01.03.2026", "b", "1", "1.5"), (4, "01.03.2026", "c", "4", "")]
    assert [r.position for r in publish.block_rows(rows, orders, limit=2).orderBy("position").collect()] == [1, 2]
    first, last = publish.default_period(orders, F.lit("2026-03-31").cast("date"))
    assert str(spark.range(1).select(first).first()[0]) == "2026-01-01"
    assert publish.default_period(publish.BLOCKS["placement"], F.lit("2026-03-31").cast("date")) is None
    assert all(len(b.headers) == len(b.formats) == len(b.columns) and b.sort for b in publish.BLOCKS.values())


def test_a_failed_job_named_like_its_action_counts(spark):
    from datetime import datetime

    from tradeloom.plans import ops

    now = datetime(2026, 1, 2)
    runs = spark.createDataFrame(
        [(1, now, " Sheets_Orders ", "error"), (2, now, "sheets_orders_export", "x"), (3, now, "erp_tru_sales", None), (4, now, "other", "x"), (5, now, "wb_orders", "OK")],
        "id long, started_at timestamp, job_name string, status string",
    )
    assert [(r.action_key, r.last_id, r.failures) for r in ops.failed_jobs(runs, F.lit(now)).collect()] == [("erp_tru_sales", 3, 1), ("sheets_orders", 2, 2)]


def test_update_ranges_compare_once(spark):
    existing = spark.createDataFrame([(1, "a", "1"), (2, "b", "2")], "position int, c1 string, c2 string")
    target = spark.createDataFrame([(1, "a", "9"), (2, "b", "2"), (3, "c", "3"), (4, "d", "4")], "position int, c1 string, c2 string")
    out = publish.update_ranges(publish.classify_rows(existing, target, ["c1", "c2"]), existing_rows=2)
    assert sorted((r.action, r.sheet_row) for r in out.collect()) == [("appended", 4), ("appended", 5), ("changed", 2)]
    assert "Join FullOuter" not in out._jdf.queryExecution().optimizedPlan().toString()
