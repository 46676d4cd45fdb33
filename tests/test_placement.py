import random
from datetime import date, timedelta
from decimal import Decimal

from pyspark.sql import functions as F

from tradeloom.operators.merge import pivot_cells, unpivot_payload
from tradeloom.plans import placement

DAY = date(2026, 1, 1)


def paid(spark, summary, supplies):
    a = spark.createDataFrame(summary, "sku int, stock_qty int, free_qty int")
    b = spark.createDataFrame(supplies, "sku int, days int, period_end date, qty int")
    return {r.sku: (r.days_until_first_paid, r.first_paid_period_end) for r in placement.first_paid(a, b).collect()}


def test_first_paid_cases(spark):
    stock = {1: 0, 2: 12, 3: 7, 4: 5, 5: 10, 6: 5, 7: None}
    supplies = [(sku, d, DAY + timedelta(days=d), q) for sku in (1, 2, 3, 4, 5, 7) for d, q in ((3, 4), (8, 6))]
    got = paid(spark, [(s, q, 10) for s, q in stock.items()], supplies)
    assert {s: d for s, (d, _) in got.items()} == {1: None, 2: 0, 3: 3, 4: 8, 5: 3, 6: None, 7: None}
    # stock above the free pieces is paid today, yet the period end of the first supply is still reported
    assert got[2][1] == DAY + timedelta(days=3) and got[1][1] is None


def loop(stock, free, supplies):
    """Row by row, as the definition reads."""
    if not stock or stock <= 0:
        return None, None
    left, days, ends = free, [], []
    for d, end, q in sorted(supplies, key=lambda s: (s[0], s[1] is None, s[1] or DAY)):
        left -= q
        if left < stock:
            days.append(d)
            if end:
                ends.append(end)
    first = 0 if stock > free else min(days, default=None)
    return first, min(ends, default=None)


def test_first_paid_against_a_loop(spark):
    rng = random.Random(11)
    summary, supplies, by_sku = [], [], {}
    for sku in range(60):
        free, stock = rng.randrange(0, 40), rng.choice([None, 0, *range(1, 45)])
        mine = [
            (d := rng.randrange(0, 6), None if rng.random() < 0.2 else DAY + timedelta(days=d + rng.randrange(3)), rng.randrange(1, 6))
            for _ in range(rng.randrange(0, 15))
        ]
        summary.append((sku, stock, free))
        supplies += [(sku, *m) for m in mine]
        by_sku[sku] = loop(stock, free, mine)
    assert paid(spark, summary, supplies) == by_sku


def report(spark, rows):
    return spark.createDataFrame(rows, "report_code string, row_number int, column_number int, column_name string, value_text string, value_numeric decimal(18,4)")


def cells(code, number, values, names=None):
    out = []
    for column, value in enumerate(values, start=1):
        name = names[column - 1] if names else f"c{column}"
        numeric = Decimal(value) if value and value.replace(".", "", 1).isdigit() else None
        out.append((code, number, column, name, value, numeric))
    return out


def supply_report(spark):
    names = ["SKU", "b", "c", "Остаток на складах на (1)", "e", "Номер поставки", "Склад поставки", "Дней до конца периода", "Дата окончания периода по поставкам", "2026-01-01"]
    rows = cells("s", 1, ["5", "", "", "7", "", " ", "", "4", "2026-02-02", "10"], names)
    rows += cells("s", 2, ["5", "", "", "", "", "S1", "W", "3", "2026-01-04 00:00:00", "4"], names)
    rows += cells("s", 3, ["5", "", "", "", "", "S2", "W", "8", "soon", "6"], names)
    rows += cells("s", 4, ["5", "", "", "", "", "S3", "W", "1", "2026-01-02", "0"], names)
    return report(spark, rows)


def test_first_paid_sources(spark):
    product = report(
        spark,
        cells("p", 1, ["x", "5", "A", "", "", "", "", "", "3"]) + cells("p", 2, ["x", "5", "B", "", "", "", "", "", "4"]) + cells("p", 3, ["x", "5", " ", "", "", "", "", "", "9"]),
    )
    supply = supply_report(spark)
    row = placement.first_paid_report(product, supply).collect()
    assert [(r.sku, r.stock_qty, r.free_qty, r.days_until_first_paid, r.first_paid_period_end) for r in row] == [(5, 7, 10, 3, date(2026, 1, 4))]
    row = placement.first_paid_report(None, supply, "report_column").first()
    assert (row.stock_qty, row.days_until_first_paid) == (7, 3)
    stock = spark.createDataFrame([(5, 2), (5, 3)], "sku long, available_stock_count int")
    row = placement.first_paid_report(None, supply, "stock_layer", stock).first()
    assert (row.stock_qty, row.days_until_first_paid, row.first_paid_period_end) == (5, 8, None)
    row = placement.first_paid_report(None, supply, "summary").first()
    assert (row.stock_qty, row.free_qty, row.days_until_first_paid, row.first_paid_period_end) == (None, 10, 4, date(2026, 2, 2))


def test_payload_rows_give_what_their_cells_give(spark):
    import json

    names = ["SKU", "b", "c", "Остаток на складах на (1)", "Остаток на складах на (2)", "Номер поставки", "w", "Дней до конца периода", "Дата окончания периода по поставкам", "z"]
    values = [
        ["5", "", "", "7", "9", " ", "", "4", "2026-02-02", "10"], ["5", "", "", "", None, "S1", "W", "3", "2026-01-04 00:00:00", "4,5"],
        ["6", "", "", "x", "1 0", "\u00a0", "", "-", "-", "3"], ["6", None, "", "", "", "S3", "W", "1", "soon", "2"], ["7", "", "", "1"],
    ]
    rows = spark.createDataFrame([("s", n, json.dumps(dict(zip(names, v)), ensure_ascii=False)) for n, v in enumerate(values, 1)], "report_code string, row_number int, payload string")
    for by_name, with_text in ((False, False), (True, True)):
        by_cells = placement.supply_rows_wide(placement.report_cells(rows), by_name, with_text)
        by_payload = placement.supply_rows_wide(rows, by_name, with_text)
        order = sorted(by_cells.columns)
        assert sorted(map(tuple, by_cells.select(order).collect()), key=str) == sorted(map(tuple, by_payload.select(order).collect()), key=str)
        plan = by_payload._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning" not in plan.split("Subquery")[0]
    product = spark.createDataFrame([("p", n, json.dumps({f"c{i}": v for i, v in enumerate(["x", s, a, "", "", "", "", "", q])})) for n, (s, a, q) in enumerate(
        [("5", "A", "3"), ("5", "B", "4,5"), ("5", " ", "9"), ("n", "A", "1"), ("6", "C", "-")], 1)], "report_code string, row_number int, payload string")
    totals = [{(r.sku, r.product_qty) for r in placement.product_totals(p).collect()} for p in (product, placement.report_cells(product))]
    assert totals[0] == totals[1] and len(totals[0]) == 2


def test_reports_and_cost(spark):
    reports = spark.createDataFrame(
        [("a", DAY, DAY, "success", 1), ("b", DAY, DAY, "success", 2), ("c", DAY, DAY + timedelta(days=1), "success", 1), ("d", DAY, DAY + timedelta(days=2), "error", 1)],
        "code string, date_from date, date_to date, status string, updated_at int",
    )
    rows = spark.createDataFrame([("a", 1), ("b", 1), ("b", 2), ("d", 1)], "report_code string, sku int")
    assert placement.latest_report(reports).first().code == "c"
    newest = placement.latest_report(reports, rows)
    assert newest.first().code == "b"
    assert placement.report_selection(reports, rows).first().rows_count == 2
    assert placement.of_report(rows, newest).count() == 2
    assert placement.same_period_report(reports, newest).first().code == "b"
    text = spark.createDataFrame(
        [(" 5 ", "A", "1 0", "1500", "2,345"), ("5", "A", "x", "1", "1"), ("z", "", "1", "1", "1"), (None, None, "1", "1", "1")],
        "sku_text string, article_text string, paid_qty_text string, paid_ml_text string, cost_text string",
    )
    got = {r.article: (r.sku, r.paid_qty, r.paid_liters, r.daily_writeoff_rub) for r in placement.storage_cost(text).collect()}
    assert got == {"A": (5, 10, Decimal("1.501"), Decimal("3.35")), "z": (None, 1, Decimal("0.001"), Decimal("1.00"))}


def test_unpivot_then_pivot(spark):
    df = spark.createDataFrame([(1, '{"b":"x","a":"1,5"}'), (2, '{"b":"y","a":null}')], "id int, payload string")
    long = unpivot_payload(df, ["id"], "payload")
    assert [(r.id, r.column_number, r.column_name, r.value_text) for r in long.orderBy("id", "column_number").collect()] == [
        (1, 1, "b", "x"), (1, 2, "a", "1,5"), (2, 1, "b", "y"), (2, 2, "a", None),
    ]
    wide = pivot_cells(long, ["id"], {n: F.when(F.col("column_name") == n, F.col("value_text")) for n in ("a", "b")})
    assert {r.id: (r.a, r.b) for r in wide.collect()} == {1: ("1,5", "x"), 2: (None, "y")}


def test_cells_not_asked_for_are_left_out_before_numbers_are_read(spark):
    import json

    values = [["5", "1", "2", "3", "4", " ", "w", "-", "-", "10"], ["5", "9", "9", "9", "9", "S1", "w", "8", "2026-01-04", "6"], ["", "9"], ["x", "9", "", "", "", "", "", "", "", "7"]]
    names = [f"c{i}" for i in range(1, 11)]
    rows = spark.createDataFrame([("s", n, json.dumps(dict(zip(names, v)))) for n, v in enumerate(values, 1)], "report_code string, row_number int, payload string")
    cells = placement.report_cells(rows)
    every, some = (placement.supply_rows_wide(cells, all_rows=a).where("sku is not null") for a in (True, False))
    assert sorted(map(tuple, every.collect()), key=str) == sorted(map(tuple, some.collect()), key=str)
    stock = spark.createDataFrame([(5, 5)], "sku long, available_stock_count int")
    paid = placement.first_paid_report(None, cells, "stock_layer", stock)
    row = paid.first()
    assert (row.sku, row.stock_qty, row.free_qty, row.days_until_first_paid) == (5, 5, 10, 8)
    plan = paid._jdf.queryExecution().optimizedPlan().toString()
    assert any("Filter" in line and f"+ 1) = {placement.SUPPLY_DAYS})" in line for line in plan.splitlines())
