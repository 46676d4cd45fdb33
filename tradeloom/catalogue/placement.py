"""Placement queries: report cells built from the given tables and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from tradeloom.bindings import load, load_spread, text, whole
from tradeloom.catalogue import query
from tradeloom.operators.merge import pivot_cells, unpivot_payload
from tradeloom.plans import placement as plans


@query(
    "cells_unpivot",
    """
    SELECT p_partkey, 1 AS column_number, 'SKU' AS column_name, p_partkey::VARCHAR AS value_text, p_partkey::DOUBLE AS value_numeric FROM part
    UNION ALL SELECT p_partkey, 2, 'Артикул', p_brand, NULL FROM part
    UNION ALL SELECT p_partkey, 3, 'Цена', REPLACE(p_size::VARCHAR || '.5', '.', ','), p_size + 0.5 FROM part
    """,
)
def cells_unpivot(spark, sf_dir):
    payload = F.concat(
        F.lit('{"SKU":'), text("p_partkey"), F.lit(',"Артикул":"'), "p_brand", F.lit('","Цена":"'), text("p_size"), F.lit(',5"}')
    )
    rows = load(spark, sf_dir, "part").select("p_partkey", payload.alias("payload"))
    return unpivot_payload(rows, ["p_partkey"], "payload").withColumn("value_numeric", F.col("value_numeric").cast("double"))


@query(
    "cells_pivot",
    "SELECT p_partkey, p_partkey::DOUBLE AS sku, p_brand AS article, (p_size + 0.5)::DOUBLE AS last_value FROM part",
)
def cells_pivot(spark, sf_dir):
    payload = F.to_json(F.struct(text("p_partkey").alias("SKU"), F.col("p_brand").alias("Артикул"), (F.col("p_size") + 0.5).alias("Цена")))
    cells = unpivot_payload(load(spark, sf_dir, "part").select("p_partkey", payload.alias("payload")), ["p_partkey"], "payload")
    last = cells.agg(F.max("column_number")).scalar()
    wide = pivot_cells(
        cells.withColumn("is_last", F.col("column_number") == last),
        ["p_partkey"],
        {
            "sku": F.when(F.col("column_name") == "SKU", F.col("value_numeric").cast("double")),
            "article": F.when(F.col("column_name").like("Арти%"), F.col("value_text")),
            "last_value": F.when(F.col("is_last"), F.col("value_numeric").cast("double")),
        },
    )
    return wide


def _supplies(spark, sf_dir):
    """Line items as free pieces that expire some days after 1995."""
    days = F.datediff(F.to_date("l_shipdate"), F.lit("1995-01-01").cast("date"))
    return load(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("sku"), days.alias("days"), F.to_date("l_shipdate").alias("period_end"), whole("l_quantity").alias("qty")
    )


SQL_PAID = """
    sup AS (SELECT l_partkey AS sku, (l_shipdate::DATE - DATE '1995-01-01')::INT AS d, l_shipdate::DATE AS pe, l_quantity::BIGINT AS qty,
                   l_orderkey, l_linenumber, l_suppkey, l_extendedprice FROM lineitem),
    run AS (SELECT *, SUM(qty) OVER (PARTITION BY sku ORDER BY d, pe, l_orderkey, l_linenumber, l_suppkey, l_extendedprice
                                     ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS expired FROM sup)
"""


@query(
    "first_paid_day",
    f"""
    WITH {SQL_PAID}, base AS (SELECT p_partkey AS sku, p_size * 17 AS stock_qty, p_partkey % 900 + 100 AS free_qty FROM part)
    SELECT b.sku, b.stock_qty::BIGINT AS stock_qty, b.free_qty::BIGINT AS free_qty,
           CASE WHEN stock_qty <= 0 THEN NULL WHEN stock_qty > free_qty THEN 0
                ELSE MIN(d) FILTER (WHERE free_qty - expired < stock_qty) END::INT AS days_until_first_paid,
           MIN(pe) FILTER (WHERE stock_qty > 0 AND free_qty - expired < stock_qty) AS first_paid_period_end
    FROM base b LEFT JOIN run USING (sku) GROUP BY b.sku, b.stock_qty, b.free_qty
    """,
)
def first_paid_day(spark, sf_dir):
    summary = load(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("sku"), (F.col("p_size") * 17).cast("bigint").alias("stock_qty"),
        (F.col("p_partkey") % 900 + 100).alias("free_qty"),
    )
    return plans.first_paid(summary, _supplies(spark, sf_dir))


def _reports(spark, sf_dir):
    """Orders as reports: one period per order date, two statuses."""
    return load(spark, sf_dir, "orders").select(
        text("o_orderkey").alias("code"), F.to_date("o_orderdate").alias("date_from"), F.to_date("o_orderdate").alias("date_to"),
        F.when(F.col("o_orderstatus") == "P", "error").otherwise("success").alias("status"), F.col("o_custkey").alias("updated_at"),
    )


@query(
    "latest_nonempty_report",
    """
    SELECT o_orderkey::VARCHAR AS code, o_orderdate::DATE AS report_date, COUNT(*)::BIGINT AS rows_count
    FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE o_orderstatus <> 'P'
    GROUP BY o_orderkey, o_orderdate, o_custkey ORDER BY o_orderdate DESC, o_custkey DESC, 1 LIMIT 1
    """,
)
def latest_nonempty_report(spark, sf_dir):
    rows = load(spark, sf_dir, "lineitem").select(text("l_orderkey").alias("report_code"))
    return plans.report_selection(_reports(spark, sf_dir), rows)


@query(
    "latest_report_rows",
    """
    SELECT l_orderkey::VARCHAR AS report_code, l_linenumber, l_partkey FROM lineitem WHERE l_orderkey = (
        SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P' AND o_orderkey IN (SELECT l_orderkey FROM lineitem)
        ORDER BY o_orderdate DESC, o_custkey DESC, o_orderkey::VARCHAR LIMIT 1)
    """,
)
def latest_report_rows(spark, sf_dir):
    rows = load(spark, sf_dir, "lineitem").select(text("l_orderkey").alias("report_code"), "l_linenumber", "l_partkey")
    return plans.of_report(rows, plans.latest_report(_reports(spark, sf_dir), rows))


@query(
    "period_join",
    """
    WITH p AS (SELECT o_orderdate::DATE AS d FROM orders WHERE o_orderstatus <> 'P' AND o_orderkey IN (SELECT l_orderkey FROM lineitem)
               ORDER BY o_orderdate DESC, o_custkey DESC, o_orderkey::VARCHAR LIMIT 1)
    SELECT o_orderkey::VARCHAR AS code, o_orderdate::DATE AS date_from FROM orders, p
    WHERE o_orderdate::DATE = p.d AND o_orderstatus <> 'P' ORDER BY o_custkey DESC, 1 LIMIT 1
    """,
)
def period_join(spark, sf_dir):
    reports = _reports(spark, sf_dir)
    rows = load(spark, sf_dir, "lineitem").select(text("l_orderkey").alias("report_code"))
    return plans.same_period_report(reports, plans.latest_report(reports, rows)).select("code", "date_from")


@query(
    "placement_flat",
    """
    SELECT l_shipdate::DATE::VARCHAR AS report_code, l_orderkey, l_linenumber AS row_number, l_partkey AS sku, d AS date_from, d AS date_to
    FROM lineitem LEFT JOIN (SELECT DISTINCT o_orderdate::DATE AS d FROM orders) ON d = l_shipdate::DATE
    """,
)
def placement_flat(spark, sf_dir):
    """One report per order date; line items are rows of the report of their ship date."""
    day = F.to_date("o_orderdate")
    reports = load(spark, sf_dir, "orders").select(day.cast("string").alias("code"), day.alias("date_from"), day.alias("date_to")).distinct()
    rows = load(spark, sf_dir, "lineitem").select(
        F.to_date("l_shipdate").cast("string").alias("report_code"), "l_orderkey", F.col("l_linenumber").alias("row_number"),
        F.col("l_partkey").alias("sku"),
    )
    return plans.placement_flat(rows, reports)


def _product_payload(spark, sf_dir):
    """Parts as rows of the product report, nine columns in order."""
    cells = [text("p_brand"), text("p_partkey"), text("p_partkey"), F.col("p_name"), text("p_type"), F.lit("x"), F.lit("x"), F.lit("x"),
             F.concat(text("p_size"), F.lit(",0"))]
    payload = F.to_json(F.struct(*[c.alias(f"c{i}") for i, c in enumerate(cells, start=1)]))
    return load(spark, sf_dir, "part").select(F.lit("R").alias("report_code"), F.col("p_partkey").alias("row_number"), payload.alias("payload"))


def _supply_payload(spark, sf_dir):
    """Line items as supplies and parts as summary rows of the supplies report, ten columns."""
    def row(sku, number, days, period_end, free):
        cells = [sku, F.lit("a"), F.lit("b"), F.lit("c"), F.lit("d"), number, F.lit("Склад"), days, period_end, free]
        return F.to_json(F.struct(*[c.alias(f"c{i}") for i, c in enumerate(cells, start=1)]))

    supplies = load_spread(spark, sf_dir, "lineitem").select(
        F.xxhash64("l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice").alias("row_number"),
        row(
            text("l_partkey"), F.concat(F.lit("S"), text("l_orderkey")),
            F.datediff(F.to_date("l_shipdate"), F.lit("1995-01-01").cast("date")).cast("string"),
            F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss"), F.concat(text("l_linenumber"), F.lit(",0")),
        ).alias("payload"),
    )
    summary = load(spark, sf_dir, "part").select(
        (-F.col("p_partkey") - 1).alias("row_number"),
        row(text("p_partkey"), F.lit(" "), F.lit("-"), F.lit("-"), (F.col("p_partkey") % 60 + 20).cast("string")).alias("payload"),
    )
    return supplies.unionByName(summary).select(F.lit("S").alias("report_code"), "row_number", "payload")


@query(
    "first_paid_report",
    """
    WITH sup AS (SELECT l_partkey AS sku, (l_shipdate::DATE - DATE '1995-01-01')::INT AS d, l_shipdate::DATE AS pe, l_linenumber AS qty,
                        l_orderkey, l_linenumber, l_suppkey, l_extendedprice FROM lineitem),
    run AS (SELECT *, SUM(qty) OVER (PARTITION BY sku ORDER BY d, pe, l_orderkey, l_linenumber, l_suppkey, l_extendedprice
                                     ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS expired FROM sup),
    base AS (SELECT p_partkey AS sku, p_size AS stock_qty, p_partkey % 60 + 20 AS free_qty FROM part)
    SELECT b.sku, b.stock_qty::INT AS stock_qty, b.free_qty::INT AS free_qty,
           CASE WHEN stock_qty <= 0 THEN NULL WHEN stock_qty > free_qty THEN 0
                ELSE MIN(d) FILTER (WHERE free_qty - expired < stock_qty) END::INT AS days_until_first_paid,
           MIN(pe) FILTER (WHERE stock_qty > 0 AND free_qty - expired < stock_qty) AS first_paid_period_end
    FROM base b LEFT JOIN run USING (sku) GROUP BY b.sku, b.stock_qty, b.free_qty
    """,
)
def first_paid_report(spark, sf_dir):
    """Both reports as JSON rows whose columns are read by position, then the first paid day."""
    return plans.first_paid_report(_product_payload(spark, sf_dir), _supply_payload(spark, sf_dir))


def _named_supply(spark, sf_dir):
    """The supplies report with the headers of its columns, and stock, days and period end in its summary rows."""
    names = ["SKU", "b", "c", plans.STOCK_COLUMN_PREFIX + "01.01)", "e", "Номер поставки", "Склад", "Дней до конца периода",
             "Дата окончания периода по поставкам", "Свободно"]

    def row(*cells):
        return F.to_json(F.struct(*[c.alias(n) for n, c in zip(names, cells)])).alias("payload")

    x, part = F.lit("x"), load(spark, sf_dir, "part")
    supplies = load_spread(spark, sf_dir, "lineitem").select(
        F.xxhash64("l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice").alias("row_number"),
        row(text("l_partkey"), x, x, F.lit(""), x, F.concat(F.lit("S"), text("l_orderkey")), x,
            F.datediff(F.to_date("l_shipdate"), F.lit("1995-01-01").cast("date")).cast("string"),
            F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss"), F.concat(text("l_linenumber"), F.lit(",0"))),
    )
    end = F.date_format(F.date_add(F.lit("2026-01-01").cast("date"), F.col("p_size")), "yyyy-MM-dd HH:mm:ss")
    summary = part.select(
        (-F.col("p_partkey") - 1).alias("row_number"),
        row(text("p_partkey"), x, x, F.concat(text("p_size"), F.lit(",0")), x, F.lit("\u00a0"), x, text("p_size"), end,
            (F.col("p_partkey") % 60 + 20).cast("string")),
    )
    return supplies.unionByName(summary).withColumn("report_code", F.lit("S"))


@query(
    "first_paid_report_column",
    """
    WITH sup AS (SELECT l_partkey AS sku, (l_shipdate::DATE - DATE '1995-01-01')::INT AS d, l_shipdate::DATE AS pe, l_linenumber AS qty,
                        l_orderkey, l_linenumber, l_suppkey, l_extendedprice FROM lineitem),
    run AS (SELECT *, SUM(qty) OVER (PARTITION BY sku ORDER BY d, pe, l_orderkey, l_linenumber, l_suppkey, l_extendedprice
                                     ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS expired FROM sup),
    base AS (SELECT p_partkey AS sku, p_size AS stock_qty, p_partkey % 60 + 20 AS free_qty FROM part)
    SELECT b.sku, b.stock_qty::INT AS stock_qty, b.free_qty::INT AS free_qty,
           CASE WHEN stock_qty <= 0 THEN NULL WHEN stock_qty > free_qty THEN 0
                ELSE MIN(d) FILTER (WHERE free_qty - expired < stock_qty) END::INT AS days_until_first_paid,
           MIN(pe) FILTER (WHERE stock_qty > 0 AND free_qty - expired < stock_qty) AS first_paid_period_end
    FROM base b LEFT JOIN run USING (sku) GROUP BY b.sku, b.stock_qty, b.free_qty
    """,
)
def first_paid_report_column(spark, sf_dir):
    """The stock stands in a named column of the supplies report itself."""
    return plans.first_paid_report(None, _named_supply(spark, sf_dir), "report_column")


@query(
    "first_paid_summary",
    """
    SELECT p_partkey AS sku, NULL::INT AS stock_qty, (p_partkey % 60 + 20)::INT AS free_qty, p_size::INT AS days_until_first_paid,
           DATE '2026-01-01' + p_size::INT AS first_paid_period_end FROM part
    """,
)
def first_paid_summary(spark, sf_dir):
    """The days printed in the summary rows."""
    return plans.first_paid_report(None, plans.report_cells(_named_supply(spark, sf_dir)), "summary")


@query(
    "first_paid_chain",
    """
    WITH sup AS (SELECT l_partkey AS sku, (l_shipdate::DATE - DATE '1995-01-01')::INT AS d, l_shipdate::DATE AS pe, l_linenumber AS qty,
                        l_orderkey, l_linenumber, l_suppkey, l_extendedprice FROM lineitem WHERE l_returnflag = 'N'),
    run AS (SELECT *, SUM(qty) OVER (PARTITION BY sku ORDER BY d, pe, l_orderkey, l_linenumber, l_suppkey, l_extendedprice
                                     ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS expired FROM sup),
    base AS (SELECT p_partkey AS sku, p_size + 2 AS stock_qty, p_partkey % 60 + 20 AS free_qty FROM part)
    SELECT b.sku, b.stock_qty::INT AS stock_qty, b.free_qty::INT AS free_qty,
           CASE WHEN stock_qty <= 0 THEN NULL WHEN stock_qty > free_qty THEN 0
                ELSE MIN(d) FILTER (WHERE free_qty - expired < stock_qty) END::INT AS days_until_first_paid,
           MIN(pe) FILTER (WHERE stock_qty > 0 AND free_qty - expired < stock_qty) AS first_paid_period_end
    FROM base b LEFT JOIN run USING (sku) GROUP BY b.sku, b.stock_qty, b.free_qty
    """,
)
def first_paid_chain(spark, sf_dir):
    """A report a return flag: the newest product report that succeeded, the supplies report of its period, the first paid day."""
    flags, part = {"A": 1, "N": 2, "R": 3}, load(spark, sf_dir, "part")
    names = [f"c{i}" for i in range(1, 11)]

    def row(*cells):
        return F.to_json(F.struct(*[c.alias(n) for n, c in zip(names, cells)])).alias("payload")

    x = F.lit("x")
    each = F.explode(F.array(*[F.struct(F.lit(f).alias("flag"), F.lit(n).alias("n")) for f, n in flags.items()])).alias("r")
    parts = part.select("p_partkey", "p_size", each)
    product = parts.select(
        F.concat(F.lit("P-"), "r.flag").alias("report_code"), F.col("p_partkey").alias("row_number"),
        row(x, text("p_partkey"), text("p_partkey"), x, x, x, x, x, (F.col("p_size") + F.col("r.n")).cast("string")),
    )
    lines = load_spread(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("S-"), "l_returnflag").alias("report_code"), F.xxhash64("l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice").alias("row_number"),
        row(text("l_partkey"), x, x, x, x, F.lit("S1"), x, F.datediff(F.to_date("l_shipdate"), F.lit("1995-01-01").cast("date")).cast("string"),
            F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss"), text("l_linenumber")),
    )
    summary = parts.select(
        F.concat(F.lit("S-"), "r.flag").alias("report_code"), (-F.col("p_partkey") - 1).alias("row_number"),
        row(text("p_partkey"), x, x, x, x, F.lit(" "), x, F.lit("-"), F.lit("-"), (F.col("p_partkey") % 60 + 20).cast("string")),
    )
    day = F.date_add(F.lit("2026-01-01").cast("date"), F.col("r.n"))
    reports = part.select(each).distinct().select(
        F.col("r.flag").alias("flag"), day.alias("date_from"), day.alias("date_to"), F.col("r.n").alias("updated_at"),
        F.when(F.col("r.flag") == "R", "error").otherwise("success").alias("status"),
    )
    coded = lambda prefix: reports.withColumn("code", F.concat(F.lit(prefix), "flag")).drop("flag")
    return plans.first_paid_of_reports(product, lines.unionByName(summary), coded("P-"), coded("S-"))


@query(
    "first_paid_stock_layer",
    """
    WITH sup AS (SELECT l_partkey AS sku, (l_shipdate::DATE - DATE '1995-01-01')::INT AS d, l_shipdate::DATE AS pe, l_linenumber AS qty,
                        l_orderkey, l_linenumber, l_suppkey, l_extendedprice FROM lineitem),
    run AS (SELECT *, SUM(qty) OVER (PARTITION BY sku ORDER BY d, pe, l_orderkey, l_linenumber, l_suppkey, l_extendedprice
                                     ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS expired FROM sup),
    st AS (SELECT l_partkey AS sku, COUNT(*) AS stock_qty FROM lineitem WHERE l_returnflag = 'A' GROUP BY 1),
    base AS (SELECT p_partkey AS sku, stock_qty, p_partkey % 60 + 20 AS free_qty FROM part LEFT JOIN st ON st.sku = p_partkey)
    SELECT b.sku, COALESCE(b.stock_qty, 0)::INT AS stock_qty, b.free_qty::INT AS free_qty,
           CASE WHEN COALESCE(stock_qty, 0) <= 0 THEN NULL WHEN stock_qty > free_qty THEN 0
                ELSE MIN(d) FILTER (WHERE free_qty - expired < stock_qty) END::INT AS days_until_first_paid,
           MIN(pe) FILTER (WHERE stock_qty > 0 AND free_qty - expired < stock_qty) AS first_paid_period_end
    FROM base b LEFT JOIN run USING (sku) GROUP BY b.sku, b.stock_qty, b.free_qty
    """,
)
def first_paid_stock_layer(spark, sf_dir):
    supply = plans.report_cells(_supply_payload(spark, sf_dir))
    stock = load(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("sku"), F.when(F.col("l_returnflag") == "A", 1).alias("available_stock_count")
    )
    return plans.first_paid_report(None, supply, "stock_layer", stock)


def _cost_payload(spark, sf_dir):
    """Line items as rows of the storage cost report, numbers as text with spaces and commas."""
    pieces = F.concat(text("l_linenumber"), F.lit(" 000"))
    cost = F.regexp_replace(F.format_string("%.2f", F.col("l_extendedprice")), r"\.", ",")
    payload = F.to_json(
        F.struct(
            F.concat(F.lit(" "), text("l_partkey")).alias("SKU"),
            F.when(F.col("l_returnflag") == "A", F.concat(F.lit("A"), text("l_partkey"))).otherwise("").alias("Артикул"),
            F.when(F.col("l_linestatus") == "O", pieces).otherwise("нет").alias(plans.PAID_QTY_COLUMN),
            text("l_quantity").alias(plans.PAID_ML_COLUMN),
            cost.alias(plans.COST_COLUMN),
        )
    )
    return load_spread(spark, sf_dir, "lineitem").select(payload.alias("payload"))


SQL_COST = """
    cost AS (SELECT l_partkey AS sku, CASE WHEN l_returnflag = 'A' THEN 'A' || l_partkey ELSE ' ' || l_partkey END AS article,
                    SUM(CASE WHEN l_linestatus = 'O' THEN l_linenumber * 1000 ELSE 0 END)::INT AS paid_qty,
                    SUM(l_quantity::BIGINT)::BIGINT AS paid_ml, SUM(l_extendedprice::DECIMAL(12,2))::DOUBLE AS daily_writeoff_rub
             FROM lineitem GROUP BY 1, 2)
"""


@query(
    "storage_cost_text",
    f"WITH {SQL_COST} SELECT sku, article, paid_qty, paid_ml, daily_writeoff_rub FROM cost",
)
def storage_cost_text(spark, sf_dir):
    cost = plans.storage_cost(plans.report_text_columns(_cost_payload(spark, sf_dir)))
    return cost.select(
        "sku", "article", "paid_qty", (F.col("paid_liters") * 1000).cast("bigint").alias("paid_ml"),
        F.col("daily_writeoff_rub").cast("double").alias("daily_writeoff_rub"),
    )


@query(
    "placement_latest",
    f"""
    WITH {SQL_COST}, {SQL_PAID}, base AS (SELECT p_partkey AS sku, p_size * 17 AS stock_qty, p_partkey % 900 + 100 AS free_qty FROM part),
    paid AS (SELECT b.sku, CASE WHEN stock_qty <= 0 THEN NULL WHEN stock_qty > free_qty THEN 0
                                ELSE MIN(d) FILTER (WHERE free_qty - expired < stock_qty) END::INT AS days_until_first_paid
             FROM base b LEFT JOIN run USING (sku) GROUP BY b.sku, b.stock_qty, b.free_qty)
    SELECT article, paid_qty, paid_ml, daily_writeoff_rub, days_until_first_paid FROM cost LEFT JOIN paid USING (sku)
    """,
)
def placement_latest(spark, sf_dir):
    rows = plans.report_text_columns(_cost_payload(spark, sf_dir))
    latest = plans.placement_latest(rows, first_paid_day(spark, sf_dir))
    return latest.select(
        "article", "paid_qty", (F.col("paid_liters") * 1000).cast("bigint").alias("paid_ml"),
        F.col("daily_writeoff_rub").cast("double").alias("daily_writeoff_rub"), "days_until_first_paid",
    )
