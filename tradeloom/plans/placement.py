"""Storage placement: reports, cells, storage cost and the first paid day."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradeloom.functions.dates import report_date
from tradeloom.functions.numbers import half_up_int, numeric_cell, report_number
from tradeloom.functions.text import blank_to_null, empty_to_null
from tradeloom.operators.merge import pivot_cells, unpivot_payload
from tradeloom.operators.normalize import with_record
from tradeloom.operators.skew import salted_join

# Column positions of the two reports.
PRODUCT_SKU, PRODUCT_ARTICLE, PRODUCT_QTY = 2, 3, 9
SUPPLY_SKU, SUPPLY_NUMBER, SUPPLY_DAYS, SUPPLY_PERIOD_END = 1, 6, 8, 9

# Column names of the reports.
SUPPLY_COLUMN_NAMES = {
    "sku": "SKU",
    "supply_number": "Номер поставки",
    "days": "Дней до конца периода",
    "period_end": "Дата окончания периода по поставкам",
}
STOCK_COLUMN_PREFIX = "Остаток на складах на ("
PAID_QTY_COLUMN = "Кол-во платных экземпляров"
PAID_ML_COLUMN = "Платный объем в миллилитрах"
COST_COLUMN = "Начисленная стоимость размещения"


def latest_report(reports: DataFrame, rows: DataFrame | None = None) -> DataFrame:
    """Newest successful report, only among those with rows when ``rows`` is given."""
    done = reports.where(F.col("status") == "success")
    if rows is not None:
        done = done.join(rows.select(F.col("report_code").alias("code")).distinct(), "code", "left_semi")
    return done.orderBy(F.col("date_to").desc_nulls_first(), F.col("updated_at").desc_nulls_first(), "code").limit(1)


def report_selection(reports: DataFrame, rows: DataFrame) -> DataFrame:
    """Newest non-empty successful report with its row count."""
    counts = rows.groupBy(F.col("report_code").alias("code")).agg(F.count(F.lit(1)).alias("rows_count"))
    return (
        reports.where(F.col("status") == "success")
        .join(counts, "code")
        .orderBy(F.col("date_to").desc_nulls_first(), F.col("updated_at").desc_nulls_first(), "code")
        .limit(1)
        .select("code", F.col("date_to").alias("report_date"), "rows_count")
    )


def same_period_report(supplies: DataFrame, product: DataFrame) -> DataFrame:
    """Newest successful supplies report of the product report's period."""
    period = product.select("date_from", "date_to")
    return (
        supplies.where(F.col("status") == "success")
        .join(period, ["date_from", "date_to"])
        .orderBy(F.col("updated_at").desc_nulls_first(), "code")
        .limit(1)
    )


def of_report(cells: DataFrame, report: DataFrame) -> DataFrame:
    """Rows of one report; its code is looked up once and filters the scan."""
    return cells.where(F.col("report_code") == report.select("code").scalar())


def report_cells(rows: DataFrame) -> DataFrame:
    """Cells of report rows held as JSON, numbered in document order."""
    return unpivot_payload(rows, ["report_code", "row_number"], "payload")


def placement_flat(rows: DataFrame, reports: DataFrame) -> DataFrame:
    """Report rows with the period of their report."""
    periods = reports.select(F.col("code").alias("report_code"), "date_from", "date_to")
    return salted_join(rows, periods, ["report_code"], F.struct("sku", "row_number"))


def _at(position: int) -> Column:
    return F.when(F.col("column_number") == position, F.col("value_numeric"))


def _filled(condition: Column) -> Column:
    """True for a cell under the condition with text in it."""
    return F.when(condition, blank_to_null("value_text").isNotNull())


def _members(rows: DataFrame) -> DataFrame:
    """Report rows that are still one JSON object, with its members in document order as ``__m``, parsed once."""
    return rows.select("*", F.explode(F.array(F.map_entries(F.from_json("payload", "map<string,string>")))).alias("__m"))


def _member(position: int) -> Column:
    return F.get("__m", F.lit(position - 1))["value"]


def _named_member(test: Callable[[Column], Column]) -> Column:
    return F.get(F.filter("__m", lambda m: test(m["key"])), F.lit(0))["value"]


def product_totals(cells: DataFrame) -> DataFrame:
    """Pieces per sku of the product report; rows need a sku and an article.

    Takes cells, or rows with their JSON ``payload``, whose columns are read in place.
    """
    if "payload" in cells.columns:
        wide = _members(cells).select(
            numeric_cell(_member(PRODUCT_SKU)).alias("sku"), blank_to_null(_member(PRODUCT_ARTICLE)).isNotNull().alias("has_article"),
            numeric_cell(_member(PRODUCT_QTY)).alias("product_qty"),
        )
    else:
        wide = pivot_cells(
            cells, ["report_code", "row_number"],
            {
                "sku": _at(PRODUCT_SKU),
                "has_article": _filled(F.col("column_number") == PRODUCT_ARTICLE),
                "product_qty": _at(PRODUCT_QTY),
            },
        )
    return (
        wide.where(F.col("sku").isNotNull() & F.col("has_article"))
        .groupBy(F.round("sku").cast("bigint").alias("sku"))
        .agg(F.sum(F.coalesce("product_qty", F.lit(0))).alias("product_qty"))
    )


def supply_rows_wide(cells: DataFrame, by_name: bool = False, with_text: bool = False, all_rows: bool = True) -> DataFrame:
    """Supplies report as rows; free pieces stand in its last column.

    Texts are reduced to what is asked of them (is there a supply number, which date)
    before the aggregation, so that it hashes fixed-width values instead of sorting.
    ``with_text`` keeps the period end as printed. Without ``all_rows`` cells that no column
    is made of are left out before their numbers are read, and rows of such cells alone with
    them; these have no sku. Rows that are still one JSON object
    (``payload``) are read in place, without a shuffle.
    """
    if "payload" in cells.columns:
        return _supply_rows_of_payload(cells, by_name, with_text)
    last = cells.agg(F.max("column_number")).scalar()
    marked = cells.withColumn("is_last", F.col("column_number") == last)

    def place(name: str, position: int) -> Column:
        if by_name:
            return F.col("column_name") == SUPPLY_COLUMN_NAMES[name]
        return F.col("column_number") == position

    period_end = place("period_end", SUPPLY_PERIOD_END)
    if not all_rows:
        asked = F.col("is_last") | F.col("column_name").startswith(STOCK_COLUMN_PREFIX) | period_end
        for name, position in (("sku", SUPPLY_SKU), ("supply_number", SUPPLY_NUMBER), ("days", SUPPLY_DAYS)):
            asked = asked | place(name, position)
        marked = marked.where(asked)
    columns = {
        "sku": F.when(place("sku", SUPPLY_SKU), F.col("value_numeric")),
        "has_number": _filled(place("supply_number", SUPPLY_NUMBER)),
        "days": F.when(place("days", SUPPLY_DAYS), F.col("value_numeric")),
        "period_end": F.when(period_end, report_date("value_text")),
        "report_stock_qty": F.when(F.col("column_name").startswith(STOCK_COLUMN_PREFIX), F.col("value_numeric")),
        "free_qty": F.when(F.col("is_last"), F.col("value_numeric")),
    }
    if with_text:
        columns["period_end_text"] = F.when(period_end, F.col("value_text"))
    wide = pivot_cells(marked, ["report_code", "row_number"], columns)
    return wide.withColumns(
        {"sku": F.round("sku").cast("bigint"), "has_number": F.coalesce("has_number", F.lit(False))}
    )


def _supply_rows_of_payload(rows: DataFrame, by_name: bool, with_text: bool) -> DataFrame:
    last = rows.agg(F.max(F.size(F.json_object_keys("payload")))).scalar()

    def place(name: str, position: int) -> Column:
        return _named_member(lambda key: key == SUPPLY_COLUMN_NAMES[name]) if by_name else _member(position)

    stock = F.filter("__m", lambda m: F.startswith(m["key"], F.lit(STOCK_COLUMN_PREFIX)))
    # members are found once, in a step of their own, and then parsed
    found = _members(rows).select(
        "report_code", "row_number",
        place("sku", SUPPLY_SKU).alias("__sku"), place("supply_number", SUPPLY_NUMBER).alias("__number"),
        place("days", SUPPLY_DAYS).alias("__days"), place("period_end", SUPPLY_PERIOD_END).alias("__end"),
        F.array_max(F.transform(stock, lambda m: numeric_cell(m["value"]))).alias("report_stock_qty"),
        F.get("__m", last - 1)["value"].alias("__free"),
    )
    columns = [
        F.round(numeric_cell("__sku")).cast("bigint").alias("sku"),
        blank_to_null("__number").isNotNull().alias("has_number"),
        numeric_cell("__days").alias("days"),
        report_date("__end").alias("period_end"),
        "report_stock_qty",
        numeric_cell("__free").alias("free_qty"),
    ]
    if with_text:
        columns.append(F.col("__end").alias("period_end_text"))
    return found.select("report_code", "row_number", *columns)


def _paid_rows(wide: DataFrame) -> DataFrame:
    """Summary and supply rows of the supplies report in one frame, told apart by is_supply."""
    is_supply = F.col("has_number")
    usable = F.when(
        is_supply, F.col("days").isNotNull() & (F.coalesce("free_qty", F.lit(0)) > 0)
    ).otherwise(F.col("free_qty").isNotNull())
    return wide.where(F.col("sku").isNotNull() & usable).select(
        "sku",
        is_supply.alias("is_supply"),
        F.when(is_supply, half_up_int("days")).alias("days"),
        F.when(is_supply, F.col("period_end")).alias("period_end"),
        F.when(is_supply, F.col("free_qty")).alias("qty"),
        F.when(~is_supply, F.col("free_qty")).alias("free_qty"),
        F.when(~is_supply, F.col("report_stock_qty")).alias("stock_qty"),
    )


def _first_paid(rows: DataFrame, stock: DataFrame | None = None) -> DataFrame:
    """Days until storage of a sku becomes payable, from summary and supply rows.

    Supplies expire in order of days; the first day on which the free pieces left no
    longer cover the stock is the answer. ``stock`` (sku, stock_qty) replaces the stock
    of the summary rows.

    Supplies of one sku, day and period end are added up first. Their pieces are
    positive, so the test holds for some of them exactly when it holds after the last,
    and the window sees at most a row per day and period end, however many supplies a
    sku has.
    """
    daily = rows.groupBy("sku", "is_supply", "days", "period_end").agg(
        F.sum("qty").alias("qty"), F.max("free_qty").alias("free_qty"), F.max("stock_qty").alias("stock_qty")
    )
    if stock is not None:
        daily = daily.drop("stock_qty").join(stock, "sku", "left")
    whole = Window.partitionBy("sku")
    order = whole.orderBy(F.col("is_supply"), F.col("days"), F.col("period_end").asc_nulls_last())
    marked = daily.select(
        "sku", "is_supply", "days", "period_end",
        F.sum("qty").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("expired"),
        F.max("free_qty").over(whole).alias("free_qty"),
        F.max("stock_qty").over(whole).alias("stock_qty"),
    )
    short = F.col("is_supply") & (F.col("free_qty") - F.col("expired") < F.col("stock_qty"))
    positive = F.coalesce("stock_qty", F.lit(0)) > 0
    return (
        marked.groupBy("sku")
        .agg(
            F.bool_or(~F.col("is_supply")).alias("has_summary"),
            F.max("stock_qty").alias("stock_qty"),
            F.max("free_qty").alias("free_qty"),
            F.min(F.when(short, F.col("days"))).alias("short_day"),
            F.min(F.when(positive & short, F.col("period_end"))).alias("first_paid_period_end"),
        )
        .where("has_summary")
        .withColumn(
            "days_until_first_paid",
            F.when(~positive, F.lit(None)).when(F.col("stock_qty") > F.col("free_qty"), 0).otherwise(F.col("short_day")),
        )
        .drop("short_day", "has_summary")
    )


def first_paid(summary: DataFrame, supplies: DataFrame) -> DataFrame:
    """First paid day from a row per sku (sku, stock_qty, free_qty) and its supplies.

    ``supplies`` holds free pieces: sku, days, period_end, qty > 0.
    """
    rows = supplies.withColumn("is_supply", F.lit(True)).unionByName(
        summary.withColumn("is_supply", F.lit(False)), allowMissingColumns=True
    )
    return _first_paid(rows)


def first_paid_report(
    product_cells: DataFrame | None,
    supply_cells: DataFrame,
    stock_source: str = "product_report",
    stock: DataFrame | None = None,
) -> DataFrame:
    """First paid day of the latest reports.

    ``stock_source`` chooses where the pieces come from: the product report, the stock
    column of the supplies report (``report_column``), the stock layer (``stock``, one
    row per sku and cluster), or ``summary``, which takes the days printed in the report.
    """
    wide = supply_rows_wide(supply_cells, stock_source == "report_column", stock_source == "summary", all_rows=False)
    if stock_source == "summary":
        days = wide.where(F.col("sku").isNotNull() & ~F.col("has_number") & F.col("days").isNotNull())
        return days.groupBy("sku").agg(
            F.lit(None).cast("int").alias("stock_qty"),
            half_up_int(F.max("free_qty")).alias("free_qty"),
            half_up_int(F.max("days")).alias("days_until_first_paid"),
            report_date(F.max("period_end_text")).alias("first_paid_period_end"),
        )
    rows = _paid_rows(wide)
    if stock_source == "report_column":
        result = _first_paid(rows.where(F.col("is_supply") | F.col("stock_qty").isNotNull()))
    elif stock_source == "stock_layer":
        result = _first_paid(rows, stock.groupBy("sku").agg(F.sum("available_stock_count").alias("stock_qty")))
        result = result.withColumn("stock_qty", F.coalesce("stock_qty", F.lit(0)))
    else:
        result = _first_paid(rows, product_totals(product_cells).withColumnRenamed("product_qty", "stock_qty"))
    return result.withColumns({"stock_qty": half_up_int("stock_qty"), "free_qty": half_up_int("free_qty")})


def first_paid_of_reports(product_rows: DataFrame, supply_rows: DataFrame, product_reports: DataFrame, supply_reports: DataFrame) -> DataFrame:
    """First paid day from the newest successful product report with rows and the supplies report of its period."""
    newest = latest_report(product_reports, product_rows)
    supplies = same_period_report(supply_reports, newest)
    return first_paid_report(of_report(product_rows, newest), of_report(supply_rows, supplies))


def storage_cost(rows: DataFrame) -> DataFrame:
    """Paid pieces, litres and cost per sku and article from report text columns.

    Rows carry sku_text, article_text, paid_qty_text, paid_ml_text and cost_text.
    """
    digits = F.regexp_replace(F.coalesce("sku_text", F.lit("")), r"\s+", "")
    prepared = rows.select(
        F.when(digits.rlike("^[0-9]+$"), digits.try_cast("bigint")).alias("sku"),
        F.coalesce(empty_to_null("article_text"), empty_to_null("sku_text")).alias("article"),
        report_number("paid_qty_text", 4).alias("paid_qty"),
        report_number("paid_ml_text", 4).alias("paid_ml"),
        report_number("cost_text", 4).alias("cost"),
    )
    return (
        prepared.where(F.col("article").isNotNull())
        .groupBy("sku", "article")
        .agg(
            half_up_int(F.sum("paid_qty")).alias("paid_qty"),
            F.round(F.sum("paid_ml") / 1000, 3).cast("decimal(14,3)").alias("paid_liters"),
            F.round(F.sum("cost"), 2).cast("decimal(14,2)").alias("daily_writeoff_rub"),
        )
    )


def report_text_columns(rows: DataFrame) -> DataFrame:
    """Text columns of report rows held as JSON."""
    rows = with_record(rows, "map<string,string>")
    value = lambda name: F.try_element_at("__r", F.lit(name))
    return rows.select(
        value("SKU").alias("sku_text"), value("Артикул").alias("article_text"),
        value(PAID_QTY_COLUMN).alias("paid_qty_text"), value(PAID_ML_COLUMN).alias("paid_ml_text"),
        value(COST_COLUMN).alias("cost_text"),
    )


def placement_latest(rows: DataFrame, paid: DataFrame) -> DataFrame:
    """Storage cost per article with the first paid day of its sku."""
    totals = storage_cost(rows)
    return totals.join(paid.select("sku", "days_until_first_paid"), "sku", "left").select(
        "article", "paid_qty", "paid_liters", "daily_writeoff_rub", "days_until_first_paid"
    )
