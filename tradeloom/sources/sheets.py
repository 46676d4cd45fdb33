"""Header handling for rows of cells: (file[, sheet], row_number, cells)."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradeloom.functions.numbers import strip
from tradeloom.functions.text import norm_header
from tradeloom.operators.skew import salted_join

# Header names that identify the header row, sheet names and the
# marker of specification sheets.
ARTICLE_HEADERS = ("артикул", "ваш sku")
SPEC_SHEET_MARKER = "заполн"
SPEC_SHEETS = ("пришло", "пришло old")


def is_article_header(name: Column) -> Column:
    return norm_header(name, fold_yo=True).isin(*ARTICLE_HEADERS)


def is_lot_header(name: Column) -> Column:
    return norm_header(name) == "lot"


def is_specification_header(name: Column) -> Column:
    text = norm_header(name, fold_yo=True)
    return text.startswith("спец") | text.contains("специф")


def is_manager_header(name: Column) -> Column:
    text = norm_header(name, fold_yo=True)
    return text.contains("менедж") | (text == "кто")


def is_production_date_header(name: Column) -> Column:
    text = norm_header(name, fold_yo=True)
    period = text.contains("дата") | text.contains("год") | text.contains("месяц")
    return period & (text.contains("производ") | text.contains("производсв"))


def pick_by_header(row: str | Column, predicate: Callable[[Column], Column]) -> Column:
    """First non-empty value whose header satisfies the predicate."""
    entries = F.map_entries(row)
    found = F.filter(entries, lambda e: predicate(e["key"]) & e["value"].isNotNull() & (e["value"] != ""))
    return F.get(found, F.lit(0))["value"]


def detect_header(
    rows: DataFrame, names: Sequence[str] = ARTICLE_HEADERS, top: int = 30, by: Sequence[str] = ("file",)
) -> DataFrame:
    """Header row and its cells per file: first of the top rows with a known name, else the first row."""
    head = rows.where(F.col("row_number") <= top)
    known = F.exists("cells", lambda c: norm_header(c).isin(*names))
    place = F.struct("row_number", "cells")
    found = head.groupBy(*by).agg(F.coalesce(F.min(F.when(known, place)), F.min(place)).alias("h"))
    return found.select(*by, F.col("h.row_number").alias("header_row"), F.col("h.cells").alias("header_cells"))


def header_names(cells: Column) -> Column:
    """Trimmed names; a missing cell becomes ``ColumnN``."""
    return F.transform(
        cells, lambda c, i: F.coalesce(strip(c), F.concat(F.lit("Column"), (i + 1).cast("string")))
    )


def row_map(names: Column, cells: Column) -> Column:
    """Header to cell; a repeated header keeps its first place and its last value."""
    turned = F.reverse(names)
    last_value = lambda n: F.get(cells, F.size(names) - F.array_position(turned, n).cast("int"))
    distinct = F.array_distinct(names)
    return F.map_from_arrays(distinct, F.transform(distinct, last_value))


def promote_header(rows: DataFrame, header: DataFrame, by: Sequence[str] = ("file",)) -> DataFrame:
    """Rows below the header as maps; fully empty rows are dropped.

    ``header`` has one row per file, so it is spread over salted copies rather than
    sending one large file to one task.
    """
    names = header.select(*by, "header_row", header_names(F.col("header_cells")).alias("names"))
    data = salted_join(rows, names, by, F.col("row_number"), how="inner")
    data = data.where(F.col("row_number") > F.col("header_row"))
    data = data.withColumn("row", row_map(F.col("names"), F.col("cells")))
    filled = F.exists(F.map_values("row"), lambda v: v.isNotNull() & (v != ""))
    return data.where(filled).select(*by, "row_number", "row")


def promote_fixed(
    rows: DataFrame, offset: int = 3, skip: int = 1, drop_last: bool = True, by: Sequence[str] = ("file",)
) -> DataFrame:
    """Header at a fixed offset, ``skip`` rows under it ignored, the last data row dropped."""
    header = rows.where(F.col("row_number") == offset + 1).select(
        *by, F.col("row_number").alias("header_row"), F.col("cells").alias("header_cells")
    )
    data = promote_header(rows, header, by).where(F.col("row_number") > offset + 1 + skip)
    if not drop_last:
        return data
    last = data.groupBy(*by).agg(F.max("row_number").alias("last_row"))
    kept = salted_join(data, last, by, F.col("row_number"), how="inner")
    return kept.where(F.col("row_number") < F.col("last_row")).drop("last_row")


#: rows of a sheet that one group of the table join spans
BAND = 10_000


def table_rows(rows: DataFrame, tables: DataFrame) -> DataFrame:
    """Rows of named tables: (file, sheet, table, row_number, min_row, cells), the header row first.

    ``tables`` has one row for each rectangle: (file, sheet, table, min_row, max_row,
    min_column, max_column), counted from 1. Rows and rectangles meet by equality on bands of
    row numbers and then by range, so neither a long sheet nor a long table is one task's
    work, and a rectangle is repeated once for each band that it touches. A cell beyond the
    end of its row is null. Tables may overlap. A ``header`` that the rectangles carry is cut alike.
    """
    band = lambda c: F.floor((F.col(c) - 1) / BAND)
    bands = tables.withColumn("band", F.explode(F.sequence(band("min_row"), band("max_row"))))
    placed = rows.withColumn("band", band("row_number")).join(bands, ["file", "sheet", "band"])
    inside = placed.where(F.col("row_number").between(F.col("min_row"), F.col("max_row")))
    cut = lambda c: F.transform(F.sequence("min_column", "max_column"), lambda i: F.get(c, (i - 1).cast("int")))
    arrays = [cut(c).alias(c) for c in ("cells", "header") if c in inside.columns]
    return inside.select("file", "sheet", "table", "row_number", "min_row", *arrays)


def read_named_tables(rows: DataFrame, tables: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """Rows of named tables as maps from header to cell: (file, sheet, table, row_number, row).

    The first row of a table holds its headers; rows whose cells are all empty are dropped.
    ``names`` narrows to these tables.
    """
    tables = tables if names is None else tables.where(F.col("table").isin(*names))
    tops = tables.withColumn("row_number", F.col("min_row"))
    first = rows.join(tops, ["file", "sheet", "row_number"]).withColumn("header", F.col("cells"))
    headed = first.select("file", "sheet", "table", "min_row", "max_row", "min_column", "max_column", "header")
    inside = table_rows(rows, headed)
    data = inside.where(F.col("row_number") > F.col("min_row")).withColumn("names", header_names(F.col("header")))
    data = data.withColumn("row", row_map(F.col("names"), F.col("cells")))
    filled = F.exists(F.map_values("row"), lambda v: v.isNotNull() & (v != ""))
    return data.where(filled).select("file", "sheet", "table", "row_number", "row")


def is_spec_sheet(sheet: Column) -> Column:
    """Sheet names of supply order specifications."""
    name = F.regexp_replace(norm_header(sheet, fold_yo=True), r"[_\-\s]+", " ")
    return strip(name).contains(SPEC_SHEET_MARKER) | strip(name).isin(*SPEC_SHEETS)


def read_spec_sheets(rows: DataFrame) -> DataFrame:
    """Specification rows of all matching sheets as ``row`` maps with sheet and row number."""
    by = ["file", "sheet"]
    wanted = rows.where(is_spec_sheet(F.col("sheet")))
    data = promote_header(wanted, detect_header(wanted, by=by), by)
    article = F.coalesce(F.nullif(F.try_element_at("row", F.lit("Артикул")), F.lit("")), pick_by_header("row", is_article_header))
    lot = F.coalesce(pick_by_header("row", is_lot_header), pick_by_header("row", is_specification_header))
    row = F.create_map(
        F.lit("Лист"), F.col("sheet"),
        F.lit("Номер строки"), F.col("row_number").cast("string"),
        F.lit("Артикул"), article,
        F.lit("LOT"), lot,
        F.lit("Менеджер"), pick_by_header("row", is_manager_header),
        F.lit("Дата производства"), pick_by_header("row", is_production_date_header),
    )
    return data.where(F.coalesce(article, F.lit("")) != "").select(*by, "row_number", row.alias("row"))


def two_level_columns(rows: DataFrame, header_row: int = 4, first_column: int = 7) -> DataFrame:
    """Warehouse triples of a two-level header: (file, warehouse_name, at), ``at`` zero-based.

    The upper header names a warehouse once, so names are carried to the right. A
    triple starts where the lower header reads quantity, unit cost, total cost. Both
    headers are one row per file, so the carry is a window over its columns only.
    """
    def cells_of(number: int, name: str) -> DataFrame:
        return rows.where(F.col("row_number") == number).select(
            "file", F.posexplode("cells").alias("at", "raw")
        ).select("file", "at", strip(F.regexp_replace(F.coalesce("raw", F.lit("")), "\n", " ")).alias(name))

    along = Window.partitionBy("file").orderBy("at")
    upper = cells_of(header_row, "top").withColumn(
        "warehouse_name",
        F.last(F.nullif(F.col("top"), F.lit("")), ignorenulls=True).over(
            along.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        ),
    )
    lower = cells_of(header_row + 1, "sub").withColumns(
        {"s1": F.lower("sub"), "s2": F.lower(F.lead("sub", 1).over(along)), "s3": F.lower(F.lead("sub", 2).over(along))}
    )
    triple = F.col("s1").contains("кол") & F.col("s2").contains("себест") & F.col("s3").contains("себестоимость")
    return (
        upper.join(lower, ["file", "at"], "inner")
        .where((F.col("at") >= first_column) & F.col("warehouse_name").isNotNull() & triple)
        .select("file", "warehouse_name", "at")
    )


def unpivot_two_level(rows: DataFrame, header_row: int = 4) -> DataFrame:
    """Wide cost rows to one row per (row, warehouse) with its three measures."""
    triples = two_level_columns(rows, header_row)
    # bounded by the width of one header row
    per_file = triples.groupBy("file").agg(F.sort_array(F.collect_list(F.struct("at", "warehouse_name"))).alias("triples"))
    data = rows.where(F.col("row_number") > header_row + 1)
    cell = lambda at: strip(F.coalesce(F.get("cells", at), F.lit("")))
    data = data.where(cell(F.lit(2)) != "")
    long = salted_join(data, per_file, ["file"], F.col("row_number"), how="inner").select(
        "file", "row_number", "cells", F.explode("triples").alias("t")
    )
    at = F.col("t.at")
    return long.select(
        "file", "row_number",
        cell(F.lit(0)).alias("code"), cell(F.lit(1)).alias("product_name"), cell(F.lit(2)).alias("article"),
        cell(F.lit(3)).alias("tnved_code"), F.col("t.warehouse_name").alias("warehouse_name"),
        cell(at).alias("quantity"), cell(at + 1).alias("unit_cost_byn"), cell(at + 2).alias("total_cost_byn"),
    ).where((F.col("quantity") != "") | (F.col("unit_cost_byn") != "") | (F.col("total_cost_byn") != ""))


def inventory_rows(rows: DataFrame) -> DataFrame:
    """Promoted file rows to inventory columns; either header name of a warehouse counts."""
    from tradeloom.functions.numbers import parse_number
    from tradeloom.functions.text import clean_article
    from tradeloom.operators.merge import INVENTORY_WAREHOUSES

    short = dict(zip(INVENTORY_WAREHOUSES, ("СМП", "ОСН", "СОХ", "СВХ", "ТС"), strict=True))
    value = lambda name: F.try_element_at("row", F.lit(name))
    return rows.select(
        clean_article(value("Артикул")).alias("article"),
        *[
            parse_number(
                F.when(F.map_contains_key("row", name), value(name)).otherwise(value(short[name])), 14, 3, default="0"
            ).alias(column)
            for name, column in INVENTORY_WAREHOUSES.items()
        ],
    )
