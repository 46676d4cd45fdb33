"""Orders: daily export, summaries, change history, feed pages and drill-down."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tradeloom.functions.dates import local_date, on_local_days
from tradeloom.functions.images import image_url_candidates, ordered_image_urls
from tradeloom.functions.jsonpath import json_text
from tradeloom.functions.labels import status_label
from tradeloom.functions.text import article_or_sku
from tradeloom.operators.keyed import first_per_key
from tradeloom.operators.ordered import version_numbers
from tradeloom.operators.skew import heavy_keys, salted_join

# Names shown for rows without an order number or an article.
NO_ORDER_NUMBER = "Без номера"
NO_ARTICLE = "Без артикула"


def _clamp(value: int, low: int, high: int) -> int:
    return max(low, min(value, high))


def item_orders_daily(items: DataFrame, date_from: Column, date_to: Column, zone: str = "UTC") -> DataFrame:
    """Quantity and amount per order date and article from order lines, not cancelled."""
    placed = F.coalesce("created_at", "in_process_at")
    return (
        items.where(F.col("status").isNull() | (F.col("status") != "cancelled"))
        .where(on_local_days(["created_at", "in_process_at"], zone, date_from, date_to))
        .withColumn("order_date", local_date(placed, zone))
        .groupBy("order_date", article_or_sku("product_offer_id", "product_sku").alias("article"))
        .agg(
            F.sum("product_quantity").cast("bigint").alias("quantity"),
            F.sum(F.col("product_price_amount") * F.col("product_quantity")).cast("decimal(28,2)").alias("amount"),
            F.max(placed).alias("newest"),
        )
    )


def piece_orders_daily(orders: DataFrame, date_from: Column, date_to: Column, zone: str = "UTC") -> DataFrame:
    """Count and amount per order date and article from one-piece orders, not cancelled."""
    price = F.coalesce("price_with_disc", "finished_price", "total_price", F.lit(0).cast("decimal(12,2)"))
    return (
        orders.where(F.col("is_cancel").isNull() | ~F.col("is_cancel"))
        .where(on_local_days(["date_ts"], zone, date_from, date_to))
        .withColumn("order_date", local_date("date_ts", zone))
        .groupBy("order_date", article_or_sku("supplier_article", "nm_id").alias("article"))
        .agg(
            F.count(F.lit(1)).alias("quantity"),
            F.sum(price).cast("decimal(28,2)").alias("amount"),
            F.max("date_ts").alias("newest"),
        )
    )


def export_order(daily: DataFrame, limit: int | None = None) -> DataFrame:
    """Newest date first, inside it newest order first, then article."""
    rows = daily.orderBy(F.col("order_date").desc(), F.col("newest").desc(), F.col("article").asc())
    return rows.limit(limit) if limit is not None else rows


def day_summary(lines: DataFrame, zone: str = "Europe/Moscow", as_of: Column | None = None) -> DataFrame:
    """Orders, articles, pieces, amount and cancelled orders per day, or of one day.

    Lines carry order_group_key, article, quantity, price, cancelled and placed_at.
    Orders and articles are each reduced to one row per day first, so that nothing
    depends on how many lines a single order or article has.
    """
    rows = lines
    if as_of is not None:
        today = local_date(as_of, zone)
        rows = rows.where(on_local_days(["placed_at"], zone, today, today))
    rows = rows.withColumn("order_date", local_date("placed_at", zone))
    per_order = rows.groupBy("order_date", "order_group_key").agg(
        F.max("cancelled").alias("cancelled"),
        F.sum("quantity").alias("quantity"),
        F.sum(F.col("quantity") * F.col("price")).alias("amount"),
    )
    orders = per_order.groupBy("order_date").agg(
        F.count("order_group_key").alias("orders_count"),
        F.coalesce(F.sum("quantity"), F.lit(0)).cast("bigint").alias("quantity"),
        F.coalesce(F.sum("amount"), F.lit(0)).alias("amount"),
        F.count_if(F.coalesce("cancelled", F.lit(False)) & F.col("order_group_key").isNotNull()).alias(
            "cancelled_orders_count"
        ),
    )
    articles = rows.where(F.col("article").isNotNull()).groupBy("order_date", "article").agg(F.lit(1).alias("one"))
    articles = articles.groupBy("order_date").agg(F.count("one").alias("articles_count"))
    return orders.join(articles, "order_date", "left").withColumn(
        "articles_count", F.coalesce("articles_count", F.lit(0).cast("bigint"))
    )


def monthly_orders(orders: DataFrame) -> DataFrame:
    """Orders, revenue and cancels per month."""
    return orders.groupBy(F.to_date(F.date_trunc("month", "date_ts")).alias("month")).agg(
        F.count(F.lit(1)).alias("orders"),
        F.sum("price_with_disc").alias("revenue"),
        F.count_if(F.coalesce("is_cancel", F.lit(False))).alias("cancels"),
    )


def change_history(
    versions: DataFrame, key: str, tracked: Sequence[str], arrival: Sequence[str] = ("run_id",)
) -> DataFrame:
    """Version number, previous value and change flag of each tracked column."""
    numbered = version_numbers(versions, [key], ["changed_at", *arrival], previous={f"previous_{c}": c for c in tracked})
    flags = {f"{c}_changed": ~F.col(f"previous_{c}").eqNullSafe(F.col(c)) for c in tracked}
    return numbered.withColumns(flags)


def posting_history(versions: DataFrame) -> DataFrame:
    """Change history of postings: status, substatus and warehouse."""
    rows = versions.withColumns(
        {
            "order_number": json_text("payload", "$.order_number"),
            "warehouse_name": json_text("payload", "$.analytics_data.warehouse_name"),
        }
    )
    history = change_history(rows, "posting_number", ["status", "substatus", "warehouse_name"])
    return history.withColumnsRenamed({"warehouse_name_changed": "warehouse_changed"}).drop("payload")


def feed_history(versions: DataFrame) -> DataFrame:
    """Change history of feed orders: status and cancel type."""
    return change_history(versions, "srid", ["status", "cancel_type"]).drop("payload")


def items_with_header(items: DataFrame, headers: DataFrame) -> DataFrame:
    """Order lines with the columns of their posting that the lines lack."""
    extra = [c for c in headers.columns if c not in items.columns]
    return items.join(headers.select("posting_number", *extra), "posting_number", "left")


def newest_card(lines: DataFrame, cards: DataFrame, article: str = "article", sku: str = "marketplace_sku") -> DataFrame:
    """Add the newest card that has the line's article or the line's sku.

    Cards are reduced to the newest one per article and per sku, so the OR becomes two
    equality joins of at most one match each and the newer of both wins. Articles and skus
    of very many lines, null among them, are spread over several tasks.
    """
    columns = ["primary_image", "images", "product_name"]
    order = [F.col("updated_at").desc_nulls_last(), F.col("article").asc_nulls_last(), F.col("marketplace_sku").asc_nulls_last()]
    kept = cards.select("article", "marketplace_sku", "updated_at", *columns)
    packed = F.struct(
        "updated_at", F.struct("article", "marketplace_sku").alias("id"), *columns
    )

    by_article = first_per_key(kept.where(F.col("article").isNotNull()), ["article"], order).select(
        F.col("article").alias(article), packed.alias("__a")
    )
    by_sku = first_per_key(kept.where(F.col("marketplace_sku").isNotNull()), ["marketplace_sku"], order).select(
        F.col("marketplace_sku").alias(sku), packed.alias("__s")
    )
    plain = F.struct(*[c for c, kind in lines.dtypes if "map<" not in kind and kind != "variant"])
    joined = salted_join(lines, by_article, [article], plain, heavy=heavy_keys(lines, [article]))
    joined = salted_join(joined, by_sku, [sku], plain, heavy=heavy_keys(lines, [sku]))
    newer = F.col("__s.updated_at") > F.col("__a.updated_at")
    same = F.col("__s.updated_at").eqNullSafe(F.col("__a.updated_at"))
    sku_wins = F.col("__a").isNull() | F.col("__a.updated_at").isNull() | newer | (same & (F.col("__s.id") < F.col("__a.id")))
    card = F.when(F.col("__s").isNotNull() & sku_wins, F.col("__s")).otherwise(F.col("__a"))
    return joined.withColumn("card", card).drop("__a", "__s")


def feed_page(lines: DataFrame, limit: int = 50, offset: int = 0, ties: Sequence[str] = ("order_key",)) -> DataFrame:
    """All lines of the newest order groups; a page holds at most 100 groups.

    Lines carry order_group_key and sort_date; the group key breaks ties of the date, and
    ``ties`` order the lines of a group, so that the sort can split a very large one.
    """
    page = (
        lines.groupBy("order_group_key")
        .agg(F.max("sort_date").alias("group_date"))
        .orderBy(F.col("group_date").desc_nulls_last(), F.col("order_group_key"))
        .offset(max(0, offset))
        .limit(_clamp(limit, 1, 100))
    )
    on_page = lines.join(F.broadcast(page), "order_group_key")
    return on_page.orderBy(F.col("sort_date").desc_nulls_last(), "order_group_key", *ties)


def write_feed_index(lines: DataFrame, path: str, unit: str = "yyyy-MM") -> None:
    """Order groups with their newest date, a folder for each calendar unit, for :func:`seek_groups`.

    ``unit`` is a date pattern whose text sorts like time; a finer one has smaller folders and more of them.
    """
    groups = lines.groupBy("order_group_key").agg(F.max("sort_date").alias("group_date"))
    groups.withColumn("unit", _unit(F.col("group_date"), unit)).repartition("unit").write.partitionBy("unit").parquet(path)


def _unit(date: Column, unit: str) -> Column:
    return F.concat(F.lit("t"), F.coalesce(F.date_format(date, unit), F.lit("")))  # a group without a date comes last


def _feed_index(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("order_group_key string, group_date timestamp_ntz, unit string").parquet(path)


def seek_groups(spark: SparkSession, index: str, limit: int = 50, offset: int = 0) -> DataFrame:
    """The groups of a page, however deep: only the units that hold the page are read and sorted.

    Groups are counted by unit, one row a unit; a running sum names the units the page lies
    in, at most as many as it has groups.
    """
    limit, offset = _clamp(limit, 1, 100), max(0, offset)
    groups = _feed_index(spark, index)
    down = Window.partitionBy(F.lit(0)).orderBy(F.col("unit").desc())
    units = groups.groupBy("unit").agg(F.count(F.lit(1)).alias("n"))
    units = units.withColumn("upto", F.sum("n").over(down.rowsBetween(Window.unboundedPreceding, 0)))
    held = units.where((F.col("upto") > offset) & (F.col("upto") - F.col("n") < offset + limit)).collect()
    skip = offset - min((u.upto - u.n for u in held), default=0)
    page = groups.where(F.col("unit").isin([u.unit for u in held]))
    return page.orderBy(F.col("group_date").desc_nulls_last(), "order_group_key").offset(skip).limit(limit).drop("unit")


def groups_after(
    spark: SparkSession, index: str, group_date: Column, order_group_key: str, limit: int = 50, unit: str = "yyyy-MM"
) -> DataFrame:
    """The groups that follow the last one of a page, by its date and key instead of a number of groups."""
    later = (F.col("group_date") < group_date) | ((F.col("group_date") == group_date) & (F.col("order_group_key") > order_group_key))
    rest = _feed_index(spark, index).where((F.col("unit") <= _unit(group_date, unit)) & (later | F.col("group_date").isNull()))
    return rest.orderBy(F.col("group_date").desc_nulls_last(), "order_group_key").limit(_clamp(limit, 1, 100)).drop("unit")


def page_lines(lines: DataFrame, page: DataFrame, ties: Sequence[str] = ("order_key",)) -> DataFrame:
    """All lines of the groups of a page (at most 100), in feed order."""
    on_page = lines.join(F.broadcast(page), "order_group_key")
    return on_page.orderBy(F.col("sort_date").desc_nulls_last(), "order_group_key", *ties)


def decorate(lines: DataFrame, marketplace: str) -> DataFrame:
    """Status label and ordered images; one marketplace has derived image addresses."""
    images = ordered_image_urls("card.primary_image", F.col("card.images"))
    if marketplace == "wb":
        images = F.when(F.size(images) > 0, images).otherwise(image_url_candidates("marketplace_sku"))
    rows = lines.withColumns(
        {
            "marketplace": F.lit(marketplace),
            "status_label": status_label("status", marketplace),
            "product_name": F.coalesce("card.product_name", "product_name"),
            "image_urls": images,
        }
    )
    primary = F.nullif(F.col("card.primary_image"), F.lit(""))
    return rows.withColumn("image_url", F.coalesce(primary, F.get("image_urls", F.lit(0)))).drop("card")


def order_detail(lines: DataFrame, key: str | Column) -> DataFrame:
    """Lines whose order key, order number or group key is ``key``."""
    wanted = F.lit(key.strip()) if isinstance(key, str) else key
    match = (F.col("order_key") == wanted) | (F.col("order_number") == wanted) | (F.col("order_group_key") == wanted)
    return lines.where(match)


def recent_history(history: DataFrame, keys: DataFrame, key: str, limit: int = 30) -> DataFrame:
    """Newest history rows of a set of keys."""
    wanted = history.join(keys.select(key).distinct(), key, "left_semi")
    return wanted.orderBy(F.col("changed_at").desc(), F.col(key), F.col("version_no").desc()).limit(limit)


def order_groups(lines: DataFrame, arrival: Column) -> DataFrame:
    """Totals per order; header fields of its first line, date of the first line that has one."""
    key = F.coalesce(
        F.nullif("order_group_key", F.lit("")), F.nullif("order_number", F.lit("")),
        F.nullif("order_key", F.lit("")), F.lit(NO_ORDER_NUMBER),
    )
    quantity = F.coalesce("quantity", F.lit(0))
    amount = quantity * F.coalesce("price", F.lit(0))
    header = [c for c in ("marketplace", "order_number", "status", "status_label", "warehouse_name") if c in lines.columns]
    return lines.groupBy(key.alias("order_group")).agg(
        F.sum(quantity).alias("total_quantity"),
        F.sum(amount).alias("total_amount"),
        F.count(F.lit(1)).alias("line_count"),
        F.min_by("order_date", F.when(F.col("order_date").isNotNull(), arrival)).alias("order_date"),
        *[F.min_by(c, arrival).alias(c) for c in header],
    )


def product_groups(lines: DataFrame, arrival: Column, by: Sequence[str] = ()) -> DataFrame:
    """Totals per product, named by article, else product name."""
    key = F.coalesce(F.nullif("article", F.lit("")), F.nullif("product_name", F.lit("")), F.lit(NO_ARTICLE))
    quantity = F.coalesce("quantity", F.lit(0))
    return lines.groupBy(*by, key.alias("product_group")).agg(
        F.sum(quantity).alias("total_quantity"),
        F.sum(quantity * F.coalesce("price", F.lit(0))).alias("total_amount"),
        F.count(F.lit(1)).alias("line_count"),
        F.min_by("product_name", arrival).alias("product_name"),
    )


def product_group_images(lines: DataFrame, arrival: Column, by: Sequence[str] = ()) -> DataFrame:
    """Distinct images per product with their first appearance, one row per image."""
    key = F.coalesce(F.nullif("article", F.lit("")), F.nullif("product_name", F.lit("")), F.lit(NO_ARTICLE))
    rows = lines.select(*by, key.alias("product_group"), arrival.alias("__at"), F.posexplode("image_urls").alias("__pos", "image_url"))
    return (
        rows.where(F.coalesce("image_url", F.lit("")) != "")
        .groupBy(*by, "product_group", "image_url")
        .agg(F.min(F.struct("__at", "__pos")).alias("first_seen"))
    )
