"""Normalizer queries: table rows are spelled as JSON records or file rows and read back."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tradeloom.bindings import load_spread, text, whole
from tradeloom.catalogue import query
from tradeloom.operators import normalize
from tradeloom.sources.landing import explode_pages


def comma_text(column: str) -> Column:
    """Number as text with a space after the first digit and a decimal comma."""
    plain = F.regexp_replace(F.format_string("%.2f", F.col(column)), r"\.", ",")
    return F.regexp_replace(plain, "^([0-9])", "$1 ")


def record(**fields: Column) -> Column:
    """JSON text of the fields; a null field is left out."""
    return F.to_json(F.struct(*[value.alias(name) for name, value in fields.items()]))


def row(**fields: Column) -> Column:
    pairs: list[Column] = []
    for name, value in fields.items():
        pairs += [F.lit(name), value]
    return F.create_map(*pairs)


def named_row(fields: dict[str, Column]) -> Column:
    return row(**fields)


def seconds(column: str) -> Column:
    return F.unix_seconds(F.col(column)).alias(column)


@query(
    "normalize_json_types",
    """
    WITH l AS (SELECT l_orderkey || '-' || l_linenumber AS srid, * FROM lineitem)
    SELECT 'order' AS kind, srid, trunc(l_extendedprice)::BIGINT AS a, NULL::BIGINT AS b, trunc(l_quantity)::BIGINT AS c, NULL::BOOLEAN AS x,
           CASE WHEN l_returnflag = 'R' THEN 1 END::BIGINT AS d FROM l
    UNION ALL SELECT 'posting', srid, NULL, NULL, (l_linenumber > 1)::BIGINT, FALSE, (l_returnflag = 'A')::BIGINT FROM l
    UNION ALL SELECT 'product', srid, CASE WHEN l_linenumber > 1 THEN l_linenumber - 1 ELSE l_partkey END, NULL, NULL, l_linenumber % 3 = 1, NULL FROM l
    """,
)
def normalize_json_types(spark, sf_dir):
    """Whole numbers and flags as JSON numbers with a fraction, texts, booleans and containers."""
    lines = load_spread(spark, sf_dir, "lineitem").withColumn("key", F.concat_ws("-", "l_orderkey", "l_linenumber"))
    order = record(
        srid=F.col("key"), nmId=F.col("l_extendedprice"), incomeID=F.concat("l_quantity", F.lit(".5")), discountPercent=F.col("l_quantity") + 0.25,
        spp=F.when(F.col("l_returnflag") == "R", F.lit(True)),
    )
    posting = record(
        posting_number=F.col("key"), analytics_data=F.struct((F.col("l_linenumber") - 1).alias("is_legal"), F.lit("2").alias("is_premium")),
        external_order=F.struct(F.when(F.col("l_returnflag") == "A", F.array(F.lit(0))).otherwise(F.array().cast("array<int>")).alias("is_external")),
    )
    product = record(
        id=F.col("l_linenumber") - 1, product_id=text("l_partkey"), offer_id=F.col("key"),
        visibility_details=F.struct(F.when(F.col("l_linenumber") % 3 == 1, " ДА\u2003").when(F.col("l_linenumber") % 3 == 2, "0.0").alias("has_price")),
    )
    none = F.lit(None)
    parts = [
        normalize.wb_orders(lines.select(order.alias("payload"))).select(
            F.lit("order").alias("kind"), "srid", F.col("nm_id").alias("a"), F.col("income_id").alias("b"), F.col("discount_percent").alias("c"),
            none.cast("boolean").alias("x"), F.col("spp").alias("d"),
        ),
        normalize.postings(lines.select(posting.alias("payload"))).select(
            F.lit("posting"), "posting_number", none.cast("bigint"), none.cast("bigint"), whole("analytics_is_legal"), "analytics_is_premium",
            whole("external_order_is_external"),
        ),
        normalize.product_info(lines.select(product.alias("payload"))).select(
            F.lit("product"), "offer_id", "product_id", none.cast("bigint"), none.cast("bigint"), "has_price", none.cast("bigint"),
        ),
    ]
    return parts[0].union(parts[1]).union(parts[2])


@query(
    "normalize_wb_order",
    """
    SELECT l_orderkey || '-' || l_linenumber AS srid, l_partkey AS nm_id, CASE l_returnflag WHEN 'R' THEN TRUE WHEN 'A' THEN FALSE END AS is_cancel,
           epoch(l_shipdate)::BIGINT - 10800 AS date_ts, epoch(l_shipdate)::BIGINT + 43200 AS last_change_ts,
           l_extendedprice::DECIMAL(14,2)::DOUBLE AS total_price, CASE WHEN l_linestatus = 'O' THEN (l_discount * 100)::INT::BIGINT END AS discount_percent,
           CASE WHEN l_linestatus = 'F' THEN l_shipdate::DATE END AS cancel_date, l_suppkey::VARCHAR AS warehouse_name
    FROM lineitem WHERE l_quantity > 1
    """,
)
def normalize_wb_order(spark, sf_dir):
    local = F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss")
    payload = record(
        srid=F.when(F.col("l_quantity") > 1, F.concat_ws("-", "l_orderkey", "l_linenumber")).otherwise(""),
        nmId=text("l_partkey"),
        isCancel=F.when(F.col("l_returnflag") == "R", " Yes").when(F.col("l_returnflag") == "A", "0").otherwise("maybe"),
        date=F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss"), lastChangeDate=F.concat(F.substring(local, 1, 11), F.lit("15:00:00+03:00")),
        totalPrice=comma_text("l_extendedprice"),
        discountPercent=F.when(F.col("l_linestatus") == "O", F.round(F.col("l_discount") * 100).cast("int").cast("string")).otherwise("1.5"),
        cancelDate=F.when(F.col("l_linestatus") == "F", F.concat(local, F.lit("Z"))).otherwise("soon"),
        warehouseName=text("l_suppkey"),
    )
    orders = normalize.wb_orders(load_spread(spark, sf_dir, "lineitem").select(payload.alias("payload")))
    return orders.select(
        "srid", "nm_id", "is_cancel", seconds("date_ts"), seconds("last_change_ts"), F.col("total_price").cast("double").alias("total_price"),
        "discount_percent", "cancel_date", "warehouse_name",
    )


@query(
    "normalize_feed_order",
    """
    SELECT event_id::VARCHAR AS srid, user_id AS nm_id, epoch(date_trunc('second', ts))::BIGINT AS created_at,
           epoch(date_trunc('second', ts))::BIGINT - 10800 AS status_updated_at, event_type AS status, NULL AS cancel_type,
           CASE WHEN event_type = 'error' THEN NULL ELSE value::DECIMAL(14,2)::DOUBLE END AS seller_price, event_type = 'view' AS is_mp FROM events
    """,
)
def normalize_feed_order(spark, sf_dir):
    at = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    payload = record(
        srid=F.concat(F.lit(" "), text("event_id"), F.lit(" ")), nmId=F.col("user_id"), createdAt=at,
        updatedAt=F.concat(at, F.lit("+03:00")), status=F.col("event_type"), cancelType=F.lit(""), isMp=F.col("event_type") == "view",
        sellerPrice=F.when(F.col("event_type") == "error", "free").otherwise(F.regexp_replace(F.format_string("%.2f", "value"), r"\.", ",")),
    )
    rows = normalize.wb_feed_orders(load_spread(spark, sf_dir, "events").select(payload.alias("payload")))
    return rows.select(
        "srid", "nm_id", seconds("created_at"), seconds("status_updated_at"), "status", "cancel_type",
        F.col("seller_price").cast("double").alias("seller_price"), "is_mp",
    )


def _posting(spark, sf_dir):
    """Every line item as a posting of two products and one financial record."""
    first = F.struct(
        F.col("l_partkey").alias("sku"), F.concat(F.lit(" "), text("l_partkey")).alias("offer_id"), text("l_quantity").alias("name"),
        whole("l_quantity").alias("quantity"), F.struct(comma_text("l_extendedprice").alias("amount"), F.lit("RUB").alias("currency")).alias("price"),
        F.lit("BYN").alias("currency_code"), F.array("l_returnflag", "l_linestatus").alias("digital_codes"), F.lit("да").alias("is_marketplace_buyout"),
    )
    second = F.struct(
        text("l_suppkey").alias("sku"), text("l_extendedprice").alias("price"), F.lit("BYN").alias("currency_code"), F.lit("x").alias("quantity"),
        F.lit("no").alias("is_marketplace_buyout"),
    )
    finance = F.struct(
        F.col("l_partkey").alias("product_id"), comma_text("l_extendedprice").alias("payout"), F.col("l_linenumber").alias("old_price"),
        F.array(F.lit("promo")).alias("actions"), F.struct(F.lit("1,5").alias("amount"), F.lit("RUB").alias("currency")).alias("commission"),
    )
    head = record(
        order_id=text("l_orderkey"), order_number=F.concat(F.lit("N"), text("l_orderkey")), status=F.col("l_returnflag"),
        created_at=F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss'Z'"),
        analytics_data=F.struct(text("l_suppkey").alias("warehouse_id"), F.lit("true").alias("is_premium")),
        cancellation=F.struct(F.lit("why").alias("cancel_reason")), additional_data=F.array(F.lit("a"), F.lit("b")),
        posting_number=F.when(F.col("l_quantity") > 1, F.concat_ws("-", "l_orderkey", "l_linenumber")),
    )
    arrays = F.concat(
        F.lit(',"products":['), F.to_json(first), F.lit(","), F.to_json(second), F.lit('],"financial_data":{"cluster_from":"c","products":['),
        F.to_json(finance), F.lit("]}}"),
    )
    payload = F.concat(F.expr("substring(head, 1, length(head) - 1)"), F.col("tail"))
    rows = load_spread(spark, sf_dir, "lineitem").select(head.alias("head"), arrays.alias("tail"))
    return rows.select(payload.alias("payload"))


@query(
    "normalize_posting",
    """
    SELECT l_orderkey || '-' || l_linenumber AS posting_number, l_orderkey AS order_id, 'N' || l_orderkey AS order_number, l_returnflag AS status,
           epoch(l_shipdate)::BIGINT AS created_at, l_suppkey AS analytics_warehouse_id, TRUE AS analytics_is_premium, FALSE AS analytics_is_legal,
           'why' AS cancel_reason, 2 AS products_count, 1 AS financial_products_count, 2 AS additional_data_count
    FROM lineitem WHERE l_quantity > 1
    """,
)
def normalize_posting(spark, sf_dir):
    return normalize.postings(_posting(spark, sf_dir)).select(
        "posting_number", "order_id", "order_number", "status", seconds("created_at"), "analytics_warehouse_id", "analytics_is_premium",
        "analytics_is_legal", "cancel_reason", "products_count", "financial_products_count", "additional_data_count",
    )


@query(
    "items_zip_by_position",
    """
    SELECT l_orderkey || '-' || l_linenumber AS posting_number, 1 AS line_number, l_partkey AS product_sku, l_partkey::VARCHAR AS product_offer_id,
           l_quantity::BIGINT AS product_quantity, l_extendedprice::DECIMAL(14,2)::DOUBLE AS price, 'RUB' AS currency, 2 AS codes, TRUE AS buyout,
           l_partkey AS financial_product_id, l_extendedprice::DECIMAL(14,2)::DOUBLE AS payout, l_linenumber::DOUBLE AS old_price, 1.5::DOUBLE AS commission, 1 AS actions
    FROM lineitem WHERE l_quantity > 1
    UNION ALL
    SELECT l_orderkey || '-' || l_linenumber, 2, l_suppkey, '', 0, l_extendedprice::DECIMAL(14,2)::DOUBLE, 'BYN', 0, FALSE, NULL, 0, 0, 0, 0
    FROM lineitem WHERE l_quantity > 1
    """,
)
def items_zip_by_position(spark, sf_dir):
    items = normalize.order_items(_posting(spark, sf_dir))
    return items.select(
        "posting_number", "line_number", "product_sku", "product_offer_id", "product_quantity",
        F.col("product_price_amount").cast("double").alias("price"), F.col("product_price_currency").alias("currency"),
        F.col("product_digital_codes_count").alias("codes"), F.col("product_is_marketplace_buyout").alias("buyout"), "financial_product_id",
        F.col("financial_payout").cast("double").alias("payout"), F.col("financial_old_price").cast("double").alias("old_price"),
        F.col("financial_commission_amount").cast("double").alias("commission"), F.col("financial_actions_count").alias("actions"),
    )


@query(
    "normalize_stock",
    """
    SELECT l_partkey AS nm_id, l_orderkey AS chrt_id, l_suppkey AS warehouse_id, l_quantity::BIGINT AS quantity,
           CASE WHEN l_linestatus = 'O' THEN l_linenumber::BIGINT END AS in_way_to_client FROM lineitem
    WHERE l_partkey <> 0 AND l_orderkey <> 0 AND l_suppkey <> 0
    """,
)
def normalize_stock(spark, sf_dir):
    payload = record(
        nmId=F.col("l_partkey"), chrtId=text("l_orderkey"), warehouseId=F.col("l_suppkey"), warehouseName=F.lit(""), quantity=text("l_quantity").substr(1, 9),
        inWayToClient=F.when(F.col("l_linestatus") == "O", text("l_linenumber")).otherwise("none"),
    )
    payload = F.regexp_replace(payload, r"\.0", "")
    rows = normalize.wb_stocks(load_spread(spark, sf_dir, "lineitem").select(payload.alias("payload")))
    return rows.select("nm_id", "chrt_id", "warehouse_id", "quantity", "in_way_to_client")


@query(
    "normalize_product_list",
    "SELECT p_partkey AS product_id, p_brand AS offer_id, p_size % 2 = 0 AS archived, 2 AS quants_count FROM part",
)
def normalize_product_list(spark, sf_dir):
    payload = record(
        product_id=text("p_partkey"), offer_id=F.concat(F.col("p_brand"), F.lit("  ")), archived=F.col("p_size") % 2 == 0,
        quants=F.array("p_type", "p_name"),
    )
    rows = normalize.product_list(load_spread(spark, sf_dir, "part").select(payload.alias("payload")))
    return rows.select("product_id", "offer_id", "archived", "quants_count")


def _product(spark, sf_dir):
    size = F.col("p_size")
    payload = record(
        id=F.when(size > 25, F.col("p_partkey")), product_id=F.col("p_partkey"), offer_id=F.when(size % 3 != 0, F.col("p_brand")).otherwise(" "),
        sku=size, name=F.col("p_name"), price=comma_text("p_retailprice"), statuses=F.struct(F.col("p_type").alias("status"), F.lit("").alias("status_name")),
        visibility_details=F.struct(F.lit(True).alias("has_price")), model_info=F.struct(size.alias("model_id")),
        images=F.array(F.concat(F.lit("i"), text("p_size")), F.col("p_brand"), F.concat(F.lit("i"), text("p_size"))),
        primary_image=F.when(size > 25, F.array("p_brand", "p_type")).otherwise(F.array("p_type")),
        barcodes=F.array("p_type"),
    )
    return load_spread(spark, sf_dir, "part").select(payload.alias("payload"))


@query(
    "normalize_product_info",
    """
    SELECT p_partkey AS product_id, CASE WHEN p_size % 3 <> 0 THEN p_brand END AS offer_id, p_size::BIGINT AS sku,
           p_retailprice::DECIMAL(14,2)::DOUBLE AS price, p_type AS status, NULL AS status_name, TRUE AS has_price, FALSE AS has_stock,
           CASE WHEN p_size > 25 THEN p_brand ELSE p_type END AS primary_image, 3 AS images_count, 1 AS barcodes_count, p_size::BIGINT AS model_id FROM part
    """,
)
def normalize_product_info(spark, sf_dir):
    return normalize.product_info(_product(spark, sf_dir)).select(
        "product_id", "offer_id", "sku", F.col("price").cast("double").alias("price"), "status", "status_name", "has_price", "has_stock",
        "primary_image", "images_count", "barcodes_count", "model_id",
    )


@query(
    "normalize_product_card",
    """
    SELECT p_partkey::VARCHAR AS product_id, CASE WHEN p_size % 3 <> 0 THEN p_brand ELSE p_partkey::VARCHAR END AS article,
           CASE WHEN p_size > 25 THEN p_brand ELSE p_type END AS primary_image,
           CASE WHEN p_size > 25 THEN 'i' || p_size || '|' || p_brand ELSE p_type || '|i' || p_size || '|' || p_brand END AS images FROM part
    """,
)
def normalize_product_card(spark, sf_dir):
    cards = normalize.ozon_cards(_product(spark, sf_dir))
    return cards.select("product_id", "article", "primary_image", F.array_join("images", "|").alias("images"))


@query(
    "normalize_content_card",
    """
    SELECT p_partkey AS nm_id, CASE WHEN p_size > 25 THEN p_brand ELSE p_partkey::VARCHAR END AS article, p_name AS product_name,
           CASE WHEN p_size > 10 THEN 'b' || p_size ELSE 'c' || p_size END AS primary_image, 3 AS photos_count,
           CASE WHEN p_size > 10 THEN 'b' || p_size || '|t' ELSE 'c' || p_size || '|t' END AS images, 2 AS sizes_count FROM part
    """,
)
def normalize_content_card(spark, sf_dir):
    size = F.col("p_size")
    big = F.when(size > 10, F.concat(F.lit("b"), text("p_size"))).otherwise(" ")
    photo = F.struct(big.alias("big"), F.concat(F.lit("c"), text("p_size")).alias("c516x688"), F.lit(None).cast("string").alias("tm"))
    small = F.struct(F.lit("").alias("big"), F.lit(None).cast("string").alias("c516x688"), F.lit("t").alias("tm"))
    payload = record(
        nmID=F.col("p_partkey"), vendorCode=F.when(size > 25, F.col("p_brand")), title=F.concat(F.lit(" "), "p_name"),
        photos=F.array(photo, small, photo), sizes=F.array(F.struct(size.alias("s")), F.struct(size.alias("s"))),
    )
    cards = normalize.wb_cards(load_spread(spark, sf_dir, "part").select(payload.alias("payload")))
    return cards.select(
        "nm_id", "article", "product_name", "primary_image", F.array_join("images", "|").alias("images"), "photos_count", "sizes_count"
    )


@query(
    "normalize_cluster_stock",
    """
    SELECT l_partkey AS sku, l_suppkey AS cluster_id, l_quantity::BIGINT AS available_stock_count, (l_linenumber * 2 + 3)::BIGINT AS in_way_to_warehouse_count,
           l_tax::DECIMAL(14,4)::DOUBLE AS ads, CASE WHEN l_linestatus = 'O' THEN l_linenumber::BIGINT END AS days_without_sales, 1 AS item_tags_count FROM lineitem
    """,
)
def normalize_cluster_stock(spark, sf_dir):
    payload = record(
        sku=F.col("l_partkey"), cluster_id=text("l_suppkey"), available_stock_count=whole("l_quantity"), requested_stock_count=F.col("l_linenumber"),
        transit_stock_count=text("l_linenumber"), return_from_customer_stock_count=F.lit(3), valid_stock_count=F.lit("?"),
        ads=F.regexp_replace(text("l_tax"), r"\.", ","), days_without_sales=F.when(F.col("l_linestatus") == "O", F.col("l_linenumber")),
        item_tags=F.array("l_returnflag"),
    )
    rows = normalize.cluster_stocks(load_spread(spark, sf_dir, "lineitem").select(payload.alias("payload")))
    return rows.select(
        "sku", "cluster_id", "available_stock_count", "in_way_to_warehouse_count", F.col("ads").cast("double").alias("ads"), "days_without_sales",
        "item_tags_count",
    )


@query(
    "normalize_erp_product",
    """
    SELECT l_partkey::VARCHAR AS article, l_orderkey AS external_id, l_quantity::BIGINT AS sales_count, l_extendedprice::DECIMAL(14,2)::DOUBLE AS sales_sum,
           NULL AS brand_name, 0::BIGINT AS warehouse_count FROM lineitem
    """,
)
def normalize_erp_product(spark, sf_dir):
    payload = record(
        id=F.col("l_orderkey"), article=F.concat(F.lit(" "), text("l_partkey")), sales_count=whole("l_quantity"), sales_sum=comma_text("l_extendedprice"),
        brand_name=F.lit("  "), warehouse_count=F.lit("many"),
    )
    rows = normalize.erp_products(load_spread(spark, sf_dir, "lineitem").select(payload.alias("payload")))
    return rows.select("article", "external_id", "sales_count", F.col("sales_sum").cast("double").alias("sales_sum"), "brand_name", "warehouse_count")


@query(
    "explode_pages",
    """
    SELECT o_orderkey AS page_no, 0 AS position, 'RUB' AS currency, o_custkey::VARCHAR AS id FROM orders
    UNION ALL SELECT o_orderkey, 2, 'RUB', o_orderkey::VARCHAR FROM orders
    """,
)
def explode_pages_query(spark, sf_dir):
    payload = F.concat(
        F.lit('{"data":{"currency":"RUB","orders":[{"id":'), text("o_custkey"), F.lit('},"text",{"id":"'), text("o_orderkey"), F.lit('"},null]}}')
    )
    pages = load_spread(spark, sf_dir, "orders").select(F.lit("r").alias("run_id"), F.col("o_orderkey").alias("page_no"), payload.alias("payload"))
    records = explode_pages(pages, "$.data.orders", {"currency": "$.data.currency"})
    return records.select("page_no", "position", "currency", F.get_json_object("payload", "$.id").alias("id"))


@query(
    "file_orders",
    """
    SELECT 'shop' AS source_system, l_partkey::VARCHAR AS article, l_shipdate::DATE AS fact_date, l_returnflag AS status, l_quantity::BIGINT AS orders_qty,
           l_extendedprice::DECIMAL(14,2)::DOUBLE AS revenue FROM lineitem
    """,
)
def file_orders(spark, sf_dir):
    shape = (
        F.when(F.col("l_linestatus") == "O", F.date_format("l_shipdate", "dd.MM.yyyy")).otherwise(F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss"))
    )
    fields = {
        "Дата": shape, "Артикул": F.concat(F.lit("00"), text("l_partkey")), "Кол-во": F.concat(text("l_quantity"), F.lit(" ")),
        "Сумма": comma_text("l_extendedprice"), "Статус": F.concat(F.lit(" "), "l_returnflag"),
    }
    rows = normalize.file_orders(load_spread(spark, sf_dir, "lineitem").select(named_row(fields).alias("row")), "shop")
    return rows.withColumn("revenue", F.col("revenue").cast("double"))


@query(
    "file_stocks",
    """
    SELECT 'shop' AS source_system, l_partkey::VARCHAR AS article, CASE WHEN l_returnflag = 'A' THEN l_quantity::BIGINT WHEN l_returnflag = 'N' THEN 0
           ELSE l_linenumber::BIGINT END AS quantity, 0::BIGINT AS in_way_qty FROM lineitem
    """,
)
def file_stocks(spark, sf_dir):
    article = {"Артикул": text("l_partkey"), "В пути, шт": F.lit("")}
    both = named_row({**article, "Остаток, шт": F.when(F.col("l_returnflag") == "A", text("l_quantity")), "Остаток": F.lit("77")})
    only = named_row({**article, "Остаток": text("l_linenumber")})
    rows = load_spread(spark, sf_dir, "lineitem").select(F.when(F.col("l_returnflag") == "R", only).otherwise(both).alias("row"))
    return normalize.file_stocks(rows, "shop")


@query(
    "file_storage",
    """
    SELECT l_partkey::VARCHAR AS article, l_quantity::BIGINT AS paid_qty, l_tax::DECIMAL(14,3)::DOUBLE AS paid_liters,
           l_extendedprice::DECIMAL(14,2)::DOUBLE AS daily_writeoff_rub, CASE WHEN l_linestatus = 'O' THEN l_linenumber::BIGINT END AS days_until_first_paid FROM lineitem
    """,
)
def file_storage(spark, sf_dir):
    fields = {
        "Артикул": text("l_partkey"), "Платно, шт": text("l_quantity"), "Платно, л": F.regexp_replace(text("l_tax"), r"\.", ","),
        "Списано в день, RUB": comma_text("l_extendedprice"), "Дней до первой платности": F.when(F.col("l_linestatus") == "O", text("l_linenumber")).otherwise(""),
    }
    rows = normalize.file_storage(load_spread(spark, sf_dir, "lineitem").select(named_row(fields).alias("row")))
    return rows.withColumns({c: F.col(c).cast("double") for c in ("paid_liters", "daily_writeoff_rub")})


@query(
    "file_supply_stages",
    """
    SELECT l_partkey::VARCHAR AS article, l_quantity::BIGINT AS approved_order_qty, 0::BIGINT AS in_production_qty, l_linenumber::BIGINT AS ready_qty,
           0::BIGINT AS in_way_qty, date_trunc('month', l_shipdate)::DATE AS minsk_date FROM lineitem
    """,
)
def file_supply_stages(spark, sf_dir):
    """Sheet columns renamed to the published ones, then typed; the date is a month name and year."""
    names = ("январь", "февраля", "Март", "апреля", "май,", "июнь.", "июль", "август", "сентябрь", "октября", "ноябрь", "декабря")
    month = F.element_at(F.array(*[F.lit(n) for n in names]), F.month("l_shipdate"))
    fields = {
        "Ваш SKU": text("l_partkey"), "согласование заказа": text("l_quantity"), "в производстве": F.lit("-"), "готов": text("l_linenumber"),
        "Дата Минск": F.concat_ws(" ", month, F.year("l_shipdate")),
    }
    lines = load_spread(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", named_row(fields).alias("row"))
    rows = normalize.supply_columns(lines, ("l_orderkey", "l_linenumber"))
    return normalize.file_supply_stages(rows)


@query(
    "file_specs",
    """
    SELECT l_partkey::VARCHAR AS article, 'Пришло' AS source_sheet, l_orderkey AS source_row_number, 'AB' || l_suppkey AS specification,
           'AB' || l_suppkey AS lot, l_shipdate::DATE AS production_date FROM lineitem
    """,
)
def file_specs(spark, sf_dir):
    fields = {
        "Лист": F.lit("Пришло "), "Номер строки": text("l_orderkey"), "Артикул": text("l_partkey"), "LOT": F.lit(""),
        "Спецификация": F.concat(F.lit("а-В "), text("l_suppkey")), "Дата производсвта": F.date_format("l_shipdate", "d/M/yyyy"),
    }
    rows = normalize.file_specs(load_spread(spark, sf_dir, "lineitem").select(named_row(fields).alias("row")))
    return rows.select(
        "article", "source_sheet", "source_row_number", "specification", F.col("row")["LOT"].alias("lot"), "production_date"
    )


@query(
    "file_costs",
    """
    SELECT l_partkey::VARCHAR AS article, 'W' || l_suppkey AS warehouse_name, l_quantity::DOUBLE AS quantity,
           CASE WHEN l_linestatus = 'O' THEN l_extendedprice::DECIMAL(14,2)::DOUBLE ELSE 0 END AS total_cost_byn
    FROM lineitem WHERE l_returnflag <> 'R' OR l_linestatus = 'O'
    """,
)
def file_costs(spark, sf_dir):
    """Returned lines have no quantity; those without a total either are dropped."""
    rows = load_spread(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("0"), text("l_partkey")).alias("article"), F.concat(F.lit("W"), text("l_suppkey")).alias("warehouse_name"),
        F.when(F.col("l_returnflag") == "R", "0").otherwise(text("l_quantity")).alias("quantity"), F.lit("").alias("unit_cost_byn"),
        F.when(F.col("l_linestatus") == "O", F.regexp_replace(comma_text("l_extendedprice"), " ", " ")).alias("total_cost_byn"),
        whole("l_quantity").alias("q"), "l_returnflag",
    )
    costs = normalize.file_costs(rows)
    quantity = F.when(F.col("l_returnflag") == "R", F.col("q")).otherwise(F.col("quantity")).cast("double")
    return costs.select("article", "warehouse_name", quantity.alias("quantity"), F.col("total_cost_byn").cast("double").alias("total_cost_byn"))


@query(
    "placement_rows",
    """
    SELECT l_orderkey, l_linenumber, l_partkey AS sku, CASE WHEN l_returnflag = 'A' THEN l_suppkey::VARCHAR END AS offer_id, 'Name' AS product_name,
           l_extendedprice::DECIMAL(14,2)::DOUBLE AS placement_cost FROM lineitem
    """,
)
def placement_rows(spark, sf_dir):
    fields = {
        "Ozon SKU ": text("l_partkey"), "Артикул продавца": F.when(F.col("l_returnflag") == "A", text("l_suppkey")).otherwise(""), "Название": F.lit(" Name"),
        "Срок хранения": F.lit("долго"), "Стоимость размещения": comma_text("l_extendedprice"), "Итого": F.lit("1"),
    }
    rows = load_spread(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", named_row(fields).alias("row"))
    placed = normalize.placement_rows(rows)
    return placed.select(
        "l_orderkey", "l_linenumber", "sku", "offer_id", "product_name", F.col("placement_cost").cast("double").alias("placement_cost")
    )


@query(
    "file_inventory",
    """
    SELECT l_partkey::VARCHAR AS article, l_extendedprice::DECIMAL(14,3)::DOUBLE AS smp_qty, l_quantity::DOUBLE AS osn_qty, 0::DOUBLE AS soh_qty,
           l_linenumber::DOUBLE AS svh_qty, 0::DOUBLE AS ts_qty FROM lineitem
    """,
)
def file_inventory(spark, sf_dir):
    fields = {
        "Артикул": F.concat(F.lit("0"), text("l_partkey")), "СМП": comma_text("l_extendedprice"), "ОСН": text("l_quantity"), "СОХ": F.lit("-"),
        "СВХ": text("l_linenumber"),
    }
    rows = normalize.file_inventory(load_spread(spark, sf_dir, "lineitem").select(named_row(fields).alias("row")))
    return rows.withColumns({c: F.col(c).cast("double") for c in ("smp_qty", "osn_qty", "soh_qty", "svh_qty", "ts_qty")})


@query(
    "flat_view",
    """
    SELECT p_partkey::VARCHAR AS product_id, p_retailprice::DECIMAL(14,2)::DOUBLE AS price, p_type AS status FROM part
    """,
)
def flat_view(spark, sf_dir):
    """Typed columns of the product details without their payload."""
    rows = normalize.flat(normalize.product_info(_product(spark, sf_dir)))
    return rows.select(F.col("product_id").cast("string").alias("product_id"), F.col("price").cast("double").alias("price"), "status")
