"""JSON records to typed rows.

A record arrives as JSON text in ``payload``. It is read once, and every field is then
typed by its own parser, because the sources mix text and numbers freely. Fields are read
as text but for whole numbers and flags: what these mean depends on the JSON type (the
number 25.5 is 25 and the number 2 is true, the texts are not), so they are read as VARIANT.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradeloom.functions import dates, images, numbers, text

Parser = Callable[[Column], Column]
Field = tuple[str, str, Parser]

keep: Parser = lambda c: c
integer = numbers.json_integer
integer_or_0: Parser = lambda c: F.coalesce(numbers.json_integer(c), F.lit(0).cast("bigint"))
money = partial(numbers.parse_number, precision=14, scale=2)
money_or_0 = partial(numbers.parse_number, precision=14, scale=2, default="0")
decimal4 = partial(numbers.parse_number, precision=14, scale=4)
flag_or_null = text.parse_bool_null
flag = text.json_flag
when = dates.parse_ts
when_moscow = partial(dates.parse_ts, naive_offset="+03:00")
day = dates.parse_date_iso
some_text = text.empty_to_null
trimmed = text.blank_to_null
price = numbers.price_amount


#: parsers that need the JSON type
TYPED = (integer, integer_or_0, flag)


def _schema(fields: list[Field], texts: tuple[str, ...] = (), arrays: tuple[str, ...] = (), typed: tuple[str, ...] = ()) -> T.StructType:
    """Struct holding the dotted path of every field, and ``texts``, ``arrays`` of JSON text and ``typed`` values."""
    typed = (*typed, *[path for _, path, parse in fields if parse in TYPED])
    tree: dict = {}
    for path in (*[path for _, path, _ in fields], *texts, *arrays, *typed):
        node = tree
        for part in path.split("."):
            node = node.setdefault(part, {})

    def build(node: dict, prefix: str) -> T.DataType:
        if not node:
            return T.VariantType() if prefix in typed else T.ArrayType(T.StringType()) if prefix in arrays else T.StringType()
        return T.StructType(
            [T.StructField(name, build(child, f"{prefix}.{name}" if prefix else name)) for name, child in node.items()]
        )

    return build(tree, "")


def with_record(df: DataFrame, schema: T.StructType | str, payload: str = "payload") -> DataFrame:
    """Add the parsed record ``__r``.

    The record is the output of a generator. A later filter on one of its fields would
    otherwise move below the projection and read the JSON a second time.
    """
    return df.select("*", F.explode(F.array(F.from_json(payload, schema))).alias("__r"))


def elements(path: str, record: str = "__r") -> Column:
    """Array of a record, empty when absent."""
    return F.coalesce(F.col(f"{record}.{path}"), F.array().cast("array<string>"))


def apply_fields(
    df: DataFrame,
    fields: list[Field],
    required: list[str],
    arrays: tuple[str, ...] = (),
    derived: dict[str, Column] | None = None,
    texts: tuple[str, ...] = (),
    values: tuple[str, ...] = (),
) -> DataFrame:
    """Typed columns of a record, read in one pass; rows lacking a required column are dropped.

    ``derived`` columns are built on the record ``__r``, which also holds the paths in
    ``arrays``, ``texts`` and, as VARIANT, ``values``.
    """
    schema = _schema(fields, texts, arrays, values)
    record = with_record(df, schema)
    typed = {name: parse(F.col(f"__r.{path}")) for name, path, parse in fields}
    typed |= derived or {}
    kept = [c for c in df.columns if c not in typed]
    result = record.select(*kept, *[c.alias(n) for n, c in typed.items()])
    for name in required:
        result = result.where(F.col(name).isNotNull() & (F.col(name).cast("string") != ""))
    return result


WB_ORDER: list[Field] = [
    ("srid", "srid", keep), ("is_cancel", "isCancel", flag_or_null),
    ("date_ts", "date", when_moscow), ("last_change_ts", "lastChangeDate", when_moscow),
    ("warehouse_name", "warehouseName", keep), ("warehouse_type", "warehouseType", keep),
    ("country_name", "countryName", keep), ("oblast_okrug_name", "oblastOkrugName", keep),
    ("region_name", "regionName", keep), ("supplier_article", "supplierArticle", keep),
    ("nm_id", "nmId", integer), ("barcode", "barcode", keep), ("category", "category", keep),
    ("subject", "subject", keep), ("brand", "brand", keep), ("tech_size", "techSize", keep),
    ("income_id", "incomeID", integer), ("is_supply", "isSupply", flag_or_null),
    ("is_realization", "isRealization", flag_or_null), ("total_price", "totalPrice", money),
    ("discount_percent", "discountPercent", integer), ("spp", "spp", integer),
    ("finished_price", "finishedPrice", money), ("price_with_disc", "priceWithDisc", money),
    ("cancel_date", "cancelDate", day), ("sticker", "sticker", keep), ("g_number", "gNumber", keep),
]

WB_FEED_ORDER: list[Field] = [
    ("srid", "srid", trimmed), ("nm_id", "nmId", integer), ("chrt_id", "chrtId", integer),
    ("created_at", "createdAt", when), ("status_updated_at", "updatedAt", when),
    ("status", "status", some_text), ("cancel_type", "cancelType", some_text),
    ("warehouse_name", "warehouseName", some_text), ("warehouse_region", "warehouseRegion", some_text),
    ("is_mp", "isMp", flag_or_null), ("destination_city", "destinationCity", some_text),
    ("destination_district", "destinationDistrict", some_text), ("seller_price", "sellerPrice", money),
    ("is_b2b", "isB2b", flag_or_null),
]

POSTING: list[Field] = [
    ("posting_number", "posting_number", keep), ("order_id", "order_id", integer),
    ("order_number", "order_number", keep), ("status", "status", keep), ("substatus", "substatus", keep),
    ("created_at", "created_at", when), ("in_process_at", "in_process_at", when),
    ("shipment_date", "shipment_date", when), ("cancel_reason_id", "cancel_reason_id", integer),
    ("cancel_reason", "cancellation.cancel_reason", keep),
    ("cancellation_initiator", "cancellation.cancellation_initiator", keep),
    ("cancellation_type", "cancellation.cancellation_type", keep),
    ("analytics_city", "analytics_data.city", keep),
    ("analytics_delivery_type", "analytics_data.delivery_type", keep),
    ("analytics_is_legal", "analytics_data.is_legal", flag),
    ("analytics_is_premium", "analytics_data.is_premium", flag),
    ("analytics_payment_type_group_name", "analytics_data.payment_type_group_name", keep),
    ("analytics_warehouse_id", "analytics_data.warehouse_id", integer),
    ("analytics_warehouse_name", "analytics_data.warehouse_name", keep),
    ("analytics_client_delivery_date_begin", "analytics_data.client_delivery_date_begin", when),
    ("analytics_client_delivery_date_end", "analytics_data.client_delivery_date_end", when),
    ("financial_cluster_from", "financial_data.cluster_from", keep),
    ("financial_cluster_to", "financial_data.cluster_to", keep),
    ("legal_company_name", "legal_info.company_name", keep), ("legal_inn", "legal_info.inn", keep),
    ("legal_kpp", "legal_info.kpp", keep),
    ("external_order_is_external", "external_order.is_external", flag),
    ("external_order_platform_name", "external_order.platform_name", keep),
]

ORDER_PRODUCT: list[Field] = [
    ("product_is_marketplace_buyout", "is_marketplace_buyout", flag), ("product_name", "name", keep),
    ("product_sku", "sku", integer), ("product_quantity", "quantity", integer_or_0),
]
ORDER_FINANCE: list[Field] = [
    ("financial_product_id", "product_id", integer), ("financial_payout", "payout", price),
    ("financial_old_price", "old_price", price), ("financial_price", "price", price),
    ("financial_total_discount_value", "total_discount_value", price),
    ("financial_total_discount_percent", "total_discount_percent", price),
    ("financial_commission_amount", "commission.amount", price),
    ("financial_commission_percent", "commission.percent", price),
    ("financial_commission_currency", "commission.currency", keep),
]

WB_STOCK: list[Field] = [
    ("nm_id", "nmId", integer), ("chrt_id", "chrtId", integer), ("warehouse_id", "warehouseId", integer),
    ("warehouse_name", "warehouseName", some_text), ("region_name", "regionName", some_text),
    ("quantity", "quantity", integer), ("in_way_to_client", "inWayToClient", integer),
    ("in_way_from_client", "inWayFromClient", integer),
]

PRODUCT_LIST_ITEM: list[Field] = [
    ("product_id", "product_id", integer), ("offer_id", "offer_id", trimmed), ("sku", "sku", integer),
    ("archived", "archived", flag), ("has_fbo_stocks", "has_fbo_stocks", flag),
    ("has_fbs_stocks", "has_fbs_stocks", flag), ("is_discounted", "is_discounted", flag),
]

PRODUCT_INFO_ITEM: list[Field] = [
    ("offer_id", "offer_id", trimmed), ("sku", "sku", integer), ("name", "name", keep),
    ("currency_code", "currency_code", keep), ("price", "price", money), ("old_price", "old_price", money),
    ("min_price", "min_price", money), ("vat", "vat", decimal4), ("volume_weight", "volume_weight", decimal4),
    ("description_category_id", "description_category_id", integer), ("type_id", "type_id", integer),
    ("is_archived", "is_archived", flag), ("is_autoarchived", "is_autoarchived", flag),
    ("is_discounted", "is_discounted", flag), ("has_discounted_fbo_item", "has_discounted_fbo_item", flag),
    ("is_kgt", "is_kgt", flag), ("is_prepayment_allowed", "is_prepayment_allowed", flag),
    ("is_seasonal", "is_seasonal", flag), ("is_super", "is_super", flag),
    ("status", "statuses.status", some_text), ("status_name", "statuses.status_name", some_text),
    ("status_description", "statuses.status_description", some_text),
    ("moderate_status", "statuses.moderate_status", some_text),
    ("validation_status", "statuses.validation_status", some_text),
    ("status_updated_at", "statuses.status_updated_at", when),
    ("has_price", "visibility_details.has_price", flag), ("has_stock", "visibility_details.has_stock", flag),
    ("model_id", "model_info.model_id", integer), ("model_count", "model_info.count", integer),
    ("updated_at", "updated_at", when), ("created_at", "created_at", when),
]

CLUSTER_STOCK: list[Field] = [
    ("sku", "sku", integer), ("offer_id", "offer_id", trimmed), ("cluster_id", "cluster_id", integer),
    ("cluster_name", "cluster_name", keep),
    *[
        (name, name, integer_or_0)
        for name in (
            "available_stock_count", "valid_stock_count", "other_stock_count", "requested_stock_count",
            "transit_stock_count", "return_from_customer_stock_count", "return_to_seller_stock_count",
            "stock_defect_stock_count", "transit_defect_stock_count", "expiring_stock_count",
            "waiting_docs_stock_count", "waiting_docs_to_export_stock_count", "excess_stock_count",
        )
    ],
    ("ads", "ads", decimal4), ("ads_cluster", "ads_cluster", decimal4), ("idc", "idc", decimal4),
    ("idc_cluster", "idc_cluster", decimal4), ("days_without_sales", "days_without_sales", integer),
    ("days_without_sales_cluster", "days_without_sales_cluster", integer),
    ("turnover_grade", "turnover_grade", keep), ("turnover_grade_cluster", "turnover_grade_cluster", keep),
    ("macrolocal_cluster_id", "macrolocal_cluster_id", integer), ("warehouse_id", "warehouse_id", integer),
    ("warehouse_name", "warehouse_name", keep), ("placement_zone", "placement_zone", keep),
    ("name", "name", keep),
]

ERP_PRODUCT: list[Field] = [
    ("external_id", "id", integer), ("article", "article", trimmed), ("series_name", "series_name", trimmed),
    ("brand_name", "brand_name", trimmed), ("name_1s", "name_1s", trimmed), ("barcode", "barcode", trimmed),
    *[
        (name, name, integer_or_0)
        for name in (
            "remains_warehouse_count", "warehouse_count", "presence_count", "for_marketplaces_count",
            "reserved_total_count", "reserved_invoice_count", "reserved_cash_count",
        )
    ],
    ("avg_price", "avg_price", money), ("sales_count", "sales_count", integer_or_0),
    ("sales_sum", "sales_sum", money_or_0),
]


def wb_orders(df: DataFrame) -> DataFrame:
    return apply_fields(df, WB_ORDER, ["srid"])


def wb_feed_orders(df: DataFrame) -> DataFrame:
    """Feed orders; ``currency`` comes with the page."""
    return apply_fields(df, WB_FEED_ORDER, ["srid"])


POSTING_ARRAYS = ("products", "financial_data.products", "additional_data")


def _posting_fields(keep_arrays: bool) -> dict[str, Column]:
    sizes = {
        "products_count": F.size(elements("products")),
        "financial_products_count": F.size(elements("financial_data.products")),
        "additional_data_count": F.size(elements("additional_data")),
        "additional_data": elements("additional_data"),
    }
    if keep_arrays:
        sizes |= {"__products": elements("products"), "__finance": elements("financial_data.products")}
    return sizes


def postings(df: DataFrame) -> DataFrame:
    """Posting headers with the sizes of their arrays."""
    return apply_fields(df, POSTING, ["posting_number"], POSTING_ARRAYS, _posting_fields(False))


def order_items(df: DataFrame) -> DataFrame:
    """One row per product of a posting, paired by position with its financial record."""
    headers = apply_fields(df, POSTING, ["posting_number"], POSTING_ARRAYS, _posting_fields(True))
    lines = headers.select("*", F.posexplode("__products").alias("__pos", "__product"))
    paired = F.get("__finance", F.col("__pos"))
    empty = F.lit("{}")
    lines = lines.withColumns(
        {
            "line_number": F.col("__pos") + 1,
            "product_payload": F.when(F.col("__product").startswith("{"), F.col("__product")).otherwise(empty),
            "financial_product_payload": F.when(paired.startswith("{"), paired).otherwise(empty),
        }
    ).drop("__products", "__finance", "__pos", "__product")
    product = _schema(ORDER_PRODUCT, ("offer_id", "price", "currency_code"), ("digital_codes",))
    finance = _schema(ORDER_FINANCE, (), ("actions",))
    lines = lines.withColumns(
        {"__p": F.from_json("product_payload", product), "__f": F.from_json("financial_product_payload", finance)}
    )
    typed = {
        **{name: parse(F.col(f"__p.{path}")) for name, path, parse in ORDER_PRODUCT},
        **{name: parse(F.col(f"__f.{path}")) for name, path, parse in ORDER_FINANCE},
        "product_offer_id": F.coalesce(numbers.strip(F.col("__p.offer_id")), F.lit("")),
        "product_price_amount": price(F.col("__p.price")),
        "product_price_currency": numbers.price_currency("__p.price", "__p.currency_code"),
        "product_digital_codes": elements("digital_codes", "__p"),
        "product_digital_codes_count": F.size(elements("digital_codes", "__p")),
        "financial_actions": elements("actions", "__f"),
        "financial_actions_count": F.size(elements("actions", "__f")),
    }
    return lines.withColumns(typed).drop("__p", "__f")


def wb_stocks(df: DataFrame) -> DataFrame:
    """Warehouse stock rows with a full, non-zero key."""
    rows = apply_fields(df, WB_STOCK, [])
    for part in ("nm_id", "chrt_id", "warehouse_id"):
        rows = rows.where(F.col(part).isNotNull() & (F.col(part) != 0))
    return rows


def product_list(df: DataFrame) -> DataFrame:
    return apply_fields(
        df, PRODUCT_LIST_ITEM, ["product_id"], ("quants",), {"quants_count": F.size(elements("quants"))}
    )


PRODUCT_ARRAYS = ("images", "barcodes", "commissions")


def _product_fields() -> dict[str, Column]:
    raw_image = F.col("__r.primary_image")
    first_image = F.when(raw_image.startswith("["), F.get(F.from_json(raw_image, "array<string>"), F.lit(0)))
    return {
        # chosen once: spelled out in a filter, the choice would outgrow a generated method
        "product_id": F.get(F.transform(F.array(text.first_true(F.col("__r.id"), F.col("__r.product_id"))), integer), F.lit(0)),
        "primary_image": some_text(F.coalesce(first_image, F.when(~raw_image.startswith("["), raw_image))),
        "images_count": F.size(elements("images")),
        "barcodes_count": F.size(elements("barcodes")),
        "commissions_count": F.size(elements("commissions")),
    }


PRODUCT_TEXTS, PRODUCT_VALUES = ("primary_image",), ("id", "product_id")


def product_info(df: DataFrame) -> DataFrame:
    """Product details; the id is ``id``, else ``product_id``."""
    return apply_fields(df, PRODUCT_INFO_ITEM, ["product_id"], PRODUCT_ARRAYS, _product_fields(), PRODUCT_TEXTS, PRODUCT_VALUES)


def cluster_stocks(df: DataFrame) -> DataFrame:
    """Cluster stock rows with the derived in-way total."""
    rows = apply_fields(df, CLUSTER_STOCK, ["sku"], ("item_tags",), {"item_tags_count": F.size(elements("item_tags"))})
    in_way = F.col("requested_stock_count") + F.col("transit_stock_count") + F.col("return_from_customer_stock_count")
    return rows.withColumn("in_way_to_warehouse_count", in_way)


AD_METRICS = "nmId variant, sum string, views variant, clicks variant, atbs variant, orders variant, shks variant, sum_price string"
AD_DAYS = (
    f"array<struct<date string, apps array<struct<nm array<struct<{AD_METRICS}>>, nms array<struct<{AD_METRICS}>>>>>>"
)


def ad_statistics(df: DataFrame) -> DataFrame:
    """Campaign statistics flattened to one row per (advert, day, app, item)."""
    record = with_record(df, f"struct<advertId variant, days {AD_DAYS}>")
    record = record.select(integer(F.col("__r.advertId")).alias("advert_id"), F.col("__r.days").alias("days"))
    record = record.where(F.col("advert_id").isNotNull() & (F.col("advert_id") != 0))
    day_rows = record.select("advert_id", F.explode("days").alias("d"))
    app_rows = day_rows.select(
        "advert_id", F.substring("d.date", 1, 10).alias("stat_date"), F.explode("d.apps").alias("app")
    ).where(F.coalesce("stat_date", F.lit("")) != "")
    items = F.when(F.size("app.nm") > 0, F.col("app.nm")).otherwise(F.col("app.nms"))
    nm_rows = app_rows.select("advert_id", "stat_date", F.explode(items).alias("nm"))
    number = partial(numbers.parse_number, precision=18, scale=4, default="0")
    return nm_rows.select(
        "advert_id",
        integer(F.col("nm.nmId")).alias("nm_id"),
        F.col("stat_date").try_cast("date").alias("stat_date"),
        number(F.col("nm.sum")).alias("spend_rub"),
        *[integer_or_0(F.col(f"nm.{c}")).alias(c) for c in ("views", "clicks", "atbs", "orders", "shks")],
        number(F.col("nm.sum_price")).alias("sum_price"),
    ).where(F.col("nm_id").isNotNull() & (F.col("nm_id") != 0))


CARD_SCHEMA = (
    "struct<nmID variant, nm_id variant, vendorCode string, vendor_code string, title string, name string, "
    "brand string, imtID variant, subjectID variant, subjectName string, "
    "photos array<struct<big string, c516x688 string, c246x328 string, tm string, square string>>, sizes array<string>>"
)


def wb_cards(df: DataFrame) -> DataFrame:
    """Content cards as product cards; the article is the vendor code, else the id."""

    def either(*names: str) -> Column:
        return F.coalesce(*[some_text(F.col(f"__r.{n}")) for n in names])

    def other_case(name: str) -> Column:
        return F.try_variant_get(F.try_parse_json("payload"), f"$.{name}", "variant")

    def number(name: str, *more: Column) -> Column:
        """The record is read anew, for a name that differs in case only, where the value is missing."""
        own = F.col(f"__r.{name}")
        return F.when(text.counts_as_true(own), integer(own)).otherwise(integer(text.first_true(*more, own)))

    photos = F.coalesce("__r.photos", F.array().cast("array<struct<big string, c516x688 string, c246x328 string, tm string, square string>>"))
    rows = with_record(df, CARD_SCHEMA).withColumns(
        {
            "nm_id": number("nmID", other_case("nmId"), F.col("__r.nm_id")),
            "images": images.photo_urls(photos),
            "product_name": trimmed(either("title", "name")),
            "brand": trimmed(F.col("__r.brand")),
            "photos_count": F.size(photos),
            "sizes_count": F.size(elements("sizes")),
            "imt_id": number("imtID", other_case("imtId")),
            "subject_id": number("subjectID", other_case("subjectId")),
            "subject_name": trimmed(F.col("__r.subjectName")),
            "vendor_code": trimmed(either("vendorCode", "vendor_code")),
        }
    )
    return rows.where(F.col("nm_id").isNotNull()).drop("__r").withColumns(
        {
            "marketplace": F.lit("wb"),
            "article": F.coalesce("vendor_code", F.col("nm_id").cast("string")),
            "product_id": F.col("nm_id").cast("string"),
            "marketplace_sku": F.col("nm_id"),
            "primary_image": F.get("images", F.lit(0)),
            "images_count": F.size("images"),
        }
    )


def ozon_cards(df: DataFrame) -> DataFrame:
    """Product details as product cards; the primary image leads the list when missing from it."""
    derived = _product_fields() | {
        "__images": F.array_distinct(F.filter(elements("images"), lambda u: u.isNotNull() & (numbers.strip(u) != "")))
    }
    rows = apply_fields(df, PRODUCT_INFO_ITEM, ["product_id"], PRODUCT_ARRAYS, derived, PRODUCT_TEXTS, PRODUCT_VALUES)
    rows = rows.withColumn("primary_image", F.coalesce(trimmed(F.col("primary_image")), F.get("__images", F.lit(0))))
    primary = F.col("primary_image")
    listed = primary.isNull() | F.array_contains("__images", F.coalesce(primary, F.lit("")))
    ordered = F.when(listed, F.col("__images")).otherwise(F.concat(F.array(primary), F.col("__images")))
    return rows.withColumns(
        {
            "marketplace": F.lit("ozon"),
            "article": F.coalesce("offer_id", F.col("product_id").cast("string")),
            "product_id": F.col("product_id").cast("string"),
            "marketplace_sku": F.col("sku"),
            "product_name": F.col("name"),
            "brand": F.lit(None).cast("string"),
            "images": ordered,
            "images_count": F.size(ordered),
        }
    ).drop("__images")


def erp_products(df: DataFrame) -> DataFrame:
    return apply_fields(df, ERP_PRODUCT, ["article"])


def _cell(name: str) -> Column:
    """Value of one named column of a file row held as MAP."""
    return F.try_element_at("row", F.lit(name))


def _bound(df: DataFrame, values: dict[str, Column]) -> DataFrame:
    """All columns and the struct ``__c`` of the values, made once a row: a generator keeps later filters above it."""
    return df.select("*", F.explode(F.array(F.struct(*[v.alias(n) for n, v in values.items()]))).alias("__c"))


qty3 = partial(numbers.parse_number, precision=14, scale=3, default="0")


def file_orders(df: DataFrame, source_system: str) -> DataFrame:
    """Daily orders of a file; ``row`` is a map of header to text."""
    return df.select(
        F.lit(source_system).alias("source_system"),
        text.clean_article(_cell("Артикул")).alias("article"),
        dates.parse_date_multi(_cell("Дата")).alias("fact_date"),
        F.coalesce(numbers.strip(_cell("Статус")), F.lit("")).alias("status"),
        numbers.parse_int_lenient(_cell("Кол-во")).alias("orders_qty"),
        money_or_0(_cell("Сумма")).alias("revenue"),
    ).where(F.col("fact_date").isNotNull() & (F.col("article") != ""))


def file_stocks(df: DataFrame, source_system: str) -> DataFrame:
    """Stock summary; the second header counts only when the first is absent."""
    quantity = F.when(F.map_contains_key("row", "Остаток, шт"), _cell("Остаток, шт")).otherwise(_cell("Остаток"))
    return df.select(
        F.lit(source_system).alias("source_system"),
        text.clean_article(_cell("Артикул")).alias("article"),
        numbers.parse_int_lenient(quantity).alias("quantity"),
        numbers.parse_int_lenient(_cell("В пути, шт")).alias("in_way_qty"),
    ).where(F.col("article") != "")


def file_storage(df: DataFrame) -> DataFrame:
    days = _cell("Дней до первой платности")
    return df.select(
        text.clean_article(_cell("Артикул")).alias("article"),
        numbers.parse_int_lenient(_cell("Платно, шт")).alias("paid_qty"),
        qty3(_cell("Платно, л")).alias("paid_liters"),
        money_or_0(_cell("Списано в день, RUB")).alias("daily_writeoff_rub"),
        F.when(days != "", numbers.parse_int_lenient(days)).alias("days_until_first_paid"),
    ).where(F.col("article") != "")


def file_inventory(df: DataFrame) -> DataFrame:
    columns = {"СМП": "smp_qty", "ОСН": "osn_qty", "СОХ": "soh_qty", "СВХ": "svh_qty", "ТС": "ts_qty"}
    return df.select(
        text.clean_article(_cell("Артикул")).alias("article"),
        *[qty3(_cell(header)).alias(name) for header, name in columns.items()],
    ).where(F.col("article") != "")


def file_supply_stages(df: DataFrame) -> DataFrame:
    counts = {
        "СОГЛ Заказа": "approved_order_qty", "В ПРОИЗВ": "in_production_qty", "ГОТОВ": "ready_qty", "В ПУТИ": "in_way_qty",
    }
    # cells are found once, in a step of their own that the filter is not pushed below, and then parsed
    cells = _bound(df.select("row"), {"article": _cell("Артикул"), **{name: _cell(header) for header, name in counts.items()}, "minsk_date": _cell("МИНСК")})
    return cells.select(
        text.clean_article("__c.article").alias("article"),
        *[numbers.parse_int_lenient(f"__c.{name}").alias(name) for name in counts.values()],
        dates.parse_date_multi("__c.minsk_date").alias("minsk_date"),
    ).where(F.col("article") != "")


def file_specs(df: DataFrame) -> DataFrame:
    """Supply order specifications; the normalized lot goes back into the row."""
    def either(*names: str) -> Column:
        return F.coalesce(*[F.nullif(_cell(n), F.lit("")) for n in names])

    lot = text.normalize_lot(either("LOT", "Спец-ия", "Спецификация"))
    others = F.map_filter("row", lambda k, _: k != "LOT")
    return df.select(
        F.coalesce(numbers.strip(_cell("Лист")), F.lit("")).alias("source_sheet"),
        numbers.parse_int_lenient(_cell("Номер строки")).alias("source_row_number"),
        text.clean_article(_cell("Артикул")).alias("article"),
        lot.alias("specification"),
        F.coalesce(numbers.strip(_cell("Менеджер")), F.lit("")).alias("manager_name"),
        dates.parse_date_multi(either("Дата производства", "Дата производсвта")).alias("production_date"),
        F.map_concat(others, F.create_map(F.lit("LOT"), lot)).alias("row"),
    ).where(F.col("article") != "")


def file_costs(df: DataFrame) -> DataFrame:
    """Cost rows by warehouse; rows with all three measures at 0 are dropped."""
    number = partial(numbers.parse_number, precision=18, scale=4, default="0", nbsp=True)
    measures = ("quantity", "unit_cost_byn", "total_cost_byn")
    rows = df.withColumns(
        {
            "article": text.clean_article("article"),
            "warehouse_name": F.coalesce(numbers.strip(F.col("warehouse_name")), F.lit("")),
            **{m: number(F.col(m)) for m in measures},
        }
    )
    non_zero = F.lit(False)
    for m in measures:
        non_zero = non_zero | (F.col(m) != 0)
    return rows.where((F.col("article") != "") & (F.col("warehouse_name") != "") & non_zero)


# Header names and markers of placement reports.
SKU_HEADERS = ("sku", "озон sku", "ozon sku", "идентификатор товара", "идентификатор товара ozon")
OFFER_HEADERS = ("артикул", "offer_id", "offer id", "артикул продавца")
NAME_HEADERS = ("название", "товар", "наименование", "product_name", "name")
COST_MARKERS = ("стоимость", "размещ", "хранен", "placement", "storage", "amount", "итого")


def placement_rows(df: DataFrame) -> DataFrame:
    """Placement rows from ``row``, a map of header to text, by header name sets."""
    headed = F.transform(
        F.map_entries("row"), lambda e: F.struct(text.norm_header(e["key"]).alias("header"), e["value"].alias("value"))
    )

    def named(names: tuple[str, ...]) -> Column:
        return F.get(F.filter("__entries", lambda e: e["header"].isin(*names)), F.lit(0))["value"]

    costs = F.transform(
        F.filter("__entries", lambda e: text.contains_any(e["header"], COST_MARKERS)),
        lambda e: numbers.parse_number(e["value"], 14, 2),
    )
    filled = F.exists(F.map_values("row"), lambda v: v.isNotNull() & (v != ""))
    # headers are normalized once, cells found once, each in a step of its own
    found = df.where(filled).withColumn("__entries", headed).withColumns(
        {
            "__sku": named(SKU_HEADERS), "__offer": named(OFFER_HEADERS), "__name": named(NAME_HEADERS),
            "placement_cost": F.get(F.filter(costs, lambda c: c.isNotNull()), F.lit(0)),
        }
    ).drop("__entries")
    return found.withColumns(
        {
            "sku": numbers.parse_int_lenient_null("__sku"),
            "offer_id": F.when(F.col("__offer") != "", numbers.strip(F.col("__offer"))),
            "product_name": F.when(F.col("__name") != "", numbers.strip(F.col("__name"))),
        }
    ).drop("__sku", "__offer", "__name")


def supply_columns(df: DataFrame, ties: tuple[str, ...] = ()) -> DataFrame:
    """Supply pipeline sheet to the published column names, ordered by article text, then ``ties``."""
    from tradeloom.sources.sheets import is_article_header, pick_by_header

    article = F.coalesce(F.nullif(_cell("Артикул"), F.lit("")), pick_by_header("row", is_article_header))
    names = {
        "СОГЛ Заказа": "согласование заказа", "В ПРОИЗВ": "в производстве", "ГОТОВ": "готов",
        "В ПУТИ": "в пути", "МИНСК": "Дата Минск",
    }
    # plain values are sorted, without their headers
    values = {"Артикул": article, **{target: _cell(source) for target, source in names.items()}}
    places = {target: f"v{i}" for i, target in enumerate(values)}
    pairs = [x for target, place in places.items() for x in (F.lit(target), F.col(f"__c.{place}"))]
    return (
        _bound(df, {places[target]: value for target, value in values.items()})
        .drop("row")
        .where(F.coalesce("__c.v0", F.lit("")) != "")
        .orderBy("__c.v0", *ties)
        .select(*[F.create_map(*pairs).alias("row") if c == "row" else F.col(f"`{c}`") for c in df.columns])
    )


def flat(df: DataFrame, drop: tuple[str, ...] = ("payload",)) -> DataFrame:
    """Typed columns only, without payload columns."""
    return df.drop(*drop)
