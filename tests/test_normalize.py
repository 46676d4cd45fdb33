import json
from datetime import date
from decimal import Decimal

from pyspark.sql import functions as F

from tradeloom.operators import merge, normalize
from tradeloom.plans import ads
from tradeloom.sources import landing

D = Decimal


def records(spark, *rows, **columns):
    frame = spark.createDataFrame([(json.dumps(r, ensure_ascii=False),) for r in rows], "payload string")
    return frame.withColumns({n: F.lit(v) for n, v in columns.items()})


def maps(spark, *rows):
    return spark.createDataFrame([(r,) for r in rows], "row map<string,string>")


def first(df):
    return df.first().asDict(recursive=True)


def test_order_record(spark):
    got = normalize.wb_orders(
        records(
            spark,
            {"srid": "order-1", "isCancel": "false", "date": "2026-07-21T10:00:00+03:00", "lastChangeDate": "2026-07-21T10:05:00", "nmId": "123456",
             "totalPrice": "1 234,50", "priceWithDisc": "1111,05", "discountPercent": "10", "cancelDate": "2026-07-22"},
            {"srid": ""},
            {"isCancel": True},
        )
    ).select("*", F.unix_seconds("date_ts").alias("s"), F.unix_seconds("last_change_ts").alias("t")).collect()
    assert len(got) == 1
    row = got[0]
    assert (row.srid, row.is_cancel, row.nm_id, row.total_price, row.price_with_disc) == ("order-1", False, 123456, D("1234.50"), D("1111.05"))
    assert row.discount_percent == 10 and row.cancel_date == date(2026, 7, 22) and row.t - row.s == 300 and row.warehouse_name is None


def test_whole_numbers_and_flags_by_json_type(spark):
    values = [12.0, 25.5, -3.99, "25.5", " 12\u00a0", True, "true", "", None, 10**30, [1], {"a": 1}, "1e3", 1e3]
    rows = normalize.wb_orders(records(spark, *[{"srid": str(i), "nmId": v} for i, v in enumerate(values)])).collect()
    assert {int(r.srid): r.nm_id for r in rows} == dict(enumerate([12, 25, -3, None, 12, 1, None, None, None, None, None, None, None, 1000]))
    values = [2, 0, 0.0, 0.5, "2", "1", " Да ", True, False, None, "", [], [0], {}, {"a": 0}]
    rows = normalize.product_list(records(spark, *[{"product_id": i + 1, "archived": v} for i, v in enumerate(values)])).collect()
    assert {r.product_id - 1: r.archived for r in rows} == dict(enumerate(
        [True, False, False, True, False, True, True, True, False, False, False, False, True, False, True]
    ))
    cards = normalize.wb_cards(records(spark, {"nmID": 0, "nmId": 7.5}, {"nm_id": "9"}, {"nmID": "", "nmId": None, "nm_id": 11.0}, {"nmID": 5, "nmId": 6}))
    assert sorted(r.nm_id for r in cards.collect()) == [5, 7, 9, 11]


def test_feed_record(spark):
    row = first(
        normalize.wb_feed_orders(
            records(spark, {"srid": " one ", "createdAt": "2026-08-01T10:00:00+03:00", "updatedAt": "2026-08-01T07:00:00", "status": "", "isMp": 1,
                            "sellerPrice": "1234.50", "isB2b": None}, currency="RUB")
        ).withColumn("same", F.col("created_at") == F.col("status_updated_at"))
    )
    assert row["srid"] == "one" and row["same"] and row["status"] is None and row["is_mp"] and row["is_b2b"] is None
    assert row["seller_price"] == D("1234.50") and row["currency"] == "RUB"


POSTING = {
    "posting_number": "p-1", "order_id": "7", "order_number": "o-1", "status": "delivering", "created_at": "2026-07-01T00:00:00Z",
    "analytics_data": {"warehouse_id": "5", "is_premium": True, "city": "Минск"}, "legal_info": {"inn": 77}, "cancellation": None,
    "financial_data": {"cluster_from": "A", "products": [
        {"product_id": 9, "old_price": 200, "price": "150", "payout": {"amount": "1,5"}, "actions": ["promo"], "commission": {"amount": 3, "currency": "RUB"}}]},
    "additional_data": ["x"],
    "products": [
        {"sku": "11", "offer_id": " A1 ", "name": "n", "quantity": "2", "price": {"amount": "123,45", "currency": "RUB"}, "digital_codes": ["a", "b"],
         "is_marketplace_buyout": "да"},
        {"sku": 12, "price": "5", "currency_code": "BYN"},
        None,
    ],
}


def test_posting_and_items(spark):
    frame = records(spark, POSTING, {"order_id": 1}, {"posting_number": "empty", "products": {"no": "list"}})
    heads = {r.posting_number: r for r in normalize.postings(frame).collect()}
    assert set(heads) == {"p-1", "empty"}
    head = heads["p-1"]
    assert (head.order_id, head.analytics_warehouse_id, head.analytics_is_premium, head.analytics_is_legal, head.legal_inn) == (7, 5, True, False, "77")
    assert (head.products_count, head.financial_products_count, head.additional_data_count) == (3, 1, 1)
    assert heads["empty"].products_count == 0
    items = normalize.order_items(frame).orderBy("line_number").collect()
    assert [i.line_number for i in items] == [1, 2, 3]
    one, two, three = items
    assert (one.product_sku, one.product_offer_id, one.product_quantity, one.product_price_amount, one.product_price_currency) == (11, "A1", 2, D("123.45"), "RUB")
    assert one.product_digital_codes_count == 2 and one.product_is_marketplace_buyout
    assert (one.financial_old_price, one.financial_price, one.financial_payout, one.financial_actions) == (D("200.00"), D("150.00"), D("1.50"), ["promo"])
    assert (two.product_sku, two.product_price_currency, two.financial_product_id, two.financial_price, two.financial_actions_count) == (12, "BYN", None, D("0.00"), 0)
    assert three.product_sku is None and three.product_quantity == 0


def test_stocks(spark):
    rows = normalize.wb_stocks(
        records(spark, {"nmId": 1, "chrtId": 2, "warehouseId": 3, "quantity": "39", "inWayToClient": "2"}, {"nmId": 1, "chrtId": 0, "warehouseId": 3})
    ).collect()
    assert len(rows) == 1 and (rows[0].quantity, rows[0].in_way_to_client, rows[0].in_way_from_client) == (39, 2, None)
    cluster = normalize.cluster_stocks(
        records(
            spark,
            {"sku": 1, "available_stock_count": 2, "requested_stock_count": 1, "transit_stock_count": 2, "return_from_customer_stock_count": "3",
             "item_tags": [1, 2], "cluster_name": ""},
            {"sku": 1, "available_stock_count": 3, "cluster_name": "East", "ads": "0"},
            {"offer_id": "none"},
        ).withColumn("at", F.monotonically_increasing_id())
    )
    merged = first(merge.merge_stock(cluster, F.col("at")))
    assert merged["available_stock_count"] == 5 and merged["in_way_to_warehouse_count"] == 6 and merged["cluster_name"] == "East"
    assert merged["item_tags_count"] == 2 and merged["merged_rows"] == 2 and merged["cluster_id"] == 0 and merged["ads"] == D("0.0000")
    assert merge.merged_payloads(cluster).count() == 2


def test_products_and_cards(spark):
    info = records(
        spark,
        {"id": 5, "offer_id": " A ", "price": "1 000,5", "primary_image": ["p"], "images": ["a", "p"], "statuses": {"status": "sale"},
         "visibility_details": {"has_price": "true"}, "barcodes": [1, 2]},
        {"product_id": "6", "primary_image": "lead", "images": ["a", "a"]},
        {"name": "none"},
    )
    got = {r.product_id: r for r in normalize.product_info(info).collect()}
    assert set(got) == {5, 6}
    assert (got[5].offer_id, got[5].price, got[5].primary_image, got[5].images_count, got[5].has_price, got[5].status) == ("A", D("1000.50"), "p", 2, True, "sale")
    cards = {r.product_id: r for r in normalize.ozon_cards(info).collect()}
    assert cards["5"].images == ["a", "p"] and cards["5"].article == "A"
    assert cards["6"].images == ["lead", "a"] and cards["6"].article == "6" and cards["6"].primary_image == "lead"
    content = {
        r.nm_id: r
        for r in normalize.wb_cards(
            records(spark, {"nmID": 1, "vendorCode": " v ", "title": "t", "photos": [{"big": "b1"}, {"big": " ", "tm": "t2"}, {"big": "b1"}], "sizes": [{}]},
                    {"nmId": "2", "photos": "x"}, {"title": "none"})
        ).collect()
    }
    assert set(content) == {1, 2}
    assert (content[1].article, content[1].images, content[1].photos_count, content[1].sizes_count, content[1].primary_image) == ("v", ["b1", "t2"], 3, 1, "b1")
    assert content[2].article == "2" and content[2].images == [] and content[2].primary_image is None
    listed = first(normalize.product_list(records(spark, {"product_id": 1, "offer_id": " ", "archived": "yes", "quants": [1]})))
    assert (listed["offer_id"], listed["archived"], listed["has_fbo_stocks"], listed["quants_count"]) == (None, True, False, 1)


def test_erp(spark):
    rows = normalize.erp_products(records(spark, {"id": "1", "article": " a ", "sales_sum": "10,5", "brand_name": " "}, {"article": "  "})).collect()
    assert len(rows) == 1
    assert (rows[0].article, rows[0].sales_sum, rows[0].sales_count, rows[0].avg_price, rows[0].brand_name) == ("a", D("10.50"), 0, None, None)


def test_ad_statistics(spark):
    nm = {"nmId": 5, "sum": 1.235, "views": 2, "clicks": "1"}
    frame = records(
        spark,
        {"advertId": 1, "days": [{"date": "2026-04-14T00:00:00Z", "apps": [{"nm": [nm]}, {"nms": [nm, {"nmId": 0, "sum": 9}]}]}, {"date": None, "apps": [{"nm": [nm]}]}]},
        {"advertId": 0, "days": [{"date": "2026-04-14", "apps": [{"nm": [nm]}]}]},
        {"advertId": 2, "days": [{"date": "2026-04-14", "apps": [{"nm": [{"nmId": 7}]}]}]},
        {"advertId": 3, "days": None},
    )
    daily = ads.ads_daily(normalize.ad_statistics(frame))
    rows = daily.collect()
    assert [(r.advert_id, r.nm_id, r.stat_date, r.spend_rub, r.views, r.clicks) for r in rows] == [(1, 5, date(2026, 4, 14), D("2.47"), 4, 2)]
    period = ads.ads_period(daily, F.lit(date(2026, 4, 1)), F.lit(date(2026, 4, 30))).collect()
    assert [(r.spend_rub, r.report_date) for r in period] == [(D("2.47"), date(2026, 5, 1))]


def test_file_blocks(spark):
    orders = normalize.file_orders(
        maps(spark, {"Дата": "2026-07-01", "Артикул": "0015", "Кол-во": "2", "Сумма": "1 234,50", "Статус": " ok "}, {"Дата": "x", "Артикул": "1"}), "s"
    ).collect()
    assert [(r.article, r.fact_date, r.orders_qty, r.revenue, r.status) for r in orders] == [("15", date(2026, 7, 1), 2, D("1234.50"), "ok")]
    stocks = normalize.file_stocks(maps(spark, {"Артикул": "a", "Остаток": "5"}, {"Артикул": "b", "Остаток, шт": None, "Остаток": "5"}), "s").collect()
    assert {r.article: r.quantity for r in stocks} == {"a": 5, "b": 0}
    inventory = first(normalize.file_inventory(maps(spark, {"Артикул": "021549", "СМП": "3,5"})))
    assert (inventory["article"], inventory["smp_qty"], inventory["ts_qty"]) == ("21549", D("3.500"), D("0.000"))
    storage = normalize.file_storage(maps(spark, {"Артикул": "a", "Платно, л": "1,25", "Дней до первой платности": ""}, {"Артикул": "b", "Дней до первой платности": "3"}))
    assert {r.article: (r.paid_liters, r.days_until_first_paid) for r in storage.collect()} == {"a": (D("1.250"), None), "b": (D("0.000"), 3)}
    stages = first(normalize.file_supply_stages(maps(spark, {"Артикул": "a", "МИНСК": "01.07.2026", "В ПУТИ": "4"})))
    assert (stages["minsk_date"], stages["in_way_qty"]) == (date(2026, 7, 1), 4)
    specs = normalize.file_specs(
        maps(spark, {"Артикул": "a", "LOT": "А-7", "Дата производства": "апрель 2025", "Номер строки": "12"}, {"Артикул": "b", "Спец-ия": "В 8"})
    )
    got = {r.article: r for r in specs.collect()}
    assert (got["a"].specification, got["a"].row["LOT"], got["a"].production_date, got["a"].source_row_number) == ("A7", "A7", date(2025, 4, 1), 12)
    assert got["b"].specification == "B8" and got["b"].production_date is None


def test_costs(spark):
    rows = spark.createDataFrame(
        [(1, "0010031", "w", "2", "10", "20"), (2, "10031", "w", "3", "12", "36"), (3, "x", "w", "0", "", "0"), (4, "y", "w", "1", "7", ""), (5, "y", "w", "1", "9", "")],
        "row_number int, article string, warehouse_name string, quantity string, unit_cost_byn string, total_cost_byn string",
    )
    merged = {r.article: r for r in merge.merge_costs(normalize.file_costs(rows)).collect()}
    assert set(merged) == {"10031", "y"}
    assert (merged["10031"].quantity, merged["10031"].total_cost_byn, merged["10031"].unit_cost_byn) == (5, 56, D("11.2000"))
    assert (merged["y"].quantity, merged["y"].unit_cost_byn) == (2, D("7.0000"))


def test_placement_rows(spark):
    got = normalize.placement_rows(
        maps(spark, {"SKU": "10", "Артикул": "ART", "Название": "Name", "Стоимость размещения": "12,5"}, {"SKU": "", "Артикул": None},
             {"Идентификатор товара": "1,9", "Срок хранения": "x", "Итого": "3"})
    ).collect()
    assert [(r.sku, r.offer_id, r.product_name, r.placement_cost) for r in got] == [(10, "ART", "Name", D("12.50")), (1, None, None, D("3.00"))]


def test_pages_and_campaigns(spark):
    pages = records(spark, {"data": {"currency": "RUB", "orders": [{"id": 1}, 5, {"id": 2}, None]}}, {"data": {"orders": {}}}, run_id="r", page_no=1)
    got = landing.explode_pages(pages, "$.data.orders", {"currency": "$.data.currency"}).orderBy("position").collect()
    assert [(r.position, r.currency, json.loads(r.payload)["id"]) for r in got] == [(0, "RUB", 1), (2, "RUB", 2)]
    campaigns = landing.flatten_campaigns(
        records(spark, {"adverts": [{"status": 9, "type": 8, "advert_list": [{"advertId": 1, "changeTime": "2026-01-01T00:00:00+03:00"}, {"advertId": 0}, {}]},
                                    {"status": 7, "type": 8, "advert_list": None}]}, {"adverts": None})
    ).collect()
    assert [(r.advert_id, r.status, r.type) for r in campaigns] == [(1, 9, 8)]


def test_placement_headers_are_normalized_once(spark):
    rows = normalize.placement_rows(maps(spark, {" Ozon SKU ": "7", "Артикул": " a ", "Название": "", "Итого": "x", "Хранение": "1 2,5"}))
    got = rows.first()
    assert (got.sku, got.offer_id, got.product_name, str(got.placement_cost)) == (7, "a", None, "12.50")
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("lower(") == 1


def test_supply_cells_are_found_once_above_the_scan(spark):
    lines = maps(spark, {"Ваш SKU": "007", "согласование заказа": "1 2", "готов": "x", "Дата Минск": "\u00a0 Март,\u00a01996. "}, {"Артикул": " "}, {"Ваш SKU": "a"})
    stages = normalize.file_supply_stages(normalize.supply_columns(lines.repartition(2)))
    assert [(r.article, r.approved_order_qty, r.ready_qty) for r in stages.collect()] == [("7", 12, 0), ("a", 0, 0)]
    plan = stages._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("element_at(") < 30
    assert "Filter" not in plan[plan.index("Repartition"):]
