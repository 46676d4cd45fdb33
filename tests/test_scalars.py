from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import functions as F

from tradeloom.functions import audit, dates, images, jsonpath, labels, numbers, text

L = F.lit


def test_numbers(values):
    got = values(
        a=numbers.parse_int_strict(L("123")), b=numbers.parse_int_strict(L("")), c=numbers.parse_int_strict(L("1.9")),
        d=numbers.parse_int_strict(L(" 7 ")), e=numbers.parse_int_lenient(L("1 234,9")), f=numbers.parse_int_lenient(L("-2,7")),
        g=numbers.parse_int_lenient(L("x")), h=numbers.parse_int_lenient_null(L("x")), i=numbers.parse_number(L("1 234,56")),
        j=numbers.parse_number(L("NaN")), k=numbers.parse_number(L("1 234,5")), m=numbers.parse_number(L("1 234,5"), nbsp=True),
        n=numbers.parse_number(L(None).cast("string"), default="0"), o=numbers.price_amount(L('{"amount":"123,45","currency":"RUB"}')),
        p=numbers.price_amount(L("7")), q=numbers.price_currency(L('{"amount":"1","currency":""}'), L("BYN")),
        r=numbers.numeric_cell(L("1e2"), strict=True), s=numbers.numeric_cell(L("12,5"), strict=True),
        t=numbers.report_number(L("1 234,5")), u=numbers.report_number(L("нет")), v=numbers.half_up_int(L(Decimal("2.5"))),
        w=numbers.half_up_int(L(Decimal("-2.5"))), x=numbers.ratio(L(1), L(0)), y=numbers.parse_int_lenient(L("nan")),
        z=numbers.report_number(L(None).cast("string")),
    )
    assert got == dict(
        a=123, b=None, c=None, d=7, e=1234, f=-2, g=0, h=None, i=Decimal("1234.56"), j=None, k=None, m=Decimal("1234.50"), n=Decimal("0.00"),
        o=Decimal("123.45"), p=Decimal("7.00"), q="BYN", r=None, s=Decimal("12.5000"), t=Decimal("1234.50"), u=Decimal("0.00"), v=3, w=-3, x=None,
        y=0, z=Decimal("0.00"),
    )


def test_booleans_and_text(values):
    got = values(
        a=text.parse_bool_null(L("true")), b=text.parse_bool_null(L("0")), c=text.parse_bool_null(L("maybe")),
        d=text.parse_bool_false(L(" ДА ")), e=text.parse_bool_false(L(None).cast("string")), f=text.parse_bool_false(L("2")),
        g=text.clean_article(L(" 0010031 ")), h=text.clean_article(L("000")), i=text.clean_article(L("00A1")),
        j=text.clean_article_number(L(21549.0)), k=text.clean_article_number(L(1.5)), m=text.normalize_lot(L("А-7")),
        n=text.normalize_lot(L("В 8")), o=text.normalize_lot(L("кот ß")), p=text.norm_header(L(" Артикул WB ")),
        q=text.norm_header(L("Ещё"), fold_yo=True), r=text.text_or_null(F.array(L(" "), L(" b "))),
        s=text.article_or_sku(L(""), L(5)), t=text.article_or_sku(L(None).cast("string"), L(None).cast("int")),
        u=text.blank_to_null(L("  ")), v=text.lookup_label(L(None).cast("string"), {"a": "b"}),
    )
    assert got == dict(
        a=True, b=False, c=None, d=True, e=False, f=False, g="10031", h="0", i="00A1", j="21549", k="1.5", m="A7", n="B8", o="KOTSS",
        p="артикул wb", q="еще", r="b", s="5", t="", u=None, v="-",
    )


def test_cell_text(values):
    cases = {
        "617,5": "617.5", "617.50": "617.5", "1 000": "1000", "1 000,00": "1000", "-0,0": "0", "007": "7", "0.10": "0.1", "100": "100",
        " A 1 ": "A 1", "": "", "-12,340": "-12.34", "1,2,3": "1,2,3",
    }
    got = values(**{f"c{i}": text.normalize_cell(L(k)) for i, k in enumerate(cases)})
    assert list(got.values()) == list(cases.values())


def test_dates(values):
    got = values(
        a=dates.parse_date_multi(L("2026-07-01 10:00")), b=dates.parse_date_multi(L("01.07.2026")), c=dates.parse_date_multi(L("1/7/2026")),
        d=dates.parse_date_multi(L("Апрель 2025")), e=dates.parse_date_multi(L("2025, апреля.")), f=dates.parse_date_multi(L("31.02.2026")),
        g=dates.parse_date_multi(L("апрель")), h=dates.parse_date_iso(L("2026-07-22T23:00:00-05:00")), i=dates.parse_date_iso(L("2026-13-01")),
        j=dates.month_start_back(L(date(2026, 8, 2))), k=dates.same_day_last_month(L(date(2026, 3, 31))),
        m=F.unix_seconds(dates.parse_ts(L("2026-08-01T10:00:00+03:00"))), n=F.unix_seconds(dates.parse_ts(L("2026-08-01 10:00"), "+03:00")),
        o=F.unix_seconds(dates.parse_ts(L("2026-08-01T07:00:00.5Z"))), p=dates.parse_ts(L("soon")), q=dates.ensure_offset(L("2026-04-20T10:00:00")),
        r=dates.ensure_offset(L("2026-04-20T10:00:00Z")), s=dates.report_date(L("2026-04-20 x")), t=dates.report_date(L("20.04.2026")),
        u=dates.local_date(L(datetime(2026, 4, 20, 21, 30)), "Europe/Moscow"), v=dates.ensure_offset(L("2026-04-20")),
    )
    seven = 1785567600
    assert got == dict(
        a=date(2026, 7, 1), b=date(2026, 7, 1), c=date(2026, 7, 1), d=date(2025, 4, 1), e=date(2025, 4, 1), f=None, g=None, h=date(2026, 7, 22),
        i=None, j=date(2026, 6, 1), k=date(2026, 2, 28), m=seven, n=seven, o=seven, p=None, q="2026-04-20T10:00:00+03:00",
        r="2026-04-20T10:00:00Z", s=date(2026, 4, 20), t=None, u=date(2026, 4, 21), v="2026-04-20+03:00",
    )


def test_json(values):
    got = values(
        a=jsonpath.canonical_json(L('{"b":1.0, "a":[ 1 ,null]}')), b=jsonpath.canonical_json(L("not json")),
        c=jsonpath.payload_sha(L('{"b":1,"a":2}')) == jsonpath.payload_sha(L('{ "a": 2, "b": 1.0 }')),
        d=jsonpath.json_array(L('{"a":[1,{"b":2}]}'), "$.a"), e=jsonpath.json_array(L('{"a":5}'), "$.a"),
        f=jsonpath.json_array_size(L('{"a":{}}'), "$.a"), g=jsonpath.row_hash(L(1), L("x")) == jsonpath.row_hash(L(2), L("x")),
    )
    assert got == dict(a='{"a":[1,null],"b":1}', b="not json", c=True, d=["1", '{"b":2}'], e=[], f=0, g=False)


def test_images(values):
    got = values(
        a=images.image_url_list(L('["u1","u2",""]')), b=images.image_url_list(L("['u1', 'u2']")), c=images.image_url_list(L(" u1 ")),
        d=images.image_url_list(L("")), e=images.ordered_image_urls(L("u2"), F.array(L("u1"), L("u2"))),
        f=F.slice(images.image_url_candidates(L(168149837)), 1, 4), g=F.size(images.image_url_candidates(L(168149837))),
        h=images.image_url_candidates(L(0)), i=images.shard_of(L(144)), j=images.shard_of(L(99999)), k=images.image_url_list(L("[broken")),
    )
    base = "https://basket-{}.wbbasket.ru/vol1681/part168149/168149837/images/{}/1.webp"
    assert got["a"] == ["u1", "u2"] and got["b"] == ["u1", "u2"] and got["c"] == ["u1"] and got["d"] == [] and got["e"] == ["u2", "u1"]
    assert got["f"] == [base.format("12", "c516x688"), base.format("12", "big"), base.format("12", "tm"), base.format("01", "c516x688")]
    assert got["g"] == 90 and got["h"] == [] and got["i"] == "02" and got["j"] == "16" and got["k"] == ["[broken"]


def test_labels(values):
    got = values(
        a=labels.status_label(L("delivered"), "ozon"), b=labels.status_label(L("odd"), "wb"), c=labels.status_tone(L("Доставлен")),
        d=labels.status_tone(L("awaiting_deliver")), e=labels.status_tone(L("FAILED")), f=labels.status_tone(L(None).cast("string")),
        g=text.lookup_key(L(" Source_Statistics"), labels.JOB_ACTIONS), h=text.lookup_key(L("other"), labels.JOB_ACTIONS),
    )
    assert got == dict(a="Доставлен", b="odd", c="good", d="warn", e="bad", f="info", g="source_files", h=None)


def test_audit(values):
    formula = L("=SUMIFS('Аналитика WB'!A:A;Data!B1;IF(1;2;3))+IMPORTRANGE(\"key1\";\"x\")")
    got = values(
        a=audit.redact_cell(L("my API_KEY=1")), b=audit.redact_cell(L("plain")),
        c=audit.redact_text(L('x = [Authorization="abc", Token: "t1"] Authorization: ' + "z" * 25)),
        d=audit.formula_functions(formula), e=audit.sheet_references(formula), f=audit.import_sources(formula),
        g=audit.classify_column(L("s"), L(" Артикул "), F.array(L("SUM"))), h=audit.classify_column(L("Аналитика WB"), L("x"), F.array(L("SUMIFS"))),
        i=audit.classify_column(L("s"), L("x"), F.array(L("VLOOKUP"))), j=audit.classify_column(L("s"), L("дрр 7"), F.array().cast("array<string>")),
        k=audit.query_marketplace(L("Заказы Ozon")), m=audit.query_subject(L("Заказы Ozon")), n=audit.query_subject(L("x")),
        o=audit.classify_column(L("s"), L("45000"), F.array().cast("array<string>")),
    )
    assert got["a"] == audit.REDACTED and got["b"] == "plain"
    assert got["c"] == 'x = [Authorization="***REDACTED***", Token: "***REDACTED***"] Authorization: ***REDACTED***'
    assert got["d"] == ["IF", "IMPORTRANGE", "SUMIFS"] and got["f"] == ["key1"]
    assert "Аналитика WB" in got["e"]
    assert [got[k] for k in "ghij"] == ["product_identity", "daily_time_series", "lookup_enrichment", "advertising_metrics"]
    assert (got["k"], got["m"], got["n"], got["o"]) == ("ozon", "orders", "other", "daily_time_series")


def test_white_space_of_any_kind_is_stripped(values):
    from pyspark.sql import functions as F

    from tradeloom.functions import numbers, text

    got = values(
        a=text.clean_article(F.lit("00123 ")), b=text.blank_to_null(F.lit("\t \n")), c=numbers.parse_int_strict(F.lit("\t12\n")),
        d=text.parse_bool_null(F.lit(" Yes\r\n")), e=text.norm_header(F.lit("Артикул ")), f=text.normalize_cell(F.lit("\t1,50 ")),
    )
    assert got == {"a": "123", "b": None, "c": 12, "d": True, "e": "артикул", "f": "1.5"}


def test_strip_by_both_ends(values):
    kinds = {f"k{i}": numbers.strip(F.lit(f"{w}a b{w}")) for i, w in enumerate(numbers.WHITE_SPACE)}
    assert set(values(**kinds).values()) == {"a b"}
    assert values(a=numbers.strip(F.lit("x")), b=numbers.strip(F.lit("")), c=numbers.strip(F.lit("é ")), d=numbers.strip(F.lit(None).cast("string"))) == {
        "a": "x", "b": "", "c": "é", "d": None,
    }
    assert "WHEN" in str(numbers.strip(F.col("x"))).upper()


def test_json_integer_tells_text_by_type(values):
    cases = {
        "12": 12, "25.5": 25, "true": 1, "false": 0, "null": None, "[5]": None, '{"a":1}': None, "1e2": 100, "99999999999999999999": None,
        '"12"': 12, '" +7\\t"': 7, '"\\u0001-8\\u007f"': -8, '"\\u20039\\u2003"': 9, '"1.5"': None, '"many"': None, '""': None,
        '"99999999999999999999"': None,
    }
    got = values(**{f"c{i}": numbers.json_integer(F.parse_json(F.lit(j))) for i, j in enumerate(cases)})
    assert list(got.values()) == list(cases.values())


def test_json_integer_casts_no_bad_text():
    assert "schema_of_variant" in str(numbers.json_integer(F.col("v")))
