"""Scalar function queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tradeloom.bindings import load, load_spread, text
from tradeloom.catalogue import query
from tradeloom.functions import dates, images, jsonpath, numbers
from tradeloom.functions import text as texts

SQL_TRANSLATE = "translate(text, 'АВЕКМНОРСТУХавекмнорстух', 'ABEKMHOPCTYXABEKMHOPCTYX')"


@query(
    "lot_and_article",
    f"""
    SELECT doc_id, sha256(regexp_replace(upper(replace({SQL_TRANSLATE}, 'ß', 'ss')), '[^A-Z0-9]', '', 'g')) AS lot_sha,
           length(regexp_replace(upper(replace({SQL_TRANSLATE}, 'ß', 'ss')), '[^A-Z0-9]', '', 'g'))::INT AS lot_length,
           doc_id::VARCHAR AS article, lang AS word_article, doc_id::VARCHAR AS number_article FROM documents
    """,
)
def lot_and_article(spark, sf_dir):
    lot = texts.normalize_lot("text")
    return load(spark, sf_dir, "documents").select(
        "doc_id", F.sha2(lot, 256).alias("lot_sha"), F.length(lot).alias("lot_length"),
        texts.clean_article(F.concat(F.lit(" 000"), text("doc_id"))).alias("article"),
        texts.clean_article(F.concat(F.lit(" "), "lang")).alias("word_article"),
        texts.clean_article_number(F.col("doc_id").cast("double")).alias("number_article"),
    )


@query(
    "numbers_from_text",
    """
    SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey AS strict_int, NULL AS strict_bad, l_quantity::BIGINT AS lenient,
           0::BIGINT AS lenient_bad, NULL AS lenient_null, l_extendedprice::DECIMAL(12,2)::DOUBLE AS number, l_extendedprice::DECIMAL(12,2)::DOUBLE AS amount,
           'BYN' AS currency, 'RUB' AS fallback, CASE WHEN l_returnflag = 'R' THEN NULL ELSE l_tax::DECIMAL(8,2)::DOUBLE END AS cell,
           l_linenumber AS rounded FROM lineitem
    """,
)
def numbers_from_text(spark, sf_dir):
    price = F.format_string("%.2f", F.col("l_extendedprice"))
    spaced = F.regexp_replace(F.regexp_replace(price, r"\.", ","), "^([0-9])", "$1 ")
    as_object = F.concat(F.lit('{"amount":"'), price, F.lit('","currency":"BYN"}'))
    return load_spread(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_suppkey",
        numbers.parse_int_strict(F.concat(F.lit(" "), text("l_partkey"))).alias("strict_int"),
        numbers.parse_int_strict(price).alias("strict_bad"),
        numbers.parse_int_lenient(F.concat(F.lit("0 "), text("l_quantity").substr(1, 2), F.lit(",9"))).alias("lenient_raw"),
        numbers.parse_int_lenient("l_returnflag").alias("lenient_bad"),
        numbers.parse_int_lenient_null("l_returnflag").alias("lenient_null"),
        numbers.parse_number(spaced, nbsp=True).cast("double").alias("number"),
        numbers.price_amount(as_object).cast("double").alias("amount"),
        numbers.price_currency(as_object, F.lit("RUB")).alias("currency"),
        numbers.price_currency(price, F.lit("RUB")).alias("fallback"),
        numbers.numeric_cell(
            F.when(F.col("l_returnflag") == "R", "1 0.5x").otherwise(F.format_string("%.2f", F.col("l_tax"))), strict=True
        ).cast("double").alias("cell"),
        numbers.half_up_int((F.col("l_linenumber") - F.lit(0.5)).cast("decimal(10,2)")).alias("rounded"), "l_quantity",
    ).withColumn("lenient", F.when(F.col("l_quantity") < 10, F.col("l_quantity").cast("bigint")).otherwise(F.col("lenient_raw"))).drop(
        "lenient_raw", "l_quantity"
    )


@query(
    "booleans_from_text",
    """
    SELECT event_id, CASE event_type WHEN 'view' THEN TRUE WHEN 'click' THEN FALSE END AS nullable, event_type IN ('view', 'purchase') AS strict FROM events
    """,
)
def booleans_from_text(spark, sf_dir):
    kind = F.col("event_type")
    word = F.when(kind == "view", " YES").when(kind == "click", "0").when(kind == "purchase", "Да").when(kind == "error", "maybe")
    return load(spark, sf_dir, "events").select(
        "event_id", texts.parse_bool_null(word).alias("nullable"), texts.parse_bool_false(word).alias("strict")
    )


@query(
    "dates_multi",
    """
    SELECT o_orderkey, o_orderdate::DATE AS iso, o_orderdate::DATE AS dotted, o_orderdate::DATE AS slashed, o_orderdate::DATE AS offset_date,
           date_trunc('month', o_orderdate)::DATE AS month_name, NULL AS bad, epoch(o_orderdate)::BIGINT - 10800 AS moscow,
           epoch(o_orderdate)::BIGINT AS naive_utc, (date_trunc('month', o_orderdate) - INTERVAL 2 MONTH)::DATE AS two_back,
           (o_orderdate - INTERVAL 1 MONTH)::DATE AS last_month, o_orderdate::DATE AS minsk_day FROM orders
    """,
)
def dates_multi(spark, sf_dir):
    day = F.to_date("o_orderdate")
    names = ("января", "февраль", "марта", "апрель", "мая", "июнь", "июля", "август", "сентября", "октябрь", "ноября", "декабрь")
    month = F.element_at(F.array(*[F.lit(n) for n in names]), F.month(day))
    iso = F.date_format(day, "yyyy-MM-dd")
    return load(spark, sf_dir, "orders").select(
        "o_orderkey", dates.parse_date_multi(F.concat(iso, F.lit(" 10:00"))).alias("iso"),
        dates.parse_date_multi(F.date_format(day, "d.M.yyyy")).alias("dotted"),
        dates.parse_date_multi(F.date_format(day, "dd/MM/yyyy")).alias("slashed"),
        dates.parse_date_iso(F.concat(iso, F.lit("T23:30:00-05:00"))).alias("offset_date"),
        dates.parse_date_multi(F.concat(F.year(day), F.lit(", "), F.upper(month), F.lit("."))).alias("month_name"),
        dates.parse_date_multi(F.concat(F.lit("32.13."), F.year(day))).alias("bad"),
        F.unix_seconds(dates.parse_ts(F.concat(iso, F.lit(" 00:00")), "+03:00")).alias("moscow"),
        F.unix_seconds(dates.parse_ts(iso)).alias("naive_utc"),
        dates.month_start_back(day).alias("two_back"), dates.same_day_last_month(day).alias("last_month"),
        dates.local_date(F.col("o_orderdate").cast("timestamp"), "+03:00").alias("minsk_day"),
    )


@query(
    "white_space_kinds",
    """
    SELECT l_orderkey, l_linenumber, l_suppkey, l_extendedprice, l_partkey::VARCHAR AS article, l_partkey AS number, l_returnflag = 'R' AS flag,
           'x ' || l_partkey AS header, l_partkey::VARCHAR AS cell, 'x ' || l_partkey || ' y' AS trimmed FROM lineitem
    """,
)
def white_space_kinds(spark, sf_dir):
    """Line items as text with every kind of white space at both ends."""
    kinds = F.array(*[F.lit(c) for c in numbers.WHITE_SPACE])
    at = F.xxhash64("l_orderkey", "l_linenumber", "l_suppkey")
    first, last = (F.get(kinds, F.pmod(F.shiftright(at, n), F.lit(len(numbers.WHITE_SPACE))).cast("int")) for n in (0, 20))
    around = lambda *parts: F.concat(first, *parts, last, first)
    part = text("l_partkey")
    return load(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice", texts.clean_article(around(F.lit("00"), part)).alias("article"),
        numbers.parse_int_strict(around(part)).alias("number"),
        texts.parse_bool_false(around(F.when(F.col("l_returnflag") == "R", "Yes").otherwise("no"))).alias("flag"),
        texts.norm_header(around(F.lit("X\u00a0"), part), fold_yo=True).alias("header"), texts.normalize_cell(around(part, F.lit(".0"))).alias("cell"),
        texts.blank_to_null(around(F.lit("x "), part, F.lit(" y"))).alias("trimmed"),
    )


@query(
    "cursor_times",
    """
    SELECT event_id, epoch(date_trunc('second', ts))::BIGINT - 600 AS back, epoch(date_trunc('second', ts))::BIGINT - 259200 AS first_run,
           epoch(date_trunc('year', ts))::BIGINT AS year_start, strftime(ts, '%Y-%m-%dT%H:%M:%S') || '+03:00' AS with_offset FROM events
    """,
)
def cursor_times(spark, sf_dir):
    at = F.col("ts").cast("timestamp")
    return load(spark, sf_dir, "events").select(
        "event_id", F.unix_seconds(dates.minus_minutes(at, 10)).alias("back"), F.unix_seconds(dates.first_run_cursor(at, 3)).alias("first_run"),
        F.unix_seconds(dates.year_start(at)).alias("year_start"),
        dates.ensure_offset(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")).alias("with_offset"),
    )


@query(
    "json_path_extract",
    """
    SELECT event_id, json_extract_string(props, '$.k')::INT AS k, 2 AS tags, event_type || '|x' AS tag_list, 0 AS missing FROM events
    """,
)
def json_path_extract(spark, sf_dir):
    tagged = F.concat(F.lit('{"t":["'), "event_type", F.lit('","x"],"p":'), "props", F.lit("}"))
    return load(spark, sf_dir, "events").select(
        "event_id", jsonpath.json_text(tagged, "$.p.k").cast("int").alias("k"), jsonpath.json_array_size(tagged, "$.t").alias("tags"),
        F.array_join(jsonpath.json_array(tagged, "$.t"), "|").alias("tag_list"), jsonpath.json_array_size(tagged, "$.p").alias("missing"),
    )


@query(
    "image_candidates",
    """
    WITH p AS (SELECT p_partkey, p_partkey * 17003 AS card FROM part),
    v AS (SELECT *, card // 100000 AS vol, card // 1000 AS part_no FROM p),
    s AS (SELECT *, lpad((CASE WHEN vol <= 143 THEN 1 WHEN vol <= 287 THEN 2 WHEN vol <= 431 THEN 3 WHEN vol <= 719 THEN 4 WHEN vol <= 1007 THEN 5
                 WHEN vol <= 1061 THEN 6 WHEN vol <= 1115 THEN 7 WHEN vol <= 1169 THEN 8 WHEN vol <= 1313 THEN 9 WHEN vol <= 1601 THEN 10
                 WHEN vol <= 1655 THEN 11 WHEN vol <= 1919 THEN 12 WHEN vol <= 2045 THEN 13 WHEN vol <= 2189 THEN 14 WHEN vol <= 2405 THEN 15
                 ELSE 16 END)::VARCHAR, 2, '0') AS shard FROM v),
    c AS (SELECT s.*, b.n, CASE WHEN b.n = 0 THEN shard ELSE lpad(b.n::VARCHAR, 2, '0') END AS basket, z.size, z.o
          FROM s, (SELECT UNNEST(range(0, 31)) AS n) b, (VALUES ('c516x688', 0), ('big', 1), ('tm', 2)) z(size, o)),
    d AS (SELECT * FROM c WHERE n = 0 OR basket <> shard)
    SELECT p_partkey, string_agg('https://basket-' || basket || '.wbbasket.ru/vol' || vol || '/part' || part_no || '/' || card || '/images/' || size || '/1.webp',
                                 ' ' ORDER BY n, o) AS urls FROM d WHERE card > 0 GROUP BY 1
    UNION ALL SELECT p_partkey, '' FROM p WHERE card <= 0
    """,
)
def image_candidates(spark, sf_dir):
    urls = images.image_url_candidates(F.col("p_partkey") * 17003)
    return load(spark, sf_dir, "part").select("p_partkey", F.array_join(urls, " ").alias("urls"))


@query(
    "image_lists",
    """
    SELECT p_partkey, p_brand || '|' || p_type AS from_json, p_brand || '|' || p_type AS from_literal, p_name AS single, '' AS empty,
           p_type || '|' || p_brand AS ordered FROM part
    """,
)
def image_lists(spark, sf_dir):
    def joined(column):
        return F.array_join(column, "|")

    as_json = F.to_json(F.array("p_brand", "p_type"))
    literal = F.concat(F.lit("['"), "p_brand", F.lit("', '"), "p_type", F.lit("', None, '']"))
    return load(spark, sf_dir, "part").select(
        "p_partkey", joined(images.image_url_list(as_json)).alias("from_json"),
        joined(images.image_url_list(F.regexp_replace(literal, "None", "''"))).alias("from_literal"),
        joined(images.image_url_list(F.concat(F.lit(" "), "p_name"))).alias("single"), joined(images.image_url_list(F.lit(""))).alias("empty"),
        joined(images.ordered_image_urls("p_type", images.image_url_list(as_json))).alias("ordered"),
    )


@query(
    "cell_text",
    """
    SELECT l_orderkey, l_linenumber, l_suppkey, l_extendedprice, l_quantity::BIGINT::VARCHAR AS whole, l_returnflag || ' x' AS word,
           CASE WHEN l_tax = 0 THEN '0' ELSE '-' || rtrim(l_tax::DECIMAL(8,2)::VARCHAR, '0') END AS fraction, 'артикул е' AS header FROM lineitem
    """,
)
def cell_text(spark, sf_dir):
    tax = F.concat(F.lit("- 00"), F.regexp_replace(F.format_string("%.2f", F.col("l_tax")), r"\.", ","), F.lit("00"))
    return load(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice", texts.normalize_cell(F.concat(F.lit("0"), text("l_quantity"))).alias("whole"),
        texts.normalize_cell(F.concat(F.lit(" "), "l_returnflag", F.lit(" x "))).alias("word"), texts.normalize_cell(tax).alias("fraction"),
        texts.norm_header(F.lit(" Артикул Ё "), fold_yo=True).alias("header"),
    )


@query(
    "text_choice",
    """
    SELECT doc_id, lang AS first_text, source AS article, doc_id::VARCHAR AS sku, NULL AS blank FROM documents
    """,
)
def text_choice(spark, sf_dir):
    return load(spark, sf_dir, "documents").select(
        "doc_id", texts.text_or_null(F.array(F.lit(" "), F.lit(None).cast("string"), F.concat(F.lit(" "), "lang"), "text")).alias("first_text"),
        texts.article_or_sku("source", "doc_id").alias("article"), texts.article_or_sku(F.lit(""), "doc_id").alias("sku"),
        texts.blank_to_null(F.lit("  ")).alias("blank"),
    )
