"""File reading queries: tables written as text exports or read as rows of cells."""

from __future__ import annotations

from pyspark.sql import functions as F

from tradeloom.bindings import load, load_spread, text
from tradeloom.catalogue import query
from tradeloom.operators import merge, normalize
from tradeloom.session import scratch_path
from tradeloom.sources import files, sheets
from tradeloom.sources.delimited import as_latin1, read_delimited
from tradeloom.sources.landing import explode_pages, in_period, read_api_pages, read_landing

# Words looked for as header names in the conversations.
WORDS = ("user", "the", "a")


def _conversation_rows(spark, sf_dir):
    """Conversations as files: a row per turn, a cell per word."""
    return load(spark, sf_dir, "conversations").select(
        text("conv_id").alias("file"), (F.col("turn") + 1).alias("row_number"), F.split("text", " ").alias("cells")
    )


SQL_HEADER = """
    r AS (SELECT conv_id::VARCHAR AS file, turn + 1 AS row_number, string_split(text, ' ') AS cells FROM conversations),
    w AS (SELECT file, row_number, lower(trim(UNNEST(cells))) AS word FROM r),
    h AS (SELECT file, COALESCE(MIN(row_number) FILTER (WHERE word IN ('user', 'the', 'a')), MIN(row_number)) AS header_row FROM w
          WHERE row_number <= 30 GROUP BY 1)
"""


@query("header_detect", f"WITH {SQL_HEADER} SELECT file, header_row FROM h")
def header_detect(spark, sf_dir):
    return sheets.detect_header(_conversation_rows(spark, sf_dir), WORDS).select("file", "header_row")


@query(
    "header_promote",
    f"""
    WITH {SQL_HEADER},
    names AS (SELECT file, header_row, UNNEST(range(1, len(cells) + 1)) AS pos, trim(UNNEST(cells)) AS name FROM r JOIN h USING (file) WHERE row_number = header_row),
    last_pos AS (SELECT file, header_row, name, MAX(pos) AS pos FROM names GROUP BY 1, 2, 3),
    vals AS (SELECT r.file, r.row_number, l.name, r.cells[l.pos] AS value FROM r JOIN last_pos l ON l.file = r.file AND r.row_number > l.header_row)
    SELECT file, row_number, name, value FROM vals
    WHERE (file, row_number) IN (SELECT (file, row_number) FROM vals WHERE value <> '')
    """,
)
def header_promote(spark, sf_dir):
    rows = _conversation_rows(spark, sf_dir)
    promoted = sheets.promote_header(rows, sheets.detect_header(rows, WORDS))
    return promoted.select("file", "row_number", F.explode("row").alias("name", "value"))


@query(
    "fixed_header",
    """
    WITH r AS (SELECT conv_id::VARCHAR AS file, turn + 1 AS row_number, string_split(text, ' ') AS cells FROM conversations),
    names AS (SELECT file, UNNEST(range(1, len(cells) + 1)) AS pos, trim(UNNEST(cells)) AS name FROM r WHERE row_number = 1),
    last_pos AS (SELECT file, name, MAX(pos) AS pos FROM names GROUP BY 1, 2),
    vals AS (SELECT r.file, r.row_number, l.name, r.cells[l.pos] AS value FROM r JOIN last_pos l USING (file) WHERE r.row_number > 1),
    filled AS (SELECT DISTINCT file, row_number FROM vals WHERE value <> '' AND row_number > 2),
    last_row AS (SELECT file, MAX(row_number) AS m FROM filled GROUP BY 1)
    SELECT f.file, f.row_number FROM filled f JOIN last_row l USING (file) WHERE f.row_number < l.m
    """,
)
def fixed_header(spark, sf_dir):
    return sheets.promote_fixed(_conversation_rows(spark, sf_dir), offset=0, skip=1).select("file", "row_number")


@query(
    "spec_sheets",
    """
    SELECT p_brand AS file, p_partkey + 2 AS row_number, p_partkey::VARCHAR AS article, 'AB' || p_size AS lot, p_name AS manager,
           CASE WHEN p_size % 2 = 0 THEN 'Заполнение-1' ELSE 'Пришло  old' END AS sheet FROM part
    """,
)
def spec_sheets(spark, sf_dir):
    """Parts as specification sheets of a workbook per brand; a third sheet must not be read."""
    part = load(spark, sf_dir, "part")
    sheet = F.when(F.col("p_size") % 2 == 0, "Заполнение-1").otherwise("Пришло  old")
    cells = F.array(text("p_partkey"), F.lit(""), F.concat(F.lit("АВ-"), text("p_size")), F.col("p_name"), F.lit("2026-01-02"))
    rows = part.select(F.col("p_brand").alias("file"), sheet.alias("sheet"), (F.col("p_partkey") + 2).alias("row_number"), cells.alias("cells"))
    other = rows.withColumn("sheet", F.lit("Прочее"))
    header = F.array(*[F.lit(h) for h in ("Ваш SKU", "LOT", "Спец-ия", "Менеджеры", "Месяц производства")])
    heads = rows.select("file", "sheet").distinct().select("file", "sheet", F.lit(1).cast("bigint").alias("row_number"), header.alias("cells"))
    read = sheets.read_spec_sheets(rows.unionByName(other).unionByName(heads))
    specs = normalize.file_specs(read.withColumn("sheet_row", F.col("row")))
    located = read.select("file", "sheet", "row_number", F.col("row")["Артикул"].alias("article"))
    return located.join(specs.select("article", F.col("specification").alias("lot"), F.col("manager_name").alias("manager")), "article")


@query(
    "named_tables",
    """
    WITH r AS (SELECT conv_id::VARCHAR AS file, turn + 1 AS row_number, string_split(text, ' ') AS cells FROM conversations),
    t AS (SELECT DISTINCT file, UNNEST([{'t': 'left', 'r0': 1, 'r1': 4, 'c0': 1, 'c1': 3}, {'t': 'right', 'r0': 2, 'r1': 8, 'c0': 3, 'c1': 9}]) AS b FROM r),
    cell AS (SELECT t.file, b.t AS tab, b.r0 AS r0, r.row_number, UNNEST(range(b.c0, b.c1 + 1)) AS pos, UNNEST(range(1, b.c1 - b.c0 + 2)) AS n, r.cells
             FROM t JOIN r ON r.file = t.file AND r.row_number BETWEEN b.r0 AND b.r1),
    head AS (SELECT file, tab, n, COALESCE(trim(cells[pos]), 'Column' || n) AS name FROM cell WHERE row_number = r0),
    last_n AS (SELECT file, tab, name, MAX(n) AS n FROM head GROUP BY 1, 2, 3),
    vals AS (SELECT c.file, c.tab, c.row_number, l.name, c.cells[c.pos] AS value FROM cell c JOIN last_n l USING (file, tab, n) WHERE c.row_number > c.r0)
    SELECT file, tab AS table_name, row_number, name, value FROM vals
    WHERE (file, tab, row_number) IN (SELECT (file, tab, row_number) FROM vals WHERE value <> '')
    """,
)
def named_tables(spark, sf_dir):
    """Conversations as sheets with two overlapping named tables each."""
    rows = _conversation_rows(spark, sf_dir).withColumn("sheet", F.lit("S"))
    boxes = [("left", 1, 4, 1, 3), ("right", 2, 8, 3, 9)]
    box = F.array(*[F.struct(*[F.lit(v).alias(n) for n, v in zip(("table", "min_row", "max_row", "min_column", "max_column"), b)]) for b in boxes])
    tables = rows.select("file", "sheet").distinct().select("file", "sheet", F.explode(box).alias("b")).select("file", "sheet", "b.*")
    read = sheets.read_named_tables(rows, tables)
    return read.select("file", F.col("table").alias("table_name"), "row_number", F.explode("row").alias("name", "value"))


def _cost_file(spark, sf_dir):
    """Line items as wide cost rows, one file per ship mode flag, with a two-level header."""
    blank = F.lit("")
    top = [blank] * 7 + [F.lit("основной"), blank, blank, F.lit("ДЛЯ МАРКЕТПЛЕЙСОВ"), blank, blank]
    sub = [blank] * 7 + [F.lit("Кол-во"), F.lit("Себест. единицы"), F.lit("Себестоимость")] * 2
    lines = load_spread(spark, sf_dir, "lineitem")
    price = F.regexp_replace(F.format_string("%.2f", F.col("l_extendedprice")), r"\.", ",")
    cells = [
        text("l_orderkey"), F.lit("name"), F.concat(F.lit("00"), text("l_partkey")), text("l_suppkey"), blank, blank, blank,
        text("l_quantity"), blank, price,
        F.when(F.col("l_linestatus") == "O", text("l_linenumber")).otherwise(""), blank, blank,
    ]
    data = lines.select(
        F.col("l_returnflag").alias("file"),
        (F.abs(F.xxhash64("l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice") / 4).cast("bigint") + 6).alias("row_number"),
        F.array(*cells).alias("cells"),
    )
    files = lines.select(F.col("l_returnflag").alias("file")).distinct()
    heads = files.select("file", F.lit(4).cast("bigint").alias("row_number"), F.array(*top).alias("cells"))
    subs = files.select("file", F.lit(5).cast("bigint").alias("row_number"), F.array(*sub).alias("cells"))
    return data.unionByName(heads).unionByName(subs)


@query(
    "two_level_unpivot",
    """
    SELECT l_returnflag AS file, l_partkey::VARCHAR AS article, l_suppkey::VARCHAR AS tnved_code, 'основной' AS warehouse_name, l_quantity::DOUBLE AS quantity,
           l_extendedprice::DECIMAL(14,2)::DOUBLE AS total_cost_byn FROM lineitem
    UNION ALL SELECT l_returnflag, l_partkey::VARCHAR, l_suppkey::VARCHAR, 'ДЛЯ МАРКЕТПЛЕЙСОВ', l_linenumber::DOUBLE, 0 FROM lineitem WHERE l_linestatus = 'O'
    """,
)
def two_level_unpivot(spark, sf_dir):
    costs = normalize.file_costs(sheets.unpivot_two_level(_cost_file(spark, sf_dir)))
    return costs.select(
        "file", "article", "tnved_code", "warehouse_name", F.col("quantity").cast("double").alias("quantity"),
        F.col("total_cost_byn").cast("double").alias("total_cost_byn"),
    )


@query(
    "inventory_from_costs",
    """
    SELECT l_partkey::VARCHAR AS article, SUM(CASE WHEN l_linestatus = 'O' THEN l_linenumber ELSE 0 END)::DOUBLE AS smp_qty, SUM(l_quantity::BIGINT)::DOUBLE AS osn_qty
    FROM lineitem GROUP BY 1
    """,
)
def inventory_from_costs(spark, sf_dir):
    """The cost file read, merged by warehouse and turned into inventory columns."""
    costs = normalize.file_costs(sheets.unpivot_two_level(_cost_file(spark, sf_dir)))
    pivot = merge.pivot_inventory(merge.merge_costs(costs))
    return pivot.select("article", F.col("smp_qty").cast("double").alias("smp_qty"), F.col("osn_qty").cast("double").alias("osn_qty"))


@query(
    "inventory_file",
    """
    SELECT l_partkey::VARCHAR AS article, SUM(l_quantity::BIGINT)::DOUBLE AS smp_qty, SUM(l_linenumber)::DOUBLE AS osn_qty FROM lineitem GROUP BY 1
    """,
)
def inventory_file(spark, sf_dir):
    """Promoted rows under either name of a warehouse."""
    long_name = F.create_map(F.lit("Артикул"), text("l_partkey"), F.lit("ДЛЯ МАРКЕТПЛЕЙСОВ"), text("l_quantity"), F.lit("ОСН"), text("l_linenumber"))
    rows = sheets.inventory_rows(load(spark, sf_dir, "lineitem").select(long_name.alias("row")))
    total = merge.sum_inventory(rows)
    return total.select("article", F.col("smp_qty").cast("double").alias("smp_qty"), F.col("osn_qty").cast("double").alias("osn_qty"))


@query(
    "delimited_text",
    """
    SELECT doc_id, 'товар;' || lang AS label, sha256(regexp_replace(text, '[\\t\\r\\n"]', ' ', 'g')) AS text_sha FROM documents
    """,
)
def delimited_text(spark, sf_dir):
    """Whole documents written as tab-separated text with quoted cells, and read back."""
    body = F.regexp_replace("text", '[\t\r\n"]', " ")
    line = F.concat_ws("\t", text("doc_id"), F.concat(F.lit('"товар;'), "lang", F.lit('"')), F.concat(F.lit('"'), body, F.lit('"')))
    path = scratch_path(spark, "delimited")
    load(spark, sf_dir, "documents").select(line).write.text(path)
    rows = read_delimited(spark, path)
    return rows.select(
        F.col("cells")[0].cast("bigint").alias("doc_id"), F.col("cells")[1].alias("label"), F.sha2(F.col("cells")[2], 256).alias("text_sha")
    )


@query(
    "delimited_quoted",
    """
    SELECT doc_id, lang, 3 AS width,
           sha256(CASE WHEN lang = 'en' THEN regexp_replace(text, '[^\x00-\x7F]', 'я', 'g') ELSE text END
                  || chr(9) || '"в кавычках"' || chr(13) || chr(10) || '";"' || chr(10) || lang) AS body_sha
    FROM documents
    """,
)
def delimited_quoted(spark, sf_dir):
    """Documents as quoted cells with separators, line breaks and quotes inside, English ones in cp1251, and read back."""
    documents = load(spark, sf_dir, "documents")
    latin = F.regexp_replace("text", "[^\\x00-\\x7F]", "я")
    body = F.concat(F.when(F.col("lang") == "en", latin).otherwise(F.col("text")), F.lit('\t"в кавычках"\r\n";"\n'), "lang")
    rows = documents.select(text("doc_id").alias("id"), "lang", body.alias("body"))
    path = scratch_path(spark, "quoted")
    english = rows.where("lang = 'en'").withColumn("body", as_latin1(F.col("body")))  # cp1251 bytes
    for folder, part, encoding in (("one", english, "iso-8859-1"), ("two", rows.where("lang <> 'en'"), "utf-8")):
        part.write.option("sep", "\t").option("quoteAll", True).option("escape", '"').option("encoding", encoding).csv(f"{path}/{folder}")
    read = read_delimited(spark, [f"{path}/one", f"{path}/two"])
    return read.select(
        F.col("cells")[0].cast("bigint").alias("doc_id"), F.col("cells")[1].alias("lang"), F.size("cells").alias("width"),
        F.sha2(F.col("cells")[2], 256).alias("body_sha"),
    )


@query(
    "landed_first_arrival",
    "SELECT conv_id, MIN(turn) AS turn, ARG_MIN(role, turn) AS role, COUNT(*) AS records FROM conversations GROUP BY 1",
)
def landed_first_arrival(spark, sf_dir):
    """Turns landed as JSON lines in turn order, between lines that are no objects; a conversation's first line is its first arrival."""
    turns = load(spark, sf_dir, "conversations").repartition("conv_id").sortWithinPartitions("conv_id", "turn")
    path = scratch_path(spark, "landed")
    record = F.to_json(F.struct("conv_id", "turn", "role", "text"))
    turns.select(F.explode(F.array(F.lit("[]"), record)).alias("value")).write.text(path)
    rows = read_landing(spark, path).select("file", "row_number", F.from_json("payload", "conv_id bigint, turn bigint, role string").alias("r"))
    at = F.struct("file", "row_number")
    return rows.groupBy("r.conv_id").agg(
        F.min_by("r.turn", at).alias("turn"), F.min_by("r.role", at).alias("role"), F.count("*").alias("records")
    )



@query(
    "api_pages_read",
    """
    SELECT user_id, event_id, value FROM events WHERE event_type = 'click' AND ts::DATE BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'
    """,
)
def api_pages_read(spark, sf_dir):
    """Events landed as API pages of at most 100 rows; the pages of one method are read, exploded and cut to a period."""
    events = load(spark, sf_dir, "events")
    item = F.struct("user_id", "event_id", "value", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("at"))
    pages = events.groupBy(F.col("event_type").alias("method"), F.floor(F.col("event_id") / 100).alias("page_no")).agg(F.collect_list(item).alias("rows"))
    landed = pages.select(F.lit("run-1").alias("run_id"), "page_no", "method", F.to_json(F.struct("rows")).alias("payload"))
    path = scratch_path(spark, "pages")
    landed.write.parquet(path)
    read = explode_pages(read_api_pages(spark, path, method="click", run_id="run-1"), "$.rows")
    rows = read.select(F.from_json("payload", "user_id bigint, event_id bigint, value double, at timestamp_ntz").alias("r")).select("r.*")
    day = lambda d: F.lit(d).cast("date")
    return in_period(rows, "at", day("2024-01-05"), day("2024-01-20")).select("user_id", "event_id", "value")


@query(
    "file_digests",
    "SELECT lang AS folder, MAX(sha256(text)) AS newest_sha, SUM(strlen(text))::BIGINT AS bytes, TRUE AS kept FROM (SELECT lang, string_agg(doc_id::VARCHAR, chr(10) ORDER BY doc_id) || chr(10) AS text FROM documents GROUP BY 1) GROUP BY 1",
)
def file_digests(spark, sf_dir):
    """Lists of document ids as one file for each language: digested, kept as originals and found as the newest of their folder."""
    path, out = scratch_path(spark, "digests"), None
    for row in load(spark, sf_dir, "documents").select("lang").distinct().orderBy("lang").collect():
        ids = load(spark, sf_dir, "documents").where(F.col("lang") == row.lang).select("doc_id").repartitionByRange(1, "doc_id")
        ids.sortWithinPartitions("doc_id").select(text("doc_id")).write.text(f"{path}/{row.lang}")
        newest = files.latest_file(spark, f"{path}/{row.lang}", ("*.none", "*.txt"))
        digest = files.file_digests(spark, f"{path}/{row.lang}/*.txt").join(newest.select("path"), "path")
        kept = files.keep_originals(spark, f"{path}/{row.lang}/*.txt", row.lang)
        one = digest.join(kept.select(F.col("file_sha256"), F.col("report_code").alias("folder")), "file_sha256").select(
            "folder", F.col("file_sha256").alias("newest_sha"), F.col("length").alias("bytes"), F.lit(True).alias("kept")
        )
        out = one if out is None else out.unionByName(one)
    return out
