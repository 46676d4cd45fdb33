"""Audit queries over whole texts and over formulas made from the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tradeloom.bindings import load, text
from tradeloom.catalogue import query
from tradeloom.functions import audit
from tradeloom.operators import quality

SQL_SECRET = "regexp_matches(lower(text), 'token|password|secret|api_key|apikey|authorization|private_key')"


@query(
    "redact_cells",
    f"SELECT source, lang, COUNT(*)::BIGINT AS cells, COUNT(*) FILTER (WHERE {SQL_SECRET})::BIGINT AS redacted_cells FROM documents GROUP BY 1, 2",
)
def redact_cells(spark, sf_dir):
    return quality.secret_cells(load(spark, sf_dir, "documents"), "text", ["source", "lang"])


@query(
    "redact_values",
    f"SELECT doc_id, CASE WHEN {SQL_SECRET} THEN '***REDACTED***' ELSE text END AS text FROM documents",
)
def redact_values(spark, sf_dir):
    return load(spark, sf_dir, "documents").select("doc_id", audit.redact_cell("text").alias("text"))


@query(
    "redact_text",
    r"""
    WITH a AS (SELECT doc_id, text || ' password="' || doc_id || '" Authorization: ' || repeat('x', 20 + doc_id % 7) || ' end' AS t FROM documents),
    b AS (SELECT doc_id, regexp_replace(t, '(Authorization\s*=\s*")[^"]+(")', '\1***REDACTED***\2', 'gi') AS t FROM a),
    c AS (SELECT doc_id, regexp_replace(t, '("?(?:token|api[_-]?key|password|secret)"?\s*[:=]\s*")[^"]+(")', '\1***REDACTED***\2', 'gi') AS t FROM b),
    d AS (SELECT doc_id, regexp_replace(t, '(Authorization\s*:\s*)[A-Za-z0-9_.=-]{20,}', '\1***REDACTED***', 'gi') AS t FROM c)
    SELECT doc_id, regexp_replace(t, 'eyJ[A-Za-z0-9_-]{20,}\.[A-Za-z0-9_-]{20,}\.[A-Za-z0-9_-]{20,}', '***REDACTED***', 'g') AS text FROM d
    """,
)
def redact_text(spark, sf_dir):
    """Whole document texts, each with two more secrets at its end."""
    secrets = F.concat(
        F.lit(' password="'), text("doc_id"), F.lit('" Authorization: '), F.repeat(F.lit("x"), (F.col("doc_id") % 7 + 20).cast("int")), F.lit(" end")
    )
    return load(spark, sf_dir, "documents").select("doc_id", audit.redact_text(F.concat("text", secrets)).alias("text"))


def _formula_cells(spark, sf_dir):
    """Parts as the formula column of a sheet per brand, under the header of the brand."""
    formula = F.concat(
        F.lit("=IF(SUM('"), "p_type", F.lit("'!A1)>0;"), F.when(F.col("p_size") > 25, "xlookup(").otherwise("ROUND("), F.lit("B1);IMPORTRANGE(\""),
        "p_name", F.lit("\";Data!C2))"),
    )
    part = load(spark, sf_dir, "part")
    value = F.when(F.col("p_size") > 5, formula).otherwise(F.col("p_name"))
    rows = part.select(
        F.col("p_brand").alias("sheet"), (F.col("p_partkey") + 2).alias("row_number"), (F.col("p_size") % 3 + 1).alias("column_number"), value.alias("value")
    )
    header = F.element_at(F.array(F.lit("Артикул"), F.lit("token id"), F.lit("45000")), F.col("c"))
    heads = part.select(F.col("p_brand").alias("sheet")).distinct().select(
        "sheet", F.lit(1).cast("bigint").alias("row_number"), F.explode(F.sequence(F.lit(1), F.lit(3))).alias("c")
    )
    heads = heads.select("sheet", "row_number", F.col("c").alias("column_number"), header.alias("value"))
    return rows.unionByName(heads)


SQL_FORMULAS = """
    f AS (SELECT p_brand AS sheet, p_size % 3 + 1 AS column_number, p_size, p_type, p_name FROM part WHERE p_size > 5)
"""


@query(
    "formula_columns",
    f"""
    WITH {SQL_FORMULAS}
    SELECT sheet, column_number, COUNT(*)::BIGINT AS formula_count,
           CASE column_number WHEN 1 THEN 'Артикул' WHEN 2 THEN '***REDACTED***' ELSE '45000' END AS header,
           CASE column_number WHEN 1 THEN 'product_identity' WHEN 2 THEN 'external_sheet_lookup' ELSE 'daily_time_series' END AS category
    FROM f GROUP BY 1, 2
    """,
)
def formula_columns(spark, sf_dir):
    return quality.formula_profile(_formula_cells(spark, sf_dir))["columns"].select("sheet", "column_number", "formula_count", "header", "category")


@query(
    "formula_functions",
    f"""
    WITH {SQL_FORMULAS}, u AS (SELECT sheet, column_number, UNNEST(['IF', 'SUM', 'IMPORTRANGE', CASE WHEN p_size > 25 THEN 'XLOOKUP' ELSE 'ROUND' END]) AS function FROM f)
    SELECT sheet, column_number, function, COUNT(*)::BIGINT AS uses FROM u GROUP BY 1, 2, 3
    """,
)
def formula_functions(spark, sf_dir):
    return quality.formula_profile(_formula_cells(spark, sf_dir))["functions"].drop("rank")


@query(
    "formula_references",
    f"""
    WITH {SQL_FORMULAS}, u AS (SELECT sheet, column_number, UNNEST([p_type, 'Data']) AS reference FROM f),
    g AS (SELECT sheet, column_number, reference, COUNT(*)::BIGINT AS uses FROM u GROUP BY 1, 2, 3)
    SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY sheet, column_number ORDER BY uses DESC, reference) AS rank FROM g) WHERE rank <= 10
    """,
)
def formula_references(spark, sf_dir):
    return quality.formula_profile(_formula_cells(spark, sf_dir))["references"]


@query(
    "logic_categories",
    f"""
    WITH {SQL_FORMULAS}, c AS (SELECT DISTINCT sheet, column_number FROM f)
    SELECT CASE column_number WHEN 1 THEN 'product_identity' WHEN 2 THEN 'external_sheet_lookup' ELSE 'daily_time_series' END AS category, COUNT(*)::BIGINT AS columns
    FROM c GROUP BY 1
    """,
)
def logic_categories(spark, sf_dir):
    return quality.formula_profile(_formula_cells(spark, sf_dir))["categories"]


@query(
    "import_sources",
    "SELECT p_partkey, p_name AS sources FROM part",
)
def import_sources(spark, sf_dir):
    formula = F.concat(F.lit('=importrange("'), "p_name", F.lit('";A1)+IMPORTRANGE("'), "p_name", F.lit('",B1)'))
    return load(spark, sf_dir, "part").select("p_partkey", F.array_join(audit.import_sources(formula), "|").alias("sources"))


@query(
    "query_names",
    """
    SELECT p_partkey, CASE WHEN p_size > 40 THEN 'wb' WHEN p_size > 30 THEN 'ozon' WHEN p_size > 20 THEN 'yandex_market' ELSE 'internal' END AS marketplace,
           CASE WHEN p_size > 25 THEN 'orders' WHEN p_size > 15 THEN 'stocks' WHEN p_size > 5 THEN 'storage_costs' ELSE 'other' END AS subject FROM part
    """,
)
def query_names(spark, sf_dir):
    size = F.col("p_size")
    place = F.when(size > 40, "WB_").when(size > 30, "Ozon ").when(size > 20, "YM-").otherwise("1C ")
    topic = F.when(size > 25, "Заказы").when(size > 15, "остатки").when(size > 5, "Хранение").otherwise("прочее")
    name = F.concat(place, topic, text("p_partkey"))
    return load(spark, sf_dir, "part").select(
        "p_partkey", audit.query_marketplace(name).alias("marketplace"), audit.query_subject(name).alias("subject")
    )


@query(
    "file_profile_sizes",
    "SELECT conv_id::VARCHAR AS file, MAX(turn + 1)::BIGINT AS rows, MAX(CASE WHEN turn = 0 THEN 3 END)::INT AS columns FROM conversations GROUP BY 1",
)
def file_profile_sizes(spark, sf_dir):
    return quality.file_profile(_conversation_cells(spark, sf_dir))[0]


@query(
    "file_profile_sample",
    """
    WITH c AS (SELECT conv_id, turn, UNNEST([1, 2, 3]) AS column_number, UNNEST([turn::VARCHAR, role, text]) AS value FROM conversations WHERE turn <= 5)
    SELECT conv_id::VARCHAR AS file, (turn + 1)::BIGINT AS row_number, column_number,
           CASE WHEN regexp_matches(lower(value), 'token|password|secret|api_key|apikey|authorization|private_key') THEN '***REDACTED***' ELSE value END AS value FROM c
    """,
)
def file_profile_sample(spark, sf_dir):
    return quality.file_profile(_conversation_cells(spark, sf_dir))[1]


def _conversation_cells(spark, sf_dir):
    """Conversations as files of three columns."""
    rows = load(spark, sf_dir, "conversations").select(
        text("conv_id").alias("file"), (F.col("turn") + 1).alias("row_number"), F.posexplode(F.array(text("turn"), "role", "text")).alias("p", "value")
    )
    return rows.select("file", "row_number", (F.col("p") + 1).alias("column_number"), "value")
