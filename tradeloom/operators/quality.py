"""Run log rows, domain rules, profiles and audits."""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeloom.functions.audit import (
    classify_column,
    formula_functions,
    is_formula,
    is_secret,
    redact_cell,
    sheet_references,
)
from tradeloom.operators.keyed import first_per_key

# Allowed values of the checked columns.
MARKETPLACES = ("wb", "ozon")
STATUS_LIGHTS = ("green", "yellow", "red", "gray")
API_STATUSES = ("ok", "error")


def domain_violations(df: DataFrame, rules: dict[str, Column], key: Sequence[str]) -> DataFrame:
    """One row per broken rule and record; a rule that evaluates to null holds."""
    broken = F.array_compact(
        F.array(*[F.when(~F.coalesce(test, F.lit(True)), F.lit(name)) for name, test in rules.items()])
    )
    return df.withColumn("__broken", broken).select(*key, F.explode("__broken").alias("rule"))


def one_snapshot_time(pages: DataFrame, run: str = "run_id", time: str = "snapshot_time") -> DataFrame:
    """Runs whose pages do not all share one snapshot time."""
    return (
        pages.groupBy(run)
        .agg(F.min(time).alias("first_time"), F.max(time).alias("last_time"))
        .where(~F.col("first_time").eqNullSafe(F.col("last_time")))
    )


def run_log_row(
    counts: DataFrame, job_name: str, run_id: str, status: str, started_at: Column, finished_at: Column,
    error: str | None = None,
) -> DataFrame:
    """The run-log row of one run from its one-row counters.

    Cursors that the counters lack are null.
    """
    cursors = [
        (F.col(c) if c in counts.columns else F.lit(None)).cast("timestamp").alias(c) for c in ("cursor_old", "cursor_used", "cursor_new")
    ]
    duplicates = F.col("deduped") - F.col("raw_new")
    share = F.when(
        F.col("api_rows") > 0,
        F.floor((duplicates * 20000 + F.col("api_rows")) / (F.col("api_rows") * 2)) / 100,
    ).otherwise(F.lit(0.0))
    return counts.select(
        F.lit(job_name).alias("job_name"), F.lit(run_id).alias("run_id"),
        started_at.alias("started_at"), finished_at.alias("finished_at"), F.lit(status).alias("status"),
        "api_rows", "raw_new", "norm_upserted", duplicates.alias("duplicates"),
        share.cast("double").alias("dup_pct"), *cursors, F.lit(error).cast("string").alias("error"),
    )


def last_dup_pct(runs: DataFrame, job_name: str) -> DataFrame:
    """Duplicate share of the newest successful run of a job."""
    done = runs.where((F.col("job_name") == job_name) & (F.col("status") == "ok") & F.col("dup_pct").isNotNull())
    return done.orderBy(F.col("started_at").desc(), F.col("run_id").desc()).limit(1).select("dup_pct")


def missing_tables(present: Sequence[str], required: Sequence[str]) -> list[str]:
    return sorted(set(required) - set(present))


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count per table."""
    frames = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame)
    return result


def column_profile(df: DataFrame) -> DataFrame:
    """Per column: values, nulls, distinct values, shortest and longest text.

    Distinct values are counted in two steps, so a common value is one row per task, and
    long texts travel as their digest.
    """
    texts = df.select(
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value"))
                    for c in df.columns
                ]
            )
        ).alias("cell")
    ).select("cell.*")
    length = F.length("value")
    short = F.when(length > 64, F.sha2("value", 256)).otherwise(F.col("value"))
    per_value = texts.groupBy("column_name", short.alias("value"), length.alias("length")).agg(
        F.count(F.lit(1)).alias("n")
    )
    return per_value.groupBy("column_name").agg(
        F.sum("n").cast("bigint").alias("row_count"),
        F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0)).cast("bigint").alias("null_count"),
        F.count("value").alias("distinct_count"),
        F.min("length").alias("min_length"),
        F.max("length").alias("max_length"),
    )


def secret_cells(df: DataFrame, text: str, by: Sequence[str]) -> DataFrame:
    """Cells and masked cells per group."""
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("cells"), F.count_if(is_secret(F.col(text))).alias("redacted_cells")
    )


def file_profile(cells: DataFrame, sample_rows: int = 5) -> tuple[DataFrame, DataFrame]:
    """Rows and columns per file, and its masked header and first rows as cells.

    ``cells`` is (file, row_number, column_number, value), row 1 being the header.
    """
    size = cells.groupBy("file").agg(
        F.max("row_number").alias("rows"),
        F.max(F.when(F.col("row_number") == 1, F.col("column_number"))).alias("columns"),
    )
    sample = cells.where(F.col("row_number") <= sample_rows + 1).withColumn("value", redact_cell("value"))
    return size, sample


DELIMITERS = (",", ";", "\t")


def file_shapes(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, encoding, delimiter) of text exports.

    A file is ``utf-8-sig`` (which reads plain UTF-8 too) if all its lines are valid UTF-8,
    else ``cp1251``; no character goes over a line end, so lines are tested apart in any
    number of tasks. The delimiter is the one whose number outside quotes is the same, and
    not 0, in most lines; of equally steady ones the more frequent, then the first of
    ``,``, ``;`` and tab. Null if none occurs.
    """
    raw = spark.read.text(path, lineSep="\n").select(F.col("_metadata.file_path").alias("file"), F.col("value").cast("binary").alias("raw"))
    latin = F.decode("raw", "ISO-8859-1")
    outside = F.array_join(F.filter(F.split(latin, '"'), lambda _, i: i % 2 == 0), "")
    signs = F.array(*[
        F.struct(F.lit(i).alias("rank"), (F.length(outside) - F.length(F.translate(outside, d, ""))).alias("n")) for i, d in enumerate(DELIMITERS)
    ])
    lines = raw.select("file", F.is_valid_utf8(F.col("raw").cast("string")).alias("valid"), F.explode(signs).alias("s"))
    counts = lines.groupBy("file", "s.rank", "s.n").agg(F.count(F.lit(1)).alias("lines"), F.bool_and("valid").alias("valid"))
    usual = F.max(F.when(F.col("n") > 0, F.struct(F.col("lines"), F.col("n"), -F.col("rank")))).alias("usual")
    found = counts.groupBy("file").agg(F.bool_and("valid").alias("valid"), usual)
    names = F.array(*[F.lit(d) for d in DELIMITERS])
    return found.select(
        "file", F.when(F.col("valid"), "utf-8-sig").otherwise("cp1251").alias("encoding"), F.get(names, -F.col("usual.col3")).alias("delimiter")
    )


def profile_files(spark: SparkSession, path: str | list[str], sample_rows: int = 5) -> DataFrame:
    """(file, encoding, delimiter, rows, columns, headers, sample_rows) of text exports, header and sample masked.

    The delimiters, one row a file, are looked up first; files of one delimiter are read together.
    """
    from tradeloom.sources.delimited import read_delimited

    shapes = file_shapes(spark, path).cache()
    by_delimiter: dict[str, list[str]] = {}
    for row in shapes.select("file", "delimiter").collect():
        by_delimiter.setdefault(row.delimiter or DELIMITERS[0], []).append(unquote(row.file))
    profiles = None
    for delimiter, files in by_delimiter.items():
        rows = read_delimited(spark, files, sep=delimiter)
        masked = F.transform("cells", redact_cell)
        head = F.when(F.col("row_number") <= sample_rows + 1, F.struct("row_number", masked.alias("cells")))
        part = rows.groupBy("file").agg(
            F.max("row_number").alias("rows"), F.max(F.when(F.col("row_number") == 1, F.size("cells"))).alias("columns"),
            F.array_sort(F.collect_list(head)).alias("head"),  # at most sample_rows + 1
        )
        profiles = part if profiles is None else profiles.unionByName(part)
    if profiles is None:
        profiles = shapes.select("file", F.lit(0).cast("bigint").alias("rows"), F.lit(0).alias("columns")).withColumn(
            "head", F.array().cast("array<struct<row_number:bigint,cells:array<string>>>")
        )
    return shapes.join(profiles, "file").select(
        "file", "encoding", "delimiter", "rows", "columns", F.get("head", F.lit(0))["cells"].alias("headers"),
        F.transform(F.slice("head", 2, sample_rows), lambda h: h["cells"]).alias("sample_rows"),
    )


def top_values(df: DataFrame, by: Sequence[str], value: str, k: int = 10) -> DataFrame:
    """The k most frequent values per group, ties by value."""
    from pyspark.sql import Window

    counts = df.groupBy(*by, value).agg(F.count(F.lit(1)).alias("uses"))
    order = Window.partitionBy(*by).orderBy(F.col("uses").desc(), F.col(value))
    return counts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def formula_profile(cells: DataFrame) -> dict[str, DataFrame]:
    """Formulas per column of a sheet: totals, top functions, top references, logic class.

    ``cells`` is (sheet, row_number, column_number, value), row 1 being the header.
    """
    column = ["sheet", "column_number"]
    header = cells.where(F.col("row_number") == 1).select(*column, redact_cell("value").alias("header"))
    formulas = cells.where((F.col("row_number") > 1) & is_formula("value"))
    totals = formulas.groupBy(*column).agg(F.count(F.lit(1)).alias("formula_count"))
    totals = totals.join(header, column, "left")
    functions = top_values(
        formulas.select(*column, F.explode(formula_functions("value")).alias("function")), column, "function"
    )
    references = top_values(
        formulas.select(*column, F.explode(sheet_references("value")).alias("reference")), column, "reference"
    )
    used = functions.groupBy(*column).agg(F.collect_set("function").alias("functions"))  # at most ten
    classes = totals.join(used, column, "left").withColumn(
        "category", classify_column("sheet", "header", F.col("functions"))
    )
    by_category = classes.groupBy("category").agg(F.count(F.lit(1)).alias("columns"))
    return {"columns": classes, "functions": functions, "references": references, "categories": by_category}


def export_warnings(summary: DataFrame, report_date: Column | None = None, expected: Column | None = None) -> DataFrame:
    """Warning columns of a publish: rows added, stale rows, outdated report."""
    outdated = F.lit(False)
    if report_date is not None and expected is not None:
        outdated = F.coalesce(report_date < expected, F.lit(False))
    return summary.select(
        "*", (F.col("appended_rows") > 0).alias("rows_added"), (F.col("stale_rows") > 0).alias("rows_stale"),
        outdated.alias("report_outdated"),
    )


def newest_sources(snapshots: DataFrame, keys: Sequence[str]) -> DataFrame:
    return first_per_key(snapshots, keys, [F.col("loaded_at").desc(), F.col("id").desc()])


def card_metrics(cards: DataFrame) -> DataFrame:
    """Cards, cards with a photo, and distinct articles."""
    per_article = cards.groupBy("article").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("images_count") > 0).alias("with_photo")
    )
    return per_article.agg(
        F.sum("n").cast("bigint").alias("cards"),
        F.sum("with_photo").cast("bigint").alias("with_photo"),
        F.count("article").alias("articles"),
    )


def source_snapshots(rows: DataFrame, digest: str = "file_sha256") -> DataFrame:
    """Row count and digest per source table; the rows themselves stay rows of their table."""
    return rows.groupBy("source_name", "table_name").agg(
        F.count(F.lit(1)).alias("row_count"), F.max(digest).alias("file_sha256")
    )
