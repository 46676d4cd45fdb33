"""Run log, cursor and quality queries."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradeloom.bindings import load, status_log, text
from tradeloom.catalogue import query
from tradeloom.operators import quality, runs
from tradeloom.plans import ops as plans
from tradeloom.session import scratch_path
from tradeloom.sources.delimited import as_latin1
from tradeloom.sources.tables import read_runs
from tradeloom.streaming import incremental

# Event types as names of jobs.
JOB_OF_EVENT = {
    "error": "wb_orders", "view": "source_statistics", "click": "sheets_orders_export", "purchase": "OZON_STOCKS ", "signup": "unknown_job",
}
SQL_JOBS = """
    runs AS (SELECT event_id AS id, ts AS started_at,
                    CASE event_type WHEN 'error' THEN 'wb_orders' WHEN 'view' THEN 'source_statistics' WHEN 'click' THEN 'sheets_orders_export'
                                    WHEN 'purchase' THEN 'OZON_STOCKS ' ELSE 'unknown_job' END AS job_name,
                    CASE event_type WHEN 'error' THEN 'wb_orders' WHEN 'view' THEN 'source_files' WHEN 'click' THEN 'sheets_orders'
                                    WHEN 'purchase' THEN 'ozon_stocks' END AS action_key,
                    CASE WHEN value > 30 THEN 'Fail' WHEN value > 20 THEN 'Running' WHEN value > 10 THEN 'ok' END AS status,
                    REPEAT(props, 40) AS error FROM events)
"""


def _runs(spark, sf_dir):
    job = F.create_map(*[F.lit(v) for pair in JOB_OF_EVENT.items() for v in pair])
    value = F.col("value")
    return load(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"), F.col("ts").alias("started_at"), job[F.col("event_type")].alias("job_name"),
        F.when(value > 30, "Fail").when(value > 20, "Running").when(value > 10, "ok").alias("status"),
        F.repeat("props", F.lit(40)).alias("error"),
    )


@query(
    "run_log_recent",
    f"""
    WITH {SQL_JOBS} SELECT id, job_name, status, LEFT(error, 240) AS error, action_key FROM runs
    WHERE started_at >= (SELECT MAX(ts) FROM events) - INTERVAL 48 HOUR ORDER BY id DESC LIMIT 500
    """,
)
def run_log_recent(spark, sf_dir):
    runs = _runs(spark, sf_dir)
    as_of = runs.agg(F.max("started_at")).scalar()
    return plans.recent_runs(runs, limit=5000, as_of=as_of, hours=48).select("id", "job_name", "status", "error", "action_key")


@query(
    "failed_jobs",
    f"""
    WITH {SQL_JOBS}, bad AS (SELECT * FROM runs WHERE started_at >= (SELECT MAX(ts) FROM events) - INTERVAL 24 HOUR
                             AND LOWER(COALESCE(status, '')) NOT IN ('ok', 'running') ORDER BY id DESC LIMIT 200)
    SELECT action_key, MAX(id) AS last_id, COUNT(*)::BIGINT AS failures FROM bad WHERE action_key IS NOT NULL GROUP BY 1
    """,
)
def failed_jobs(spark, sf_dir):
    runs = _runs(spark, sf_dir)
    return plans.failed_jobs(runs, runs.agg(F.max("started_at")).scalar())


@query(
    "cursor_and_lookback",
    """
    WITH c AS (SELECT user_id, MAX(CASE WHEN event_type = 'error' THEN NULL ELSE ts END) AS cursor,
                      COUNT(*) FILTER (WHERE event_type = 'click') * 100.0 / COUNT(*) AS dup FROM events GROUP BY 1),
    a AS (SELECT *, FLOOR((epoch_us((SELECT MAX(ts) FROM events)) - epoch_us(cursor)) / 60000000)::BIGINT AS age FROM c),
    l AS (SELECT *, CASE WHEN age <= 20 THEN 2 WHEN age <= 60 THEN 5 WHEN age <= 360 THEN 10 ELSE 15 END AS look FROM a)
    SELECT user_id, strftime(cursor, '%Y-%m-%d %H:%M:%S') AS cursor, age AS age_minutes,
           CASE WHEN cursor IS NULL THEN 10 WHEN dup >= 30 THEN LEAST(look, 2) WHEN dup >= 15 THEN LEAST(look, 5)
                WHEN dup <= 3 THEN LEAST(30, look + 5) WHEN dup <= 7 THEN LEAST(30, look + 2) ELSE look END::INT AS lookback FROM l
    """,
)
def cursor_and_lookback(spark, sf_dir):
    events = load(spark, sf_dir, "events")
    seen = events.withColumn("seen", F.when(F.col("event_type") != "error", F.col("ts")))
    cursors = incremental.max_cursor(seen, ["seen"], ["user_id"])
    shares = events.groupBy("user_id").agg((F.count_if(F.col("event_type") == "click") * 100.0 / F.count(F.lit(1))).alias("dup"))
    as_of = events.agg(F.max("ts").cast("timestamp")).scalar()
    rows = cursors.join(shares, "user_id").withColumn("age", incremental.age_in_minutes(F.col("cursor").cast("timestamp"), as_of))
    return rows.select(
        "user_id", F.date_format("cursor", "yyyy-MM-dd HH:mm:ss").alias("cursor"), F.col("age").alias("age_minutes"),
        incremental.lookback_minutes(F.col("age"), F.col("dup"), 10, 30).cast("int").alias("lookback"),
    )


@query(
    "cursor_advance",
    """
    WITH o AS (SELECT user_id, MAX(ts) AS c FROM events WHERE ts < TIMESTAMP '2024-01-15' GROUP BY 1),
    n AS (SELECT user_id, MAX(ts) AS c FROM events WHERE ts >= TIMESTAMP '2024-01-15' AND event_type = 'purchase' GROUP BY 1)
    SELECT user_id, strftime(COALESCE(GREATEST(o.c, n.c), o.c, n.c), '%Y-%m-%d %H:%M:%S') AS cursor FROM o FULL JOIN n USING (user_id)
    """,
)
def cursor_advance(spark, sf_dir):
    events = load(spark, sf_dir, "events")
    half = F.lit("2024-01-15").cast("timestamp_ntz")
    old = incremental.max_cursor(events.where(F.col("ts") < half), ["ts"], ["user_id"])
    new = incremental.max_cursor(events.where((F.col("ts") >= half) & (F.col("event_type") == "purchase")), ["ts"], ["user_id"])
    moved = incremental.advance_cursor(old, new, "user_id")
    return moved.select("user_id", F.date_format("cursor", "yyyy-MM-dd HH:mm:ss").alias("cursor"))


@query(
    "page_end_rules",
    """
    SELECT l_shipdate::DATE AS day, COUNT(*)::BIGINT AS n, (COUNT(*) < 79000 OR NOT (MAX(l_orderkey) > MIN(l_orderkey))) AS ends,
           (l_shipdate::DATE < DATE '1998-01-01') AS retry FROM lineitem GROUP BY l_shipdate
    """,
)
def page_end_rules(spark, sf_dir):
    pages = load(spark, sf_dir, "lineitem").groupBy(F.to_date("l_shipdate").alias("day")).agg(
        F.count(F.lit(1)).alias("n"), F.min("l_orderkey").alias("before"), F.max("l_orderkey").alias("after")
    )
    return pages.select(
        "day", "n", incremental.stalled(F.col("before"), F.col("after"), F.col("n")).alias("ends"),
        incremental.needs_retry(F.col("day"), F.lit("1998-01-01").cast("date")).alias("retry"),
    )


@query(
    "table_counts",
    """
    SELECT 'lineitem' AS table_name, COUNT(*)::BIGINT AS row_count FROM lineitem UNION ALL SELECT 'orders', COUNT(*) FROM orders
    UNION ALL SELECT 'events', COUNT(*) FROM events UNION ALL SELECT 'part', COUNT(*) FROM part
    """,
)
def table_counts(spark, sf_dir):
    return quality.table_counts({t: load(spark, sf_dir, t) for t in ("lineitem", "orders", "events", "part")})


@query(
    "run_log_row",
    """
    WITH k AS (SELECT DISTINCT user_id, event_type FROM events)
    SELECT 'events' AS job_name, 'ok' AS status, (SELECT COUNT(*) FROM events)::BIGINT AS api_rows,
           (SELECT COUNT(*) FROM k WHERE event_type <> 'view')::BIGINT AS raw_new, (SELECT COUNT(*) FROM k)::BIGINT AS norm_upserted,
           (SELECT COUNT(*) FROM k WHERE event_type = 'view')::BIGINT AS duplicates,
           ((SELECT COUNT(*) FROM k WHERE event_type = 'view') * 20000 + (SELECT COUNT(*) FROM events)) // ((SELECT COUNT(*) FROM events) * 2) / 100 AS dup_pct
    """,
)
def run_log_row(spark, sf_dir):
    events = load(spark, sf_dir, "events")
    per_key = events.groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n"))
    counts = per_key.agg(
        F.sum("n").alias("api_rows"), F.count(F.lit(1)).alias("deduped"), F.count(F.lit(1)).alias("norm_upserted"),
        F.count_if(F.col("event_type") != "view").alias("raw_new"),
    )
    day = F.lit("2024-02-01").cast("date")
    row = quality.run_log_row(counts, "events", "run-1", "ok", day, day)
    return row.select("job_name", "status", "api_rows", "raw_new", "norm_upserted", "duplicates", "dup_pct")


@query(
    "last_dup_pct",
    """
    SELECT value AS dup_pct FROM events WHERE event_type = 'view' ORDER BY ts DESC, event_id::VARCHAR DESC LIMIT 1
    """,
)
def last_dup_pct(spark, sf_dir):
    runs = load(spark, sf_dir, "events").select(
        F.col("event_type").alias("job_name"), F.lit("ok").alias("status"), F.col("value").alias("dup_pct"),
        F.col("ts").alias("started_at"), text("event_id").alias("run_id"),
    )
    return quality.last_dup_pct(runs, "view")


@query(
    "domain_violations",
    """
    SELECT l_orderkey, l_linenumber, 'flag' AS rule FROM lineitem WHERE l_returnflag NOT IN ('A', 'N')
    UNION ALL SELECT l_orderkey, l_linenumber, 'quantity' FROM lineitem WHERE l_quantity > 45
    UNION ALL SELECT l_orderkey, l_linenumber, 'discount' FROM lineitem WHERE l_discount > 0.09
    """,
)
def domain_violations(spark, sf_dir):
    rules = {
        "flag": F.col("l_returnflag").isin("A", "N"), "quantity": F.col("l_quantity") <= 45, "discount": F.col("l_discount") <= 0.09,
        "unknown": F.lit(None).cast("boolean"),
    }
    return quality.domain_violations(load(spark, sf_dir, "lineitem"), rules, ["l_orderkey", "l_linenumber"])


@query(
    "one_snapshot_time",
    """
    SELECT l_orderkey AS run_id, MIN(l_shipdate)::DATE AS first_time, MAX(l_shipdate)::DATE AS last_time FROM lineitem GROUP BY 1
    HAVING MIN(l_shipdate) <> MAX(l_shipdate)
    """,
)
def one_snapshot_time(spark, sf_dir):
    pages = load(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("run_id"), F.to_date("l_shipdate").alias("snapshot_time"))
    return quality.one_snapshot_time(pages)


@query(
    "column_profile",
    """
    WITH c AS (SELECT UNNEST([{'n': 'doc_id', 'v': doc_id::VARCHAR}, {'n': 'text', 'v': text}, {'n': 'lang', 'v': lang}, {'n': 'source', 'v': source},
                              {'n': 'quality', 'v': quality::VARCHAR}]) AS c FROM documents LEFT JOIN labels USING (doc_id))
    SELECT c.n AS column_name, COUNT(*)::BIGINT AS row_count, (COUNT(*) - COUNT(c.v))::BIGINT AS null_count, COUNT(DISTINCT c.v)::BIGINT AS distinct_count,
           MIN(LENGTH(c.v))::INT AS min_length, MAX(LENGTH(c.v))::INT AS max_length FROM c GROUP BY 1
    """,
)
def column_profile(spark, sf_dir):
    documents = load(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    labels = load(spark, sf_dir, "labels").select("doc_id", "quality")
    return quality.column_profile(documents.join(labels, "doc_id", "left"))


@query(
    "versions_per_run",
    """
    SELECT event_type AS run_id, COUNT(*)::BIGINT AS versions, COUNT(DISTINCT user_id)::BIGINT AS keys FROM events GROUP BY 1
    """,
)
def versions_per_run(spark, sf_dir):
    return status_log(spark, sf_dir).groupBy(F.col("status").alias("run_id")).agg(
        F.count(F.lit(1)).alias("versions"), F.count_distinct("user_id").alias("keys")
    )


@query(
    "card_metrics",
    """
    SELECT COUNT(*)::BIGINT AS cards, COUNT(*) FILTER (WHERE l_returnflag = 'A')::BIGINT AS with_photo, COUNT(DISTINCT l_partkey)::BIGINT AS articles FROM lineitem
    """,
)
def card_metrics(spark, sf_dir):
    cards = load(spark, sf_dir, "lineitem").select(
        text("l_partkey").alias("article"), F.when(F.col("l_returnflag") == "A", F.col("l_linenumber")).otherwise(0).alias("images_count")
    )
    return quality.card_metrics(cards)


@query(
    "source_snapshots",
    """
    SELECT source AS source_name, lang AS table_name, COUNT(*)::BIGINT AS row_count, MAX(sha256(text)) AS file_sha256 FROM documents GROUP BY 1, 2
    """,
)
def source_snapshots(spark, sf_dir):
    rows = load(spark, sf_dir, "documents").select(
        F.col("source").alias("source_name"), F.col("lang").alias("table_name"), F.sha2("text", 256).alias("file_sha256")
    )
    return quality.source_snapshots(rows)


RUN_STATE = T.StructType(
    [T.StructField("user_id", T.LongType()), T.StructField("event_id", T.LongType()), T.StructField("status", T.StringType()), T.StructField("at", T.TimestampType())]
)


@query(
    "run_log_runs",
    """
    WITH p AS (SELECT * FROM (VALUES ('1', TIMESTAMP '2000-01-01', TIMESTAMP '2024-01-11'), ('2', TIMESTAMP '2024-01-11', TIMESTAMP '2024-01-21'),
                                     ('3', TIMESTAMP '2024-01-21', TIMESTAMP '2100-01-01'), ('4', TIMESTAMP '2100-01-01', TIMESTAMP '2100-01-01')) v(run, since, until)),
    c AS (SELECT run, MAX(until) AS until, MAX(ts) AS cursor_old FROM p LEFT JOIN events ON ts < since GROUP BY run),
    w AS (SELECT c.run, e.* FROM c JOIN events e ON e.ts < c.until AND (c.cursor_old IS NULL OR e.ts >= c.cursor_old - INTERVAL 180 MINUTE)),
    n AS (SELECT run, user_id, ARG_MAX(event_type, ts) AS status FROM w GROUP BY 1, 2),
    o AS (SELECT p.run, e.user_id, ARG_MAX(e.event_type, e.ts) AS status FROM p JOIN events e ON e.ts < p.since GROUP BY 1, 2),
    k AS (SELECT run, COUNT(*) AS deduped, COUNT(*) FILTER (WHERE o.status IS DISTINCT FROM n.status) AS raw_new FROM n LEFT JOIN o USING (run, user_id) GROUP BY 1),
    a AS (SELECT run, COUNT(*) AS api_rows, MAX(ts) AS cursor_new FROM w GROUP BY 1)
    SELECT 'events-' || run AS run_id, 'ok' AS status, api_rows::BIGINT AS api_rows, raw_new::BIGINT AS raw_new, deduped::BIGINT AS norm_upserted,
           (deduped - raw_new)::BIGINT AS duplicates, ((deduped - raw_new) * 20000 + api_rows) // (api_rows * 2) / 100 AS dup_pct,
           strftime(cursor_old, '%Y-%m-%d %H:%M:%S') AS cursor_old, strftime(cursor_old - INTERVAL 180 MINUTE, '%Y-%m-%d %H:%M:%S') AS cursor_used,
           strftime(cursor_new, '%Y-%m-%d %H:%M:%S') AS cursor_new
    FROM c JOIN k USING (run) JOIN a USING (run)
    """,
)
def run_log_runs(spark, sf_dir):
    """Four runs over the events landed so far, each reading 180 minutes again, with the log rows they leave."""
    events = load(spark, sf_dir, "events").select("user_id", "event_id", F.col("event_type").alias("status"), F.col("ts").cast("timestamp").alias("at"))
    paths = tuple(scratch_path(spark, name) for name in ("run-state", "run-versions", "run-log"))
    for number, until in enumerate(("2024-01-11", "2024-01-21", "2100-01-01", "2100-01-01"), start=1):
        landed = events.where(F.col("at") < F.lit(until).cast("timestamp"))
        runs.logged_upsert(
            spark, lambda since, landed=landed: landed if since is None else landed.where(F.col("at") >= F.lit(since)), paths, ["user_id"], "at",
            ["event_id"], ["status"], RUN_STATE, "events", str(number), timedelta(minutes=incremental.FIXED_LOOKBACK_MINUTES), buckets=4,
        )
    found = read_runs(spark, paths[2], runs.RUN_ROW)
    cursors = [F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c) for c in ("cursor_old", "cursor_used", "cursor_new")]
    return found.select("run_id", "status", "api_rows", "raw_new", "norm_upserted", "duplicates", "dup_pct", *cursors)


@query(
    "file_profile_shapes",
    """
    WITH f AS (SELECT CASE lang WHEN 'en' THEN 'tab' WHEN 'de' THEN 'semicolon' ELSE 'comma' END AS folder, * FROM documents)
    SELECT folder, CASE folder WHEN 'tab' THEN 'cp1251' ELSE 'utf-8-sig' END AS encoding,
           CASE folder WHEN 'tab' THEN chr(9) WHEN 'semicolon' THEN ';' ELSE ',' END AS delimiter, COUNT(*)::BIGINT AS rows, 4 AS columns FROM f GROUP BY 1
    """,
)
def file_profile_shapes(spark, sf_dir):
    """Documents exported in three shapes, whose encoding, delimiter and size are found again."""
    documents = load(spark, sf_dir, "documents")
    body = F.concat(F.lit("слово "), F.regexp_replace("text", "[^\\x20-\\x7E]", " "))
    rows = documents.select("lang", text("doc_id").alias("id"), "source", body.alias("body"), F.concat_ws(" ", "lang", "source").alias("place"))
    path = scratch_path(spark, "shapes")
    shapes = (("tab", rows.where("lang = 'en'").withColumn("body", as_latin1(F.col("body"))), "\t", "iso-8859-1"),
              ("semicolon", rows.where("lang = 'de'"), ";", "utf-8"), ("comma", rows.where("lang not in ('en', 'de')"), ",", "utf-8"))
    for folder, part, sep, encoding in shapes:
        part.drop("lang").write.option("sep", sep).option("quoteAll", True).option("escape", '"').option("encoding", encoding).csv(f"{path}/{folder}")
    found = quality.profile_files(spark, [f"{path}/{folder}" for folder, *_ in shapes])
    folder = F.element_at(F.split("file", "/"), -2)
    return found.groupBy(folder.alias("folder"), "encoding", "delimiter").agg(F.sum("rows").alias("rows"), F.max("columns").alias("columns"))
