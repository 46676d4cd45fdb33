"""Keyed-table queries."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradeloom.bindings import FEED_ARRIVAL, FEED_KEYS, feed, load, money, text, whole
from tradeloom.catalogue import query
from tradeloom.functions.jsonpath import canonical_json, payload_sha, row_hash
from tradeloom.operators import keyed
from tradeloom.operators.ordered import id_chunks
from tradeloom.session import scratch_path
from tradeloom.sources import tables
from tradeloom.sources.landing import union_sources

# The feed before this day is the stored state, the feed from it on the next batch.
CUT = "1998-07-01"


def _cut():
    return F.lit(CUT).cast("timestamp_ntz")


SQL_FEED = """
    feed AS (SELECT l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey, l_quantity::BIGINT AS qty,
                    l_extendedprice::DECIMAL(12,2) AS price FROM lineitem),
    ranked AS (SELECT *, l_shipdate < TIMESTAMP '1998-07-01' AS old,
                      ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_linenumber, l_shipdate < TIMESTAMP '1998-07-01'
                                         ORDER BY l_shipdate DESC, l_partkey, l_suppkey, qty, price) AS rn FROM feed),
    cur AS (SELECT * EXCLUDE (rn, old) FROM ranked WHERE rn = 1 AND old),
    inc AS (SELECT * EXCLUDE (rn, old) FROM ranked WHERE rn = 1 AND NOT old)
"""


def _states(spark, sf_dir):
    rows = feed(spark, sf_dir)
    current = keyed.dedupe_latest(rows.where(F.col("l_shipdate") < _cut()), FEED_KEYS, "l_shipdate", FEED_ARRIVAL)
    incoming = keyed.dedupe_latest(rows.where(F.col("l_shipdate") >= _cut()), FEED_KEYS, "l_shipdate", FEED_ARRIVAL)
    return current, incoming


def _plain(df):
    return df.withColumns({"l_shipdate": F.to_date("l_shipdate"), "price": F.col("price").cast("double")})


SQL_PLAIN = "l_orderkey, l_linenumber, l_shipdate::DATE AS l_shipdate, l_partkey, l_suppkey, qty, price::DOUBLE AS price"


@query(
    "dedupe_latest",
    f"""
    WITH {SQL_FEED} SELECT {SQL_PLAIN} FROM
        (SELECT *, ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_linenumber
                                      ORDER BY l_shipdate DESC, l_partkey, l_suppkey, qty, price) AS rn FROM feed)
    WHERE rn = 1
    """,
)
def dedupe_latest(spark, sf_dir):
    return _plain(keyed.dedupe_latest(feed(spark, sf_dir), FEED_KEYS, "l_shipdate", FEED_ARRIVAL))


@query(
    "dedupe_null_time",
    """
    SELECT user_id, event_type, event_id FROM
        (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id, event_type
                                      ORDER BY CASE WHEN value > 30 THEN ts END DESC NULLS LAST, event_id) AS rn FROM events)
    WHERE rn = 1
    """,
)
def dedupe_null_time(spark, sf_dir):
    events = load(spark, sf_dir, "events").withColumn("seen", F.when(F.col("value") > 30, F.col("ts")))
    newest = keyed.dedupe_latest(events, ["user_id", "event_type"], "seen", ["event_id"], null_time="oldest")
    return newest.select("user_id", "event_type", "event_id")


@query(
    "dedupe_duplicate_count",
    """
    SELECT COUNT(*)::BIGINT AS received, COUNT(DISTINCT (l_orderkey, l_linenumber))::BIGINT AS unique_rows,
           (COUNT(*) - COUNT(DISTINCT (l_orderkey, l_linenumber)))::BIGINT AS duplicates,
           ((COUNT(*) - COUNT(DISTINCT (l_orderkey, l_linenumber))) * 20000 + COUNT(*)) // (COUNT(*) * 2) / 100 AS dup_pct
    FROM lineitem
    """,
)
def dedupe_duplicate_count(spark, sf_dir):
    return keyed.dedupe_metrics(feed(spark, sf_dir), FEED_KEYS)


@query(
    "append_new",
    f"""
    WITH {SQL_FEED}, fresh AS (SELECT * FROM feed WHERE l_shipdate >= TIMESTAMP '{CUT}')
    SELECT {SQL_PLAIN} FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_linenumber
        ORDER BY l_shipdate, l_partkey, l_suppkey, qty, price) AS rn FROM fresh
        WHERE (l_orderkey, l_linenumber) NOT IN (SELECT (l_orderkey, l_linenumber) FROM cur)) WHERE rn = 1
    """,
)
def append_new(spark, sf_dir):
    rows = feed(spark, sf_dir)
    target = rows.where(F.col("l_shipdate") < _cut())
    incoming = rows.where(F.col("l_shipdate") >= _cut())
    return _plain(keyed.append_new(target, incoming, FEED_KEYS, ["l_shipdate", *FEED_ARRIVAL]))


@query(
    "upsert_state",
    f"""
    WITH {SQL_FEED} SELECT {SQL_PLAIN} FROM inc UNION ALL SELECT {SQL_PLAIN} FROM cur
    WHERE (l_orderkey, l_linenumber) NOT IN (SELECT (l_orderkey, l_linenumber) FROM inc)
    """,
)
def upsert_state(spark, sf_dir):
    return _plain(keyed.upsert(*_states(spark, sf_dir), FEED_KEYS))


@query(
    "upsert_changed",
    f"""
    WITH {SQL_FEED}, both_sides AS (
        SELECT COALESCE(i.l_orderkey, c.l_orderkey) AS l_orderkey, COALESCE(i.l_linenumber, c.l_linenumber) AS l_linenumber,
               i.l_orderkey IS NOT NULL AND (c.l_orderkey IS NULL OR i.qty IS DISTINCT FROM c.qty) AS wins,
               i.l_shipdate AS id, c.l_shipdate AS cd, i.l_partkey AS ip, c.l_partkey AS cp, i.l_suppkey AS iss, c.l_suppkey AS cs,
               i.qty AS iq, c.qty AS cq, i.price AS ipr, c.price AS cpr
        FROM inc i FULL JOIN cur c ON i.l_orderkey = c.l_orderkey AND i.l_linenumber = c.l_linenumber)
    SELECT l_orderkey, l_linenumber, (CASE WHEN wins THEN id ELSE cd END)::DATE AS l_shipdate, CASE WHEN wins THEN ip ELSE cp END AS l_partkey,
           CASE WHEN wins THEN iss ELSE cs END AS l_suppkey, CASE WHEN wins THEN iq ELSE cq END AS qty,
           (CASE WHEN wins THEN ipr ELSE cpr END)::DOUBLE AS price FROM both_sides
    """,
)
def upsert_changed(spark, sf_dir):
    return _plain(keyed.upsert_changed(*_states(spark, sf_dir), FEED_KEYS, ["qty"]))


@query(
    "upsert_changed_counts",
    f"""
    WITH {SQL_FEED} SELECT verdict, COUNT(*)::BIGINT AS n FROM (
        SELECT CASE WHEN i.l_orderkey IS NULL THEN 'kept' WHEN c.l_orderkey IS NULL THEN 'new'
                    WHEN i.qty IS DISTINCT FROM c.qty THEN 'changed' ELSE 'same' END AS verdict
        FROM inc i FULL JOIN cur c ON i.l_orderkey = c.l_orderkey AND i.l_linenumber = c.l_linenumber) GROUP BY 1
    """,
)
def upsert_changed_counts(spark, sf_dir):
    states = keyed.compare_states(*_states(spark, sf_dir), FEED_KEYS, ["qty"])
    return states.groupBy("verdict").agg(F.count(F.lit(1)).alias("n"))


@query(
    "append_versions",
    f"""
    WITH {SQL_FEED} SELECT i.l_orderkey, i.l_linenumber, i.l_shipdate::DATE AS l_shipdate, i.l_partkey, i.l_suppkey, i.qty, i.price::DOUBLE AS price
    FROM inc i LEFT JOIN cur c ON i.l_orderkey = c.l_orderkey AND i.l_linenumber = c.l_linenumber
    WHERE c.l_orderkey IS NULL OR i.qty <> c.qty OR i.l_partkey <> c.l_partkey
    """,
)
def append_versions(spark, sf_dir):
    return _plain(keyed.append_versions(*_states(spark, sf_dir), FEED_KEYS, ["qty", "l_partkey"]))


@query(
    "change_events",
    """
    SELECT event_id, user_id, event_type AS status FROM
        (SELECT *, LAG(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev FROM events)
    WHERE prev IS DISTINCT FROM event_type
    """,
)
def change_events(spark, sf_dir):
    """The whole log of changes: rows whose status differs from the one before."""
    from tradeloom.bindings import status_log
    from tradeloom.plans.orders import change_history

    history = change_history(status_log(spark, sf_dir), "user_id", ["status"], ["event_id"])
    return history.where("status_changed").select("event_id", "user_id", "status")


@query(
    "rebuild_versions",
    """
    SELECT event_type AS run_id, user_id, COUNT(*)::BIGINT AS n, SUM(value::DECIMAL(12,2))::DOUBLE AS v FROM
        (SELECT event_type, user_id, value FROM events WHERE event_type <> 'error'
         UNION ALL SELECT 'error', user_id, value FROM events WHERE event_type = 'signup')
    GROUP BY 1, 2
    """,
)
def rebuild_versions(spark, sf_dir):
    """The run 'error' rebuilt from the records of 'signup'."""
    log = load(spark, sf_dir, "events").select("user_id", money("value").alias("value"), F.col("event_type").alias("run_id"))
    replay = log.where(F.col("run_id") == "signup").drop("run_id")
    rebuilt = keyed.rebuild_versions(log, replay, "error")
    return rebuilt.groupBy("run_id", "user_id").agg(F.count(F.lit(1)).alias("n"), F.sum("value").cast("double").alias("v"))


@query(
    "seed_versions",
    """
    SELECT p_partkey AS part FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_returnflag = 'R' AND l_linestatus = 'F')
    """,
)
def seed_versions(spark, sf_dir):
    current = load(spark, sf_dir, "part").select(F.col("p_partkey").alias("part"))
    log = load(spark, sf_dir, "lineitem").where((F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F"))
    return keyed.seed_versions(log.select(F.col("l_partkey").alias("part")), current, ["part"])


@query(
    "replace_slice",
    """
    SELECT l_returnflag AS report_code, COUNT(*)::BIGINT AS n, SUM(q)::BIGINT AS qty FROM
        (SELECT l_returnflag, l_quantity::BIGINT AS q FROM lineitem WHERE l_returnflag <> 'R'
         UNION ALL SELECT 'R', l_quantity::BIGINT + 1 FROM lineitem WHERE l_linestatus = 'F') GROUP BY 1
    """,
)
def replace_slice(spark, sf_dir):
    lines = load(spark, sf_dir, "lineitem")
    table = lines.select(F.col("l_returnflag").alias("report_code"), whole("l_quantity").alias("qty"))
    rows = lines.where(F.col("l_linestatus") == "F").select((whole("l_quantity") + 1).alias("qty"))
    replaced = keyed.replace_slice(table, rows, "report_code", "R")
    return replaced.groupBy("report_code").agg(F.count(F.lit(1)).alias("n"), F.sum("qty").alias("qty"))


@query(
    "snapshot_append",
    """
    SELECT o_orderdate::DATE AS snapped_on, COUNT(*)::BIGINT AS n, COUNT(DISTINCT o_custkey)::BIGINT AS articles FROM orders GROUP BY 1
    """,
)
def snapshot_append(spark, sf_dir):
    rows = keyed.append_snapshot(load(spark, sf_dir, "orders"), F.col("o_orderdate"))
    return rows.groupBy("snapped_on").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("o_custkey").alias("articles"))


@query(
    "retention",
    """
    SELECT event_type, COUNT(*)::BIGINT AS kept, MIN(event_id) AS first_id FROM events
    WHERE ts >= (SELECT MAX(ts) FROM events) - INTERVAL 14 DAY GROUP BY 1
    """,
)
def retention(spark, sf_dir):
    events = load(spark, sf_dir, "events")
    as_of = events.agg(F.max("ts")).scalar()
    kept = keyed.retain(events, "ts", as_of, 14)
    return kept.groupBy("event_type").agg(F.count(F.lit(1)).alias("kept"), F.min("event_id").alias("first_id"))


@query(
    "payload_sha",
    """
    SELECT event_id, sha256('{"k":' || json_extract_string(props, '$.k') || ',"type":"' || event_type || '"}') AS payload_sha256 FROM events
    """,
)
def payload_sha_query(spark, sf_dir):
    """The payload is spelled with unsorted keys and spaces; the hash is of the sorted text."""
    payload = F.concat(F.lit('{"type": "'), "event_type", F.lit('", "k": '), F.get_json_object("props", "$.k"), F.lit(".0}"))
    return load(spark, sf_dir, "events").select("event_id", payload_sha(payload).alias("payload_sha256"))


@query(
    "canonical_json",
    """
    SELECT event_id, '{"a":' || event_id || ',"k":' || json_extract_string(props, '$.k') || ',"z":["' || event_type || '",null]}' AS payload
    FROM events
    """,
)
def canonical_json_query(spark, sf_dir):
    payload = F.concat(
        F.lit('{ "z":["'), "event_type", F.lit('", null], "k":'), F.get_json_object("props", "$.k"), F.lit(', "a" : '),
        text("event_id"), F.lit("}"),
    )
    return load(spark, sf_dir, "events").select("event_id", canonical_json(payload).alias("payload"))


@query(
    "row_hash",
    """
    SELECT event_id, sha256(event_id || chr(31) || user_id || chr(31) || event_type || chr(31) ||
                            CASE WHEN event_type = 'error' THEN '' ELSE props END) AS row_hash FROM events
    """,
)
def row_hash_query(spark, sf_dir):
    payload = F.when(F.col("event_type") != "error", F.col("props"))
    return load(spark, sf_dir, "events").select(
        "event_id", row_hash("event_id", "user_id", "event_type", payload).alias("row_hash")
    )


@query(
    "latest_by_key",
    """
    SELECT user_id, event_id, event_type FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
    WHERE rn = 1
    """,
)
def latest_by_key(spark, sf_dir):
    return keyed.latest_by(load(spark, sf_dir, "events"), ["user_id"], ["ts", "event_id"]).select("user_id", "event_id", "event_type")


@query(
    "backfill",
    """
    SELECT event_id, CASE WHEN event_type IN ('error', 'view') THEN user_id ELSE json_extract_string(props, '$.k')::BIGINT END AS k FROM events
    """,
)
def backfill(spark, sf_dir):
    """k from the payload; unreadable or missing payloads keep the stored value."""
    payload = (
        F.when(F.col("event_type") == "error", '{"k": "n/a"}').when(F.col("event_type") == "view", "{}").otherwise(F.col("props"))
    )
    rows = load(spark, sf_dir, "events").select("event_id", F.col("user_id").alias("k"), payload.alias("payload"))
    return keyed.backfill(rows, {"k": F.get_json_object("payload", "$.k").try_cast("bigint")}).select("event_id", "k")


@query(
    "stock_update_from",
    """
    SELECT p_partkey, p_brand, COALESCE(q, p_size)::BIGINT AS p_size FROM part LEFT JOIN
        (SELECT l_partkey, SUM(l_quantity::BIGINT) AS q FROM lineitem WHERE l_returnflag = 'R' AND l_linestatus = 'O' GROUP BY 1)
        ON l_partkey = p_partkey
    """,
)
def stock_update_from(spark, sf_dir):
    base = load(spark, sf_dir, "part").select("p_partkey", "p_brand", F.col("p_size").cast("bigint").alias("p_size"))
    returned = (F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "O")
    totals = load(spark, sf_dir, "lineitem").where(returned).groupBy(F.col("l_partkey").alias("p_partkey"))
    return keyed.update_from(base, totals.agg(F.sum(whole("l_quantity")).alias("p_size")), ["p_partkey"], ["p_size"])


@query(
    "source_changed",
    """
    WITH now_side AS (SELECT source, lang, COUNT(*) AS row_count, SUM(n_chars)::BIGINT AS sig FROM documents GROUP BY 1, 2),
    old_side AS (SELECT source, lang, COUNT(*) AS row_count, SUM(n_chars)::BIGINT AS sig FROM documents
                 WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1) GROUP BY 1, 2)
    SELECT n.source, n.lang, n.row_count::BIGINT AS row_count FROM now_side n LEFT JOIN old_side o USING (source, lang)
    WHERE o.sig IS NULL OR o.sig <> n.sig OR (n.lang = 'de' AND n.row_count > 0)
    """,
)
def source_changed(spark, sf_dir):
    """Groups of documents as files: the stored snapshot lacks the toxic ones and is empty for one language."""
    documents = load(spark, sf_dir, "documents")
    toxic = load(spark, sf_dir, "labels").where(F.col("toxic") == 1).select("doc_id")

    def snapshot(df):
        return df.groupBy("source", "lang").agg(
            F.count(F.lit(1)).alias("row_count"), F.sha2(F.sum("n_chars").cast("string"), 256).alias("file_sha256")
        )

    stored = snapshot(documents.join(toxic, "doc_id", "left_anti")).withColumns(
        {
            "row_count": F.when(F.col("lang") == "de", 0).otherwise(F.col("row_count")),
            "loaded_at": F.lit("2026-01-01").cast("date"),
            "id": F.lit(1),
        }
    )
    older = stored.withColumns({"loaded_at": F.lit("2025-01-01").cast("date"), "file_sha256": F.lit("old")})
    now = snapshot(documents)
    return keyed.changed_sources(now, stored.unionByName(older), ["source", "lang"]).select("source", "lang", "row_count")


@query(
    "fallback_source",
    """
    SELECT o_orderkey AS id, o_orderpriority AS block FROM orders WHERE o_orderstatus = 'P'
    UNION ALL
    SELECT l_orderkey, l_returnflag FROM lineitem WHERE l_returnflag NOT IN (SELECT DISTINCT o_orderpriority FROM orders WHERE o_orderstatus = 'P')
    """,
)
def fallback_source(spark, sf_dir):
    primary = load(spark, sf_dir, "orders").where(F.col("o_orderstatus") == "P")
    primary = primary.select(F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("block"))
    lines = load(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("id"), F.col("l_returnflag").alias("block"))
    orders = load(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("block"))
    known = orders.join(primary.select("block").distinct(), "block", "left_semi").select("id", "block")
    return keyed.prefer_primary(primary, lines.unionByName(known), "block")


@query(
    "union_sources",
    """
    SELECT source_no, COUNT(*)::BIGINT AS n, SUM(qty)::BIGINT AS qty FROM
        (SELECT 0 AS source_no, l_quantity::BIGINT AS qty FROM lineitem UNION ALL SELECT 1, o_custkey FROM orders) GROUP BY 1
    """,
)
def union_sources_query(spark, sf_dir):
    lines = load(spark, sf_dir, "lineitem").select(whole("l_quantity").alias("qty"), "l_partkey")
    orders = load(spark, sf_dir, "orders").select(F.col("o_custkey").alias("qty"))
    return union_sources([lines, orders]).groupBy("source_no").agg(F.count(F.lit(1)).alias("n"), F.sum("qty").alias("qty"))


@query(
    "stale_keys",
    """
    SELECT p_partkey FROM part EXCEPT SELECT l_partkey FROM lineitem WHERE l_linestatus = 'O' AND l_returnflag = 'N'
    """,
)
def stale_keys(spark, sf_dir):
    live = load(spark, sf_dir, "lineitem").where((F.col("l_linestatus") == "O") & (F.col("l_returnflag") == "N"))
    return load(spark, sf_dir, "part").select("p_partkey").join(live.select(F.col("l_partkey").alias("p_partkey")), "p_partkey", "left_anti")


@query(
    "id_chunks",
    """
    SELECT l_orderkey, ordinal, (ordinal - 1) // 1000 AS chunk FROM
        (SELECT l_orderkey, ROW_NUMBER() OVER (ORDER BY l_orderkey) AS ordinal FROM (SELECT DISTINCT l_orderkey FROM lineitem))
    """,
)
def id_chunks_query(spark, sf_dir):
    return id_chunks(load(spark, sf_dir, "lineitem"), "l_orderkey", 1000)


@query(
    "last_seen_run",
    f"""
    WITH {SQL_FEED} SELECT COALESCE(last_seen_run, 'never') AS last_seen_run, COUNT(*)::BIGINT AS n FROM (
        SELECT CASE WHEN (l_orderkey, l_linenumber) IN (SELECT (l_orderkey, l_linenumber) FROM inc) THEN 'run-2' END AS last_seen_run FROM
        (SELECT l_orderkey, l_linenumber FROM cur UNION SELECT l_orderkey, l_linenumber FROM inc)) GROUP BY 1
    """,
)
def last_seen_run(spark, sf_dir):
    current, incoming = _states(spark, sf_dir)
    state = keyed.seen_in_run(keyed.upsert(current, incoming, FEED_KEYS), incoming, FEED_KEYS, "run-2")
    run = F.coalesce("last_seen_run", F.lit("never")).alias("last_seen_run")
    return state.groupBy(run).agg(F.count(F.lit(1)).alias("n"))


TABLE_ROW = T.StructType([T.StructField("k", T.LongType()), T.StructField("v", T.LongType())])


@query(
    "table_upserts",
    """
    WITH a AS (SELECT l_partkey AS k, MIN(l_suppkey) AS v FROM lineitem WHERE l_returnflag <> 'R' GROUP BY 1),
    b AS (SELECT l_suppkey AS k, MIN(l_orderkey) AS v FROM lineitem GROUP BY 1),
    c AS (SELECT o_custkey AS k, MIN(o_orderkey) AS v FROM orders GROUP BY 1)
    SELECT k, COALESCE(c.v, b.v, a.v) AS v FROM a FULL JOIN b USING (k) FULL JOIN c USING (k)
    """,
)
def table_upserts(spark, sf_dir):
    """A bucketed table after three batches with repeated and missing keys; a write that died is in between."""
    path, lines = scratch_path(spark, "upserts"), load(spark, sf_dir, "lineitem")
    parts = lines.select(F.when(F.col("l_returnflag") != "R", F.col("l_partkey")).alias("k"), F.col("l_suppkey").alias("v"))
    tables.upsert_table(path, parts, ["k"], TABLE_ROW, buckets=8)
    dead = tables.next_generation(spark, path)
    lost = parts.withColumn(tables.BUCKET, F.lit(0))
    lost.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").partitionBy(tables.BUCKET).parquet(
        f"{path}/generation={dead:012d}"
    )
    tables.upsert_table(path, lines.select(F.col("l_suppkey").alias("k"), F.col("l_orderkey").alias("v")), ["k"], TABLE_ROW, buckets=8)
    orders = load(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k"), F.col("o_orderkey").alias("v"))
    tables.upsert_table(path, orders, ["k"], TABLE_ROW, buckets=8, compare=["v"])
    tables.vacuum(spark, path)
    return tables.read_table(spark, path, TABLE_ROW)


@query("table_replaced", "SELECT p_partkey, p_size + 1 AS p_size FROM part")
def table_replaced(spark, sf_dir):
    """A whole table written anew from its own newest generation."""
    path = scratch_path(spark, "replaced")
    tables.replace_all(load(spark, sf_dir, "part").select("p_partkey", "p_size"), path, 1)
    tables.replace_all(tables.read_newest(spark, path).withColumn("p_size", F.col("p_size") + 1), path, 1)
    return tables.read_newest(spark, path)
