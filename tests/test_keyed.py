import random
from collections import defaultdict
from datetime import datetime, timedelta

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tradeloom.operators import keyed
from tradeloom.operators.ordered import dense_ordinal, id_chunks, running_total, version_numbers
from tradeloom.operators.skew import heavy_keys, salted_join
from tradeloom.plans.orders import change_history, newest_card

SLOW = settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
STATES = st.lists(st.tuples(st.integers(0, 5), st.integers(0, 3)), max_size=12)


def at(minute):
    return datetime(2026, 8, 1, 10, minute)


def pairs(df):
    return {r.k: r.v for r in df.collect()}


def frame(spark, rows):
    return spark.createDataFrame(list(dict(rows).items()), "k int, v int")


def test_dedupe_keeps_newest_and_first_arrival(spark):
    rows = spark.createDataFrame(
        [("a", at(0), 1, 1), ("a", at(5), 2, 2), ("a", at(5), 3, 3), ("b", at(1), 4, 3), ("c", None, 5, 9), ("", at(1), 6, 9), (None, at(1), 7, 9)],
        "k string, t timestamp, n int, v int",
    )
    assert pairs(keyed.dedupe_latest(rows, ["k"], "t", ["n"])) == {"a": 2, "b": 3}
    assert pairs(keyed.dedupe_latest(rows, ["k"], "t", ["n"], null_time="oldest")) == {"a": 2, "b": 3, "c": 9}
    metrics = keyed.dedupe_metrics(rows, ["k"]).first()
    assert (metrics.received, metrics.unique_rows, metrics.duplicates, metrics.dup_pct) == (5, 3, 2, 40.0)


def test_time_is_the_first_filled_column(spark):
    rows = spark.createDataFrame(
        [("a", None, at(9), 1), ("a", at(5), at(1), 2), ("b", None, None, 3)], "k string, changed timestamp, placed timestamp, v int"
    )
    assert pairs(keyed.dedupe_latest(rows, ["k"], ["changed", "placed"], ["v"])) == {"a": 1}


def test_salted_join_matches_a_plain_join(spark):
    rows = spark.createDataFrame([("hot" if i % 3 else f"k{i % 5}", i) for i in range(300)] + [(None, 999)], "f string, n int")
    lookup = spark.createDataFrame([("hot", 1), ("k0", 2), ("k3", 3)], "f string, h int")
    for how in ("left", "inner"):
        got = salted_join(rows, lookup, ["f"], F.col("n"), how)
        plain = rows.join(lookup, "f", how)
        assert sorted(map(tuple, got.select("n", "h").collect()), key=str) == sorted(map(tuple, plain.select("n", "h").collect()), key=str)
    spread = salted_join(rows.where("f = 'hot'"), lookup, ["f"], F.col("n"), "left")
    assert "__salt" not in spread.columns and spread.count() == 200


def test_heavy_keys_are_named(spark):
    rows = spark.range(0, 100_000, 1, 7).select(
        F.when(F.col("id") % 5 < 2, "hot").when(F.col("id") % 5 == 2, F.lit(None)).when(F.col("id") % 5 == 3, F.concat(F.lit("w"), F.col("id") % 95))
        .otherwise(F.col("id").cast("string")).alias("k")
    )
    named = {r["__heavy"]: r["heavy_rows"] for r in heavy_keys(rows, ["k"]).collect()}
    counts = {r["h"]: r["n"] for r in rows.groupBy(F.xxhash64("k").alias("h")).agg(F.count("*").alias("n")).collect()}
    assert set(named) == {h for h, n in counts.items() if n >= 100_000 / 1024} and len(named) == 2 + 19
    assert all(abs(n - counts[h]) <= 100 for h, n in named.items())
    assert heavy_keys(rows.where("k = 'none'"), ["k"]).count() == 0


def test_a_hot_article_is_spread_and_the_rest_joins_plainly(spark):
    lines = spark.range(0, 50_000, 1, 8).select(
        F.when(F.col("id") % 10 < 8, "hot").otherwise(F.concat(F.lit("a"), "id")).alias("article"), F.col("id").alias("marketplace_sku")
    )
    cards = spark.range(0, 50_000, 7).select(
        F.when(F.col("id") == 0, "hot").otherwise(F.concat(F.lit("a"), "id")).alias("article"), (F.col("id") * 3).alias("marketplace_sku"),
        F.timestamp_seconds("id").alias("updated_at"), F.lit("i").alias("primary_image"), F.lit("[]").alias("images"), F.lit("n").alias("product_name"),
    )
    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        for k, v in zip(before, ("-1", "32", "false")):
            spark.conf.set(k, v)
        by_article = cards.groupBy("article").agg(F.max("updated_at").alias("at"))
        spread = salted_join(lines, by_article, ["article"], F.col("marketplace_sku"))
        sizes = [r["n"] for r in spread.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n"), F.max("at")).collect()]
        plain = lines.join(by_article, ["article"], "left")
        one = [r["n"] for r in plain.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n"), F.max("at")).collect()]
        assert max(one) > 40_000 and max(sizes) < 4000 and sum(sizes) == 50_000
        found = newest_card(lines, cards)
        assert found.where("card is not null").count() == lines.join(by_article, "article").count() + found.where(
            "article <> 'hot' and card is not null and card.id.marketplace_sku = marketplace_sku and not card.id.article = article"
        ).count()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_only_one_exchange_moves_the_rows(spark):
    rows, df = history(spark)
    plan = running_total(df.repartition(3), ["k"], ["t", "n"], "q", "r", per_range=50)._jdf.queryExecution().executedPlan().toString()
    moved = [line for line in plan.splitlines() if "Exchange hashpartitioning(k" in line and "__range" in line]
    assert len(moved) == 1
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_version_log_over_runs(spark):
    current = frame(spark, [])
    appended = []
    for payload in (1, 2, 1, 1):
        batch = frame(spark, [(1, payload)])
        versions = keyed.append_versions(current, batch, ["k"], ["v"])
        appended.append(versions.count())
        current = frame(spark, pairs(keyed.upsert_changed(current, batch, ["k"], ["v"])).items())
    assert appended == [1, 1, 1, 0]


def test_null_payload_counts_as_change(spark):
    old = spark.createDataFrame([(1, None), (2, None), (3, 1)], "k int, v int")
    new = spark.createDataFrame([(1, 5), (2, None), (3, None)], "k int, v int")
    assert {r.k for r in keyed.append_versions(old, new, ["k"], ["v"]).collect()} == {1, 3}
    verdicts = {r.k: r.verdict for r in keyed.compare_states(old, new, ["k"], ["v"]).collect()}
    assert verdicts == {1: "changed", 2: "same", 3: "changed"}


@SLOW
@given(STATES, STATES)
def test_upsert_is_idempotent_and_matches_dict(spark, old, new):
    expected = dict(old) | dict(new)
    a, b = frame(spark, old), frame(spark, new)
    once = keyed.upsert(a, b, ["k"])
    assert pairs(once) == expected
    assert pairs(keyed.upsert(once, b, ["k"])) == expected
    assert pairs(keyed.upsert_changed(a, b, ["k"], ["v"])) == expected
    new_keys = {k: v for k, v in dict(new).items() if k not in dict(old)}
    assert pairs(keyed.append_new(a, b, ["k"], ["v"])) == new_keys


def test_upsert_takes_one_row_per_key_by_the_given_order(spark):
    old = spark.createDataFrame([(1, 0), (3, 9)], "k int, v int")
    new = spark.createDataFrame([(1, 5), (1, 7), (None, 1), (2, 4)], "k int, v int")
    for order, first in ((None, 5), ([F.col("v").desc()], 7)):
        rows = keyed.upsert(keyed.upsert(old, new, ["k"], order), new, ["k"], order).collect()
        assert sorted((r.k, r.v) for r in rows) == [(1, first), (2, 4), (3, 9)]


def test_slices_and_runs(spark):
    table = spark.createDataFrame([("r1", 1), ("r1", 2), ("r2", 3)], "run_id string, v int")
    rebuilt = keyed.rebuild_versions(table, spark.createDataFrame([(9,)], "v int"), "r1")
    assert sorted((r.run_id, r.v) for r in rebuilt.collect()) == [("r1", 9), ("r2", 3)]
    replaced = keyed.replace_slice(table, spark.createDataFrame([(7,)], "v int"), "run_id", "r2")
    assert sorted((r.run_id, r.v) for r in replaced.collect()) == [("r1", 1), ("r1", 2), ("r2", 7)]


def test_changed_sources(spark):
    shape = "source string, file_sha256 string, row_count int"
    stored = spark.createDataFrame(
        [("same", "x", 5, 1, 1), ("other", "old", 5, 1, 1), ("empty", "x", 0, 1, 1), ("back", "y", 1, 1, 1), ("back", "x", 1, 2, 2)],
        shape + ", loaded_at int, id int",
    )
    now = spark.createDataFrame([("same", "x", 5), ("other", "new", 5), ("empty", "x", 3), ("fresh", "x", 1), ("back", "x", 1)], shape)
    assert {r.source for r in keyed.changed_sources(now, stored, ["source"]).collect()} == {"other", "empty", "fresh"}


def test_latest_fallback_retention(spark):
    rows = spark.createDataFrame([("a", 1, 1), ("a", 2, 2), ("b", 1, 3)], "k string, t int, v int")
    assert pairs(keyed.latest_by(rows, ["k"], ["t"])) == {"a": 2, "b": 3}
    primary = spark.createDataFrame([("x", 1)], "block string, v int")
    secondary = spark.createDataFrame([("x", 2), ("y", 3)], "block string, v int")
    assert sorted((r.block, r.v) for r in keyed.prefer_primary(primary, secondary, "block").collect()) == [("x", 1), ("y", 3)]
    days = spark.createDataFrame([(1, at(0)), (2, at(0) - timedelta(days=15)), (3, None)], "k int, t timestamp")
    kept = keyed.retain(days, "t", F.lit(at(0)), 14)
    assert {r.k for r in kept.collect()} == {1, 3}


def history(spark, n=400):
    """One key holds most rows, and half of them fall into one second."""
    rng = random.Random(7)
    rows = []
    for i in range(n):
        key = "hot" if rng.random() < 0.8 else rng.choice(["a", "b", None])
        when = at(0) if rng.random() < 0.5 else at(0) + timedelta(hours=rng.randrange(200))
        rows.append((key, when, i, rng.choice(["x", "y", None]), rng.randrange(5)))
    rng.shuffle(rows)
    return rows, spark.createDataFrame(rows, "k string, t timestamp, n int, s string, q int")


def expected_history(rows):
    groups = defaultdict(list)
    for row in rows:
        groups[row[0]].append(row)
    result = {}
    for group in groups.values():
        previous, total = None, 0
        for number, row in enumerate(sorted(group, key=lambda r: (r[1], r[2])), start=1):
            total += row[4]
            result[row[2]] = (number, previous, total)
            previous = row[3]
    return result


def test_versions_and_running_total_split_a_hot_key(spark):
    rows, df = history(spark)
    expected = expected_history(rows)
    for per_range in (10**9, 50, 7, 1):
        numbered = version_numbers(df, ["k"], ["t", "n"], {"p": "s"}, per_range=per_range).collect()
        assert {r.n: (r.version_no, r.p) for r in numbered} == {n: e[:2] for n, e in expected.items()}
        total = running_total(df, ["k"], ["t", "n"], "q", "r", per_range=per_range).collect()
        assert {r.n: r.r for r in total} == {n: e[2] for n, e in expected.items()}


def test_change_flags(spark):
    rows = spark.createDataFrame(
        [("k", at(0), "1", None), ("k", at(1), "2", "a"), ("k", at(2), "3", "a"), ("k", at(3), "4", None)], "id string, changed_at timestamp, run_id string, status string"
    )
    got = change_history(rows, "id", ["status"]).orderBy("version_no").collect()
    assert [(r.version_no, r.previous_status, r.status_changed) for r in got] == [(1, None, False), (2, None, True), (3, "a", False), (4, "a", True)]


def test_ordinals_and_chunks(spark):
    rng = random.Random(3)
    ids = [rng.randrange(10**12) for _ in range(500)]
    df = spark.createDataFrame([(i,) for i in ids + ids[:50] + [None]], "id long")
    got = {r.id: (r.ordinal, r.chunk) for r in id_chunks(df, "id", 100).collect()}
    unique = sorted(set(ids))
    assert got == {v: (i + 1, i // 100) for i, v in enumerate(unique)}
    pairs_df = spark.createDataFrame([(i % 7, i) for i in range(100)], "a int, b int")
    ranks = dense_ordinal(pairs_df, ["a", "b"]).orderBy("ordinal").collect()
    assert [(r.a, r.b) for r in ranks] == sorted((i % 7, i) for i in range(100)) and [r.ordinal for r in ranks] == list(range(1, 101))


def test_null_order_values_come_last_however_rows_are_cut(spark):
    from datetime import datetime

    from pyspark.sql import functions as F

    times = [datetime(2026, 1, 1), datetime(2026, 1, 2), None, datetime(2026, 1, 25)]
    df = spark.createDataFrame([("a", t, i, 10**i) for i, t in enumerate(times)], "k string, t timestamp, n int, q bigint")
    for per_range in (20_000_000, 1):
        numbered = version_numbers(df, ["k"], ["t", "n"], {"p": "n"}, per_range=per_range).collect()
        assert {r["n"]: (r["version_no"], r["p"]) for r in numbered} == {0: (1, None), 1: (2, 0), 3: (3, 1), 2: (4, 3)}
        total = running_total(df, ["k"], ["t", "n"], "q", "r", per_range=per_range).collect()
        assert {r["n"]: r["r"] for r in total} == {0: 1, 1: 11, 3: 1011, 2: 1111}
