import glob
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradeloom.session import ensure_checkpoint_dir, shared_folder
from tradeloom.sources import tables
from tradeloom.streaming import incremental, streams

ROW = T.StructType([T.StructField("k", T.LongType()), T.StructField("v", T.StringType())])


def batch(spark, rows):
    return spark.createDataFrame(rows, ROW)


def state(spark, path):
    return {r.k: r.v for r in tables.read_table(spark, path, ROW).collect()}


def test_shared_folder_comes_from_the_session(spark):
    assert shared_folder(spark) == spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert ensure_checkpoint_dir(spark)


def test_upsert_rewrites_touched_buckets_only(spark, tmp_path):
    path = str(tmp_path / "t")
    assert state(spark, path) == {}
    tables.upsert_table(path, batch(spark, [(i, "a") for i in range(40)]), ["k"], ROW, buckets=8)
    before = {f: os.path.getmtime(f) for f in glob.glob(f"{path}/generation=*/key_bucket=*/*.parquet")}
    tables.upsert_table(path, batch(spark, [(3, "b"), (100, "c")]), ["k"], ROW, buckets=8)
    after = {f: os.path.getmtime(f) for f in glob.glob(f"{path}/generation=*/key_bucket=*/*.parquet")}
    assert all(after.get(f) == t for f, t in before.items())  # nothing that can be read is touched
    assert 1 <= len(set(after) - set(before)) <= 2  # one file for each touched bucket
    assert state(spark, path) == {i: "a" for i in range(40)} | {3: "b", 100: "c"}


def test_a_death_before_the_commit_loses_nothing(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    tables.upsert_table(path, batch(spark, [(i, "a") for i in range(40)]), ["k"], ROW, buckets=8)
    held = tables.read_table(spark, path, ROW)  # a reader that started before
    tables.upsert_table(path, batch(spark, [(i, "b") for i in range(40)]), ["k"], ROW, buckets=8)
    os.remove(f"{path}/generation=000000000002/_SUCCESS")
    os.remove(glob.glob(f"{path}/generation=000000000002/key_bucket=*/*.parquet")[0])
    assert state(spark, path) == {i: "a" for i in range(40)}
    tables.upsert_table(path, batch(spark, [(1, "c")]), ["k"], ROW, buckets=8)
    assert state(spark, path) == {i: "a" for i in range(40)} | {1: "c"}
    assert {r.v for r in held.collect()} == {"a"}

    def dies(df, to, by):
        df.repartition(by).write.partitionBy(by).parquet(f"{to}/generation={tables.next_generation(spark, to):012d}/_temporary/0")
        raise KeyboardInterrupt

    with monkeypatch.context() as m, pytest.raises(KeyboardInterrupt):
        m.setattr(tables, "write_generation", dies)
        tables.upsert_table(path, batch(spark, [(2, "d")]), ["k"], ROW, buckets=8)
    assert state(spark, path)[2] == "a"
    tables.upsert_table(path, batch(spark, [(2, "d")]), ["k"], ROW, buckets=8)
    assert state(spark, path)[2] == "d"
    assert tables.committed(spark, path) == [1, 3, 5]


def test_files_do_not_grow_with_shuffle_partitions(spark, tmp_path):
    path, before = str(tmp_path / "t"), spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "64")
        tables.upsert_table(path, batch(spark, [(i, "a") for i in range(3000)]), ["k"], ROW, buckets=4)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(glob.glob(f"{path}/generation=*/key_bucket=*/*.parquet")) == 4


def test_vacuum_keeps_the_newest_states(spark, tmp_path):
    path = str(tmp_path / "t")
    for n in range(6):
        tables.upsert_table(path, batch(spark, [(i, str(n)) for i in range(40) if n == 0 or i % 40 == n]), ["k"], ROW, buckets=8)
    os.remove(f"{path}/generation=000000000004/_SUCCESS")
    expected = state(spark, path)
    older = {r.k: r.v for r in tables.read_generations(spark, path, ROW, as_of=5).collect()}
    assert tables.vacuum(spark, path, keep=2) > 0
    assert state(spark, path) == expected and expected[5] == "5" and older[5] == "0"
    assert {r.k: r.v for r in tables.read_generations(spark, path, ROW, as_of=5).collect()} == older
    assert 4 not in {tables._generation(p) for p in tables._listed(spark, f"{path}/generation=*")}
    assert tables.vacuum(spark, path, keep=2) == 0


def test_replacing_the_table_that_is_read(spark, tmp_path):
    path = str(tmp_path / "t")
    assert tables.replace_all(batch(spark, [(1, "a"), (2, "b")]), path, 7) == 7
    now = tables.read_newest(spark, path)
    assert tables.replace_all(now.where("k = 1"), path, 7) == 8  # the same number again
    assert [r.k for r in tables.read_newest(spark, path).collect()] == [1] and now.count() == 2


@pytest.mark.parametrize("compare", [None, ["v"]])
def test_upsert_keeps_one_row_per_key(spark, tmp_path, compare):
    path = str(tmp_path / "t")
    for _ in range(2):
        tables.upsert_table(path, batch(spark, [(1, "b"), (1, "a"), (1, None), (2, "c"), (None, "x")]), ["k"], ROW, buckets=2, compare=compare)
        assert sorted((r.k, r.v) for r in tables.read_table(spark, path, ROW).collect()) == [(1, "a"), (2, "c")]


def test_versioned_upsert_survives_a_repeated_run(spark, tmp_path):
    current, log = str(tmp_path / "s"), str(tmp_path / "l")

    def run(run_id, rows):
        tables.versioned_upsert(current, log, batch(spark, rows), ["k"], ["v"], ROW, run_id, buckets=4)

    def versions():
        return sorted((r.run_id, r.k, r.v) for r in spark.read.parquet(log).collect())

    run("r1", [(1, "a"), (2, "a")])
    run("r2", [(1, "b"), (2, "a")])
    expected = [("r1", 1, "a"), ("r1", 2, "a"), ("r2", 1, "b")]
    assert versions() == expected
    run("r2", [(1, "b"), (2, "a")])  # the state already holds the rows, the log must stay
    assert versions() == expected and state(spark, current) == {1: "b", 2: "a"}
    # the job died after the log was written and before the state was
    tables.write_slice(batch(spark, [(2, "c")]).withColumn("run_id", F.lit("r3")), log, "run_id")
    run("r3", [(2, "c")])
    assert versions() == [*expected, ("r3", 2, "c")] and state(spark, current) == {1: "b", 2: "c"}


def test_slices_generations_and_retention(spark, tmp_path):
    path = str(tmp_path / "slices")
    rows = spark.createDataFrame([("a", 1), ("b", 2)], "report_code string, v int")
    tables.write_slice(rows, path, "report_code")
    tables.write_slice(rows.where("report_code = 'b'").withColumn("v", F.lit(9)), path, "report_code")
    assert sorted((r.report_code, r.v) for r in spark.read.parquet(path).collect()) == [("a", 1), ("b", 9)]
    whole = str(tmp_path / "whole")
    with pytest.raises(FileNotFoundError):
        tables.read_newest(spark, whole)
    tables.replace_all(rows, whole, 1)
    tables.replace_all(rows.limit(1), whole, 2)
    assert tables.read_newest(spark, whole).count() == 1
    os.remove(f"{whole}/generation=000000000002/_SUCCESS")  # an unfinished write is not seen
    assert tables.read_newest(spark, whole).count() == 2
    days = str(tmp_path / "days")
    dated = spark.createDataFrame([("2026-01-01", 1), ("2026-01-20", 2)], "snapped_on string, v int")
    tables.append_rows(dated, days, "snapped_on")
    assert tables.drop_old_partitions(spark, days, "snapped_on", "2026-01-10") == 1
    assert [r.v for r in spark.read.parquet(days).collect()] == [2]


def test_stream_equals_batch(spark, tmp_path):
    """The same feed in one, two and four landed parts leaves the same state."""
    rows = [(k, f"v{(k * 7 + n) % 3}", n) for n in range(12) for k in range(6) if (k + n) % 2]
    schema = T.StructType([*ROW.fields, T.StructField("n", T.IntegerType())])
    full = T.StructType([*ROW.fields, T.StructField("n", T.IntegerType())])
    expected = {k: v for k, v, n in sorted(rows, key=lambda r: r[2])}
    for parts in (1, 2, 4):
        base = tmp_path / str(parts)
        landed, current, log, check = (str(base / n) for n in ("landed", "state", "log", "check"))
        size = -(-12 // parts)
        for p in range(parts):
            chunk = [r for r in rows if p * size <= r[2] < (p + 1) * size]
            spark.createDataFrame(chunk, schema).coalesce(1).write.mode("append").parquet(landed)
            feed = streams.read_stream(spark, landed, schema)
            streams.upsert_stream(feed, current, log, check, ["k"], "n", ["v"], ["v"], full, buckets=2).awaitTermination()
        assert state(spark, current) == expected
        last = spark.read.parquet(log).groupBy("k").agg(F.max_by("v", F.struct("run_id", "n")).alias("v"))
        assert {r.k: r.v for r in last.collect()} == expected


def test_lookback_rules(spark):
    cases = [
        # age, duplicates, base, longest, expected
        (10, None, 10, 30, 2), (45, None, 10, 30, 5), (300, None, 12, 30, 10), (10_000, 40.0, 10, 30, 2), (10_000, 20.0, 10, 30, 5),
        (10_000, 3.0, 10, 30, 20), (10_000, 7.0, 10, 30, 17), (10_000, 10.0, 10, 30, 15), (10_000, 1.0, 28, 30, 30), (None, 40.0, 10, 30, 10),
    ]
    for age, dup, base, longest, expected in cases:
        got = spark.range(1).select(
            incremental.lookback_minutes(F.lit(age).cast("long"), F.lit(dup).cast("double"), base, longest).alias("m")
        ).first().m
        assert got == expected, (age, dup, base, longest)


def test_cursors(spark):
    moved = spark.createDataFrame([("a", 5), ("b", None), ("c", 7), ("d", 1)], "job_name string, cursor int")
    known = spark.createDataFrame([("a", 3), ("b", 4), ("d", 9)], "job_name string, cursor int")
    assert {r.job_name: r.cursor for r in incremental.advance_cursor(known, moved).collect()} == {"a": 5, "b": 4, "c": 7, "d": 9}
    rows = spark.createDataFrame([(1, 9), (None, 4), (2, None)], "x int, y int")
    assert incremental.max_cursor(rows, ["x", "y"]).first().cursor == 4
    assert incremental.max_cursor(rows, ["x", "y"], first_only=False).first().cursor == 9
    got = spark.range(1).select(
        incremental.stalled(F.lit(1), F.lit(2), F.lit(79_000)).alias("a"), incremental.stalled(F.lit(2), F.lit(2), F.lit(80_000)).alias("b"),
        incremental.stalled(F.lit(1), F.lit(2), F.lit(10)).alias("c"), incremental.needs_retry(F.lit(None).cast("int"), F.lit(1)).alias("d"),
        incremental.needs_retry(F.lit(2), F.lit(1)).alias("e"),
    ).first()
    assert tuple(got) == (False, True, True, True, False)
