"""Runs that count themselves, file profiles and feed pages found by a bound."""

import csv
import random
import re
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradeloom.operators import quality, runs
from tradeloom.plans import orders
from tradeloom.sources import tables

ROW = T.StructType([T.StructField("k", T.LongType()), T.StructField("v", T.StringType()), T.StructField("at", T.TimestampType())])
DAY = datetime(2026, 1, 1)


def feed(spark, rows):
    return spark.createDataFrame([(k, v, DAY + timedelta(hours=h)) for k, v, h in rows], ROW)


def test_a_run_counts_what_it_writes(spark, tmp_path):
    paths, scans = tuple(str(tmp_path / n) for n in ("s", "l", "r")), []

    def run(run_id, rows, fail=False):
        def read(since):
            scans.append(since)
            if fail:
                raise ValueError("no feed")
            return feed(spark, rows).where(F.lit(True) if since is None else F.col("at") >= F.lit(since))

        return runs.logged_upsert(spark, read, paths, ["k"], "at", ["v"], ["v"], ROW, "job", run_id, timedelta(hours=1), buckets=2, now=lambda: DAY)

    first = run("1", [(1, "a", 0), (1, "b", 1), (2, "a", 2), (2, "a", 2), (None, "x", 3)])
    assert [first[c] for c in ("api_rows", "raw_new", "norm_upserted", "duplicates", "dup_pct")] == [5, 2, 2, 0, 0.0]
    assert (first["cursor_old"], first["cursor_used"], first["cursor_new"]) == (None, None, DAY + timedelta(hours=3))
    second = run("2", [(1, "b", 1), (2, "c", 4), (2, "a", 2), (9, "a", 2)])
    assert [second[c] for c in ("api_rows", "raw_new", "norm_upserted", "duplicates")] == [3, 2, 2, 0]
    assert (second["cursor_used"], second["cursor_new"]) == (DAY + timedelta(hours=2), DAY + timedelta(hours=4))
    with pytest.raises(ValueError):
        run("3", [], fail=True)
    empty = run("4", [])
    assert [empty[c] for c in ("api_rows", "raw_new", "norm_upserted", "dup_pct")] == [0, 0, 0, 0.0]
    assert empty["cursor_new"] == empty["cursor_old"] == DAY + timedelta(hours=4)
    again = run("2", [(1, "z", 9)])
    assert again["api_rows"] == 3 and len(scans) == 4  # a logged run is not done again
    log = {r.run_id: (r.status, r.error) for r in tables.read_runs(spark, paths[2], runs.RUN_ROW).collect()}
    assert log["job-3"] == ("error", "no feed") and {s for s, _ in log.values()} == {"ok", "error"} and len(log) == 4
    assert {r.k: r.v for r in tables.read_table(spark, paths[0], ROW).collect()} == {1: "b", 2: "c", 9: "a"}


def test_counting_reads_the_feed_once(spark, tmp_path):
    feed(spark, [(i, "a", i % 50) for i in range(500)]).write.parquet(str(tmp_path / "feed"))
    counters = runs.RunCounters()
    source = spark.read.parquet(str(tmp_path / "feed"))
    seen = counters.keep(counters.receive(source, "at").where("k % 2 = 0"))
    seen.write.parquet(str(tmp_path / "out"))
    assert seen._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    assert counters.values() == {"api_rows": 500, "deduped": 250, "raw_new": 0, "norm_upserted": 250, "cursor_new": DAY + timedelta(hours=49)}


def test_file_shapes(spark, tmp_path):
    rows = [["Артикул", "token = abcdef", "a,b;c", "1"]] + [[str(i), "x\ty", "нет;да,", 'q"w'] for i in range(20)]
    for name, sep, codec in (("tab.csv", "\t", "cp1251"), ("semi.csv", ";", "utf-8"), ("comma.csv", ",", "utf-8-sig"), ("one.csv", "|", "utf-8")):
        with open(tmp_path / name, "w", encoding=codec, newline="") as f:
            csv.writer(f, delimiter=sep).writerows([["слово"]] * 3 if name == "one.csv" else rows)
    found = {r.file.rsplit("/", 1)[1]: r for r in quality.profile_files(spark, str(tmp_path), sample_rows=2).collect()}
    assert {n: (r.encoding, r.delimiter, r.rows, r.columns) for n, r in found.items()} == {
        "tab.csv": ("cp1251", "\t", 21, 4), "semi.csv": ("utf-8-sig", ";", 21, 4), "comma.csv": ("utf-8-sig", ",", 21, 4),
        "one.csv": ("utf-8-sig", None, 3, 1),
    }
    assert found["tab.csv"].headers[0] == "Артикул" and found["tab.csv"].sample_rows == rows[1:3]
    assert "abcdef" not in str(found["semi.csv"].headers)


def test_pages_by_bound_equal_pages_by_offset(spark, tmp_path):
    rng = random.Random(1)
    rows = [(f"g{rng.randrange(400)}", None if rng.random() < 0.05 else DAY + timedelta(hours=rng.randrange(600)), i) for i in range(1500)]
    lines = spark.createDataFrame(rows, "order_group_key string, sort_date timestamp, order_key int").withColumn("sort_date", F.col("sort_date").cast("timestamp_ntz"))
    index = str(tmp_path / "index")
    orders.write_feed_index(lines, index, "yyyy-MM-dd")
    newest = {}
    for key, at, _ in rows:
        newest[key] = max((x for x in (newest.get(key), at) if x is not None), default=None)
    order = sorted(newest, key=lambda g: (newest[g] is None, -(newest[g] or DAY).timestamp(), g))
    for limit, offset in ((50, 0), (7, 33), (100, 350), (20, len(order) - 5), (20, 5000)):
        got = [r.order_group_key for r in orders.seek_groups(spark, index, limit, offset).collect()]
        assert got == order[offset : offset + limit]
        page = orders.feed_page(lines, limit, offset).select("order_group_key").distinct()
        assert {r.order_group_key for r in page.collect()} == set(got)
    page = orders.seek_groups(spark, index, 10, 200)
    files = spark.read.parquet(index).inputFiles()
    plan = page._jdf.queryExecution().executedPlan().toString()
    assert len(files) > 20 and re.search(r"PartitionFilters: \[isnotnull\(unit#\d+\), \(unit#\d+ = t2026-01-\d+\)\]", plan)
    last = page.collect()[-1]
    after = orders.groups_after(spark, index, F.lit(last.group_date).cast("timestamp_ntz"), last.order_group_key, 15, "yyyy-MM-dd")
    assert [r.order_group_key for r in after.collect()] == order[210:225]
    lines_of = orders.page_lines(lines, page).collect()
    assert sorted(r.order_key for r in lines_of) == sorted(i for g, _, i in rows if g in set(order[200:210]))
