"""Quoted delimited text against Python's csv reader, over files cut into small blocks."""

import csv
import io
import os
import random

import pytest
from pyspark.sql import functions as F

from tradeloom.sources import delimited, landing


@pytest.fixture
def small_blocks(spark):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {k: spark.conf.get(k) for k in names}
    yield lambda size: [spark.conf.set(k, v) for k, v in zip(names, (str(size), "1"))]
    for k, v in before.items():
        spark.conf.set(k, v)


def rows_by_file(df):
    found = {}
    for r in df.collect():
        found.setdefault(os.path.basename(r.file), {})[r.row_number] = r.cells
    return {f: [rows[n] for n in range(1, len(rows) + 1)] for f, rows in found.items()}


def expected(text, sep):
    return list(csv.reader(io.StringIO(text, newline=""), delimiter=sep))


BITS = ["a", "товар", "", '"', '""', ";", ";", "\n", "\r\n", "\r", '"x"', '";"', '"a;b"', '"c\nd"', '5" x', ' "q"', "﷐", "é"]


@pytest.mark.parametrize("size", [7, 64, 100_000])
def test_any_text_equals_the_csv_reader(spark, tmp_path, small_blocks, size):
    rng, texts = random.Random(size), {}
    for k in range(40):
        text = "".join(rng.choice(BITS) for _ in range(rng.randint(1, 60)))
        # an open quote at the end of a file takes its last break too, which a reader of lines does not see
        if not text.strip("\r\n") or delimiter_open(text):
            text += '"'
            if delimiter_open(text):
                continue
        texts[f"{k:02d}.txt"] = text
        (tmp_path / f"{k:02d}.txt").write_bytes(text.encode())
    small_blocks(size)
    got = rows_by_file(delimited.read_delimited(spark, str(tmp_path), sep=";"))
    assert got == {f: expected(t, ";") for f, t in texts.items()}


def delimiter_open(text):
    rows = list(csv.reader(io.StringIO(text + "\n@@@;1", newline=""), delimiter=";"))
    return rows[-1] != ["@@@", "1"]


def test_cp1251_and_utf8_side_by_side(spark, tmp_path, small_blocks):
    rows = [["Артикул", "Имя \"№\"", ""], ["1\t2", "две\nстроки\r\nи три", 'a"b'], [], ["конец"]]
    for name, codec in (("a.txt", "cp1251"), ("b.txt", "utf-8-sig")):
        with open(tmp_path / name, "w", encoding=codec, newline="") as f:
            csv.writer(f, delimiter="\t").writerows(rows)
    small_blocks(16)
    assert rows_by_file(delimited.read_delimited(spark, str(tmp_path))) == {"a.txt": rows, "b.txt": rows}
    assert rows_by_file(delimited.read_delimited(spark, str(tmp_path / "a.txt"), encoding="cp1251")) == {"a.txt": rows}


def test_long_quoted_rows_over_many_blocks(spark, tmp_path, small_blocks):
    rng = random.Random(5)
    rows = [[str(i), "\n".join(["строка " * rng.randint(0, 5) + '"'] * rng.randint(0, 40)), "z"] for i in range(300)]
    rows.append(["end", 'x"' * 3000, "a\t" * 2000])
    with open(tmp_path / "long.txt", "w", encoding="utf-8", newline="") as f:
        csv.writer(f, delimiter="\t").writerows(rows)
    small_blocks(2000)
    df = delimited.read_delimited(spark, str(tmp_path))
    assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 20
    assert rows_by_file(df) == {"long.txt": rows}


def test_landed_records_keep_their_order_under_any_split(spark, tmp_path, small_blocks):
    (tmp_path / "r.jsonl").write_text("".join(f'{{"key": {i % 7}, "n": {i}}}\n' + "[skipped]\n" * (i % 3) for i in range(500)))
    firsts = []
    for size in (100, 3000, 10_000_000):
        small_blocks(size)
        rows = landing.read_landing(spark, str(tmp_path)).withColumn("key", F.get_json_object("payload", "$.key"))
        first = rows.groupBy("key").agg(F.min_by(F.get_json_object("payload", "$.n"), F.struct("file", "row_number")).alias("n"))
        firsts.append(sorted((r["key"], int(r["n"])) for r in first.collect()))
        assert [r["row_number"] for r in rows.orderBy("row_number").limit(4).collect()] == [1, 2, 4, 7]
    assert firsts[0] == firsts[1] == firsts[2] == [(str(i), i) for i in range(7)]
