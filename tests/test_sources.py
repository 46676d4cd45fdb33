import hashlib
import os
import time

from pyspark.sql import functions as F

from tradeloom.operators import merge, normalize
from tradeloom.sources import files, landing, sheets
from tradeloom.sources.delimited import read_delimited


def write(path, text, encoding):
    path.write_bytes(text.encode(encoding))
    return str(path)


def cells(df):
    return {(os.path.basename(r.file), r.row_number): r.cells for r in df.collect()}


def test_encodings_quotes_and_numbers(spark, tmp_path):
    write(tmp_path / "a.txt", 'Артикул\tЦена\r\n1\t"x\ty"\r\n\r\n2\t', "cp1251")
    write(tmp_path / "b.txt", "﻿Артикул\tЦена\n3\t№ 4\n", "utf-8")
    got = cells(read_delimited(spark, str(tmp_path)))
    assert got[("a.txt", 1)] == ["Артикул", "Цена"] and got[("b.txt", 1)] == ["Артикул", "Цена"]
    assert got[("a.txt", 2)][:2] == ["1", "x\ty"] and got[("b.txt", 2)] == ["3", "№ 4"] and got[("a.txt", 4)][0] == "2"
    forced = cells(read_delimited(spark, str(tmp_path / "a.txt"), encoding="cp1251"))
    assert forced[("a.txt", 1)] == ["Артикул", "Цена"]


def test_lines_of_a_split_file_are_numbered(spark, tmp_path):
    lines = [f"{i}\t{'x' * 50}" for i in range(20000)]
    write(tmp_path / "big.txt", "\n".join(lines), "ascii")
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "100000")
        spark.conf.set("spark.sql.files.openCostInBytes", "1000")
        rows = read_delimited(spark, str(tmp_path / "big.txt"))
        assert spark.read.text(str(tmp_path / "big.txt")).rdd.getNumPartitions() > 4
        wrong = rows.where(F.col("cells")[0].cast("long") + 1 != F.col("row_number")).count()
        assert wrong == 0 and rows.count() == 20000
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def rows_of(spark, *rows, file="f", sheet=None):
    data = [(file, n, list(r)) for n, r in enumerate(rows, start=1)]
    df = spark.createDataFrame(data, "file string, row_number long, cells array<string>")
    return df.withColumn("sheet", F.lit(sheet)) if sheet else df


def test_header_detection_and_promotion(spark):
    rows = rows_of(spark, ["report", None], [" Артикул ", None, "Цена", "Цена"], ["A", "b", "1"], ["", None], ["C", "", "2", "3"])
    header = sheets.detect_header(rows)
    assert header.first().header_row == 2
    got = {r.row_number: r.row for r in sheets.promote_header(rows, header).collect()}
    assert got == {3: {"Артикул": "A", "Column2": "b", "Цена": None}, 5: {"Артикул": "C", "Column2": "", "Цена": "3"}}
    nothing = sheets.detect_header(rows_of(spark, ["x"], ["y"]))
    assert nothing.first().header_row == 1


def test_placement_report_rows(spark):
    rows = rows_of(spark, ["SKU", "Артикул", "Название", "Стоимость размещения"], ["10", "ART", "Name", "12,5"])
    header = sheets.detect_header(rows, normalize.SKU_HEADERS + normalize.OFFER_HEADERS, top=20)
    row = normalize.placement_rows(sheets.promote_header(rows, header)).first()
    assert (row.sku, row.offer_id, float(row.placement_cost)) == (10, "ART", 12.5)


def test_inventory_text_file(spark):
    names = list(merge.INVENTORY_WAREHOUSES)
    rows = rows_of(
        spark, ["t"], ["t"], ["t"], ["Артикул", *names], ["", "шт", "шт", "шт", "шт", "шт"],
        ["ART", "1.5", "2", "3", "", "1"], ["ART", "2,5", "", "", "", "3"], ["0", "", "", "", "", ""], ["Итого", "4", "2", "3", "0", "4"],
    )
    total = merge.sum_inventory(sheets.inventory_rows(sheets.promote_fixed(rows))).collect()
    assert [(r.article, *[float(r[c]) for c in merge.INVENTORY_WAREHOUSES.values()]) for r in total] == [("ART", 4.0, 2.0, 3.0, 0.0, 4.0)]


def test_named_tables(spark, monkeypatch):
    monkeypatch.setattr(sheets, "BAND", 3)  # tables and sheets over several bands
    rows = rows_of(spark, *[[f"r{i}c{j}" if i != 5 else None for j in range(1, 6)] for i in range(1, 12)], ["short"], sheet="S")
    other = rows_of(spark, ["h", " \u00a0k "], ["1", ""], ["", ""], file="g", sheet="S")
    boxes = [("f", "S", "all", 1, 12, 1, 5), ("f", "S", "mid", 4, 8, 2, 3), ("f", "S", "head", 2, 2, 1, 2), ("f", "T", "none", 1, 2, 1, 1), ("g", "S", "g", 1, 3, 1, 3)]
    tables = spark.createDataFrame(boxes, "file string, sheet string, table string, min_row long, max_row long, min_column long, max_column long")
    got = {(r.table, r.row_number): r.row for r in sheets.read_named_tables(rows.unionByName(other), tables).collect()}
    names = [f"r1c{j}" for j in range(1, 6)]
    expected = {("all", i): {n: f"r{i}c{j}" for j, n in enumerate(names, 1)} for i in range(2, 12) if i != 5}
    expected |= {("all", 12): dict(zip(names, ["short"] + [None] * 4))}
    expected |= {("mid", i): {"r4c2": f"r{i}c2", "r4c3": f"r{i}c3"} for i in (6, 7, 8)}
    expected |= {("g", 2): {"h": "1", "k": "", "Column3": None}}
    assert got == expected
    only = sheets.read_named_tables(rows, tables, names=["mid"])
    assert {r.table for r in only.collect()} == {"mid"}
    plan = only._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_two_level_cost_file(spark, tmp_path):
    top = [""] * 7 + ["основной", "", "", "ДЛЯ МАРКЕТПЛЕЙСОВ", "", ""]
    sub = [""] * 7 + ["Кол-во", "Себест. единицы", "Себестоимость"] * 2
    data = ["c", "name", "0010031", "t", "", "", "", "2,000", "1,10", "2,20", "1,5", "", "3"]
    lines = ["title"] * 3 + ["\t".join(r) for r in (top, sub, data, ["x"] * 2 + [""] + ["9"] * 10)]
    write(tmp_path / "cost.txt", "\r\n".join(lines), "cp1251")
    wide = read_delimited(spark, str(tmp_path / "cost.txt"))
    costs = normalize.file_costs(sheets.unpivot_two_level(wide)).orderBy("warehouse_name").collect()
    assert [(r.article, r.warehouse_name, float(r.quantity), float(r.unit_cost_byn), float(r.total_cost_byn)) for r in costs] == [
        ("10031", "ДЛЯ МАРКЕТПЛЕЙСОВ", 1.5, 0.0, 3.0), ("10031", "основной", 2.0, 1.1, 2.2),
    ]
    pivot = merge.pivot_inventory(merge.merge_costs(normalize.file_costs(sheets.unpivot_two_level(wide)))).first()
    assert (pivot.article, float(pivot.smp_qty), float(pivot.osn_qty), float(pivot.ts_qty)) == ("10031", 1.5, 2.0, 0.0)


def test_spec_sheets(spark):
    head = ["Ваш SKU", "LOT", "Спецификация", "Менеджер", "Год производства"]
    good = rows_of(spark, ["note"], head, ["a", "", "В 8", "M", "апрель 2025"], [None, "x"], sheet="Для_заполнения")
    old = rows_of(spark, head, ["b", "А-7", "z", "", "2026-01-02"], sheet="Пришло-old")
    other = rows_of(spark, head, ["c", "1", "z", "", ""], sheet="Архив")
    read = sheets.read_spec_sheets(good.unionByName(old).unionByName(other))
    got = {r.article: r for r in normalize.file_specs(read).collect()}
    assert {a: (r.source_sheet, r.source_row_number, r.specification, str(r.production_date)) for a, r in got.items()} == {
        "a": ("Для_заполнения", 3, "B8", "2025-04-01"), "b": ("Пришло-old", 2, "A7", "2026-01-02"),
    }


def test_newest_file_and_digest(spark, tmp_path):
    for n, name in enumerate(("x.csv", "a.xlsx", "b.csv")):
        path = tmp_path / name
        path.write_text(name)
        os.utime(path, (time.time() + n * 10, time.time() + n * 10))
    folder = str(tmp_path)
    assert files.latest_file(spark, folder, ("*.xlsx", "*.csv")).first().path.endswith("b.csv")
    assert files.latest_file(spark, folder, ("*.xlsx", "*.csv"), preferred=True).first().path.endswith("a.xlsx")
    digests = {os.path.basename(r.path): r.file_sha256 for r in files.file_digests(spark, folder).collect()}
    assert digests["a.xlsx"] == hashlib.sha256(b"a.xlsx").hexdigest()
    kept = files.keep_originals(spark, f"{folder}/a.xlsx", "R1").first()
    assert (kept.report_code, kept.file_name, bytes(kept.content)) == ("R1", "a.xlsx", b"a.xlsx")


def test_landing(spark, tmp_path):
    (tmp_path / "r.jsonl").write_text('{"a":1}\n[1]\n\n {"a":2}\n')
    assert [r.payload.strip() for r in landing.read_landing(spark, str(tmp_path / "r.jsonl")).orderBy("row_number").collect()] == ['{"a":1}', '{"a":2}']
    pages = spark.createDataFrame(
        [("r1", 1, "m", "", 200, "{}", "", 1, 1, None), ("r2", 1, "n", "", 200, "{}", "", 1, 1, None)], landing.PAGE_SCHEMA
    )
    pages.write.parquet(str(tmp_path / "pages"))
    assert landing.read_api_pages(spark, str(tmp_path / "pages"), method="n").count() == 1
    assert landing.read_api_pages(spark, str(tmp_path / "pages"), method="n", run_id="r1").count() == 0
    days = spark.sql("SELECT * FROM VALUES (TIMESTAMP '2026-01-31 23:59:59'), (TIMESTAMP '2026-02-01 00:00:00') AS t(at)")
    day = F.lit("2026-01-31").cast("date")
    assert landing.in_period(days, "at", day, day).count() == 1


def test_spread_grows_with_the_table(spark, tmp_path, monkeypatch):
    from tradeloom import bindings

    spark.range(40_000).coalesce(1).write.parquet(str(tmp_path / "t.parquet"))
    cores = spark.sparkContext.defaultParallelism
    assert bindings.load_spread(spark, str(tmp_path), "t").rdd.getNumPartitions() == cores
    monkeypatch.setattr(bindings, "SPREAD_BYTES", 4_000)
    assert bindings.load_spread(spark, str(tmp_path), "t").rdd.getNumPartitions() > cores
    assert bindings.load_spread(spark, str(tmp_path), "t").count() == 40_000
