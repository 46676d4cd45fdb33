"""Delimited text exports as rows of cells, whatever their encoding.

A quoted cell may hold separators, line breaks and doubled quotes, so where a row ends
depends on everything before it. Files are still read by blocks, in many tasks:

1. Each line maps the state before it (outside or inside quotes) to the state after it.
   The mapping is the identity, a swap, or a constant, and a chain of them is again one of
   these: the last constant before a line and the parity of the swaps since then.
2. Inside a block the chain is a running maximum and a running sum. Per block one small row
   stays: the state after it and the rows begun in it, for either state before it.
3. The same chain over the blocks of a file gives every block's first state and the rows
   before it. With that the lines of a row are put together, and rows are cut into cells.

The rules are those of a spreadsheet export: a cell is quoted if it begins with a quote, a
quote inside an unquoted cell is an ordinary character, text after a closing quote belongs
to the cell, and rows end at LF, CR or CR LF outside quotes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

UPPER_LATIN1 = bytes(range(128, 256)).decode("latin-1")
BOM = b"\xef\xbb\xbf".decode("latin-1")
#: a separator outside quotes while a row is cut; rows that hold it themselves are cut piece by piece
CUT = "﷐"


def one_byte_table(codec: str) -> str:
    return bytes(range(128, 256)).decode(codec, errors="replace")


def single_byte_text(raw: Column, codec: str = "cp1251") -> Column:
    """Bytes of a one-byte code page to text, by mapping the upper half of Latin-1."""
    return F.translate(F.decode(raw, "ISO-8859-1"), UPPER_LATIN1, one_byte_table(codec))


def as_latin1(text: Column, codec: str = "cp1251") -> Column:
    """Text whose Latin-1 bytes are the bytes of ``text`` in a one-byte code page, for writers that know no other."""
    return F.translate(text, one_byte_table(codec), UPPER_LATIN1)


def numbered_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, block, line, value): lines as they are between two LF, numbered from 1 in their block of the file.

    A block is a split of the file, and a split is read by one task in file order, so the
    numbers are the same in every run with the same split size.
    """
    lines = spark.read.text(path, lineSep="\n").select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("read"), "value",
    )
    inside = Window.partitionBy("file", "block").orderBy("read")
    return lines.select("file", "block", F.row_number().over(inside).alias("line"), "value")


def before_block(column: str) -> Column:
    """Sum of a column over the blocks of the file before this one."""
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(column).over(before), F.lit(0))


def file_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, row_number, value) with row numbers that do not depend on how files are split."""
    lines = numbered_lines(spark, path)
    blocks = lines.groupBy("file", "block").agg(F.count(F.lit(1)).alias("lines"))
    blocks = blocks.select("file", "block", before_block("lines").alias("offset"))
    return lines.join(blocks, ["file", "block"]).select("file", (F.col("offset") + F.col("line")).alias("row_number"), "value")


def _split(text: Column, by: str) -> Column:
    return F.split(text, "\\Q" + by + "\\E")


def _open_after(line: Column, sep: str, inside: bool) -> Column:
    """Whether a quote is open at the end of a line that begins inside or outside quotes.

    Walks the text between quotes. 0: at the start of a cell or right after a closing quote,
    1: in an unquoted cell, 2: in quotes. A quote changes 0 and 2 into each other; the first
    piece has no quote before it, so the walk starts at the opposite.
    """

    def walk(state: Column, piece: Column) -> Column:
        now = F.when(state == 0, 2).when(state == 2, 0).otherwise(1)
        return F.when((now == 2) | (piece == ""), now).when(F.endswith(piece, F.lit(sep)), 0).otherwise(1)

    return F.aggregate(F.split(line, '"'), F.lit(0 if inside else 2), walk) == 2


def _states(df: DataFrame, by: list[str], order: list[str], after_outside: Column, after_inside: Column) -> DataFrame:
    """Adds what the rows before a row do to the state: (``fixed``, ``flag``).

    If ``fixed``, the state before the row is ``flag`` whatever it was before the first row;
    else it is that state, swapped if ``flag``.
    """
    before = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    df = df.withColumn("to_outside", after_outside).withColumn("to_inside", after_inside)
    df = df.withColumn("swaps", F.sum(F.when(F.col("to_outside") & ~F.col("to_inside"), 1).otherwise(0)).over(upto))
    constant = F.when(F.col("to_outside") == F.col("to_inside"), F.struct("to_outside", "swaps"))
    df = df.withColumn("last_fixed", F.last(constant, ignorenulls=True).over(before))
    df = df.withColumn("swaps_before", F.coalesce(F.last("swaps").over(before), F.lit(0)))
    odd = (F.col("swaps_before") - F.coalesce("last_fixed.swaps", F.lit(0))) % 2 == 1
    flag = F.coalesce(F.col("last_fixed.to_outside"), F.lit(False)) != odd
    return df.withColumn("fixed", F.col("last_fixed").isNotNull()).withColumn("flag", flag).drop("swaps", "last_fixed", "swaps_before")


def _given(start: Column) -> Column:
    """State before a row, given the state before the first row."""
    return F.when(F.col("fixed"), F.col("flag")).otherwise(start != F.col("flag"))


def read_rows(spark: SparkSession, path: str | list[str], sep: str = "\t") -> DataFrame:
    """(file, row_number, raw, valid_utf8): whole rows as bytes, with the line breaks inside quotes."""
    lines = numbered_lines(spark, path)
    raw = F.col("value").cast("binary")
    latin = F.regexp_replace(F.decode(raw, "ISO-8859-1"), f"^{BOM}", "")
    lines = lines.withColumn("valid", F.is_valid_utf8(raw.cast("string"))).withColumn("latin", latin)
    # a CR before the LF belongs to the break, any other one ends a line of its own
    crs = F.when(F.instr("latin", "\r") > 0, F.split("latin", "\r(?=[\\s\\S])")).otherwise(F.array("latin"))
    lines = lines.select("file", "block", "line", "valid", F.size(crs).alias("parts"), F.posexplode(crs).alias("part", "latin"))
    tail = F.endswith("latin", F.lit("\r"))
    last = F.col("part") + 1 == F.col("parts")
    lines = lines.withColumn("end", F.when(~last, "\r").when(tail, "\r\n").otherwise("\n"))
    lines = lines.withColumn("latin", F.when(last & tail, F.expr("left(latin, length(latin) - 1)")).otherwise(F.col("latin")))
    quoted = F.instr("latin", '"') > 0
    lines = _states(
        lines, ["file", "block"], ["line", "part"],
        F.when(quoted, _open_after(F.col("latin"), sep, False)).otherwise(False),
        F.when(quoted, _open_after(F.col("latin"), sep, True)).otherwise(True),
    )
    upto = Window.partitionBy("file", "block").orderBy("line", "part").rowsBetween(Window.unboundedPreceding, 0)
    starts = (("outside", F.lit(False)), ("inside", F.lit(True)))
    for name, start in starts:
        lines = lines.withColumn(f"rows_{name}", F.sum(F.when(_given(start), 0).otherwise(1)).over(upto))
    at = F.struct("line", "part")
    summary = [F.bool_and("valid").alias("valid")]
    for name, start in starts:
        after = F.when(_given(start), F.col("to_inside")).otherwise(F.col("to_outside"))
        summary += [F.max(f"rows_{name}").alias(f"rows_{name}"), F.max_by(after, at).alias(f"after_{name}")]
    blocks = lines.groupBy("file", "block").agg(*summary)
    blocks = _states(blocks, ["file"], ["block"], F.col("after_outside"), F.col("after_inside"))
    blocks = blocks.withColumn("start", _given(F.lit(False)))
    blocks = blocks.withColumn("rows", F.when(F.col("start"), F.col("rows_inside")).otherwise(F.col("rows_outside")))
    blocks = blocks.select(
        "file", "block", "start", before_block("rows").alias("offset"), F.min("valid").over(Window.partitionBy("file")).alias("valid_utf8")
    )
    here = F.when(F.col("start"), F.col("rows_inside")).otherwise(F.col("rows_outside"))
    placed = lines.join(blocks, ["file", "block"]).withColumn("row_number", F.col("offset") + here)
    bits = F.array_sort(F.collect_list(F.struct("block", "line", "part", "latin", "end")))
    rows = placed.groupBy("file", "row_number").agg(bits.alias("bits"), F.first("valid_utf8").alias("valid_utf8"))
    joined = F.concat_ws("", F.transform(F.slice("bits", 1, F.size("bits") - 1), lambda b: F.concat(b["latin"], b["end"])))
    whole = F.concat(joined, F.element_at("bits", -1)["latin"])
    return rows.select("file", "row_number", F.encode(whole, "ISO-8859-1").alias("raw"), "valid_utf8")


def _unquoted(cell: Column) -> Column:
    inner = F.substr(cell, F.lit(2), F.length(cell) - 2)
    return F.when(F.startswith(cell, F.lit('"')), F.replace(inner, F.lit('""'), F.lit('"'))).otherwise(cell)


def cells_of(row: Column, sep: str) -> Column:
    """Cells of a whole row; an empty row has none."""
    pieces = F.split(row, '"')
    outside = F.filter(pieces, lambda _, i: i % 2 == 0)
    last = F.size(outside) - 1
    # every quote begins or ends a cell or is doubled, and none is open
    edges = F.transform(
        outside,
        lambda p, i: ((p == "") & ((i == 0) | (i == last) | (F.size(pieces) > 1)))
        | ((F.startswith(p, F.lit(sep)) | (i == 0)) & (F.endswith(p, F.lit(sep)) | (i == last))),
    )
    regular = (F.size(pieces) % 2 == 1) & F.forall(edges, lambda x: x) & (F.instr(row, CUT) == 0)
    marked = F.array_join(F.transform(pieces, lambda p, i: F.when(i % 2 == 0, F.replace(p, F.lit(sep), F.lit(CUT))).otherwise(p)), '"')
    easy = F.transform(_split(marked, CUT), _unquoted)
    return (
        F.when(row == "", F.array().cast("array<string>"))
        .when(F.instr(row, '"') == 0, _split(row, sep))
        .when(regular, easy)
        .otherwise(_walked(pieces, sep))
    )


def _walked(pieces: Column, sep: str) -> Column:
    """Cells of a row with quotes at odd places: 0 start of a cell, 1 unquoted, 2 in quotes, 3 after a closing quote."""
    start = F.struct(F.lit(-1).alias("state"), F.array().cast("array<string>").alias("cells"), F.lit("").alias("cell"))

    def walk(acc: Column, piece: Column) -> Column:
        state = acc["state"]
        now = F.when(state < 0, 0).when(state == 0, 2).when(state == 2, 3).when(state == 3, 2).otherwise(1)
        cell = F.when(state.isin(1, 3), F.concat(acc["cell"], F.lit('"'))).otherwise(acc["cell"])
        parts = _split(piece, sep)
        n = F.size(parts)
        whole = (now == 2) | (piece == "") | (n == 1)
        ended = F.concat(acc["cells"], F.array(F.concat(cell, F.get(parts, F.lit(0)))), F.slice(parts, F.lit(2), F.greatest(n - 2, F.lit(0))))
        return F.struct(
            F.when((now == 2) | (piece == ""), now).when(F.endswith(piece, F.lit(sep)), 0).otherwise(1).alias("state"),
            F.when(whole, acc["cells"]).otherwise(ended).alias("cells"),
            F.when(whole, F.concat(cell, piece)).otherwise(F.element_at(parts, -1)).alias("cell"),
        )

    return F.aggregate(pieces, start, walk, lambda acc: F.concat(acc["cells"], F.array(acc["cell"])))


def read_delimited(
    spark: SparkSession, path: str | list[str], sep: str = "\t", encoding: str | None = None
) -> DataFrame:
    """Rows of cells: (file, row_number, cells). Rows are as wide as they are; a blank line is a row without cells.

    Without ``encoding`` a file is UTF-8 when every line is valid UTF-8, else cp1251. A row
    whose last quote is never closed takes the rest of its file. ``sep`` is one ASCII character.
    """
    rows = read_rows(spark, path, sep)
    utf8, raw = F.col("raw").cast("string"), F.col("raw")
    if encoding is None:
        line = F.when(F.col("valid_utf8"), utf8).otherwise(single_byte_text(raw))
    elif encoding.lower().replace("-", "") in ("utf8", "utf8sig"):
        line = utf8
    else:
        line = single_byte_text(raw, encoding)
    return rows.withColumn("text", line).select("file", "row_number", cells_of(F.col("text"), sep).alias("cells"))
