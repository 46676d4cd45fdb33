"""SimHash fingerprints, their links within a bit distance, and near-duplicate groups.

Routing: 64 bits are cut into ``distance + 2`` blocks. Two fingerprints within the
distance agree on two blocks at least, so each distinct fingerprint goes once for every
pair of blocks to the bucket of its bits there. A bucket of more than ``BUCKET`` rows is
cut into parts, and each pair of parts is one work item, so that no task holds it whole.

Index: a task sorts the fingerprints of a table by Gray rank, the bits of the table's
two blocks first. Runs of ``FAN`` neighbours become nodes; a node keeps the bits on which
all below it agree, without those that its parent already holds. A search adds up the
differing bits from the root down and drops a whole node once they exceed the distance.
Links found are united at once and leave the task as one edge a fingerprint, to the
smallest of its set; pairs are never written out.

Groups: the edges are contracted to stars in rounds of joins over tables in the shared
folder; nothing of them comes to the driver but counts.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradeloom.llm.common import narrow, slices, stored, texts_of, tidy

BUCKET = 4096
FAN = 8
FRONTIER = 1 << 16
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def fingerprint(text: str, shingle: int) -> int:
    """SimHash of the word shingles of a text; zero without words."""
    words = text.encode().translate(LOWER).split()
    if not words:
        return 0
    normal = b" ".join(words)
    if len(words) <= shingle:
        hashes = [xxhash.xxh64_intdigest(normal, 42)]
    else:
        stops = np.cumsum([len(w) + 1 for w in words]) - 1
        starts = np.concatenate([[0], stops[:-1] + 1])
        digest = xxhash.xxh64_intdigest
        hashes = [
            digest(normal[a:b], 42)
            for a, b in zip(starts[: len(words) - shingle + 1].tolist(), stops[shingle - 1 :].tolist())
        ]
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 4096):
        part = np.array(hashes[i : i + 4096], "<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(hashes), bitorder="little")
    return int(bits.view("<u8")[0])


def fingerprints(documents: DataFrame, shingle: int = 3, keep_text: bool = True) -> DataFrame:
    """All columns (``text`` only if asked) and ``bits``, the fingerprint as a signed 64-bit integer, of every row.

    Null texts are empty and have the fingerprint zero, like texts without words.
    """
    kept = [f for f in documents.schema.fields if f.name != "bits" and (keep_text or f.name != "text")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            bits = np.array([fingerprint(t, shingle) for t in texts_of(batch)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(f.name) for f in kept] + [pa.array(bits)], [f.name for f in kept] + ["bits"]
            )

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept] + ["bits bigint"])
    return documents.mapInArrow(tidy(run, "simhash"), schema)


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """Place of each code in the reflected Gray sequence."""
    rank = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


class GrayIndex:
    """Hierarchy over distinct codes in Gray order; ``levels`` go from the root to the codes."""

    def __init__(self, codes: np.ndarray) -> None:
        self.codes = codes[np.argsort(gray_rank(codes), kind="stable")]
        full = np.full(len(codes), np.uint64(0xFFFFFFFFFFFFFFFF))
        up = [(self.codes, full)]
        while len(up[-1][0]) > 1:
            pattern, mask = up[-1]
            start = np.arange(0, len(pattern), FAN)
            first = np.repeat(pattern[start], np.diff(start, append=len(pattern)))
            shared = np.bitwise_and.reduceat(mask & ~(pattern ^ first), start)
            up.append((pattern[start], shared))
        levels = []
        above = np.zeros(1, np.uint64)
        for pattern, mask in reversed(up):
            held = above if len(levels) == 0 else np.repeat(above, FAN)[: len(mask)]
            levels.append((pattern, mask & ~held))
            above = mask
        self.levels = levels

    def search(self, queries: np.ndarray, distance: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of (query place, code place) within the distance, in parts of bounded size."""
        stack = [(0, np.arange(len(queries)), np.zeros(len(queries), np.int64), np.zeros(len(queries), np.int64))]
        while stack:
            level, query, node, added = stack.pop()
            if len(query) > FRONTIER:
                half = len(query) // 2
                stack += [(level, *(x[half:] for x in (query, node, added))), (level, *(x[:half] for x in (query, node, added)))]
                continue
            pattern, mask = self.levels[level]
            added = added + np.bitwise_count((queries[query] ^ pattern[node]) & mask[node])
            near = added <= distance
            query, node, added = query[near], node[near], added[near]
            if level == len(self.levels) - 1:
                yield query, node
                continue
            below = len(self.levels[level + 1][0])
            child = (node[:, None] * FAN + np.arange(FAN)).ravel()
            query, added = np.repeat(query, FAN), np.repeat(added, FAN)
            real = child < below
            stack.append((level + 1, query[real], child[real], added[real]))


def united(roots: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Roots after uniting the sets of a and b; a root is the smallest place of its set."""
    while True:
        ra, rb = roots[a], roots[b]
        differ = ra != rb
        if not differ.any():
            return roots
        a, b, ra, rb = a[differ], b[differ], ra[differ], rb[differ]
        np.minimum.at(roots, np.maximum(ra, rb), np.minimum(ra, rb))
        while (up := roots[roots] != roots).any():
            roots[up] = roots[roots][up]


def local_edges(codes: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """For every code that has a link, itself and the first code of its set."""
    index = GrayIndex(codes)
    roots = np.arange(len(codes))
    for start in range(0, len(codes), 8192):
        for query, found in index.search(index.codes[start : start + 8192], distance):
            later = query + start > found
            roots = united(roots, (query + start)[later], found[later])
    at = np.flatnonzero(roots != np.arange(len(codes)))
    return index.codes[at], index.codes[roots[at]]


def tables(distance: int) -> list[list[tuple[int, int]]]:
    """For every pair of blocks the (first bit, width) of both."""
    n = distance + 2
    edges = [round(64 * i / n) for i in range(n + 1)]
    return [list(p) for p in combinations([(a, b - a) for a, b in zip(edges, edges[1:])], 2)]


def bits_of(parts: list[tuple[int, int]]) -> Column:
    """The bits of the given blocks side by side, as one integer."""
    out = F.lit(0).cast("bigint")
    for first, width in parts:
        piece = F.shiftrightunsigned(F.col("bits"), first).bitwiseAND(F.lit((1 << width) - 1).cast("bigint"))
        out = F.shiftleft(out, width).bitwiseOR(piece)
    return out


def links(codes: DataFrame, distance: int) -> DataFrame:
    """Edges (a, b) between distinct fingerprints ``bits`` that connect all that are within the distance.

    The table holds each fingerprint once. Buckets are counted first; the count of a
    bucket joins its rows through an exchange on both sides, which splits a hot bucket.
    """
    plans = tables(distance)
    keys = F.explode(F.array(*[F.struct(F.lit(i).alias("tab"), bits_of(p).alias("key")) for i, p in enumerate(plans)]))
    rows = codes.select("bits", keys.alias("k")).select("bits", "k.tab", "k.key")
    large = rows.groupBy("tab", "key").count().where(F.col("count") > BUCKET).select(
        "tab", "key", F.ceil(F.col("count") / BUCKET).cast("int").alias("parts")
    )
    sized = rows.join(stored(large, "buckets"), ["tab", "key"], "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    own = F.pmod(F.xxhash64("bits"), F.col("parts")).cast("int")
    pair = F.explode(F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda other: F.struct(
        F.least(F.col("own"), other).alias("low"), F.greatest(F.col("own"), other).alias("high")
    )))
    work = sized.withColumn("own", own).select("tab", "key", "bits", pair.alias("p")).select("tab", "key", "p.*", "bits")
    partitions = int(codes.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = [(b.column("tab").to_numpy(), b.column("bits").to_numpy()) for b in batches]
        if not seen:
            return
        tab, bits = (np.concatenate(x) for x in zip(*seen))
        for t in np.unique(tab):
            parts = plans[t]
            held = np.unique(bits[tab == t].view(np.uint64))
            turned = turn(held, parts)
            a, b = local_edges(turned, distance)
            back = np.argsort(turned)
            a, b = (held[back[np.searchsorted(turned, x, sorter=back)]].view(np.int64) for x in (a, b))
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    return work.repartition(partitions, "tab", "key", "low", "high").select("tab", "bits").mapInArrow(tidy(run, "simhash"), "a bigint, b bigint")


def turn(codes: np.ndarray, parts: list[tuple[int, int]]) -> np.ndarray:
    """Codes with the bits of the given blocks moved to the top; distances stay."""
    out, rest, left = np.zeros_like(codes), [], 0
    used = sorted(parts)
    for first, width in used:
        rest.append((left, first - left))
        left = first + width
    rest.append((left, 64 - left))
    for first, width in [*used, *rest]:
        if width:
            out = (out << np.uint64(width)) | ((codes >> np.uint64(first)) & np.uint64((1 << width) - 1))
    return out


def components(edges: DataFrame) -> DataFrame:
    """node and root (the smallest node of its component) of every node of the edges (a, b).

    Alternates between hanging larger neighbours and smaller neighbours of every node
    below its smallest one. Minima are summed up before the exchange, and the minima of a
    round are a table of their own, so that the edges of a node with very many
    neighbours can be split in the join.
    """
    now = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    mark = None
    while True:
        for large in (True, False):
            both = now.unionAll(now.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else now
            low = both.groupBy(F.col("a").alias("c")).agg(F.least(F.min("b"), F.first("a")).alias("low"))
            low = stored(low, "minima")
            joined = both.join(low, both["a"] == low["c"])
            if large:
                made = joined.where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
            else:
                made = joined.select(F.col("b").alias("a"), F.col("low").alias("b")).unionAll(
                    joined.where("b = low").select("a", "b")
                )
            now = stored(made.where("a <> b").distinct(), "edges")
        state = now.agg(F.count("*"), F.sum(F.col("a").cast("decimal(38,0)")), F.sum(F.col("b").cast("decimal(38,0)"))).first()
        if state == mark or not state[0]:
            break
        mark = state
    roots = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionAll(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def near_duplicates(documents: DataFrame, shingle: int = 3, distance: int = 3) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of every row.

    Rows are linked if their fingerprints differ in at most ``distance`` bits;
    ``component_id`` is the smallest doc_id that links lead to, itself included. Empty
    and null texts share the fingerprint zero. Null ids are never the smallest; a
    component of null ids only has a null id. Repeated rows each get their row. An empty
    table gives no row.
    """
    prints = stored(fingerprints(narrow(documents, "doc_id", "text"), shingle, keep_text=False), "prints")
    out = prints.join(groups(prints, distance), "bits")
    text = F.lpad(F.lower(F.hex("bits")), 16, "0")
    return out.select("doc_id", text.alias("fingerprint"), "component_id")


def groups(prints: DataFrame, distance: int) -> DataFrame:
    """bits, root (one fingerprint of its group) and component_id of every distinct fingerprint."""
    codes = stored(prints.groupBy("bits").agg(F.min("doc_id").alias("least")), "codes")
    roots = components(links(codes, distance))
    known = codes.join(roots, codes["bits"] == roots["node"], "left").select(
        "bits", "least", F.coalesce("root", "bits").alias("root")
    )
    known = stored(known, "roots")
    lowest = stored(known.groupBy("root").agg(F.min("least").alias("component_id")), "lowest")
    return stored(known.join(lowest, "root").select("bits", "root", "component_id"), "named")


def one_of_each(documents: DataFrame, shingle: int = 3, distance: int = 3) -> DataFrame:
    """The row with the smallest doc_id of every group of near-duplicates, with all its columns.

    Rows without an id stay only if their group has no id at all; of rows with the same
    id that with the smallest text stays. The other rows of a group leave before the
    exchange that brings its candidates together.
    """
    columns = [c for c in documents.columns if c != "bits"]
    rows = documents.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"), "text")
    wide = stored(fingerprints(rows, shingle, keep_text=False), "prints")
    named = groups(wide.select("row.doc_id", "bits"), distance).select(F.col("bits").alias("own_bits"), F.col("root").alias("group_root"))
    wide = wide.join(named, F.col("bits") == F.col("own_bits"))
    order = Window.partitionBy("group_root").orderBy(F.col("row.doc_id").asc_nulls_last(), F.col("row.text").asc_nulls_last())
    first = wide.withColumn("place", F.row_number().over(order)).where("place = 1")
    return first.select(*[F.col(f"row.`{c}`").alias(c) for c in columns])
