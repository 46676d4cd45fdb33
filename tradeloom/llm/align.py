"""Which tokens of two tokenizers stand for the same bytes of a text.

A tokenizer's token-byte incidence matrix has a row for each token and a one for each byte
the token covers. ``A B'``, taken row by row (Gustavson), links every token of A with the
tokens of B it shares bytes with; the values are the shared bytes. Byte offsets where
tokens of both end cut a text into groups; the product of the two token-group matrices
links all tokens of a group. Both kinds of matrix are compressed sparse rows held in plain
arrays.

Neither tokenizer joins a space that follows another character than white space with what
stands before it. A text is therefore cut there into units, and the matrices are made of
the distinct units of a block of documents; a document's numbers are sums over its units.
Documents by units times units by pairs, row by row again, says how often a document holds
a pair. A block hands this on in many small rows, so no task holds a large one.

The corpus-wide count of a linked pair of ids is the number of documents that hold it. A
block sends every distinct pair once, with its number of documents, and gets the summed
counts back, so that what is shuffled grows with blocks and vocabularies, not with tokens.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradeloom.llm.common import CACHES, blocks, slices, stored, texts_of, tidy
from tradeloom.llm.pieces import MARK, default_model, piece_table
from tradeloom.llm.token_files import default_tokenizer

UNITS = re.compile(r" [^ ]*(?:(?<=\s) [^ ]*)*")
BLOCK_BYTES = 4 << 20
CHUNK_BYTES = 1 << 18
PART_CHARS = 20_000
ROW_LINKS = 1 << 16
DOC_SIZE = 64  # of a document besides its text or links
#: a reader holds the rows of a row group at once
ROW_GROUP = {"parquet.block.row.count.limit": "8"}


@dataclass(frozen=True)
class Csr:
    """A sparse matrix by rows: ``columns[starts[i]:starts[i + 1]]`` and the values there belong to row i."""

    starts: np.ndarray
    columns: np.ndarray
    values: np.ndarray
    width: int

    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.starts) - 1), np.diff(self.starts))

    def transposed(self) -> Csr:
        order = np.argsort(self.columns, kind="stable")
        starts = np.concatenate([[0], np.cumsum(np.bincount(self.columns, minlength=self.width))])
        return Csr(starts, self.rows()[order], self.values[order], len(self.starts) - 1)


def incidence(lengths: np.ndarray) -> Csr:
    """Tokens by bytes, for tokens that follow each other."""
    starts = np.concatenate([[0], np.cumsum(lengths)])
    return Csr(starts, np.arange(starts[-1]), np.ones(starts[-1], np.int64), int(starts[-1]))


def membership(group: np.ndarray, groups: int) -> Csr:
    """Tokens by groups."""
    return Csr(np.arange(len(group) + 1), group, np.ones(len(group), np.int64), groups)


def product(a: Csr, b: Csr) -> Csr:
    """Gustavson's product: a row of the result is the sum of those rows of b that a's row names."""
    first, counts = b.starts[a.columns], b.starts[a.columns + 1] - b.starts[a.columns]
    total = int(counts.sum())
    at = np.repeat(first - (np.cumsum(counts) - counts), counts) + np.arange(total)
    rows, columns = np.repeat(a.rows(), counts), b.columns[at]
    values = np.repeat(a.values, counts) * b.values[at]
    key = rows * b.width + columns
    if total and (key[1:] < key[:-1]).any():
        order = np.argsort(key, kind="stable")
        key, rows, columns, values = key[order], rows[order], columns[order], values[order]
    new = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if total else np.empty(0, np.int64)
    summed = np.add.reduceat(values, new) if total else values
    starts = np.concatenate([[0], np.cumsum(np.bincount(rows[new], minlength=len(a.starts) - 1))])
    return Csr(starts, columns[new], summed, b.width)


@dataclass(frozen=True)
class Links:
    """Two token sequences over the same bytes.

    ``overlap`` has a row for each token of A, a column for each of B and the shared bytes
    as values; ``group_a`` and ``group_b`` are the group of each token.
    """

    a: np.ndarray
    b: np.ndarray
    overlap: Csr
    group_a: np.ndarray
    group_b: np.ndarray
    groups: int

    def shared(self) -> Csr:
        """Links between all tokens of a group; as many as the products of the groups' sizes."""
        return product(membership(self.group_a, self.groups), membership(self.group_b, self.groups).transposed())


def linked(a: np.ndarray, a_bytes: np.ndarray, b: np.ndarray, b_bytes: np.ndarray) -> Links:
    """Links of two sequences of ids whose tokens have so many bytes."""
    overlap = product(incidence(a_bytes), incidence(b_bytes).transposed())
    a_ends, b_ends = np.cumsum(a_bytes), np.cumsum(b_bytes)
    common = np.intersect1d(a_ends, b_ends, assume_unique=True)
    return Links(a, b, overlap, np.searchsorted(common, a_ends), np.searchsorted(common, b_ends), len(common))


def byte_alphabet() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary: printable ones for themselves."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    out = {chr(b): b for b in plain}
    return out | {chr(256 + k): b for k, b in enumerate(x for x in range(256) if x not in set(plain))}


class Aligner:
    """A byte-level tokenizer (A) and a SentencePiece model (B) over the same text with a space before it."""

    def __init__(self, byte_path: str, piece_path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core; threads hold memory of their own
        from tokenizers import Tokenizer

        self.byte, self.pieces = Tokenizer.from_file(byte_path), piece_table(piece_path)
        self.byte.no_truncation()
        self.byte.no_padding()
        self.byte.encode_special_tokens = True
        with open(byte_path, encoding="utf-8") as f:
            config = json.load(f)
        pre = config["pre_tokenizer"] or {}
        self.by_units = self.pieces.marks_split and config["normalizer"] is None and pre.get("type") == "ByteLevel" and (
            pre.get("use_regex", True) and not pre.get("add_prefix_space", True) and all(t["special"] for t in config["added_tokens"])
        )
        letters, size = byte_alphabet(), self.byte.get_vocab_size()
        self.a_bytes = [b""] * size
        for token, i in self.byte.get_vocab().items():
            known = all(c in letters for c in token)
            self.a_bytes[i] = bytes(letters[c] for c in token) if known else token.encode()
        for t in config["added_tokens"]:
            self.a_bytes[t["id"]] = t["content"].encode()
        self.b_bytes = [p.replace(MARK, " ").encode() for p in self.pieces.pieces]
        for value, i in self.pieces.byte_ids.items():
            self.b_bytes[i] = bytes([value])
        self.a_sizes, self.b_sizes = (np.fromiter(map(len, x), np.int64, len(x)) for x in (self.a_bytes, self.b_bytes))
        names = [str(i) for i in range(max(size, len(self.b_bytes)))]
        self.names = {end: np.array([n + end for n in names], object) for end in ",|;"}
        mark = MARK.encode()
        self.mark_ids = [self.pieces.ids[MARK]] if MARK in self.pieces.ids else [self.pieces.byte_ids[b] for b in mark]

    def units(self, text: str) -> list[str]:
        """The text with a space before it, cut into units that both tokenizers encode apart."""
        return UNITS.findall(" " + text) if self.by_units else [" " + text]

    def encoded(self, units: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of A and of B for every unit, the latter for what comes after its space, which the model adds."""
        a = [e.ids for e in self.byte.encode_batch_fast(units, add_special_tokens=False)]
        b = self.pieces.processor.encode([u[1:] for u in units])
        return a, [ids if len(u) > 1 else self.mark_ids for u, ids in zip(units, b)]

    def tokens(self, units: list[str]) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray]]:
        """Places of the units that both give back byte by byte, their ids and their numbers of tokens.

        Units that end in no white space are encoded end to end and cut by their bytes.
        """
        joined = [k for k, u in enumerate(units) if self.by_units and MARK not in u and not u[-1].isspace()]
        apart = [k for k, u in enumerate(units) if MARK not in u and (not self.by_units or u[-1].isspace())]
        own, ids, sizes = [], ([], []), ([], [])
        parts = [joined[a:b] for a, b in blocks([len(units[k]) for k in joined], PART_CHARS)]
        texts = ["".join([units[k] for k in part]) for part in parts]
        encoded = zip(parts, texts, *self.encoded(texts)) if parts else ()
        for part, text, a, b in encoded:
            ends = np.cumsum(np.fromiter((len(units[k].encode()) for k in part), np.int64, len(part)))
            found = [np.array(x, np.int64) for x in (a, b)]
            reach = [np.cumsum(size[x]) for size, x in zip((self.a_sizes, self.b_sizes), found)]
            stops = [np.searchsorted(r, ends) for r in reach]
            if self.matches(text, a, b) and all((r[x] == ends).all() for r, x in zip(reach, stops)):
                own.append(np.array(part, np.int64))
                for k in range(2):
                    ids[k].append(found[k])
                    sizes[k].append(np.diff(stops[k] + 1, prepend=0))
            else:
                apart += part
        for k, u, a, b in zip(apart, [units[k] for k in apart], *self.encoded([units[k] for k in apart])) if apart else ():
            if self.matches(u, a, b):
                own.append(np.array([k]))
                for j, x in enumerate((a, b)):
                    ids[j].append(np.array(x, np.int64))
                    sizes[j].append(np.array([len(x)]))
        none = [np.empty(0, np.int64)]
        return np.concatenate(own or none), [np.concatenate(x or none) for x in ids], [np.concatenate(x or none) for x in sizes]

    def matches(self, unit: str, a: list[int], b: list[int]) -> bool:
        raw = unit.encode()
        return b"".join(map(self.a_bytes.__getitem__, a)) == raw == b"".join(map(self.b_bytes.__getitem__, b))

    def links(self, text: str) -> Links | None:
        """Links of one text; None if it is empty or a tokenizer does not give back its bytes."""
        units = self.units(text) if text else []
        a, b = self.encoded(units) if units else ([], [])
        if not units or not all(map(self.matches, units, a, b)):
            return None
        ids = [np.fromiter((i for x in lists for i in x), np.int64) for lists in (a, b)]
        return linked(ids[0], self.a_sizes[ids[0]], ids[1], self.b_sizes[ids[1]])

    def aligned(self, units: list[str]) -> Units:
        """Numbers, linked id pairs and group text of every unit."""
        out = Units(len(units))
        for lo, hi in blocks([len(u) for u in units], CHUNK_BYTES):
            own, ids, sizes = self.tokens(units[lo:hi])
            if not len(own):
                continue
            own += lo
            found = linked(ids[0], self.a_sizes[ids[0]], ids[1], self.b_sizes[ids[1]])
            unit_a, unit_b = (np.repeat(own, n) for n in sizes)
            per_a, per_b = (np.bincount(g, minlength=found.groups) for g in (found.group_a, found.group_b))
            unit_g = unit_a[np.searchsorted(found.group_a, np.arange(found.groups))]
            rows = found.overlap.rows()
            out.fine[own] = True
            out.n_a[own], out.n_b[own] = sizes
            for sums, unit, weights in (
                (out.n_groups, unit_g, None), (out.n_links, unit_a[rows], None), (out.n_shared, unit_g, per_a * per_b)
            ):
                sums[lo:hi] += np.bincount(unit - lo, weights, minlength=hi - lo).astype(np.int64)
            out.link_units.append(unit_a[rows])
            out.link_pairs.append((found.a[rows] << 32) | found.b[found.overlap.columns])
            self.name_groups(out, own, found, sizes, per_a, per_b)
        return out

    def name_groups(self, out: Units, own: np.ndarray, found: Links, sizes: list, per_a: np.ndarray, per_b: np.ndarray) -> None:
        """Group text ``a1,a2|b1;a3|b2`` of every unit; each id comes with the sign after it."""
        order = np.empty(len(found.a) + len(found.b), object)
        for ids, group, last, before in (
            (found.a, found.group_a, "|", np.concatenate([[0], np.cumsum(per_b)])),
            (found.b, found.group_b, ";", np.cumsum(per_a)),
        ):
            final = np.append(group[1:] != group[:-1], True)
            order[np.arange(len(ids)) + before[group]] = np.where(final, self.names[last][ids], self.names[","][ids])
        words, start = order.tolist(), 0
        for u, n in zip(own.tolist(), (sizes[0] + sizes[1]).tolist()):
            out.groups[u] = "".join(words[start : start + n])[:-1]
            start += n


class Units:
    def __init__(self, n: int) -> None:
        self.fine = np.zeros(n, bool)
        self.n_a, self.n_b, self.n_groups, self.n_links, self.n_shared = (np.zeros(n, np.int64) for _ in range(5))
        self.groups: list[str] = [""] * n
        self.link_units: list[np.ndarray] = []
        self.link_pairs: list[np.ndarray] = []


@lru_cache(maxsize=2)
def aligner(byte_path: str, piece_path: str) -> Aligner:
    return Aligner(byte_path, piece_path)


CACHES["align"] = aligner.cache_clear
NUMBERS = ("n_a", "n_b", "n_groups", "n_links", "n_shared")
ROWS = "block bigint, pairs array<bigint>, docs array<bigint>, starts binary, places binary, times binary, " \
    "doc_id array<bigint>, " + ", ".join(f"{c} array<bigint>" for c in NUMBERS) + ", groups_sha256 array<string>"


def summed(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sums of consecutive parts, which may be empty."""
    total = np.concatenate([[0], np.cumsum(values)])
    return total[starts[1:]] - total[starts[:-1]]


def counted(keys: np.ndarray, of: int, width: int) -> Csr:
    """From keys ``row * width + column``: how often each column is in each row."""
    distinct, times = np.unique(keys, return_counts=True)
    starts = np.searchsorted(distinct, np.arange(of + 1) * max(width, 1))
    return Csr(starts, distinct % max(width, 1), times, max(width, 1))


def block_rows(tool: Aligner, number: int, doc_ids: list, docs: list[np.ndarray], names: list[str]) -> Iterator[pa.RecordBatch]:
    """Everything about a block but the corpus-wide counts. ``docs`` are the units of each document, in order.

    The documents by pairs matrix is cut into rows of at most ``ROW_LINKS`` links (one document
    at least), so that none is large; the first has the block's pairs and their numbers of documents.
    """
    units = tool.aligned(names)
    lengths = np.fromiter(map(len, docs), np.int64, len(docs))
    owner, used = np.repeat(np.arange(len(docs)), lengths), np.concatenate([*docs, np.empty(0, np.int64)]).astype(np.int64)
    void = np.bincount(owner[~units.fine[used]], minlength=len(docs)) > 0
    texts = [
        "" if v or not len(d) else hashlib.sha256(";".join([units.groups[u] for u in d.tolist()]).encode()).hexdigest()
        for d, v in zip(docs, void.tolist())
    ]
    units.groups.clear()
    kept = ~void[owner]
    owner, used = owner[kept], used[kept]
    edges = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(docs)))])
    numbers = {c: summed(getattr(units, c)[used], edges) for c in NUMBERS}
    by_unit = np.concatenate([*units.link_units, np.empty(0, np.int64)]).astype(np.int64)
    linked_pairs = np.concatenate([*units.link_pairs, np.empty(0, np.int64)])
    # a pair whose only documents are void has no count
    held = np.zeros(len(names), bool)
    held[used] = True
    held = held[by_unit]
    pairs, place = np.unique(linked_pairs[held], return_inverse=True)
    of_units = counted(by_unit[held] * max(len(pairs), 1) + place, len(names), len(pairs))
    often, parts = np.zeros(len(pairs), np.int64), []
    for lo, hi in blocks((numbers["n_links"] + DOC_SIZE).tolist(), ROW_LINKS):
        inner = slice(edges[lo], edges[hi])
        found = product(counted((owner[inner] - lo) * len(names) + used[inner], hi - lo, len(names)), of_units)
        often += np.bincount(found.columns, minlength=len(pairs))
        parts.append((lo, hi, [x.astype("<u4").tobytes() for x in (found.starts, found.columns, found.values)]))
    big = pa.list_(pa.int64())
    for k, (lo, hi, raw) in enumerate(parts):
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([number], pa.int64()), *[pa.array([None if k else x], big) for x in (pairs, often)],
                *[pa.array([x], pa.binary()) for x in raw], pa.array([doc_ids[lo:hi]], big),
                *[pa.array([numbers[c][lo:hi]], big) for c in NUMBERS], pa.array([texts[lo:hi]], pa.list_(pa.string())),
            ],
            ["block", "pairs", "docs", "starts", "places", "times", "doc_id", *NUMBERS, "groups_sha256"],
        )


def aligned_blocks(documents: DataFrame, byte_path: str, piece_path: str) -> DataFrame:
    """The rows of each block of at most ``BLOCK_BYTES`` of text (one document at least)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        tool, number = aligner(byte_path, piece_path), TaskContext.get().partitionId() << 32
        ids, docs, known, size = [], [], {}, 0
        for batch in slices(batches, limit=CHUNK_BYTES):
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts_of(batch)):
                if ids and size + len(text) > BLOCK_BYTES:
                    yield from block_rows(tool, number, ids, docs, list(known))
                    ids, docs, known, size, number = [], [], {}, 0, number + 1
                words = tool.units(text) if text else []
                ids.append(doc_id)
                docs.append(np.fromiter((known.setdefault(w, len(known)) for w in words), np.int32, len(words)))
                size += len(text) + DOC_SIZE
        if ids:
            yield from block_rows(tool, number, ids, docs, list(known))

    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(tidy(run, "align"), ROWS)


def pair_counts(blocks_of: DataFrame) -> DataFrame:
    """pair (A's id times 2**32 plus B's), the documents that hold it, and whether no pair of its A id has more."""
    found = blocks_of.select(F.explode(F.arrays_zip("pairs", "docs")).alias("x")).select("x.pairs", "x.docs").where("docs > 0")
    total = found.groupBy(F.col("pairs").alias("pair")).agg(F.sum("docs").alias("count"))
    # at most as many rows an A id as B has ids
    most = F.max("count").over(Window.partitionBy(F.shiftright("pair", 32)))
    return total.select("pair", "count", (F.col("count") == most).alias("best"))


def align(documents: DataFrame, byte_path: str | None = None, piece_path: str | None = None) -> DataFrame:
    """Token alignment of every whole text with corpus-wide counts of linked id pairs.

    Returns ``doc_id``, tokens (``n_a``, ``n_b``), ``n_groups``, overlap links ``n_links``,
    links within groups ``n_shared``, ``n_best`` (overlap links whose pair is in as many
    documents as any pair of its A id), ``count_sum`` (those numbers of documents over all
    overlap links) and ``groups_sha256`` of ``a1,a2|b1;a3|b2``. ``Aligner.links`` gives the
    links of a text themselves.

    Reads ``doc_id`` and ``text``; other columns are left out, whatever their names. Null and
    empty texts, and texts that a tokenizer does not give back byte by byte, have zeros and
    an empty hash and count nowhere. Every row is a document, repeated or not; null ids stay
    null; an empty table gives no row.
    """
    made = stored(aligned_blocks(documents, byte_path or default_tokenizer(), piece_path or default_model()), "aligned", ROW_GROUP)
    asked = made.select("block", F.posexplode("pairs").alias("place", "pair"))
    answers = asked.join(pair_counts(made), "pair").groupBy("block").agg(F.array_sort(F.collect_list(F.struct("place", "count", "best"))).alias("told"))
    told = answers.select("block", F.col("told.count").alias("count"), F.col("told.best").alias("best"))
    both = made.drop("pairs", "docs").join(told, "block", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c).slice(i, 1) for c in batch.schema.names}
                starts, places, times = (np.frombuffer(row[c][0].as_buffer(), "<u4").astype(np.int64) for c in ("starts", "places", "times"))
                told = (row[c].flatten().to_numpy(zero_copy_only=False).astype(np.int64) for c in ("best", "count"))
                sums = [pa.array(summed(values[places] * times, starts)) for values in told]
                columns = [row[c].flatten() for c in ("doc_id", *NUMBERS)]
                yield pa.RecordBatch.from_arrays(
                    [*columns, *sums, row["groups_sha256"].flatten()], ["doc_id", *NUMBERS, "n_best", "count_sum", "groups_sha256"]
                )

    out = ", ".join(f"{c} bigint" for c in ("doc_id", *NUMBERS, "n_best", "count_sum"))
    # an owner of its own: these tasks need no tokenizers
    return both.mapInArrow(tidy(run, "align_counts"), f"{out}, groups_sha256 string")
