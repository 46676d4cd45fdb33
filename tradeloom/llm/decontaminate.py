"""Passages of a benchmark inside documents, by one Aho-Corasick automaton.

Benchmark texts become windows of consecutive normalised words. All windows form one
automaton; a document is normalised and scanned once, and hits are mapped back to its
words and to offsets in the text as it was. Normalising lower-cases A-Z, takes runs of
letters, digits and non-ASCII characters as words and joins them by one space.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeloom.llm.common import narrow, slices, texts_of, tidy

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
# one byte for each byte: A-Z to a-z, all other ASCII that is in no word to the space
TABLE = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)
AUTOMATON_BYTES = 64 << 20


def normal_words(text: str) -> list[bytes]:
    return text.encode().translate(TABLE).split()


def windows(text: str, size: int) -> set[bytes]:
    words = normal_words(text)
    if not words:
        return set()
    return {b" %b " % b" ".join(words[i : i + size]) for i in range(max(len(words) - size, 0) + 1)}


def lowered(text: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def merge(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


class Scanner:
    """The automaton over (window, items that have it). Bytes stand for characters one to one."""

    def __init__(self, patterns: list[tuple[bytes, tuple]]) -> None:
        self.items = [items for _, items in patterns]
        self.words = [p.count(b" ") - 1 for p, _ in patterns]
        self.lengths = [len(p) for p, _ in patterns]
        self.automaton = ahocorasick.Automaton()
        for i, (p, _) in enumerate(patterns):
            self.automaton.add_word(p.decode("latin-1"), i)
        if patterns:
            self.automaton.make_automaton()

    def scan(self, text: str) -> tuple[int, list[tuple[int, int]], set]:
        """Number of words, word ranges hit (merged, end exclusive) and items found."""
        words = normal_words(text)
        if not words or not self.items:
            return len(words), [], set()
        normal = b" %b " % b" ".join(words)
        ranges, found, spaces = [], set(), None
        for end, which in self.automaton.iter(normal.decode("latin-1")):
            if spaces is None:
                spaces = np.flatnonzero(np.frombuffer(normal, np.uint8) == 32)
            first = int(np.searchsorted(spaces, end - self.lengths[which] + 1))
            ranges.append((first, first + self.words[which]))
            found.update(self.items[which])
        return len(words), merge(ranges), found


@lru_cache(maxsize=2)
def scanner(key: str, patterns: tuple) -> Scanner:
    return Scanner(list(patterns))


SCHEMA = (
    "n_words bigint, n_hit bigint, items array<string>, word_spans array<struct<first:bigint,last:bigint>>, "
    "char_spans array<struct<start:bigint,stop:bigint>>"
)


def contamination(
    documents: DataFrame, benchmark: DataFrame, window: int = 10, automaton_bytes: int = AUTOMATON_BYTES
) -> DataFrame:
    """All columns of every document and what of the benchmark occurs in it.

    Added columns: ``n_words``, ``n_hit`` (words inside any hit), ``items`` (ids of items
    with a hit, as sorted strings), ``word_spans`` (first and last word of merged hits,
    from 0) and ``char_spans`` (their code points in the text as it was, stop excluded).
    An item of fewer words than ``window`` is one window; one without words is never
    found. Null texts have no words, null item ids no name but their hits count; repeated
    rows are answered one by one. Columns of the document that clash with an added one
    are replaced. If the windows outgrow ``automaton_bytes``, documents are scanned by
    several automata, one after another, and the hits are united.
    """
    items = narrow(benchmark, "item_id", "text").where(F.col("text").isNotNull()).withColumn(
        "item_id", F.col("item_id").cast("string")
    )
    size = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0] * window
    shards = max(1, -(-int(size) // automaton_bytes))
    names = ["n_words", "n_hit", "items", "word_spans", "char_spans"]
    out = documents.drop(*names)
    parts = [items.where(F.pmod(F.xxhash64("text"), F.lit(shards)) == s) if shards > 1 else items for s in range(shards)]
    for number, part in enumerate(parts):
        patterns: dict[bytes, set] = {}
        for row in part.collect():  # at most automaton_bytes
            for w in windows(row["text"], window):
                patterns.setdefault(w, set()).add(row["item_id"])
        out = scanned(out, patterns, number > 0)
    return out


def scanned(documents: DataFrame, patterns: dict[bytes, set], more: bool) -> DataFrame:
    """Documents with the hits of one automaton, united with those of earlier ones."""
    frozen = tuple(sorted((p, tuple(i for i in s if i is not None)) for p, s in patterns.items()))
    key = hashlib.sha256(repr(frozen).encode()).hexdigest()
    sent = documents.sparkSession.sparkContext.broadcast(frozen)
    earlier = ["items", "word_spans"] if more else []
    kept = [f for f in documents.schema.fields if not more or f.name not in ("n_words", "n_hit", "items", "word_spans", "char_spans")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = scanner(key, sent.value)
        for batch in slices(batches):
            texts = texts_of(batch)
            columns = {n: [] for n in ("n_words", "n_hit", "items", "word_spans", "char_spans")}
            before = [batch.column(c).to_pylist() for c in earlier]
            for i, text in enumerate(texts):
                n, ranges, found = tool.scan(text)
                if earlier:
                    found |= set(before[0][i])
                    ranges = merge(ranges + [(s["first"], s["last"] + 1) for s in before[1][i]])
                places = [m.span() for m in WORD.finditer(lowered(text))] if ranges else []
                columns["n_words"].append(n)
                columns["n_hit"].append(sum(b - a for a, b in ranges))
                columns["items"].append(sorted(found))
                columns["word_spans"].append([{"first": a, "last": b - 1} for a, b in ranges])
                columns["char_spans"].append([{"start": places[a][0], "stop": places[b - 1][1]} for a, b in ranges])
            types = [
                pa.int64(), pa.int64(), pa.list_(pa.string()),
                pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())])),
                pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())])),
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(f.name) for f in kept] + [pa.array(v, t) for v, t in zip(columns.values(), types)],
                [f.name for f in kept] + list(columns),
            )

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept] + [SCHEMA])
    return documents.mapInArrow(tidy(run, "decontaminate"), schema)
