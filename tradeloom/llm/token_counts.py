"""Token counts of a byte-fallback BPE model by rank-synchronous array merging.

A batch of distinct units is one ragged array of symbols. In each round every sequence
looks up the ranks of its neighbouring pairs, and the lowest-ranked pair of each
sequence is merged in all sequences at once. What survives is counted. Only the
vocabulary is taken from the library; it encodes nothing here.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeloom.llm.common import CACHES, blocks, narrow, slices, texts_of, tidy
from tradeloom.llm.pieces import CACHE_ENTRIES, PieceTable, code_points, default_model, piece_table

NONE = np.iinfo(np.int32).max
#: equal hits of a sequence that may wait for each other before it is walked
WAITING = 16


class MergeTable:
    """Ranks of symbol pairs. Symbols past the vocabulary stand for unknown characters
    of one to four bytes, which never merge."""

    def __init__(self, table: PieceTable) -> None:
        self.table, self.width = table, table.size + 8
        levels = sorted(set(table.scores.values()), reverse=True)
        rank_of = {score: i for i, score in enumerate(levels)}
        rank = {p: rank_of[s] for p, s in table.scores.items()}
        rows = []
        for piece, i in table.ids.items():
            r = rank[piece]
            for cut in range(1, len(piece)):
                a, b = table.ids.get(piece[:cut]), table.ids.get(piece[cut:])
                if a is not None and b is not None:
                    rows.append((a * self.width + b, r, i))
        rows.sort()
        self.keys = np.array([r[0] for r in rows], np.int64)
        self.ranks = np.array([r[1] for r in rows], np.int32)
        self.made = np.array([r[2] for r in rows], np.int32)
        self.pairs: dict[int, tuple[int, int]] = {}
        self.symbol = np.empty(0x110000, np.int32)
        for low, high, n in ((0, 0x80, 1), (0x80, 0x800, 2), (0x800, 0x10000, 3), (0x10000, 0x110000, 4)):
            self.symbol[low:high] = table.size + n
        for piece, i in table.ids.items():
            if len(piece) == 1:
                self.symbol[ord(piece)] = i

    def count(self, units: list[str]) -> np.ndarray:
        """Tokens of every unit."""
        codes, lengths = code_points(units)
        counts = np.zeros(len(units), np.int64)
        if not len(codes):
            return counts
        symbols = self.symbol[codes]
        owner = np.repeat(np.arange(len(units)), lengths)
        first = self.table.breaks(codes)
        first |= np.diff(owner, prepend=-1) != 0
        unknown = symbols > self.table.size
        # bytes of unknown characters; all other characters start as one symbol each
        np.add.at(counts, owner[unknown], symbols[unknown] - self.table.size)
        np.add.at(counts, owner[~unknown], 1)
        seq = np.cumsum(first) - 1
        alone = np.bincount(seq)[seq] == 1
        symbols, owner, seq = symbols[~alone], owner[~alone], seq[~alone]
        if not len(symbols):
            return counts
        rank, made = self.lookup(symbols, seq, np.arange(len(symbols)))
        while True:
            start = np.flatnonzero(np.diff(seq, prepend=-1))
            lowest = np.repeat(np.minimum.reduceat(rank, start), np.diff(start, append=len(seq)))
            hit = np.flatnonzero((rank == lowest) & (rank != NONE))
            if not len(hit):
                return counts
            # of overlapping hits every other one merges, from the left
            run = np.cumsum((np.diff(hit, prepend=-9) != 1) | (np.diff(seq[hit], prepend=-1) != 0)) - 1
            run_start = np.flatnonzero(np.diff(run, prepend=-1))
            hit = hit[(np.arange(len(hit)) - run_start[run]) % 2 == 0]
            found = np.bincount(seq[hit], minlength=seq[-1] + 1)
            hit = hit[self.in_turn(symbols, seq, hit, made[hit], lowest[hit])]
            waiting = found - np.bincount(seq[hit], minlength=len(found)) > WAITING
            if waiting.any():  # merges that wait for each other, as in a run of spaces, are walked one by one
                left = waiting[seq]
                for part in np.split(np.flatnonzero(left), np.flatnonzero(np.diff(seq[left])) + 1):
                    counts[owner[part[0]]] -= self.walked(symbols[part].tolist())
                rest = ~left
                hit = (np.cumsum(rest) - 1)[hit[rest[hit]]]
                symbols, owner, seq, rank, made, lowest = (x[rest] for x in (symbols, owner, seq, rank, made, lowest))
                if not len(symbols):
                    return counts
            product = made[hit]
            symbols[hit] = product
            np.subtract.at(counts, owner[hit], 1)
            keep = lowest != NONE
            keep[hit + 1] = False
            changed = (np.cumsum(keep) - 1)[hit]
            symbols, owner, seq, rank, made = symbols[keep], owner[keep], seq[keep], rank[keep], made[keep]
            changed = np.concatenate([changed, changed[changed > 0] - 1])
            rank[changed], made[changed] = self.lookup(symbols, seq, changed)

    def walked(self, symbols: list[int]) -> int:
        """Merges in one sequence, by a heap of pairs: the lowest rank, then the leftmost, comes first."""
        if not self.pairs:
            self.pairs.update(zip(self.keys.tolist(), zip(self.ranks.tolist(), self.made.tolist())))
        pairs, width, n = self.pairs, self.width, len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        none, merges = (int(NONE), -1), 0
        heap = []
        for i in range(n - 1):
            rank, _ = pairs.get(symbols[i] * width + symbols[i + 1], none)
            if rank != none[0]:
                heap.append(rank << 40 | i)
        heapify(heap)
        while heap:
            top = heappop(heap)
            i = top & 0xFFFFFFFFFF
            j = after[i]
            if symbols[i] < 0 or j >= n:
                continue
            rank, made = pairs.get(symbols[i] * width + symbols[j], none)
            if rank != top >> 40:
                continue
            merges += 1
            symbols[i], symbols[j] = made, -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                rank, _ = pairs.get(made * width + symbols[k], none)
                if rank != none[0]:
                    heappush(heap, rank << 40 | i)
            h = before[i]
            if h >= 0:
                rank, _ = pairs.get(symbols[h] * width + made, none)
                if rank != none[0]:
                    heappush(heap, rank << 40 | h)
        return merges

    def in_turn(self, symbols: np.ndarray, seq: np.ndarray, hit: np.ndarray, product: np.ndarray, lowest: np.ndarray) -> np.ndarray:
        """Which hits of a sequence can merge at once, as they would from left to right.

        After a hit merges, its product forms a pair with what stands before it by then and
        one with what still stands after it. If one of these comes no later than the hits
        themselves, it is due before the next hit, so the later hits wait.
        """
        last = len(symbols) - 1
        after = np.minimum(hit + 2, last)
        right = np.where((hit + 2 <= last) & (seq[after] == seq[hit]), self.rank_of(product, symbols[after]), NONE)
        before = np.maximum(hit - 1, 0)
        merged = np.zeros(len(hit), bool)
        merged[1:] = hit[1:] == hit[:-1] + 2
        neighbour = np.where(merged, np.roll(product, 1), symbols[before])
        left = np.where((hit > 0) & (seq[before] == seq[hit]), self.rank_of(neighbour, product), NONE)
        due = np.minimum(left, right) <= lowest
        earlier = np.cumsum(due) - due
        start = np.flatnonzero(np.diff(seq[hit], prepend=-1))
        return earlier == np.repeat(earlier[start], np.diff(start, append=len(hit)))

    def rank_of(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        key = first.astype(np.int64) * self.width + second
        found = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[found] == key, self.ranks[found], NONE)

    def lookup(self, symbols: np.ndarray, seq: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and product of the pairs that start at the given places."""
        after = np.minimum(at + 1, len(symbols) - 1)
        key = symbols[at].astype(np.int64) * self.width + symbols[after]
        found = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        good = (self.keys[found] == key) & (seq[at] == seq[after]) & (after > at)
        return np.where(good, self.ranks[found], NONE), self.made[found]


@lru_cache(maxsize=4)
def merge_table(path: str) -> tuple[MergeTable, dict[str, int]]:
    return MergeTable(piece_table(path)), {}


CACHES["token_counts"] = merge_table.cache_clear


def count_texts(texts: list[str], path: str) -> list[int]:
    """Tokens of each text; counts of the first units met are remembered for later texts."""
    merges, known = merge_table(path)
    units = [merges.table.units(t) for t in texts]
    missing = [u for u in set(chain.from_iterable(units)) if u not in known]
    fresh: dict[str, int] = {}
    for a, b in blocks([len(u) for u in missing], 1 << 18):
        fresh.update(zip(missing[a:b], merges.count(missing[a:b]).tolist()))
    if len(known) < CACHE_ENTRIES:
        known.update(fresh)
        return [sum(map(known.__getitem__, u)) for u in units]
    return [sum([known[x] if x in known else fresh[x] for x in u]) for u in units]


def token_counts(documents: DataFrame, model_path: str | None = None, limit: int = 4096) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of every row.

    Null and empty text: no bytes and no tokens. Repeated rows and null ids are counted
    like any other row. Only ``doc_id`` and ``text`` are read, so extra columns of any
    name do no harm. No shuffle; a text of any length is counted whole.
    """
    path = model_path or default_model()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            counts = count_texts(texts_of(batch), path)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_bytes"), pa.array(counts, pa.int64())],
                ["doc_id", "n_bytes", "n_tokens"],
            )

    rows = narrow(documents, "doc_id", "text").withColumn(
        "n_bytes", F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint")
    )
    kind = rows.schema["doc_id"].dataType.simpleString()
    counted = rows.mapInArrow(tidy(run, "token_counts"), f"doc_id {kind}, n_bytes bigint, n_tokens bigint")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
