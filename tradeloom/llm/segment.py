"""N-best segmentation into the pieces of a SentencePiece model, and decoding.

The score of a segmentation is the sum of its pieces' scores in the model file; a
character that is no piece costs ten more than the lowest score and becomes byte pieces.
Forward Viterbi gives the best score up to each place; it is the exact heuristic of an
A-star search that runs backward from the end, so hypotheses leave the agenda in the
order of their full scores. Units (see ``pieces``) fall into parts, and the n best of a
text are the n best choices among the lists of its parts. Only the n - 1 parts whose
second best loses least can differ from their best, so the forward pass of all parts,
side by side, also keeps the score of the second best path, and the A-star search lists
the candidates of those few parts, and the best of parts with several of equal score.
What is known of a part or unit is a row of arrays, so that a text is put together by
gathers over its units' numbers, and what a worker remembers takes little memory.
"""

from __future__ import annotations

from bisect import insort
from collections.abc import Iterator
from functools import lru_cache
from heapq import heappop, heappush
from itertools import chain, islice
from struct import pack

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeloom.llm.common import CACHES, slices, texts_of, tidy
from tradeloom.llm.pieces import CACHE_ENTRIES, MARK, PieceTable, code_points, default_model, piece_table

Candidate = tuple[float, bytes]
# bytes of text that are worked on at once
SLICE_BYTES = 1 << 19
# above the rounding of sums of scores
SLACK = 1e-6
# parts that go forward side by side, and the most characters of one; longer ones go one by one
ABREAST, LONG = 4096, 64


class NumberTable:
    """Distinct keys of 0 or more with a number each, looked up for whole arrays at once."""

    def __init__(self, keys: np.ndarray, numbers: np.ndarray) -> None:
        bits = (4 * len(keys) + 4).bit_length()
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.numbers = np.full(1 << bits, -1, np.int64), np.full(1 << bits, -1, np.int32)
        slot = self.first(keys)
        while len(keys):
            free = self.keys[slot] < 0
            self.keys[slot[free]] = keys[free]  # of several the last one stays
            put = self.keys[slot] == keys
            self.numbers[slot[put]] = numbers[put]
            keys, numbers, slot = keys[~put], numbers[~put], (slot[~put] + 1) & self.mask

    def first(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The numbers of the keys, -1 for others."""
        slot = self.first(keys)
        there = self.keys[slot]
        out = np.where(there == keys, self.numbers[slot], -1)
        at = np.flatnonzero((there != keys) & (there >= 0))
        while len(at):
            slot[at] = (slot[at] + 1) & self.mask
            there = self.keys[slot[at]]
            hit = there == keys[at]
            out[at[hit]] = self.numbers[slot[at[hit]]]
            at = at[~hit & (there >= 0)]
        return out


class Lattice:
    """The pieces of a model by their text, with all their prefixes to stop at."""

    def __init__(self, table: PieceTable) -> None:
        self.table = table
        self.unknown = min(table.scores.values()) - 10
        # a prefix that is no piece has an empty entry
        self.arcs: dict[str, tuple] = {}
        for piece, number in table.ids.items():
            for cut in range(1, len(piece)):
                self.arcs.setdefault(piece[:cut], ())
            self.arcs[piece] = (table.scores[piece], (number,))
        # the same as a trie of arrays: node 0 is the empty prefix, a step is (node, character) -> node
        node = {"": 0} | {prefix: i for i, prefix in enumerate(self.arcs, 1)}
        steps = np.array([(node[x[:-1]] << 21) | ord(x[-1]) for x in self.arcs], np.int64)
        self.steps = NumberTable(steps, np.arange(1, len(node), dtype=np.int32))
        self.number = np.array([-1, *(arc[1][0] if arc else -1 for arc in self.arcs.values())], np.int64)
        self.score = np.array([0.0, *(arc[0] if arc else 0.0 for arc in self.arcs.values())])
        self.grows = np.zeros(len(node), bool)
        self.grows[steps >> 21] = True

    def forward(self, unit: str) -> tuple[list[float], list[list]]:
        """Best score up to each place, and the arcs that end there: start, (score, ids)."""
        arc_of, size = self.arcs.get, len(unit)
        best = [0.0] + [float("-inf")] * size
        ends: list[list] = [[] for _ in range(size + 1)]
        for i in range(size):
            here = best[i]
            arc = arc_of(unit[i]) or (self.unknown, tuple(self.table.byte_ids[b] for b in unit[i].encode()))
            j = i + 1
            while arc is not None:
                if arc:
                    ends[j].append((i, arc))
                    score = here + arc[0]
                    if score > best[j]:
                        best[j] = score
                j += 1
                if j > size:
                    break
                arc = arc_of(unit[i:j])
        return best, ends

    def side_by_side(self, units: list[str]) -> tuple[np.ndarray, ...]:
        """All arcs of the units: score, piece, start and end, by place in the unit and end, of one end by start.

        Starts and ends are nodes, of which a unit has one more than characters. Also where in
        the arcs each place begins, the first node of each unit, and whether all its characters are pieces.
        """
        codes, sizes = code_points(units)
        codes = codes.astype(np.int64)
        row = np.repeat(np.arange(len(units)), sizes)
        begin = np.cumsum(sizes) - sizes
        place = np.arange(len(codes)) - begin[row]
        left = sizes[row] - place
        at, state, length, found = np.arange(len(codes)), np.zeros(len(codes), np.int64), 0, []
        plain = np.ones(len(units), bool)
        while len(at):
            state = self.steps.find((state << 21) | codes[at + length]).astype(np.int64)
            hit = state >= 0
            at, state = at[hit], state[hit]
            length += 1
            is_piece = self.number[state] >= 0
            if length == 1:
                plain = np.bincount(row[at[is_piece]], minlength=len(units)) == sizes
            found.append((at[is_piece], state[is_piece], np.full(int(is_piece.sum()), length)))
            go = self.grows[state] & (left[at] > length)
            at, state = at[go], state[go]
        at, state, size = map(np.concatenate, zip(*found))
        start, depth = at + row[at], place[at] + size
        order = np.argsort((depth * (len(codes) + len(units)) + start + size) * (length + 1) - size)
        bounds = np.searchsorted(depth[order], np.arange(1, int(sizes.max()) + 2))
        score, piece, start, size = self.score[state[order]], self.number[state[order]], start[order], size[order]
        return score, piece, start, start + size, bounds, begin + np.arange(len(units)), plain

    def forward_all(self, units: list[str]) -> tuple[np.ndarray, ...]:
        """Best score of each unit, what the second best loses, the number of its ids, and all ids in a row.

        A unit has no ids here if more than one is best or a character is no piece.
        """
        score, piece, start, end, bounds, first, plain = self.side_by_side(units)
        sizes = np.fromiter(map(len, units), np.int64, len(units))
        best, second = np.full((2, int(first[-1] + sizes[-1]) + 1), -np.inf)
        best[first] = 0
        via = np.zeros(len(best), np.int64)
        for a, b in zip(bounds.tolist(), bounds[1:].tolist()):
            if a == b:
                continue
            heads = np.flatnonzero(np.diff(end[a:b], prepend=-1))
            ends, count = end[a:b][heads], np.diff(heads, append=b - a)
            total, other = best[start[a:b]] + score[a:b], second[start[a:b]] + score[a:b]
            most = np.maximum.reduceat(total, heads)
            top = np.flatnonzero(total == np.repeat(most, count))
            chosen = top[np.searchsorted(top, heads)]
            total[chosen] = other[chosen]  # of the chosen arc only its second path is left
            best[ends], second[ends], via[ends] = most, np.maximum.reduceat(total, heads), chosen + a
        last = first + sizes
        loss = np.where(plain, best[last], 0.0) - second[last]
        sure = plain & (loss > SLACK)
        unit, at = np.flatnonzero(sure), last[sure]
        after, steps = np.zeros(len(units)), []
        while len(unit):
            arc = via[at]
            after[unit] += score[arc]
            steps.append((unit, piece[arc]))
            at = start[arc]
            go = at > first[unit]
            unit, at = unit[go], at[go]
        if not steps:
            return after, loss, np.zeros(len(units), np.int64), np.zeros(0, np.uint32)
        unit, ids = map(np.concatenate, zip(*reversed(steps)))
        ids = ids[np.argsort(unit, kind="stable")].astype(np.uint32)
        return after, loss, np.bincount(unit, minlength=len(units)), ids

    def search(self, unit: str, n: int) -> list[tuple[float, list[int]]]:
        """The n best segmentations of a unit, best first; those of equal score in a fixed order.

        As the heuristic is exact, each hypothesis is the cost of a whole path: the one of its
        parent goes on, every other is a new path. What costs more than n paths met can't be found.
        """
        best, ends = self.forward(unit)
        agenda: list[tuple] = [(-best[-1], 0, len(unit), 0.0, None)]
        costs, limit = [-best[-1]], -best[-1] + SLACK if n == 1 else float("inf")
        order, found = 0, []
        while agenda:
            cost, _, at, after, tail = heappop(agenda)
            if not at:
                ids: list[int] = []
                while tail:
                    ids += tail[0]
                    tail = tail[1]
                found.append((-cost, ids))
                if len(found) == n:
                    break
                continue
            goes_on = False
            for i, arc in ends[at]:
                order += 1
                total = after + arc[0]
                new = -(best[i] + total)
                if new > limit:
                    continue
                heappush(agenda, (new, order, i, total, (arc[1], tail)))
                if not goes_on and new <= cost + SLACK:
                    goes_on = True
                    continue
                insort(costs, new)
                if len(costs) >= n:
                    del costs[n:]
                    limit = costs[-1] + SLACK
        return found


def join_lists(chosen: list[tuple[int, list[float]]], n: int) -> list[tuple[float, dict[int, int]]]:
    """The n best choices of one candidate from each entry: lost score and the choices that are not the first.

    ``chosen`` has the entries that can take part, and what each of their candidates loses.
    """
    agenda, out = [(0.0, (), 0)], []
    while agenda and len(out) < n:
        lost, picks, at = heappop(agenda)
        out.append((lost, {chosen[i][0]: c for i, c in picks}))
        for i in range(at, len(chosen)):
            held = dict(picks)
            c = held.get(i, 0) + 1
            if c < len(chosen[i][1]):
                loss = lost - chosen[i][1][c - 1] + chosen[i][1][c]
                heappush(agenda, (loss, tuple(sorted((held | {i: c}).items())), i))
    return out


def nearest(second: np.ndarray, n: int) -> list[int]:
    """Entries whose other candidates can take part in the n best: the n - 1 whose second one loses least."""
    return (np.argsort(second, kind="stable")[: n - 1] if len(second) < 4 * n else smallest(second, n - 1)).tolist()


def smallest(values: np.ndarray, n: int) -> np.ndarray:
    """Places of the n smallest values, of equal ones the first, in order."""
    limit = np.partition(values, n)[n]
    at = np.flatnonzero(values <= limit)
    return at[np.argsort(values[at], kind="stable")][:n]


class Numbers(dict):
    """Numbers strings as they are met; ``fresh`` are those since it was last emptied."""

    def __init__(self) -> None:
        self.fresh: list[str] = []

    def __missing__(self, x: str) -> int:
        self[x] = number = len(self)
        self.fresh.append(x)
        return number

    def forget(self) -> None:
        for _ in self.fresh:
            self.popitem()


def ranges(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """All places of the ranges, one range after another."""
    ends = np.cumsum(count)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(first - ends + count, count)


class Segmenter:
    def __init__(self, path: str, n: int) -> None:
        self.table, self.n = piece_table(path), n
        self.lattice = Lattice(self.table)
        self.units, self.parts = Numbers(), Numbers()
        # of each part its text, best score, what the second best loses, and where its ids are
        self.texts: list[str] = []
        self.score, self.loss = np.zeros(0), np.zeros(0)
        self.first, self.count, self.ids = np.zeros(0, np.int32), np.zeros(0, np.int32), np.zeros(0, np.uint32)
        # of each unit where its parts are
        self.begin, self.size, self.held = np.zeros(0, np.int32), np.zeros(0, np.int32), np.zeros(0, np.int32)
        self.lists: dict[str, list[Candidate]] = {}

    def candidates(self, part: str) -> list[Candidate]:
        """The n best of a part by the A-star search."""
        if (found := self.lists.get(part)) is None:
            found = [(s, pack(f"<{len(ids)}I", *ids)) for s, ids in self.lattice.search(part, max(self.n, 2))]
            if len(self.lists) < CACHE_ENTRIES // 12:  # only the first parts met are remembered
                self.lists[part] = found
        return found

    def best(self, parts: list[str]) -> tuple[np.ndarray, ...]:
        """Of each part its best score, what the second best loses, the place and number of its ids, and all ids."""
        sizes = np.fromiter(map(len, parts), np.int64, len(parts))
        score, loss = np.zeros((2, len(parts)))
        first, count = np.zeros((2, len(parts)), np.int64)
        short, rows, end = np.flatnonzero(sizes <= LONG), [np.zeros(0, np.uint32)], 0
        short = short[np.argsort(sizes[short], kind="stable")]  # those of one length go forward together
        for a in range(0, len(short), ABREAST):
            at = short[a : a + ABREAST]
            score[at], loss[at], number, ids = self.lattice.forward_all([parts[k] for k in at.tolist()])
            first[at], count[at] = end + np.cumsum(number) - number, number
            rows.append(ids)
            end += len(ids)
        for k in np.flatnonzero(count == 0).tolist():
            most = self.candidates(parts[k])
            score[k], ids = most[0]
            loss[k] = most[0][0] - most[1][0] if len(most) > 1 else float("inf")
            first[k], count[k] = end, len(ids) // 4
            rows.append(np.frombuffer(ids, "<u4"))
            end += len(ids) // 4
        return score, loss, first, count, np.concatenate(rows)

    def entries(self, parts: list[str]) -> list[tuple]:
        """Of each part its best score and ids, what the second best loses, and the part."""
        score, loss, first, count, ids = self.best(parts)
        return [
            (s, ids[a : a + c].astype("<u4").tobytes(), lost, p)
            for s, lost, a, c, p in zip(score.tolist(), loss.tolist(), first.tolist(), count.tolist(), parts)
        ]

    def cuts(self, units: list[str]) -> tuple[list[str], np.ndarray]:
        """The parts of the units, cut between characters that no piece joins, and how many each has."""
        codes, sizes = code_points(units)
        ends = np.cumsum(sizes)
        breaks = self.table.breaks(codes)
        breaks[ends - sizes] = True
        cuts = np.append(np.flatnonzero(breaks), len(codes))
        row, places = "".join(units), cuts.tolist()
        return [row[a:b] for a, b in zip(places, places[1:])], np.diff(np.searchsorted(cuts, ends), prepend=0)

    def searched(self, units: list[str]) -> dict[str, list[tuple]]:
        """The entries of each unit."""
        parts, counts = self.cuts(units)
        found = iter(self.entries(parts))
        return {unit: list(islice(found, n)) for unit, n in zip(units, counts.tolist())}

    def learn(self) -> None:
        """Adds what the fresh units and parts need to the arrays."""
        units, parts = self.units.fresh, self.parts
        texts, counts = self.cuts(units)
        held = np.fromiter(map(parts.__getitem__, texts), np.int32, len(texts))
        self.begin = np.concatenate([self.begin, len(self.held) + np.cumsum(counts) - counts], dtype=np.int32, casting="unsafe")
        self.size = np.concatenate([self.size, counts], dtype=np.int32, casting="unsafe")
        self.held = np.concatenate([self.held, held])
        score, loss, first, count, ids = self.best(parts.fresh)
        self.texts += parts.fresh
        self.score, self.loss = np.concatenate([self.score, score]), np.concatenate([self.loss, loss])
        self.first = np.concatenate([self.first, len(self.ids) + first], dtype=np.int32, casting="unsafe")
        self.count = np.concatenate([self.count, count], dtype=np.int32, casting="unsafe")
        self.ids = np.concatenate([self.ids, ids])

    def sizes(self) -> tuple[int, ...]:
        return tuple(map(len, (self.texts, self.ids, self.size, self.held)))

    def settle(self, before: tuple[int, ...]) -> None:
        """Forgets what was learned since ``before``, unless there is room for it: only the first units met are remembered."""
        if max(len(self.units), len(self.parts)) > CACHE_ENTRIES // 2:
            self.units.forget()
            self.parts.forget()
            texts, ids, units, held = before
            del self.texts[texts:]
            self.score, self.loss, self.first, self.count = (x[:texts] for x in (self.score, self.loss, self.first, self.count))
            self.ids, self.held = self.ids[:ids], self.held[:held]
            self.begin, self.size = self.begin[:units], self.size[:units]
        self.units.fresh, self.parts.fresh = [], []

    def joined(self, score: list[float], loss: np.ndarray, parts: list[int], ends: list[int], data: bytes) -> list[Candidate]:
        """The n best of a row of parts: their best scores, losses and numbers, and where the best ids of each begin and end."""
        total = sum(score)
        out = [(total, data[ends[0] : ends[-1]])]
        lists = {k: self.candidates(self.texts[parts[k]]) for k in nearest(loss, self.n) if loss[k] < float("inf")}
        chosen = [(k, [score[k] - s for s, _ in found]) for k, found in lists.items()]
        for lost, picks in islice(join_lists(chosen, self.n), 1, None):
            at, ids = ends[0], []
            for k, c in sorted(picks.items()):
                ids += data[at : ends[k]], lists[k][c][1]
                at = ends[k + 1]
            out.append((total - lost, b"".join([*ids, data[at : ends[-1]]])))
        return out

    def encode(self, texts: list[str]) -> list[list[Candidate]]:
        rows = [self.table.units(t) for t in texts]
        ends = np.cumsum([0, *map(len, rows)])
        before = self.sizes()
        units = np.fromiter(map(self.units.__getitem__, chain.from_iterable(rows)), np.int64, int(ends[-1]))
        del rows
        if self.units.fresh:
            self.learn()
        size = self.size[units]
        ends = np.concatenate([[0], np.cumsum(size)])[ends].tolist()
        parts = self.held[ranges(self.begin[units], size)]
        score, loss, count = self.score[parts], self.loss[parts], self.count[parts]
        data = self.ids[ranges(self.first[parts], count)].astype("<u4").tobytes()
        places = np.concatenate([[0], 4 * np.cumsum(count)])
        out = [
            self.joined(score[a:b].tolist(), loss[a:b], parts[a:b].tolist(), places[a : b + 1].tolist(), data) if b > a else [(0.0, b"")]
            for a, b in zip(ends, ends[1:])
        ]
        self.settle(before)
        return out


@lru_cache(maxsize=4)
def segmenter(path: str, n: int) -> Segmenter:
    return Segmenter(path, n)


CACHES["segment"] = segmenter.cache_clear


def segment(
    documents: DataFrame, n_best: int = 4, keep: tuple[str, ...] = ("doc_id",), model_path: str | None = None
) -> DataFrame:
    """The columns of ``keep`` and ``candidates``: up to ``n_best`` segmentations, best first, of each row's whole text.

    A candidate has ``score`` and ``ids``, little-endian 32-bit integers. Null and empty
    texts have one candidate, without ids and of score 0. Repeated rows and null ids are
    kept; other columns are not read. Candidates of equal score come in the
    order in which the agenda took them, the same in every run. No shuffle.
    """
    path = model_path or default_model()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = segmenter(path, n_best)
        for batch in slices(batches, limit=SLICE_BYTES):
            found = tool.encode(texts_of(batch))
            scores, ids = zip(*chain.from_iterable(found)) if found else ((), ())
            rows = pa.StructArray.from_arrays([pa.array(scores, pa.float64()), pa.array(ids, pa.binary())], ["score", "ids"])
            ends = pa.array(np.cumsum([0, *map(len, found)]), pa.int32())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.ListArray.from_arrays(ends, rows)], [*keep, "candidates"])

    rows = documents.select(*[F.col(f"`{c}`") for c in dict.fromkeys((*keep, "text"))])
    kept = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in keep)
    return rows.mapInArrow(tidy(run, "segment"), f"{kept}, candidates array<struct<score:double,ids:binary>>")


class Decoder:
    def __init__(self, path: str) -> None:
        table = piece_table(path)
        plain = [p.replace(MARK, " ").encode() for p in table.pieces]
        for byte, i in table.byte_ids.items():
            plain[i] = bytes([byte])
        for i in range(table.size):
            if table.processor.is_control(i):
                plain[i] = b""
        self.plain = pa.array(plain, pa.binary())

    def decode(self, rows: list[bytes | None]) -> list[str]:
        """The texts of rows of ids, gathered at once."""
        found = self.plain.take(pa.array(np.frombuffer(b"".join([x or b"" for x in rows]), "<u4")))
        ends = np.frombuffer(found.buffers()[1], np.int32)[np.cumsum([0, *(len(x or b"") // 4 for x in rows)])].tolist()
        data = found.buffers()[2].to_pybytes() if ends[-1] else b""
        skip = [a + (data[a : a + 1] == b" " and a < b) for a, b in zip(ends, ends[1:])]
        return [data[a:b].decode("utf-8", "replace") for a, b in zip(skip, ends[1:])]


@lru_cache(maxsize=4)
def decoder(path: str) -> Decoder:
    return Decoder(path)


def decoded(frame: DataFrame, ids: str = "ids", text: str = "decoded", model_path: str | None = None) -> DataFrame:
    """All columns and the text that the binary ids stand for, without the leading mark's space.

    Null ids give the empty text; bytes that are no UTF-8 become U+FFFD. A word mark that
    stood in the text itself comes back as a space, as with the library.
    """
    path = model_path or default_model()
    kept = [f for f in frame.schema.fields if f.name != text]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = decoder(path)
        for batch in slices(batches, ids, SLICE_BYTES):
            column = pa.array(tool.decode(batch.column(ids).to_pylist()), pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column(f.name) for f in kept] + [column], [f.name for f in kept] + [text]
            )

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept] + [f"`{text}` string"])
    return frame.mapInArrow(tidy(run, "segment"), schema)
