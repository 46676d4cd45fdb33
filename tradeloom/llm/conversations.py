"""Cheapest repair of role order in conversations, by a Viterbi search with survivor coalescence.

A repaired conversation reads ``(s?(ua)+)?`` in role initials. Rows are kept, given another
role, deleted, or answered by an inserted empty row; of equally cheap repairs the one whose
edit initials are smallest in ASCII wins.

The search walks the rows once. Four states (nothing yet, after system, after user, after
assistant) each keep one survivor, a node of a backpointer tree that counts its children.
A node that loses its last child goes; once all survivors have one ancestor, the edits up
to it are final and are emitted, so only the unresolved rows are held. Ties compare whole
unresolved suffixes: survivors carry their rank among each other, which is the order of
those suffixes carried from row to row, as two paths over the same rows never are prefixes
of each other when both end in a row's own edit. Inserts stand right before a kept row or
at the end, because ``D`` sorts before ``I``.

A conversation may hold any share of the rows. Rows are sorted over range partitions, and a
partition sees its first and last conversation as pieces: for each state before a piece the
search gives cost and rank of each state after it. These 16 numbers a piece are combined
over the pieces of a conversation (at most one a partition), which fixes the states between
pieces, and then every piece is repaired on its own.
"""

from __future__ import annotations

import hashlib
from collections import deque
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradeloom.llm.common import cut, narrow, stored, tidy

WHITE = " \t\n\x0b\x0c\r"
FINE, BLANK, DUPLICATE, TRUNCATED = range(4)
START, SYSTEM, USER, ASSISTANT = range(4)
DELETE, REROLE, INSERT, UNFINISHED = 2, 1, 5, 5
LEGAL = {"su", "ua", "au"}
#: what a path must still insert if the conversation ends in a state
ENDING = {START: "", SYSTEM: "II", USER: "I", ASSISTANT: ""}
#: EXTRA[i][j]: whatever can follow state j can follow state i for so much more
EXTRA = ((0, 0, 5, 0), (12, 0, 5, 10), (7, 5, 0, 5), (2, 0, 5, 0))
PARTITION_BYTES = 64 << 20
SEGMENT_BYTES = 2 << 20


def after_other(state: int) -> int:
    """The state after a row is inserted or given the role that must come next."""
    return ASSISTANT if state == USER else USER


def after_kept(state: int, initial: str) -> int | None:
    if initial == "s":
        return SYSTEM if state == START else None
    if initial == "u":
        return USER if state != USER else None
    return ASSISTANT if initial == "a" and state == USER else None


def moves_of(initial: str, truncated: bool) -> list[tuple[int, int, str, int]]:
    """(state before, state after, edits, cost) for a row that need not be deleted."""
    out, more = [], UNFINISHED if truncated else 0
    for state in (START, SYSTEM, USER, ASSISTANT):
        out.append((state, state, "D", DELETE))
        for base, edits, cost in ((state, "", more), (after_other(state), "I", more + INSERT)):
            kept = after_kept(base, initial)
            if kept is not None:
                out.append((state, kept, edits + "K", cost))
            if initial != ("a" if base == USER else "u"):
                out.append((state, after_other(base), edits + "R", cost + REROLE))
    return out


MOVES = {(i, t): moves_of(i, t) for i in ("s", "u", "a", "") for t in (False, True)}


def step(survivors: dict[int, tuple[int, int]], moves: list) -> dict[int, tuple[int, int, int, str]]:
    """From cost and rank by state to cost, rank, state before and edits by state; hopeless states are left out."""
    best: dict[int, tuple[int, int, str, int]] = {}
    for before, state, edits, cost in moves:
        if before in survivors:
            total, rank = survivors[before]
            found = (total + cost, rank, edits, before)
            if state not in best or found < best[state]:
                best[state] = found
    order = sorted(best, key=lambda s: best[s][1:3])
    ranks = {s: r for r, s in enumerate(order)}
    out = {}
    for j, (cost, _, edits, before) in best.items():
        for i in best:
            reach = best[i][0] + EXTRA[i][j]
            if i != j and (reach < cost or (reach == cost and EXTRA[i][j] == 0 and ranks[i] < ranks[j])):
                break
        else:
            out[j] = (cost, ranks[j], before, edits)
    return out


class Node:
    """A row's edits on some path; the length of ``kids`` is its reference count."""

    __slots__ = ("edits", "kids", "parent")

    def __init__(self, parent: Node | None, edits: str) -> None:
        self.parent, self.edits, self.kids = parent, edits, []
        if parent is not None:
            parent.kids.append(self)


class Search:
    """Rows go in one by one; ``feed`` and ``finish`` give (row, edits) as soon as they are certain."""

    def __init__(self, state: int = START) -> None:
        self.root = Node(None, "")
        self.alive: dict[int, tuple[int, int, Node]] = {state: (0, 0, self.root)}
        self.waiting: deque = deque()

    def feed(self, row: tuple, initial: str, fault: int, copies: int) -> Iterator[tuple[tuple, str]]:
        self.waiting.append(row)
        before = {s: (c, r) for s, (c, r, _) in self.alive.items()}
        if fault in (BLANK, DUPLICATE):
            after = {s: (c + DELETE * copies, r, s, "D") for s, (c, r) in before.items()}
        else:
            after = step(before, MOVES[initial if initial in ("s", "u", "a") else "", fault == TRUNCATED])
        nodes = {s: node for s, (_, _, node) in self.alive.items()}
        self.alive = {s: (c, r, Node(nodes[b], edits)) for s, (c, r, b, edits) in after.items()}
        for node in nodes.values():
            self.release(node)
        yield from self.settled()

    def release(self, node: Node) -> None:
        while not node.kids and node.parent is not None:
            above, node.parent = node.parent, None
            above.kids.remove(node)
            node = above

    def settled(self) -> Iterator[tuple[tuple, str]]:
        while len(self.root.kids) == 1:
            self.root = self.root.kids[0]
            self.root.parent = None
            yield self.waiting.popleft(), self.root.edits

    def best(self) -> int:
        return min(self.alive, key=lambda s: (self.alive[s][0] + INSERT * len(ENDING[s]), self.alive[s][1]))

    def finish(self, state: int) -> Iterator[tuple[tuple, str]]:
        """The rest of the path that ends in a state."""
        for s, (_, _, node) in list(self.alive.items()):
            if s != state:
                self.release(node)
        yield from self.settled()


def costs_of(codes: list[tuple[str, bool]], state: int) -> dict[int, tuple[int, int]]:
    """Cost and rank of each state after rows that need not be deleted, from a state before them."""
    now = {state: (0, 0)}
    for code in codes:
        now = {s: (c, r) for s, (c, r, _, _) in step(now, MOVES[code]).items()}
    return now


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows as a faulty export leaves them, by a checksum of conversation and turn.

    Of 20 rests, 0 drops the row, 1 empties its text, 2 removes ``.!?``, 3 repeats it and 4
    makes its role ``user``. A null of any column counts as one space (``conv_id`` and
    ``turn`` only in the checksum). Equal rows are damaged alike. An empty table stays empty.
    """
    rows = narrow(conversations, "conv_id", "turn", "role", "text")
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    role, text = (F.coalesce(c, F.lit(" ")) for c in ("role", "text"))
    kind = F.col("kind")
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.crc32(key) % 20).alias("kind")).where("kind <> 0").select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(kind == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy"),
    ).drop("copy")


def in_order() -> list[Column]:
    return [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("content").asc()]


def sorted_rows(rows: DataFrame) -> DataFrame:
    """Distinct rows with their number and fault, sorted by conversation and turn over range partitions.

    Exact copies are counted before they are shuffled. A text that comes back in a later
    turn is found by the first turn of its (conversation, content), joined only where there
    are several; content is the SHA-256 of role and text. The sorted rows are a checkpoint,
    so that later passes see the same partitions.
    """
    plain = narrow(rows, "conv_id", "turn", "role", "text").select(
        "conv_id", F.col("turn").cast("bigint").alias("turn"), *[F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text")]
    )
    counted = stored(plain.groupBy("conv_id", "turn", "role", "text").agg(F.count("*").alias("n")), "turns")
    hashed = counted.withColumn("content", F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)))
    when = F.struct(F.col("turn").isNotNull().alias("filled"), "turn")
    again = hashed.groupBy("conv_id", "content").agg(F.count("*").alias("turns"), F.min(when).alias("first")).where("turns > 1")
    again = again.select(F.col("conv_id").alias("again_conv"), F.col("content").alias("again_content"), "first")
    both = hashed.join(again, hashed.conv_id.eqNullSafe(again.again_conv) & (hashed.content == again.again_content), "left")
    seen = F.rtrim(F.col("text"), F.lit(WHITE))
    fault = (
        F.when(seen == "", BLANK)
        .when(F.col("first").isNotNull() & ~F.col("first").eqNullSafe(when), DUPLICATE)
        .when(~F.right(seen, F.lit(1)).isin(".", "!", "?"), TRUNCATED)
        .otherwise(FINE)
    )
    flagged = both.select("conv_id", "turn", "role", "text", "n", "content", fault.alias("fault"))
    size = counted.agg(F.sum(F.octet_length("text") + 64).alias("bytes")).first()["bytes"] or 0
    ranges = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // PARTITION_BYTES))
    dealt = flagged.repartitionByRange(ranges, *in_order()).sortWithinPartitions(*in_order())
    return cut(dealt.drop("content").withColumn("part", F.spark_partition_id()))


def edge_costs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For the first and the last conversation of a partition: cost and rank from each state to each state."""
    conv, part, first, codes, kind, begun = None, 0, True, [], None, False

    def row() -> pa.RecordBatch:
        costs, ranks = [], []
        for state in (START, SYSTEM, USER, ASSISTANT):
            found = costs_of(codes, state)
            costs += [found[s][0] if s in found else None for s in range(4)]
            ranks += [found[s][1] if s in found else None for s in range(4)]
        return pa.RecordBatch.from_arrays(
            [pa.array([conv], kind), pa.array([part], pa.int32()), pa.array([costs], pa.list_(pa.int64())), pa.array([ranks], pa.list_(pa.int32()))],
            ["conv_id", "part", "costs", "ranks"],
        )

    for batch in batches:
        kind = batch.schema.field("conv_id").type
        for c, p, initial, fault in zip(*(batch.column(x).to_pylist() for x in ("conv_id", "part", "initial", "fault"))):
            if begun and c != conv:
                if first:
                    yield row()
                first, codes = False, []
            conv, part, begun = c, p, True
            if fault in (FINE, TRUNCATED):
                codes.append((initial if initial in ("s", "u", "a") else "", fault == TRUNCATED))
    if begun:
        yield row()


def states_between(pieces: list[tuple[list, list]]) -> list[tuple[int, int]]:
    """(state before, state after) of every piece of a conversation on its cheapest path, least in ASCII."""
    now, back = {START: (0, 0)}, []
    for costs, ranks in pieces:
        best: dict[int, tuple[int, int, int, int]] = {}
        for i, (cost, rank) in now.items():
            for j in range(4):
                if costs[4 * i + j] is not None:
                    found = (cost + costs[4 * i + j], rank, ranks[4 * i + j], i)
                    if j not in best or found < best[j]:
                        best[j] = found
        order = sorted(best, key=lambda s: best[s][1:3])
        now = {s: (best[s][0], r) for r, s in enumerate(order)}
        back.append({s: best[s][3] for s in best})
    state = min(now, key=lambda s: (now[s][0] + INSERT * len(ENDING[s]), now[s][1]))
    out = []
    for before in reversed(back):
        out.append((before[state], state))
        state = before[state]
    return out[::-1]


def choose(table: pa.Table) -> pa.Table:
    table = table.sort_by("part")
    chosen = states_between(list(zip(table.column("costs").to_pylist(), table.column("ranks").to_pylist())))
    last = [False] * (len(chosen) - 1) + [True]
    return pa.table({
        "conv_id": table.column("conv_id"), "part": table.column("part"),
        "before": pa.array([a for a, _ in chosen], pa.int32()), "after": pa.array([b for _, b in chosen], pa.int32()),
        "last": pa.array(last),
    })


def with_id(kind: T.DataType, ddl: str) -> T.StructType:
    return T.StructType([T.StructField("conv_id", kind), *T.StructType.fromDDL(ddl).fields])


EDIT = "part int, whole boolean, turn bigint, old_role string, op string, n bigint, fault int, role string, text string"


class Edits:
    """Edit rows of one conversation or piece, in order."""

    def __init__(self, conv: object, part: int, whole: bool, state: int) -> None:
        self.conv, self.part, self.whole, self.state, self.search = conv, part, whole, state, Search(state)

    def of(self, row: tuple | None, edits: str) -> Iterator[tuple]:
        for op in edits:
            turn, old, text, fault, n = row if op != "I" else (None, None, "", None, 1)
            role = None
            if op == "K":
                self.state, role = after_kept(self.state, old[:1]), old
            elif op != "D":
                self.state = after_other(self.state)
                role = "assistant" if self.state == ASSISTANT else "user"
            yield self.conv, self.part, self.whole, turn, old, op, n, fault, role, None if op == "D" else text

    def feed(self, turn: int | None, role: str, text: str, fault: int, n: int) -> Iterator[tuple]:
        runs = [(fault, n)] if fault in (BLANK, DUPLICATE) or n == 1 else [(fault, 1), (DUPLICATE, n - 1)]
        for kind, copies in runs:
            own = text if kind in (FINE, TRUNCATED) else None
            for row, edits in self.search.feed((turn, role, own, kind, copies), role[:1], kind, copies):
                yield from self.of(row, edits)

    def finish(self, after: int | None, last: bool) -> Iterator[tuple]:
        after = self.search.best() if after is None else after
        for row, edits in self.search.finish(after):
            yield from self.of(row, edits)
        if last:
            yield from self.of(None, ENDING[after])


def edit_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    current, key, after, last = None, None, None, True
    for batch in batches:
        names = ("conv_id", "part", "turn", "role", "text", "fault", "n", "before", "after", "last")
        for conv, part, turn, role, text, fault, n, before, then, end in zip(*(batch.column(x).to_pylist() for x in names)):
            if current is None or conv != key:
                if current is not None:
                    yield from current.finish(after, last)
                key, after, last = conv, then, end is not False
                current = Edits(conv, part, before is None, START if before is None else before)
            yield from current.feed(turn, role, text, fault, n)
    if current is not None:
        yield from current.finish(after, last)


def batched(rows: Iterator[tuple], names: list[str], types: list[pa.DataType], weight: Callable[[tuple], int]) -> Iterator[pa.RecordBatch]:
    """Rows as record batches of about ``SEGMENT_BYTES``."""
    held, size = [], 0

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*held), types)], names)

    for row in rows:
        held.append(row)
        size += weight(row)
        if size > SEGMENT_BYTES:
            yield batch()
            held, size = [], 0
    if held:
        yield batch()


def repair(rows: DataFrame) -> DataFrame:
    """The edits that give every conversation legal role order, in order within each ``part``.

    Reads ``conv_id``, ``turn``, ``role`` and ``text``; other columns are left out, whatever
    their names. Null role or text is one space; null ids are one conversation, null turns
    come first. Rows of one turn stand in the order of the SHA-256 of role and text, exact
    copies next to each other.

    A row is blank (no character but white space), else a duplicate (role and text seen
    earlier), else truncated (last character but white space not ``.!?``). Blank and
    duplicate rows must go. Keep costs 0, rerole 1, delete 2, insert 5, an undeleted
    truncated row 5 more.

    Returns ``conv_id``, ``part`` (parts ascend along a conversation), ``whole`` (it lies in one part), ``turn``,
    ``old_role``, ``op`` (K, R, D, I), ``n`` (copies of one deleted row are one edit),
    ``fault`` (0 none, 1 blank, 2 duplicate, 3 truncated; null for I) and the repaired
    ``role`` and ``text`` (null for D). An empty table gives no row.
    """
    held = sorted_rows(rows)
    kind = held.schema["conv_id"].dataType
    seen = held.select("conv_id", "part", F.left("role", F.lit(1)).alias("initial"), "fault")
    costs = with_id(kind, "part int, costs array<bigint>, ranks array<int>")
    states = with_id(kind, "part int, before int, after int, last boolean")
    chosen = seen.mapInArrow(edge_costs, costs).groupBy("conv_id").applyInArrow(choose, states)
    chosen = chosen.withColumnsRenamed({"conv_id": "own_conv", "part": "own_part"})
    # at most two rows a partition
    known = held.join(
        F.broadcast(chosen), held.conv_id.eqNullSafe(chosen.own_conv) & (held.part == chosen.own_part), "left"
    ).drop("own_conv", "own_part")
    schema = with_id(kind, EDIT)
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types: list[pa.DataType] = []

        def tapped() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not types:
                    types.extend([
                        batch.schema.field("conv_id").type, pa.int32(), pa.bool_(), pa.int64(), pa.string(), pa.string(), pa.int64(),
                        pa.int32(), pa.string(), pa.string(),
                    ])
                yield batch

        yield from batched(edit_rows(tapped()), names, types, lambda r: 100 + len(r[-1] or ""))

    return known.mapInArrow(tidy(run, "conversations"), schema)


COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


class Summary:
    """Counters, audit and content of edits in order; also of summaries of consecutive pieces."""

    def __init__(self) -> None:
        self.first_turn = self.last_turn = self.low = self.high = None
        self.turns, self.first, self.last, self.faults, self.illegal, self.cost = 0, None, None, [0, 0, 0, 0], 0, 0
        self.audit: list[str] = []
        self.hash, self.lines = hashlib.sha256(), 0

    def add(self, turn: int | None, old: str | None, op: str, n: int, fault: int | None, role: str | None, text: str | None) -> bytes:
        """Take in one edit; gives the bytes it adds to the repaired conversation, with a line break before each line."""
        self.audit.append(op * n)
        self.cost += {"K": 0, "R": REROLE, "D": DELETE * n, "I": INSERT}[op]
        if op != "I":
            self.faults[fault] += n
            self.cost += UNFINISHED if fault == TRUNCATED and op != "D" else 0
            initial = old[:1]
            self.illegal += (self.last is not None and self.last + initial not in LEGAL) + n - 1
            self.first, self.last = initial if self.first is None else self.first, initial
            if turn is not None:
                self.turns += turn != self.high
                self.low, self.high = turn if self.low is None else self.low, turn
        return b"" if op == "D" else f"\n{role}:{text}".encode()

    def join(self, own: dict) -> None:
        """Take in the summary of the piece after this one."""
        self.audit.append(own["audit"])
        self.cost += own["cost"]
        for k, c in enumerate(("blank", "duplicate", "truncated"), BLANK):
            self.faults[k] += own[c]
        self.illegal += own["illegal"]
        if own["first"] is not None:
            self.illegal += self.last is not None and self.last + own["first"] not in LEGAL
            self.last = own["last"]
        if own["low"] is not None:
            self.turns += own["turns"] - (self.high == own["low"])
            self.low, self.high = own["low"] if self.low is None else self.low, own["high"]

    def gaps(self) -> int:
        return 0 if self.low is None else self.high - self.low + 1 - self.turns

    def write(self, lines: bytes) -> None:
        if lines:
            self.hash.update(lines if self.lines else lines[1:])
            self.lines += 1


PIECE = "part int, seg int, whole boolean, low bigint, high bigint, turns bigint, first string, last string, blank bigint, " \
    "duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, data binary, digest string"


def piece_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """One row for each whole conversation; pieces come in segments of ``SEGMENT_BYTES`` with their bytes."""
    key, part, whole, seg, own, data, size = None, None, None, 0, None, [], 0

    def row() -> tuple:
        return (
            key, part, seg, whole, own.low, own.high, own.turns, own.first, own.last, own.faults[BLANK], own.faults[DUPLICATE],
            own.faults[TRUNCATED], own.illegal, own.cost, "".join(own.audit), None if whole else b"".join(data),
            own.hash.hexdigest() if whole else None,
        )

    for batch in batches:
        names = ("conv_id", "part", "whole", "turn", "old_role", "op", "n", "fault", "role", "text")
        for conv, p, w, *edit in zip(*(batch.column(x).to_pylist() for x in names)):
            if own is None or (conv, p) != (key, part):
                if own is not None:
                    yield row()
                key, part, whole, seg, own, data, size = conv, p, w, 0, Summary(), [], 0
            elif not whole and size > SEGMENT_BYTES:
                yield row()
                seg, own, data, size = seg + 1, Summary(), [], 0
            lines = own.add(*edit)
            size += len(lines) + edit[3]
            if whole:
                own.write(lines)
            else:
                data.append(lines)
    if own is not None:
        yield row()


def joined_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """One row for each conversation, from sorted segments as they stream by."""
    key, own = None, None

    def row() -> tuple:
        return (key, own.gaps(), *own.faults[1:], own.illegal, own.cost, "".join(own.audit), own.hash.hexdigest())

    for batch in batches:
        for i in range(batch.num_rows):
            piece = batch.slice(i, 1).to_pylist()[0]
            if own is None or piece["conv_id"] != key:
                if own is not None:
                    yield row()
                key, own = piece["conv_id"], Summary()
            own.join(piece)
            if piece["whole"]:
                yield (*row()[:-1], piece["digest"])
                own = None
            else:
                own.write(piece["data"])
    if own is not None:
        yield row()


def summaries(edits: DataFrame) -> DataFrame:
    """Counters, edit initials and content hash of each conversation, from ``repair``'s rows.

    A conversation that lies in one partition is hashed there. Pieces of a larger one go to
    one task as segments of ``SEGMENT_BYTES``, which stream through its SHA-256; that hash
    has no parallel form. ``gaps`` ignores null turns and is 0 if all are null.
    """
    kind = edits.schema["conv_id"].dataType
    piece = with_id(kind, PIECE)
    whole = with_id(kind, ", ".join(f"{c} bigint" for c in COUNTS) + ", audit string, repaired_sha256 string")
    flat = {"int": pa.int32(), "bigint": pa.int64(), "boolean": pa.bool_(), "string": pa.string(), "binary": pa.binary()}

    def over(function: Callable[[Iterator[pa.RecordBatch]], Iterator[tuple]], schema: T.StructType, weight: Callable[[tuple], int]):
        names, types = schema.names, [flat[f.dataType.simpleString()] for f in schema.fields[1:]]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own: list[pa.DataType] = []

            def tapped() -> Iterator[pa.RecordBatch]:
                for batch in batches:
                    if not own:
                        own.extend([batch.schema.field("conv_id").type, *types])
                    yield batch

            yield from batched(function(tapped()), names, own, weight)

        return run

    pieces = edits.mapInArrow(over(piece_rows, piece, lambda r: 300 + len(r[-3]) + len(r[-2] or b"")), piece)
    dealt = pieces.repartition("conv_id").sortWithinPartitions(F.col("conv_id").asc_nulls_first(), "part", "seg")
    return dealt.mapInArrow(over(joined_rows, whole, lambda r: 300 + len(r[-2])), whole)
