"""Removal of long repeated byte strings by a distributed merge sort of suffixes.

A byte goes if a string of ``LENGTH`` bytes that covers it starts anywhere else as well.

Which suffixes are sorted. For each start p of a whole string inside its document the
anchor m(p) is the leftmost smallest hashed gram among the ``WINDOW`` places from p on.
Equal strings have their anchors at the same offset, so a repeated string has an anchor
whose gram occurs twice. Anchors with a gram of their own are dropped by a count; of the
others the suffix is sorted.

What is sorted. The suffix ``text[m : m + LENGTH]``, then, backward, the bytes before m
as far as starts with this anchor reach. If a sorted neighbour shares ``LENGTH + b``
bytes, the strings that start at m - b .. m all occur there too.

How. Every task sorts its suffixes into runs, those of one key by document and place, and
cuts them at splitters of that order, so that a key of many suffixes goes over as many
buckets as it needs. Rows of one id and one text repeat each other as a whole; one of
them stands for all in the sort. A run travels
front-coded: for each suffix the length of the prefix that it shares with the one before
it, and the rest. A loser tree merges the runs of a bucket. It holds for each waiting
suffix the length of the prefix that it shares with the last winner; two suffixes whose
lengths differ are ordered by them alone, and equal lengths are compared from there on,
so no known prefix is compared again. The winner's length is its common prefix with the
one before it in the whole order. Each run also sends its neighbours beyond the cuts, and
those of a class of equal prefixes that goes over a cut, so that the first and the last
suffix and class of a bucket know theirs.

What is left. Starts whose match ends between their string's end and ``LENGTH`` after the
anchor are not decided by prefixes of ``LENGTH`` bytes. They are known from the common
prefixes: the longest one with a suffix of another class is g, and offsets b from
``LENGTH - g`` on are open. Strings of open starts are counted by a 128-bit hash, in the
bucket where all that could equal them are neighbours, else over all buckets, to which a
bucket gives one row of each string for every ``STRINGS`` counted.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeloom.llm.common import narrow, slices, stored, tidy

LENGTH = 400
WINDOW = 256
GRAM = 32
RUN_BYTES = 16 << 20
BUCKET_BYTES = 16 << 20
OVERSAMPLE = 24
STRINGS = 200_000
PLACE = np.uint64((1 << 31) - 1)


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """64-bit hashes of the ``GRAM`` bytes from each place; the last places are of less use."""
    table = np.frombuffer(hashlib.shake_128(b"grams").digest(256 * 8), "<u8") | np.uint64(1)
    h, k = table[data], 1
    while k < GRAM:
        h[: len(h) - k] = h[: len(h) - k] * np.uint64(0x9E3779B97F4A7C15 + 2 * k) + h[k:]
        h ^= h >> np.uint64(29)
        k *= 2
    return h * np.uint64(0xBF58476D1CE4E5B9)


def anchors(texts: list[bytes], length: int, window: int) -> dict[str, np.ndarray]:
    """Anchors of a block of texts: text number, place, gram, and the offsets of the starts that have it."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    begin = np.concatenate([[0], np.cumsum(sizes)[:-1]]) if len(texts) else np.zeros(0, np.int64)
    data = np.frombuffer(b"".join(texts), np.uint8)
    starts = np.concatenate([np.zeros(0, np.int64), *(np.arange(b, b + n - length + 1) for b, n in zip(begin, sizes) if n >= length)])
    if not len(starts):
        return {k: np.zeros(0, np.int64) for k in ("text", "place", "low", "high")} | {"gram": np.zeros(0, np.uint64)}
    h = gram_hashes(data)
    least = (h & ~PLACE) | np.arange(len(h), dtype=np.uint64)
    k = 1
    while 2 * k <= window:
        least = np.minimum(least[: len(least) - k], least[k:])
        k *= 2
    rest = window - k
    if rest:
        least = np.minimum(least[: len(least) - rest], least[rest:])
    place = (least[starts] & PLACE).astype(np.int64)
    first = np.flatnonzero(np.diff(place, prepend=-1))
    last = np.append(first[1:], len(place)) - 1
    at = place[first]
    text = np.searchsorted(begin, at, side="right") - 1
    # empty texts share their begin with the next one; the last of equal begins holds the bytes
    return {
        "text": text, "place": at - begin[text], "gram": h[at],
        "low": at - starts[last], "high": at - starts[first],
    }


def texts_by_key(documents: DataFrame) -> DataFrame:
    """id0, code (key of a row) and text; a null text is empty."""
    rows = narrow(documents, "doc_id", "text").withColumn("text", F.coalesce("text", F.lit("")))
    return rows.select(F.coalesce("doc_id", F.xxhash64("text")).cast("bigint").alias("id0"), F.xxhash64("doc_id", "text").alias("code"), "text")


def compressed(frame: DataFrame) -> DataFrame:
    """The frame with its text packed as ``z``, to move less."""
    kept = [f for f in frame.schema.fields if f.name != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            z = [len(x).to_bytes(8, "little") + pa.compress(x, codec="zstd", asbytes=True) for x in bytes_of(batch)]
            yield pa.RecordBatch.from_arrays([batch.column(f.name) for f in kept] + [pa.array(z, pa.binary())], [f.name for f in kept] + ["z"])

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept] + ["z binary"])
    return frame.mapInArrow(tidy(run, "suffix_dedup"), schema)


def bytes_of(batch: pa.RecordBatch) -> list[bytes]:
    return [x.as_buffer().to_pybytes() for x in batch.column("text")]


def unpacked(z: bytes) -> bytes:
    return pa.decompress(z[8:], decompressed_size=int.from_bytes(z[:8], "little"), codec="zstd", asbytes=True)


def repeated_anchors(texts: DataFrame, length: int, window: int) -> DataFrame:
    """id0, code and ``places``: anchors whose gram occurs more than once, of every text that has any."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = anchors(bytes_of(batch), length, window)
            own = [pa.array(batch.column(c).to_numpy()[found["text"]]) for c in ("id0", "code")]
            yield pa.RecordBatch.from_arrays(
                [*own, pa.array(found["place"].astype(np.int32)), pa.array(found["gram"].view(np.int64))],
                ["id0", "code", "place", "gram"],
            )

    rows = texts.mapInArrow(tidy(run, "suffix_dedup"), "id0 bigint, code bigint, place int, gram bigint")
    rows = stored(rows, "anchors")
    twice = stored(rows.groupBy("gram").count().where("count > 1").select("gram"), "grams")
    kept = rows.join(twice, "gram", "left_semi")
    return stored(kept.groupBy("id0", "code").agg(F.sort_array(F.collect_set("place")).alias("places")), "places")


def common_prefix(a: bytes, b: bytes, start: int) -> int:
    """Length of the common prefix of two strings that are known to share ``start`` bytes."""
    low, high = start, min(len(a), len(b))
    step = 8
    while low + step <= high and a[low : low + step] == b[low : low + step]:
        low += step
        step *= 2
    high = min(high, low + step)
    while low < high:
        middle = (low + high + 1) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle - 1
    return low


class Suffix:
    """A suffix with its key string, the bytes before its anchor and where it is from."""

    __slots__ = ("key", "back", "id0", "code", "place", "low", "ghost")

    def __init__(self, key: bytes, back: bytes, id0: int, code: int, place: int, low: int, ghost: bool = False) -> None:
        self.key, self.back, self.id0, self.code, self.place, self.low, self.ghost = key, back, id0, code, place, low, ghost

    def order(self) -> tuple[bytes, int, int, int]:
        return self.key, self.id0, self.code, self.place


def suffixes(id0: int, code: int, data: bytes, places: set, found: dict, rows: range, length: int) -> Iterator[Suffix]:
    for r in rows:
        m = int(found["place"][r])
        if m in places:
            back = data[m - int(found["high"][r]) : m][::-1]
            front = data[m : m + length]
            key = front + back if len(front) == length else front
            yield Suffix(key, back, id0, code, m, int(found["low"][r]))


def front_coded(run: list[Suffix], first: int, last: int, length: int, beside: tuple[int, ...] = ()) -> bytes:
    """The suffixes first..last-1 of a sorted run, and as ghosts those at the places ``beside``, packed."""
    ghosts = {i for i in beside if 0 <= i < len(run) and not first <= i < last}
    part = [(run[i], i in ghosts) for i in sorted({*range(first, last), *ghosts})]
    shared, rest, back, before = [], [], [], b""
    for s, _ in part:
        n = common_prefix(before, s.key, 0)
        shared.append(n)
        rest.append(s.key[n:])
        back.append(b"" if len(s.key) >= length else s.back)  # a whole key holds them already
        before = s.key
    columns = pa.RecordBatch.from_pydict({
        "shared": pa.array(shared, pa.int32()), "rest": pa.array(rest, pa.binary()), "back": pa.array(back, pa.binary()),
        "id0": pa.array([s.id0 for s, _ in part], pa.int64()), "code": pa.array([s.code for s, _ in part], pa.int64()),
        "place": pa.array([s.place for s, _ in part], pa.int64()), "low": pa.array([s.low for s, _ in part], pa.int32()),
        "ghost": pa.array([g for _, g in part], pa.bool_()),
    })
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, columns.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(columns)
    return sink.getvalue().to_pybytes()


def bucket_runs(held: list[Suffix], cuts: list[tuple], length: int) -> list[bytes]:
    """The suffixes, sorted in place, as one packed run for each bucket between the cuts."""
    held.sort(key=Suffix.order)

    def at(*order) -> int:
        return bisect_left(held, order, key=Suffix.order)

    edges = [0, *(at(*c) for c in cuts), len(held)]
    # a class that goes over a cut has its neighbours further away: the last key before
    # the class of the lower cut, and the first after that of the upper one (no text holds 0xff)
    before = [-1, *(at(c[0][:length]) - 1 for c in cuts)]
    after = [*(at(c[0][:length] + b"\xff") for c in cuts), -1]
    return [front_coded(held, a, b, length, (before[i], a - 1, b, after[i])) for i, (a, b) in enumerate(zip(edges, edges[1:]))]


def decoded_run(blob: bytes, length: int) -> Iterator[tuple[int, Suffix]]:
    """Prefix shared with the suffix before, and the suffix, one after another."""
    batch = pa.ipc.open_stream(blob).read_next_batch()
    columns = [batch.column(c) for c in ("shared", "rest", "back", "id0", "code", "place", "low", "ghost")]
    before = b""
    for i in range(batch.num_rows):
        n, rest, back, id0, code, place, low, ghost = (c[i].as_py() for c in columns)
        before = before[:n] + rest
        yield n, Suffix(before, back if len(before) < length else before[length:], id0, code, place, low, ghost)


class PrefixLoserTree:
    """Merges front-coded runs. A waiting suffix is held with its common prefix with the last winner."""

    def __init__(self, runs: list[Iterator[tuple[int, Suffix]]]) -> None:
        self.runs, self.size = runs, len(runs)
        self.head: list[Suffix | None] = [None] * self.size
        self.shared = [0] * self.size
        self.waiting = [-1] * max(self.size, 1)
        for i in range(self.size):
            self.advance(i)
            self.shared[i] = 0
        for i in range(self.size):
            self.play(i)

    def advance(self, i: int) -> None:
        self.shared[i], self.head[i] = next(self.runs[i], (0, None))

    def play(self, i: int) -> None:
        head, shared, waiting = self.head, self.shared, self.waiting
        node = (i + self.size) // 2
        while node:
            j = waiting[node]
            if j < 0:
                waiting[node] = i
                return
            a, b = head[i], head[j]
            if a is None:
                wins = b is None
            elif b is None:
                wins = True
            elif shared[i] != shared[j]:
                wins = shared[i] > shared[j]  # shares more with the last winner, so it is smaller
            else:
                n = common_prefix(a.key, b.key, shared[i])
                wins = (a.key[n : n + 1], a.id0, a.code, a.place) <= (b.key[n : n + 1], b.id0, b.code, b.place)
                shared[j if wins else i] = n
            if not wins:
                waiting[node], i = i, j
            node //= 2
        waiting[0] = i

    def __iter__(self) -> Iterator[tuple[int, Suffix]]:
        """Every suffix in order, with its common prefix with the one before it."""
        if not self.size:
            return
        while (best := self.head[self.waiting[0]]) is not None:
            i = self.waiting[0]
            yield self.shared[i], best
            self.advance(i)
            self.play(i)


def judged(order: list[tuple[int, Suffix]], length: int, window: int) -> Iterator[tuple]:
    """Decided starts and open strings of a merged bucket.

    Gives (None, id0, code, first, last, True) for starts that are repeated for sure, and
    (hash, id0, code, start, start, open) for strings to be counted over buckets; those
    that are not open are evidence for others. Only bundles, neighbours that share enough
    for open strings, that reach beyond the bucket or have over ``STRINGS`` strings need
    that; others are counted here.
    """
    n = len(order)
    if not n:
        return
    shared = np.array([c for c, _ in order] + [0], np.int64)
    shared[0] = 0
    ghost = np.array([s.ghost for _, s in order], bool)
    whole = np.array([len(s.key) >= length for _, s in order], bool)
    # class: neighbours that share all of the first ``length`` bytes
    number = np.cumsum(shared[:n] < length)
    first = np.flatnonzero(np.diff(number, prepend=0))
    last = np.append(first[1:], n) - 1
    outside = np.maximum(shared[first], shared[last + 1])
    outside = np.minimum(outside, length - 1)[number - 1]
    edges = np.append(np.flatnonzero(shared[:n] <= length - window), n)
    for a, b in zip(edges.tolist(), edges[1:].tolist()):
        beyond = bool(ghost[a:b].any())
        strings: list[tuple[bytes, Suffix, int, bool]] = []
        for i in range(a, b):
            before, s = order[i]
            if s.ghost:
                continue
            best, high = max(before, int(shared[i + 1])), len(s.back)
            sure = -1
            if whole[i] and best >= length:
                sure = min(best - length, high)
                yield None, s.id0, s.code, s.place - sure, s.place, True
            told = before - length if i and not order[i - 1][1].ghost else -1  # the one before has given these
            for back in range(max(s.low, length - int(outside[i]), told + 1, 1), high + 1):
                digest = xxhash.xxh3_128_digest(s.back[:back][::-1] + s.key[: length - back])
                strings.append((digest, s, back, back > sure))
            if len(strings) >= STRINGS:
                beyond = True
                yield from counted(strings, beyond)
                strings = []
        yield from counted(strings, beyond)


def counted(strings: list[tuple[bytes, Suffix, int, bool]], beyond: bool) -> Iterator[tuple]:
    """What ``judged`` gives for these strings: hash, suffix, offset, open; one row of each hash if equal ones may be ``beyond``."""
    count = Counter(x[0] for x in strings)
    given: set[bytes] = set()
    # offsets of one suffix follow each other; runs of repeated ones are one range
    held: tuple[Suffix, int, int] | None = None
    for digest, s, back, is_open in strings:
        once = count[digest] < 2
        if beyond and digest not in given:
            given.add(digest)
            yield digest, s.id0, s.code, s.place - back, s.place - back, once and is_open
        if once or not is_open:
            continue
        if held and held[0] is s and held[2] + 1 == back:
            held = (s, held[1], back)
            continue
        if held:
            yield None, held[0].id0, held[0].code, held[0].place - held[2], held[0].place - held[1], True
        held = (s, back, back)
    if held:
        yield None, held[0].id0, held[0].code, held[0].place - held[2], held[0].place - held[1], True


def repeated_starts(documents: DataFrame, length: int = LENGTH, window: int = WINDOW) -> DataFrame:
    """id0, code, first, last: starts of strings that also start elsewhere, as ranges of each text."""
    spark = documents.sparkSession
    texts, copies = one_of_each(texts_by_key(documents).where(F.octet_length("text") >= length), length)
    places = repeated_anchors(texts, length, window)
    total = places.agg(F.coalesce(F.sum(F.size("places")), F.lit(0))).first()[0]
    buckets = max(1, int(total) * (length + window) // BUCKET_BYTES, int(spark.conf.get("spark.sql.shuffle.partitions")))
    cuts = splitters(texts, places, int(total), buckets, length, window)
    sent = spark.sparkContext.broadcast(cuts)

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[Suffix] = []
        size = 0

        def flush() -> pa.RecordBatch:
            parts = bucket_runs(held, sent.value, length)
            return pa.RecordBatch.from_arrays(
                [pa.array(range(len(parts)), pa.int32()), pa.array(parts, pa.binary())], ["bucket", "run"]
            )

        for batch in slices(batches, "z", 1 << 20):
            for id0, code, z, list_ in zip(*[batch.column(c).to_pylist() for c in ("id0", "code", "z", "places")]):
                data = unpacked(z)
                found = anchors([data], length, window)
                for s in suffixes(id0, code, data, set(list_), found, range(len(found["place"])), length):
                    held.append(s)
                    size += len(s.key) + 300
                if size > RUN_BYTES:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["hash", "id0", "code", "first", "last", "open"]
        kinds = pa.schema([("hash", pa.binary()), *((c, pa.int64()) for c in names[1:5]), ("open", pa.bool_())])

        def decide(blobs: list[bytes]) -> Iterator[pa.RecordBatch]:
            order = list(PrefixLoserTree([decoded_run(b, length) for b in blobs]))
            rows: list[tuple] = []
            for row in judged(order, length, window):
                rows.append(row)
                if len(rows) == 20_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k.type) for c, k in zip(zip(*rows), kinds)], schema=kinds)
                    rows = []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k.type) for c, k in zip(zip(*rows), kinds)], schema=kinds)

        now, blobs = None, []
        for batch in batches:
            for bucket, blob in zip(batch.column("bucket").to_pylist(), batch.column("run").to_pylist()):
                if bucket != now and blobs:
                    yield from decide(blobs)
                    blobs = []
                now = bucket
                blobs.append(blob)
        if blobs:
            yield from decide(blobs)

    made = compressed(texts).join(places, ["id0", "code"]).mapInArrow(tidy(runs, "suffix_dedup"), "bucket int, run binary")
    dealt = made.repartition(buckets, "bucket").sortWithinPartitions("bucket")
    found = stored(dealt.mapInArrow(tidy(merge, "suffix_dedup"), "hash binary, id0 bigint, code bigint, first bigint, last bigint, open boolean"), "starts")
    # a string may be in as many classes as there are texts: its rows are added up before they move
    twice = stored(found.where("hash is not null").groupBy("hash").count().where("count > 1").select("hash"), "strings")
    columns = ["id0", "code", "first", "last"]
    again = found.where("hash is not null and open").join(twice, "hash", "left_semi")
    return found.where("hash is null").select(*columns).unionAll(again.select(*columns)).unionAll(copies.select(*columns))


def one_of_each(texts: DataFrame, length: int) -> tuple[DataFrame, DataFrame]:
    """One row of each id0 and code, and the starts (id0, code, first, last) of those with several rows, which are all repeated."""
    copies = texts.groupBy("id0", "code").agg(F.count("*").alias("n"), F.max(F.octet_length("text")).alias("size")).where("n > 1")
    copies = stored(copies.select("id0", "code", F.lit(0).cast("bigint").alias("first"), (F.col("size") - length).cast("bigint").alias("last")), "copies")
    return texts if copies.isEmpty() else stored(texts.dropDuplicates(["id0", "code"]), "distinct"), copies


def splitters(texts: DataFrame, places: DataFrame, total: int, buckets: int, length: int, window: int) -> list[tuple]:
    """Places in the order (``Suffix.order``) that cut it into about equal buckets, from ``OVERSAMPLE`` sampled suffixes a bucket."""
    every = max(1, total // (buckets * OVERSAMPLE))
    picked = places.select("id0", "code", F.explode("places").alias("place")).where(
        F.pmod(F.xxhash64("id0", "code", "place"), F.lit(every)) == 0
    ).groupBy("id0", "code").agg(F.sort_array(F.collect_set("place")).alias("places"))

    names, kinds = ["key", "id0", "code", "place"], [pa.binary(), pa.int64(), pa.int64(), pa.int64()]

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            for id0, code, text, list_ in zip(*[batch.column(c).to_pylist() for c in ("id0", "code", "text", "places")]):
                data = text.encode()
                found = anchors([data], length, window)
                out = [s.order() for s in suffixes(id0, code, data, set(list_), found, range(len(found["place"])), length)]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)] if out else [pa.array([], k) for k in kinds], names)

    # about OVERSAMPLE * buckets rows, whatever the table's size
    sample = texts.join(F.broadcast(picked), ["id0", "code"]).mapInArrow(tidy(keys, "suffix_dedup"), "key binary, id0 bigint, code bigint, place bigint").collect()
    ordered = sorted((bytes(r["key"]), r["id0"], r["code"], r["place"]) for r in sample)
    return sorted({ordered[len(ordered) * i // buckets] for i in range(1, buckets)}) if ordered else []


def without_repeats(documents: DataFrame, length: int = LENGTH, window: int = WINDOW) -> DataFrame:
    """All columns of every row with ``n_bytes``, ``n_removed``, ``n_spans``, ``kept`` (the bytes left) and ``kept_text``.

    ``kept_text`` is ``kept`` as text, without characters of which a part is gone; null
    where the text is null.

    Texts are UTF-8 bytes, null ones empty; matches never cross texts. Rows of one id
    and one text are documents of their own, so they repeat each other. Texts shorter
    than ``length`` lose nothing. Columns that clash with an added one are replaced. An
    empty table stays empty.
    """
    if window + GRAM - 1 > length:
        raise ValueError("the window and its last gram must lie inside the length")
    names = ["n_bytes", "n_removed", "n_spans", "kept", "kept_text"]
    spans = repeated_starts(documents, length, window).groupBy("id0", "code").agg(
        F.collect_list(F.struct("first", "last")).alias("spans")
    )
    plain = documents.drop(*names)
    columns = [c for c in plain.columns if c != "text"]
    rows = plain.select(
        F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"), F.col("text").isNull().alias("none"),
        F.coalesce("doc_id", F.xxhash64(F.coalesce("text", F.lit("")))).cast("bigint").alias("id0"),
        F.xxhash64("doc_id", F.coalesce("text", F.lit(""))).alias("code"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    joined = compressed(rows).join(spans, ["id0", "code"], "left").select("row", "none", "z", "spans")
    kind = joined.schema["row"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "z", 1 << 20):
            out = []
            for z, spans in zip(batch.column("z").to_pylist(), batch.column("spans").to_pylist()):
                data, kept, at, count = unpacked(z), [], 0, 0
                runs: list[list[int]] = []
                for a, b in sorted((s["first"], s["last"] + length) for s in spans or ()):
                    if runs and a <= runs[-1][1]:
                        runs[-1][1] = max(runs[-1][1], b)
                    else:
                        runs.append([a, b])
                for a, b in runs:
                    kept.append(data[at:a])
                    at, count = b, count + b - a
                kept.append(data[at:])
                out.append((data, len(data), count, len(runs), b"".join(kept)))
            texts, sizes, removed, numbers, left = zip(*out) if out else ((),) * 5
            none = batch.column("none").to_pylist()
            text = [None if x else t.decode() for x, t in zip(none, texts)]
            kept_text = [None if x else t if not n else k.decode("utf-8", "ignore") for x, t, n, k in zip(none, text, removed, left)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(text, pa.string()), *(pa.array(x, pa.int64()) for x in (sizes, removed, numbers)),
                 pa.array(left, pa.binary()), pa.array(kept_text, pa.string())],
                ["row", "text", *names],
            )

    made = joined.mapInArrow(tidy(run, "suffix_dedup"), f"row {kind}, text string, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary, kept_text string")
    return made.select(*[F.col(f"row.`{c}`") if c != "text" else F.col("text") for c in plain.columns], *names)
