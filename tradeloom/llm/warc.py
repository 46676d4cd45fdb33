"""Web archives: WARC records with revisits, and capture histories by external merge.

Every writing task makes one archive, each record a gzip member. Every archive is then
read back record by record; its captures form locally sorted runs of lines
``key time page {rest}``. A loser tree merges the runs by URL key and time: first groups
of ``FAN_IN`` runs into longer ones until one group is left, then, by ranges of whole
lines, that group into the globally ordered history; a URL of many captures is in as many
ranges as it needs. A sparse index beside each run leads to the start of a range. Files
are below the shared folder; the driver sees one small row a file and ``SPLITS`` lines a
run.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import json
import zlib
from collections.abc import Callable, Iterable, Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeloom.llm.common import narrow, stored
from tradeloom.llm.files import locate, write_whole
from tradeloom.session import scratch_path

FAN_IN = 256
RUN_LINES = 200_000
SPARSE = 512
SPLITS = 32
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
NO_PAGE = "none"


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def url_key(url: str) -> str:
    """Host labels from the right, then path and query: ``example,www)/a?b``; no scheme, port of the scheme or fragment."""
    try:
        parts = urlsplit(url.strip())
        host, port = (parts.hostname or ""), parts.port
    except ValueError:
        return quoted(url.lower())
    if not host:
        return quoted(url.lower())
    host = host.removeprefix("www.")
    tail = "" if port in (None, 80, 443) else f":{port}"
    query = f"?{parts.query}" if parts.query else ""
    return quoted(f"{','.join(reversed(host.split('.')))}{tail}){parts.path or '/'}{query}")


def quoted(text: str) -> str:
    """White space and control characters as percent escapes, so that a line has its fields."""
    return "".join(c if c > " " and not c.isspace() and c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in text)


def record(page: int | None, url: str | None, time: str, payload: bytes, size: int, digest: str, refers: int | None) -> bytes:
    """One gzip member: a response with its payload, or a revisit that only names the response."""
    name = NO_PAGE if page is None else str(page)
    head = {
        "WARC-Type": "response" if refers is None else "revisit",
        "WARC-Record-ID": f"<urn:x-page:{name}>",
        "WARC-Date": time,
        "WARC-Target-URI": None if url is None else quoted(url),
        "WARC-Payload-Digest": f"sha1:{digest}",
        "X-Payload-Length": str(size),
    }
    block = HTTP + b"Content-Length: %d\r\n\r\n" % size
    if refers is None:
        block += payload
    else:
        head |= {"WARC-Profile": PROFILE, "WARC-Refers-To": f"<urn:x-page:{refers}>"}
    head |= {"Content-Type": "application/http; msgtype=response", "Content-Length": str(len(block))}
    lines = "".join(f"{k}: {v}\r\n" for k, v in head.items() if v is not None)
    tool = zlib.compressobj(1, wbits=31)
    return tool.compress(f"WARC/1.1\r\n{lines}\r\n".encode() + block + b"\r\n\r\n") + tool.flush()


def members(stream) -> Iterator[tuple[int, int, bytes]]:
    """Offset, length and content of every gzip member of a stream."""
    offset, rest = 0, b""
    while True:
        tool, parts, used = zlib.decompressobj(wbits=31), [], 0
        while not tool.eof:
            data = rest or stream.read(1 << 20)
            rest = b""
            if not data:
                if used:
                    raise ValueError("the archive ends inside a record")
                return
            parts.append(tool.decompress(data))
            used += len(data)
        rest = tool.unused_data
        used -= len(rest)
        yield offset, used, b"".join(parts)
        offset += used


def capture(content: bytes) -> dict:
    """What a record says; a response's payload is checked against its digest."""
    head, _, body = content.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = body[: int(fields["Content-Length"])]
    payload = block.partition(b"\r\n\r\n")[2]
    digest, size = fields["WARC-Payload-Digest"].removeprefix("sha1:"), int(fields["X-Payload-Length"])
    if fields["WARC-Type"] == "response" and (len(payload) != size or base32_sha1(payload) != digest):
        raise ValueError(f"payload of {fields['WARC-Record-ID']} differs from its digest")
    return {
        "page": page_of(fields["WARC-Record-ID"]), "time": fields["WARC-Date"], "url": fields.get("WARC-Target-URI"),
        "type": fields["WARC-Type"], "digest": digest, "bytes": size, "refers": page_of(fields.get("WARC-Refers-To", "")),
    }


def page_of(name: str) -> int | None:
    number = name.rpartition(":")[2].rstrip(">")
    return None if number in ("", NO_PAGE) else int(number)


Line = tuple[str, str, int, str]  # URL key, time, page (lowest for none), rest as JSON


def line_of(text: str) -> Line:
    key, time, page, rest = text.split(" ", 3)
    return key, time, int(page), rest


class LoserTree:
    """Merges sorted sources; every inner node keeps the loser of its match, the winner moves up."""

    def __init__(self, sources: list[Iterator[Line]]) -> None:
        self.sources = sources
        self.heads: list[Line | None] = [next(s, None) for s in sources]
        self.size = len(sources)
        self.losers = [-1] * max(self.size, 1)
        for i in range(self.size):
            self.play(i)

    def before(self, a: int, b: int) -> bool:
        """Whether source a's head comes before b's; an empty source comes last, equal lines by source."""
        x, y = self.heads[a], self.heads[b]
        if x is None or y is None:
            return y is None and (x is not None or a < b)
        return (x, a) < (y, b)

    def play(self, winner: int) -> None:
        node = (winner + self.size) // 2
        while node:
            other = self.losers[node]
            if other < 0:  # the first to come waits here
                self.losers[node] = winner
                return
            if self.before(other, winner):
                self.losers[node], winner = winner, other
            node //= 2
        self.losers[0] = winner

    def __iter__(self) -> Iterator[Line]:
        if not self.size:
            return
        while (head := self.heads[self.losers[0]]) is not None:
            yield head
            at = self.losers[0]
            self.heads[at] = next(self.sources[at], None)
            self.play(at)


def write_run(path: str, lines: Iterable[Line]) -> list[str]:
    """Write sorted lines and their sparse index; a few lines at even distance come back."""
    sparse: list[tuple[str, int]] = []

    def write(out) -> None:
        at = 0
        for i, line in enumerate(lines):
            text = " ".join(map(str, line))
            if i % SPARSE == 0:
                sparse.append((text, at))
            data = (text + "\n").encode()
            out.write(data)
            at += len(data)

    write_whole(path, write)
    write_whole(f"{path}.sparse", lambda out: out.write(json.dumps(sparse).encode()))
    step = max(1, len(sparse) // SPLITS)
    return [x for x, _ in sparse[::step]]


def read_run(path: str, low: Line | None = None, high: Line | None = None) -> Iterator[Line]:
    """Lines of a run from ``low`` on and below ``high``."""
    fs, name = locate(path)
    start = 0
    if low is not None:
        with fs.open_input_stream(f"{name}.sparse") as f:
            sparse = json.loads(f.read())
        at = bisect.bisect_left(sparse, low, key=lambda x: line_of(x[0]))
        start = sparse[at - 1][1] if at else 0
    with fs.open_input_file(name) as f:
        f.seek(start)
        rest = b""
        while data := f.read(1 << 16):
            *whole, rest = (rest + data).split(b"\n")
            for raw in whole:
                line = line_of(raw.decode())
                if high is not None and line >= high:
                    return
                if low is None or line >= low:
                    yield line


def write_archives(pages: DataFrame, folder: str, min_bytes: int = 0) -> list[str]:
    """One archive a task from page_id, url, html and captured (timestamp); gives their paths.

    Of pages with equal payloads of at least ``min_bytes``, that with the smallest
    page_id is the response and the others revisit it. Pages without an id are responses.
    Only payloads that occur again meet the pages in a join, over an exchange on both
    sides that splits a hot payload.
    """
    rows = narrow(pages, "page_id", "url", "html", "captured").withColumn("html", F.coalesce("html", F.lit("")))
    rows = rows.withColumn("sha1", F.unhex(F.sha1("html"))).withColumn("size", F.octet_length("html").cast("bigint"))
    again = rows.where((F.col("size") >= min_bytes) & F.col("page_id").isNotNull()).groupBy("sha1").agg(
        F.min("page_id").alias("first"), F.max("page_id").alias("last")
    ).where("first < last").select("sha1", "first")
    known = rows.join(stored(again, "payloads"), "sha1", "left")
    refers = F.when((F.col("page_id") > F.col("first")) & (F.col("size") >= min_bytes), F.col("first").cast("bigint"))
    time = F.date_format("captured", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    out = known.select(
        F.col("page_id").cast("bigint").alias("page"), "url", F.coalesce(time, F.lit("1970-01-01T00:00:00Z")).alias("time"),
        F.col("html").cast("binary").alias("payload"), "size", "sha1", refers.alias("refers"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        path = f"{folder}/{TaskContext.get().partitionId():06d}.warc.gz"
        first = next(batches, None)
        if first is None:
            return

        def write(stream) -> None:
            batch = first
            while batch is not None:
                for i in range(batch.num_rows):
                    page, url, time, payload, size, sha1, refers = (c[i].as_py() for c in batch.columns)
                    stream.write(record(page, url, time, payload, size, base64.b32encode(sha1).decode(), refers))
                batch = next(batches, None)

        write_whole(path, write)
        yield pa.RecordBatch.from_pydict({"path": [path]})

    return sorted(r["path"] for r in out.mapInArrow(run, "path string").collect())


def over_files(spark: SparkSession, groups: list[list[str]], work: Callable[[int, list[str]], Iterator[tuple]], schema: str, names: list[str]) -> DataFrame:
    """Rows that ``work`` makes of each group of files, a task for each group."""
    table = spark.createDataFrame(list(enumerate(groups)), "number int, paths array<string>")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, paths in zip(batch.column("number").to_pylist(), batch.column("paths").to_pylist()):
                rows: list[tuple] = []
                for row in work(number, paths):
                    rows.append(row)
                    if len(rows) == 10_000:
                        yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in rows], kinds)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in rows], kinds)

    from pyspark.sql.pandas.types import to_arrow_schema

    kinds = to_arrow_schema(spark.createDataFrame([], schema).schema)
    return table.repartitionByRange(max(len(groups), 1), "number").mapInArrow(run, schema)


def index_archives(spark: SparkSession, archives: list[str], folder: str) -> list[tuple[str, list[str]]]:
    """Read every archive back and write its captures as sorted runs; gives path and split lines of each."""

    def work(number: int, paths: list[str]) -> Iterator[tuple]:
        for path in paths:
            lines, part = [], 0
            fs, name = locate(path)
            with fs.open_input_stream(name, compression=None) as stream:
                for offset, length, content in members(stream):
                    c = capture(content)
                    rest = {k: c[k] for k in ("type", "digest", "bytes", "refers", "url")}
                    rest |= {"file": name.rpartition("/")[2], "offset": offset, "length": length}
                    page = -(2**63) if c["page"] is None else c["page"]
                    stamp = "".join(x for x in c["time"] if x.isdigit())
                    lines.append((url_key(c["url"] or "-"), stamp, page, json.dumps(rest)))
                    if len(lines) == RUN_LINES:
                        yield f"{folder}/run-{number:06d}-{part}", write_run(f"{folder}/run-{number:06d}-{part}", sorted(lines))
                        lines, part = [], part + 1
            if lines:
                yield f"{folder}/run-{number:06d}-{part}", write_run(f"{folder}/run-{number:06d}-{part}", sorted(lines))

    rows = over_files(spark, [[a] for a in archives], work, "path string, splits array<string>", ["path", "splits"])
    return sorted((r["path"], r["splits"]) for r in rows.collect())


def merged(spark: SparkSession, runs: list[tuple[str, list[str]]], folder: str) -> list[tuple[str, list[str]]]:
    """Merge groups of runs into longer runs until at most ``FAN_IN`` are left."""
    level = 0
    while len(runs) > FAN_IN:
        level += 1
        groups = [[p for p, _ in runs[i : i + FAN_IN]] for i in range(0, len(runs), FAN_IN)]

        def work(number: int, paths: list[str], level: int = level) -> Iterator[tuple]:
            path = f"{folder}/level-{level}-{number:06d}"
            yield path, write_run(path, LoserTree([read_run(p) for p in paths]))

        rows = over_files(spark, groups, work, "path string, splits array<string>", ["path", "splits"])
        runs = sorted((r["path"], r["splits"]) for r in rows.collect())
    return runs


HISTORY = (
    "url_key string, captured_at string, page_id bigint, record_type string, payload_digest string, "
    "payload_bytes bigint, refers_to bigint, url string, file string, offset bigint, length bigint"
)


def history(spark: SparkSession, runs: list[tuple[str, list[str]]], ranges: int | None = None) -> DataFrame:
    """The captures of all runs, ordered by URL key, time and page over the partitions of the result."""
    lines = sorted(line_of(x) for _, splits in runs for x in splits)
    ranges = ranges or max(1, min(int(spark.conf.get("spark.sql.shuffle.partitions")), len(lines) // 8))
    cuts = sorted({lines[len(lines) * i // ranges] for i in range(1, ranges)}) if lines else []
    bounds = list(zip([None, *cuts], [*cuts, None]))
    paths = [p for p, _ in runs]

    def work(number: int, _: list[str]) -> Iterator[tuple]:
        low, high = bounds[number]
        for key, time, page, rest in LoserTree([read_run(p, low, high) for p in paths]):
            r = json.loads(rest)
            yield (
                key, time, None if page == -(2**63) else page, r["type"], r["digest"], r["bytes"], r["refers"], r["url"],
                r["file"], r["offset"], r["length"],
            )

    names = [x.split()[0] for x in HISTORY.split(", ")]
    return over_files(spark, [[] for _ in bounds] if runs else [], work, HISTORY, names)


def archive(pages: DataFrame, folder: str | None = None, min_bytes: int = 0) -> DataFrame:
    """Write pages as archives, read them back, and give their ordered capture history.

    ``pages`` has page_id, url, html and captured. Null html is an empty payload, a null
    url is kept as null under the key ``-``, a null time is the start of 1970. Repeated
    rows are records of their own; those with the smallest id of a payload are all
    responses. Empty tables give an empty history. Extra columns are not read.
    """
    spark = pages.sparkSession
    folder = folder or scratch_path(spark, "warc")
    archives = write_archives(pages, folder, min_bytes)
    runs = merged(spark, index_archives(spark, archives, folder), folder)
    return history(spark, runs)
