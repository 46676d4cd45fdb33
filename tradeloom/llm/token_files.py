"""Token ids as flat unsigned integer files with 64-bit document offsets.

Documents are dealt by ranges of their id. Every range becomes three files:

* ``NNNNNN.ids``: the ids of all its documents, little-endian ``uint16`` if every id of
  the vocabulary fits, else ``uint32``;
* ``NNNNNN.off``: ``int64`` offsets, one more than documents, counted from the range's
  own first id;
* ``NNNNNN.doc``: ``int64`` document ids, with ``-2**63`` for a null id.

The place of a range among all ids is the prefix sum of the token counts of the ranges
before it; only these counts, one small row a range, come to the driver.

A text is cut where a run of white space begins. The byte-level pre-tokenizer starts a
new pre-token there whatever stands before, so pieces can be encoded apart, and the
library encodes each distinct piece once. Models for which this does not hold are given
whole texts.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeloom.llm.common import CACHES, blocks, narrow, slices, texts_of, tidy
from tradeloom.llm.files import mapped, write_whole
from tradeloom.session import scratch_path

NO_ID = -(2**63)
CACHE_ENTRIES = 300_000
#: bytes of text whose words are looked up together
GATHERED = 4 << 20
# Unicode's White_Space, which the pre-tokenizer's pattern uses; Python's \s has four more
SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
WORDS = re.compile(f"[{SPACE}]*[^{SPACE}]+|[{SPACE}]+")


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@dataclass(frozen=True)
class TokenFiles:
    """Where the files are, and for every range its number, first id's place and documents."""

    folder: str
    dtype: str
    ranges: list[tuple[int, int, int]]


class Encoder:
    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        with open(path, encoding="utf-8") as f:
            config = json.load(f)
        pre = config["pre_tokenizer"] or {}
        plain = all(
            not (t["lstrip"] or t["rstrip"] or t["single_word"] or re.search(f"[{SPACE}]", t["content"]))
            for t in config["added_tokens"]
        )
        self.by_words = plain and config["normalizer"] is None and pre.get("type") == "ByteLevel" and (
            pre.get("use_regex", True) and not pre.get("add_prefix_space", True)
        )
        self.known: dict[str, bytes] = {}
        self.widths = np.zeros(self.tokenizer.get_vocab_size(), np.int64)
        if self.by_words:  # a token's characters stand for bytes one to one; an added token for itself
            for token, i in self.tokenizer.get_vocab().items():
                self.widths[i] = len(token)
            for t in config["added_tokens"]:
                self.widths[t["id"]] = len(t["content"].encode())

    def batch(self, texts: list[str]) -> list[bytes]:
        encoded = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in encoded]

    def ids_of_words(self, words: list[str]) -> dict[str, bytes]:
        """Words that start with a space and do not end in one are encoded end to end and cut by their bytes."""
        easy = [w for w in words if w[:1] in (" ", "\n") and not w[-1].isspace()]
        rest = [w for w in words if w[:1] not in (" ", "\n") or w[-1].isspace()]
        out = dict(zip(rest, self.batch(rest)))
        parts = [easy[a:b] for a, b in blocks([len(w) for w in easy], 20_000)]
        for part, e in zip(parts, self.tokenizer.encode_batch_fast(["".join(x) for x in parts], add_special_tokens=False)):
            ids = np.array(e.ids, "<u4")
            ends = np.cumsum([len(w.encode()) for w in part])
            stops = (np.searchsorted(np.cumsum(self.widths[ids]), ends) + 1) * 4
            data, start = ids.tobytes(), 0
            for w, stop in zip(part, stops.tolist()):
                out[w] = data[start:stop]
                start = stop
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit integers."""
        if not self.by_words:
            return self.batch(texts)
        words = [WORDS.findall(t) for t in texts]
        distinct = set(chain.from_iterable(words))
        table = dict(zip(distinct, map(self.known.get, distinct)))
        fresh = self.ids_of_words([w for w, ids in table.items() if ids is None])
        table.update(fresh)
        if len(self.known) < CACHE_ENTRIES:  # only the first words met are remembered
            self.known.update(fresh)
        return [b"".join(map(table.__getitem__, w)) for w in words]


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    return Encoder(path)


CACHES["token_files"] = encoder.cache_clear


def write_token_files(
    documents: DataFrame, folder: str | None = None, tokenizer_path: str | None = None, end_id: int = 0,
    ranges: int | None = None,
) -> TokenFiles:
    """Write the ids of every text, in ascending order of ``doc_id``, each with ``end_id`` after it.

    Null text is empty and still has its end id. Null ids come first; rows of one id
    follow each other, shorter and then smaller texts first. Only ``doc_id`` and
    ``text`` are read. An empty table gives no range.
    """
    spark = documents.sparkSession
    path = tokenizer_path or default_tokenizer()
    folder = folder or scratch_path(spark, "tokens")
    width = "<u2" if max(encoder(path).tokenizer.get_vocab_size(), end_id + 1) <= 1 << 16 else "<u4"
    ranges = ranges or max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        tool, number = encoder(path), TaskContext.get().partitionId()
        ends, docs, end = [0], [], np.array([end_id], width).tobytes()

        def encoded(texts: list[str], out) -> None:
            for ids in tool.encode(texts):
                out.write(np.frombuffer(ids, "<u4").astype(width).tobytes() + end)
                ends.append(ends[-1] + len(ids) // 4 + 1)

        def write(out) -> None:
            held, size = [], 0
            for batch in slices(batches):
                docs.extend(NO_ID if d is None else d for d in batch.column("doc_id").to_pylist())
                held += texts_of(batch)
                size += batch.nbytes
                if size > GATHERED:
                    encoded(held, out)
                    held, size = [], 0
            encoded(held, out)

        name = f"{folder}/{number:06d}"
        write_whole(f"{name}.ids", write)
        if docs:
            write_whole(f"{name}.off", lambda out: out.write(np.array(ends, "<i8").tobytes()))
            write_whole(f"{name}.doc", lambda out: out.write(np.array(docs, "<i8").tobytes()))
            yield pa.RecordBatch.from_pydict({
                "number": pa.array([number], pa.int32()), "documents": [len(docs)], "tokens": [int(ends[-1])]
            })

    rows = narrow(documents, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("bigint"))
    dealt = rows.repartitionByRange(ranges, F.col("doc_id").asc_nulls_first()).sortWithinPartitions(
        F.col("doc_id").asc_nulls_first(), F.length("text").asc_nulls_first(), F.col("text").asc_nulls_first()
    )
    written = sorted(dealt.mapInArrow(tidy(run, "token_files"), "number int, documents bigint, tokens bigint").collect())
    base, out = 0, []
    for r in written:
        out.append((r["number"], base, r["documents"]))
        base += r["tokens"]
    return TokenFiles(folder, width, out)


def read_token_files(spark: SparkSession, files: TokenFiles) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, from the mapped files alone."""
    kind, folder = files.dtype, files.folder

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, base in zip(batch.column("number").to_pylist(), batch.column("base").to_pylist()):
                name = f"{folder}/{number:06d}"
                ids, ends, docs = mapped(f"{name}.ids", kind), mapped(f"{name}.off", "<i8"), mapped(f"{name}.doc", "<i8")
                for a in range(0, len(docs), 4096):
                    part = ends[a : a + 4097]
                    crc = [zlib.crc32(ids[i:j].astype("<u4").tobytes()) for i, j in zip(part[:-1], part[1:])]
                    own = docs[a : a + 4096]
                    yield pa.RecordBatch.from_pydict({
                        "doc_id": pa.array(own, pa.int64(), mask=own == NO_ID),
                        "start": pa.array(part[:-1] + base),
                        "n_tokens": pa.array(np.diff(part)),
                        "ids_crc32": pa.array(crc, pa.int64()),
                    })

    table = spark.createDataFrame(files.ranges, "number int, base bigint, documents bigint")
    spread = table.repartition(max(len(files.ranges), 1), "number")
    return spread.mapInArrow(tidy(run, "token_files"), "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def document_ids(files: TokenFiles, place: int) -> np.ndarray:
    """Ids of the document at a place of the id order (0 is the first), as a training loop reads them."""
    for number, _, documents in files.ranges:
        if place < documents:
            name = f"{files.folder}/{number:06d}"
            a, b = mapped(f"{name}.off", "<i8")[place : place + 2]
            return mapped(f"{name}.ids", files.dtype)[a:b]
        place -= documents
    raise IndexError(place)
