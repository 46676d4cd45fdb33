"""Toxicity scores: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Words of the lower-cased text, pairs of neighbours and pairs with one or two words
between them are hashed to ``2**BITS`` coordinates; a text has each coordinate once.
Every coordinate has a learning rate of its own, and the L1 term keeps most weights at
zero, so the model is a short list that is broadcast to the scoring tasks.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeloom.llm.common import CACHES, narrow, slices, texts_of, tidy

BITS = 20
MAX_TRAIN_ROWS = 12_000
MIN_SEEN = 4
WORD = re.compile(r"\w+")
GAPS = (1, 2, 3)
KNOWN: dict[str, int] = {}
KNOWN_ENTRIES = 100_000
CACHES["toxicity"] = KNOWN.clear


def word_hash(word: str) -> int:
    out = xxhash.xxh64_intdigest(word.encode(), 7)
    if len(KNOWN) < KNOWN_ENTRIES:
        KNOWN[word] = out
    return out


def coordinates(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Text number and coordinate of every n-gram and skip-gram, repeats included."""
    words = [WORD.findall(t.lower()) for t in texts]
    lengths = np.array([len(w) for w in words])
    hashes = np.fromiter((KNOWN.get(w) or word_hash(w) for x in words for w in x), np.uint64, int(lengths.sum()))
    owner = np.repeat(np.arange(len(texts)), lengths)
    shift = np.uint64(64 - BITS)
    parts, owners = [(hashes * np.uint64(0x9E3779B97F4A7C15)) >> shift], [owner]
    for gap in GAPS:
        same = owner[:-gap] == owner[gap:]
        pair = hashes[:-gap] * np.uint64(0xC2B2AE3D27D4EB4F) + np.uint64(gap)
        pair = (pair ^ (pair >> np.uint64(29))) + hashes[gap:]
        parts.append(((pair * np.uint64(0x165667B19E3779F9)) >> shift)[same])
        owners.append(owner[:-gap][same])
    return np.concatenate(owners), np.concatenate(parts).astype(np.int64)


class Ftrl:
    """Per-coordinate follow-the-regularised-leader, one example at a time."""

    def __init__(self, alpha: float = 1.0, beta: float = 1.0, l1: float = 8.0, l2: float = 1.0) -> None:
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z = np.zeros((1 << BITS) + 1)
        self.n = np.zeros((1 << BITS) + 1)

    def weights(self, at: np.ndarray) -> np.ndarray:
        z = self.z[at]
        scale = (self.beta + np.sqrt(self.n[at])) / self.alpha + self.l2
        return np.where(np.abs(z) <= self.l1, 0.0, (np.sign(z) * self.l1 - z) / scale)

    def learn(self, at: np.ndarray, label: int) -> None:
        """``at`` holds distinct coordinates; the last coordinate of the model is its bias."""
        at = np.append(at, 1 << BITS)
        w = self.weights(at)
        g = 1 / (1 + math.exp(-max(-35.0, min(35.0, float(w.sum()))))) - label
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha * w
        self.n[at] = n + g * g


def train(documents: DataFrame, labels: DataFrame, rows: int = MAX_TRAIN_ROWS, passes: int = 4) -> tuple[list[int], list[float]]:
    """Coordinates and weights of the model.

    ``labels`` has doc_id and toxic (0 or 1); rows with a null in either are left out, and
    the largest label of an id counts. The examples are a bounded sample: the ``rows``
    labelled ids with the smallest hash, each an example with the smallest of its texts,
    however many rows it has. Only their features go to one task, which learns one example
    after another in the order of the hash.
    Coordinates of fewer than ``MIN_SEEN`` examples are left out.
    Without any example the model has no weight at all.
    """
    sample = (
        narrow(labels, "doc_id", "toxic").dropna().groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
        .withColumn("place", F.xxhash64(F.col("doc_id").cast("string"))).orderBy("place", "doc_id").limit(rows)
    )

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, limit=1 << 20):
            owner, at = coordinates(texts_of(batch))
            keys = np.unique((owner << 32) | at)
            counts = np.bincount(keys >> 32, minlength=batch.num_rows)
            at32 = (keys & 0xFFFFFFFF).astype("<u4")
            cuts = np.concatenate([[0], np.cumsum(counts)])
            data = [at32[i:j].tobytes() for i, j in zip(cuts[:-1], cuts[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column("place"), batch.column("toxic"), pa.array(data, pa.binary())], ["place", "toxic", "at"]
            )

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        examples = [x for batch in batches for x in zip(*[c.to_pylist() for c in batch.columns])]
        examples = sorted(examples)[:rows]
        seen = np.zeros(1 << BITS, np.int64)
        for _, _, at in examples:
            seen[np.frombuffer(at, "<u4")] += 1
        often, model = seen >= MIN_SEEN, Ftrl()
        for i, (place, label, at) in enumerate(examples):
            own = np.frombuffer(at, "<u4")
            examples[i] = (place, label, own[often[own]])
        for _ in range(passes):
            for _, label, at in examples:
                model.learn(at.astype(np.int64), label)
        weights = model.weights(np.arange((1 << BITS) + 1))
        kept = np.flatnonzero(weights)
        yield pa.RecordBatch.from_pydict({
            "at": pa.array([kept.tolist()], pa.list_(pa.int64())),
            "weight": pa.array([weights[kept].tolist()], pa.list_(pa.float64())),
        })

    texts = narrow(documents, "doc_id", "text").join(F.broadcast(sample), "doc_id")  # at most ``rows`` ids
    texts = texts.groupBy("doc_id", "place", "toxic").agg(F.min("text").alias("text"))
    made = texts.select("text", "place", "toxic").mapInArrow(tidy(features, "toxicity"), "place bigint, toxic int, at binary")
    model = made.repartition(1).mapInArrow(tidy(learn, "toxicity"), "at array<bigint>, weight array<double>").collect()
    return (model[0]["at"], model[0]["weight"]) if model else ([], [])


def score(documents: DataFrame, model: tuple[list[int], list[float]], threshold: float = 0.3) -> DataFrame:
    """All columns of every row with ``score`` (0 to 1) and ``predicted`` (1 from the threshold on).

    Null and empty texts have the score of the bias alone. Nothing but the text is an
    input. Columns that clash with the two are replaced. No shuffle; the model's size is
    bounded by the number of coordinates.
    """
    sent = documents.sparkSession.sparkContext.broadcast(
        (np.array(model[0], np.int64), np.array(model[1], np.float64))
    )
    kept = [f for f in documents.schema.fields if f.name not in ("score", "predicted")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight = np.zeros((1 << BITS) + 1)
        weight[sent.value[0]] = sent.value[1]
        used = weight != 0
        for batch in slices(batches, limit=1 << 20):
            owner, at = coordinates(texts_of(batch))
            live = used[at]
            keys = np.unique((owner[live] << 32) | at[live])
            total = np.bincount(keys >> 32, weight[keys & 0xFFFFFFFF], batch.num_rows) + weight[-1]
            column = pa.array(1 / (1 + np.exp(-np.clip(total, -500, 500))), pa.float64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(f.name) for f in kept] + [column], [f.name for f in kept] + ["score"]
            )

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept] + ["score double"])
    return documents.mapInArrow(tidy(run, "toxicity"), schema).withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def held_out() -> Column:
    """True for documents whose labels are never learned."""
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == 2, F.lit(False))
