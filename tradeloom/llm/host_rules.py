"""Quality rules judged by host: failure rates of a host's documents, shrunk by an empirical beta prior.

Every document is measured on its own. Failures of each rule are added up by host, and the
hosts together give the rule's prior: its mean is the share of failing documents, its
strength follows from how much the hosts' rates differ beyond chance (moments of the
beta-binomial). A host's rate is then ``(failures + mean * strength) / (documents + strength)``:
a host of few documents is judged by what is usual, a large one by itself. A host whose
rate of any rule is over that rule's limit is rejected with all its documents.

Only sums meet: a host's counts are added before the shuffle, and the prior is one row.
Verdicts come back by an equality join, which the adaptive skew rule splits if a host holds
a large share of the documents.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradeloom.llm.common import slices, stored, texts_of, tidy

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SYMBOLS = re.compile(r"[#*$%&|<>]")
WHITE = " \t\n\x0b\x0c\r"
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
MEASURES = (*BASE, "n_lines")


@dataclass(frozen=True)
class Rule:
    """A document fails where ``failed`` is true; a host is rejected if its shrunk rate is over ``limit``."""

    name: str
    failed: str
    limit: float = 0.5
    base: bool = False


#: the first two are the base rules
RULES = (
    Rule("short", "n_words < 50", base=True),
    Rule("repeats", "100 * n_repeat_words > 50 * n_words", base=True),
    Rule("symbols", "10 * n_symbols > n_words"),
    Rule("dup_lines", "2 * n_dup_lines > n_lines"),
)


def repeat_words(texts: list[list[str]]) -> np.ndarray:
    """Words of each text that lie in a run of three words found at least twice in that text."""
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    known: dict[str, int] = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for words in texts for w in words), np.int64, int(lengths.sum()))
    if len(ids) < 3:
        return np.zeros(len(texts), np.int64)
    owner = np.repeat(np.arange(len(texts)), lengths)
    at = np.flatnonzero(owner[:-2] == owner[2:])
    key = owner[at]
    for k in range(3):  # a key is a rank among at most as many keys as there are words
        _, key = np.unique(key * len(known) + ids[at + k], return_inverse=True)
    often = at[np.bincount(key, minlength=1)[key] > 1]
    covered = np.zeros(len(ids), bool)
    for k in range(3):
        covered[often + k] = True
    return np.bincount(owner[covered], minlength=len(texts))


def measured(texts: list[str]) -> list[np.ndarray]:
    """The measures of ``MEASURES`` for each text."""
    words = [WORD.findall(t) for t in texts]
    lines = [[x for x in t.split("\n") if x.strip(WHITE)] for t in texts]
    rows = [
        (len(w), sum(map(len, w)), len(SYMBOLS.findall(t)), len(x) - len(set(x)), len(x))
        for t, w, x in zip(texts, words, lines)
    ]
    n_words, chars, symbols, dup, n_lines = (np.array(c, np.int64) for c in zip(*rows))
    return [n_words, chars, symbols, dup, repeat_words(words), n_lines]


def measure(documents: DataFrame, host: str = "source", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns ``keep``, ``host`` and the measures of every whole text; null text has no words."""
    wanted = [F.col(f"`{c}`") for c in keep] + [F.col(f"`{host}`").cast("string").alias("host"), F.col("text")]
    rows = documents.select(*wanted)
    fields = [rows.schema[c] for c in (*keep, "host")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            if batch.num_rows:
                arrays = [batch.column(f.name) for f in fields] + [pa.array(x, pa.int64()) for x in measured(texts_of(batch))]
                yield pa.RecordBatch.from_arrays(arrays, [*(f.name for f in fields), *MEASURES])

    schema = T.StructType(fields + [T.StructField(name, T.LongType()) for name in MEASURES])
    return rows.mapInArrow(tidy(run, "host_rules"), schema)


def failures(rules: tuple[Rule, ...], base: bool | None = None) -> Column:
    """True for a document that fails any of the rules."""
    out = F.lit(False)
    for r in rules:
        if base is None or r.base == base:
            out = out | F.expr(r.failed)
    return out


def host_verdicts(measures: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """host, n_docs, for each rule its failures and its shrunk rate, and ``rejected``.

    Null is a host of its own. The strength of a prior lies between 1 and the number of all
    documents; the latter where hosts differ no more than by chance. No document, no row.
    """
    hosts = measures.groupBy("host").agg(
        F.count("*").alias("n_docs"), *[F.count(F.when(F.expr(r.failed), 1)).alias(r.name) for r in rules]
    )
    hosts = stored(hosts, "hosts")
    n = F.col("n_docs").cast("double")
    total = hosts.agg(
        F.sum(n).alias("docs"), F.count("*").alias("hosts"), F.sum(n * n).alias("squares"),
        *[F.sum(r.name).cast("double").alias(r.name) for r in rules],
        *[F.sum(F.col(r.name) * F.col(r.name) / n).alias(f"{r.name}_spread") for r in rules],
    ).first()
    out, rejected = hosts, F.lit(False)
    for r in rules:
        docs = total["docs"] or 1.0
        mean = (total[r.name] or 0.0) / docs
        strength = prior_strength(docs, total["hosts"], total["squares"] or 0.0, mean, total[f"{r.name}_spread"] or 0.0)
        rate = (F.col(r.name) + F.lit(mean * strength)) / (n + F.lit(strength))
        out = out.withColumn(f"{r.name}_rate", rate)
        rejected = rejected | (F.col(f"{r.name}_rate") > r.limit)
    return out.withColumn("rejected", rejected)


def prior_strength(docs: float, hosts: int, squares: float, mean: float, spread: float) -> float:
    """alpha + beta of the prior from sums over hosts: of n, of n squared and of failures squared by n."""
    chance, room = mean * (1 - mean), docs - squares / docs
    if chance <= 0 or room <= 0:
        return docs
    between = (spread - mean * mean * docs - (hosts - 1) * chance) / room
    return docs if between <= 0 else min(max(chance / between - 1, 1.0), docs)


def judge(documents: DataFrame, host: str = "source", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id, host, the measures, base_failed, host_rejected and kept of every document.

    A document is kept if it fails no rule itself and its host is not rejected. Reads
    ``doc_id``, ``text`` and the host column; other columns are left out, whatever their
    names. Null or empty text has no words and fails as short; null hosts are one host;
    repeated rows count and are returned as often as they come; an empty table gives no row.
    """
    measures = stored(measure(documents, host), "measures")
    verdicts = host_verdicts(measures, rules).where("rejected").select(F.col("host").alias("bad_host"), "rejected")
    both = measures.join(verdicts, F.col("host").eqNullSafe(F.col("bad_host")), "left")
    rejected = F.coalesce("rejected", F.lit(False))
    return both.select(
        "doc_id", "host", *MEASURES, failures(rules, base=True).alias("base_failed"), rejected.alias("host_rejected"),
        (~failures(rules) & ~rejected).alias("kept"),
    )
