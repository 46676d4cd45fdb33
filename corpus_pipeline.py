"""From raw documents to token ids: five stages, each by one operator of ``tradeloom.llm``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeloom.llm import decontaminate, segment, simhash, suffix_dedup, toxicity
from tradeloom.llm.common import load, stored

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model does not call toxic; it learns from the labels that are not held out."""
    model = toxicity.train(docs, load(spark, sf_dir, "labels").where(~toxicity.held_out()))
    return toxicity.score(docs.select(*COLUMNS), model).where("predicted = 0").select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose fingerprints are linked: that with the smallest id."""
    return simhash.one_of_each(docs.select(*COLUMNS), shingle=3, distance=3)


def repeat_removal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without bytes of strings of 400 that occur again; what a cut leaves of a character goes too."""
    done = suffix_dedup.without_repeats(docs.select(*COLUMNS))
    text = done.withColumn("text", F.col("kept_text"))
    return text.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*COLUMNS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item."""
    found = decontaminate.contamination(docs.select(*COLUMNS), load(spark, sf_dir, "benchmark"), 10)
    return found.where("n_hit = 0").select(*COLUMNS)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The best segmentation of every text, its lead over the second, and the text decoded from the ids."""
    found = segment.segment(docs, 2, keep=("doc_id", "lang", "source", "n_chars"))
    best = found.select(
        "doc_id", "lang", "source", "n_chars", F.col("candidates")[0]["score"].alias("score"),
        (F.col("candidates")[0]["score"] - F.get("candidates", F.lit(1))["score"]).alias("lead"),
        F.col("candidates")[0]["ids"].alias("ids"),
    )
    return segment.decoded(best, "ids", "text").withColumn("n_tokens", (F.octet_length("ids") / 4).cast("bigint"))


STAGES = [
    ("toxicity", toxicity_filter),
    ("simhash_near_dedup", near_dedup),
    ("suffix_array_dedup", repeat_removal),
    ("benchmark_decontamination", decontamination),
    ("sentencepiece", tokenize),
]
# no stage is an SQL expression; tests/llm checks the chain against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after another over the table documents, each from the written rows of the one before."""
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
