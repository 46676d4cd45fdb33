"""The registered queries of the operators, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeloom.catalogue import Query
from tradeloom.llm import (
    align, conversations, decontaminate, extract, host_rules, segment, simhash, suffix_dedup, token_counts, token_files, toxicity, warc, winnow,
)
from tradeloom.llm.common import load

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


@query
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents by a model of the labels that are not held out."""
    documents, labels = load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels")
    model = toxicity.train(documents, labels.where(~toxicity.held_out()))
    scored = toxicity.score(documents.select("doc_id", "text"), model)
    return scored.select("doc_id", toxicity.held_out().alias("held_out"), "score", "predicted")


@query
def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(load(spark, sf_dir, "documents"))


@query
def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as archives, read back through the merged index; a page's time is made of its id."""
    pages = load(spark, sf_dir, "pages").select("page_id", "url", "html")
    pages = pages.withColumn("captured", F.timestamp_seconds(F.lit(1_577_836_800) + F.col("page_id")))
    return warc.archive(pages).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query
def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnow.edit_likeness(load(spark, sf_dir, "documents"))


@query
def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = load(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.contamination(documents, load(spark, sf_dir, "benchmark"), 10)
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


@query
def op6_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = load(spark, sf_dir, "pages")
    return extract.extract(pages, extract.train(pages))


@query
def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = suffix_dedup.without_repeats(load(spark, sf_dir, "documents").select("doc_id", "text"))
    return done.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The n best segmentations of every text by the operator's own n, the best one decoded again."""
    documents = load(spark, sf_dir, "documents").select("doc_id", "text")
    # digests of the candidates come first, so that only the best ids go on to be decoded
    found = segment.segment(documents).select(
        "doc_id", F.col("candidates")[0]["score"].alias("score"), F.col("candidates")[0]["ids"].alias("ids"),
        F.size("candidates").alias("n_candidates"), F.get("candidates", F.lit(1))["score"].alias("second_score"),
        F.crc32(F.get("candidates", F.lit(1))["ids"]).alias("second_crc32"),
    )
    return segment.decoded(found).select(
        "doc_id", "score", (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"),
        "n_candidates", "second_score", "second_crc32", F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    written = token_files.write_token_files(load(spark, sf_dir, "documents"))
    return token_files.read_token_files(spark, written)


@query
def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(load(spark, sf_dir, "documents"))


@query
def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cheapest repair of every conversation after a fixed damage; those left without rows have zeros."""
    rows = load(spark, sf_dir, "conversations")
    found = conversations.summaries(conversations.repair(conversations.damaged(rows)))
    everyone = rows.select("conv_id").distinct()
    both = everyone.join(found.withColumnRenamed("conv_id", "own_id"), F.col("conv_id").eqNullSafe(F.col("own_id")), "left")
    return both.select(
        "conv_id", *[F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in conversations.COUNTS],
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


@query
def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text by a byte-level and a SentencePiece tokenizer, aligned byte by byte."""
    return align.align(load(spark, sf_dir, "documents"))


@query
def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents against rules of their own and the verdict on their source."""
    judged = host_rules.judge(load(spark, sf_dir, "documents"))
    return judged.select("doc_id", *host_rules.BASE, "base_failed", "kept")


ORACLE["op13_quality_rules"] = r"""
with doc as (select row_number() over () as r, doc_id, source, coalesce(text, '') as t from documents),
word as (
  select r, unnest(w) as w, generate_subscripts(w, 1) as p
  from (select r, regexp_extract_all(t, '[^\x20\x09-\x0D]+') as w from doc)
),
run as (
  select r, p, count(*) over (partition by r, a, b, c) as n
  from (
    select r, p, w as a, lead(w) over (partition by r order by p) as b, lead(w, 2) over (partition by r order by p) as c
    from word
  ) where c is not null
),
covered as (select r, count(distinct q) as n_repeat_words from (select r, unnest([p, p + 1, p + 2]) as q from run where n > 1) group by r),
words as (select r, count(*) as n_words, sum(length(w)) as word_chars from word group by r),
line as (
  select r, count(*) as n_lines, count(*) - count(distinct x) as n_dup_lines
  from (select r, unnest(string_split(t, chr(10))) as x from doc) where regexp_matches(x, '[^\x20\x09-\x0D]') group by r
),
measure as (
  select doc_id, source, coalesce(n_words, 0) as n_words, coalesce(word_chars, 0)::bigint as word_chars,
    length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) as n_symbols, coalesce(n_dup_lines, 0) as n_dup_lines,
    coalesce(n_repeat_words, 0) as n_repeat_words, coalesce(n_lines, 0) as n_lines
  from doc left join words using (r) left join covered using (r) left join line using (r)
),
flag as (
  select source, rule, failed::int as failed from (
    select *, n_words < 50 as short, 100 * n_repeat_words > 50 * n_words as repeats, 10 * n_symbols > n_words as symbols,
      2 * n_dup_lines > n_lines as dup_lines
    from measure
  ) unpivot (failed for rule in (short, repeats, symbols, dup_lines))
),
host as (select source, rule, count(*)::double as n, sum(failed)::double as x from flag group by source, rule),
total as (
  select rule, sum(n) as docs, count(*) as hosts, sum(n * n) as squares, sum(x) / sum(n) as mean, sum(x * x / n) as spread
  from host group by rule
),
prior as (
  select rule, docs, mean, mean * (1 - mean) as chance, docs - squares / docs as room,
    spread - mean * mean * docs - (hosts - 1) * mean * (1 - mean) as excess
  from total
),
strength as (
  select rule, mean, case when chance <= 0 or room <= 0 or excess <= 0 then docs
    else least(greatest(chance * room / excess - 1, 1), docs) end as s
  from prior
),
bad as (select distinct source from host join strength using (rule) where (x + mean * s) / (n + s) > 0.5)
select m.doc_id, m.n_words, m.word_chars, m.n_symbols, m.n_dup_lines, m.n_repeat_words,
  (m.n_words < 50 or 100 * m.n_repeat_words > 50 * m.n_words) as base_failed,
  not (m.n_words < 50 or 100 * m.n_repeat_words > 50 * m.n_words or 10 * m.n_symbols > m.n_words or 2 * m.n_dup_lines > m.n_lines)
    and not exists (select 1 from bad where bad.source is not distinct from m.source) as kept
from measure m
"""
