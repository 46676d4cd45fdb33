"""The pipeline on the small table, each stage against brute force on its own input."""

import re

import corpus_pipeline
import pytest
from test_operators import brute_fingerprint, brute_hits, brute_repeats

from tradeloom.llm.common import load, stored

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    docs, out = load(spark, SF, "documents"), []
    for name, stage in corpus_pipeline.STAGES:
        made = stored(stage(spark, docs, SF), name)
        out.append((docs.collect(), made.collect()))
        docs = made
    return out


def test_columns_and_rows(spark, steps):
    columns = load(spark, SF, "documents").columns
    for before, after in steps[:-1]:
        assert list(after[0].asDict()) == columns
        assert {r["doc_id"] for r in after} <= {r["doc_id"] for r in before}
    assert corpus_pipeline.run(spark, SF).count() == len(steps[-1][1])


def test_toxic_documents_go(spark, steps):
    toxic = {r["doc_id"]: r["toxic"] for r in load(spark, SF, "labels").collect()}
    before, after = steps[0]
    left = {r["doc_id"] for r in after}
    clean = [r["doc_id"] for r in before if toxic.get(r["doc_id"]) == 0]
    assert sum(i in left for i in clean) >= 0.98 * len(clean)


def test_one_of_each_group_stays(steps):
    before, after = steps[1]
    prints = {r["doc_id"]: brute_fingerprint(r["text"]) for r in before}
    root = {i: i for i in prints}
    for i in prints:
        for j in prints:
            if j < i and (prints[i] ^ prints[j]).bit_count() <= 3:
                a, b = sorted((root[i], root[j]))
                root = {k: a if v == b else v for k, v in root.items()}
    assert {r["doc_id"] for r in after} == set(root.values())


def test_repeats_go(steps):
    before, after = steps[2]
    want = brute_repeats([r["text"].encode() for r in before], 400)
    texts = {r["doc_id"]: w[3].decode("utf-8", "ignore") for r, w in zip(before, want)}
    for r in after:
        assert (r["text"], r["n_chars"]) == (texts[r["doc_id"]], len(texts[r["doc_id"]]))


def test_benchmark_goes(spark, steps):
    items = [(r["item_id"], r["text"]) for r in load(spark, SF, "benchmark").collect()]
    before, after = steps[3]
    clean = {r["doc_id"] for r in before if not brute_hits(r["text"], items)[1]}
    assert {r["doc_id"] for r in after} == clean


def test_tokens_decode(steps):
    before, after = steps[4]
    texts = {r["doc_id"]: r["text"] for r in before}
    for r in after:
        assert r["text"] == texts[r["doc_id"]] or "▁" in texts[r["doc_id"]]
        assert r["n_tokens"] * 4 == len(r["ids"]) and (r["lead"] is None or r["lead"] >= 0)
        assert re.search(r"\S", r["text"]) is None or r["n_tokens"] > 0
