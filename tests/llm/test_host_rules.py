"""Quality rules by host: measures against a plain count, shrinkage against its formula, the query against SQL."""

import random
import re
import sys
from collections import Counter
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent.parent))

import oracle  # noqa: E402

from tradeloom.llm import catalogue, host_rules  # noqa: E402

SCHEMA = "doc_id bigint, text string, source string, host int, n_words string, kept string, short string, rejected string, bad_host string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", "y", "z", "w", "v") for r in rows], SCHEMA).repartition(3)


def plain(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    runs = Counter(zip(words, words[1:], words[2:]))
    covered = {k + j for k in range(len(words) - 2) if runs[tuple(words[k : k + 3])] > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), len(lines),
    )


def text_of(rng, n):
    seps = [" ", "  ", "\n", "\n\n", "\t", "\x85", " ", "\r\n"]
    return "".join(rng.choice(["a", "b", "é", "x#y", "<b>", "中文", "😀", "the", "\x1c"]) + rng.choice(seps) for _ in range(n))


def test_measures_equal_plain_count(spark):
    rng = random.Random(1)
    texts = [None, "", " \n ", "a a a", "a a a a", "a b c a b c", "x\n\nx\n x", "#" * 9] + [text_of(rng, rng.randint(0, 60)) for _ in range(300)]
    texts += ["go on " * 40_000, "z" * 200_000, *texts[:5]]
    rows = [(i if i % 9 else None, t, "h") for i, t in enumerate(texts)]
    got = sorted((r["doc_id"] is None, r["doc_id"] or 0, *(r[c] for c in host_rules.MEASURES)) for r in host_rules.measure(frame(spark, rows)).collect())
    assert got == sorted((i is None, i or 0, *plain(t)) for i, t, _ in rows)


GOOD = " ".join(f"w{i}" for i in range(60))


def test_hosts_are_shrunk_and_rejected(spark):
    rows = [(i, GOOD, f"good{i % 20}") for i in range(2000)]
    rows += [(2000 + i, "too short" if i % 10 else GOOD, "bad") for i in range(500)]
    rows += [(3000, "one short text", "new"), (3001, GOOD, "new")]
    rows += [(4000 + i, GOOD, None) for i in range(5)]
    judged = {r["doc_id"]: r for r in host_rules.judge(frame(spark, rows)).collect()}
    assert len(judged) == len(rows)
    for i, text, source in rows:
        fails = text != GOOD
        assert (judged[i]["base_failed"], judged[i]["host_rejected"], judged[i]["kept"]) == (fails, source == "bad", not fails and source != "bad")
    verdicts = {r["host"]: r for r in host_rules.host_verdicts(host_rules.measure(frame(spark, rows))).collect()}
    hosts = Counter(r[2] for r in rows)
    failed = Counter(r[2] for r in rows if r[1] != GOOD)
    docs, mean = len(rows), 451 / len(rows)
    spread = sum(failed[h] ** 2 / n for h, n in hosts.items())
    chance = mean * (1 - mean)
    between = (spread - mean**2 * docs - (len(hosts) - 1) * chance) / (docs - sum(n * n for n in hosts.values()) / docs)
    strength = max(chance / between - 1, 1)
    for h, n in hosts.items():
        assert verdicts[h]["short_rate"] == pytest.approx((failed[h] + mean * strength) / (n + strength))
        assert verdicts[h]["symbols_rate"] == 0
    assert 0.1 < verdicts["new"]["short_rate"] < 0.5


def test_strength_of_equal_hosts_and_of_one_host():
    assert host_rules.prior_strength(1000.0, 10, 100_000.0, 0.1, 1000 * 0.01) == 1000
    assert host_rules.prior_strength(50.0, 1, 2500.0, 0.2, 2.0) == 50
    assert host_rules.prior_strength(1000.0, 2, 500_000.0, 0.5, 500.0) == 1


def test_one_host_with_most_rows_and_empty_table(spark):
    rows = [(i, GOOD if i % 3 else "a#b " * 60, "big" if i % 10 else f"h{i}") for i in range(3000)]
    judged = host_rules.judge(frame(spark, rows))
    assert judged.where("kept").count() == 2000
    assert host_rules.judge(frame(spark, [])).count() == 0


def test_query_equals_sql(spark, tmp_path):
    rng = random.Random(2)
    rows = [(i, text_of(rng, rng.choice([3, 70, 200])) if i % 11 else None, f"h{rng.randint(0, 8)}" if i % 7 else None) for i in range(300)]
    rows += [(i, "too short", "bad") for i in range(300, 340)] + [(340, GOOD, "bad"), (341, GOOD, "fine"), *rows[:4]]
    frame(spark, rows).select("doc_id", "text", "source").write.parquet(f"{tmp_path}/documents.parquet")
    import duckdb

    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    assert oracle.compare(catalogue.op13_quality_rules(spark, str(tmp_path)), con, catalogue.ORACLE["op13_quality_rules"]) is None
