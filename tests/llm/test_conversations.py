"""Conversation repair against an exhaustive search that keeps whole edit strings."""

import hashlib
import random
import re
import zlib

from pyspark.sql import functions as F

from tradeloom.llm import catalogue, conversations

SCHEMA = "conv_id bigint, turn bigint, role string, text string, part string, op int, n string, fault string, content string"
LEGAL = re.compile("(s?(ua)+)?")


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "y", "z", "w") for r in rows], SCHEMA).repartition(3)


def damage(rows):
    def shown(x):
        return " " if x is None else str(x)

    out = []
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{shown(conv)}:{shown(turn)}".encode()) % 20
        role, text = shown(role), shown(text)
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def content(row):
    return hashlib.sha256(f"{len(row[2])}:{row[2]}{row[3]}".encode()).digest()


def expected(rows):
    """Every cheapest audit by (state, whole audit); rows of one conversation, nulls shown as a space."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, content(r)))
    seen, faults = set(), []
    for _, _, role, text in rows:
        bare = text.strip(" \t\n\x0b\x0c\r")
        faults.append(1 if not bare else 2 if (role, text) in seen else 3 if bare[-1] not in ".!?" else 0)
        seen.add((role, text))
    best = {"": (0, "", [])}  # initials so far without repeats of ua -> cost, audit, repaired rows

    def short(x):
        return re.sub("(ua)+", "ua", x)

    def offer(into, sequence, found):
        key = short(sequence)
        if re.fullmatch("s?(ua)*u?", key) and (key not in into or found[:2] < into[key][:2]):
            into[key] = found

    for (_, _, role, text), fault in zip(rows, faults):
        for _ in range(2):
            for key, (cost, audit, kept) in list(best.items()):
                offer(best, key + "u", (cost + 5, audit + "I", [*kept, ("user", "")]))
                offer(best, key + "a", (cost + 5, audit + "I", [*kept, ("assistant", "")]))
        after = {}
        for key, (cost, audit, kept) in best.items():
            offer(after, key, (cost + 2, audit + "D", kept))
            if fault in (0, 3):
                more = 5 if fault else 0
                if role[:1]:
                    offer(after, key + role[0], (cost + more, audit + "K", [*kept, (role, text)]))
                for to in ("user", "assistant"):
                    offer(after, key + to[0], (cost + more + 1, audit + "R", [*kept, (to, text)]))
        best = after
    for _ in range(2):
        for key, (cost, audit, kept) in list(best.items()):
            offer(best, key + "u", (cost + 5, audit + "I", [*kept, ("user", "")]))
            offer(best, key + "a", (cost + 5, audit + "I", [*kept, ("assistant", "")]))
    cost, audit, kept = min((v for k, v in best.items() if LEGAL.fullmatch(k)), key=lambda v: v[:2])
    turns = [r[1] for r in rows if r[1] is not None]
    initials = [r[2][:1] for r in rows]
    return (
        max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, faults.count(1), faults.count(2), faults.count(3),
        sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit,
        hashlib.sha256("\n".join(f"{r}:{t}" for r, t in kept).encode()).hexdigest(),
    )


def check(got, rows, everyone):
    by = {}
    for r in rows:
        by.setdefault(r[0], []).append((*r[:2], " " if r[2] is None else r[2], " " if r[3] is None else r[3]))
    nothing = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    names = [*conversations.COUNTS, "audit", "repaired_sha256"]
    assert sorted((r["conv_id"] is None, r["conv_id"] or 0) for r in got) == sorted((c is None, c or 0) for c in everyone)
    for r in got:
        assert tuple(r[c] for c in names) == (expected(by[r["conv_id"]]) if r["conv_id"] in by else nothing), r


ROLES = ["system", "user", "assistant", "user", "assistant", "tool", "", None, "ü"]
TEXTS = ["Yes.", "No!", "So", "", " \n", None, "Why? ", "end.\x85", "é。", "x" * 3000 + "."]


def conversation(rng, conv, n):
    return [
        (conv, None if rng.random() < 0.1 else rng.randint(0, n), rng.choice(ROLES), rng.choice(TEXTS) if rng.random() < 0.6 else f"t{rng.random()}.")
        for _ in range(n)
    ]


def test_any_conversation(spark):
    rng, rows = random.Random(3), []
    for conv in [*range(400), None]:
        rows += conversation(rng, conv, rng.randint(1, 9))
    found = conversations.summaries(conversations.repair(frame(spark, rows))).collect()
    check(found, rows, {r[0] for r in rows})


def test_one_conversation_over_many_partitions(spark):
    rng = random.Random(4)
    rows = [r for conv, n in ((1, 3), (2, 3000), (3, 1), (4, 40), (None, 500)) for r in conversation(rng, conv, n)]
    rows += [(2, 5, "user", "copied.")] * 700 + [(2, i, "assistant", "again!") for i in range(300)]
    spark.conf.set("spark.sql.shuffle.partitions", "9")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        edits = conversations.repair(frame(spark, rows))
        found = conversations.summaries(edits).collect()
        spans = edits.where("not whole").groupBy("conv_id").agg(F.countDistinct("part").alias("n")).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    check(found, rows, {r[0] for r in rows})
    assert max(r["n"] for r in spans) > 4


def test_edits_are_emitted_before_the_end():
    search, emitted = conversations.Search(), 0
    for i in range(20_000):
        role = "ua"[i % 2] if i % 7 else "a"
        emitted += len(list(search.feed((i,), role, 0, 1)))
        assert i + 1 - emitted < 50
    assert emitted + len(list(search.finish(search.best()))) == 20_000


def test_pieces_give_the_path_of_the_whole():
    rng = random.Random(5)
    for _ in range(300):
        codes = [(rng.choice(["s", "u", "a", ""]), rng.random() < 0.3) for _ in range(rng.randint(0, 14))]
        cuts = sorted(rng.randint(0, len(codes)) for _ in range(3))
        pieces = [codes[a:b] for a, b in zip([0, *cuts], [*cuts, len(codes)])]

        def numbers(piece):
            found = [conversations.costs_of(piece, s) for s in range(4)]
            return [[f[s][k] if s in f else None for f in found for s in range(4)] for k in (0, 1)]

        def path(rows, search, state):
            out = [e for c in rows for _, e in search.feed((0,), c[0], 3 if c[1] else 0, 1)]
            state = search.best() if state is None else state
            return "".join(out + [e for _, e in search.finish(state)]) + ("" if rows is not codes else conversations.ENDING[state])

        between = conversations.states_between([numbers(p) for p in pieces])
        joined = "".join(path(p, conversations.Search(a), b) for p, (a, b) in zip(pieces, between)) + conversations.ENDING[between[-1][1]]
        assert joined == path(codes, conversations.Search(), None)


def test_query_over_damaged_rows(spark, tmp_path):
    rng, rows = random.Random(6), []
    for conv in [*range(150), None]:
        rows += [(conv, t, rng.choice(ROLES[:5]), rng.choice(TEXTS)) for t in [*range(rng.randint(1, 6)), None][: rng.randint(1, 7)]]
    rows += [(i, 0, "user", "Gone.") for i in range(1000, 1100)]
    frame(spark, rows).write.parquet(f"{tmp_path}/conversations.parquet")
    got = catalogue.op11_conversation_repair(spark, str(tmp_path)).collect()
    check(got, damage(rows), {r[0] for r in rows})
    assert any(r["audit"] == "" for r in got)


def test_empty_table(spark):
    assert conversations.summaries(conversations.repair(frame(spark, []))).count() == 0
