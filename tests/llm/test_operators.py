"""The training-data operators against brute force, libraries and planted cases, with the edge cases of each."""

import base64
import hashlib
import json
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tradeloom.llm import (
    decontaminate, extract, segment, simhash, suffix_dedup, token_counts, token_files, toxicity, warc, winnow,
)
from tradeloom.llm.pieces import default_model, piece_table

DOCS = "doc_id bigint, text string, lang string, n_tokens string, items int, bits string, score string, chosen string"
EDGES = [None, "", " ", "\n", "a", "ab cd", "x" * 5000, "The end. " * 900, "é 中文 😀", "a\x00b", "<s> </s> <|endoftext|>", "  two  gaps \n\n"]


def frame(spark, texts, ids=None):
    """Documents with null, long and repeated rows, and columns that clash with those of the operators."""
    rows = [(i, t, None, "x", 1, "y", "z", "w") for i, t in zip(ids or range(len(texts)), texts)]
    return spark.createDataFrame(rows, DOCS).repartition(3)


def edge_docs(spark):
    return frame(spark, EDGES + EDGES[:6] + ["same words here today"] * 2, [*range(len(EDGES) - 1), None, *range(6), 100, 100])


def words(rng, n, letters="abcdefgh"):
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(1, 7))) for _ in range(n))


# ---------------------------------------------------------------- token counts


def test_counts_equal_library(spark):
    import sentencepiece

    rng, lib = random.Random(1), sentencepiece.SentencePieceProcessor(model_file=default_model())
    bits = ["a", "the", " ", "   ", "\n", "▁", "Ａ", "😀", "\x00", "é", "12", "<s>", "中", "aaaa", "=" * 5, " " * 17]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 40))) for _ in range(3000)] + ["a" * 3000, "ab" * 900]
    assert token_counts.count_texts(texts, default_model()) == [len(x) for x in lib.encode(texts)]
    got = token_counts.token_counts(edge_docs(spark), limit=3).collect()
    assert len(got) == 20
    by = {r["doc_id"]: r for r in got}
    assert (by[0]["n_bytes"], by[0]["n_tokens"], by[0]["over_limit"]) == (0, 0, False)
    assert by[7]["n_tokens"] == len(lib.encode(EDGES[7])) and by[7]["over_limit"]
    assert token_counts.token_counts(frame(spark, [])).count() == 0


def test_counts_of_long_repeats_in_time():
    import sentencepiece
    import time

    lib, rng = sentencepiece.SentencePieceProcessor(model_file=default_model()), random.Random(9)
    texts = ["".join(rng.choice(bits) for _ in range(400)) for bits in (["a", "aa"], [" ", "  "], ["th", "e"], ["=", "-", "=="], ["1", "0"], ["in", "n", "i"]) for _ in range(20)]
    texts += [bit * n for bit in (" ", "the", "a", "=", "ab", "\n", "é", "<a ", "ha ha") for n in (1, 2, 3, 7, 64, 1001)]
    assert token_counts.count_texts(texts, default_model()) == [len(x) for x in lib.encode(texts)]
    for bit in (" ", "the", "<a ", "=-"):
        start = time.process_time()
        long = bit * (1_000_000 // len(bit))
        assert token_counts.count_texts([long], default_model()) == [len(lib.encode(long))]
        assert time.process_time() - start < 8


def test_broken_markup_is_read_in_time():
    import time

    from tradeloom.llm import html_blocks

    for bit in ("<a ", "</", "<a \"", "<a '\"", "<!", "<a \">", "< ", "<p>", "&", "<!-- "):
        start = time.process_time()
        html_blocks.leaf_blocks(bit * (200_000 // len(bit)) + "<p>end</p>")
        assert time.process_time() - start < 8, bit


# ---------------------------------------------------------------- segmentation


def brute_segmentations(unit):
    table = piece_table(default_model())
    unknown, out = min(table.scores.values()) - 10, []

    def walk(i, score, ids):
        if i == len(unit):
            out.append((score, ids))
        for j in range(i + 1, len(unit) + 1):
            if unit[i:j] in table.ids:
                walk(j, score + table.scores[unit[i:j]], (*ids, table.ids[unit[i:j]]))
            elif j == i + 1:
                walk(j, score + unknown, (*ids, *(table.byte_ids[b] for b in unit[i].encode())))

    walk(0, 0.0, ())
    return sorted(out, key=lambda x: -x[0])


def test_nbest_equals_enumeration():
    rng, tool = random.Random(2), segment.segmenter(default_model(), 5)
    for _ in range(200):
        text = "".join(rng.choice(["a", "the", " ", "in", "é", "\n", "Ａ", "  ", "or"]) for _ in range(rng.randint(1, 5)))
        want = brute_segmentations("▁" + text.replace(" ", "▁"))
        got = tool.encode([text])[0]
        assert [s for s, _ in got] == [s for s, _ in want[:5]]
        assert len({ids for _, ids in got}) == len(got)
        for score, ids in got:
            assert (score, tuple(np.frombuffer(ids, "<u4").tolist())) in want


def test_best_of_many_parts_equals_search_and_is_faster():
    import time

    rng, tool = random.Random(4), segment.Segmenter(default_model(), 4)
    letters = "etaoinshrdlu"
    parts = {"".join(rng.choice(letters) for _ in range(rng.randint(1, 14))) for _ in range(4000)}
    parts |= {"▁", "▁▁▁▁▁", "\n\n\n", "aaaaaaaaaaaa", "anaanaana", "111111", "=" * 60, "the" * 40, "é", "中", "\U0001F600", "Ａ"}
    parts = sorted(parts)
    start = time.process_time()
    want = [tool.lattice.search(p, 4) for p in parts]
    alone = time.process_time() - start
    start = time.process_time()
    got = tool.entries(parts)
    together = time.process_time() - start
    for part, best, (score, ids, loss, own) in zip(parts, want, got, strict=True):
        assert own == part and (score, np.frombuffer(ids, "<u4").tolist()) == best[0]
        assert loss == (best[0][0] - best[1][0] if len(best) > 1 else float("inf"))
    assert together < 0.6 * alone


def test_nbest_takes_parts_that_lose_least():
    tool = segment.Segmenter(default_model(), 4)
    one = lambda p: tool.lattice.search(p, 4)
    text = "the nation then\nother 12 aaaa \U0001F600 rest"
    found = tool.encode([text])[0]
    scores = [0.0]
    for entry in tool.searched(tool.table.units(text)).values():
        for _, _, _, part in entry:
            scores = sorted((a + b for a in scores for b, _ in one(part)), reverse=True)[:4]
    assert [s for s, _ in found] == scores and len({ids for _, ids in found}) == 4


def test_segment_edges_and_round_trip(spark):
    found = segment.segment(edge_docs(spark), 3, keep=("doc_id", "text", "score"))
    back = segment.decoded(found.withColumn("ids", F.col("candidates")[0]["ids"])).collect()
    assert len(back) == 20
    for r in back:
        assert r["decoded"] == (r["text"] or "")
        scores = [c["score"] for c in r["candidates"]]
        assert scores == sorted(scores, reverse=True)
    assert segment.segment(frame(spark, []), 2).count() == 0


def test_segment_query_searches_the_default_n(spark, tmp_path):
    from tradeloom.llm.catalogue import QUERIES

    frame(spark, EDGES).select("doc_id", "text").write.parquet(f"{tmp_path}/documents.parquet")
    want = {r["doc_id"]: r["candidates"] for r in segment.segment(frame(spark, EDGES), 4).collect()}
    rows = QUERIES["op8_sentencepiece"](spark, str(tmp_path)).collect()
    assert {r["doc_id"]: (r["score"], r["n_candidates"]) for r in rows} == {i: (c[0]["score"], len(c)) for i, c in want.items()}
    assert max(r["n_candidates"] for r in rows) == 4


def test_forgotten_units_change_nothing(monkeypatch):
    rng, path = random.Random(12), default_model()
    texts = [words(rng, rng.randint(0, 30), "aeinort1.É") for _ in range(60)]
    want = [segment.Segmenter(path, 3).encode([t])[0] for t in texts]
    monkeypatch.setattr(segment, "CACHE_ENTRIES", 1000)
    tool = segment.Segmenter(path, 3)
    for a in (0, 7, 20, 50, 0):
        assert tool.encode(texts[a : a + 13]) == want[a : a + 13]
    assert 0 < len(tool.units) <= 500 and len(tool.size) == len(tool.units) and len(tool.texts) == len(tool.parts)


def test_remembered_units_are_small():
    import tracemalloc

    rng, tool = random.Random(13), segment.Segmenter(default_model(), 2)
    texts = [words(rng, 1000, "etaoinshrdlu.") for _ in range(30)]
    tracemalloc.start()
    for t in texts:
        tool.encode([t])
    tool.lists.clear()  # the A-star search's
    held, _ = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert held < 305 * len({u for t in texts for u in tool.table.units(t)})


def test_rows_are_decoded_together():
    rng, tool = random.Random(14), segment.Decoder(default_model())
    rows = [None, b""] + [np.array([rng.choice((rng.randrange(32000), rng.randrange(300))) for _ in range(rng.randint(0, 9))], "<u4").tobytes() for _ in range(500)]
    plain = tool.plain.to_pylist()
    for row, text in zip(rows, tool.decode(rows), strict=True):
        data = b"".join(plain[i] for i in np.frombuffer(row or b"", "<u4").tolist())
        assert text == data.removeprefix(b" ").decode("utf-8", "replace")
    assert tool.decode([]) == [] and tool.decode([None]) == [""]


def test_only_the_best_ids_go_on_to_be_decoded(spark, tmp_path):
    from tradeloom.llm.catalogue import QUERIES

    frame(spark, EDGES).select("doc_id", "text").write.parquet(f"{tmp_path}/documents.parquet")
    plan = QUERIES["op8_sentencepiece"](spark, str(tmp_path))._jdf.queryExecution().optimizedPlan().toString()
    decoding = next(x for x in plan.splitlines() if "MapInArrow" in x)
    assert "decoded" in decoding and "candidates" not in decoding.replace("n_candidates", "")


# ---------------------------------------------------------------- token files


def test_token_files(spark, tmp_path):
    docs = edge_docs(spark)
    tool = token_files.encoder(token_files.default_tokenizer())
    written = token_files.write_token_files(docs, f"file://{tmp_path}/t", ranges=4)
    rows = sorted(token_files.read_token_files(spark, written).collect(), key=lambda r: r["start"])
    ids = [r["doc_id"] for r in rows]
    assert ids[0] is None and ids[1:] == sorted(ids[1:]) and len(rows) == 20
    at = 0
    for place, r in enumerate(rows):
        assert r["start"] == at
        at += r["n_tokens"]
        own = token_files.document_ids(written, place)
        assert own[-1] == 0 and zlib.crc32(own.astype("<u4").tobytes()) == r["ids_crc32"]
    whole = {i: tool.tokenizer.encode(t or "", add_special_tokens=False).ids + [0] for i, t in enumerate(EDGES[:-1])}
    for r in rows:
        if r["doc_id"] in (6, 7, 8, 9, 10):
            assert r["ids_crc32"] == zlib.crc32(np.array(whole[r["doc_id"]], "<u4").tobytes())
    empty = token_files.write_token_files(frame(spark, []), f"{tmp_path}/e")
    assert empty.ranges == [] and token_files.read_token_files(spark, empty).count() == 0


def test_words_encode_as_whole_texts():
    rng, tool = random.Random(3), token_files.encoder(token_files.default_tokenizer())
    bits = ["a", "b", "'s", "'ll", " ", "  ", "\n", "\r", "\t", "\x1c", "\x85", " ", "​", "😀", "\x00", "é", "22", "!", "<|endoftext|>"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 30))) for _ in range(5000)]
    assert tool.encode(texts) == tool.batch(texts)


# ---------------------------------------------------------------- decontamination


def brute_hits(text, items, size=10):
    pattern = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
    own = pattern.findall(decontaminate.lowered(text or ""))
    hit, found = set(), set()
    for number, item in items:
        w = pattern.findall(decontaminate.lowered(item or ""))
        for i in range(max(len(w) - size, 0) + 1 if w else 0):
            part = w[i : i + size]
            for j in range(len(own) - len(part) + 1):
                if own[j : j + len(part)] == part:
                    hit |= set(range(j, j + len(part)))
                    found.add(str(number))
    return len(own), len(hit), sorted(found)


@pytest.mark.parametrize("limit", [decontaminate.AUTOMATON_BYTES, 900])
def test_contamination(spark, limit):
    rng = random.Random(4)
    items = [(i, words(rng, rng.randint(1, 25), "abc")) for i in range(12)] + [(50, None), (51, "!?"), (52, "Ünï x")]
    texts = list(EDGES)
    for _ in range(40):
        w = words(rng, 30, "abc").split()
        item = rng.choice(items[:12])[1].upper().split()
        at = rng.randint(0, 30)
        texts.append(", ".join(w[:at] + item + w[at:]))
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    rows = decontaminate.contamination(frame(spark, texts), bench, 10, limit).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert (r["n_words"], r["n_hit"], r["items"]) == brute_hits(r["text"], items), r["doc_id"]
        spanned = sum(len(decontaminate.WORD.findall(decontaminate.lowered(r["text"][s["start"] : s["stop"]]))) for s in r["char_spans"])
        assert spanned == r["n_hit"]
    assert decontaminate.contamination(frame(spark, []), bench).count() == 0
    none = decontaminate.contamination(frame(spark, ["a b"]), bench.where("false")).first()
    assert (none["n_hit"], none["items"]) == (0, [])


# ---------------------------------------------------------------- toxicity


def test_toxicity_learns(spark):
    rng = random.Random(5)
    bad = ["vile", "rotten", "loathsome"]
    rows = []
    for i in range(600):
        w = words(rng, 40).split()
        toxic = i % 5 == 0
        for _ in range(3 if toxic else 0):
            w.insert(rng.randint(0, 40), rng.choice(bad))
        rows.append((i, " ".join(w), int(toxic)))
    docs = frame(spark, [t for _, t, _ in rows])
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(None, 1), (3, None)], "doc_id bigint, toxic int")
    model = toxicity.train(docs, labels.where(~toxicity.held_out()), rows=400)
    scored = {r["doc_id"]: r for r in toxicity.score(docs, model).collect()}
    held = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 4 == 2]
    assert len(held) > 50 and sum(scored[i]["predicted"] == y for i, _, y in held) >= 0.95 * len(held)
    assert len(model[0]) < 5000
    edge = toxicity.score(edge_docs(spark), model).collect()
    assert len(edge) == 20 and all(0 <= r["score"] <= 1 for r in edge)
    assert toxicity.train(docs, labels.where("false")) == ([], [])
    assert toxicity.score(frame(spark, []), model).count() == 0


def test_toxicity_learns_an_id_once(spark):
    rng = random.Random(15)
    texts = [words(rng, 30) + (" vile" if i % 3 == 0 else "") for i in range(90)]
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(90)], "doc_id bigint, toxic int")
    hot = labels.orderBy(F.xxhash64(F.col("doc_id").cast("string"))).first()["doc_id"]
    want = toxicity.train(frame(spark, texts), labels, rows=60)
    again = frame(spark, [*texts, *[texts[hot]] * 100, *[texts[hot] + " zz"] * 100], [*range(90), *[hot] * 200])
    assert want[0] and toxicity.train(again, labels, rows=60) == want


# ---------------------------------------------------------------- simhash


def brute_fingerprint(text, k=3):
    w = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(w[i : i + k]) for i in range(max(len(w) - k, 0) + 1)] if w else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def test_simhash_groups(spark):
    rng, texts = random.Random(6), list(EDGES)
    for _ in range(25):
        base = words(rng, 120).split()
        for _ in range(rng.randint(1, 5)):
            texts.append(" ".join(base))
            base[rng.randint(0, 119)] = "Swap"
    got = {r["doc_id"]: r for r in simhash.near_duplicates(frame(spark, texts)).collect()}
    prints = [brute_fingerprint(t) for t in texts]
    root = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3:
                a, b = sorted((root[i], root[j]))
                root = [a if x == b else x for x in root]
    assert len(got) == len(texts)
    for i, p in enumerate(prints):
        assert (got[i]["fingerprint"], got[i]["component_id"]) == (f"{p:016x}", root[i])
    kept = simhash.one_of_each(frame(spark, texts)).collect()
    assert sorted(r["doc_id"] for r in kept) == sorted(set(root)) and kept[0]["bits"] in ("y", None) if "bits" in kept[0].asDict() else True
    assert simhash.near_duplicates(frame(spark, [])).count() == 0
    assert simhash.near_duplicates(edge_docs(spark)).count() == 20


def test_gray_index_finds_all_links():
    rng = np.random.default_rng(7)
    codes = [rng.integers(0, 2**64, 200, dtype=np.uint64)]
    for _ in range(5):
        codes.append(codes[-1] ^ (np.uint64(1) << rng.integers(0, 64, 200, dtype=np.uint64)))
    codes = np.unique(np.concatenate([*codes, np.arange(300, dtype=np.uint64)]))
    index = simhash.GrayIndex(codes)
    found = {(q, c) for qs, cs in index.search(index.codes, 3) for q, c in zip(qs.tolist(), cs.tolist())}
    near = np.bitwise_count(index.codes[:, None] ^ index.codes[None, :]) <= 3
    assert found == set(zip(*(x.tolist() for x in np.nonzero(near))))


def test_hot_bucket_is_cut(spark, monkeypatch):
    monkeypatch.setattr(simhash, "BUCKET", 16)
    codes = spark.createDataFrame([(i,) for i in range(300)], "bits bigint")
    edges = simhash.links(codes, 1)
    assert simhash.components(edges).select("node").distinct().count() == 300
    assert simhash.components(edges).select("root").distinct().count() == 1


# ---------------------------------------------------------------- winnowing


def brute_winnow(chosen_all, size):
    """Places of the minima of all windows, rightmost of equal hashes."""
    out = set()
    for i in range(max(len(chosen_all) - size, 0) + 1):
        part = chosen_all[i : i + size]
        out.add(i + max(j for j, h in enumerate(part) if h == min(part)))
    return sorted(out)


def test_winnowing(spark):
    rng = random.Random(8)
    texts = [words(rng, rng.randint(1, 90), "ab") for _ in range(40)] + ["la " * 60, "中文字" * 20]
    docs = frame(spark, texts)
    rows = winnow.fingerprints(docs.withColumn("codes", F.transform(F.filter(F.split("text", " "), lambda w: w != ""), lambda w: F.xxhash64(w))))
    for r in rows.where("length(text) > 0 and not text like '中%'").select(
        "text", "chosen", winnow.grams(F.col("codes")).alias("grams")
    ).collect():
        every = [g >> 31 for g in r["grams"]]
        assert [c["place"] for c in r["chosen"]] == brute_winnow(every, winnow.WINDOW), r["text"]
        assert all(every[c["place"]] == c["hash"] for c in r["chosen"])


def test_edit_likeness(spark):
    docs = edge_docs(spark)
    rows = winnow.edit_likeness(docs).collect()
    assert len(rows) == 20 and all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in rows)
    rng = random.Random(9)
    texts = [words(rng, 100) for _ in range(30)]
    texts[7] = texts[6]
    got = {r["doc_id"]: r for r in winnow.edit_likeness(frame(spark, texts)).collect()}
    for i, t in enumerate(texts):
        m = len(t) // 4
        edited = t[: len(t) - m] + texts[(i + 1) % 30][:m]
        assert got[i]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest() and got[i]["n_chars"] == len(t)
        assert got[i]["near_edited"] > 0.3
    assert got[6]["fingerprint"] == got[7]["fingerprint"] and got[6]["near_next"] == 1.0 and got[3]["near_next"] < 0.1
    one = winnow.edit_likeness(frame(spark, ["one two three four"])).first()
    assert one["near_next"] == 1.0
    assert winnow.edit_likeness(frame(spark, [])).count() == 0


# ---------------------------------------------------------------- suffix deduplication


def brute_repeats(texts, length):
    count = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if count[t[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        left = bytes(x for x, y in zip(t, gone) if not y)
        out.append((len(t), sum(gone), len(re.findall(b"\1+", bytes(gone))), left))
    return out


@pytest.mark.parametrize(("length", "window", "seed"), [(60, 29, 1), (60, 20, 2), (50, 8, 3)])
def test_repeats(spark, length, window, seed):
    rng = random.Random(seed)
    passages = [words(rng, rng.randint(10, 60), "abcé") for _ in range(10)]
    texts = []
    for _ in range(100):
        parts = []
        for _ in range(rng.randint(0, 5)):
            p = rng.choice(passages)
            if rng.random() < 0.5:
                cut = rng.randint(0, len(p) - 1)
                p = p[:cut] + rng.choice("XY") + p[cut + 1 :] if rng.random() < 0.4 else p
                parts.append(p[rng.randint(0, 20) : len(p) - rng.randint(0, 20)])
            else:
                parts.append(words(rng, rng.randint(3, 25), "abcé"))
        texts.append("".join(parts))
    texts += [*texts[:5], "ab" * 150, "ab" * 90, "a" * 200, None, "", "short"]
    rows = suffix_dedup.without_repeats(frame(spark, texts), length, window).collect()
    want = brute_repeats([(t or "").encode() for t in texts], length)
    assert len(rows) == len(texts)
    for r in rows:
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) == want[r["doc_id"]], r["doc_id"]
        assert r["text"] == texts[r["doc_id"]] and r["score"] == "z"


def test_repeats_edges(spark):
    rows = suffix_dedup.without_repeats(edge_docs(spark)).collect()
    by = Counter((r["n_bytes"], r["n_removed"]) for r in rows)
    assert len(rows) == 20 and by[(5000, 5000)] == 1 and by[(8100, 8100)] == 1
    assert suffix_dedup.without_repeats(frame(spark, [])).count() == 0
    twice = frame(spark, ["word " * 3 + words(random.Random(1), 200)] * 2, [None, None])
    assert [r["kept_text"] for r in suffix_dedup.without_repeats(twice).collect()] == ["", ""]


def test_equal_keys_go_over_buckets(spark):
    text = words(random.Random(5), 300)
    docs = frame(spark, [text] * 80)
    texts = suffix_dedup.texts_by_key(docs)
    places = suffix_dedup.repeated_anchors(texts, 60, 20)
    total = places.agg(F.sum(F.size("places"))).first()[0]
    buckets = 4 * total // 80  # a quarter of the copies each
    cuts = suffix_dedup.splitters(texts, places, total, buckets, 60, 20)
    assert len(cuts) == buckets - 1
    found = suffix_dedup.anchors([text.encode()], 60, 20)
    own = texts.select("id0", "code").collect()
    sizes = Counter(
        sum(c <= s.order() for c in cuts) for r in own
        for s in suffix_dedup.suffixes(r["id0"], r["code"], text.encode(), set(found["place"].tolist()), found, range(len(found["place"])), 60)
    )
    assert max(sizes.values()) <= 60


@pytest.mark.parametrize("strings", [200_000, 50])
def test_classes_over_buckets_give_all_repeats(monkeypatch, strings):
    monkeypatch.setattr(suffix_dedup, "STRINGS", strings)
    rng, length, window = random.Random(6), 60, 20
    shared = [words(rng, n) for n in (60, 60, 40)]
    texts = [(shared[0] + words(rng, 12) + shared[1][: rng.randint(20, 300)]).encode() for _ in range(60)]
    texts += [shared[2].encode()] * 30 + [(shared[2] + words(rng, 9)).encode() for _ in range(30)]
    found = [suffix_dedup.anchors([t], length, window) for t in texts]
    made = [list(suffix_dedup.suffixes(i, i, t, set(f["place"].tolist()), f, range(len(f["place"])), length)) for i, (t, f) in enumerate(zip(texts, found))]
    order = sorted(s.order() for x in made for s in x)
    cuts = order[25::25]
    runs = [suffix_dedup.bucket_runs([s for x in made[i::5] for s in x], cuts, length) for i in range(5)]
    rows, most = [], 0
    for blobs in zip(*runs):
        merged = list(suffix_dedup.PrefixLoserTree([suffix_dedup.decoded_run(b, length) for b in blobs]))
        most = max(most, sum(not s.ghost for _, s in merged))
        rows += suffix_dedup.judged(merged, length, window)
    assert most <= 25
    times = Counter(r[0] for r in rows if r[0])
    got = {(r[2], p) for r in rows if r[0] is None or (r[5] and times[r[0]] > 1) for p in range(r[3], r[4] + 1)}
    count = Counter(t[p : p + length] for t in texts for p in range(len(t) - length + 1))
    assert got == {(i, p) for i, t in enumerate(texts) for p in range(len(t) - length + 1) if count[t[p : p + length]] > 1}
    # one row of a string a bucket, not one for each text that holds it
    assert strings == 50 or max(times.values()) <= len(cuts) + 1


def test_repeated_rows_are_sorted_once(spark):
    text = words(random.Random(7), 200)
    texts, copies = suffix_dedup.one_of_each(suffix_dedup.texts_by_key(frame(spark, [text] * 50 + [text + "s"], [3] * 50 + [4])), 400)
    assert texts.count() == 2 and [(r["id0"], r["first"], r["last"]) for r in copies.collect()] == [(3, 0, len(text) - 400)]


def test_loser_tree_order_and_prefixes():
    rng = random.Random(11)
    keys = [bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 30))) for _ in range(300)]
    runs = []
    for i in range(7):
        run = [suffix_dedup.Suffix(k, b"", 0, 0, 0, 0) for k in sorted(keys[i::7])]
        runs.append(suffix_dedup.decoded_run(suffix_dedup.front_coded(run, 0, len(run), 99), 99))
    before = b""
    for (n, s), want in zip(suffix_dedup.PrefixLoserTree(runs), sorted(keys), strict=True):
        assert s.key == want and n == suffix_dedup.common_prefix(before, want, 0)
        before = want


# ---------------------------------------------------------------- archives


def page_frame(spark, rows):
    return spark.createDataFrame(rows, "page_id bigint, url string, html string, sha1 string").withColumn(
        "captured", F.when(F.col("page_id") != 4, F.timestamp_seconds(F.lit(1_600_000_000) - F.col("page_id")))
    )


def test_archive(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "RUN_LINES", 7)
    monkeypatch.setattr(warc, "FAN_IN", 3)
    monkeypatch.setattr(warc, "SPARSE", 2)
    rng = random.Random(12)
    payloads = [None, "", "x", "<p>é</p>", "z" * 90_000, *(words(rng, 50) for _ in range(20))]
    rows = [(i, rng.choice([f"http://www.a{i % 7}.org/p q{i}", f"https://b.net:8443/{i}#f", "no url", None]), rng.choice(payloads), "s") for i in range(150)]
    rows += [(7, "http://twice.org/", rows[7][2], "s"), (None, "http://none.org/", "x", "s")]
    got = warc.archive(page_frame(spark, rows).repartition(4), f"file://{tmp_path}/w").collect()
    first = {}
    for i, _, html, _ in rows:
        if i is not None:
            first[html or ""] = min(i, first.get(html or "", i))
    want = []
    for i, _, html, _ in rows:
        data = (html or "").encode()
        refers = first.get(html or "") if i is not None and first[html or ""] < i else None
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        want.append((i, len(data), digest, "response" if refers is None else "revisit", refers))
    order = lambda x: tuple((v is not None, v) for v in x)
    assert sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in got), key=order) == sorted(want, key=order)
    keys = [(r["url_key"], r["captured_at"], r["page_id"] if r["page_id"] is not None else -1) for r in got]
    assert keys == sorted(keys)
    r = next(x for x in got if x["page_id"] == 3)
    with open(f"{tmp_path}/w/{r['file']}", "rb") as f:
        f.seek(r["offset"])
        assert warc.capture(zlib.decompress(f.read(r["length"]), 31))["page"] == 3
    assert warc.archive(page_frame(spark, []), f"{tmp_path}/e").count() == 0


def test_history_of_one_url_is_spread(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "SPARSE", 4)
    rest = {"type": "response", "digest": "d", "bytes": 1, "refers": None, "url": None, "file": "f", "length": 9}
    # captures of one URL, then those that have nothing but their place to tell them apart
    lines = sorted(
        ("-", f"2020{i:010d}" if i < 200 else "19700101000000", i if i < 200 else -(2**63), json.dumps(rest | {"offset": i})) for i in range(400)
    )
    runs = [(f"{tmp_path}/run-{k}", warc.write_run(f"{tmp_path}/run-{k}", lines[k::3])) for k in range(3)]
    rows = warc.history(spark, runs, 8).withColumn("part", F.spark_partition_id()).collect()
    assert [(r["captured_at"], r["offset"]) for r in rows] == [(x[1], json.loads(x[3])["offset"]) for x in lines]
    sizes = Counter(r["part"] for r in rows)
    assert len(sizes) == 8 and max(sizes.values()) <= 100


def test_url_keys():
    assert warc.url_key("HTTP://www.Example.ORG:80/A b?q=1#x") == "org,example)/A%20b?q=1"
    assert warc.url_key("https://a.b:8443") == "b,a:8443)/"
    assert " " not in warc.url_key("no url\n") and warc.url_key("http://[bad") == "http://[bad"


# ---------------------------------------------------------------- extraction


def plain_page(title, paragraphs, number):
    menu = "".join(f'<li><a href="/{w}">{w}</a></li>' for w in title.split()[:5])
    body = "".join(f"<p>{p}</p>" for p in paragraphs)
    return (f"<!DOCTYPE html><html><head><title>{title}</title><style>p{{}}</style><script>var t='</p>';</script></head><body>"
            f"<nav><ul>{menu}</ul></nav><!-- ad {number} --><div class='ad'>Buy {title[:9]} now.</div><article><h1>{title}</h1>{body}"
            f"</article><footer>&copy; site &middot; {title[:12]}</footer></body></html>")


def test_extraction(spark):
    rng = random.Random(13)
    pages, want = [], {}
    for i in range(60):
        title, body = words(rng, 6), [words(rng, rng.randint(8, 60)) + "." for _ in range(rng.randint(1, 6))]
        pages.append((i, f"u{i}", plain_page(title, body, i), "e"))
        want[i] = "\n".join([title, *body])
    pages += [(60, None, None, "e"), (61, "u", "", "e"), (62, "u", "<p>", "e"), (None, "u", "<div>" * 3000 + "deep" + "</div>", "e")]
    pages.append((63, "u", "<article><p>" + "long text, &amp; more of it. " * 9000 + "<p>a&nbsp;\t b<br>c</article>", "e"))
    df = spark.createDataFrame(pages, "page_id bigint, url string, html string, text string")
    weights = extract.train(df, limit=40)
    got = {r["page_id"]: r for r in extract.extract(df, weights).collect()}
    assert len(got) == len(pages)
    held = [i for i in want if got[i]["text"] == want[i]]
    assert len(held) == 60
    assert got[60]["text"] == got[61]["text"] == got[62]["text"] == "" and got[60]["n_chars"] == 0
    assert got[63]["text"].endswith("\na b c") and "&" in got[63]["text"]
    other = df.where("page_id < 40").select("page_id", "url", F.expr("replace(replace(html, '<article>', '<div class=post-content>'), '</article>', '</div><div class=comments><p>Nice words, thanks all.</p></div>')").alias("html"))
    share = [r["text"] == want[r["page_id"]] for r in extract.extract(other, weights).collect()]
    assert sum(share) >= 30
    assert extract.extract(df.where("false"), weights).count() == 0
    assert not extract.train(df.where("false")).any()


def test_extraction_learns_a_page_once(spark):
    rng = random.Random(16)
    pages = [(i, f"u{i}", plain_page(words(rng, 6), [words(rng, 30) + "." for _ in range(3)], i)) for i in range(12)]
    kind = "page_id bigint, url string, html string"
    df = spark.createDataFrame(pages, kind)
    hot = df.orderBy(F.xxhash64(F.col("page_id").cast("string"))).first()["page_id"]
    copies = spark.createDataFrame([*[pages[hot]] * 20, *[(hot, "u", pages[hot][2] + "<p>more")] * 20], kind)
    want = extract.train(df, limit=8)
    assert want.any() and (extract.train(df.unionAll(copies), limit=8) == want).all()


def test_viterbi_is_the_best_path():
    rng = np.random.default_rng(3)
    model = extract.Chain(rng.normal(size=(extract.WIDTH + 3, 2)))
    feats = [rng.integers(0, extract.WIDTH, 4) for _ in range(7)]
    e, t = model.emissions(feats), model.w[extract.WIDTH :]

    def total(path):
        return t[2][path[0]] + sum(e[i][y] for i, y in enumerate(path)) + sum(t[a][b] for a, b in zip(path, path[1:]))

    paths = [[n >> i & 1 for i in range(7)] for n in range(128)]
    assert model.decode(feats) == max(paths, key=total)
