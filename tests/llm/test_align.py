"""Token alignment against the libraries on whole texts and a plain count of overlapping ranges."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np

from tradeloom.llm import align
from tradeloom.llm.common import stored
from tradeloom.llm.pieces import default_model
from tradeloom.llm.token_files import default_tokenizer

SCHEMA = "doc_id bigint, text string, block int, pairs string, n_a string, count int, best string"
ODD = [
    None, "", " ", "  ", "\n", "a", "ab  cd ", " lead", "x" * 3000, "▁", "a▁b", "<s> </s> <|endoftext|> <unk> <0x41>", "é 中文 😀　",
    "a\x00b", "tabs\t\there \n\n  and \r\n lines", "=" * 500, "1234567890 12", " " * 40 + "x", "can't won't", "\x1c x\x1d y", "Ａ\xa0b \x85 c",
    "ｱ ́x", "the end \n", "中文没有空格" * 50,
]


def frame(spark, texts, ids=None, parts=3):
    return spark.createDataFrame(list(zip(ids or range(len(texts)), texts, *[[1] * len(texts), *[["x"] * len(texts)] * 2, [1] * len(texts), ["x"] * len(texts)])), SCHEMA).repartition(parts)


def sequences(texts):
    """Tokens of both libraries for whole texts as (id, bytes), or None."""
    import sentencepiece
    from tokenizers import Tokenizer

    byte, pieces = Tokenizer.from_file(default_tokenizer()), sentencepiece.SentencePieceProcessor(model_file=default_model())
    byte.encode_special_tokens = True
    letters = align.byte_alphabet()
    for text in texts:
        if not text:
            yield None
            continue
        a = [(i, bytes(letters[c] for c in byte.id_to_token(i))) for i in byte.encode(" " + text, add_special_tokens=False).ids]
        b = []
        for i in pieces.encode(text):
            piece = pieces.id_to_piece(i)
            b.append((i, bytes([int(piece[1:-1], 16)]) if pieces.is_byte(i) else piece.replace("▁", " ").encode()))
        raw = (" " + text).encode()
        yield (a, b) if b"".join(x for _, x in a) == raw == b"".join(x for _, x in b) else None


def expected(texts):
    docs, holds = [], Counter()
    for both in sequences(texts):
        if both is None:
            docs.append(None)
            continue
        spans = []
        for tokens in both:
            ends = np.cumsum([len(x) for _, x in tokens]).tolist()
            spans.append(list(zip([0, *ends], ends, [i for i, _ in tokens])))
        links = []
        j = 0
        for lo, hi, a in spans[0]:
            while spans[1][j][1] <= lo:
                j += 1
            k = j
            while k < len(spans[1]) and spans[1][k][0] < hi:
                links.append((a, spans[1][k][2]))
                k += 1
        cuts = sorted({hi for _, hi, _ in spans[0]} & {hi for _, hi, _ in spans[1]})
        groups = [[[i for _, hi, i in s if lo < hi <= to] for s in spans] for lo, to in zip([0, *cuts], cuts)] if len(cuts) < 3000 else None
        docs.append((len(spans[0]), len(spans[1]), len(cuts), links, groups))
        holds.update(set(links))
    best = defaultdict(int)
    for (a, _), n in holds.items():
        best[a] = max(best[a], n)
    out = []
    for d in docs:
        if d is None:
            out.append((0,) * 7 + ("",))
            continue
        n_a, n_b, n_groups, links, groups = d
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        out.append((
            n_a, n_b, n_groups, len(links), sum(len(a) * len(b) for a, b in groups), sum(holds[x] == best[x[0]] for x in links),
            sum(holds[x] for x in links), hashlib.sha256(text.encode()).hexdigest(),
        ))
    return out


def texts_of(rng, n):
    bits = ["the", " ", "  ", "\n", "ing", "é", "中", "😀", "1", "23", "'s", "=", "\t", "Ｂ", "▁", "un", "tion", "　", "."]
    return ["".join(rng.choice(bits) for _ in range(rng.randint(1, 30))) for _ in range(n)]


def test_documents_equal_libraries(spark, monkeypatch):
    rng = random.Random(1)
    texts = ODD + texts_of(rng, 400) + ODD[:8] + ["the same words here"] * 30
    ids = [i if i % 13 else None for i in range(len(texts))]
    got = align.align(frame(spark, texts, ids)).collect()
    names = [*align.NUMBERS, "n_best", "count_sum", "groups_sha256"]
    shown = [(i, *want) for i, want in zip(ids, expected(texts))]
    assert sorted(map(repr, [(r["doc_id"], *(r[c] for c in names)) for r in got])) == sorted(map(repr, shown))


def test_small_blocks_give_the_same(spark, monkeypatch):
    texts = texts_of(random.Random(2), 300) + ["the the thing " * 200, "", None]
    wanted = sorted(tuple(r) for r in align.align(frame(spark, texts, parts=1)).collect())

    def small(rows, byte_path, piece_path):
        return rows.repartition(40).transform(lambda df: ALL(df, byte_path, piece_path))

    ALL = align.aligned_blocks
    monkeypatch.setattr(align, "aligned_blocks", small)
    assert sorted(tuple(r) for r in align.align(frame(spark, texts)).collect()) == wanted


def test_a_block_is_many_small_rows(spark):
    rng = random.Random(5)
    words = ["".join(rng.choice("etaoinshrdlu中é") for _ in range(rng.randint(2, 9))) for _ in range(9000)]
    texts = [" ".join(rng.choices(words, k=90)) for _ in range(900)]
    texts[100:700:30] = (ODD * 2)[:20]
    ids = [i if i % 13 else None for i in range(len(texts))]
    rows = frame(spark, texts, ids, parts=1)
    made = align.aligned_blocks(rows, default_tokenizer(), default_model())
    sizes = [sum(len(v) for v in r if isinstance(v, (bytes, bytearray))) for r in made.collect()]
    assert made.select("block").distinct().count() == 1 and len(sizes) > 3 and max(sizes) < 1 << 20
    got = [tuple(r[c] for c in ("doc_id", *align.NUMBERS, "n_best", "count_sum", "groups_sha256")) for r in align.align(rows).collect()]
    assert sorted(map(repr, got)) == sorted(repr((i, *want)) for i, want in zip(ids, expected(texts)))


def test_stored_rows_are_in_small_row_groups(spark):
    import pyarrow.parquet as pq

    files = stored(spark.range(100, numPartitions=1), "rows", align.ROW_GROUP).inputFiles()
    groups = [pq.ParquetFile(f.removeprefix("file://")).metadata for f in files]
    assert sum(m.num_rows for m in groups) == 100 and max(m.row_group(k).num_rows for m in groups for k in range(m.num_row_groups)) <= 8


def test_matrices_equal_dense_products():
    rng = np.random.default_rng(3)
    for _ in range(50):
        a, b = (rng.random((rng.integers(1, 8), 6)) < 0.4 for _ in range(2))

        def csr(x):
            return align.Csr(np.concatenate([[0], np.cumsum(x.sum(1))]), np.nonzero(x)[1], np.ones(int(x.sum()), np.int64), x.shape[1])

        found = align.product(csr(a), csr(b).transposed())
        dense = np.zeros((len(a), len(b)), np.int64)
        dense[found.rows(), found.columns] = found.values
        assert (dense == a.astype(int) @ b.astype(int).T).all()


def test_links_of_one_text():
    tool = align.aligner(default_tokenizer(), default_model())
    text = "Alignment of thingamajigs 12345 é"
    found, (both,) = tool.links(text), list(sequences([text]))
    assert found.a.tolist() == [i for i, _ in both[0]] and found.b.tolist() == [i for i, _ in both[1]]
    assert found.overlap.values.sum() == len((" " + text).encode())
    shared = found.shared()
    for i, j in zip(shared.rows(), shared.columns):
        assert found.group_a[i] == found.group_b[j]
    assert len(shared.columns) == sum((found.group_a == g).sum() * (found.group_b == g).sum() for g in range(found.groups))
    assert tool.links("") is None and tool.links("a▁b") is None


def test_empty_table(spark):
    assert align.align(frame(spark, [])).count() == 0
