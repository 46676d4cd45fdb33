"""Main text of web pages: a linear-chain conditional random field over leaf blocks.

A block's features are the tags, classes and ids of its ancestors and properties of its
text. Two labels, main and other; weights for feature and label, for label after label,
and for the first label. Training maximises the likelihood by stochastic gradient steps
with a rate for each weight; decoding is Viterbi.

Labelled pages come from the table itself: in a bounded sample, blocks inside an article
or main element and outside of any menu, advert and the like are main. Each sampled page
is labelled a second and third time in other dress: the same texts in containers of other
names, with side columns, notices, forms and reader comments between them. So the model
does not lean on one site's markup.
"""

from __future__ import annotations

import random
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeloom.llm.common import narrow, slices, tidy
from tradeloom.llm.html_blocks import Block, leaf_blocks

MAX_TRAIN_PAGES = 200
WIDTH = 1 << 15
BODY = {"t:article", "t:main", "c:article", "c:main", "c:content", "c:post", "c:entry"}
OUTSIDE = {
    "t:nav", "t:footer", "t:aside", "t:form", "t:button", "t:dialog", "t:menu", "c:ad", "c:ads", "c:advert", "c:nav", "c:menu",
    "c:footer", "c:sidebar", "c:comment", "c:comments", "c:cookie", "c:notice", "c:banner", "c:share", "c:related", "c:promo",
}
# containers that labelled pages are dressed in: for each kind its paths from the body down
DRESS = {
    "main": ["article", "main", "main article", "div.content", "div.post", "div.entry", "section.article", "div.story", "div.text",
             "div.main", "div.article-body", "td", "div", "section"],
    "nav": ["nav ul li", "div.menu ul li", "ul.nav li", "header nav", "div.navigation", "div.breadcrumbs", "header", "div.header"],
    "ad": ["div.ad", "aside.ads", "div.advert", "div.sponsored", "div.promo", "div.banner", "article div.ad"],
    "footer": ["footer", "div.footer", "footer div.copyright", "div.legal"],
    "side": ["aside", "div.sidebar", "aside.related ul li", "div.related", "div.widget", "article aside"],
    "notice": ["div.cookie-notice", "div.notice", "dialog", "div.alert", "div.consent", "div.newsletter", "div.subscribe"],
    "form": ["form", "form.search", "div.login form", "form div.field"],
    "comment": ["div.comments div.comment", "section.comments article.comment", "ol.comments li", "div.discussion", "article section.comments",
                "div.reader-comments", "ul.commentlist li.comment"],
}


def features(blocks: list[Block]) -> list[np.ndarray]:
    """Hashed features of every block of a page."""
    out = []
    for i, b in enumerate(blocks):
        words = b.text.count(" ") + 1
        names = [
            "bias", f"parent:{b.parent}", f"words:{min(words.bit_length(), 8)}", f"linked:{round(4 * b.linked)}",
            f"stop:{b.text[-1] in '.!?…:;»”'}", f"commas:{min(b.text.count(','), 3)}", f"copyright:{'©' in b.text}",
            f"first:{i == 0}", f"last:{i == len(blocks) - 1}", f"linked:{round(4 * b.linked)} words:{min(words.bit_length(), 4)}",
            *b.path, *(f"{p} parent:{b.parent}" for p in b.path if p[:2] == "c:"),
        ]
        out.append(np.array(sorted({zlib.crc32(n.encode()) % WIDTH for n in names}), np.int64))
    return out


class Chain:
    """Weights of the field; labels are 0 (other) and 1 (main)."""

    def __init__(self, weights: np.ndarray | None = None) -> None:
        # a row of weights for each feature, then two for label after label and one for the first label
        self.w = np.zeros((WIDTH + 3, 2)) if weights is None else weights
        self.g2 = np.full_like(self.w, 1e-8)

    def emissions(self, feats: list[np.ndarray]) -> np.ndarray:
        return np.array([self.w[f].sum(axis=0) for f in feats])

    def decode(self, feats: list[np.ndarray]) -> list[int]:
        """Viterbi; of two equal paths the one that stays out of the main text."""
        if not feats:
            return []
        e, t = self.emissions(feats), self.w[WIDTH : WIDTH + 2]
        best, back = e[0] + self.w[WIDTH + 2], []
        for row in e[1:]:
            paths = best[:, None] + t
            back.append(paths.argmax(axis=0))
            best = paths.max(axis=0) + row
        out = [int(best.argmax())]
        for b in reversed(back):
            out.append(int(b[out[-1]]))
        return out[::-1]

    def learn(self, feats: list[np.ndarray], labels: list[int], rate: float = 0.3, decay: float = 1e-4) -> None:
        """One gradient step on a page, with marginals from forward and backward sums."""
        e, t = self.emissions(feats), self.w[WIDTH : WIDTH + 2]
        n = len(feats)
        a, b = np.zeros((n, 2)), np.zeros((n, 2))
        a[0] = e[0] + self.w[WIDTH + 2]
        for i in range(1, n):
            a[i] = np.logaddexp.reduce(a[i - 1][:, None] + t, axis=0) + e[i]
        for i in range(n - 2, -1, -1):
            b[i] = np.logaddexp.reduce(t + (e[i + 1] + b[i + 1])[None, :], axis=1)
        total = np.logaddexp.reduce(a[-1])
        gradient: dict[int, np.ndarray] = {}

        def add(row: int, value: np.ndarray) -> None:
            gradient[row] = gradient[row] + value if row in gradient else value

        marginal = np.exp(a + b - total)
        for i, f in enumerate(feats):
            delta = np.eye(2)[labels[i]] - marginal[i]
            for row in f.tolist():
                add(row, delta)
            if i:
                pair = np.exp(a[i - 1][:, None] + t + (e[i] + b[i])[None, :] - total)
                pair[labels[i - 1], labels[i]] -= 1
                add(WIDTH, -pair[0])
                add(WIDTH + 1, -pair[1])
        add(WIDTH + 2, np.eye(2)[labels[0]] - marginal[0])
        for row, g in gradient.items():
            g = g - decay * self.w[row]
            self.g2[row] += g * g
            self.w[row] += rate * g / np.sqrt(self.g2[row] + 1e-6)


def labels_of(blocks: list[Block]) -> list[int]:
    """1 inside an article or main container and outside of everything that surrounds one."""
    return [int(bool(b.path & BODY) and not b.path & OUTSIDE) for b in blocks]


def dressed(blocks: list[Block], labels: list[int], rng: random.Random) -> tuple[list[Block], list[int]]:
    """The page in other containers, with blocks of further kinds around and inside the main text."""
    def block(text: str, kind: str, dress: str, leaf: str, linked: float) -> Block:
        path = {"t:html", "t:body", f"t:{leaf}"} if leaf else {"t:html", "t:body"}
        last = leaf
        for step in dress.split():
            tag, _, names = step.partition(".")
            path |= {f"t:{tag}"} | {f"c:{w}" for w in names.split("-") if w}
            last = leaf or tag
        return Block(text, frozenset(path), last, linked)

    main = [b for b, y in zip(blocks, labels) if y]
    other = [b for b, y in zip(blocks, labels) if not y]
    sentences = [s.strip() + "." for b in main for s in b.text.split(".") if s.strip()] or ["."]
    pick = {kind: rng.choice(paths) for kind, paths in DRESS.items()}

    def extra(kind: str, most: int, leaves: tuple[str, ...], linked: tuple[float, ...], whole: bool) -> list[tuple[Block, int]]:
        out = []
        for _ in range(rng.randint(0, most)):
            text = " ".join(rng.choice(sentences) for _ in range(rng.randint(1, 3)))
            text = text if whole else " ".join(text.split()[: rng.randint(1, 6)]).rstrip(".")
            out.append((block(text or "-", kind, pick[kind], rng.choice(leaves), rng.choice(linked)), 0))
        return out

    page = []
    for b in other:
        kind = "nav" if b.linked > 0.5 else "footer" if "©" in b.text else "ad"
        page.append((block(b.text, kind, pick[kind], rng.choice(("", "p", "div")) if kind != "nav" else "", b.linked), 0))
    feet = [x for x in page if "©" in x[0].text]
    page = [x for x in page if "©" not in x[0].text]
    page = extra("notice", 1, ("p", "div", ""), (0.0, 0.3), True) + page + extra("form", 2, ("label", "div", "p", ""), (0.0,), False)
    body = [(block(b.text, "main", pick["main"], b.parent if b.parent in ("p", "h1", "h2", "h3", "li", "blockquote", "pre") else "p", b.linked), 1) for b in main]
    for inner in ("ad", "side"):
        if body and rng.random() < 0.4:
            at = rng.randint(0, len(body))
            body[at:at] = extra(inner, 2, ("p", "div", ""), (0.0, 0.5, 1.0), rng.random() < 0.5)
    after = extra("side", 4, ("p", "li", "h3", ""), (1.0, 0.5, 0.0), rng.random() < 0.3) + extra("comment", 5, ("p", "div", ""), (0.0, 0.1), True)
    page += body + after + extra("notice", 1, ("p", "div"), (0.0, 0.3), True) + feet
    return [b for b, _ in page], [y for _, y in page]


def train(pages: DataFrame, limit: int = MAX_TRAIN_PAGES, passes: int = 4) -> np.ndarray:
    """Weights from a bounded sample: the ``limit`` ids with the smallest hash, each with the smallest html of its rows.

    The blocks of the sample go to one task, which learns page after page. Without any
    labelled page all weights are zero and nothing is main text.
    """
    chosen = narrow(pages, "page_id").dropna().distinct().withColumn("place", F.xxhash64(F.col("page_id").cast("string")))
    chosen = chosen.orderBy("place", "page_id").limit(limit)
    rows = narrow(pages, "page_id", "html").join(F.broadcast(chosen), "page_id")
    rows = rows.groupBy("page_id", "place").agg(F.min("html").alias("html")).select("place", "html")

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sample = sorted((x["place"], x["html"] or "") for b in batches for x in b.to_pylist())[:limit]
        examples = []
        for place, page in sample:
            blocks = leaf_blocks(page)
            labels = labels_of(blocks)
            if 1 not in labels:
                continue
            examples.append((features(blocks), labels))
            rng = random.Random(place)
            for _ in range(2):
                other, marks = dressed(blocks, labels, rng)
                examples.append((features(other), marks))
        model = Chain()
        for number in range(passes):
            random.Random(number).shuffle(examples)
            for feats, labels in examples:
                model.learn(feats, labels)
        yield pa.RecordBatch.from_pydict({"w": [model.w.astype("<f8").tobytes()]})

    made = rows.repartition(1).mapInArrow(tidy(learn, "extract"), "w binary").collect()
    return np.frombuffer(made[0]["w"], "<f8").reshape(WIDTH + 3, 2) if made else np.zeros((WIDTH + 3, 2))


def main_text(page: str | None, model: Chain) -> str:
    blocks = leaf_blocks(page)
    return "\n".join(b.text for b, y in zip(blocks, model.decode(features(blocks))) if y)


def extract(pages: DataFrame, weights: np.ndarray) -> DataFrame:
    """page_id, url, text and n_chars (code points) of every row, from its whole html.

    Null, empty and text-less pages have the empty text. Null ids and urls and repeated
    rows are kept; other columns are not read. No shuffle; the weights have a fixed size.
    """
    sent = pages.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Chain(sent.value)
        for batch in slices(batches, "html"):
            texts = [main_text(p, model) for p in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    rows = narrow(pages, "page_id", "url", "html")
    kind = rows.schema["page_id"].dataType.simpleString()
    return rows.mapInArrow(tidy(run, "extract"), f"page_id {kind}, url string, text string, n_chars bigint")
