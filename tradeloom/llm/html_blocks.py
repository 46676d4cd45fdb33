"""HTML as leaf blocks: the text between block boundaries, with its ancestors."""

from __future__ import annotations

import html
import re
from collections import Counter
from dataclasses import dataclass

# Element names of the HTML standard.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr".split()
)
UNSEEN = set("head script style noscript template iframe object svg canvas select textarea title".split())
RAW = set("script style textarea title iframe noscript template".split())
# a start tag of the right side ends an open element of the left side
ENDS_P = set(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr "
    "main menu nav ol p pre section table ul".split()
)
ENDED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"},
            "option": {"option"}}
SCOPE = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}, "option": {"select"}}

# a tag that is not closed before the next one opens is text, so that a search ends there and not at the end of the page
MARKUP = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^<>"']|"[^"]*"|'[^']*'|["'])*+)>|<[!?/][^<>]*>""", re.S)
NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
WORDS = re.compile(r"[a-z]+")


@dataclass
class Block:
    text: str
    path: frozenset  # "t:" and tag, "c:" and word of class, id or role, of all ancestors
    parent: str
    linked: float  # share of characters inside links


class Reader:
    def __init__(self) -> None:
        self.stack: list[tuple[str, tuple]] = []
        self.open: Counter = Counter()
        self.path: Counter = Counter()
        self.blocks: list[Block] = []
        self.parts: list[str] = []
        self.linked = 0

    def flush(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            parent = next((t for t, _ in reversed(self.stack) if t not in INLINE), "")
            share = min(1.0, self.linked / len(text))
            self.blocks.append(Block(text, frozenset(k for k, n in self.path.items() if n > 0), parent, share))
        self.parts, self.linked = [], 0

    def push(self, tag: str, attributes: str) -> None:
        words = {w for m in NAMES.finditer(attributes) for w in WORDS.findall((m[1] or m[2] or m[3] or "").lower())}
        tokens = (f"t:{tag}", *(f"c:{w}" for w in words))
        self.stack.append((tag, tokens))
        self.open[tag] += 1
        self.path.update(tokens)

    def pop_to(self, tag: str) -> None:
        """Close the nearest open element of that name and all inside it."""
        while self.stack:
            name, tokens = self.stack.pop()
            self.open[name] -= 1
            self.path.subtract(tokens)
            if name == tag:
                return

    def close_implied(self, tag: str) -> None:
        if tag in ENDS_P and self.open["p"]:
            self.pop_to("p")
        for name in ("li", "dt", "dd", "tr", "td", "th", "option"):
            if self.open[name] and tag in ENDED_BY[name]:
                for held, _ in reversed(self.stack):
                    if held in SCOPE[name]:
                        break
                    if held == name:
                        self.pop_to(name)
                        break

    def text(self, raw: str) -> None:
        if not raw or any(self.open[t] > 0 for t in UNSEEN):
            return
        plain = html.unescape(raw) if "&" in raw else raw
        self.parts.append(plain)
        if self.open["a"] > 0:
            self.linked += len(plain)

    def read(self, page: str) -> list[Block]:
        at, size = 0, len(page)
        while at < size:
            m = MARKUP.search(page, at)
            if m is None:
                self.text(page[at:])
                break
            self.text(page[at : m.start()])
            at = m.end()
            if not m[2]:
                continue
            tag = m[2].lower()
            if tag not in INLINE:
                self.flush()
            elif tag == "br":
                self.parts.append(" ")
            if m[1]:
                if self.open[tag] > 0:
                    self.pop_to(tag)
                continue
            self.close_implied(tag)
            if tag in VOID or m[3].endswith("/") and tag in RAW:
                continue
            if tag in RAW:  # nothing inside is markup
                end = re.compile(rf"</{re.escape(tag)}[^>]*>", re.I).search(page, at)
                at = end.end() if end else size
                continue
            if tag == "body" and self.open["head"] > 0:
                self.pop_to("head")
            self.push(tag, m[3])
        self.flush()
        return self.blocks


def leaf_blocks(page: str | None) -> list[Block]:
    """Blocks with text, in page order; scripts, styles, comments and the head have none."""
    return Reader().read(page or "")
