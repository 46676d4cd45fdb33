"""A SentencePiece model as tables, and the units at which its lattice falls apart.

No piece holds a word mark after another character, and a pair of neighbouring
characters that no piece holds is never joined. A text can therefore be cut before a
word mark and between such characters without any change of the result; equal units
of many texts are then worked on once.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
import sentencepiece

MARK = "▁"
UNITS = re.compile(f"{MARK}*[^{MARK}\n]+|{MARK}+|\n+")
CACHE_ENTRIES = 400_000


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class PieceTable:
    """Pieces, scores and kinds of a model file whose normalizer is the identity."""

    def __init__(self, path: str) -> None:
        self.processor = sentencepiece.SentencePieceProcessor(model_file=path)
        p = self.processor
        self.size = p.get_piece_size()
        self.pieces = [p.id_to_piece(i) for i in range(self.size)]
        self.byte_ids = {}
        self.scores: dict[str, float] = {}
        self.ids: dict[str, int] = {}
        for i, piece in enumerate(self.pieces):
            if p.is_byte(i):
                self.byte_ids[int(piece[1:-1], 16)] = i
            elif not (p.is_control(i) or p.is_unknown(i) or p.is_unused(i)):
                self.ids[piece] = i
                self.scores[piece] = p.get_score(i)
        for probe in ("Ａ  b\tc", " x "):
            if p.normalize(probe) != MARK + probe.replace(" ", MARK):
                raise ValueError("the model rewrites text; only an identity normalizer with a leading mark is handled")
        if len(self.byte_ids) != 256:
            raise ValueError("the model has no byte pieces")
        self.marks_split = not any(b == MARK != a for piece in self.ids for a, b in zip(piece, piece[1:]))
        joined = {(ord(a) << 21) | ord(b) for piece in self.ids for a, b in zip(piece, piece[1:])}
        self.joined = np.array(sorted(joined), np.int64)
        self.longest = max(map(len, self.ids))

    def units(self, text: str) -> list[str]:
        """Independent units of a text, in order; none of an empty text."""
        if not text:
            return []
        marked = MARK + text.replace(" ", MARK)
        return UNITS.findall(marked) if self.marks_split else [marked]

    def breaks(self, codes: np.ndarray) -> np.ndarray:
        """True where a code point can't be joined with the one before it."""
        out = np.ones(len(codes), bool)
        if len(codes) > 1:
            key = (codes[:-1].astype(np.int64) << 21) | codes[1:]
            at = np.minimum(np.searchsorted(self.joined, key), len(self.joined) - 1)
            out[1:] = self.joined[at] != key
        return out


@lru_cache(maxsize=4)
def piece_table(path: str) -> PieceTable:
    return PieceTable(path)


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts in one array, and the length of each text."""
    codes = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
    return codes, np.fromiter(map(len, texts), np.int64, len(texts))
