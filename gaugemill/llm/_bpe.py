"""Word-wise use of a tokenizers vocabulary: pieces between spaces are encoded once and then looked up.

A text is cut before every space that follows other text. These vocabularies split there anyway, so the ids of a text are
those of its pieces in order. Texts in which a space has white space on both sides, whose split depends on more than
the piece, and texts with a special token's string are encoded whole. A piece of plain letters and marks goes straight
to the vocabulary's merge model, any other through the whole tokenizer. The table of pieces lives as long as the Python
worker and is emptied when it is full.
"""

from __future__ import annotations

import json
import re
from array import array

import numpy as np
from tokenizers import Tokenizer

MAX_PIECES = 900_000
SPACED = re.compile(r"\s \s|  ")
LETTERS, MARKS = "[A-Za-zÀ-ÖØ-öø-ÿ]+", "[.,!#$%&*]*"
PLAIN = re.compile(rf"({LETTERS})({MARKS})(?:\n({LETTERS})({MARKS}))?")
SPACE_MARK = "Ġ"
DTYPE = np.uint16  # both vocabularies have fewer than 65,536 ids

_held: dict[str, PieceEncoder] = {}


def encoder(path: str, most: int | None = None) -> PieceEncoder:
    """The worker's encoder of a vocabulary file, whose table is emptied beyond ``most`` pieces (``MAX_PIECES``)."""
    if path not in _held:
        _held[path] = PieceEncoder(path)
    _held[path].most = most or MAX_PIECES
    return _held[path]


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte: printable ones for themselves, the others from 256 on."""
    kept = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in kept]
    return {b: chr(b) for b in kept} | {b: chr(256 + i) for i, b in enumerate(rest)}


class PieceEncoder(dict):
    """Ids of a piece that follows a space, as bytes; encoded when first asked for."""

    def __init__(self, path: str):
        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        if self.tokenizer.get_vocab_size() > np.iinfo(DTYPE).max:
            raise ValueError("vocabulary has more ids than two bytes hold")
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        shape = json.loads(self.tokenizer.to_str())
        with_space = shape["normalizer"] is None and shape["pre_tokenizer"] == {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
        lower = [n["type"] for n in (shape["normalizer"] or {}).get("normalizers", [])] == ["NFC", "Replace", "Lowercase"]
        self.mark = SPACE_MARK if with_space else "" if lower else None
        self.lower = lower
        self.letters = byte_letters()
        self.model = self.tokenizer.model
        self.runs: dict[str, bytes] = {}
        self.most = MAX_PIECES

    def __missing__(self, piece: str) -> bytes:
        plain = PLAIN.fullmatch(piece) if self.mark is not None else None
        if plain is None:
            ids = self.whole(f" {piece}")
        else:
            ids = self._letters(self.mark, plain[1]) + self._marks(plain[2])
            if plain[3]:
                ids += self._marks("" if self.lower else "\n") + self._letters("", plain[3]) + self._marks(plain[4])
        self[piece] = ids
        return ids

    def _letters(self, mark: str, text: str) -> bytes:
        if self.lower:
            text = text.lower()
        return self._run(mark + (text if text.isascii() else self._shown(text)))

    def _marks(self, text: str) -> bytes:
        if text not in self.runs:
            self.runs[text] = self._run(self._shown(text)) if text else b""
        return self.runs[text]

    def _shown(self, text: str) -> str:
        return text.encode("utf-8").decode("latin-1").translate(self.letters)

    def _run(self, shown: str) -> bytes:
        return array("H", [t.id for t in self.model.tokenize(shown)]).tobytes()

    def whole(self, text: str) -> bytes:
        return array("H", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def encode(self, text: str | None) -> bytes:
        """Ids of a text as little-endian two-byte numbers; None is an empty text."""
        if not text:
            return b""
        if "  " in text or not (text.isascii() and " \n" not in text and "\t" not in text) and SPACED.search(text) or any(s in text for s in self.special):
            return self.whole(text)
        if len(self) > self.most or len(self.runs) > self.most:
            self.clear()
            self.runs.clear()
        head, *pieces = text.split(" ")
        return b"".join([self.whole(head) if head else b"", *map(self.__getitem__, pieces)])
