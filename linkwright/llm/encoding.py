"""Exact ids from the tokenizers library, at a few times its speed on whole texts.

A byte-level BPE never merges across its pre-tokens, so a text may be cut at pre-token
boundaries, each distinct piece be encoded once by the library, and the ids be joined.
The cuts are coarse: white space up to its last character, then one white-space
character with the run of other characters after it.  Each cut is also a boundary of
the library's own pattern, whose white-space rules these are.  What this reasoning does
not cover goes to the library whole: other kinds of tokenizer, texts that hold an added
token, and texts with the separators U+001C to U+001F, on which Python and the library
disagree as to white space.
"""

from __future__ import annotations

import json
import re
from array import array

import numpy as np
from tokenizers import Tokenizer

#: Pieces that a process keeps, and pieces it has met once; either table is begun anew when
#: full.  A piece met once has its ids there, so that it is not encoded again when it is kept;
#: only pieces met twice are kept, as most others never come again.
KEPT_PIECES, MET_PIECES = 1_000_000, 500_000
#: Characters of the longest piece that is kept, so that the tables are bounded in bytes.
LONGEST_KEPT = 64
_PIECE = re.compile(r"\s+(?!\S)|\s?\S+")
_SEPARATORS = "\x1c\x1d\x1e\x1f"
#: A line feed or space, a word of ASCII and Latin-1 letters, and marks that end a piece.
#: These are pre-tokens: marks after a letter begin one, and so does what follows a line feed.
_WORD = re.compile(r"(\n?)( ?[A-Za-z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u00FF]+)([.,;:!?]*)")


def _byte_letters() -> dict[int, int]:
    """The character that stands for each byte in a byte-level vocabulary, for str.translate."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: b for b in shown} | {b: 256 + i for i, b in enumerate(hidden)}


class _Pieces(dict):
    def __init__(self, tokenizer: Tokenizer) -> None:
        super().__init__()
        self.tokenizer, self.model, self.letters = tokenizer, tokenizer.model, _byte_letters()
        self.met: dict[str, bytes] = {}

    def __missing__(self, piece: str) -> bytes:
        ids = self.met.get(piece)
        if ids is not None:
            if len(self) >= KEPT_PIECES:
                self.clear()
            self[piece] = ids
            return ids
        ids = self.encoded(piece)
        if len(piece) <= LONGEST_KEPT:
            if len(self.met) >= MET_PIECES:
                self.met.clear()
            self.met[piece] = ids
        return ids

    def encoded(self, piece: str) -> bytes:
        word = _WORD.fullmatch(piece)
        if word is None:
            return array("I", self.tokenizer.encode(piece, add_special_tokens=False).ids).tobytes()
        if word[1] or word[3]:
            return b"".join(self[part] for part in word.groups() if part)
        shown = piece.encode().decode("latin-1").translate(self.letters)  # one pre-token: straight to the model
        return array("I", [t.id for t in self.model.tokenize(shown)]).tobytes()


class Encoder:
    def __init__(self, path: str) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        spec = json.loads(self.tokenizer.to_str())
        pre = spec.get("pre_tokenizer") or {}
        self.vocabulary = max(spec["model"]["vocab"].values(), default=-1) + 1
        self.vocabulary = max([self.vocabulary, *(x["id"] + 1 for x in spec["added_tokens"])])
        self.cuttable = (
            spec["model"]["type"] == "BPE"
            and spec["normalizer"] is None
            and pre.get("type") == "ByteLevel"
            and pre.get("use_regex", True)
            and not pre.get("add_prefix_space", True)
            and not spec["model"].get("dropout")
        )
        self._whole = [*_SEPARATORS, *(x["content"] for x in spec["added_tokens"])]
        self._pieces = _Pieces(self.tokenizer)

    def encode(self, text: str) -> bytes:
        """The ids of a text as little-endian unsigned 32-bit integers."""
        if self.cuttable and not any(x in text for x in self._whole):
            return b"".join(map(self._pieces.__getitem__, _PIECE.findall(text)))
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder for each file and process."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]
