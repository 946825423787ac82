"""Token ids of the public 50k byte-level BPE, as bytes of little-endian unsigned 16-bit numbers.

The ids are those of the ``tokenizers`` library with the vocabulary's JSON file
(its path is a parameter) and ``add_special_tokens=False``; the string of a
special token within a text is that token's id.  Texts are cut into the
vocabulary's pieces by one pattern; a piece's ids are computed once and looked up
after that, in a table of at most ``MAX_PIECES`` entries that starts anew when it
is full.  A text that holds a special token's string goes to ``tokenizers``
whole.  All other pieces are merged by ``tiktoken`` with the JSON file's own
vocabulary as ranks, which gives the same ids in half the time.  The fast pattern
knows letters and digits below U+0250; any other text is merged whole.
"""

from __future__ import annotations

import json
import re
from collections.abc import Sequence
from functools import cached_property

import numpy as np

MAX_PIECES = 300_000
_PER_PIECE = 64  # longer pieces are encoded without being kept

_LETTERS = "A-Za-zªµºÀ-ÖØ-öø-ɏ"
_DIGITS = "0-9²³¹¼-¾"
_SPACES = "\\t\\n\\x0b\\x0c\\r \u0085 "
_PIECE = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTERS}]+| ?[{_DIGITS}]+| ?[^{_SPACES}{_LETTERS}{_DIGITS}]+"
                    rf"|[{_SPACES}]+(?![^{_SPACES}])|[{_SPACES}]+")
_BEYOND = re.compile("[^\x00-ɏ]")


def vocabulary_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def _byte_letters() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for: printable Latin-1 for itself, the others in order from U+0100."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(0x100 + k): b for k, b in enumerate(rest)}


class Pieces(dict):
    """piece -> bytes of its ids."""

    def __init__(self, path: str | None = None):
        super().__init__()
        import public_tokenizers
        import tiktoken
        self.path = path or vocabulary_path()
        with open(self.path, encoding="utf-8") as file:
            content = json.load(file)
        special = [t["content"] for t in content["added_tokens"]]
        letters = _byte_letters()
        ranks = {bytes(letters[c] for c in token): rank for token, rank in content["model"]["vocab"].items() if token not in special}
        if max(ranks.values()) + len(special) > 0xFFFF:
            raise ValueError("ids of this vocabulary don't fit 16 bits")
        self.encoding = tiktoken.Encoding("pieces", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.special = re.compile("|".join(map(re.escape, special)) or "(?!)")

    @cached_property
    def library(self):
        """The tokenizer itself, loaded when a text needs it."""
        from tokenizers import Tokenizer
        return Tokenizer.from_file(self.path)

    def __missing__(self, piece: str) -> bytes:
        ids = np.array(self.encoding.encode_ordinary(piece), "<u2").tobytes()
        if len(piece) <= _PER_PIECE:
            if len(self) >= MAX_PIECES:
                self.clear()
            self[piece] = ids
        return ids

    def encode(self, text: str | None) -> bytes:
        """Ids of a whole text; null: none."""
        if not text:
            return b""
        if self.special.search(text):
            return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u2").tobytes()
        if _BEYOND.search(text):
            return np.array(self.encoding.encode_ordinary(text), "<u2").tobytes()
        return b"".join(map(self.__getitem__, _PIECE.findall(text)))

    def encode_all(self, texts: Sequence[str | None]) -> list[bytes]:
        return [self.encode(t) for t in texts]


_LOADED: dict[str | None, Pieces] = {}


def pieces(path: str | None = None) -> Pieces:
    """The table of this worker process."""
    if path not in _LOADED:
        _LOADED[path] = Pieces(path)
    return _LOADED[path]
