"""Token ids of whole texts by a public tokenizer, inside tasks.

For tokenizers that drop white space, ignore case and separate letters from
other characters: a text then has the ids of its pieces one after another, where
a piece ends at white space or where an ASCII letter meets an ASCII character
that is none. Pieces repeat a lot, so each worker encodes a piece once and keeps
its ids, up to ``CACHED`` pieces.
"""

from __future__ import annotations

import functools
import os

import numpy as np

CACHED = 500_000
_TOGETHER = 2_000

_ALL = np.arange(256)
_UPPER = (_ALL >= 0x41) & (_ALL <= 0x5A)
_LETTER = _UPPER | ((_ALL >= 0x61) & (_ALL <= 0x7A))
_OTHER = (_ALL < 0x80) & ~_LETTER & ~np.isin(_ALL, [0x20, 9, 10, 11, 12, 13])
#: A byte that no UTF-8 text has.
_END = b"\xff"


def pieces(texts: list[bytes]) -> list[list[bytes]]:
    """Pieces of each text; ASCII letters in lower case unless a mark may follow them."""
    buffer = np.frombuffer(_END.join([*texts, b""]), dtype=np.uint8).copy()
    upper = _UPPER[buffer]
    upper[:-1] &= buffer[1:] < 0x80
    buffer[upper] += 32
    cut = np.flatnonzero(_LETTER[buffer[:-1]] & _OTHER[buffer[1:]]) + 1
    spaced = np.full(len(buffer) + len(cut), 0x20, dtype=np.uint8)
    kept = np.ones(len(spaced), dtype=bool)
    kept[cut + np.arange(len(cut))] = False
    spaced[kept] = buffer
    return [x.split() for x in spaced.tobytes().split(_END)[: len(texts)]]


class PieceTokenizer:
    """Ids as little-endian unsigned 32-bit numbers."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [
            x.content.lower().encode() for x in self.tokenizer.get_added_tokens_decoder().values()
        ]
        self.known: dict[bytes, bytes] = {}

    def _encode(self, text: bytes) -> bytes:
        ids = self.tokenizer.encode(text.decode(), add_special_tokens=False).ids
        return np.array(ids, dtype="<u4").tobytes()

    def _learn(self, new: set[bytes]) -> None:
        word = self.tokenizer.model.tokenize
        rest = []
        for x in new:
            # A piece of ASCII letters is one word, which goes to the model as it is.
            if x.isalpha() and x.islower():
                self.known[x] = np.array([t.id for t in word(x.decode())], dtype="<u4").tobytes()
            else:
                rest.append(x)
        for i in range(0, len(rest), _TOGETHER):
            some = [x.decode() for x in rest[i : i + _TOGETHER]]
            encoded = self.tokenizer.encode(" ".join(some), add_special_tokens=False)
            ids = np.array(encoded.ids, dtype="<u4")
            begins = np.array([b for b, _ in encoded.offsets], dtype=np.int64)
            ends = np.cumsum([len(x) + 1 for x in some])
            bounds = [0, *np.searchsorted(begins, ends)]
            for x, a, b in zip(rest[i : i + _TOGETHER], bounds, bounds[1:]):
                self.known[x] = ids[a:b].tobytes()

    def ids(self, texts: list[bytes], end: bytes = b"") -> list[bytes]:
        # Texts with the name of a special token are encoded as a whole.
        lowered = [x.lower() if b"<|" in x else b"" for x in texts]
        whole = [any(s in x for s in self.special) for x in lowered]
        split = pieces([b"" if w else x for w, x in zip(whole, texts)])
        new = set().union(*split).difference(self.known)
        if len(self.known) + len(new) > CACHED:
            self.known = {}
            new = set().union(*split)
        self._learn(new)
        get = self.known.__getitem__
        return [
            (self._encode(x) if w else b"".join(map(get, own))) + end
            for x, w, own in zip(texts, whole, split)
        ]


@functools.lru_cache(maxsize=1)
def piece_tokenizer(path: str) -> PieceTokenizer:
    return PieceTokenizer(path)
