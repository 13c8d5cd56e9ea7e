"""Encode texts with a ``tokenizers`` file by pieces that the tokenizer treats independently.

A worker keeps the ids of pieces it has met, so each distinct piece is encoded by the library once per
worker and not once per occurrence.
"""

from __future__ import annotations

import os
from struct import pack

import numpy as np

# Pieces kept per worker, and the longest one worth keeping; when full, the store is emptied and fills again (results do
# not change).
KEPT_PIECES = 250_000
LONGEST_KEPT = 64
# ASCII white space.
SPACES = "\t\n\x0b\x0c\r "

_tokenizers: dict[int, object] = {}


def load(json_text: str):
    """The tokenizer of a file's text, once per worker, without threads of its own."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    key = hash(json_text)
    if key not in _tokenizers:
        _tokenizers[key] = Tokenizer.from_str(json_text)
    return _tokenizers[key]


def read_text(path: str) -> str:
    with open(path, encoding="utf-8") as file:
        return file.read()


class Pieces(dict):
    """Piece -> value made from its ids by ``make``; ``learn`` encodes what is missing."""

    def __init__(self, tokenizer, make, start=()):
        super().__init__(start)
        self.tokenizer, self.make, self.start = tokenizer, make, dict(start)

    def learn(self, pieces: list[str]) -> None:
        missing = list(set(pieces).difference(self))
        if len(self) + len(missing) > KEPT_PIECES + len(self.start):
            self.clear()
            self.update(self.start)
            missing = list(set(pieces).difference(self))
        if missing:
            found = self.tokenizer.encode_batch_fast(missing, add_special_tokens=False)
            make = self.make
            self.update((piece, make(one.ids)) for piece, one in zip(missing, found, strict=True))

    def forget(self, pieces: list[str]) -> None:
        """Let go of long pieces after their batch, so that texts without spaces do not fill the store."""
        for piece in pieces:
            if len(piece) > LONGEST_KEPT:
                self.pop(piece, None)


class Words:
    """Ids of single words for a tokenizer that lower-cases, drops white space and splits off punctuation.

    New words go to the library many in one call, parted by a sign that is one token and occurs in none of them. Lower-case
    ASCII letters are one pre-token, which its model takes as it is.
    """

    SIGN = "|"
    PER_CALL = 1_000

    def __init__(self, tokenizer):
        self.tokenizer = tokenizer
        self.sign = self._alone(self.SIGN)
        if len(self.sign) != 1:
            raise ValueError("the sign between words must be one token")

    def _alone(self, word: str) -> list[int]:
        return self.tokenizer.encode(word, add_special_tokens=False).ids

    @staticmethod
    def _bytes(ids) -> bytes:
        return np.asarray(ids, "<u4").tobytes()

    def encode(self, words: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of each word; white space and an empty one have none."""
        merge, known, plain = self.tokenizer.model.tokenize, {}, []
        for word in words:
            if word.isascii():
                if word.isalpha() and word.islower():
                    ids = [t.id for t in merge(word)]
                    known[word] = pack(f"<{len(ids)}I", *ids)
                    continue
                if not word.strip(SPACES):
                    known[word] = b""
                    continue
            if self.SIGN in word:
                known[word] = self._bytes(self._alone(word))
            else:
                plain.append(word)
        for start in range(0, len(plain), self.PER_CALL):
            some = plain[start : start + self.PER_CALL]
            joined = f" {self.SIGN} ".join(some)
            ids = np.asarray(self.tokenizer.encode_batch_fast([joined], add_special_tokens=False)[0].ids, "<u4")
            cuts = np.flatnonzero(ids == self.sign[0])
            if len(cuts) != len(some) - 1:
                known.update((w, self._bytes(self._alone(w))) for w in some)
                continue
            whole = ids.tobytes()
            ends = [*(cuts * 4).tolist(), len(whole)]
            begins = [0, *((cuts + 1) * 4).tolist()]
            known.update((w, whole[a:b]) for w, a, b in zip(some, begins, ends, strict=True))
        return [known[w] for w in words]
