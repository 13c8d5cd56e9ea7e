"""Tokenize whole Arrow columns: cut bytes into pieces that a tokenizer treats apart, encode each distinct piece once.

The pieces of a batch are contiguous, so they are a view on the batch's own bytes; Arrow numbers the distinct ones, the
library encodes those a worker has not met, and NumPy lays the ids out. Nothing is done per occurrence in Python.
"""

from __future__ import annotations

import string
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from changeflow.llm import tokenizing

# Bytes of pieces and ids kept per worker, and the longest piece worth keeping. Results do not depend on them.
STORE_BYTES = 64 << 20
LONGEST_KEPT = 64
# Two bytes objects and a place in the table take about this much besides their contents.
ENTRY_BYTES = 170
JOINED = 1_000
# Bytes kept per worker where pieces and ids lie in Arrow buffers, some 36 a piece.
PACKED_BYTES = 16 << 20

# UTF-8 of the characters with the Unicode property White_Space.
ASCII_SPACES = b"\t\n\x0b\x0c\r "
WIDE_SPACES = [
    chr(c).encode() for c in (0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
]
LEADS = np.isin(np.arange(256), [w[0] for w in WIDE_SPACES])
IS_SPACE = np.isin(np.arange(256), list(ASCII_SPACES))
IS_LETTER = np.isin(np.arange(256), list(string.ascii_letters.encode()))
# Punctuation that always starts a pre-token of its own behind a letter; an apostrophe may not.
IS_MARK = np.isin(np.arange(256), list(string.punctuation.replace("'", "").encode()))


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts one after another (null: none) and the offset of each text, one more than texts."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    _, offsets, data = texts.buffers()
    bounds = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if data is None or not len(texts):
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]], bounds - bounds[0]


def spaces_of(data: np.ndarray) -> np.ndarray:
    """Which bytes belong to white space."""
    space = IS_SPACE[data]
    leads = np.flatnonzero(LEADS[data])
    for wide in WIDE_SPACES if len(leads) else ():
        at = leads[leads + len(wide) <= len(data)]
        for k, byte in enumerate(wide):
            at = at[data[at + k] == byte]
        for k in range(len(wide)):
            space[at + k] = True
    return space


def byte_level_cuts(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Starts of pieces: a run of other characters with the one space before it, or white space.

    White space before a word leaves its last character out of the run: a space goes to the word, any other is alone.
    Marks behind a letter start a piece too.
    """
    space = spaces_of(data)
    first = np.zeros(len(data) + 1, bool)
    first[bounds] = True
    first = first[:-1]
    before = np.zeros(len(data), bool)
    before[1:] = space[:-1]
    cut = first | (space & ~before)
    word = np.flatnonzero(~space & before & ~first)
    last = word - 1
    while True:
        inside = (data[last] & 0xC0) == 0x80
        if not inside.any():
            break
        last = last - inside
    cut[last] = True
    cut[word[data[last] != 0x20]] = True
    cut[1:] |= IS_MARK[data[1:]] & IS_LETTER[data[:-1]]
    return np.flatnonzero(cut)


def space_cuts(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Starts of pieces: a run of spaces (0x20) with the run of other bytes behind it."""
    cut = np.zeros(len(data) + 1, bool)
    cut[bounds] = True
    space = data == 0x20
    cut[1:-1] |= space[1:] & ~space[:-1]
    return np.flatnonzero(cut[:-1])


def word_cuts(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Starts of pieces: a run of ASCII white space or of other bytes; marks behind a letter start a piece too."""
    cut = np.zeros(len(data) + 1, bool)
    cut[bounds] = True
    space = IS_SPACE[data]
    cut[1:-1] |= (space[:-1] != space[1:]) | (IS_MARK[data[1:]] & IS_LETTER[data[:-1]])
    return np.flatnonzero(cut[:-1])


def spread(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The stretches flat[start : start + length] one after another."""
    total = int(lengths.sum())
    ends = np.cumsum(lengths)
    return flat[np.arange(total) + np.repeat(starts - (ends - lengths), lengths)]


def sums_between(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of values[bounds[i] : bounds[i + 1]]."""
    return np.diff(np.concatenate(([0], np.cumsum(values, dtype=np.int64)))[bounds])


class Store:
    """Values of keys by ``make``, which a worker asks once per key as long as the key stays in the store.

    Two generations: a full store becomes the older one, and what is used again moves to the new one.
    """

    def __init__(
        self, make: Callable[[list[bytes]], list], size_of: Callable, longest: int = LONGEST_KEPT, limit: int = STORE_BYTES
    ):
        self.make, self.size_of, self.longest, self.limit = make, size_of, longest, limit
        self.known: dict[bytes, object] = {}
        self.older: dict[bytes, object] = {}
        self.size = 0

    def __call__(self, keys: list[bytes]) -> list:
        known, older = self.known, self.older
        missing = [k for k in keys if k not in known]
        fresh = {k: older[k] for k in missing if k in older}
        new = [k for k in missing if k not in fresh]
        if new:
            fresh.update(zip(new, self.make(new), strict=True))
        values = [known[k] if k in known else fresh[k] for k in keys]
        if self.size > self.limit / 2:
            self.older, self.known, self.size = known, {}, 0
        for key, value in fresh.items():
            if len(key) <= self.longest:
                self.known[key] = value
                self.size += len(key) + self.size_of(value) + ENTRY_BYTES
        return values


class Coder:
    """Ids of texts by distinct pieces.

    ``cuts`` finds the pieces; ``encode`` gives the ids of new pieces, each as little-endian 32-bit bytes. A piece whose
    ids do not spell its bytes may be given as None: texts that hold it are ``broken`` and have no ids.
    """

    def __init__(self, cuts: Callable, encode: Callable[[list[bytes]], list[bytes | None]], limit: int = STORE_BYTES):
        self.cuts = cuts
        self.values = Store(encode, lambda ids: len(ids or b""), limit=limit)

    def __call__(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all texts in order, the number of ids of each text, and which texts are broken."""
        n = len(bounds) - 1
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(n, np.int64), np.zeros(n, bool)
        starts = self.cuts(data, bounds)
        offsets = np.append(starts, len(data))
        pieces = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))]
        )
        coded = pieces.dictionary_encode()
        values = self.values(coded.dictionary.to_pylist())
        codes = coded.indices.to_numpy(zero_copy_only=False)
        owned = np.searchsorted(starts, bounds)
        broken = np.zeros(n, bool)
        if None in values:
            bad = np.array([v is None for v in values])[codes]
            broken = sums_between(bad, owned) > 0
            values = [v or b"" for v in values]
        lengths = np.fromiter(map(len, values), np.int64, len(values)) // 4
        each = lengths[codes]
        if broken.any():
            each = np.where(np.repeat(broken, np.diff(owned)), 0, each)
        flat = np.frombuffer(b"".join(values), "<u4")
        return spread(flat, (np.cumsum(lengths) - lengths)[codes], each), sums_between(each, owned), broken


class PackedCoder(Coder):
    """A ``Coder`` that keeps what it knows in Arrow buffers, a sixth of the memory of two objects a piece.

    A full store starts anew with the pieces of the batch at hand. New pieces meet the library some at a time, so that their
    Python objects stay few.
    """

    PER_CALL = 20_000

    def __init__(self, cuts: Callable, encode: Callable[[list[bytes]], list[bytes | None]], limit: int = PACKED_BYTES):
        self.cuts, self.encode, self.limit = cuts, encode, limit
        self.pieces = pa.array([], pa.large_binary())
        self.ids, self.lengths = np.zeros(0, "<u4"), np.zeros(0, np.int32)

    def __call__(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        n = len(bounds) - 1
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(n, np.int64), np.zeros(n, bool)
        starts = self.cuts(data, bounds)
        offsets = np.append(starts, len(data))
        pieces = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))]
        )
        coded = pieces.dictionary_encode()
        flat, firsts, lengths = self.known(coded.dictionary)
        codes = coded.indices.to_numpy(zero_copy_only=False)
        owned = np.searchsorted(starts, bounds)
        broken = np.zeros(n, bool)
        bad = lengths < 0
        if bad.any():
            broken = sums_between(bad[codes], owned) > 0
            lengths = np.where(bad, 0, lengths)
        each = lengths[codes]
        if broken.any():
            each = np.where(np.repeat(broken, np.diff(owned)), 0, each)
        return spread(flat, firsts[codes], each), sums_between(each, owned), broken

    def known(self, pieces: pa.LargeBinaryArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, and of each piece where its own begin and how many they are; -1 if they do not spell it."""
        at = pc.fill_null(pc.index_in(pieces, value_set=self.pieces), -1).to_numpy().astype(np.int64)
        new = np.flatnonzero(at < 0)
        at[new] = len(self.pieces) + np.arange(len(new))
        flat, lengths, added = [self.ids], [self.lengths], pieces.take(pa.array(new))
        for start in range(0, len(new), self.PER_CALL):
            ids, _, own = _laid_out(self.encode(added.slice(start, self.PER_CALL).to_pylist()))
            flat.append(ids)
            lengths.append(own.astype(np.int32))
        flat, lengths = np.concatenate(flat), np.concatenate(lengths)
        places = np.maximum(lengths, 0).astype(np.int64)
        places = np.cumsum(places) - places
        self._keep(pieces, at, added, flat, places, lengths)
        return flat, places[at], lengths[at].astype(np.int64)

    def _keep(self, pieces, at, added, flat, places, lengths) -> None:
        kept, own = pa.concat_arrays([self.pieces, added]), np.arange(len(lengths))
        if kept.nbytes + flat.nbytes + lengths.nbytes > self.limit:
            kept, own = pieces, at
        short = pc.less_equal(pc.binary_length(kept), LONGEST_KEPT)
        if kept is pieces or not pc.all(short, min_count=0).as_py():
            kept, own = kept.filter(short), own[short.to_numpy(zero_copy_only=False)]
            flat = spread(flat, places[own], np.maximum(lengths[own], 0))
        self.pieces, self.ids, self.lengths = kept, flat, lengths[own]


def _laid_out(values: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids one after another, and of each value the place and number of its ids; -1 for None."""
    lengths = np.fromiter((-4 if v is None else len(v) for v in values), np.int64, len(values)) // 4
    each = np.maximum(lengths, 0)
    return np.frombuffer(b"".join([v for v in values if v]), "<u4"), np.cumsum(each) - each, lengths


def packed(ids: list[int]) -> bytes:
    return np.asarray(ids, "<u4").tobytes()


class ByteLevel:
    """Ids of a plain byte-level BPE tokenizer, as its library gives them without added special tokens.

    Special strings inside texts are tokens of their own (the library's default) or, with ``plain``, ordinary text.
    Texts that hold one in the first case are rare and are encoded whole.
    """

    def __init__(self, json_text: str, plain: bool = False, coder: type[Coder] = Coder):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(json_text) if plain else tokenizing.load(json_text)
        if plain:
            self.tokenizer.encode_special_tokens = True
        self.special = [] if plain else [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        # A token is spelt with one character per byte.
        self.bytes_of = np.zeros(self.tokenizer.get_vocab_size(), np.int64)
        for token, i in self.tokenizer.get_vocab().items():
            self.bytes_of[i] = len(token)
        self.coder = coder(byte_level_cuts, self._encode)

    def _alone(self, pieces: list[bytes]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast([p.decode() for p in pieces], add_special_tokens=False)
        return [packed(one.ids) for one in found]

    def _encode(self, pieces: list[bytes]) -> list[bytes]:
        """Words behind a space go to the library many in one text, which it splits at the spaces; the rest one by one."""
        words = [p for p in pieces if p[0] == 0x20 and len(p) > 1 and p[1] > 0x20 and not LEADS[p[1]]]
        out = {}
        for start in range(0, len(words), JOINED):
            some = words[start : start + JOINED]
            found = self.tokenizer.encode_batch_fast([b"".join(some).decode()], add_special_tokens=False)[0]
            ids = np.asarray(found.ids, "<u4")
            ends, wanted = np.cumsum(self.bytes_of[ids]), np.cumsum(np.fromiter(map(len, some), np.int64, len(some)))
            cuts = np.searchsorted(ends, wanted)
            if cuts[-1] >= len(ends) or (ends[cuts] != wanted).any():
                continue
            whole, at = ids.tobytes(), ((cuts + 1) * 4).tolist()
            out.update((w, whole[a:b]) for w, a, b in zip(some, [0, *at[:-1]], at, strict=True))
        rest = [p for p in pieces if p not in out]
        if rest:
            out.update(zip(rest, self._alone(rest), strict=True))
        return [out[p] for p in pieces]

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in order and the number of ids of each."""
        return encode_apart(texts, self.special, self.tokenizer, lambda data, bounds: self.coder(data, bounds)[:2])


def encode_apart(texts: pa.Array, strings: list[str], tokenizer, fast: Callable) -> tuple[np.ndarray, np.ndarray]:
    """Ids and number of ids of each text: by ``fast``, but by the library as a whole for texts that hold one of ``strings``."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    odd = np.zeros(len(texts), bool)
    for string in strings:
        odd |= pc.match_substring(texts, string).to_numpy(zero_copy_only=False)
    if not odd.any():
        return fast(*text_bytes(texts))
    ids, counts = fast(*text_bytes(pc.if_else(pa.array(odd), pa.scalar("", pa.large_string()), texts)))
    parts = np.split(ids, np.cumsum(counts)[:-1])
    for row in np.flatnonzero(odd).tolist():
        own = tokenizer.encode(texts[row].as_py(), add_special_tokens=False).ids
        parts[row], counts[row] = np.asarray(own, np.uint32), len(own)
    return np.concatenate(parts), counts
