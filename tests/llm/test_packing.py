"""Packing: whole documents, gapless sequences, and as few of them as can be."""

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from changeflow.llm import packing
from tests.llm.test_tokens import BYTES, SCHEMA, texts

CAPACITY = 48


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, 3, "x") for i, t in enumerate(texts())]
    rows += [(None, "null id", 1, None), (7, "again", 1, None), (7, "again", 1, None)]
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


def check_places(rows, capacity):
    by_sequence = defaultdict(list)
    for r in rows:
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at and length > 0
            at += length
        assert at <= capacity
    return len(by_sequence)


def test_pieces_and_sequences_equal_library(spark, docs):
    pieces = packing.stage(packing.piece_table(docs, BYTES, CAPACITY, end_id=0), "pieces")
    packed = packing.pack(pieces.drop("ids"), CAPACITY)
    library = Tokenizer.from_file(BYTES)
    want = []
    for r in docs.collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids + [0]
        first = (len(ids) - 1) % CAPACITY + 1
        cuts = [0, *range(first, len(ids) + 1, CAPACITY)]
        for piece, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
            want.append((r.doc_id, piece, a, b - a, zlib.crc32(np.asarray(ids[a:b], "<u4").tobytes())))
    rows = packed.collect()
    got = [(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    used = check_places(rows, CAPACITY)
    assert used <= 1.01 * -(-sum(r.length for r in rows) // CAPACITY) + 1
    whole = {r.sequence_id: r.ids for r in packing.sequences(pieces, packed).collect()}
    assert len(whole) == used
    ids_of = {(r.key, r.piece): r.ids for r in pieces.collect()}
    for r in rows:
        assert whole[r.sequence_id][r.offset : r.offset + r.length] == ids_of[(r.key, r.piece)]


def test_groups_share_their_last_bins(spark, monkeypatch):
    monkeypatch.setattr(packing, "GROUP", 500)
    rng = random.Random(2)
    rows = [(i, 0, rng.randint(1, 60)) for i in range(1500)] + [(i, 1, 64) for i in range(30)]
    frame = spark.createDataFrame(rows, "key long, piece int, length long")
    got = packing.pack(frame, 64).collect()
    assert sorted((r.key, r.piece, r.length) for r in got) == sorted(rows)
    least = -(-sum(r[2] for r in rows) // 64)
    assert check_places(got, 64) <= 1.02 * least + 1
    assert [tuple(r) for r in packing.pack(frame, 64).collect()] and least > 40


def exact_least(lengths, capacity):
    """Fewest bins by search over sorted contents."""
    lengths = sorted(lengths, reverse=True)
    best = len(lengths)

    def place(i, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if i == len(lengths):
            best = len(bins)
            return
        for k in {b: k for k, b in enumerate(bins) if b + lengths[i] <= capacity}.values():
            place(i + 1, [*bins[:k], bins[k] + lengths[i], *bins[k + 1 :]])
        place(i + 1, [*bins, lengths[i]])

    place(0, [])
    return best


def test_search_saves_bins_that_best_fit_needs():
    for seed in range(5):
        rng = random.Random(seed)
        lengths = [rng.randint(400, 800) for _ in range(1_000)]
        plain = packing.Bins(lengths, 2048)
        plain.best_fit()
        assert sum(1 for own in packing.pack_group(lengths, 2048).items if own) < 0.99 * len(plain.items)


def test_small_groups_come_near_the_least():
    rng = random.Random(4)
    worse = 0
    for _ in range(60):
        lengths = [rng.randint(8, 50) for _ in range(11)]
        bins = packing.pack_group(lengths, 100)
        used = sum(1 for own in bins.items if own)
        assert sorted(p for own in bins.items for p in own) == list(range(11))
        assert all(sum(lengths[p] for p in own) == 100 - bins.free[b] for b, own in enumerate(bins.items) if own)
        worse += used > exact_least(lengths, 100)
    assert worse <= 6


def test_exchanges_raise_squared_fill(monkeypatch):
    rng = random.Random(9)
    bins = packing.Bins([rng.randint(300, 1100) for _ in range(400)], 2048)
    bins.best_fit()
    fill = lambda: sum((2048 - f) ** 2 for f, own in zip(bins.free, bins.items, strict=True) if own)
    before, give = fill(), packing.Bins._give

    def watched(self, source):
        nonlocal before
        moved = give(self, source)
        assert (fill() > before) == moved
        before = fill()
        return moved

    monkeypatch.setattr(packing.Bins, "_give", watched)
    bins.search()


def test_a_hard_group_ends_soon():
    rng = random.Random(7)
    bins = packing.pack_group([rng.randint(600, 1400) for _ in range(20_000)], 2048)
    used = sum(1 for own in bins.items if own)
    assert used <= 10_400


def test_no_rows(spark):
    empty = spark.createDataFrame([], SCHEMA)
    pieces = packing.stage(packing.piece_table(empty, BYTES, CAPACITY), "pieces")
    assert packing.pack(pieces.drop("ids"), CAPACITY).count() == 0


def test_other_tokenizers_are_refused(docs):
    with pytest.raises(ValueError):
        packing.piece_table(docs, public_tokenizers.path("word_bpe_49k.json"), CAPACITY)
