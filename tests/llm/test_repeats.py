"""Repeat removal against brute force over all 400-byte strings."""

import collections
import hashlib
import random
import re

import numpy as np
import pytest

from changeflow.llm import repeats
from changeflow.llm.queries import QUERIES

SCHEMA = "doc_id long, text string, r1 long, _text string, size long"


def brute(rows):
    data = [(t or "").encode() for _, t in rows]
    seen = collections.Counter(d[p : p + 400] for d in data for p in range(len(d) - 399))
    out = []
    for (doc, _), d in zip(rows, data, strict=True):
        hit = np.zeros(len(d) + 1, bool)
        for p in range(len(d) - 399):
            if seen[d[p : p + 400]] > 1:
                hit[p : p + 400] = True
        runs = int((hit[1:] & ~hit[:-1]).sum() + hit[0])
        kept = bytes(np.frombuffer(d, np.uint8)[~hit[: len(d)]])
        out.append((doc, len(d), int(hit.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def corpus(seed):
    rng = random.Random(seed)
    letters = "abcdefghij é\n\0"
    make = lambda n: "".join(rng.choices(letters, k=n))
    shared = [make(n) for n in (399, 400, 401, 520, 900, 1500)]
    texts = [None, "", "short", make(400), make(3000), "ab" * 700, "z" * 500, "z" * 450]
    for _ in range(60):
        parts = [make(rng.randint(0, 300))]
        for _ in range(rng.randint(0, 3)):
            s = rng.choice(shared)
            a = rng.randint(0, 60)
            parts += [s[a : len(s) - rng.randint(0, 60)], make(rng.randint(0, 200))]
        texts.append("".join(parts))
    base = make(1800)
    for _ in range(12):
        t = list(base)
        for _ in range(rng.randint(0, 4)):
            t[rng.randrange(len(t))] = rng.choice(letters)
        texts.append("".join(t))
    rows = list(enumerate(texts))
    return rows + [(3, texts[3]), (900, texts[4]), (901, texts[4]), (None, texts[20]), (950, make(500))]


@pytest.mark.parametrize("block, piece", [(4_096, 1 << 20), (3, 700)])
def test_equals_brute_force(spark, monkeypatch, block, piece):
    monkeypatch.setattr(repeats, "BLOCK", block)
    monkeypatch.setattr(repeats, "PIECE", piece)
    rows = corpus(2)
    docs = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], SCHEMA).repartition(3)
    got = repeats.remove_repeats(docs)
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows)


def test_anchors_depend_on_the_window_alone():
    rng = np.random.default_rng(3)
    window = rng.integers(0, 4, 400, np.uint8)
    own = set(repeats.anchor_places(window).tolist())
    for lead in (0, 1, 77, 300):
        text = np.concatenate([rng.integers(0, 4, lead, np.uint8), window, rng.integers(0, 4, 50, np.uint8)])
        assert {p + lead for p in own} <= set(repeats.anchor_places(text).tolist())


def test_intervals():
    # banana: suffixes a, ana, anana, banana, na, nana share 1, 3, 0, 0, 2 letters
    assert sorted(repeats.intervals([1, 3, 0, 0, 2])) == [(0, 2, 1), (0, 5, 0), (1, 2, 3), (4, 5, 2)]


def test_kept_bytes_and_no_rows(spark):
    long = "abc" * 50 + "".join(map(str, range(300)))
    docs = spark.createDataFrame([(1, long + "x", 1, "", 1), (2, "y" + long, 1, "", 1)], SCHEMA)
    got = {r.doc_id: r.kept for r in repeats.remove_repeats(docs, texts_too=True).collect()}
    assert got == {1: b"x", 2: b"y"}
    assert repeats.remove_repeats(docs.limit(0)).count() == 0


def passages(rows, least):
    data = [(t or "").encode() for _, t in rows]
    seen = collections.Counter(d[p : p + 256] for d in data for p in range(len(d) - 255))
    out = {}
    for (doc, _), d in zip(rows, data, strict=True):
        hit = bytearray(len(d))
        for p in range(len(d) - 255):
            if seen[d[p : p + 256]] > 1:
                hit[p : p + 256] = b"\x01" * 256
        words = [m.span() for m in re.finditer(rb"[^\x20\x09-\x0D]+", d)]
        runs = [m.span() for m in re.finditer(rb"\x01+", bytes(hit))]
        inside = [sum(a <= w and z <= b for w, z in words) for a, b in runs]
        out[doc] = sum(n for n in inside if n >= least)
    return out


@pytest.mark.parametrize("block, piece", [(4_096, 1 << 20), (3, 700)])
def test_passages_equal_brute_force(spark, monkeypatch, block, piece):
    monkeypatch.setattr(repeats, "BLOCK", block)
    monkeypatch.setattr(repeats, "PIECE", piece)
    rng = random.Random(5)
    make = lambda n: "".join(rng.choices("abcé  \n\t", k=n))
    shared = [make(n) for n in (240, 256, 270, 330, 399, 520)]
    texts = [None, "", make(256), make(390), "la " * 200, "lo " * 84]
    for _ in range(60):
        parts = [make(rng.randint(0, 200))]
        for _ in range(rng.randint(0, 3)):
            s = rng.choice(shared)
            parts += [s[rng.randint(0, 12) : len(s) - rng.randint(0, 12)], make(rng.randint(0, 90))]
        texts.append("".join(parts))
    rows = list(enumerate([*texts, texts[3], texts[2]]))
    docs = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], SCHEMA).repartition(3)
    got = [tuple(r) for r in repeats.remove_repeats(docs, passage_words=51).collect()]
    assert {r[0]: r[-1] for r in got} == passages(rows, 51)
    assert sorted((r[:-1] for r in got), key=repr) == brute(rows)


def test_query_counts_passages_shorter_than_removed_strings(spark, tmp_path):
    passage = " ".join(f"word{i}" for i in range(51))
    assert 256 <= len(passage) < 400
    rows = [(1, f"one {passage} end"), (2, f"{passage}\nother"), (3, " ".join(f"v{i}" for i in range(90))), (4, f"x{passage}")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: (r.n_removed, r.n_passage_words) for r in QUERIES["op7_repeats"](spark, str(tmp_path)).collect()}
    assert got == {1: (0, 51), 2: (0, 51), 3: (0, 0), 4: (0, 0)}
