"""Components of the n-gram join against brute force."""

import random
import re

import numpy as np
import pytest

from changeflow.llm import graph, ngram_join

SCHEMA = "doc_id long, text string, n long, prefix string, c long"


def brute(rows, width=3, percent=90):
    sets = []
    for _, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets.append({tuple(words[i : i + width]) for i in range(max(len(words) - width + 1, 1))} if words else set())
    up, links = list(range(len(rows))), [0] * len(rows)

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                up[root(i)] = root(j)
                links[i] += 1
                links[j] += 1
    least = {}
    for i, (doc, _) in enumerate(rows):
        key = (doc is not None, doc or 0)
        least[root(i)] = min(least.get(root(i), key), key)
    out = [(doc, len(sets[i]), least[root(i)][1] if least[root(i)][0] else None, links[i]) for i, (doc, _) in enumerate(rows)]
    return sorted(out, key=repr)


def corpus(seed, n=160):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)] + ["the"] * 200 + ["Of"] * 100
    texts = [None, "", " \n\t", "one", "One", "one two", "a b c", "a b c d", "é É", "é é", "x " * 30_000]
    passage = " ".join(rng.choices(words, k=60))
    while len(texts) < n:
        kind = rng.random()
        if kind < 0.35 or len(texts) < 20:
            base = rng.choices(words, k=rng.randint(1, 150))
            if rng.random() < 0.4:
                base += passage.split()
        else:
            base = (rng.choice(texts[11:]) or "").split()
            for _ in range(rng.randint(0, 4)):
                at = rng.randrange(len(base) + 1)
                base[at : at + rng.randint(0, 2)] = rng.choices(words, k=rng.randint(0, 2))
        texts.append(" ".join(base))
    rows = [(i, t) for i, t in enumerate(texts)]
    rng.shuffle(rows)
    return rows + [(5, "w1 w2 w3 w4"), (5, "w1 w2 w3 w4"), (None, "w1 w2 w3 w4"), (None, None), (7, "other text here")]


@pytest.mark.parametrize("block", [2_048, 2])
def test_components_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(ngram_join, "LIST_BLOCK", block)
    monkeypatch.setattr(ngram_join, "SET_BLOCK", block)
    rows = corpus(3)
    docs = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], SCHEMA).repartition(4)
    got = ngram_join.ngram_components(docs).drop("row_key").collect()
    assert sorted(map(tuple, got), key=repr) == brute(rows)


def test_links_in_small_parts(monkeypatch):
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 60, rng.integers(20, 50))) for _ in range(80)]
    weight, own = rng.integers(1, 4, 80), np.zeros(80, np.int64)
    whole = ngram_join.links_of(np.arange(80), sets, weight, own, (0, 0), 45)
    monkeypatch.setattr(ngram_join, "SET_VALUES", 200)
    parts = ngram_join.links_of(np.arange(80), sets, weight, own, (0, 0), 45)
    # Two blocks meet in three pairs; each pair of sets counts in one of them.
    own[::3] = 1
    blocks = []
    for i, j in ((0, 0), (0, 1), (1, 1)):
        at = np.flatnonzero((own == i) | (own == j))
        links, pairs = ngram_join.links_of(at, [sets[k] for k in at], weight[at], own[at], (i, j), 45)
        full = np.zeros(80, np.int64)
        full[at] = links
        blocks.append((full, pairs))

    def groups(pairs):
        forest = ngram_join.Forest(80)
        for a, b in pairs:
            forest.union(a, b)
        return forest.flatten().tolist()

    def linked(a, b):
        return 100 * len(np.intersect1d(a, b)) >= 45 * len(np.union1d(a, b))

    close = [(a, b) for a in range(80) for b in range(a) if linked(sets[a], sets[b])]
    assert groups(whole[1]) == groups(parts[1]) == groups(close) and len(set(groups(close))) < 80
    assert groups([p for _, pairs in blocks for p in pairs]) == groups(close)
    want = np.zeros(80, np.int64)
    for a, b in close:
        want[a] += weight[b]
        want[b] += weight[a]
    assert (whole[0] == want).all() and (parts[0] == want).all() and (sum(full for full, _ in blocks) == want).all()


def test_bucket_counts_never_rule_out_a_link():
    rng = np.random.default_rng(8)
    for size in (40, 3_000, 60_000):
        one = rng.integers(0, 1 << 63, size, np.uint64) * np.uint64(2)
        for share in (0.0, 0.02, 0.05, 0.3):
            two = one.copy()
            new = rng.random(size) < share
            two[new] = rng.integers(0, 1 << 63, int(new.sum()), np.uint64)
            differ = 2 * int(new.sum())
            counts = {}
            for buckets in (64, 256, 1024, 4096):
                shift = np.uint64(64 - (buckets.bit_length() - 1))
                counts[buckets] = [
                    np.bincount((x >> shift).astype(np.int64), minlength=buckets).astype(np.uint8) for x in (one, two)
                ]
                a, b = counts[buckets]
                assert int(ngram_join.least_gap(a[None], b[None])[0]) <= differ
            sizes = np.asarray([size])
            for left, right in ((256, 256), (1024, 256), (256, 4096), (4096, 4096)):
                near = ngram_join.still_near(sizes, sizes, [counts[left][0].tobytes()], [counts[right][1].tobytes()], 90)[0]
                assert near or differ > 2 * size * 10 // 190
            if size == 60_000 and share == 0.3:
                assert not near  # and the finer counts do rule out what is far
    assert ngram_join.fine_buckets(500, 90) == 0 and ngram_join.fine_buckets(20_000, 90) == 1024


def test_keep_one(spark):
    rows = [(1, "a b c d"), (2, "A b c d"), (3, "z"), (4, None), (5, None), (3, "z")]
    docs = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], SCHEMA)
    kept = ngram_join.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3, 4, 5]
    assert ngram_join.keep_one(docs.limit(0)).count() == 0


def test_graph_components(spark):
    rng = random.Random(1)
    pairs = [(i, i + 1) for i in range(0, 200)] + [(1_000, 1_000 + i) for i in range(1, 300)] + [(5_000, 5_000)]
    pairs += [(rng.randrange(6_000, 6_400), rng.randrange(6_000, 6_400)) for _ in range(150)]
    rng.shuffle(pairs)
    got = {r.node: r.component for r in graph.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    up = {x: x for p in pairs for x in p}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in pairs:
        x, y = sorted((root(a), root(b)))
        up[y] = x
    assert got == {x: root(x) for p in pairs if p[0] != p[1] for x in p}


def test_keep_one_with_any_names_of_columns(spark):
    names = ["row", "id", "key", "_kept_id", "_kept_key", "row_key", "component_id", "n", "c"]
    texts = {None: "one two three four", 1: "one two three four", 3: "other words are here", 2: None, 4: ""}
    docs = spark.createDataFrame(
        [(i, t, *[7] * len(names)) for i, t in texts.items()],
        "doc_id long, text string, " + ", ".join(f"`{n}` int" for n in names),
    )
    kept = ngram_join.keep_one(docs)
    assert kept.columns == docs.columns
    assert {(r.doc_id, r.text, r["_kept_id"]) for r in kept.collect()} == {
        (None, "one two three four", 7), (3, "other words are here", 7), (2, None, 7), (4, "", 7)
    }


def test_word_hashes_depend_on_the_word_alone(monkeypatch):
    import pyarrow as pa

    long = "y" * 5_000
    texts = ["One two  three", None, "", " \n", "TWO\tone é É " + long, long.upper() + "x", "three", "\x1cone \x85 a"]
    def hashed():
        rows, values = ngram_join.word_hashes(pa.array(texts))
        return list(zip(rows.tolist(), values.tolist(), strict=True))

    got = hashed()
    words = [(i, w) for i, t in enumerate(texts) for w in re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))]
    assert [i for i, _ in got] == [i for i, _ in words]
    value = {}
    for (_, h), (_, w) in zip(got, words, strict=True):
        assert value.setdefault(w, h) == h
    assert len(set(value.values())) == len(value)
    monkeypatch.setattr(ngram_join, "SPAN", 40)
    assert hashed() == got
