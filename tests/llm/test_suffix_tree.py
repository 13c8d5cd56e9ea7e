"""The suffix tree: exact base scores, proper distributions, and better scores than the base on held-out text."""

import collections
import math
import random
import re
import zlib

import numpy as np
from pyspark.sql import functions as F

from changeflow.llm import suffix_tree
from changeflow.llm.common import held_out, stage
from changeflow.llm.queries import QUERIES

DATA = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def tokens(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) + ["\n"]


def check(got, rows, parts=7):
    held = lambda d: zlib.crc32(("null" if d is None else str(d)).encode()) % parts == 2
    counts = collections.Counter(w for d, t in rows if not held(d) for w in tokens(t))
    n, v = sum(counts.values()), len(counts)
    want = []
    for d, t in rows:
        own = tokens(t)
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in own)
        want.append((d, held(d), len(own), sum(counts[w] > 0 for w in own), n, round(base, 6)))
    key = repr
    assert sorted(((*r[:5], round(r[5], 6)) for r in got), key=key) == sorted(want, key=key)


def test_query(spark, monkeypatch):
    rows = [tuple(r) for r in spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()]
    got = QUERIES["op10_suffix_tree"](spark, DATA).collect()
    check(got, rows)
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > 0.9 * sum(r.base_score for r in held)
    assert all(r.score < 0 for r in got)


def test_rare_words_meet_their_counts(spark, monkeypatch):
    monkeypatch.setattr(suffix_tree, "COUNTED", 6)
    monkeypatch.setattr(suffix_tree, "LEAST_CONTEXT", 3)
    rows = [(i, f"the Cat w{i % 7} sat on x{i} é the mat") for i in range(60)]
    rows += [(100, None), (101, ""), (None, "the cat"), (None, None), (102, "the a " * 20_000), (5, rows[5][1]), (5, "other words")]
    docs = spark.createDataFrame([(*r, 1.0, 2) for r in rows], "doc_id long, text string, score double, w int").repartition(3)
    check(suffix_tree.scores(docs, held_out(docs["doc_id"], 7)).collect(), rows)


def test_distributions_are_proper(spark, monkeypatch):
    monkeypatch.setattr(suffix_tree, "LEAST_CONTEXT", 3)
    docs = spark.createDataFrame([("a b c a b d a b c",)] * 9 + [("b a c d",)] * 5, "_text string")
    words = stage(suffix_tree.count_words(docs), "words")
    model = suffix_tree.learn(docs, words)
    assert len(model.levels[0].contexts) and len(model.levels[1].contexts)
    codes = np.flatnonzero(model.root)
    for near in [*codes, suffix_tree.START]:
        for far in [*codes, suffix_tree.START]:
            size = len(codes)
            contexts = [np.full(size, near, np.uint64), np.full(size, far << 16 | near, np.uint64)]
            p = suffix_tree.chances(model, contexts, codes)
            assert abs(p.sum() - 1) < 1e-9


def test_no_rows_and_nothing_to_train(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    assert suffix_tree.scores(docs.limit(0), F.lit(False)).count() == 0
    got = {r.doc_id: (r.n_tokens, r.n_known, r.train_tokens) for r in suffix_tree.scores(docs, F.lit(True)).collect()}
    assert got == {1: (3, 0, 0), 2: (1, 0, 0)}


def tree_scores(train, texts, symbols, depth):
    """Scores by the definition, with contexts as tuples of words; None stands for the class of other words."""
    counts = collections.Counter(w for t in train for w in tokens(t))
    total = sum(counts.values())
    alphabet = set(sorted(counts, key=lambda w: -counts[w])[:symbols])
    assert len({counts[w] for w in alphabet} & {counts[w] for w in set(counts) - alphabet}) == 0
    other = sum(c for w, c in counts.items() if w not in alphabet)
    once = sum(1 for w, c in counts.items() if c == 1 and w not in alphabet)
    unseen = (once + 0.5) / (other + 1)
    symbol = lambda w: w if w in alphabet else None
    root = lambda s: (counts[s] if s is not None else other + 1) / (total + 1)

    def before(own, i, d):
        return tuple(own[i - k] if i >= k else "^" for k in range(d, 0, -1))

    levels = []

    def chance(own, i, s):
        p = root(s)
        for d, level in enumerate(levels, 1):
            if found := level.get(before(own, i, d)):
                kept, types = found
                p = (kept.get(s, 0) + types * p) / (sum(kept.values()) + types)
        return p

    coded = [[symbol(w) for w in tokens(t)] for t in train]
    allowed = None
    for d in range(1, depth + 1):
        moves, parent = collections.defaultdict(collections.Counter), {}
        for own in coded:
            for i, s in enumerate(own):
                context = before(own, i, d)
                if allowed is None or context in allowed:
                    moves[context][s] += 1
                    parent[context, s] = chance(own, i, s)
        level = {}
        for context, following in moves.items():
            n = sum(following.values())
            gain = sum(c * math.log(c / parent[context, s]) for s, c in following.items())
            if n >= suffix_tree.LEAST_CONTEXT and gain / n - math.log(n) >= suffix_tree.DIVERGENCE:
                kept = {s: c for s, c in following.items() if c >= suffix_tree.LEAST_COUNT}
                level[context] = kept, len(following)
        levels.append(level)
        allowed = {(*c, s) for c, f in moves.items() for s, n in f.items() if n >= suffix_tree.LEAST_CONTEXT and s != "\n"}
        if not allowed:
            break
    out = []
    for t in texts:
        own, score = [symbol(w) for w in tokens(t)], 0.0
        for i, w in enumerate(tokens(t)):
            score += math.log10(chance(own, i, own[i]))
            if own[i] is None:
                score += math.log10((1 - unseen) * counts[w] / other if counts[w] else unseen)
        out.append(score)
    return out, levels


def test_scores_equal_a_tree_of_tuples(spark, monkeypatch):
    monkeypatch.setattr(suffix_tree, "LEAST_CONTEXT", 4)
    monkeypatch.setattr(suffix_tree, "SYMBOLS", 10)
    monkeypatch.setattr(suffix_tree, "START", 11)
    rng = random.Random(3)
    phrases = ["a b c d e f g", "b c a", "d e f a b", "g g a b c d", "x y a b c d e"]
    texts = [" ".join(rng.choice(phrases) for _ in range(rng.randint(1, 6))) for _ in range(120)]
    texts += [f"{t} rare{i % 9} word{i}" for i, t in enumerate(texts[:30])] + ["never seen a b c d", "", None]
    rows = list(enumerate(texts))
    held = lambda d: zlib.crc32(str(d).encode()) % 7 == 2
    train = [t for d, t in rows if not held(d)]
    want, levels = tree_scores(train, texts, 10, suffix_tree.MOST_DEPTH)
    assert len(levels) == suffix_tree.MOST_DEPTH and all(levels[:4])
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: r.score for r in suffix_tree.scores(docs, held_out(docs["doc_id"], 7)).collect()}
    assert max(abs(got[d] - want[d]) for d, _ in rows) < 1e-9


def phrase_rows():
    rng = random.Random(3)
    phrases = ["a b c d e f g", "b c a", "d e f a b", "g g a b c d", "x y a b c d e"]
    texts = [" ".join(rng.choice(phrases) for _ in range(rng.randint(1, 6))) for _ in range(120)]
    texts += [f"{t} rare{i % 9} word{i}" for i, t in enumerate(texts[:30])] + ["never seen a b c d", "", None] + [texts[0]] * 5
    return list(enumerate(texts))


def check_scores(spark, rows):
    train = [t for d, t in rows if zlib.crc32(str(d).encode()) % 7 != 2]
    want, _ = tree_scores(train, [t for _, t in rows], 10, suffix_tree.MOST_DEPTH)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: r.score for r in suffix_tree.scores(docs, held_out(docs["doc_id"], 7)).collect()}
    assert max(abs(got[d] - want[d]) for d, _ in rows) < 1e-9


def test_states_and_counts_have_no_limit(spark, monkeypatch):
    for name, value in {"LEAST_CONTEXT": 4, "SYMBOLS": 10, "START": 11}.items():
        monkeypatch.setattr(suffix_tree, name, value)
    for name in ("STATES", "TRANSITIONS"):  # the limits of earlier versions
        monkeypatch.setattr(suffix_tree, name, 8, raising=False)
    check_scores(spark, phrase_rows())


def test_frequent_contexts_have_buckets_of_their_own(spark, monkeypatch):
    for name, value in {"LEAST_CONTEXT": 4, "SYMBOLS": 10, "START": 11, "BUCKET": 20}.items():
        monkeypatch.setattr(suffix_tree, name, value)
    depths = []
    add_heavy = suffix_tree.Plan.add_heavy
    monkeypatch.setattr(suffix_tree.Plan, "add_heavy", lambda plan, *a: depths.append(len(plan.heavy) + 1) or add_heavy(plan, *a))
    check_scores(spark, phrase_rows())
    assert depths == [1, 2, 3, 4]
