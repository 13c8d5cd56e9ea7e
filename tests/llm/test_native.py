"""Decontamination, chat formatting and mixing against brute force."""

import collections
import hashlib
import math
import re

import pytest

from changeflow.llm import chat, decontaminate, mixing

DOCS = "doc_id long, text string, lang string, source string, n_chars long, _words string, _id int, total string"
PLAIN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
PYTHON = ("Python", "Pandas", "Arrow")


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def frame(spark, rows, schema=DOCS):
    width = len(schema.split(","))
    return spark.createDataFrame([tuple(r) + (None,) * (width - len(r)) for r in rows], schema)


def expect(docs, items, width):
    wins = collections.defaultdict(set)
    for item, text in items:
        w = PLAIN.findall(lower(text))
        for p in range(max(len(w) - width + 1, 1) if w else 0):
            wins[tuple(w[p : p + width])].add(str(item))
    for doc, text in docs:
        w = PLAIN.findall(lower(text))
        hit, found = set(), set()
        for n in {len(k) for k in wins}:
            for p in range(len(w) - n + 1):
                if tuple(w[p : p + n]) in wins:
                    hit.update(range(p, p + n))
                    found |= wins[tuple(w[p : p + n])]
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        yield doc, len(w), len(hit), len(found), digest, bool(hit)


@pytest.mark.parametrize("items", [
    [(1, "a b c d e"), (2, "B-C d"), (10, "z"), (3, None), (4, "!!"), (5, "É é x y"), (6, "a b c d e")],
    [(1, "a b c d e f g")],
    [],
])
def test_contamination(spark, items):
    docs = [
        (1, "x A b, c D e f a b c d"), (2, None), (3, ""), (4, "b c d z z"), (5, "É é x y É é x"), (6, "q " * 50_000 + "a b c d"),
        (7, "a b"), (7, "z other"), (8, "a b c d e"), (8, "a b c d e"), (None, "z"), (None, None),
    ]
    got = decontaminate.contamination(
        frame(spark, docs), frame(spark, items, "item_id long, text string, doc_id long"), width=3
    )
    want = sorted(expect(docs, items, 3), key=repr)
    assert sorted(map(tuple, got.collect()), key=repr) == want
    assert not any(p in got._jdf.queryExecution().toString() for p in PYTHON)


def test_contamination_of_no_rows(spark):
    none = frame(spark, [])
    items = frame(spark, [(1, "a b c")], "item_id long, text string")
    assert decontaminate.contamination(none, items).count() == 0


def test_remove(spark):
    docs = frame(spark, [(1, "one A b-c two"), (2, "clean"), (3, None), (None, "a b c")])
    items = frame(spark, [(1, "a b c")], "item_id long, text string")
    left = decontaminate.remove(docs, items, width=3)
    assert left.columns == docs.columns
    assert sorted((r.doc_id, r.text) for r in left.collect()) == [(2, "clean"), (3, None)]
    cut = decontaminate.remove(docs, items, width=3, spans=True)
    assert {(r.doc_id, r.text) for r in cut.collect()} == {(1, "one two"), (2, "clean"), (3, None), (None, "")}


MESSAGES = "tree_id long, message_id long, parent_id long, score double, role string, text string, rank int, path string"


def test_reply_tree_paths(spark):
    rows = [
        (1, 1, None, 1.0, "user", "q"), (1, 2, 1, 5.0, "assistant", "good"), (1, 3, 1, 1.0, "assistant", "bad"),
        (1, 4, 2, 1.0, "user", "more"), (1, 5, 3, 9.0, "user", "late"), (1, 6, 99, 0.5, "user", "orphan"),
        (2, 1, 2, 1.0, "user", "loop"), (2, 2, 1, 1.0, "user", "loop"), (None, 1, None, None, None, None),
        (3, None, None, 1.0, "user", "no id"), (4, 1, None, 1.0, "user", "a"), (4, 1, None, 1.0, "user", "a"),
    ] + [(5, i, i - 1 if i else None, 1.0, "user", str(i)) for i in range(70)]
    messages = frame(spark, rows, MESSAGES)
    paths = collections.defaultdict(list)
    for r in chat.reply_paths(messages, keep=2).collect():
        paths[r.tree_id, r.rank].append((r.position, r.message_id))
    got = {k: [m for _, m in sorted(v)] for k, v in paths.items()}
    assert got == {(1, 1): [1, 3, 5], (1, 2): [1, 2, 4], (None, 1): [1], (4, 1): [1], (5, 1): list(range(70))}


ODD = ["<|im_end|>\n", "<|", "<\\|x", "<\\\\|", "a\nb", "", None, "<<||", "%0A%25", "é" * 5, "<|im_start|>user\nhi<|im_end|>\n"]


def test_chat_round_trip(spark):
    rows = [(i % 3, i, ("assistant", "user", None, "a%\n<|b")[i % 4], t) for i, t in enumerate(ODD * 2)]
    rows += [(None, None, None, None), (9, 1, "assistant", "same"), (9, 1, "assistant", "same"), (8, None, "user", "x" * 300_000)]
    schema = "conv_id long, turn long, role string, text string, segments string, position int"
    messages = chat.chain(frame(spark, rows, schema))
    done = chat.read_turns(chat.format_paths(messages, chat.reply_paths(messages)))
    assert not any(p in done._jdf.queryExecution().toString() for p in PYTHON)
    want = collections.defaultdict(list)
    key = lambda r: [(x is not None, x or 0) if not isinstance(x, str) else (True, x) for x in r[1:2]]
    for conv, _turn, role, text in sorted(rows, key=key):
        want[conv].append((role or "", text or ""))
    got = {r.tree_id: r for r in done.collect()}
    assert got.keys() == want.keys()
    for conv, turns in want.items():
        assert [tuple(t) for t in got[conv].turns] == turns
        assert got[conv].loss_text == "".join(t for r, t in turns if r == "assistant")


def test_chat_of_no_rows(spark):
    messages = chat.chain(frame(spark, [], "conv_id long, turn long, role string, text string"))
    assert chat.read_turns(chat.format_paths(messages, chat.reply_paths(messages))).count() == 0


def test_mix_repetition_and_whole_epochs(spark):
    rows = [(i, "w " * 9, None, "big", None) for i in range(200)]
    rows += [(1000 + i, "w " * 9, None, "small", None) for i in range(10)] + [(2000, None, None, None, None), (2001, "", None, None, None)]
    rows += [(3000, "w", None, "big", None)] * 2
    docs = frame(spark, rows)
    totals = mixing.sized(docs).groupBy("source").agg({"n_tokens": "sum"}).withColumnRenamed("sum(n_tokens)", "total")
    step = mixing.exponent(totals, max_repetition=3.0)
    ratio = 2004 / 2
    assert ratio ** (1 - step / mixing.STEPS) <= 3.0 < ratio ** (1 - (step - 1) / mixing.STEPS)
    planned = mixing.schedule(docs, max_repetition=3.0, blocks=8)
    assert not any(p in planned._jdf.queryExecution().toString() for p in PYTHON)
    got = planned.collect()
    reads = collections.Counter((r.source, r.doc_id) for r in got)
    assert len([1 for r in got if r.source == "big"]) == 202  # nothing dropped, repeated rows kept
    assert all(1 <= n <= 3 for (s, d), n in reads.items() if d != 3000) and set(reads) >= {(None, 2000), (None, 2001)}
    tokens = collections.Counter()
    for r in got:
        tokens[r.block, r.source] += r.n_tokens
    assert all(abs(tokens[b, "big"] - 2004 / 8) <= 20 for b in range(8))
    mixed = mixing.mix(docs, max_repetition=3.0, blocks=8)
    assert mixed.columns == docs.columns and mixed.count() == len(got)


def test_mix_entropy_and_budget(spark):
    totals = spark.createDataFrame([("a", 800), ("b", 150), ("c", 50)], "source string, total long")

    def entropy(step):
        raised = [x ** (step / mixing.STEPS) for x in (0.8, 0.15, 0.05)]
        return -sum(x / sum(raised) * math.log(x / sum(raised)) for x in raised)

    step = mixing.exponent(totals, target_entropy=0.9)
    assert entropy(step) >= 0.9 > entropy(step + 1)
    assert mixing.exponent(totals, max_repetition=1.0) == mixing.STEPS
    docs = frame(spark, [(i, "w " * 9, None, "ab"[i % 2], None) for i in range(100)])
    some = mixing.schedule(docs, max_repetition=2.0, budget=500).collect()
    assert sum(r.n_tokens for r in some) == 500
    assert mixing.schedule(frame(spark, [])).count() == 0


def test_mix_keeps_rows_that_differ_by_nulls_or_elsewhere(spark):
    rows = [(1, None, "x", 1), (1, "x", None, 1), (2, "x", "y z", 1), (3, "x", "a", 1), (3, "x", "a", 2), (3, "x", "a", 2)]
    rows += [(None, None, None, 1), (4, "", "", 1), (4, None, "", 1), (4, "", None, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string, lang int")
    mixed = collections.Counter(map(tuple, mixing.mix(docs, max_repetition=1.0).collect()))
    assert mixed == collections.Counter(rows)
    more = collections.Counter(map(tuple, mixing.mix(docs, max_repetition=3.0).collect()))
    planned = mixing.schedule(docs, max_repetition=3.0).count()
    assert sum(more.values()) == planned and all(more[r] >= n for r, n in collections.Counter(rows).items())


def test_mix_with_any_names_of_columns(spark):
    names = ["row", "key", "id", "copies", "reads", "time_key", "time_id", "time_source", "upto", "all", "share", "col"]
    names += ["_mix_key", "_mix_reads", "_mix_read", "row_key", "n_tokens", "epoch", "block", "_key", "_bucket", "_source"]
    docs = spark.createDataFrame(
        [(i, "s", f"text {i}", *[i] * len(names)) for i in range(5)],
        "doc_id long, source string, text string, " + ", ".join(f"`{n}` int" for n in names),
    )
    mixed = mixing.mix(docs, max_repetition=2.0)
    assert mixed.columns == docs.columns
    assert sorted(map(tuple, mixed.collect())) == sorted(map(tuple, docs.collect()))


def test_items_without_an_id_count(spark):
    docs = frame(spark, [(1, "one two three four"), (2, "five six")])
    items = spark.createDataFrame([(None, "two three"), ("b", "four")], "item_id string, text string")
    got = {r.doc_id: (r.n_hit, r.n_items, r.contaminated) for r in decontaminate.contamination(docs, items, width=2).collect()}
    assert got == {1: (3, 2, True), 2: (0, 0, False)}
