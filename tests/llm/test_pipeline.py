"""The pipeline, stage by stage, against plain Python on the same small table."""

import collections
import hashlib
import re
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from changeflow.llm import langid
from .test_native import PLAIN, lower
from .test_ngram_join import brute

DATA = "/root/testdata/sf0.001"
ODD = [(-1, None, "en", "x", 0), (-2, "", None, None, 0), (-3, "12 34 !!", "en", "src0", 8), (None, None, None, None, None)]


def ids(rows):
    return sorted(r[0] for r in rows)


def test_stages_equal_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    rows = [tuple(r) for r in docs.collect()] + ODD
    repeated = rows[11]
    rows.append(repeated)
    docs = spark.createDataFrame(rows, docs.schema)
    seen = []
    for name, function in corpus_pipeline.STAGES:
        path = str(tmp_path / name)
        function(spark, docs, DATA).write.parquet(path)
        docs = spark.read.parquet(path)
        seen.append([tuple(r) for r in docs.collect()])
    one, two, three, four, five = seen
    assert all(len(r) == 5 for stage in seen[:4] for r in stage)

    # 1: only texts without letters and hardly any similarity go
    lost = collections.Counter(rows) - collections.Counter(one)
    assert set(ODD) <= set(lost) and all(r in ODD or len(r[1]) < 30 for r in lost)
    assert langid.UNDEFINED not in {r[2] for r in one}

    # 2: the least id of each component
    parts = brute([r[:2] for r in one], width=5, percent=80)
    assert ids(two) == sorted({c for _, _, c, _ in parts})

    # 3: no window of a benchmark item
    windows = set()
    for (text,) in spark.read.parquet(f"{DATA}/benchmark.parquet").select("text").collect():
        w = PLAIN.findall(lower(text))
        windows |= {tuple(w[p : p + 10]) for p in range(max(len(w) - 9, 1) if w else 0)}
    sizes = {len(w) for w in windows}

    def clean(text):
        w = PLAIN.findall(lower(text))
        return not any(tuple(w[p : p + n]) in windows for n in sizes for p in range(len(w) - n + 1))

    assert ids(three) == sorted(r[0] for r in two if clean(r[1]))
    assert len(three) < len(two) < len(one)

    # 4: every document once or twice, the largest source once
    reads = collections.Counter(four)
    assert set(reads) == set(three) and max(reads.values()) == 2
    tokens = collections.Counter()
    for r in three:
        tokens[r[3]] += len(re.findall(r"[^\x20\x09-\x0D]+", r[1])) + 1
    top = max(tokens, key=tokens.get)
    assert all(n == 1 for r, n in reads.items() if r[3] == top)

    # 5: ids of every text in order
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want, start = [], 0
    for r in sorted(four, key=lambda r: (r[0], r[1])):
        own = library.encode(r[1], add_special_tokens=False).ids + [1]
        want.append((r[0], start, len(own), zlib.crc32(np.asarray(own, "<u4").tobytes())))
        start += len(own)
    assert sorted(five, key=lambda r: r[1]) == want


def test_language_stage_keeps_short_clean_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    words = sorted({w for (t,) in docs.select("text").collect() for w in re.findall(r"[^\W\d_]+", t or "")})[:3_000]
    short = ["OK", "Hello world", "a", "xyzzy " * 400, *words]
    rng = np.random.default_rng(6)
    strange = ["".join(chr(c) for c in rng.integers(0x10A0, 0x10FB, 4_000) if chr(c).isalpha()) for _ in range(20)]
    rows = [(10_000_000 + i, t, None, "x", len(t)) for i, t in enumerate([*short, *strange])]
    known = [tuple(r) for r in docs.collect()]
    kept = corpus_pipeline.language_id(spark, spark.createDataFrame(known + rows, docs.schema), DATA)
    kept = collections.Counter(map(tuple, kept.collect()))
    assert all(kept[r] == 1 for r in rows[: len(short)])
    assert not any(kept[r] for r in rows[len(short) : len(short) + 20])  # a script that no profile has
    assert all(kept[r] for r in known if re.search(r"[^\W\d_]", r[1] or ""))


def test_run(spark):
    got = corpus_pipeline.run(spark, DATA)
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    again = corpus_pipeline.run(spark, DATA)
    digest = lambda df: hashlib.sha256(repr(sorted(map(tuple, df.collect()))).encode()).hexdigest()
    assert digest(got) == digest(again)


def test_empty_table(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").limit(0)
    for _, function in corpus_pipeline.STAGES[:-1]:
        docs = function(spark, docs, DATA)
        assert docs.count() == 0 and len(docs.columns) == 5
    assert corpus_pipeline.STAGES[-1][1](spark, docs, DATA).count() == 0
