"""Token files and token counts against the library itself."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from changeflow.llm import token_counts, token_files

WORDS = public_tokenizers.path("word_bpe_49k.json")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string, segment int, start string"

ODD = [
    None,
    "",
    " ",
    "\n\n  a\t\tb \r\n",
    "it's they'll WE'VE I'd 12 345x",
    "a<|endoftext|>b <|startoftext|> c<|endoftext|><|endoftext|>",
    "é ́x éÉ ΣΣ naïve x y　z",
    "a\x1cb\x85c \x0bd\x0ce \x1f",
    "你好 世界 \U0001f600\U0001f600 !!! ...",
    "word " * 40_000 + "x" * 20_000,
    "   \n   \n x",
]


def texts():
    rng = random.Random(5)
    alphabet = list("abcXYZ'  \n\t19.,!é日\x1c ʼ<|>") + ["'s", "'ll", "<|endoftext|>", " the", "ing"]
    return ODD + ["".join(rng.choices(alphabet, k=rng.randint(1, 60))) for _ in range(300)]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i * 7 % 1009, t, 3, "x") for i, t in enumerate(texts())]
    rows += [(None, "null id", 1, None), (7, "again", 1, None), (7, "again", 1, None)]
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


def test_counts_equal_library(docs):
    library = Tokenizer.from_file(BYTES)
    got = token_counts.token_counts(docs, BYTES, limit=30)
    assert got.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    want = []
    for r in docs.collect():
        n = len(library.encode(r.text or "", add_special_tokens=False).ids)
        want.append((r.doc_id, len((r.text or "").encode()), n, n > 30))
    key = repr
    assert sorted(map(tuple, got.collect()), key=key) == sorted(want, key=key)


def test_whole_tokens_are_proven():
    whole = token_counts.whole_tokens(open(BYTES, encoding="utf-8").read())
    assert len(whole) > 40_000 and " the" in whole and "<|endoftext|>" not in whole


def test_counts_refuse_other_kinds():
    with pytest.raises(ValueError):
        token_counts.token_counts(None, WORDS)


def test_files_refuse_other_kinds(docs, tmp_path):
    with pytest.raises(ValueError):
        token_files.write_token_files(docs, str(tmp_path / "x"), BYTES)


def test_counts_of_no_rows(spark):
    assert token_counts.token_counts(spark.createDataFrame([], SCHEMA), BYTES).count() == 0


def test_files_round_trip(spark, docs, tmp_path):
    path = str(tmp_path / "ids")
    token_files.write_token_files(docs, path, WORDS, end_id=1, segments=4)
    library = Tokenizer.from_file(WORDS)
    rows = sorted(docs.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.text is not None, r.text or ""))
    want, start = [], 0
    for r in rows:
        ids = library.encode(r.text or "", add_special_tokens=False).ids + [1]
        want.append((r.doc_id, start, len(ids), zlib.crc32(np.asarray(ids, "<u4").tobytes())))
        start += len(ids)
    back = token_files.read_token_files(spark, path)
    assert sorted(map(tuple, token_files.digest(back).collect()), key=lambda r: r[1]) == want
    one = back.where(F.col("doc_id") == rows[40].doc_id).first()
    assert one.ids == library.encode(rows[40].text or "", add_special_tokens=False).ids + [1]


def test_files_of_no_rows(spark, tmp_path):
    path = str(tmp_path / "none")
    token_files.write_token_files(spark.createDataFrame([], SCHEMA), path, WORDS)
    assert token_files.digest(token_files.read_token_files(spark, path)).count() == 0


def test_files_prune_by_id(spark, docs, tmp_path):
    path = str(tmp_path / "pruned")
    token_files.write_token_files(docs, path, WORDS, segments=4)
    plan = token_files.read_token_files(spark, path).where("doc_id = 7")._jdf.queryExecution().toString()
    assert "PushedFilters: [IsNotNull(doc_id), EqualTo(doc_id,7)" in plan
