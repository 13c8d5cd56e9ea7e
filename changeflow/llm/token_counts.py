"""Token counts with a whole-token shortcut.

A byte-level BPE tokenizer splits a text into pre-tokens and merges bytes within each. The vocabulary
strings that encode alone as exactly one token are proven once, on the driver, by encoding every one.
Texts are cut into pieces at the boundaries of the tokenizer's own split rule (a run of non-space with the
one space before it, or white space); a piece found in the proven set counts one token, and only other
pieces go through the merges, each distinct piece once per worker. Special strings inside a text count
one token each, as the library does by default.

Null and empty texts have no tokens. Extra columns do not matter: only id and text are read. Repeated rows are
counted each.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from changeflow.llm import tokenizing
from changeflow.llm.common import column, ship, sub_batches

# The characters with the Unicode property White_Space.
SPACES = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
PIECES = re.compile(f" ?[^{SPACES}]+|[{SPACES}]+(?![^{SPACES}])|[{SPACES}]+")

_counters: dict[int, tuple] = {}


def check_kind(config: dict) -> None:
    """Refuse tokenizer files whose split rule differs from the one ``PIECES`` follows."""
    split = config.get("pre_tokenizer") or {}
    plain = split.get("type") == "ByteLevel" and split.get("use_regex") and not split.get("add_prefix_space")
    if config.get("normalizer") or not plain or (config.get("truncation") or config.get("padding")):
        raise ValueError("the whole-token shortcut needs a plain byte-level BPE tokenizer")


def whole_tokens(json_text: str) -> list[str]:
    """Vocabulary strings that are one piece and encode alone as their own single token."""
    tokenizer = tokenizing.load(json_text)
    special = {t.content for t in tokenizer.get_added_tokens_decoder().values()}
    strings = [tokenizer.decode([i], skip_special_tokens=False) for i in range(tokenizer.get_vocab_size())]
    encoded = tokenizer.encode_batch(strings, add_special_tokens=False)
    return [
        s
        for i, (s, one) in enumerate(zip(strings, encoded, strict=True))
        if one.ids == [i] and s not in special and PIECES.fullmatch(s)
    ]


def _counter(json_text: str, whole: list[str]) -> tuple:
    key = hash(json_text)
    if key not in _counters:
        tokenizer = tokenizing.load(json_text)
        special = sorted((t.content for t in tokenizer.get_added_tokens_decoder().values()), key=len, reverse=True)
        split = re.compile("|".join(map(re.escape, special))).split if special else (lambda text: [text])
        _counters[key] = split, tokenizing.Pieces(tokenizer, len, dict.fromkeys(whole, 1))
    return _counters[key]


def count_batch(texts: list[str], json_text: str, whole: list[str]) -> list[int]:
    split, known = _counter(json_text, whole)
    parts = [split(text) for text in texts]
    pieces = [[p for part in own for p in PIECES.findall(part)] for own in parts]
    known.learn([p for own in pieces for p in own])
    count = known.__getitem__
    counts = [len(own) - 1 + sum(map(count, found)) for own, found in zip(parts, pieces, strict=True)]
    known.forget([p for own in pieces for p in own if len(p) > tokenizing.LONGEST_KEPT])
    return counts


def token_counts(
    docs: DataFrame, tokenizer_file: str, limit: int = 1024, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Rows of (id, n_bytes, n_tokens, over_limit); ``over_limit`` is ``n_tokens > limit``."""
    json_text = tokenizing.read_text(tokenizer_file)
    check_kind(json.loads(json_text))
    ship(docs.sparkSession)
    # Bounded by the vocabulary.
    shared = docs.sparkSession.sparkContext.broadcast((json_text, whole_tokens(json_text)))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sub_batches(batches, 2 << 20):
            texts = pc.fill_null(column(batch, "_text"), "")
            counts = pa.array(count_batch(texts.to_pylist(), *shared.value), pa.int64())
            n_bytes = pc.binary_length(texts).cast(pa.int64())
            over = pc.greater(counts, limit)
            yield pa.RecordBatch.from_arrays(
                [column(batch, "_id"), n_bytes, counts, over], [id_col, "n_bytes", "n_tokens", "over_limit"]
            )

    schema = T.StructType(
        [
            T.StructField(id_col, docs.schema[id_col].dataType),
            T.StructField("n_bytes", T.LongType()),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("over_limit", T.BooleanType()),
        ]
    )
    return docs.select(docs[id_col].alias("_id"), docs[text_col].alias("_text")).mapInArrow(count, schema)
