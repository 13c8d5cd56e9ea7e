"""Token ids in ORC files: integer run-length encoding, row indexes and Bloom filters on document ids.

Documents are dealt to segments by ranges of their id, sorted within each, encoded, closed by an end id and
written as ORC, one file per segment. Rows carry the document's offset within its segment, so a reader
finds every document's place in the whole stream from the segment totals, which it takes from the narrow
columns alone. Stripes can be read in parallel; filters on ``doc_id`` skip files and stripes by their
statistics and Bloom filters.

A null text is an empty document (just the end id). A null id sorts first. Repeated ids are documents of their
own, ordered by text. Columns other than id and text are not read.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeflow.llm import tokenizing
from changeflow.llm.byte_pieces import Coder, encode_apart, word_cuts
from changeflow.llm.common import column, ship, sub_batches

ROW_INDEX_STRIDE = 1_000
STRIPE_BYTES = 16 << 20
BLOOM_FPP = 0.01
SEGMENT_BYTES = 64 << 20

BATCH_BYTES = 2 << 20
STORE_BYTES = 24 << 20  # of words and ids kept per worker
LOWERED = np.arange(256, dtype=np.uint8)
LOWERED[ord("A") : ord("Z") + 1] += 32

_encoders: dict[int, tuple[tokenizing.Words, Coder]] = {}


def check_kind(config: dict) -> None:
    """Refuse tokenizer files that do not treat words apart: they have to lower-case, drop white space and mark word ends."""
    normal = [n.get("type") for n in (config.get("normalizer") or {}).get("normalizers", [])]
    split = (config.get("pre_tokenizer") or {}).get("pretokenizers", [{}])[0]
    model = config.get("model", {})
    plain = (
        normal == ["NFC", "Replace", "Lowercase"]
        and split.get("type") == "Split"
        and split.get("invert")
        and model.get("end_of_word_suffix")
        and not model.get("continuing_subword_prefix")
        and all("<|" in token["content"] for token in config.get("added_tokens", []))
    )
    if not plain or config.get("truncation") or config.get("padding"):
        raise ValueError("token files need a tokenizer that encodes words apart from each other")


def encode_rows(texts: pa.Array, json_text: str, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts one after another, each closed by ``end_id``, and the number of ids of each.

    The tokenizer drops white space between pre-tokens and normalises characters one by one, so words, and marks behind
    ASCII letters, are encoded apart: a worker asks for each distinct one about once. Capitals A-Z are lowered first.
    Texts that may hold special strings are encoded whole.
    """
    key = hash(json_text)
    if key not in _encoders:
        words = tokenizing.Words(tokenizing.load(json_text))
        _encoders[key] = words, Coder(word_cuts, lambda pieces: words.encode([p.decode() for p in pieces]), STORE_BYTES)
    words, coder = _encoders[key]
    ids, counts = encode_apart(texts, ["<|"], words.tokenizer, lambda data, bounds: coder(LOWERED[data], bounds)[:2])
    return np.insert(ids, np.cumsum(counts), end_id), counts + 1


def by_id_ranges(docs: DataFrame, segments: int) -> DataFrame:
    """Deal rows to at most ``segments`` ascending ranges of ids and sort each."""
    order = [F.col("doc_id").asc_nulls_first(), F.col("_text").asc_nulls_first()]
    return docs.repartitionByRange(segments, order[0]).sortWithinPartitions(*order)


def segment_count(docs: DataFrame, text_col: str) -> int:
    """Segments of about ``SEGMENT_BYTES`` of text each, at least one per core."""
    total = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    cores = docs.sparkSession.sparkContext.defaultParallelism
    return int(max(cores, -(-total // SEGMENT_BYTES)))


def write_token_files(
    docs: DataFrame,
    path: str,
    tokenizer_file: str,
    end_id: int = 1,
    segments: int | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> None:
    """Encode ``docs`` and write (doc_id, segment, offset, n_tokens, ids) in ascending id order."""
    ship(docs.sparkSession)
    json_text = tokenizing.read_text(tokenizer_file)
    check_kind(json.loads(json_text))
    shared = docs.sparkSession.sparkContext.broadcast(json_text)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segment, offset = TaskContext.get().partitionId(), 0
        for batch in sub_batches(batches, BATCH_BYTES):
            ids, counts = encode_rows(column(batch, "_text"), shared.value, end_id)
            ends = np.concatenate(([0], np.cumsum(counts)))
            arrays = [
                column(batch, "doc_id"),
                pa.array(np.full(len(counts), segment, np.int32)),
                pa.array(offset + ends[:-1]),
                pa.array(counts),
                pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids.astype(np.int32))),
            ]
            offset += int(ends[-1])
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "segment", "offset", "n_tokens", "ids"])

    id_type = docs.schema[id_col].dataType
    schema = T.StructType(
        [
            T.StructField("doc_id", id_type),
            T.StructField("segment", T.IntegerType()),
            T.StructField("offset", T.LongType()),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("ids", T.ArrayType(T.IntegerType())),
        ]
    )
    plain = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("_text"))
    dealt = by_id_ranges(plain, segments or segment_count(plain, "_text"))
    (
        dealt.mapInArrow(encode, schema)
        .write.option("compression", "zstd")
        .option("orc.stripe.size", STRIPE_BYTES)
        .option("orc.create.index", "true")
        .option("orc.row.index.stride", ROW_INDEX_STRIDE)
        .option("orc.bloom.filter.columns", "doc_id")
        .option("orc.bloom.filter.fpp", BLOOM_FPP)
        .orc(path)
    )


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """The rows of the files, plus ``start``: ids of all documents before the row."""
    rows = spark.read.orc(path)
    # One row per file; only two narrow columns are read for it.
    before = W.orderBy("segment").rowsBetween(W.unboundedPreceding, -1)
    bases = (
        rows.groupBy("segment")
        .agg(F.sum("n_tokens").alias("_total"))
        .select("segment", F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_base"))
    )
    return rows.join(F.broadcast(bases), "segment").withColumn("start", F.col("_base") + F.col("offset")).drop("_base")


def digest(rows: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of rows read back; fails when a stored count is wrong."""
    ship(rows.sparkSession)

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sub_batches(batches):
            lists = column(batch, "ids")
            ids = lists.flatten().to_numpy(zero_copy_only=False).astype("<u4").tobytes()
            counts = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
            if (counts != column(batch, "n_tokens").to_numpy(zero_copy_only=False)).any():
                raise ValueError("a token file holds another number of ids than its row says")
            ends = np.concatenate(([0], np.cumsum(counts))) * 4
            crc = [zlib.crc32(ids[a:b]) for a, b in zip(ends[:-1], ends[1:], strict=True)]
            arrays = [column(batch, "doc_id"), column(batch, "start"), pa.array(counts), pa.array(crc, pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "start", "n_tokens", "ids_crc32"])

    schema = T.StructType(
        [
            T.StructField("doc_id", rows.schema["doc_id"].dataType),
            T.StructField("start", T.LongType()),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("ids_crc32", T.LongType()),
        ]
    )
    return rows.select("doc_id", "start", "n_tokens", "ids").mapInArrow(check, schema)
