"""The corpus pipeline: documents in, token files out, one operator per stage.

Every stage reads what its predecessor wrote as Parquet. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from changeflow.llm import decontaminate, langid, mixing, ngram_join, token_files
from changeflow.llm.common import scratch_path, stage, table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that may be of a known language; those without letters, or clearly unlike every profile, go."""
    return langid.keep_identified(docs)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies: five-word shingles, similarity of 0.8 or more."""
    return ngram_join.keep_one(docs, width=5, percent=80)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item."""
    return decontaminate.remove(docs, table(spark, sf_dir, "benchmark"), width=decontaminate.WIDTH)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources read by temperature weights: small ones up to twice, every document at least once."""
    return mixing.mix(docs, max_repetition=2.0)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files, and from them per document: doc_id, start, n_tokens, ids_crc32."""
    import public_tokenizers

    path = scratch_path(spark, "pipeline-token-files")
    token_files.write_token_files(docs, path, public_tokenizers.path("word_bpe_49k.json"), end_id=1)
    return token_files.digest(token_files.read_token_files(spark, path))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("benchmark_decontamination", benchmark_decontamination),
    ("source_mix", source_mix),
    ("token_output", token_output),
]

# A language model of trigram vectors and a tokenizer are not SQL; tests/llm/test_pipeline.py compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
