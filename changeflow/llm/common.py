"""Table access and Arrow batch helpers that the operators share."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Iterable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from changeflow.session import scratch_path, stage

__all__ = ["column", "held_out", "scratch_path", "ship", "stage", "sub_batches", "table"]


def ship(spark: SparkSession) -> None:
    """Send this package's code to the executors, once per application, so that they need no copy of it."""
    context = spark.sparkContext
    if getattr(context, "_changeflow_code_sent", False):
        return
    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="changeflow-code-")) / "changeflow_code.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as code:
        for file in sorted(package.rglob("*.py")):
            code.write(file, file.relative_to(package.parent))
    context.addPyFile(str(archive))
    context._changeflow_code_sent = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id: Column, parts: int, held: int = 2) -> Column:
    """Whether crc32 of the id as text leaves ``held`` modulo ``parts``; a null id counts as text ``null``."""
    text = F.coalesce(doc_id.cast("string"), F.lit("null"))
    return F.crc32(text.cast("binary")) % parts == held


def sub_batches(batches: Iterable[pa.RecordBatch], max_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Cut batches so that each piece holds about ``max_bytes`` (one row at least)."""
    for batch in batches:
        rows = batch.num_rows
        if not rows:
            continue
        step = max(1, int(rows * max_bytes / max(batch.nbytes, 1)))
        for start in range(0, rows, step):
            yield batch.slice(start, min(step, rows - start))


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))
