"""Ordered binary sink: segment files plus a manifest.

Spark's text sink cannot write records without separators, so the bytes go out through the Python
data source API. Records arrive sorted; each (split, segment) becomes one file. File names are unique
per task attempt and only files a finished attempt reports enter the manifest, so a lost executor or
a task that runs twice leaves no trace in the result, and nothing has to be renamed. The end of a job, good or bad,
deletes the files of its other attempts; replacing a dump also deletes what earlier jobs left in the folder.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import sys
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby

import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

MANIFEST = "manifest.jsonl"
COPY_BYTES = 8 << 20
_DIGESTS = pa.schema([("split_id", pa.int32()), ("records", pa.int64()), ("bytes", pa.int64()), ("digest", pa.string())])
MANIFEST_SCHEMA = "split_id int, segment long, file string, bytes long, records long"
ORDER = ["split_id", "segment", "change_id", "part"]


# Ship this module's code with the job, so that executors need no installed copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


@dataclass
class SegmentsWritten(WriterCommitMessage):
    entries: list


# Spark's names of stores that Arrow calls otherwise.
ARROW_SCHEMES = {"s3a": "s3", "s3n": "s3", "wasb": "abfs", "wasbs": "abfs"}


class DumpSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "changeflow_dump"

    def writer(self, schema, overwrite: bool) -> "DumpWriter":
        return DumpWriter(self.options["path"], self.options.get("name", "dump"), overwrite)


def file_store(path: str) -> tuple[fs.FileSystem, str]:
    """Arrow's file system for a path as Spark spells it."""
    scheme, found, rest = path.partition("://")
    return fs.FileSystem.from_uri(ARROW_SCHEMES.get(scheme, scheme) + found + rest if found else path)


class DumpWriter(DataSourceArrowWriter):
    """Writes segments; every file carries the job's mark, so the end of a job can tell its own from others'."""

    def __init__(self, path: str, name: str, overwrite: bool) -> None:
        self.path, self.name, self.overwrite = path, name, overwrite
        self.job = uuid.uuid4().hex[:12]

    def write(self, iterator: Iterator[pa.RecordBatch]) -> SegmentsWritten:
        store, root = file_store(self.path)
        store.create_dir(root, recursive=True)
        attempt = uuid.uuid4().hex[:12]
        entries, key, out = [], None, None
        try:
            for batch in iterator:
                if not batch.num_rows:
                    continue
                records = batch.column("record").cast(pa.large_binary())
                for begin, end, split, segment in _runs(batch):
                    if (split, segment) != key:
                        if out is not None:
                            out.close()
                        key = (split, segment)
                        file = f"{self.name}{split or ''}-{segment:09d}-{self.job}-{attempt}"
                        out = store.open_output_stream(f"{root}/{file}")
                        entries.append(
                            {"split_id": split, "segment": segment, "file": file, "bytes": 0, "records": 0}
                        )
                    chunk = _joined(records.slice(begin, end - begin))
                    out.write(chunk)
                    entries[-1]["bytes"] += chunk.size
                    entries[-1]["records"] += end - begin
            if out is not None:
                out.close()
        except BaseException:
            # An attempt that fails takes its files along; one that is killed leaves them to the end of the job.
            _delete(store, root, [e["file"] for e in entries])
            raise
        return SegmentsWritten(entries)

    def commit(self, messages: list) -> None:
        store, root = file_store(self.path)
        store.create_dir(root, recursive=True)
        written = sorted(
            (e for m in messages if m is not None for e in m.entries),
            key=lambda e: (e["split_id"], e["segment"]),
        )
        target = f"{root}/{MANIFEST}"
        earlier = []
        if store.get_file_info(target).type != fs.FileType.NotFound:
            with store.open_input_stream(target) as stream:
                earlier = [json.loads(line) for line in stream.read().splitlines()]
        lines = written if self.overwrite else earlier + written
        with store.open_output_stream(target) as stream:
            stream.write("".join(json.dumps(e) + "\n" for e in lines).encode())
        # Files of attempts that were killed, and, when a dump is replaced, all that earlier jobs left.
        named = {e["file"] for e in lines}
        _delete(store, root, [f for f in self._files(store, root, own=not self.overwrite) if f not in named])

    def abort(self, messages: list) -> None:
        store, root = file_store(self.path)
        _delete(store, root, self._files(store, root, own=True))

    def _files(self, store: fs.FileSystem, root: str, own: bool) -> list[str]:
        """Segment files in the folder: this job's, or those of all jobs that wrote under the same name."""
        mark = self.job if own else "[0-9a-f]{12}"
        pattern = re.compile(rf"{re.escape(self.name)}\d*-\d{{9,}}-{mark}-[0-9a-f]{{12}}")
        found = store.get_file_info(fs.FileSelector(root, allow_not_found=True))
        return [i.base_name for i in found if i.type == fs.FileType.File and pattern.fullmatch(i.base_name)]


def _delete(store: fs.FileSystem, root: str, files: list[str]) -> None:
    for file in files:
        if store.get_file_info(f"{root}/{file}").type != fs.FileType.NotFound:
            store.delete_file(f"{root}/{file}")


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[int, int, int, int]]:
    """Stretches of rows in a sorted batch that belong to one segment file."""
    split, segment = batch.column("split_id"), batch.column("segment")
    n = batch.num_rows
    changed = pc.or_(
        pc.not_equal(split.slice(1), split.slice(0, n - 1)),
        pc.not_equal(segment.slice(1), segment.slice(0, n - 1)),
    )
    cuts = [0, *(i + 1 for i in pc.indices_nonzero(changed).to_pylist()), n]
    for begin, end in zip(cuts, cuts[1:]):
        yield begin, end, split[begin].as_py(), segment[begin].as_py()


def _joined(records: pa.LargeBinaryArray) -> pa.Buffer:
    """The bytes of consecutive records; Arrow already keeps them side by side."""
    _, offsets, data = records.buffers()
    ends = pa.Array.from_buffers(pa.int64(), len(records) + 1, [None, offsets], offset=records.offset)
    first, last = ends[0].as_py(), ends[-1].as_py()
    return data.slice(first, last - first)


def write_dump(records: DataFrame, path: str, name: str = "dump", mode: str = "overwrite") -> None:
    """Write laid-out records; rows of one segment meet in one task, already sorted."""
    spark = records.sparkSession
    spark.dataSource.register(DumpSource)
    (
        records.repartition("split_id", "segment")
        .sortWithinPartitions(*ORDER)
        .write.format(DumpSource.name())
        .mode(mode)
        .option("path", path)
        .option("name", name)
        .save()
    )


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Segments in dump order once sorted by (split_id, segment)."""
    return spark.read.schema(MANIFEST_SCHEMA).json(f"{path.rstrip('/')}/{MANIFEST}")


def read_segments(spark: SparkSession, path: str) -> DataFrame:
    """Manifest rows with the bytes of each segment file."""
    files = spark.read.format("binaryFile").load(path)
    named = files.select(F.element_at(F.split("path", "/"), -1).alias("file"), "content")
    return read_manifest(spark, path).join(named, "file")


def split_digests(spark: SparkSession, path: str) -> DataFrame:
    """(split_id, records, bytes, digest): MD5 of each split's bytes as its files hold them, in manifest order.

    Only names of files are shuffled: the task that holds a split streams its segments, so no split has to fit a row.
    """

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = file_store(path)
        rows = (row for batch in batches for row in batch.to_pylist())
        for split, segments in groupby(rows, key=lambda row: row["split_id"]):
            records, size, digest = 0, 0, hashlib.md5()
            for row in segments:
                records += row["records"]
                with store.open_input_stream(f"{root}/{row['file']}") as segment:
                    while chunk := segment.read(COPY_BYTES):
                        size += len(chunk)
                        digest.update(chunk)
            one = {"split_id": split, "records": records, "bytes": size, "digest": digest.hexdigest()}
            yield pa.RecordBatch.from_pylist([one], _DIGESTS)

    dealt = read_manifest(spark, path).repartition("split_id").sortWithinPartitions("split_id", "segment")
    return dealt.mapInArrow(digests, "split_id int, records long, bytes long, digest string")


def split_files(spark: SparkSession, path: str, name: str = "dump") -> DataFrame:
    """Compose the segments of each split into one file, ``dump`` or ``dump1``, ``dump2``, ...; (split_id, file, bytes).

    On a file system with positions every segment is written to its own range of the file by a task of its own; on other
    stores one task per split streams its segments. Files get their names when all bytes are in place.
    """
    segments = read_manifest(spark, path)
    earlier = W.partitionBy("split_id").orderBy("segment").rowsBetween(W.unboundedPreceding, -1)
    ranged = segments.select(
        "split_id", "segment", "file", "bytes", F.coalesce(F.sum("bytes").over(earlier), F.lit(0)).alias("offset")
    )
    store, root = file_store(path)
    local = isinstance(store, fs.LocalFileSystem)
    attempt = uuid.uuid4().hex[:12]

    def part_of(split: int) -> str:
        return f"_{name}{split or ''}-{attempt}"

    def at_ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                out = os.open(f"{root}/{part_of(row['split_id'])}", os.O_WRONLY | os.O_CREAT, 0o644)
                try:
                    with open(f"{root}/{row['file']}", "rb") as segment:
                        at = row["offset"]
                        while chunk := segment.read(COPY_BYTES):
                            os.pwrite(out, chunk, at)
                            at += len(chunk)
                finally:
                    os.close(out)
            yield batch.select(["split_id", "bytes"])

    def in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = file_store(path)
        split, out = None, None
        for batch in batches:
            for row in batch.to_pylist():
                if row["split_id"] != split:
                    if out is not None:
                        out.close()
                    split = row["split_id"]
                    out = store.open_output_stream(f"{root}/{part_of(split)}")
                with store.open_input_stream(f"{root}/{row['file']}") as segment:
                    while chunk := segment.read(COPY_BYTES):
                        out.write(chunk)
            yield batch.select(["split_id", "bytes"])
        if out is not None:
            out.close()

    if local:
        written = ranged.repartition("split_id", "segment").mapInArrow(at_ranges, "split_id int, bytes long")
    else:
        dealt = ranged.repartition("split_id").sortWithinPartitions("split_id", "segment")
        written = dealt.mapInArrow(in_order, "split_id int, bytes long")
    # One row per split.
    splits = written.groupBy("split_id").agg(F.sum("bytes").alias("bytes")).collect()
    for row in splits:
        store.move(f"{root}/{part_of(row.split_id)}", f"{root}/{name}{row.split_id or ''}")
    rows = [(r.split_id, f"{name}{r.split_id or ''}", r.bytes) for r in splits]
    return spark.createDataFrame(rows, "split_id int, file string, bytes long")
