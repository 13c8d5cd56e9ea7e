"""Changes in nested form, one line of JSON per change, in files of consecutive ids: a data source with partitions by id.

A file name holds the ids it covers, ``changes-<first>-<last>.jsonl``. Filters on ``change_id`` are taken by the reader:
they choose files, and rows within files. As a stream, the source offers the ids that have arrived, in order; files
must arrive in order of their ids.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs, json
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    DataSourceStreamReader,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    InputPartition,
    LessThan,
    LessThanOrEqual,
)

from changeflow.options import MAX_ID
from changeflow.sinks.dump import file_store

# Ship this module's code with the job, so that executors need no installed copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

FILE = re.compile(r"changes-(\d+)-(\d+)\.jsonl")
SCHEMA = (
    "change_id int, username string, submitted_at timestamp_ntz, description string, "
    "files array<struct<file_ord: int, depot_path: string, rev: int, action: string, file_type: string>>"
)
FILE_COLUMNS = ["file_ord", "depot_path", "rev", "action", "file_type"]
ARROW = pa.schema(
    [
        ("change_id", pa.int32()),
        ("username", pa.string()),
        ("submitted_at", pa.timestamp("us")),
        ("description", pa.string()),
        (
            "files",
            pa.list_(
                pa.struct(
                    [("file_ord", pa.int32()), ("depot_path", pa.string()), ("rev", pa.int32()), ("action", pa.string()), ("file_type", pa.string())]
                )
            ),
        ),
    ]
)


@dataclass
class IdRange(InputPartition):
    """A file, and the ids (both included) wanted of it."""

    file: str
    low: int
    high: int


def files_in(path: str, low: int, high: int) -> list[IdRange]:
    """Files that cover ids of a range, in order; one entry per file reaches the driver."""
    store, root = file_store(path)
    found = []
    for info in store.get_file_info(fs.FileSelector(root, allow_not_found=True)):
        name = FILE.fullmatch(info.base_name)
        if name and int(name[1]) <= high and int(name[2]) >= low:
            found.append((int(name[1]), IdRange(info.path, low, high)))
    return [part for _, part in sorted(found, key=lambda f: f[0])]


def read_range(path: str, part: IdRange) -> Iterator[pa.RecordBatch]:
    store, _ = file_store(path)
    with store.open_input_stream(part.file) as stream:
        rows = json.read_json(
            stream,
            read_options=json.ReadOptions(block_size=64 << 20),
            parse_options=json.ParseOptions(explicit_schema=ARROW, unexpected_field_behavior="ignore"),
        )
    rows = rows.select(ARROW.names).cast(ARROW)
    ids = rows.column("change_id")
    rows = rows.filter(pc.and_(pc.greater_equal(ids, part.low), pc.less_equal(ids, part.high)))
    yield from rows.to_batches()


class ChangeReader(DataSourceReader):
    def __init__(self, path: str) -> None:
        self.path, self.low, self.high = path, 0, MAX_ID

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        """Take comparisons of ``change_id`` with a number; Spark applies the others."""
        for f in filters:
            value = getattr(f, "value", None)
            if getattr(f, "attribute", None) != ("change_id",) or not isinstance(value, int):
                yield f
            elif isinstance(f, EqualTo):
                self.low, self.high = max(self.low, value), min(self.high, value)
            elif isinstance(f, GreaterThan):
                self.low = max(self.low, value + 1)
            elif isinstance(f, GreaterThanOrEqual):
                self.low = max(self.low, value)
            elif isinstance(f, LessThan):
                self.high = min(self.high, value - 1)
            elif isinstance(f, LessThanOrEqual):
                self.high = min(self.high, value)
            else:
                yield f

    def partitions(self) -> list[IdRange]:
        return files_in(self.path, self.low, self.high)

    def read(self, partition: IdRange | None) -> Iterator[pa.RecordBatch]:
        # With no file in range Spark still asks once.
        if partition is not None:
            yield from read_range(self.path, partition)


class ChangeStreamReader(DataSourceStreamReader):
    """Offsets are the last id that was read."""

    def __init__(self, path: str) -> None:
        self.path = path

    def initialOffset(self) -> dict:
        return {"last": 0}

    def latestOffset(self) -> dict:
        store, root = file_store(self.path)
        found = store.get_file_info(fs.FileSelector(root, allow_not_found=True))
        return {"last": max((int(m[2]) for m in map(FILE.fullmatch, (i.base_name for i in found)) if m), default=0)}

    def partitions(self, start: dict, end: dict) -> list[IdRange]:
        return files_in(self.path, start["last"] + 1, end["last"])

    def read(self, partition: IdRange) -> Iterator[pa.RecordBatch]:
        yield from read_range(self.path, partition)

    def commit(self, end: dict) -> None:
        pass


class ChangeSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "changeflow_changes"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> ChangeReader:
        return ChangeReader(self.options["path"])

    def streamReader(self, schema) -> ChangeStreamReader:
        return ChangeStreamReader(self.options["path"])


def _registered(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(ChangeSource)


def read_changes(spark: SparkSession, path: str) -> DataFrame:
    """Changes with their ``files``; ``files_of`` gives one row per file."""
    _registered(spark)
    return spark.read.format(ChangeSource.name()).option("path", path).load()


def stream_changes(spark: SparkSession, path: str) -> DataFrame:
    _registered(spark)
    return spark.readStream.format(ChangeSource.name()).option("path", path).load()


def files_of(changes: DataFrame) -> DataFrame:
    return changes.select("change_id", F.explode("files").alias("_file")).select("change_id", "_file.*")


def export_changes(changelists: DataFrame, files: DataFrame, path: str, ids_per_file: int = 65_536) -> DataFrame:
    """Write changes with their files, nested; a change and its files have to fit a row. (file, changes) written."""
    nested = files.groupBy("change_id").agg(F.sort_array(F.collect_list(F.struct(*FILE_COLUMNS))).alias("files"))
    rows = changelists.select("change_id", "username", "submitted_at", "description").join(nested, "change_id", "left")
    number = F.expr(f"(change_id - 1) div {int(ids_per_file)}").alias("_file")
    lines = rows.select(number, "change_id", F.to_json(F.struct(*rows.columns), {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}).alias("line"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = file_store(path)
        store.create_dir(root, recursive=True)
        file, out, names, counts = None, None, [], []
        for batch in batches:
            for number, _, line in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if number != file:
                    if out is not None:
                        out.close()
                    file, first = number, number * ids_per_file + 1
                    names.append(f"changes-{first:012d}-{first + ids_per_file - 1:012d}.jsonl")
                    counts.append(0)
                    out = store.open_output_stream(f"{root}/{names[-1]}")
                out.write(line.encode() + b"\n")
                counts[-1] += 1
        if out is not None:
            out.close()
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(counts, pa.int64())], ["file", "changes"])

    dealt = lines.repartition("_file").sortWithinPartitions("_file", "change_id")
    return dealt.mapInArrow(write, "file string, changes long")
