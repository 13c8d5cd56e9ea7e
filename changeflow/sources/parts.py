"""Part files of a dump directory tree, ``<change>/<part>``: listed, read and written by tasks.

The driver lists the first level only, one name per change.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changeflow.sinks.dump import file_store

# Ship this module's code with the job, so that executors need no installed copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

FOLDERS_PER_TASK = 1_000
READ_BYTES = 16 << 20


def discover_parts(spark: SparkSession, root: str) -> DataFrame:
    """(change_id, part, path, length) of part files: those whose folder and own name are whole numbers."""
    root = root.rstrip("/")
    store, base = file_store(root)
    names = [i.base_name for i in store.get_file_info(fs.FileSelector(base)) if i.type == fs.FileType.Directory]
    folders = spark.createDataFrame([(n,) for n in names], "folder string")
    folders = folders.withColumn("change_id", F.col("folder").try_cast("int")).where("change_id is not null")

    def list_folders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = file_store(root)
        for batch in batches:
            rows = []
            for folder, change in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for i in store.get_file_info(fs.FileSelector(f"{base}/{folder}")):
                    if i.type == fs.FileType.File:
                        rows.append((change, i.base_name, f"{root}/{folder}/{i.base_name}", i.size))
            columns = list(zip(*rows, strict=True)) or [[]] * 4
            kinds = [pa.int32(), pa.string(), pa.string(), pa.int64()]
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, ["change_id", "name", "path", "length"])

    dealt = folders.repartition(max(1, -(-len(names) // FOLDERS_PER_TASK)))
    found = dealt.mapInArrow(list_folders, "change_id int, name string, path string, length long")
    part = F.col("name").try_cast("int").alias("part")
    return found.select("change_id", part, "path", "length").where("part is not null")


def read_parts(placed: DataFrame, file: str = "file") -> DataFrame:
    """Rows with ``record``, the bytes of the file that each row names; every file has to fit a row."""
    kept = [f for f in placed.schema.fields if f.name != file]
    names = [f.name for f in kept]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store = None
        for batch in batches:
            start, size, records = 0, 0, []
            for row, path in enumerate(batch.column(file).to_pylist()):
                store = store or file_store(path)[0]
                with store.open_input_stream(file_store(path)[1]) as stream:
                    records.append(stream.read())
                size += len(records[-1])
                if size > READ_BYTES or row + 1 == batch.num_rows:
                    own = batch.select(names).slice(start, row + 1 - start)
                    yield pa.RecordBatch.from_arrays([*own.columns, pa.array(records, pa.binary())], [*names, "record"])
                    start, size, records = row + 1, 0, []

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), "record binary"])
    return placed.mapInArrow(read, schema)


def export_parts(records: DataFrame, root: str) -> DataFrame:
    """Write (change_id, part, record) as part files; the files written. A repeated task writes the same bytes again."""
    root = root.rstrip("/")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = file_store(root)
        made = None
        for batch in batches:
            rows = []
            for change, part, record in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if change != made:
                    store.create_dir(f"{base}/{change}", recursive=True)
                    made = change
                with store.open_output_stream(f"{base}/{change}/{part}") as out:
                    out.write(record or b"")
                rows.append((f"{root}/{change}/{part}", len(record or b"")))
            columns = list(zip(*rows, strict=True)) or [[]] * 2
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.string()), pa.array(columns[1], pa.int64())], ["path", "length"]
            )

    narrow = records.select(F.col("change_id").cast("int"), F.col("part").cast("int"), F.col("record").cast("binary"))
    return narrow.mapInArrow(write, "path string, length long")
