"""Replay of a stream of node records in Spark's own keyed state.

Paths are dealt to ``BUCKETS`` keys by a hash. The statuses of a bucket's paths and its rows that are still open live in the
state store (RocksDB), spread over executors by bucket. Change ids serve as event time, one second each, and the watermark
lags one id behind: a change is closed, and its rows replayed in order of part, by a timer that fires once a higher id has
arrived. A bucket has a timer for its first open change, which settles all that are closed by then, path by path, so calls
into Python grow with buckets and micro-batches, and look-ups with the paths that a micro-batch names. Rows of closed changes
that come late are dropped by the watermark. The newest change stays open until a higher id arrives; ``closing_row`` makes one.

Unlike ``replay_stream`` there is no table of statuses, so what a micro-batch costs depends on its own rows alone; the state
ends with the checkpoint folder.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from itertools import groupby

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

# Ship this module's code with the job, so that executors need no installed copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
ROWS = "change_id int, part int, path string, change_action string"
# A path that no record has.
NO_PATH = "\n"
SECOND = 1_000
# Part of a checkpoint: a stream goes on with the number it began with.
BUCKETS = 1 << 12


class ReplayProcessor(StatefulProcessor):
    """One bucket of paths. A call costs exchanges with the state store, so one call settles all changes closed by then."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.status = handle.getMapState("status", "path string", "status int")
        # One entry holds many rows, as every entry is an exchange of its own.
        self.open = handle.getListState("open", "path array<string>, change_id array<int>, part array<int>, change_action array<string>")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        first = None
        for some in rows:
            columns = tuple(some[c].tolist() for c in ("path", "change_id", "part", "change_action"))
            self.open.appendValue(columns)
            first = min(columns[1]) if first is None else min(first, *columns[1])
        if first is not None:
            self.handle.registerTimer(first * SECOND)
        yield pd.DataFrame()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        closed = timerValues.getCurrentWatermarkInMs() // SECOND
        ready, left = [], []
        for entry in self.open.get():
            for row in zip(*entry, strict=True):
                (ready if row[1] <= closed else left).append(row)
        if not ready:
            # An earlier timer of this bucket settled them already.
            yield pd.DataFrame()
            return
        out = []
        for path, own in groupby(sorted(ready, key=lambda r: r[:3]), key=lambda r: r[0]):
            before = self.status.getValue((path,))
            before = status = 0 if before is None else before[0]
            for _, change, part, action in own:
                if action in ("Add", "Add Copy"):
                    out.append((change, part, path, action, status == 0))
                    status = 1
                elif action == "Delete":
                    out.append((change, part, path, action, status == 1))
                    status = 0
                else:
                    out.append((change, part, path, action, status == 1 if action in ("Edit", "Replace Copy") else True))
            if status != before:
                self.status.updateValue((path,), (status,))
        if left:
            self.open.put([tuple(map(list, zip(*left, strict=True)))])
            self.handle.registerTimer(min(r[1] for r in left) * SECOND)
        else:
            self.open.clear()
        yield pd.DataFrame(out, columns=["change_id", "part", "path", "change_action", "allowed"])

    def close(self) -> None:
        pass


def closing_row(spark: SparkSession, change_id: int) -> DataFrame:
    """A row that closes all changes below ``change_id``; it never comes out itself."""
    return spark.createDataFrame([(change_id, 0, NO_PATH, "Edit")], ROWS)


def replayed(records: DataFrame) -> DataFrame:
    """The stream of closed rows with their ``allowed`` flag."""
    rows = records.selectExpr("CAST(change_id AS INT) change_id", "CAST(part AS INT) part", "path", "change_action")
    timed = rows.withColumn("_time", F.timestamp_seconds("change_id")).withWatermark("_time", "1 second")
    timed = timed.withColumn("_bucket", F.pmod(F.xxhash64("path"), F.lit(BUCKETS)).cast("int"))
    return timed.groupBy("_bucket").transformWithStateInPandas(
        statefulProcessor=ReplayProcessor(), outputStructType=f"{ROWS}, allowed boolean", outputMode="Append", timeMode="EventTime"
    )


def keyed_replay(records: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Replay what has arrived and write closed rows below ``out``; the session must use RocksDB as its state store."""
    spark = records.sparkSession
    if spark.conf.get("spark.sql.streaming.stateStore.providerClass") != ROCKSDB:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    return (
        replayed(records)
        .writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
