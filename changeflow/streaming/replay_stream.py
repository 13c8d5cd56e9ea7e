"""Structured Streaming twins of the batch jobs, by micro-batch.

Statuses are kept as one delta table per micro-batch, so a batch writes only the paths it touched.
Every few batches the deltas are folded into a new base. Rows of the newest change are kept open until a higher id
shows that it is whole. A batch that is run again overwrites its own folders with the same rows.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from changeflow import schema
from changeflow.operators.changes import late_changes
from changeflow.operators.replay import final_status, replay
from changeflow.options import MigrationOptions
from changeflow.plans.pipeline import run_incremental
from changeflow.sources.state import load_state, read_or_empty, write_table
from changeflow.sources.tables import ChangeLog

COMPACT_EVERY = 50


class ReplayState:
    """Statuses, open rows and watermark under one folder, addressed by micro-batch number.

    A flush between two micro-batches writes a step of its own, which later batches read in its place.
    """

    def __init__(self, spark: SparkSession, root: str, compact_every: int = COMPACT_EVERY) -> None:
        self.spark, self.root, self.compact_every = spark, root.rstrip("/"), compact_every

    def _base(self, batch: int) -> int:
        return batch - batch % self.compact_every

    def _steps(self, base: int, stop: int) -> list[str]:
        """Folders of the steps in order: each micro-batch and the flush that may follow it."""
        steps = [s for n in range(base, stop) for s in (f"{n}", f"{n}-flush")]
        return [s for s in steps if not s.endswith("-flush") or self._exists(s)]

    def _exists(self, step: str) -> bool:
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.root}/seen/{step}/_SUCCESS")
        return path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(path)

    def statuses(self, before: int) -> DataFrame:
        """Statuses as they stood when micro-batch ``before`` began."""
        return self._fold(self._base(before), before)

    def _fold(self, base: int, stop: int) -> DataFrame:
        rows = read_or_empty(self.spark, f"{self.root}/base/{base}", schema.PATH_STATUS)
        rows = rows.withColumn("_step", F.lit(-1))
        steps = self._steps(base, stop)
        if base and self._exists(f"{base - 1}-flush"):
            steps = [f"{base - 1}-flush", *steps]  # it came after the base was folded
        for n, step in enumerate(steps):
            delta = self.spark.read.schema(schema.PATH_STATUS).parquet(f"{self.root}/delta/{step}")
            rows = rows.unionByName(delta.withColumn("_step", F.lit(n)))
        return rows.groupBy("path").agg(F.max_by("status", "_step").alias("status"))

    def before(self, batch: int, columns: StructType) -> tuple[int, DataFrame]:
        """The last closed change id, and the rows still held back, when micro-batch ``batch`` began."""
        if batch == 0:
            return 0, self.spark.createDataFrame([], columns)
        flushed = f"{batch - 1}-flush"
        step = flushed if self._exists(flushed) else str(batch - 1)
        closed = self.spark.read.parquet(f"{self.root}/seen/{step}").first().closed
        return closed, self.spark.read.schema(columns).parquet(f"{self.root}/open/{step}")

    def save(self, step: str, touched: DataFrame, held: DataFrame, closed: int, late: int) -> None:
        write_table(touched, f"{self.root}/delta/{step}", schema.PATH_STATUS)
        held.write.mode("overwrite").parquet(f"{self.root}/open/{step}")
        seen = self.spark.createDataFrame([(closed, late)], "closed int, late_rows long")
        seen.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/seen/{step}")

    def compact(self, batch: int) -> None:
        if (batch + 1) % self.compact_every == 0:
            folded = self._fold(self._base(batch), batch + 1)
            write_table(folded, f"{self.root}/base/{batch + 1}", schema.PATH_STATUS)


def _replay_closed(state: ReplayState, batch: int, ready: DataFrame, out: str) -> DataFrame:
    """Write the replayed rows of closed changes; their paths' new statuses."""
    # Only statuses of paths in these rows take part.
    before = state.statuses(batch).join(ready.select("path").distinct(), "path", "left_semi")
    replay(ready, before).write.mode("overwrite").parquet(out)
    return final_status(ready, before)


def replay_stream(
    records: DataFrame, root: str, out: str, checkpoint: str, compact_every: int = COMPACT_EVERY
) -> StreamingQuery:
    """Replay a stream of node records (change_id, part, path, change_action) in id order.

    A change may be spread over micro-batches: the newest one is held back until a higher id arrives, or until
    ``flush_replay``. Rows of closed changes are written with their ``allowed`` flag to ``out/<batch>``. Rows that
    arrive after their change was closed are left out and counted.
    """
    state = ReplayState(records.sparkSession, root, compact_every)
    columns = records.schema

    def on_batch(arrived: DataFrame, batch: int) -> None:
        closed, held = state.before(batch, columns)
        rows = arrived.unionByName(held).persist()
        try:
            late = late_changes(rows, closed).first().late_rows
            fresh = rows.where(F.col("change_id") > closed)
            newest = fresh.agg(F.coalesce(F.max("change_id"), F.lit(closed + 1)).alias("n")).first().n
            ready = fresh.where(F.col("change_id") < newest)
            touched = _replay_closed(state, batch, ready, f"{out}/{batch}")
            state.save(str(batch), touched, fresh.where(F.col("change_id") == newest), newest - 1, late)
            state.compact(batch)
        finally:
            rows.unpersist()

    return (
        records.writeStream.foreachBatch(on_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def flush_replay(
    spark: SparkSession, columns: StructType, root: str, out: str, batch: int, compact_every: int = COMPACT_EVERY
) -> None:
    """Close the change still held back after micro-batch ``batch``; run it while the stream is stopped."""
    state = ReplayState(spark, root, compact_every)
    closed, held = state.before(batch + 1, columns)
    newest = held.agg(F.coalesce(F.max("change_id"), F.lit(closed)).alias("n")).first().n
    touched = _replay_closed(state, batch + 1, held, f"{out}/{batch}-flush")
    state.save(f"{batch}-flush", touched, held.limit(0), newest, 0)


def migrate_stream(
    changelists: DataFrame, log: ChangeLog, options: MigrationOptions, root: str, out: str, checkpoint: str
) -> StreamingQuery:
    """Run one increment per micro-batch of arriving changelists.

    ``log`` gives the file, content and integration tables the increments read. A batch that is run
    again finds its ids already passed and does nothing.
    """
    spark = changelists.sparkSession

    def on_batch(rows: DataFrame, batch: int) -> None:
        high = rows.agg(F.max("change_id").alias("high")).first().high
        if high is None or high <= load_state(spark, root).last_change_id:
            return
        until = replace(options, to_change=min(high, options.to_change))
        run_incremental(log, until, root, f"batch-{batch:09d}", f"{out}/{batch:09d}")

    return (
        changelists.writeStream.foreachBatch(on_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
