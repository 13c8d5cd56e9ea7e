"""Replaying records in order through the live/dead state of each path."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeflow.operators.skew import running, segment_of

ADDS = ("Add", "Add Copy")
CHANGES = ("Edit", "Replace Copy")
PART_BITS = 31


def log_position(change_id: Column, part: Column) -> Column:
    """One long per record whose order is (change_id, part)."""
    return F.shiftleft(change_id.cast("long"), PART_BITS) + part


def change_of(position: Column) -> Column:
    return F.shiftright(position, PART_BITS)


def effect(action: Column) -> Column:
    """Status a record leaves its path in: 1 live, 0 dead, NULL unchanged.

    An add leaves the path live and a delete leaves it dead whether or not it was allowed.
    """
    return F.when(action.isin(*ADDS), 1).when(action == "Delete", 0)


def is_allowed(action: Column, status: Column) -> Column:
    return (
        F.when(action.isin(*ADDS), status == 0)
        .when((action == "Delete") | action.isin(*CHANGES), status == 1)
        .otherwise(True)
    )


def replay(records: DataFrame, previous: DataFrame | None = None) -> DataFrame:
    """Add ``allowed`` to records that have a path, given the statuses of an earlier run.

    An earlier status is one more row at the very start of its path's log.
    """
    columns = records.columns
    rows = records.select(
        *columns,
        log_position(F.col("change_id"), F.col("part")).alias("_pos"),
        effect(F.col("change_action")).alias("_effect"),
    )
    if previous is not None:
        before = previous.select("path", F.lit(-1).cast("long").alias("_pos"), F.col("status").alias("_effect"))
        rows = rows.unionByName(before, allowMissingColumns=True)
    segment = segment_of(change_of(F.col("_pos")))
    seen = running(rows, ["path"], ["_pos"], segment, F.col("_effect"), "last", "_status")
    if previous is not None:
        seen = seen.where("_pos >= 0")
    status = F.coalesce("_status", F.lit(0))
    return seen.select(*columns, is_allowed(F.col("change_action"), status).alias("allowed"))


def final_status(records: DataFrame, previous: DataFrame | None = None) -> DataFrame:
    """Status of every path touched now or before."""
    pos = log_position(F.col("change_id"), F.col("part"))
    rows = records.where("path is not null").select("path", pos.alias("_pos"), effect(F.col("change_action")).alias("_e"))
    if previous is not None:
        rows = rows.unionByName(previous.select("path", F.lit(-1).cast("long").alias("_pos"), F.col("status").alias("_e")))
    last = F.max_by("_e", F.when(F.col("_e").isNotNull(), F.col("_pos")))
    return rows.groupBy("path").agg(F.coalesce(last, F.lit(0)).cast("int").alias("status"))


def replay_dirs(dirs: DataFrame, previous: DataFrame | None = None) -> DataFrame:
    """The directory records that survive, without a window.

    Within a run a directory is only added, and at most once deleted, after everything else. So its
    first add counts if it was not live before, and its delete counts if it is live by then. A hot
    directory folds to one row per task before the shuffle.
    """
    pos = log_position(F.col("change_id"), F.col("part"))
    added = F.col("change_action").isin(*ADDS)
    rows = dirs.select(
        "path", F.when(added, pos).alias("_add"), F.when(~added, pos).alias("_del"), F.lit(0).alias("_was")
    )
    if previous is not None:
        none = F.lit(None).cast("long")
        before = previous.where(F.col("path").endswith("/")).select(
            "path", none.alias("_add"), none.alias("_del"), F.col("status").alias("_was")
        )
        rows = rows.unionByName(before)
    folded = rows.groupBy("path").agg(
        F.min("_add").alias("_add"), F.min("_del").alias("_del"), F.max("_was").alias("_was")
    )
    has_add, has_del, was_live = F.col("_add").isNotNull(), F.col("_del").isNotNull(), F.col("_was") == 1
    record = lambda pos, name: F.struct(F.col(pos).alias("pos"), F.lit(name).alias("change_action"))
    adds = F.when(~was_live & has_add, record("_add", "Add"))
    deletes = F.when((was_live | has_add) & has_del, record("_del", "Delete"))
    kept = folded.select("path", F.explode(F.array_compact(F.array(adds, deletes))).alias("_k"))
    return kept.select(
        change_of(F.col("_k.pos")).cast("int").alias("change_id"),
        F.col("_k.pos").bitwiseAND(2**PART_BITS - 1).cast("int").alias("part"),
        "path",
        F.col("_k.change_action").alias("change_action"),
    )


def keep_allowed(records: DataFrame, previous: DataFrame | None = None) -> DataFrame:
    """All records that survive replay, headers included."""
    from changeflow.operators.nodes import as_nodes

    headers = records.where(F.col("path").isNull())
    is_dir = F.col("node_kind") == "dir"
    # Directory names end in "/" and file names do not, so the two kinds never share a path.
    files = records.where(F.col("path").isNotNull() & ~is_dir)
    prior_files = None if previous is None else previous.where(~F.col("path").endswith("/"))
    kept_files = replay(files, prior_files).where("allowed").drop("allowed")
    verb = F.when(F.col("change_action") == "Add", "add").otherwise("delete")
    kept_dirs = replay_dirs(records.where(is_dir), previous).withColumns(
        {"node_kind": F.lit("dir"), "node_action": verb}
    )
    return headers.unionByName(kept_files).unionByName(as_nodes(kept_dirs))
