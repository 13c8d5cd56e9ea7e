"""Turning file actions into node records, with directories and part numbers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeflow import options as o
from changeflow.functions import filetypes
from changeflow.functions.records import property_map
from changeflow.functions.text import change_log_text, gmt_date
from changeflow.operators.directories import first_dir_uses
from changeflow.operators.skew import running, segment_of
from changeflow.schema import NODE_RECORDS

NODE_COLUMNS = NODE_RECORDS.fieldNames()


def as_nodes(df: DataFrame) -> DataFrame:
    """Fill in the node record columns a frame lacks and put them in order."""
    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in NODE_RECORDS.fields
        ]
    )


def change_action(action: Column, is_copy: Column) -> Column:
    """What a file action does to its target path; NULL for actions that are not known."""
    return (
        F.when(action.isin("ADD", "PURGE"), "Add")
        .when(action == "DELETE", "Delete")
        .when(action == "EDIT", "Edit")
        .when(action == "BRANCH", F.when(is_copy, "Add Copy").otherwise("Add"))
        .when(action == "INTEGRATE", F.when(is_copy, "Replace Copy").otherwise("Edit"))
    )


def node_action(change: Column) -> Column:
    return (
        F.when(change.isin("Add", "Add Copy"), "add")
        .when(change == "Delete", "delete")
        .when(change == "Edit", "change")
        .when(change == "Replace Copy", "replace")
    )


def rejects(files: DataFrame) -> DataFrame:
    """Files whose action is not known, with the whole row kept as context."""
    bad = F.col("action").isNull() | ~F.col("action").isin(*o.ACTIONS)
    context = F.to_json(F.struct(*files.columns)).alias("context")
    return files.where(bad).select(
        "change_id", "file_ord", "action", F.lit("unknown action").alias("reason"), context
    )


def known_actions(files: DataFrame) -> DataFrame:
    return files.where(F.col("action").isin(*o.ACTIONS))


def file_nodes(wanted: DataFrame, copies: DataFrame, options: o.MigrationOptions) -> DataFrame:
    """One record per wanted file. Both inputs are unique per (change_id, file_ord)."""
    rows = known_actions(wanted).join(copies, ["change_id", "file_ord"], "left")
    is_copy = F.col("copy_from_path").isNotNull()
    action, kind = F.col("action"), F.col("file_type")
    rows = rows.withColumn("change_action", change_action(action, is_copy))
    has_text = F.col("change_action").isin("Add", "Edit")
    purged = action == "PURGE"
    linked = filetypes.is_symlink(kind) & ~purged
    form = (
        F.when(purged, "placeholder")
        .when(linked, "symlink")
        .when(filetypes.is_text(kind), "text")
        .otherwise("raw")
    )
    ref = F.struct("depot_path", "rev")
    return rows.select(
        "change_id", "file_ord", F.lit(1).alias("is_file"), F.col("svn_path").alias("path"),
        "change_action", F.lit("file").alias("node_kind"),
        node_action(F.col("change_action")).alias("node_action"),
        "copy_from_path", "copy_from_rev",
        F.when(has_text, property_map(kind, options, linked)).alias("props"),
        F.when(has_text, form).alias("content_form"),
        F.when(has_text & ~purged, ref).alias("content_ref"),
    )


def dir_nodes(wanted: DataFrame) -> DataFrame:
    """Directory adds that precede the first adding file of each change."""
    adding = wanted.where(F.col("action").isin("ADD", "BRANCH", "PURGE"))
    return first_dir_uses(adding).select(
        "change_id", "file_ord", F.lit(0).alias("is_file"), "path",
        F.lit("Add").alias("change_action"), F.lit("dir").alias("node_kind"),
        F.lit("add").alias("node_action"),
    )


def number_parts(nodes: DataFrame) -> DataFrame:
    """Part 1, 2, ... inside each change: directories, parents first, then their file."""
    numbered = running(
        nodes, ["change_id"], ["file_ord", "is_file", "path"], segment_of(F.col("file_ord")),
        F.lit(1), "sum", "part",
    )
    return numbered.withColumn("part", F.col("part").cast("int"))


def change_nodes(wanted: DataFrame, copies: DataFrame, options: o.MigrationOptions) -> DataFrame:
    """All numbered directory and file records of the wanted files."""
    nodes = file_nodes(wanted, copies, options).unionByName(dir_nodes(wanted), allowMissingColumns=True)
    return as_nodes(number_parts(nodes))


def header_nodes(changelists: DataFrame, numbered: DataFrame, options: o.MigrationOptions) -> DataFrame:
    """Part 0 of every kept change: its log text, author, date and revision."""
    rows = changelists.join(numbered.where("kept").select("change_id", "revision"), "change_id")
    log = change_log_text(
        F.col("description"), F.col("change_id"), options.add_change_info, options.change_info
    )
    date = gmt_date(F.col("submitted_at"), options.source_timezone)
    return as_nodes(
        rows.select("change_id", "revision", F.lit(0).alias("part"), header_props(log, F.col("username"), date).alias("props"))
    )


def header_props(log: Column, author: Column, date: Column) -> Column:
    return F.create_map(
        F.lit(o.PROP_LOG), log, F.lit(o.PROP_AUTHOR), author, F.lit(o.PROP_DATE), date
    )


def cleanup_header(change_id: int, revision: int, frame: DataFrame, options: o.MigrationOptions) -> DataFrame:
    """Header of the change that removes empty directories; ``frame`` supplies the session."""
    if options.cleanup_time is None:
        now = F.localtimestamp()
        date = gmt_date(now, frame.sparkSession.conf.get("spark.sql.session.timeZone"))
    else:
        date = gmt_date(F.lit(options.cleanup_time).cast("timestamp_ntz"), options.source_timezone)
    props = header_props(F.lit(o.CLEANUP_LOG), F.lit(options.cleanup_author), date)
    row = frame.sparkSession.range(1).select(
        F.lit(change_id).alias("change_id"), F.lit(0).alias("part"), F.lit(revision).alias("revision"),
        props.alias("props"),
    )
    return as_nodes(row)


def cleanup_nodes(numbered_dirs: DataFrame, change_id: int) -> DataFrame:
    return as_nodes(
        numbered_dirs.select(
            F.lit(change_id).alias("change_id"), "part", "path", F.lit("Delete").alias("change_action"),
            F.lit("dir").alias("node_kind"), F.lit("delete").alias("node_action"),
        )
    )
