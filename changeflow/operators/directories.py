"""Directory trees: usage counts, first uses and empty directories."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeflow.functions.paths import ancestors_of
from changeflow.operators.numbering import number_rows


def rollup_by_path(df: DataFrame, path: str, measures: dict[str, Column]) -> DataFrame:
    """Sum measures into every ancestor directory of each row's path."""
    rows = df.select(
        F.explode(ancestors_of(F.col(path))).alias("path"),
        *[expr.alias(name) for name, expr in measures.items()],
    )
    return rows.groupBy("path").agg(*[F.sum(name).alias(name) for name in measures])


def usage_delta(action: Column) -> Column:
    """+1 for actions that add a file, -1 for a delete, nothing for edits."""
    return F.when(action.isin("ADD", "BRANCH", "PURGE"), 1).when(action == "DELETE", -1)


def dir_usage(files: DataFrame, path: str = "svn_path") -> DataFrame:
    """Net number of adds under each directory, root included."""
    # Climbing the tree before the shuffle lets each task fold its rows into one per directory.
    moves = files.withColumn("delta", usage_delta(F.col("action"))).where("delta is not null")
    return rollup_by_path(moves, path, {"usage": F.col("delta").cast("long")})


def kept_usage(kept: DataFrame) -> DataFrame:
    """Usage counted over records that survived replay."""
    delta = F.when(F.col("change_action").isin("Add", "Add Copy"), 1).when(
        F.col("change_action") == "Delete", -1
    )
    moves = kept.where(F.col("node_kind") == "file").withColumn("delta", delta)
    return rollup_by_path(
        moves.where("delta is not null"), "path", {"usage": F.col("delta").cast("long")}
    )


def merge_usage(*frames: DataFrame) -> DataFrame:
    """Add up usage tables of several runs."""
    merged = frames[0].select("path", "usage")
    for frame in frames[1:]:
        merged = merged.unionByName(frame.select("path", "usage"))
    return merged.groupBy("path").agg(F.sum("usage").alias("usage"))


def first_dir_uses(adding_files: DataFrame, path: str = "svn_path") -> DataFrame:
    """Each directory once per change, at the first file that needs it; the root is left out."""
    return (
        adding_files.select("change_id", "file_ord", F.explode(ancestors_of(F.col(path))).alias("path"))
        .where(F.col("path") != "/")
        .groupBy("change_id", "path")
        .agg(F.min("file_ord").alias("file_ord"))
    )


def empty_dirs(usage: DataFrame) -> DataFrame:
    return usage.where(F.col("usage") == 0).select("path")


def zero_crossings(usage: DataFrame, before: DataFrame | None = None) -> DataFrame:
    """(path, empty) of the directories among ``usage`` that are empty now and were not, or the other way round."""
    now = usage.select("path", (F.col("usage") == 0).alias("_now"))
    if before is None:
        return now.where("_now").select("path", F.lit(1).alias("empty"))
    was = before.select("path", (F.col("usage") == 0).alias("_was"))
    met = now.join(was, "path", "left").where(F.col("_now") != F.coalesce("_was", F.lit(False)))
    return met.select("path", F.col("_now").cast("int").alias("empty"))


def number_empty_dirs(usage: DataFrame) -> DataFrame:
    """Empty directories numbered children first."""
    return number_rows(empty_dirs(usage), [F.col("path").desc()], "part")
