"""Selecting changes and their files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeflow.functions.paths import is_wanted, map_prefix
from changeflow.options import MAX_ID, MigrationOptions


def in_range(df: DataFrame, low: int = 0, high: int = MAX_ID, id_col: str = "change_id") -> DataFrame:
    """Ids above ``low`` up to and including ``high``."""
    return df.where((F.col(id_col) > low) & (F.col(id_col) <= high))


def late_changes(df: DataFrame, last_seen: int, id_col: str = "change_id") -> DataFrame:
    """How many rows an increment leaves out because their id was already passed."""
    return df.where(F.col(id_col) <= last_seen).agg(F.count("*").alias("late_rows"))


def last_per_key(df: DataFrame, key: str, order: str | None = None) -> DataFrame:
    """One row per key: the one latest by ``order``; ties, or no order, go to the greatest by time, then by all columns."""
    others = [c for c in df.columns if c != key]
    first = [c for c in (order, "submitted_at") if c in others]
    rank = F.struct(*first, *(c for c in others if c not in first))
    newest = F.max_by(F.struct(*others), rank).alias("_row")
    return df.groupBy(key).agg(newest).select(key, "_row.*").select(*df.columns)


def wanted_files(files: DataFrame, options: MigrationOptions) -> DataFrame:
    """Files under a mapped prefix, with their target path."""
    path = F.col("depot_path")
    kept = files.where(is_wanted(path, options.branches))
    return kept.withColumn("svn_path", map_prefix(path, options.branches))


def mark_kept(changes: DataFrame, wanted: DataFrame) -> DataFrame:
    """(change_id, n_files, kept) for every change; a change without wanted files is not kept."""
    # Files are counted before they meet the changes, so a giant change shuffles as one row per task.
    counts = wanted.groupBy("change_id").agg(F.count("*").alias("n_files"))
    n_files = F.coalesce("n_files", F.lit(0)).alias("n_files")
    return (
        changes.select("change_id")
        .join(counts, "change_id", "left")
        .select("change_id", n_files)
        .withColumn("kept", F.col("n_files") > 0)
    )


def empty_changes(changes: DataFrame, wanted: DataFrame) -> DataFrame:
    return mark_kept(changes, wanted).where(~F.col("kept")).select("change_id")


def run_summary(numbered: DataFrame, base: int = 0) -> DataFrame:
    """Totals of a run: changes scanned, the last id and the last revision given."""
    return numbered.agg(
        F.count("*").alias("total_changes"),
        F.max("change_id").alias("last_change_id"),
        F.greatest(F.coalesce(F.max("revision"), F.lit(base)), F.lit(base)).alias("last_revision"),
    )
