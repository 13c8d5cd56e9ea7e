"""Reading the four input tables of a change log."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from changeflow import schema
from changeflow.functions.paths import is_wanted
from changeflow.operators.changes import in_range, last_per_key
from changeflow.options import MigrationOptions


@dataclass(frozen=True)
class SharedContents:
    """Contents of which many revisions may share one, so that each is stored, hashed and shuffled once.

    ``refs`` names the content of each revision: (depot_path, rev, missing, blob_id), with ``change_id`` and ``prefix`` (bytes
    that stand before the blob's) if there are any. ``blobs`` holds (blob_id, content), one row per id.
    """

    refs: DataFrame
    blobs: DataFrame

    sparkSession = property(lambda self: self.refs.sparkSession)
    columns = property(lambda self: self.refs.columns)

    def where(self, condition: Column | str) -> SharedContents:
        return replace(self, refs=self.refs.where(condition))

    def fill(self, rows: DataFrame, how: str = "inner") -> DataFrame:
        """Rows with columns of ``refs``, with ``content`` in place of ``blob_id`` and ``prefix``."""
        # Both sides grow with the data, so they meet by shuffle and the bytes spread over all tasks.
        filled = rows.join(self.blobs.hint("merge"), "blob_id", how)
        whole = F.concat(F.coalesce("prefix", F.lit(b"")), "content") if "prefix" in rows.columns else F.col("content")
        return filled.withColumn("content", F.when(~F.col("missing"), whole)).drop("blob_id", "prefix")

    def table(self) -> DataFrame:
        """The same with the bytes of every revision, as in ``schema.CONTENTS``."""
        filled = self.fill(self.refs)
        return filled.select("depot_path", "rev", "content", "missing", *(c for c in filled.columns if c == "change_id"))


@dataclass(frozen=True)
class ChangeLog:
    changelists: DataFrame
    file_revisions: DataFrame
    contents: DataFrame | SharedContents
    integrations: DataFrame


def read_table(spark: SparkSession, source: str | DataFrame, table_schema=None, format: str = "parquet", **options) -> DataFrame:
    """A path in any Spark format (jdbc takes its settings as ``options``), or a frame as it is."""
    if isinstance(source, DataFrame):
        return source
    reader = spark.read.format(format).options(**options)
    if table_schema is not None and format != "jdbc":
        reader = reader.schema(table_schema)
    return reader.load(source) if source else reader.load()


def read_change_log(
    spark: SparkSession, root: str, format: str = "parquet", contents_by_change: bool = False, **options
) -> ChangeLog:
    """The four tables under ``root``; with jdbc, ``root`` is the schema they are in and ``options`` the connection.

    With ``contents_by_change`` the contents carry the change that made them, so increments read only their range.
    """
    contents = schema.CONTENTS_BY_CHANGE if contents_by_change else schema.CONTENTS

    def read(name: str, table_schema) -> DataFrame:
        if format == "jdbc":
            return read_table(spark, "", None, format, **{**options, "dbtable": f"{root}.{name}" if root else name})
        return read_table(spark, f"{root.rstrip('/')}/{name}", table_schema, format, **options)

    return ChangeLog(
        read("changelists", schema.CHANGELISTS),
        read("file_revisions", schema.FILE_REVISIONS),
        read("contents", contents),
        read("integrations", schema.INTEGRATIONS),
    )


def read_changelists(changelists: DataFrame, options: MigrationOptions, order: str | None = None) -> DataFrame:
    """Changes of the wanted id range, one row each: the last by ``order``, else by time and the other columns."""
    rows = in_range(changelists, options.from_change, options.to_change)
    return last_per_key(rows, "change_id", order)


def changes_touching(changelists: DataFrame, files: DataFrame, options: MigrationOptions) -> DataFrame:
    """Changes with a file under any configured prefix; several hits still give one row."""
    hit = files.where(is_wanted(F.col("depot_path"), options.branches)).select("change_id").distinct()
    return read_changelists(changelists, options).join(hit, "change_id", "left_semi")


def explode_files(changes: DataFrame) -> DataFrame:
    """Nested form: changes that carry an ordered ``files`` array, to one row per file."""
    return changes.select("change_id", F.posexplode("files").alias("_pos", "_file")).select(
        "change_id", (F.col("_pos") + 1).alias("file_ord"), "_file.*"
    )


def explode_integrations(revisions: DataFrame) -> DataFrame:
    """Nested form: revisions that carry an ordered ``integrations`` array."""
    return revisions.select(
        F.col("depot_path").alias("to_path"), F.col("rev").alias("to_rev"),
        F.posexplode("integrations").alias("_pos", "_i"),
    ).select("to_path", "to_rev", (F.col("_pos") + 1).alias("seq"), "_i.*")


def change_details(changelists: DataFrame, files: DataFrame) -> DataFrame:
    """Changes with their files; Spark splits the join's partition that holds a giant change."""
    return files.join(changelists, ["change_id"])
