"""Old line-based state files: key and value on alternate lines, or one item per line."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from changeflow.operators.publish import LAYOUT, place
from changeflow.operators.replay import replay
from changeflow.options import MigrationOptions
from changeflow.sources.parts import discover_parts, read_parts


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line_no, value) of text files, numbered without reading a file in one task."""
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_row"),
        "value",
    )
    # A block is one file split, read from start to end by one task.
    earlier = W.partitionBy("file").orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    blocks = (
        lines.groupBy("file", "_block")
        .agg(F.count("*").alias("_lines"))
        .select("file", "_block", F.coalesce(F.sum("_lines").over(earlier), F.lit(0)).alias("_before"))
    )
    within = W.partitionBy("file", "_block").orderBy("_row")
    return lines.join(blocks, ["file", "_block"]).select(
        "file", (F.col("_before") + F.row_number().over(within)).alias("line_no"), "value"
    )


def read_pairs(spark: SparkSession, path: str) -> DataFrame:
    """Key/value pairs of a map file. An odd last line is dropped and later keys win."""
    line = read_lines(spark, path).withColumn("_pair", F.shiftright(F.col("line_no") - 1, 1))
    odd = F.col("line_no") % 2 == 1
    pairs = (
        line.groupBy("file", "_pair")
        .agg(
            F.max(F.when(odd, F.col("value"))).alias("key"),
            F.max(F.when(~odd, F.col("value"))).alias("value"),
            F.count("*").alias("_n"),
        )
        .where("_n = 2")
    )
    return pairs.groupBy("key").agg(F.max_by("value", F.struct("file", "_pair")).alias("value"))


def read_list(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select(F.col("value").try_cast("int").alias("change_id"))


def split_path_action(pairs: DataFrame, semantics: str = "faithful") -> DataFrame:
    """Cut ``path:action`` values. Faithful stops at the first two colons; corrected uses the last."""
    if semantics == "corrected":
        pattern = r"(?s)^(.*):([^:]*)$"
        path, action = (F.regexp_extract("value", pattern, i) for i in (1, 2))
    else:
        fields = F.split("value", ":", -1)
        path, action = F.get(fields, 0), F.get(fields, 1)
    return pairs.select("key", path.alias("path"), action.alias("change_action"))


def import_legacy_state(spark: SparkSession, root: str, semantics: str = "faithful") -> dict[str, DataFrame]:
    """State tables out of an old dump directory."""
    root = root.rstrip("/")
    pairs = lambda name: read_pairs(spark, f"{root}/{name}")
    whole = F.col("value").try_cast("int")
    part = F.split("key", "/")
    records = split_path_action(pairs("files"), semantics).select(
        F.element_at(part, -2).try_cast("int").alias("change_id"),
        F.element_at(part, -1).try_cast("int").alias("part"),
        "path", "change_action",
    )
    return {
        "node_records": records,
        "dir_usage": pairs("dirsUsage").select(F.col("key").alias("path"), whole.cast("long").alias("usage")),
        "revision_map": pairs("revisionByChangeListId").select(
            F.col("key").try_cast("int").alias("change_id"), whole.alias("revision")
        ),
        "changes": read_list(spark, f"{root}/changeLists"),
        "path_status": pairs("fileStatuses").select(F.col("key").alias("path"), whole.alias("status")),
    }


def recorded_parts(spark: SparkSession, root: str, semantics: str = "faithful") -> DataFrame:
    """Part files of an old dump directory with the path and action recorded for them, if any."""
    parts = discover_parts(spark, root).select("change_id", "part", F.col("path").alias("file"), F.col("length").alias("weight"))
    records = import_legacy_state(spark, root, semantics)["node_records"]
    return parts.join(records, ["change_id", "part"], "left")


def assemble_parts(
    spark: SparkSession,
    root: str,
    options: MigrationOptions,
    previous: DataFrame | None = None,
) -> DataFrame:
    """Replay an old dump directory: its legal parts, and those without a record, ready for the sink."""
    parts = recorded_parts(spark, root, options.semantics)
    known = F.col("path").isNotNull()
    kept = replay(parts.where(known), previous).where("allowed").drop("allowed")
    kept = kept.unionByName(parts.where(~known)).select("change_id", "part", "file", "weight")
    placed, headers = place(kept, options)
    return read_parts(placed).select(LAYOUT).unionByName(headers)


@dataclass(frozen=True)
class Codec:
    """How a value is written to a line and read from one; what cannot be read is null."""

    encode: Callable[[Column], Column]
    decode: Callable[[Column], Column]


TEXT = Codec(lambda c: c.cast("string"), lambda c: c)
INT = Codec(lambda c: c.cast("string"), lambda c: c.try_cast("int"))
LONG = Codec(lambda c: c.cast("string"), lambda c: c.try_cast("long"))


def write_map(df: DataFrame, path: str, key: Codec = TEXT, value: Codec = TEXT) -> None:
    """Write (key, value) rows as a map file."""
    export_pairs(df.select(key.encode(F.col("key")).alias("key"), value.encode(F.col("value")).alias("value")), "key", "value", path)


def read_map(spark: SparkSession, path: str, key: Codec = TEXT, value: Codec = TEXT) -> DataFrame:
    """(key, value) of a map file, decoded."""
    pairs = read_pairs(spark, path)
    return pairs.select(key.decode(F.col("key")).alias("key"), value.decode(F.col("value")).alias("value"))


def with_default(keys: DataFrame, stored: DataFrame, default: Callable[[Column], Column]) -> DataFrame:
    """(key, value) of all keys asked for: the stored value, or what ``default`` makes of the key."""
    known = stored.select("key", F.col("value"), F.lit(True).alias("_known"))
    met = keys.select("key").join(known, "key", "left")
    return met.select("key", F.when(F.col("_known"), F.col("value")).otherwise(default(F.col("key"))).alias("value"))


def export_pairs(df: DataFrame, key: str, value: str, path: str) -> None:
    """Write a map file: each key and, on the next line, its value."""
    pair = F.array(F.col(key).cast("string"), F.col(value).cast("string"))
    df.select(F.explode(pair).alias("value")).write.mode("overwrite").text(path)


def export_list(df: DataFrame, column: str, path: str) -> None:
    df.select(F.col(column).cast("string").alias("value")).write.mode("overwrite").text(path)
