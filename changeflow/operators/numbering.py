"""Dense numbering and prefix sums over unique ids, without a global window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from changeflow.operators.skew import SEGMENT_BITS, segment_of
from changeflow.options import MigrationOptions
from changeflow.session import pin


def prefix_sum(df: DataFrame, id_col: str, value: Column, out: str) -> DataFrame:
    """Sum of ``value`` over all rows up to and including this one, by a unique whole-number id of any width.

    Ids fall into blocks of 65,536, so no window holds more rows than that. 32-bit ids make at most 65,536 blocks, whose
    totals are few enough for one window and a broadcast. Wider ids may make a block each: the totals of their blocks are
    summed up in the same way by block number, which has 16 bits less, and joined.
    """
    bits = {"tinyint": 8, "smallint": 16, "int": 32}.get(df.schema[id_col].dataType.simpleString(), 64)
    return _prefix_sum(df, id_col, value, out, bits)


def _prefix_sum(df: DataFrame, id_col: str, value: Column, out: str, bits: int) -> DataFrame:
    value_col, block = f"_value{bits}", f"_block{bits}"
    blocks = df.withColumn(value_col, value.cast("long")).withColumn(block, segment_of(F.col(id_col)))
    totals = blocks.groupBy(block).agg(F.sum(value_col).alias("_total"))
    if bits <= 32:
        earlier = W.orderBy(block).rowsBetween(W.unboundedPreceding, -1)
        offsets = totals.select(block, F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_offset"))
        offsets = F.broadcast(offsets)
    else:
        summed = _prefix_sum(totals, block, F.col("_total"), "_upto", bits - SEGMENT_BITS)
        offsets = summed.select(block, (F.col("_upto") - F.col("_total")).alias("_offset"))
    within = W.partitionBy(block).orderBy(id_col).rowsBetween(W.unboundedPreceding, 0)
    return (
        blocks.join(offsets, block)
        .withColumn(out, F.col("_offset") + F.sum(value_col).over(within))
        .select(*df.columns, out)
    )


def serial_numbers(changes: DataFrame, base: int = 0) -> DataFrame:
    """Number kept changes 1, 2, ... after ``base`` in id order; others get 0."""
    kept = F.col("kept")
    numbered = prefix_sum(changes, "change_id", kept.cast("int"), "_rank")
    revision = F.when(kept, F.col("_rank") + base).otherwise(0).cast("int")
    return numbered.withColumn("revision", revision).drop("_rank")


def identity_numbers(changes: DataFrame, base: int = 0) -> DataFrame:
    """Keep the change id as the revision number."""
    return changes.withColumn("revision", F.when(F.col("kept"), F.col("change_id")).otherwise(0))


def number_changes(changes: DataFrame, options: MigrationOptions, base: int | None = None) -> DataFrame:
    """Add ``revision`` to rows of (change_id, kept), by the chosen strategy."""
    base = options.base_revision if base is None else base
    if callable(options.numbering):
        return options.numbering(changes, base)
    strategy = {"serial": serial_numbers, "identity": identity_numbers}[options.numbering]
    return strategy(changes, base)


def revision_map(numbered: DataFrame) -> DataFrame:
    return numbered.select("change_id", "revision")


def number_rows(df: DataFrame, order: list[Column], out: str) -> DataFrame:
    """1, 2, ... over a whole frame in any order, sorted by range and counted per partition."""
    ranged = pin(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_row", F.monotonically_increasing_id())
    )
    # The id packs the partition number above the row number within the partition.
    ranged = ranged.withColumn("_slice", F.shiftright("_row", 33)).withColumn(
        "_row", F.col("_row") - F.shiftleft(F.col("_slice"), 33)
    )
    earlier = W.orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        ranged.groupBy("_slice")
        .agg(F.count("*").alias("_total"))
        .select("_slice", F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_offset"))
    )
    # One offset per sort partition.
    return ranged.join(F.broadcast(offsets), "_slice").select(
        *df.columns, (F.col("_offset") + F.col("_row") + 1).cast("int").alias(out)
    )
