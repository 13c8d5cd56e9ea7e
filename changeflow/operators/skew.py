"""Running values per key that stay balanced when a few keys hold most of the rows.

Every key's ordered rows are cut into segments of 65,536 positions, and each segment starts from a carried value. There
is one path for all keys, so nothing has to be guessed about which of them are large.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

SEGMENT_BITS = 16


def segment_of(position: Column) -> Column:
    """Number of the stretch of 65,536 consecutive positions that holds ``position``."""
    return F.shiftright(position.cast("long"), SEGMENT_BITS)


def running(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], segment: Column, value: Column, how: str, out: str
) -> DataFrame:
    """Add a running value per key: ``sum`` up to each row, or the ``last`` non-null before it.

    ``segment`` must not decrease along ``order``. The state a segment starts from joins the window as one extra row,
    removed again at the end: at most one more row per segment, and no window longer than a segment.
    """
    if how not in ("sum", "last"):
        raise ValueError("how must be 'sum' or 'last'")
    columns = df.columns
    rows = df.withColumn("_seg", segment).withColumn("_value", value)
    position = F.struct(*order)
    if how == "sum":
        total = F.sum("_value")
        before = F.sum("_total")
        current = F.sum("_value")
    else:
        total = F.max_by("_value", F.when(F.col("_value").isNotNull(), position))
        before = F.last("_total", ignorenulls=True)
        current = F.last("_value", ignorenulls=True)

    by_segment = W.partitionBy(*keys).orderBy("_seg").rowsBetween(W.unboundedPreceding, -1)
    carried = (
        rows.groupBy(*keys, "_seg")
        .agg(total.alias("_total"))
        .select(*keys, "_seg", before.over(by_segment).alias("_value"), F.lit(0).alias("_own"))
        .where(F.col("_value").isNotNull())
    )
    both = rows.withColumn("_own", F.lit(1)).unionByName(carried, allowMissingColumns=True)
    frame = W.partitionBy(*keys, "_seg").orderBy("_own", *order)
    frame = frame.rowsBetween(W.unboundedPreceding, 0 if how == "sum" else -1)
    return both.withColumn(out, current.over(frame)).where(F.col("_own") == 1).select(*columns, out)
