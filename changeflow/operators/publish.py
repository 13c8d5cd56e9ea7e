"""Content, record bytes and the layout of the ordered dump."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from changeflow import options as o
from changeflow.functions.records import record_bytes
from changeflow.functions.text import munge_keywords, to_bytes
from changeflow.operators.lineage import attach_content
from changeflow.operators.numbering import prefix_sum
from changeflow.operators.skew import segment_of
from changeflow.sources.tables import SharedContents

LAYOUT = ["split_id", "segment", "change_id", "part", "record"]


def divide(value: Column, by: int) -> Column:
    """Whole-number division, exact for any long."""
    return F.call_function("div", value, F.lit(by))


def with_content(nodes: DataFrame, contents: DataFrame | SharedContents, options: o.MigrationOptions) -> DataFrame:
    """Attach ``content`` to the records that need it. Give this only records that will be kept."""
    charset = options.charset
    form = F.col("content_form")
    # Said of placeholders too, so that a plan for placeholders alone reads no contents.
    stored = F.col("content_ref").isNotNull() & ~form.eqNullSafe("placeholder")
    keyed = nodes.where(stored).select("*", "content_ref.depot_path", "content_ref.rev")
    found = attach_content(keyed, contents, charset)
    raw = F.col("content")
    shaped = F.when(form == "symlink", F.concat(to_bytes(F.lit(o.SYMLINK_PREFIX), charset), raw))
    if options.munge_keywords:
        shaped = shaped.when(form == "text", munge_keywords(raw, charset))
    found = found.withColumn("content", shaped.otherwise(raw)).drop("depot_path", "rev")
    fixed = F.when(form == "placeholder", to_bytes(F.lit(o.PURGED_TEXT), charset))
    return nodes.where(~stored).withColumn("content", fixed).unionByName(found)


def serialise(
    nodes: DataFrame, contents: DataFrame | SharedContents, options: o.MigrationOptions, carry: tuple[str, ...] = ()
) -> DataFrame:
    """(carried columns, change_id, part, record): the final bytes of each record."""
    rows = with_content(nodes, contents, options)
    record = record_bytes(F.col("content"), options.charset, options.property_order)
    return rows.select(*carry, "change_id", "part", record.alias("record"))


def assign_splits(changes: DataFrame, split_by: int) -> DataFrame:
    """(change_id, split_id) for emitted changes: every ``split_by`` of them start a new file."""
    if not split_by:
        return changes.select("change_id", F.lit(0).alias("split_id"))
    ranked = prefix_sum(changes.select("change_id"), "change_id", F.lit(1), "_rank")
    split = (divide(F.col("_rank") - 1, split_by) + 1).cast("int")
    return ranked.select("change_id", split.alias("split_id"))


def record_weight(records: DataFrame, sizes: DataFrame, options: o.MigrationOptions) -> DataFrame:
    """Add ``weight``: about the bytes of each record, from the lengths of contents (depot_path, rev, n_bytes).

    Only the length of munged text is a guess, as keywords grow or shrink; no content is read.
    """
    bare = F.octet_length(record_bytes(F.when(F.col("content_form").isNotNull(), F.lit(b"")), options.charset))
    keyed = records.withColumns({"depot_path": F.col("content_ref.depot_path"), "rev": F.col("content_ref.rev")})
    # Records without content have a null key; spread over the join by their own place, they meet nothing.
    salted = F.when(F.col("depot_path").isNull(), F.concat(F.lit("\n"), F.col("change_id").cast("string"), F.lit("/"), F.col("part").cast("string")))
    keyed = keyed.withColumn("depot_path", F.coalesce("depot_path", salted))
    lengths = sizes.select("depot_path", "rev", F.col("n_bytes").cast("long").alias("_content"))
    # The lengths of a text take up to ten digits each, twice.
    weight = F.coalesce(bare, F.lit(0)) + F.coalesce("_content", F.lit(0)) + F.when(F.col("content_form").isNotNull(), 20).otherwise(0)
    return keyed.join(lengths, ["depot_path", "rev"], "left").withColumn("weight", weight).drop("depot_path", "rev", "_content")


def place(records: DataFrame, options: o.MigrationOptions) -> tuple[DataFrame, DataFrame]:
    """Records with their split and segment, and the format header that opens each split.

    Records (change_id, part, others, and ``weight`` in bytes if known) lie one after another, and a segment is half of
    ``bytes_per_segment`` of that line: it takes the records that start in it, so it holds at most the whole. A record of
    more than half is alone in its segment. ``records_per_segment`` sets the least a record counts. No change is too big
    to be cut up, and the cut depends only on the data: a task that is run again writes the same segment.
    """
    half = max(options.bytes_per_segment // 2, 1)
    least = -(-options.bytes_per_segment // options.records_per_segment)
    known = F.col("weight").cast("long") if "weight" in records.columns else F.lit(0).cast("long")
    rows = records.withColumn("_weight", F.greatest(F.coalesce(known, F.lit(0)), F.lit(least))).withColumn("_unit", _unit())
    counts = rows.groupBy("change_id", "_unit").agg(F.sum("_weight").alias("_total"))
    per_change = counts.groupBy("change_id").agg(F.sum("_total").alias("_total"))
    started = prefix_sum(per_change, "change_id", F.col("_total"), "_end")
    started = started.select("change_id", (F.col("_end") - F.col("_total")).alias("_start"))
    splits = assign_splits(per_change, options.split_by)
    # At most 32,768 units per change, so this window never holds record-level data; the next one holds a unit.
    within = W.partitionBy("change_id").orderBy("_unit").rowsBetween(W.unboundedPreceding, -1)
    units = counts.withColumn("_before", F.coalesce(F.sum("_total").over(within), F.lit(0)))
    units = units.join(started, "change_id").join(splits, "change_id")
    units = units.select("change_id", "_unit", (F.col("_start") + F.col("_before")).alias("_before"), "split_id")
    before = W.partitionBy("change_id", "_unit").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    offset = F.col("_before") + F.coalesce(F.sum("_weight").over(before), F.lit(0))
    alone = (F.col("_weight") > half).cast("long")
    placed = rows.join(units, ["change_id", "_unit"]).withColumn("segment", 2 * divide(offset, half) + alone)
    text = to_bytes(F.lit(o.DUMP_HEADER), options.charset)
    headers = units.groupBy("split_id").agg((2 * divide(F.min("_before"), half)).alias("segment"))
    headers = headers.withColumns({"change_id": F.lit(-1), "part": F.lit(-1), "record": text})
    return placed.drop("_weight", "_unit", "_before", "weight"), headers.select(LAYOUT)


def _unit() -> Column:
    return segment_of(F.col("part")).cast("int")


def lay_out(
    nodes: DataFrame, contents: DataFrame | SharedContents, options: o.MigrationOptions, sizes: DataFrame | None = None
) -> DataFrame:
    """Dump records ready for the sink; ``sizes`` are the contents' fingerprints, if they are stored.

    The place of a record is settled on narrow rows; its bytes then move only twice, once to meet
    their record and once to their segment.
    """
    if sizes is not None:
        nodes = record_weight(nodes, sizes, options)
    placed, headers = place(nodes, options)
    records = serialise(placed, contents, options, ("split_id", "segment"))
    return records.select(LAYOUT).unionByName(headers)
