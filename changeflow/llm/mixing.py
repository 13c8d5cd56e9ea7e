"""Mixing sources to target weights by temperature.

Source shares of all tokens are raised to an exponent between 0 and 1 and normalised. The exponent is found by
bisection on a grid of ``STEPS``: the smallest that keeps every source within a repetition limit, or the largest
that reaches a target entropy. The weights then turn into a token quota per source. Each source is read in
epochs; every epoch is a permutation of the source by hash, cut where the quota ends. The document's place in
its source's quota gives its block, so every block holds all sources in the wanted shares, and the order within a
block is a hash again.

With no budget given, the budget is the smallest that reads every document at least once, so nothing is dropped.

A document counts its words and one end, so no document is free. Null and empty texts count one token. A null source
is a source. Rows that repeat are scheduled each. An empty table gives no rows. Running sums within a source are
taken over ``BUCKETS`` hash ranges, so a source that holds most rows is not one task. The only values that reach the
driver are the exponent and two sums; the bisection sees one number per source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from changeflow.llm.columns import SPACED_WORDS, nulls_and_all, same, word_list
from changeflow.llm.common import stage

STEPS = 4096  # a power of two
BUCKET_DIGITS = 3  # hex digits: 4096 ranges


def sized(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """Narrow rows (doc_id, source, row_key, n_tokens)."""
    return docs.select(
        docs[id_col].alias("doc_id"),
        docs[source_col].alias("source"),
        F.xxhash64(*nulls_and_all(docs[id_col], docs[source_col], docs[text_col])).alias("row_key"),
        (F.size(word_list(docs[text_col], SPACED_WORDS)) + 1).cast("long").alias("n_tokens"),
    )


def exponent(totals: DataFrame, max_repetition: float | None = None, target_entropy: float | None = None) -> int:
    """Exponent in steps of 1 / ``STEPS`` for rows (source, total).

    ``max_repetition`` bounds how often a source is read when the largest is read once; ``target_entropy`` is in nats.
    """
    if (max_repetition is None) == (target_entropy is None):
        raise ValueError("give either a repetition limit or a target entropy")
    # One number per source.
    row = totals.agg(F.collect_list(F.col("total").cast("double")).alias("t"))

    def power(step: Column, x: Column) -> Column:
        return F.pow(x / F.array_max("t"), step / STEPS)

    def add(values: Column) -> Column:
        return F.aggregate(values, F.lit(0.0), lambda a, x: a + x)

    def natural_enough(step: Column) -> Column:
        if max_repetition is not None:
            return F.pow(F.array_max("t") / F.array_min("t"), 1 - step / STEPS) <= max_repetition
        raised = F.transform("t", lambda x: power(step, x))
        total = add(raised)
        entropy = F.log(total) - add(F.transform(raised, lambda x: x * F.log(x))) / total
        return entropy < target_entropy  # below the target: go on to a smaller exponent

    # The smallest step for which the test holds, searched beyond STEPS so that STEPS itself is tested.
    def halve(low: Column, width: Column) -> Column:
        half = (width / 2).cast("int")
        return F.when(natural_enough(low + half - 1), low).otherwise(low + half)

    widths = [2 * STEPS >> k for k in range(STEPS.bit_length())]
    found = F.aggregate(F.array(*map(F.lit, widths)), F.lit(0), halve)
    step = row.where(F.size("t") > 0).select(found).first()
    if step is None:
        return STEPS
    return min(step[0], STEPS) if max_repetition is not None else min(max(step[0] - 1, 0), STEPS)


def schedule(
    docs: DataFrame,
    max_repetition: float | None = 2.0,
    target_entropy: float | None = None,
    budget: int | None = None,
    blocks: int = 64,
    seed: int = 7,
    **cols: str,
) -> DataFrame:
    """(doc_id, source, row_key, n_tokens, epoch, block, block_key): sort by block and block_key to read."""
    rows = stage(sized(docs, **cols), "mix-sizes")
    totals = rows.groupBy("source").agg(F.sum("n_tokens").alias("total"))
    step = exponent(totals, max_repetition, target_entropy)
    top = totals.agg(F.max("total")).first()[0] or 1
    raised = F.pow(F.col("total") / F.lit(float(top)), F.lit(step / STEPS))
    if budget is None:
        quota = raised * F.lit(float(top))
    else:
        whole = totals.agg(F.sum(raised)).first()[0] or 1.0
        quota = raised * F.lit(budget / whole)
    # With the smallest covering budget a quota is never under its source's total.
    least = F.col("total") if budget is None else F.lit(0)
    plan = totals.withColumn("quota", F.greatest(F.round(quota).cast("long"), least)).select(
        F.col("source").alias("_source"), "total", "quota"
    )
    epochs = F.ceil(F.col("quota") / F.col("total"))
    parts = [F.coalesce("source", F.lit("")), F.col("epoch"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))]
    key = F.md5(F.concat_ws("|", F.lit(str(seed)), *(p.cast("string") for p in parts)).cast("binary"))
    repeated = (
        rows.join(plan, same(F.col("source"), F.col("_source")))
        .where(F.col("quota") > 0)
        .withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), epochs - 1)))
        .withColumn("_key", key)
        .withColumn("_bucket", F.substring("_key", 1, BUCKET_DIGITS))
    )
    part = ["source", "epoch", "_bucket"]
    earlier = W.partitionBy("source", "epoch").orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    bases = (
        repeated.groupBy(*part)
        .agg(F.sum("n_tokens").alias("_sum"))
        .select(
            F.col("source").alias("_s"),
            F.col("epoch").alias("_e"),
            F.col("_bucket").alias("_b"),
            F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_base"),
        )
    )
    within = W.partitionBy(*part).orderBy("_key", "row_key", "n_tokens").rowsBetween(W.unboundedPreceding, -1)
    at = F.col("epoch") * F.col("total") + F.col("_base") + F.col("_within")
    joined = repeated.withColumn("_within", F.coalesce(F.sum("n_tokens").over(within), F.lit(0))).join(
        bases, same(F.col("source"), F.col("_s")) & (F.col("epoch") == F.col("_e")) & (F.col("_bucket") == F.col("_b"))
    )
    block = F.expr(f"(_at * {int(blocks)}) div quota").cast("int")
    return (
        joined.withColumn("_at", at)
        .where(F.col("_at") < F.col("quota"))
        .withColumn("block", block)
        .withColumn("block_key", F.md5(F.concat_ws("|", F.col("_key"), F.col("block").cast("string")).cast("binary")))
        .select("doc_id", "source", "row_key", "n_tokens", "epoch", "block", "block_key")
    )


def mix(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs``, each as often as the schedule reads it, with the columns of ``docs``.

    Rows with one id, source and text share their reads evenly, whatever their other columns hold.
    """
    planned = schedule(docs, id_col=id_col, source_col=source_col, text_col=text_col, **options)
    times = planned.groupBy(
        F.col("row_key").alias("time_key"), F.col("doc_id").alias("time_id"), F.col("source").alias("time_source")
    ).agg(F.count("*").alias("reads"))
    # The row is one column from here on, so its names meet none of these. Equal rows fold before texts move, once.
    row = F.struct(*[docs[c] for c in docs.columns]).alias("row")
    key = F.xxhash64(*nulls_and_all(docs[id_col], docs[source_col], docs[text_col])).alias("key")
    distinct = docs.select(row, key, docs[id_col].alias("id"), docs[source_col].alias("source"))
    distinct = distinct.repartition("key").groupBy("row", "key", "id", "source").agg(F.count("*").alias("copies"))
    met = distinct.join(
        times, (F.col("key") == F.col("time_key")) & same(F.col("id"), F.col("time_id")) & same(F.col("source"), F.col("time_source"))
    )
    # Rows that differ elsewhere, or whose hashes collide: each gets its share of the reads of all.
    alike = W.partitionBy("key", "id", "source")
    upto = F.sum("copies").over(alike.orderBy(F.xxhash64("row"), "copies").rowsBetween(W.unboundedPreceding, 0))
    shared = met.withColumns({"upto": upto, "all": F.sum("copies").over(alike)})
    share = F.expr("upto * reads div all - (upto - copies) * reads div all").alias("share")
    counted = shared.select("row", share).where("share > 0")
    return counted.select("row", F.explode(F.sequence(F.lit(1).cast("long"), "share"))).select("row.*")
