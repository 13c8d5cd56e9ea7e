"""Benchmark decontamination by word windows.

Words are lower-cased (A-Z) runs of digits, a-z and non-ASCII characters. A window is ``width`` consecutive
words of a benchmark item; a shorter item is one window. Each document is scanned once: every position's
window hash is probed against the hash set of the benchmark's windows, hits are verified word by word, and a
document word inside any verified window is hit. All of it is built-in expressions inside generated code.

The window set is broadcast only when a count of it proves it small (``BROADCAST_WINDOWS``, some tens of MB);
else the same join is left to Spark and shuffles. Besides its windows every document emits one marker row, so
that documents without hits keep their word count without a second scan.

Null and empty texts have no words and are never hit. Rows that repeat (same id and text) each get the same
result; rows that share an id but not the text are scanned as separate documents. A null id is an id like any
other. Items without words are ignored; an item with a null id counts under the id ``null``. Columns other than id and text are not read, and ``remove`` returns all
columns as they were.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from changeflow.llm.columns import CASED_PLAIN_WORDS, PLAIN_WORDS, ascii_lower, same, word_list
from changeflow.llm.common import stage

WIDTH = 10
BROADCAST_WINDOWS = 200_000


def _hash(words: str, at: Column, length: int, width: int) -> Column:
    """Hash of ``length`` words from ``at``; nulls (also those past the end) leave a hash as it is."""
    parts = [F.get(words, at + k) if k < length else F.lit(None).cast("string") for k in range(width)]
    return F.xxhash64(*parts)


def windows(benchmark: DataFrame, width: int = WIDTH, item_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """Distinct (_key, _length, _window, _item) of all items; ``_window`` is the words joined by a space."""
    items = benchmark.select(
        F.coalesce(benchmark[item_col].cast("string"), F.lit("null")).alias("_item"),
        word_list(ascii_lower(benchmark[text_col]), PLAIN_WORDS).alias("_words"),
    ).where(F.size("_words") > 0)
    last = F.greatest(F.size("_words") - width, F.lit(0))
    placed = items.select("*", F.explode(F.sequence(F.lit(0), last)).alias("_at"))
    return placed.select(
        _hash("_words", F.col("_at"), width, width).alias("_key"),
        F.least(F.size("_words"), F.lit(width)).alias("_length"),
        F.concat_ws(" ", *(F.get("_words", F.col("_at") + k) for k in range(width))).alias("_window"),
        "_item",
    ).distinct()


def _small(df: DataFrame, rows: int = BROADCAST_WINDOWS) -> bool:
    return df.limit(rows + 1).count() <= rows


def scan(
    docs: DataFrame,
    benchmark: DataFrame,
    width: int = WIDTH,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """Verified hits (_id, _row, _n, _at, _length, _window) and one marker (_at = -1) per document row."""
    found = windows(benchmark, width, item_col, item_text_col)
    lengths = sorted(r[0] for r in found.select("_length").distinct().collect())  # at most ``width`` numbers
    keys = found.select("_key", "_length", "_window").distinct()
    marker = F.lit(0).cast("long")
    # Marker rows meet a row of their own; a real window with that hash fails the check of its words.
    own = keys.sparkSession.range(1).select(marker.alias("_key"), F.lit(0).alias("_length"), F.lit("").alias("_window"))
    keys = keys.unionByName(own)
    if _small(keys):
        keys = F.broadcast(keys)
    texts = docs.select(
        docs[id_col].alias("_id"),
        F.xxhash64(docs[text_col]).alias("_row"),
        word_list(ascii_lower(docs[text_col]), PLAIN_WORDS).alias("_words"),
    ).withColumn("_n", F.size("_words"))
    placed = texts.select("*", F.explode(F.sequence(F.lit(-1), F.col("_n") - 1)).alias("_at"))
    at = F.col("_at")

    def probe(length: int) -> Column:
        return F.when(at + length <= F.col("_n"), _hash("_words", at, length, width))

    if len(lengths) == 1:
        probed = placed.withColumn("_probe", F.when(at < 0, marker).otherwise(probe(lengths[0])))
    elif lengths:
        each = F.when(at < 0, F.array(marker)).otherwise(F.array(*(probe(n) for n in lengths)))
        probed = placed.withColumn("_probe", F.explode(each))
    else:
        probed = placed.where(at < 0).withColumn("_probe", marker)
    words = F.concat_ws(" ", *(F.when(F.lit(k) < F.col("_length"), F.get("_words", at + k)) for k in range(width)))
    return (
        probed.join(keys, F.col("_probe") == F.col("_key"))
        .where(((at < 0) & (F.col("_length") == 0)) | ((at >= 0) & (F.col("_length") > 0) & (words == F.col("_window"))))
        .select("_id", "_row", "_n", "_at", "_length", "_window")
    )


def contamination(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, id_col: str = "doc_id", **cols) -> DataFrame:
    """(id, n_words, n_hit, n_items, items_sha256, contaminated) per document row."""
    hits = scan(docs, benchmark, width, id_col, **cols)
    key = ["_id", "_row"]
    end = F.col("_at") + F.col("_length")
    # Windows of one document in order: each adds the words that no earlier one reached.
    earlier = W.partitionBy(*key).orderBy("_at", "_length").rowsBetween(W.unboundedPreceding, -1)
    reached = F.greatest(F.coalesce(F.max(end).over(earlier), F.lit(-1)), F.col("_at"))
    per_doc = stage(
        hits.withColumn("_new", F.when(F.col("_at") >= 0, F.greatest(end - reached, F.lit(0))).otherwise(0))
        .groupBy(*key)
        .agg(
            F.max("_n").cast("long").alias("n_words"),
            F.sum("_new").alias("n_hit"),
            F.count_if(F.col("_at") < 0).alias("_copies"),
            F.collect_set(F.when(F.col("_at") >= 0, F.col("_window"))).alias("_windows"),
        ),
        "contamination",
    )
    names = {k: v for k, v in (("item_col", cols.get("item_col")), ("text_col", cols.get("item_text_col"))) if v}
    of_item = windows(benchmark, width, **names).select("_window", "_item").distinct()
    items = (
        per_doc.where(F.size("_windows") > 0)
        .select(*key, F.explode("_windows").alias("_window"))
        .join(of_item, "_window")
        .groupBy(*key)
        .agg(F.sort_array(F.collect_set("_item")).alias("_items"))
        .select(F.col("_id").alias("_id2"), F.col("_row").alias("_row2"), "_items")
    )
    joined = per_doc.drop("_windows").join(
        items, same(F.col("_id"), F.col("_id2")) & (F.col("_row") == F.col("_row2")), "left"
    )
    names_of = F.coalesce("_items", F.array().cast("array<string>"))
    return joined.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies")))).select(
        F.col("_id").alias(id_col),
        "n_words",
        "n_hit",
        F.size(names_of).cast("long").alias("n_items"),
        F.sha2(F.array_join(names_of, ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def remove(
    docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, spans: bool = False, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Documents without those that are hit, or, with ``spans``, all documents without their hit words.

    A removed word takes the separator behind it along.
    """
    hits = scan(docs, benchmark, width, id_col, text_col).where("_at >= 0")
    if not spans:
        hit = hits.select("_id", "_row").distinct()
    else:
        covered = F.explode(F.sequence(F.col("_at"), F.col("_at") + F.col("_length") - 1))
        hit = hits.select("_id", "_row", covered.alias("_at")).groupBy("_id", "_row").agg(F.collect_set("_at").alias("_hit"))
    on = same(docs[id_col], hit["_id"]) & (F.xxhash64(docs[text_col]) == hit["_row"])
    if not spans:
        return docs.join(hit, on, "left_anti")
    words = word_list(docs[text_col], CASED_PLAIN_WORDS)
    between = F.split(docs[text_col], CASED_PLAIN_WORDS, -1)
    kept = F.transform(
        F.arrays_zip(words.alias("w"), F.slice(between, F.lit(2), F.size(words)).alias("s")),
        lambda x, i: F.when(F.array_contains(hit["_hit"], i), F.lit("")).otherwise(F.concat(x["w"], x["s"])),
    )
    whole = F.concat(F.get(between, F.lit(0)), F.array_join(kept, ""))
    text = F.when(hit["_hit"].isNull(), docs[text_col]).otherwise(whole)
    columns = [text.alias(c) if c == text_col else docs[c] for c in docs.columns]
    return docs.join(hit, on, "left").select(*columns)
