"""Change log tables derived from the ``events`` and ``documents`` tables.

Every rule here is fixed by the test inputs: eight events make one change, and ``k`` is the number
inside an event's ``props``.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from changeflow.functions.text import missing_text, to_bytes
from changeflow.operators.skew import running, segment_of
from changeflow.options import Branch
from changeflow.sources.tables import ChangeLog, SharedContents

BRANCHES = (
    Branch("//depot/main/", "trunk/", 1),
    Branch("//depot/rel/", "branches/rel/", 2),
)

# --- fixed values of the derivation -----------------------------------------
FILES_PER_CHANGE = 8
FILE_TYPES = ("text", "unicode", "k", "+kx", "binary", "symlink", "ktext", "x")
SOURCE_STEPS = {1: 9, 2: 25}
KEYWORD_LINE = "$Author$ $Date$ $File$ $Id$ $Revision$"
MISSING_K = 97
EVENTS_PER_GROUP, DOCUMENTS_PER_GROUP = 20, 4
# ------------------------------------------------------------------------------


@lru_cache(maxsize=64)
def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; its schema is read from the files once per session."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def change_of_event(event: Column) -> Column:
    return F.call_function("div", event, F.lit(FILES_PER_CHANGE)).cast("int") + 1


def event_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One file row per event, still without its revision number."""
    number = F.get_json_object("props", "$.k").cast("int")
    events = table(spark, sf_dir, "events").withColumn("k", number)
    event, user, k = F.col("event_id"), F.col("user_id"), F.col("k")
    change = change_of_event(event)
    unmapped = (change % 10 == 0) | (user % 10).isin(8, 9)
    root = F.when(unmapped, "scratch").when(user % 2 == 0, "main").otherwise("rel")
    kind = F.col("event_type")
    action = (
        F.when(kind == "signup", F.when(k % 10 == 0, "PURGE").otherwise("ADD"))
        .when(kind == "click", "EDIT")
        .when(kind == "view", "INTEGRATE")
        .when(kind == "purchase", "BRANCH")
        .when(kind == "error", "DELETE")
    )
    path = F.concat(
        F.lit("//depot/"), root, F.lit("/u"), user.cast("string"), F.lit("/d"), (k % 3).cast("string"),
        F.lit("/f"), (k % 6).cast("string"), F.lit(".txt"),
    )
    types = F.array(*[F.lit(t) for t in FILE_TYPES])
    return events.select(
        "event_id", "ts", "user_id", "k",
        change.alias("change_id"),
        (event % FILES_PER_CHANGE).cast("int").alias("_slot"),
        path.alias("depot_path"),
        action.alias("action"),
        F.get(types, k % len(FILE_TYPES)).alias("file_type"),
    ).withColumn("file_ord", F.col("_slot") + 1).drop("_slot")


def with_revisions(rows: DataFrame) -> DataFrame:
    """Number the rows of each path in event order."""
    numbered = running(
        rows, ["depot_path"], ["event_id"], segment_of(F.col("event_id")), F.lit(1), "sum", "rev"
    )
    return numbered.withColumn("rev", F.col("rev").cast("int"))


def file_revisions(revised: DataFrame) -> DataFrame:
    return revised.select("change_id", "file_ord", "depot_path", "rev", "action", "file_type")


def changelists(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    change = change_of_event(F.col("event_id"))
    return (
        events.groupBy(change.alias("change_id"))
        .agg(F.min_by("user_id", "event_id").alias("_user"), F.max("ts").alias("submitted_at"))
        .select(
            "change_id",
            F.concat(F.lit("u"), F.col("_user").cast("string")).alias("username"),
            "submitted_at",
            F.concat(F.lit("change "), F.col("change_id").cast("string")).alias("description"),
        )
    )


def integrations(revised: DataFrame) -> DataFrame:
    """Up to two integration records per branched or integrated row, from earlier events."""
    k = F.col("k")
    verb = F.when(F.col("action") == "BRANCH", "branch from").otherwise("copy from")
    steps = F.array(
        *[F.struct(F.lit(n).alias("seq"), F.lit(back).alias("back")) for n, back in SOURCE_STEPS.items()]
    )
    targets = revised.where(F.col("action").isin("BRANCH", "INTEGRATE")).select(
        F.col("depot_path").alias("to_path"),
        F.col("rev").alias("to_rev"),
        F.when(k % 7 == 0, "merge into").otherwise(verb).alias("how_from"),
        (k % 11 == 0).alias("_no_rev"),
        "event_id",
        F.inline(steps),
    )
    targets = targets.withColumn("event_id", F.col("event_id") - F.col("back"))
    sources = revised.select("event_id", F.col("depot_path").alias("from_path"), F.col("rev").alias("_rev"))
    no_rev = F.col("_no_rev") & (F.col("seq") == 1)
    return targets.join(sources, "event_id").select(
        "to_path", "to_rev", "seq", "how_from", "from_path",
        F.when(no_rev, 0).otherwise(F.col("_rev")).alias("end_from_rev"),
    )


def _document_of_row(spark: SparkSession, sf_dir: str, revised: DataFrame) -> DataFrame:
    n_docs = table(spark, sf_dir, "documents").agg(F.max("doc_id") + 1).scalar()
    group = F.call_function("div", F.col("event_id"), F.lit(EVENTS_PER_GROUP)) * DOCUMENTS_PER_GROUP
    doc_id = (group + F.col("k") % DOCUMENTS_PER_GROUP) % n_docs
    return revised.select("depot_path", "rev", "file_type", "k", doc_id.alias("doc_id"))


def fingerprints(spark: SparkSession, sf_dir: str, revised: DataFrame, keyword_line: bool = False) -> DataFrame:
    """Length and digest of each revision's content. A document is hashed once, where it is read; texts never move."""
    def print_of(content: Column) -> Column:
        return F.struct(F.octet_length(content).alias("n_bytes"), F.sha2(content, 256).alias("digest"))

    text = F.col("text").cast("binary")
    with_line = F.concat(F.lit(KEYWORD_LINE + "\n"), F.col("text")).cast("binary") if keyword_line else text
    prints = table(spark, sf_dir, "documents").select(
        "doc_id", print_of(text).alias("_plain"), print_of(with_line).alias("_lined")
    )
    rows = _document_of_row(spark, sf_dir, revised).join(prints, "doc_id")
    is_text = F.col("file_type").isin("text", "unicode")
    gone = print_of(to_bytes(missing_text(F.col("depot_path"), F.col("rev"))))
    found = F.when(F.col("k") == MISSING_K, gone).when(is_text, F.col("_lined")).otherwise(F.col("_plain"))
    return rows.select("depot_path", "rev", found.alias("_f")).select("depot_path", "rev", "_f.*")


def contents(spark: SparkSession, sf_dir: str, revised: DataFrame, keyword_line: bool = False) -> SharedContents:
    """Each revision holds one whole document; neighbouring events share a few of them."""
    documents = table(spark, sf_dir, "documents")
    line = []
    if keyword_line:
        is_text = F.col("file_type").isin("text", "unicode")
        line = [F.when(is_text, F.lit(KEYWORD_LINE + "\n")).cast("binary").alias("prefix")]
    refs = _document_of_row(spark, sf_dir, revised).select(
        "depot_path", "rev", (F.col("k") == MISSING_K).alias("missing"), F.col("doc_id").alias("blob_id"), *line
    )
    return SharedContents(refs, documents.select(F.col("doc_id").alias("blob_id"), F.col("text").cast("binary").alias("content")))


def change_log(spark: SparkSession, sf_dir: str, keyword_line: bool = False) -> ChangeLog:
    revised = with_revisions(event_rows(spark, sf_dir))
    return ChangeLog(
        changelists(spark, sf_dir),
        file_revisions(revised),
        contents(spark, sf_dir, revised, keyword_line),
        integrations(revised),
    )
