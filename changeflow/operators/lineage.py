"""Where a branched or integrated revision came from, and whether it is a plain copy."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeflow.functions.paths import is_wanted, map_prefix
from changeflow.functions.text import missing_text, to_bytes
from changeflow.operators.changes import in_range
from changeflow.options import MigrationOptions
from changeflow.sources.tables import SharedContents


def pick_sources(integrations: DataFrame, semantics: str = "faithful") -> DataFrame:
    """One (from_path, from_rev) per target revision, out of its integration records.

    Faithful: the first path and the first non-zero revision are taken independently, so they may
    stem from different records. Corrected: both come from the first record that has both.
    """
    rows = integrations.where(F.col("how_from").contains("from"))
    has_path, has_rev = F.col("from_path").isNotNull(), F.col("end_from_rev") != 0
    if semantics == "corrected":
        rows = rows.where(has_path & has_rev)
        has_path = has_rev = F.lit(True)
    first = lambda name, ok: F.min_by(name, F.when(ok, F.col("seq")))
    return (
        rows.groupBy("to_path", "to_rev")
        .agg(
            first("from_path", has_path).alias("from_path"),
            first("end_from_rev", has_rev).alias("from_rev"),
            F.count(F.when(has_path, 1)).alias("_paths"),
            F.count(F.when(has_rev, 1)).alias("_revs"),
        )
        .where("_paths > 0 and _revs > 0")
        .drop("_paths", "_revs")
    )


def single_history(history: DataFrame) -> DataFrame:
    """Integration rows of history entries that are usable: own path, and one revision returned.

    ``history`` holds (asked_path, asked_rev, entry_path, entry_rev, integrations ARRAY<STRUCT>).
    """
    own = history.where(F.col("entry_path") == F.col("asked_path"))
    entry = F.struct("entry_rev", "integrations")
    single = (
        own.groupBy("asked_path", "asked_rev")
        .agg(F.count("*").alias("_entries"), F.any_value(entry).alias("_entry"))
        .where("_entries = 1")
    )
    return single.select(
        F.col("asked_path").alias("to_path"),
        F.col("asked_rev").alias("to_rev"),
        F.posexplode("_entry.integrations").alias("seq", "_i"),
    ).select("to_path", "to_rev", (F.col("seq") + 1).alias("seq"), "_i.*")


def resolved_content(depot_path: Column, rev: Column, content: Column, charset: str = "UTF-8") -> Column:
    """A revision's bytes, or an explanation in their place when they are gone."""
    return F.coalesce(content, to_bytes(missing_text(depot_path, rev), charset))


def load_content(contents: DataFrame | SharedContents, charset: str = "UTF-8") -> DataFrame:
    if isinstance(contents, SharedContents):
        contents = contents.table()
    present = F.when(~F.coalesce("missing", F.lit(False)), F.col("content"))
    resolved = resolved_content(F.col("depot_path"), F.col("rev"), present, charset)
    return contents.select(
        "depot_path", "rev", resolved.alias("content"), present.isNull().alias("missing")
    )


def attach_content(rows: DataFrame, contents: DataFrame | SharedContents, charset: str = "UTF-8") -> DataFrame:
    """Add ``content`` to rows of (depot_path, rev, others); shared contents move once, to the rows that name them."""
    key = ["depot_path", "rev"]
    if isinstance(contents, SharedContents):
        found = contents.fill(rows.join(contents.refs.drop("change_id"), key, "left"), "left").drop("missing")
    else:
        found = rows.join(load_content(contents, charset).select(*key, "content"), key, "left")
    return found.withColumn("content", resolved_content(F.col("depot_path"), F.col("rev"), F.col("content"), charset))


def print_of(content: Column) -> Column:
    return F.struct(F.octet_length(content).alias("n_bytes"), F.sha2(content, 256).alias("digest"))


def fingerprints(contents: DataFrame | SharedContents, charset: str = "UTF-8") -> DataFrame:
    """Length and digest per revision: computed where the bytes are read, cheap to shuffle."""
    if isinstance(contents, SharedContents) and "prefix" not in contents.columns:
        blobs = contents.blobs.select("blob_id", F.when(F.col("content").isNotNull(), print_of(F.col("content"))).alias("_found"))
        gone = print_of(to_bytes(missing_text(F.col("depot_path"), F.col("rev")), charset))
        found = F.coalesce(F.when(~F.col("missing"), F.col("_found")), gone)
        rows = contents.refs.join(blobs, "blob_id")
        return rows.select("depot_path", "rev", found.alias("_f")).select("depot_path", "rev", "_f.*")
    rows = load_content(contents, charset)
    return rows.select("depot_path", "rev", print_of(F.col("content")).alias("_f")).select("depot_path", "rev", "_f.*")


def contents_of_run(contents: DataFrame | SharedContents, options: MigrationOptions) -> DataFrame | SharedContents:
    """Contents under the branches; with a ``change_id`` column, only those of the run's range.

    Both filters reach the scan, so an increment need not read the bytes of earlier runs.
    """
    rows = contents.where(is_wanted(F.col("depot_path"), options.branches))
    if "change_id" in contents.columns:
        rows = in_range(rows, options.from_change, options.to_change)
    return rows


def same_content(n_bytes: Column, digest: Column, other_bytes: Column, other_digest: Column) -> Column:
    return (n_bytes == other_bytes) & (digest == other_digest)


def find_source_changes(picks: DataFrame, all_files: DataFrame) -> DataFrame:
    """Add the change that made each picked source revision; unknown sources drop out."""
    sources = all_files.select(
        F.col("depot_path").alias("from_path"),
        F.col("rev").alias("from_rev"),
        F.col("change_id").alias("from_change_id"),
    )
    return picks.join(sources, ["from_path", "from_rev"])


def with_revision(files: DataFrame, revisions: DataFrame) -> DataFrame:
    """Add the revision number of each file row's change; 0 when it has none."""
    numbered = revisions.select("change_id", "revision")
    out = files.join(numbered, ["change_id"], "left")
    return out.withColumn("revision", F.coalesce("revision", F.lit(0)))


def ask_sources(wanted: DataFrame, integrations: DataFrame, options: MigrationOptions) -> DataFrame:
    """Branched and integrated files with the source revision each names: columns of ``schema.ASKED``."""
    candidates = wanted.where(F.col("action").isin("BRANCH", "INTEGRATE")).select(
        "change_id", "file_ord", F.col("depot_path").alias("to_path"), F.col("rev").alias("to_rev")
    )
    target = ["to_path", "to_rev"]
    # Only what this run's candidates name is looked up in the history.
    named = integrations.join(candidates.select(target), target, "left_semi")
    return candidates.join(pick_sources(named, options.semantics), target).select(
        "change_id", "file_ord", "to_path", "to_rev", "from_path", "from_rev"
    )


def source_changes(asked: DataFrame, all_files: DataFrame, options: MigrationOptions) -> DataFrame:
    """The change that made each source revision asked for: columns of ``schema.SOURCES``."""
    keys = asked.select("from_path", "from_rev").distinct()
    return find_source_changes(keys, all_files.where(is_wanted(F.col("depot_path"), options.branches)))


def named_revisions(asked: DataFrame) -> DataFrame:
    """(depot_path, rev) of all targets and sources, whose content is compared."""
    targets = asked.select(F.col("to_path").alias("depot_path"), F.col("to_rev").alias("rev"))
    return targets.union(asked.select("from_path", "from_rev")).distinct()


def compare_copies(
    asked: DataFrame, sources: DataFrame, prints: DataFrame, revisions: DataFrame, options: MigrationOptions
) -> DataFrame:
    """(change_id, file_ord, copy_from_path, copy_from_rev) of the files that are plain copies.

    ``prints`` holds content fingerprints; give it as a stored table, since it is used twice. Every
    step is an inner join that only narrows the candidates, so rows without a source never travel
    along as NULL keys.
    """
    targets = prints.toDF("to_path", "to_rev", "to_bytes", "to_digest")
    asked = asked.join(targets, ["to_path", "to_rev"])
    # Everything known about a source revision is gathered once per revision, before it meets the
    # (possibly very many) targets that name it.
    made = sources.select(
        F.col("from_path").alias("depot_path"), F.col("from_rev").alias("rev"), F.col("from_change_id").alias("change_id")
    )
    known = (
        with_revision(made, revisions)
        .where("revision <> 0")
        .join(prints, ["depot_path", "rev"])
        .select(
            F.col("depot_path").alias("from_path"),
            F.col("rev").alias("from_rev"),
            F.col("change_id").alias("from_change_id"),
            map_prefix(F.col("depot_path"), options.branches).alias("copy_from_path"),
            F.col("revision").alias("copy_from_rev"),
            F.col("n_bytes").alias("from_bytes"),
            F.col("digest").alias("from_digest"),
        )
    )
    same = same_content(F.col("to_bytes"), F.col("to_digest"), F.col("from_bytes"), F.col("from_digest"))
    copies = asked.join(known, ["from_path", "from_rev"]).where(same)
    if options.corrected:
        copies = copies.where(F.col("from_change_id") < F.col("change_id"))
    return copies.select("change_id", "file_ord", "copy_from_path", "copy_from_rev")


def resolve_copies(
    wanted: DataFrame,
    all_files: DataFrame,
    integrations: DataFrame,
    prints: DataFrame,
    revisions: DataFrame,
    options: MigrationOptions,
) -> DataFrame:
    """All of the above in one lazy frame, for inputs that are stored tables."""
    asked = ask_sources(wanted, integrations, options)
    return compare_copies(asked, source_changes(asked, all_files, options), prints, revisions, options)
