"""The three jobs: build node records, publish them as a dump, and continue from an earlier run."""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import asdict, dataclass, replace
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from changeflow import schema
from changeflow.operators import changes, directories, lineage, nodes, replay
from changeflow.operators.numbering import number_changes, prefix_sum
from changeflow.operators.publish import lay_out
from changeflow.options import Hooks, MigrationOptions
from changeflow.session import scratch_path
from changeflow.sinks.dump import write_dump
from changeflow.sources import state as st
from changeflow.sources.tables import ChangeLog, read_changelists

# Node records are kept in folders of 65,536 ids each.
CHANGE_BITS = 16


@dataclass(frozen=True)
class Build:
    """What a build leaves behind; frames read from the tables it wrote."""

    run_id: str
    folder: str
    summary: dict
    state: st.State
    node_records: DataFrame
    rejects: DataFrame
    cleanup_change: int | None
    last_revision: int

    revisions = property(lambda self: self.state.revision_map)
    usage = property(lambda self: self.state.dir_usage)


@dataclass(frozen=True)
class Plan:
    """The first, lazy frames of a build."""

    changelists: DataFrame
    wanted: DataFrame
    numbered: DataFrame


def plan(log: ChangeLog, options: MigrationOptions) -> Plan:
    hooks = options.hooks
    changelists = hooks.apply(read_changelists(log.changelists, options), hooks.on_changelist)
    files = changes.in_range(log.file_revisions, options.from_change, options.to_change)
    wanted = hooks.apply(changes.wanted_files(files, options), hooks.on_file)
    numbered = number_changes(changes.mark_kept(changelists, wanted), options)
    return Plan(changelists, wanted, numbered)


def options_fingerprint(options: MigrationOptions) -> str:
    """Identifies the settings that shape node records; a change of them voids finished work."""
    fields = asdict(replace(options, hooks=Hooks()))
    shaping = ("branches", "base_revision", "from_change", "semantics", "convert_eol", "keyword_order")
    text = repr([(name, fields[name]) for name in shaping]) + repr(options.numbering)
    return hashlib.sha256(text.encode()).hexdigest()


def _steps(current: DataFrame, options: MigrationOptions, summary: dict) -> list[tuple[int, int]]:
    """Ranges of ids, of ``changes_per_step`` changes each, that are built and marked one after another."""
    size, last = options.changes_per_step, summary["last_change_id"]
    bounds = [options.from_change, last]
    if size and summary["total_changes"] > size:
        ranked = prefix_sum(current.select("change_id"), "change_id", F.lit(1), "_rank")
        # One id per step.
        ends = ranked.where((F.col("_rank") % size == 0) & (F.col("change_id") < last))
        bounds += [r.change_id for r in ends.collect()]
    bounds = sorted(set(bounds))
    return list(zip(bounds[:-1], bounds[1:], strict=True))


def without(ranges: list[tuple[int, int]], done: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Parts of half-open id ranges (low, high] that no range of ``done`` covers."""
    for begin, end in done:
        cut = []
        for low, high in ranges:
            cut += [(low, min(high, begin)), (max(low, end), high)]
        ranges = [(low, high) for low, high in cut if low < high]
    return ranges


def _marked(spark: SparkSession, path: str, table_schema, fingerprint: str, options: MigrationOptions) -> DataFrame:
    """Marks of earlier attempts at this run; none unless it is restored."""
    if not options.restore:
        return spark.createDataFrame([], table_schema)
    return st.read_or_empty(spark, path, table_schema).where(F.col("fingerprint") == fingerprint)


def _prints_in(log: ChangeLog, options: MigrationOptions, ranges: list[tuple[int, int]]) -> DataFrame:
    """Fingerprints of the revisions made in ranges of ids.

    With a ``change_id`` the one range given is a filter that reaches the scan. Without one, contents are hashed where they are
    read, and the revisions of the ranges are picked among the narrow fingerprints, so no bytes move.
    """
    if "change_id" in log.contents.columns:
        ((low, high),) = ranges
        rows = lineage.contents_of_run(log.contents, replace(options, from_change=low, to_change=high))
        return lineage.fingerprints(rows, options.charset)
    prints = lineage.fingerprints(lineage.contents_of_run(log.contents, options), options.charset)
    within = [(F.col("change_id") > low) & (F.col("change_id") <= high) for low, high in joined(ranges)]
    made = log.file_revisions.where(reduce(or_, within)).select("depot_path", "rev").distinct()
    # An inner join, as Spark would push a semi join below the hashes and shuffle the bytes.
    return prints.join(made, ["depot_path", "rev"])


def joined(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Half-open id ranges in order, with those that touch put together."""
    out: list[tuple[int, int]] = []
    for low, high in sorted(ranges):
        if out and out[-1][1] >= low:
            out[-1] = (out[-1][0], max(high, out[-1][1]))
        else:
            out.append((low, high))
    return out


def hash_contents(
    log: ChangeLog, options: MigrationOptions, folder: str, steps: list[tuple[int, int]], fingerprint: str, attempt: str
) -> DataFrame:
    """Fingerprints of the run's contents; ranges that an earlier attempt finished are left out.

    Contents with a ``change_id`` are read step by step, each step its own range. Others would be read whole by every step, so
    one pass makes all steps.
    """
    spark = log.contents.sparkSession
    marks = _marked(spark, f"{folder}/hashed", schema.HASHED, fingerprint, options).collect()  # one row per step
    stored = [m.batch for m in marks]
    left = without(steps, [(m.low, m.high) for m in marks])
    passes = [[step] for step in left] if "change_id" in log.contents.columns else [left] if left else []
    for number, ranges in enumerate(passes):
        batch = f"{attempt}-{number:06d}"
        st.write_table(_prints_in(log, options, ranges), f"{folder}/prints/batch={batch}", schema.FINGERPRINTS)
        mark = spark.createDataFrame([(low, high, fingerprint, batch) for low, high in ranges], schema.HASHED)
        mark.coalesce(1).write.mode("append" if options.restore or number else "overwrite").parquet(f"{folder}/hashed")
        stored.append(batch)
    return _batches_of(spark, f"{folder}/prints", schema.FINGERPRINTS, sorted(set(stored)))


def _batches_of(spark: SparkSession, path: str, table_schema, stored: list[str], *more: StructField) -> DataFrame:
    """Rows of the finished steps among the folders ``batch=...`` of a table."""
    if not stored:
        return spark.createDataFrame([], StructType([*table_schema.fields, *more]))
    named = StructType([*table_schema.fields, *more, StructField("batch", StringType())])
    return spark.read.schema(named).parquet(path).where(F.col("batch").isin(stored)).drop("batch")


def _records_of(spark: SparkSession, folder: str, stored: list[str], options: MigrationOptions) -> DataFrame:
    """Node records of the run's range; folders of other ranges of changes are not read."""
    rows = _batches_of(spark, f"{folder}/node_records", schema.NODE_RECORDS, stored, StructField("change_bucket", IntegerType()))
    low, high = options.from_change >> CHANGE_BITS, options.to_change >> CHANGE_BITS
    rows = rows.where(F.col("change_bucket").between(low, high)).drop("change_bucket")
    # A restored run may cover a narrower range than the one that wrote the records.
    return changes.in_range(rows, options.from_change, options.to_change)


def _copies(
    wanted: DataFrame, log: ChangeLog, prints: DataFrame, current: DataFrame, previous: st.State, save: Callable, options: MigrationOptions
) -> DataFrame:
    """Plain copies among the wanted files; of earlier runs, only what these files name is looked up."""
    asked = lineage.ask_sources(wanted, log.integrations, options)
    if not previous.layers:
        made = lineage.source_changes(asked, log.file_revisions, options)
        return lineage.compare_copies(asked, made, prints, current, options)
    asked = save(asked, "asked", schema.ASKED)
    made = save(lineage.source_changes(asked, log.file_revisions, options), "sources", schema.SOURCES)
    prints = previous.lookup("fingerprints", lineage.named_revisions(asked), prints)
    changed = made.select(F.col("from_change_id").alias("change_id"))
    revisions = previous.lookup("revision_map", changed, current)
    return lineage.compare_copies(asked, made, prints, revisions, options)


def build(
    log: ChangeLog,
    options: MigrationOptions,
    root: str,
    run_id: str,
    previous: st.State | None = None,
) -> Build | None:
    """Write revision map, node records, rejects and directory usage; None if no change is in range."""
    spark = log.changelists.sparkSession
    root = root.rstrip("/")
    previous = previous or st.empty_state(spark, root)
    folder = f"{root}/{run_id}"
    frames = plan(log, options)
    save = lambda df, name, s: st.write_table(df, f"{folder}/{name}", s)

    current = save(frames.numbered, "numbered", schema.REVISION_MAP)
    summary = changes.run_summary(current, options.base_revision).first().asDict()
    if not summary["total_changes"]:
        return None
    numbered = current.withColumn("kept", F.col("revision") != 0)
    layers = dict(previous.layers)
    layers["revision_map"] = st.add_layer(previous, run_id, "revision_map", current)

    # Narrow rows, written once: everything below starts from them, and hooks run once.
    wanted_files = save(frames.wanted, "wanted", frames.wanted.schema)
    reject_rows = nodes.rejects(wanted_files)
    reject_rows = save(reject_rows, "rejects", reject_rows.schema)
    if options.strict and not reject_rows.isEmpty():
        raise ValueError(f"files with unknown actions, see {folder}/rejects")

    # Finished changes leave first: nothing below is done for them, and their contents are not read again.
    fingerprint = options_fingerprint(options)
    steps = _steps(current, options, summary)
    attempt = hashlib.sha256(scratch_path(spark, "batch").encode()).hexdigest()[:16]
    done = _marked(spark, f"{folder}/completed", schema.COMPLETED, fingerprint, options)
    stored = [r.batch for r in done.select("batch").distinct().collect()] if options.restore else []
    wanted = wanted_files
    if stored:
        wanted = wanted.join(done.select("change_id").distinct(), ["change_id"], "left_anti")

    prints = hash_contents(log, options, folder, steps, fingerprint + options.charset, attempt)
    layers["fingerprints"] = st.add_layer(previous, run_id, "fingerprints", prints)
    copies = save(_copies(wanted, log, prints, current, previous, save, options), "copies", schema.COPIES)
    for number, (low, high) in enumerate(steps):
        batch = f"{attempt}-{number:06d}"
        step = lambda df: changes.in_range(df, low, high)  # noqa: B023, E731
        made = nodes.change_nodes(step(wanted), step(copies), options)
        made = options.hooks.apply(made, options.hooks.after_build)
        place = f"{folder}/node_records/batch={batch}"
        bucket = F.shiftright("change_id", CHANGE_BITS).alias("change_bucket")
        columns = [F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.NODE_RECORDS]
        made.select(*columns, bucket).write.mode("overwrite").partitionBy("change_bucket").parquet(place)
        marked = _batches_of(spark, f"{folder}/node_records", schema.NODE_RECORDS, [batch]).select("change_id").distinct()
        marked = marked.withColumns({"fingerprint": F.lit(fingerprint), "batch": F.lit(batch)})
        # Appended once the step's records are whole, so a run that dies keeps all steps before.
        marked.write.mode("append" if options.restore or number else "overwrite").parquet(f"{folder}/completed")
        stored.append(batch)
    records = _records_of(spark, folder, stored, options)
    headers = nodes.header_nodes(frames.changelists, numbered, options)
    headers = save(headers, "headers", schema.NODE_RECORDS)
    records = records.unionByName(headers)

    if options.corrected:
        usage = directories.kept_usage(replay.keep_allowed(records, _prior(previous, records)))
    else:
        usage = directories.dir_usage(wanted_files)
    if previous.layers:
        # Only directories that this run touches get a new count, and only those that cross zero change the empty ones.
        usage = save(usage, "usage", schema.DIR_USAGE)
        before = save(previous.lookup("dir_usage", usage), "prior_usage", schema.DIR_USAGE)
        usage = directories.merge_usage(before, usage)
        crossed = directories.zero_crossings(usage, before)
    else:
        crossed = directories.zero_crossings(usage)
    layers["dir_usage"] = st.add_layer(previous, run_id, "dir_usage", usage)
    if previous.layers and "empty_dirs" not in previous.layers:
        # State of a version that did not keep them: once from all counts.
        crossed = directories.zero_crossings(replace(previous, layers=layers).dir_usage)
    layers["empty_dirs"] = st.add_layer(previous, run_id, "empty_dirs", crossed)
    state = replace(previous, layers=layers)

    last_revision, cleanup_change = summary["last_revision"], None
    if options.cleanup:
        usage = state.empty_dirs.where("empty = 1").select("path", F.lit(0).cast("long").alias("usage"))
        if not (options.skip_empty_cleanup and directories.empty_dirs(usage).isEmpty()):
            last_revision, cleanup_change = last_revision + 1, summary["last_change_id"] + 1
            removed = nodes.cleanup_nodes(directories.number_empty_dirs(usage), cleanup_change)
            header = nodes.cleanup_header(cleanup_change, last_revision, usage, options)
            records = records.unionByName(save(removed.unionByName(header), "cleanup", schema.NODE_RECORDS))
    return Build(run_id, folder, summary, state, records, reject_rows, cleanup_change, last_revision)


def _prior(previous: st.State, records: DataFrame) -> DataFrame | None:
    """Earlier statuses of the paths in ``records``."""
    if not previous.layers.get("path_status"):
        return None
    return previous.lookup("path_status", records.where("path is not null"))


def publish(
    built: Build,
    log: ChangeLog,
    options: MigrationOptions,
    root: str,
    out: str | None = None,
    previous: st.State | None = None,
    name: str = "dump",
) -> DataFrame:
    """Replay the records, write the legal ones as an ordered dump and save path statuses."""
    spark = log.changelists.sparkSession
    previous = previous or st.empty_state(spark, root.rstrip("/"))
    prior = _prior(previous, built.node_records)
    if prior is not None:
        prior = st.write_table(prior, f"{built.folder}/prior_status", schema.PATH_STATUS)
    kept = replay.keep_allowed(built.node_records, prior)
    # Narrow rows are settled before any content is read.
    kept = st.write_table(kept, f"{built.folder}/kept", schema.NODE_RECORDS)
    if out is not None:
        contents = lineage.contents_of_run(log.contents, options)
        sizes = built.state.lookup("fingerprints", kept.where("content_ref is not null").select("content_ref.*"))
        laid = lay_out(kept, contents, options, sizes)
        write_dump(options.hooks.apply(laid, options.hooks.on_publish), out, name)
    status = replay.final_status(built.node_records, prior)
    built.state.layers["path_status"] = st.add_layer(previous, built.run_id, "path_status", status)
    return kept


def finish(built: Build, spark: SparkSession, root: str) -> None:
    """Make the run visible to later runs: its last id, its last revision with the cleanup's, and its layers."""
    last = built.summary["last_change_id"]
    st.save_run_meta(spark, root, built.run_id, last, built.last_revision, built.state.layers)


def run(
    log: ChangeLog,
    options: MigrationOptions,
    root: str,
    run_id: str,
    out: str | None = None,
    previous: st.State | None = None,
) -> Build | None:
    built = build(log, options, root, run_id, previous)
    if built is not None:
        publish(built, log, options, root, out, previous)
        finish(built, log.changelists.sparkSession, root)
    return built


def run_incremental(
    log: ChangeLog, options: MigrationOptions, root: str, run_id: str, out: str | None = None
) -> Build | None:
    """Continue after the newest finished run; its last id overrides a lower bound in ``options``."""
    previous = st.load_state(log.changelists.sparkSession, root)
    if previous.run_id is not None:
        options = replace(
            options, from_change=previous.last_change_id, base_revision=previous.last_revision
        )
    return run(log, options, root, run_id, out, previous)
