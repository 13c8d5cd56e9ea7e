"""Whole jobs: splits, dumps, increments, restore and old state files."""

from dataclasses import replace

from pyspark.sql import functions as F

from changeflow.operators import publish, replay
from changeflow.options import Hooks
from changeflow.plans import pipeline
from changeflow.queries.common import OPTIONS, Log
from changeflow.queries.registry import query
from changeflow.session import scratch_path, stage
from changeflow.sinks.dump import split_digests, split_files, write_dump
from changeflow.sources import legacy, parts
from changeflow.sources.event_log import table
from changeflow.sources.state import load_state, merge_latest

SPLIT_BY = 100
SEGMENT_BYTES = 256 << 10
PLAIN = replace(OPTIONS, cleanup=False)


@query(f"""
    SELECT change_id, CAST((revision - 1) // {SPLIT_BY} + 1 AS INTEGER) AS split_id FROM t_numbered WHERE kept
""")
def split_assignment(spark, sf_dir):
    return publish.assign_splits(Log(spark, sf_dir).numbered.where("kept"), SPLIT_BY)


@query(f"""
    SELECT split_id, CAST(count(*) + 1 AS BIGINT) AS records, CAST(sum(octet_length(record)) + 31 AS BIGINT) AS bytes,
      md5(unhex(hex(encode('SVN-fs-dump-format-version: 1' || chr(10) || chr(10)))
                || string_agg(hex(record), '' ORDER BY r_change, r_part))) AS digest
    FROM (SELECT r.record, r.change_id AS r_change, r.part AS r_part, CAST((n.revision - 1) // {SPLIT_BY} + 1 AS INTEGER) AS split_id FROM t_records r
          JOIN t_numbered n ON n.change_id = r.change_id
          LEFT JOIN t_replayed p ON p.change_id = r.change_id AND p.part = r.part
          WHERE r.part = 0 OR p.allowed)
    GROUP BY split_id
""")
def dump_write_roundtrip(spark, sf_dir):
    options = replace(PLAIN, split_by=SPLIT_BY, bytes_per_segment=SEGMENT_BYTES)
    log = Log(spark, sf_dir, options)
    kept = stage(replay.keep_allowed(log.records.unionByName(log.headers)), "kept")
    out = scratch_path(spark, "dump")
    write_dump(publish.lay_out(kept, log.contents, options, log.prints), out)
    # The files themselves, their bytes in manifest order.
    return split_digests(spark, out)


def _staged_log(spark, sf_dir):
    """The derived log as stored tables, as a real job would find it."""
    from changeflow.sources.tables import ChangeLog

    log = Log(spark, sf_dir).change_log
    contents = replace(log.contents, refs=stage(log.contents.refs, "contents"))
    return ChangeLog(stage(log.changelists, "changelists"), log.file_revisions, contents, log.integrations)


@query("""
    SELECT change_id, part, path, change_action, copy_from_path, copy_from_rev FROM t_replayed WHERE allowed
""")
def incremental_equals_full(spark, sf_dir):
    log = _staged_log(spark, sf_dir)
    root = scratch_path(spark, "runs")
    last = log.changelists.agg(F.max("change_id").alias("last")).first().last
    pipeline.run_incremental(log, replace(PLAIN, to_change=last * 9 // 10), root, "run-1")
    pipeline.run_incremental(log, PLAIN, root, "run-2")
    kept = spark.read.parquet(f"{root}/run-1/kept").unionByName(spark.read.parquet(f"{root}/run-2/kept"))
    return kept.where("path is not null").select(
        "change_id", "part", "path", "change_action", "copy_from_path", "copy_from_rev"
    )


@query("""
    SELECT change_id, part, path, change_action, node_kind FROM t_nodes
""")
def restore_skips_done(spark, sf_dir):
    log = _staged_log(spark, sf_dir)
    root = scratch_path(spark, "runs")
    last = log.changelists.agg(F.max("change_id").alias("last")).first().last
    pipeline.build(log, replace(PLAIN, to_change=last // 2), root, "run")
    built = pipeline.build(log, replace(PLAIN, restore=True), root, "run")
    return built.node_records.where("path is not null").select(
        "change_id", "part", "path", "change_action", "node_kind"
    )


@query("""
    SELECT change_id, part, path, change_action, node_kind FROM t_nodes
""")
def restore_after_partial_write(spark, sf_dir):
    """A build that dies in its third step, then a restored one that makes only what is missing."""
    log = _staged_log(spark, sf_dir)
    root = scratch_path(spark, "runs")
    last = log.changelists.agg(F.max("change_id").alias("last")).first().last
    steps = replace(PLAIN, changes_per_step=last // 4 + 1)
    seen = []

    def fail(records):
        seen.append(records)
        return records.where(F.raise_error(F.lit("stopped")).isNull()) if len(seen) == 3 else records

    try:
        pipeline.build(log, replace(steps, hooks=Hooks(after_build=(fail,))), root, "run")
    except Exception as error:
        if "stopped" not in str(error):
            raise
    made = spark.read.parquet(f"{root}/run/completed")
    if made.select("batch").distinct().count() != 2:
        raise AssertionError("two finished steps were expected")
    built = pipeline.build(log, replace(steps, restore=True), root, "run")
    return built.node_records.where("path is not null").select(
        "change_id", "part", "path", "change_action", "node_kind"
    )


@query(f"""
    SELECT (SELECT max(change_id) + 1 FROM t_changes) AS change_id,
           CAST(row_number() OVER (ORDER BY path DESC) AS INTEGER) AS part, path, CAST(NULL AS INTEGER) AS revision,
           NULL AS log
    FROM t_usage WHERE usage = 0
    UNION ALL
    SELECT (SELECT max(change_id) + 1 FROM t_changes), 0, NULL, (SELECT max(revision) + 1 FROM t_numbered),
           'Deleting Empty Parent Directories'
""")
def cleanup_revision(spark, sf_dir):
    from changeflow.operators import changes, directories, nodes

    log = Log(spark, sf_dir)
    totals = changes.run_summary(log.numbered).first()
    change_id, revision = totals.last_change_id + 1, totals.last_revision + 1
    dirs = directories.number_empty_dirs(directories.dir_usage(log.wanted_events))
    rows = nodes.cleanup_nodes(dirs, change_id).unionByName(
        nodes.cleanup_header(change_id, revision, log.numbered, OPTIONS)
    )
    return rows.select("change_id", "part", "path", "revision", F.col("props")["svn:log"].alias("log"))


@query("""
    SELECT change_id, part, path, change_action FROM t_replayed WHERE allowed
    UNION ALL
    SELECT (SELECT max(change_id) + 1 FROM t_changes), part, path, 'Delete' FROM (
      SELECT path, CAST(row_number() OVER (ORDER BY path DESC) AS INTEGER) AS part FROM t_usage WHERE usage = 0)
    WHERE path IN (SELECT path FROM t_nodes WHERE node_kind = 'dir')
""")
def full_run_kept_records(spark, sf_dir):
    log = _staged_log(spark, sf_dir)
    root = scratch_path(spark, "runs")
    pipeline.run(log, OPTIONS, root, "run")
    return spark.read.parquet(f"{root}/run/kept").where("path is not null").select(
        "change_id", "part", "path", "change_action"
    )


@query("""
    SELECT 'run-2' AS run_id, max(change_id) AS last_change_id, max(revision) + 2 AS last_revision,
           (SELECT count(*) FROM t_numbered) AS known_changes
    FROM t_numbered
""")
def incremental_run_meta(spark, sf_dir):
    # With cleanup on, each run takes one extra revision, and the next run counts on from it.
    log = _staged_log(spark, sf_dir)
    root = scratch_path(spark, "runs")
    last = log.changelists.agg(F.max("change_id").alias("last")).first().last
    pipeline.run_incremental(log, replace(OPTIONS, to_change=last * 9 // 10), root, "run-1")
    pipeline.run_incremental(log, OPTIONS, root, "run-2")
    state = load_state(spark, root)
    return state.revision_map.agg(F.count("*").alias("known_changes")).select(
        F.lit(state.run_id).alias("run_id"), F.lit(state.last_change_id).alias("last_change_id"),
        F.lit(state.last_revision).alias("last_revision"), "known_changes",
    )


@query("""
    SELECT c_custkey AS change_id, CAST(coalesce(n, -1) AS BIGINT) AS value FROM customer
    LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey) ON o_custkey = c_custkey
""")
def state_merge_latest(spark, sf_dir):
    old = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("change_id"), F.lit(-1).cast("long").alias("value"))
    new = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("change_id")).agg(F.count("*").alias("value"))
    return merge_latest(old, new, "change_id", "value").join(old.select("change_id"), "change_id", "left_semi")


@query("""
    SELECT 'tmp/' || page_id || '/1' AS key, split_part(url, ':', 1) AS path, split_part(url, ':', 2) AS action,
           url AS whole_path, 'Add' AS whole_action
    FROM pages
""")
def legacy_state_pairs(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select(
        F.concat(F.lit("tmp/"), F.col("page_id").cast("string"), F.lit("/1")).alias("key"),
        F.concat("url", F.lit(":Add")).alias("value"),
    )
    folder = scratch_path(spark, "legacy")
    legacy.export_pairs(pages, "key", "value", folder)
    pairs = legacy.read_pairs(spark, folder)
    cut = legacy.split_path_action(pairs).withColumnRenamed("change_action", "action")
    whole = legacy.split_path_action(pairs, "corrected").toDF("key", "whole_path", "whole_action")
    return cut.join(whole, "key")


@query("""
    SELECT CAST(change_id AS INTEGER) AS change_id, CAST(revision AS INTEGER) AS revision FROM t_numbered WHERE change_id % 9 <> 0
    UNION ALL SELECT NULL, CAST(revision AS INTEGER) FROM t_numbered WHERE change_id % 9 = 0
""")
def legacy_revision_map_casts(spark, sf_dir):
    """An old revision map read back; keys that are not whole numbers become NULL."""
    numbered = Log(spark, sf_dir).numbered
    key = F.when(F.col("change_id") % 9 == 0, F.concat(F.lit("x"), F.col("change_id").cast("string")))
    root = scratch_path(spark, "legacy-root")
    rows = numbered.select(F.coalesce(key, F.col("change_id").cast("string")).alias("key"), "revision")
    legacy.export_pairs(rows, "key", "revision", f"{root}/revisionByChangeListId")
    for name in ("files", "dirsUsage", "fileStatuses"):
        legacy.export_pairs(rows.limit(0), "key", "revision", f"{root}/{name}")
    legacy.export_list(numbered, "change_id", f"{root}/changeLists")
    return legacy.import_legacy_state(spark, root)["revision_map"]


@query("""
    SELECT change_id, part, md5(html) AS digest, octet_length(encode(html)) AS bytes FROM (
      SELECT page_id // 5 + 1 AS change_id, page_id % 5 AS part, html, page_id % 7 = 0 AS unrecorded,
             row_number() OVER (PARTITION BY page_id % 50, page_id % 7 = 0 ORDER BY page_id) AS n FROM pages)
    WHERE unrecorded OR n = 1
    UNION ALL SELECT -1, -1, md5('SVN-fs-dump-format-version: 1' || chr(10) || chr(10)), 31
""")
def legacy_parts_assembled(spark, sf_dir):
    """An old dump tree written by tasks, discovered, joined with its recorded paths and actions, and replayed."""
    root = scratch_path(spark, "old-dump")
    pages = table(spark, sf_dir, "pages").select(
        (F.expr("page_id div 5") + 1).cast("int").alias("change_id"), (F.col("page_id") % 5).cast("int").alias("part"),
        F.encode("html", "UTF-8").alias("record"), "page_id",
    )
    parts.export_parts(pages, root).agg(F.sum("length")).collect()
    recorded = pages.where("page_id % 7 <> 0").select(
        F.concat(F.lit(f"{root}/"), F.col("change_id").cast("string"), F.lit("/"), F.col("part").cast("string")).alias("key"),
        F.concat(F.lit("p"), (F.col("page_id") % 50).cast("string"), F.lit(":Add")).alias("value"),
    )
    legacy.write_map(recorded, f"{root}/files")
    for name in ("dirsUsage", "fileStatuses", "revisionByChangeListId"):
        legacy.write_map(recorded.limit(0), f"{root}/{name}")
    legacy.export_list(pages.limit(0), "change_id", f"{root}/changeLists")
    rows = legacy.assemble_parts(spark, root, PLAIN)
    return rows.select(
        F.col("change_id").cast("long").alias("change_id"), F.col("part").cast("long").alias("part"),
        F.md5("record").alias("digest"), F.octet_length("record").cast("long").alias("bytes"),
    )


@query("""
    SELECT CAST(c_custkey // 100 AS BIGINT) AS segment, sum(octet_length(encode(c_name))) AS bytes,
           md5(string_agg(c_name, '' ORDER BY c_custkey)) AS digest
    FROM customer WHERE c_custkey % 2 = 0 GROUP BY 1
""")
def dump_replaces_target(spark, sf_dir):
    """A dump written over an earlier, larger one: every file found in the folder belongs to the new one."""
    out = scratch_path(spark, "dump")
    rows = table(spark, sf_dir, "customer").select(
        F.lit(0).alias("split_id"), F.expr("c_custkey div 100").alias("segment"),
        F.col("c_custkey").cast("int").alias("change_id"), F.lit(0).alias("part"), F.encode("c_name", "UTF-8").alias("record"),
    )
    write_dump(rows, out)
    write_dump(rows.where("change_id % 2 = 0"), out)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "dump-*").load(out)
    segment = F.regexp_extract("path", r"dump-(\d+)-", 1).cast("long").alias("segment")
    return files.select(segment, F.col("length").alias("bytes"), F.md5("content").alias("digest"))


@query(f"""
    SELECT 'dump' || split_id AS file, CAST(sum(octet_length(record)) + 31 AS BIGINT) AS bytes,
      md5(unhex(hex(encode('SVN-fs-dump-format-version: 1' || chr(10) || chr(10)))
                || string_agg(hex(record), '' ORDER BY change_id))) AS digest
    FROM (SELECT h.change_id, h.record, CAST((n.revision - 1) // {SPLIT_BY} + 1 AS INTEGER) AS split_id
          FROM t_records h JOIN t_numbered n ON n.change_id = h.change_id WHERE h.part = 0)
    GROUP BY split_id
""")
def dump_split_files(spark, sf_dir):
    """Headers alone, many segments per split, composed into one file per split."""
    options = replace(PLAIN, split_by=SPLIT_BY, bytes_per_segment=2_048)
    log = Log(spark, sf_dir, options)
    out = scratch_path(spark, "dump")
    write_dump(publish.lay_out(log.headers, log.contents, options, log.prints), out)
    split_files(spark, out)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "dump[0-9]*").load(out)
    named = files.withColumn("file", F.element_at(F.split("path", "/"), -1)).where(~F.col("file").contains("-"))
    return named.select("file", F.col("length").alias("bytes"), F.md5("content").alias("digest"))


@query("""
    SELECT c_custkey AS key, CASE WHEN c_custkey % 3 = 0 THEN CAST(round(c_acctbal * 100) AS BIGINT)
                                  WHEN c_custkey % 3 = 1 THEN NULL ELSE -c_custkey END AS value FROM customer
""")
def map_codec_and_defaults(spark, sf_dir):
    """A map file of whole numbers; values that are none read as NULL, absent keys get a default made of the key."""
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("long").alias("key"), "c_acctbal")
    stored = customers.where("key % 3 <> 2").select(
        "key", F.when(F.col("key") % 3 == 0, F.round(F.col("c_acctbal") * 100).cast("long").cast("string")).otherwise("none").alias("value")
    )
    path = scratch_path(spark, "map")
    legacy.write_map(stored, path, legacy.LONG, legacy.TEXT)
    return legacy.with_default(customers, legacy.read_map(spark, path, legacy.LONG, legacy.LONG), lambda key: -key)


@query("""
    SELECT o_orderkey * 1000003 * 1000003 - 4000000000000000000 AS id,
           CAST(sum(o_custkey + o_orderkey % 7) OVER (ORDER BY o_orderkey) AS BIGINT) AS upto FROM orders
""")
def wide_prefix_sum(spark, sf_dir):
    """Running sums over sparse 64-bit ids, negative ones included."""
    from changeflow.operators.numbering import prefix_sum

    key = F.col("o_orderkey").cast("long")
    rows = table(spark, sf_dir, "orders").select(
        (key * F.lit(1000003).cast("long") * F.lit(1000003).cast("long") - F.lit(4000000000000000000).cast("long")).alias("id"),
        (F.col("o_custkey") + key % 7).alias("n"),
    )
    return prefix_sum(rows, "id", F.col("n"), "upto").select("id", "upto")
