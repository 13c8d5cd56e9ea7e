"""Copy sources and content identity."""

from dataclasses import replace

from pyspark.sql import functions as F

from changeflow.operators import lineage
from changeflow.queries.common import OPTIONS, Log
from changeflow.queries.registry import query
from changeflow.session import stage
from changeflow.sources.event_log import fingerprints, table


@query("SELECT to_path, to_rev, from_path, from_rev FROM t_picks")
def integration_source_pick(spark, sf_dir):
    return lineage.pick_sources(Log(spark, sf_dir).integrations)


@query("""
    SELECT to_path, to_rev, arg_min(from_path, seq) AS from_path, arg_min(end_from_rev, seq) AS from_rev
    FROM t_integrations WHERE contains(how_from, 'from') AND from_path IS NOT NULL AND end_from_rev <> 0
    GROUP BY to_path, to_rev
""")
def integration_source_corrected(spark, sf_dir):
    return lineage.pick_sources(Log(spark, sf_dir).integrations, "corrected")


@query("""
    SELECT i.to_path, i.to_rev, i.seq, i.how_from FROM t_integrations i
    WHERE (to_path, to_rev) IN (SELECT (depot_path, rev) FROM t_files WHERE file_ord % 2 = 0)
""")
def history_of_single_revisions(spark, sf_dir):
    # Odd file rows come back with two revisions, so their history is not used.
    log = Log(spark, sf_dir)
    nested = log.integrations.groupBy("to_path", "to_rev").agg(
        F.array_sort(F.collect_list(F.struct("seq", "how_from", "from_path", "end_from_rev"))).alias("rows")
    )
    entries = log.revised.select(
        F.col("depot_path").alias("to_path"), F.col("rev").alias("to_rev"),
        F.when(F.col("file_ord") % 2 == 0, 1).otherwise(2).alias("_copies"),
    )
    history = nested.join(entries, ["to_path", "to_rev"]).select(
        F.col("to_path").alias("asked_path"), F.col("to_rev").alias("asked_rev"),
        F.col("to_path").alias("entry_path"),
        F.explode(F.sequence(F.lit(1), F.col("_copies"))).alias("entry_rev"),
        F.transform("rows", lambda r: F.struct(r["seq"].alias("row_seq"), r["how_from"].alias("how_from"))).alias("integrations"),
    )
    return lineage.single_history(history).select(
        "to_path", "to_rev", F.col("row_seq").alias("seq"), "how_from"
    )


@query("""
    SELECT p.*, f.change_id AS from_change_id FROM t_picks p
    JOIN t_files f ON f.depot_path = p.from_path AND f.rev = p.from_rev
""")
def copy_source_lookup(spark, sf_dir):
    log = Log(spark, sf_dir)
    return lineage.find_source_changes(lineage.pick_sources(log.integrations), log.files)


@query("""
    SELECT f.depot_path, f.rev, f.change_id, coalesce(n.revision, 0) AS revision FROM t_files f
    LEFT JOIN (SELECT * FROM t_numbered WHERE kept) n ON n.change_id = f.change_id
""")
def source_revision_default0(spark, sf_dir):
    log = Log(spark, sf_dir)
    return lineage.with_revision(
        log.files.select("depot_path", "rev", "change_id"), log.revisions.where("revision > 0")
    )


@query("""
    SELECT p.to_path, p.to_rev, a.content = b.content AS identical FROM t_picks p
    JOIN t_contents a ON a.depot_path = p.to_path AND a.rev = p.to_rev
    JOIN t_contents b ON b.depot_path = p.from_path AND b.rev = p.from_rev
""")
def content_identity(spark, sf_dir):
    log = Log(spark, sf_dir)
    prints = stage(fingerprints(spark, sf_dir, log.revised), "fingerprints")
    targets = prints.toDF("to_path", "to_rev", "to_bytes", "to_digest")
    sources = prints.toDF("from_path", "from_rev", "from_bytes", "from_digest")
    same = lineage.same_content(
        F.col("to_bytes"), F.col("to_digest"), F.col("from_bytes"), F.col("from_digest")
    )
    asked = lineage.pick_sources(log.integrations).join(targets, ["to_path", "to_rev"])
    met = asked.join(sources, ["from_path", "from_rev"])
    return met.select("to_path", "to_rev", same.alias("identical"))


@query("""
    SELECT md5(text) AS digest, CAST(octet_length(encode(text)) AS INTEGER) AS n_bytes, count(*) AS n_copies,
           min(doc_id) AS first_doc
    FROM documents GROUP BY text HAVING count(*) > 1
""")
def duplicate_documents(spark, sf_dir):
    # Counted per digest, so a large group of copies folds to one row per task.
    return (
        table(spark, sf_dir, "documents")
        .select("doc_id", F.md5(F.col("text").cast("binary")).alias("digest"), F.octet_length("text").alias("n_bytes"))
        .groupBy("digest", "n_bytes")
        .agg(F.count("*").alias("n_copies"), F.min("doc_id").alias("first_doc"))
        .where("n_copies > 1")
    )


def _decision(spark, sf_dir, action):
    log = Log(spark, sf_dir)
    rows = log.wanted.where(F.col("action") == action).select("change_id", "file_ord", "svn_path")
    return rows.join(log.copies, ["change_id", "file_ord"], "left").withColumn(
        "is_copy", F.col("copy_from_path").isNotNull()
    )


_DECISION_SQL = """
    SELECT change_id, file_ord, svn_path, copy_from_path, copy_from_rev, copy_from_path IS NOT NULL AS is_copy
    FROM t_wanted LEFT JOIN t_copies USING (change_id, file_ord) WHERE action = '{}'
"""


@query(_DECISION_SQL.format("BRANCH"))
def copy_decision_branch(spark, sf_dir):
    return _decision(spark, sf_dir, "BRANCH")


@query(_DECISION_SQL.format("INTEGRATE"))
def copy_decision_integrate(spark, sf_dir):
    return _decision(spark, sf_dir, "INTEGRATE")


@query("""
    SELECT t.change_id, t.file_ord, s.svn_path AS copy_from_path, n.revision AS copy_from_rev
    FROM t_wanted t
    JOIN (SELECT to_path, to_rev, arg_min(from_path, seq) AS from_path, arg_min(end_from_rev, seq) AS from_rev
          FROM t_integrations WHERE contains(how_from, 'from') AND end_from_rev <> 0
          GROUP BY to_path, to_rev) p ON p.to_path = t.depot_path AND p.to_rev = t.rev
    JOIN t_wanted s ON s.depot_path = p.from_path AND s.rev = p.from_rev
    JOIN t_numbered n ON n.change_id = s.change_id AND n.revision <> 0
    JOIN t_contents a ON a.depot_path = t.depot_path AND a.rev = t.rev
    JOIN t_contents b ON b.depot_path = s.depot_path AND b.rev = s.rev
    WHERE a.content = b.content AND s.change_id < t.change_id
""")
def copy_decision_corrected(spark, sf_dir):
    return Log(spark, sf_dir, replace(OPTIONS, semantics="corrected")).copies
