"""Node records, their properties, content and bytes."""

from dataclasses import replace

from pyspark.sql import functions as F

from changeflow.functions.records import property_block, property_map
from changeflow.functions.text import change_log_text, gmt_date, munge_keywords
from changeflow.operators import lineage, nodes, publish
from changeflow.operators.replay import keep_allowed
from changeflow.queries.common import OPTIONS, Log
from changeflow.queries.registry import query
from changeflow.queries.sqlbase import GMT, KEYWORD_WORDS
from changeflow.sources.event_log import KEYWORD_LINE, table


@query("""
    SELECT change_id, part, path, change_action, node_kind, copy_from_path, copy_from_rev,
      CASE WHEN change_action IN ('Add', 'Add Copy') THEN 'add' WHEN change_action = 'Delete' THEN 'delete'
           WHEN change_action = 'Edit' THEN 'change' ELSE 'replace' END AS node_action,
      CAST(NULL AS INTEGER) AS revision FROM t_nodes
    UNION ALL
    SELECT change_id, 0, NULL, NULL, NULL, NULL, NULL, NULL, revision FROM t_headers
""")
def node_records_all(spark, sf_dir):
    log = Log(spark, sf_dir)
    return log.nodes.unionByName(log.headers).select(
        "change_id", "part", "path", "change_action", "node_kind", "copy_from_path", "copy_from_rev",
        "node_action", "revision",
    )


@query("""
    SELECT change_id, part, path, change_action, CAST(octet_length(content) AS INTEGER) AS n_bytes, md5(content) AS digest,
           block
    FROM t_texts WHERE file_type = 'symlink' AND content IS NOT NULL AND action <> 'PURGE'
""")
def symlink_nodes(spark, sf_dir):
    log = Log(spark, sf_dir)
    rows = publish.with_content(log.nodes.where(F.col("content_form") == "symlink"), log.contents, OPTIONS)
    return rows.select(
        "change_id", "part", "path", "change_action", F.octet_length("content").alias("n_bytes"),
        F.md5("content").alias("digest"), property_block(F.col("props")).alias("block"),
    )


@query("""
    SELECT change_id, part, path, change_action, md5(content) AS digest, block FROM t_texts WHERE action = 'PURGE'
""")
def purge_nodes(spark, sf_dir):
    log = Log(spark, sf_dir)
    rows = log.nodes.where(F.col("content_form") == "placeholder")
    return publish.with_content(rows, log.contents, OPTIONS).select(
        "change_id", "part", "path", "change_action", F.md5("content").alias("digest"),
        property_block(F.col("props")).alias("block"),
    )


@query(f"""
    SELECT * FROM (
      SELECT change_id, file_ord, 'svn:keywords' AS key, '{KEYWORD_WORDS}' AS value
      FROM t_wanted WHERE file_type = 'k'
      UNION ALL SELECT change_id, file_ord, 'svn:executable', 'on' FROM t_wanted WHERE file_type IN ('x', '+kx')
      UNION ALL SELECT change_id, file_ord, 'svn:eol-style', 'native' FROM t_wanted
                WHERE file_type IN ('text', 'unicode')
      UNION ALL SELECT change_id, file_ord, 'svn:special', '*' FROM t_wanted WHERE file_type = 'symlink')
""")
def property_map_rows(spark, sf_dir):
    kind = F.col("file_type")
    props = property_map(kind, replace(OPTIONS, convert_eol=True), kind.contains("symlink"))
    rows = Log(spark, sf_dir).wanted_events
    return rows.select("change_id", "file_ord", F.explode(props).alias("key", "value"))


@query("""
    SELECT change_id, part, block, CAST(octet_length(encode(block)) + 1 AS INTEGER) AS prop_length
    FROM t_props WHERE change_action IN ('Add', 'Edit') AND node_kind = 'file'
""")
def property_blocks(spark, sf_dir):
    rows = Log(spark, sf_dir).nodes.where(F.col("content_form").isNotNull())
    block = property_block(F.col("props"))
    return rows.select(
        "change_id", "part", block.alias("block"), (F.octet_length(block) + 1).alias("prop_length")
    )


@query(f"""
    SELECT doc_id, md5(encode(m)) AS digest, CAST(octet_length(encode(m)) AS INTEGER) AS n_bytes FROM (
      SELECT doc_id, replace(replace(replace(replace(t, 'Author', 'LastChangedBy'), 'Date', 'LastChangedDate'),
          'Revision', 'LastChangedRevision'), 'File', 'HeadURL') AS m
      FROM (SELECT doc_id, '{KEYWORD_LINE}' || chr(10) || text AS t FROM documents))
""")
def keyword_munge(spark, sf_dir):
    content = F.concat(F.lit(KEYWORD_LINE + "\n"), F.col("text")).cast("binary")
    munged = munge_keywords(content)
    return table(spark, sf_dir, "documents").select(
        "doc_id", F.md5(munged).alias("digest"), F.octet_length(munged).alias("n_bytes")
    )


@query("""
    SELECT depot_path, rev, missing, CAST(octet_length(content) AS INTEGER) AS n_bytes, md5(content) AS digest FROM t_contents
""")
def missing_content_fallback(spark, sf_dir):
    return lineage.load_content(Log(spark, sf_dir).contents).select(
        "depot_path", "rev", "missing", F.octet_length("content").alias("n_bytes"), F.md5("content").alias("digest")
    )


@query("SELECT change_id, revision, log, author, date FROM t_headers")
def header_fields(spark, sf_dir):
    return Log(spark, sf_dir).headers.select(
        "change_id", "revision", F.col("props")["svn:log"].alias("log"),
        F.col("props")["svn:author"].alias("author"), F.col("props")["svn:date"].alias("date"),
    )


@query(f"""
    SELECT event_id, {GMT.format(ts="(ts AT TIME ZONE 'America/New_York') AT TIME ZONE 'UTC'")} AS date
    FROM events
""")
def gmt_dates(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id", gmt_date(F.col("ts"), "America/New_York").alias("date")
    )


@query("""
    SELECT change_id, description || chr(10) || 'Converted from original Perforce changelist ' || change_id AS log
    FROM t_changes
""")
def description_suffix(spark, sf_dir):
    log = change_log_text(F.col("description"), F.col("change_id"), add_info=True)
    return Log(spark, sf_dir).changelists.select("change_id", log.alias("log"))


@query("""
    SELECT doc_id, CAST(octet_length(encode(text)) AS INTEGER) AS text_length, md5(text) AS digest,
           CAST(octet_length(encode('PROPS-END')) + 1 AS INTEGER) AS prop_length,
           CAST(octet_length(encode(text)) + 10 AS INTEGER) AS content_length
    FROM documents
""")
def content_lengths_md5(spark, sf_dir):
    props = F.octet_length(property_block(F.lit(None).cast("map<string,string>"))) + 1
    size = F.octet_length("text")
    return table(spark, sf_dir, "documents").select(
        "doc_id", size.alias("text_length"), F.md5(F.col("text").cast("binary")).alias("digest"),
        props.alias("prop_length"), (props + size).alias("content_length"),
    )


@query("SELECT change_id, part, CAST(octet_length(record) AS INTEGER) AS n_bytes, md5(record) AS digest FROM t_records")
def dump_record_bytes(spark, sf_dir):
    log = Log(spark, sf_dir)
    records = publish.serialise(log.nodes.unionByName(log.headers), log.contents, OPTIONS)
    return records.select(
        "change_id", "part", F.octet_length("record").alias("n_bytes"), F.md5("record").alias("digest")
    )


@query("""
    SELECT r.change_id, r.part, md5(record) AS digest FROM t_records r
    LEFT JOIN t_replayed p ON p.change_id = r.change_id AND p.part = r.part
    WHERE r.part = 0 OR p.allowed
""")
def kept_record_bytes(spark, sf_dir):
    log = Log(spark, sf_dir)
    kept = keep_allowed(log.records.unionByName(log.headers))
    return publish.serialise(kept, log.contents, OPTIONS).select(
        "change_id", "part", F.md5("record").alias("digest")
    )


@query(f"""
    SELECT change_id, part, md5(encode(munged)) AS digest FROM (
      SELECT change_id, part, replace(replace(replace(replace(t, 'Author', 'LastChangedBy'),
          'Date', 'LastChangedDate'), 'Revision', 'LastChangedRevision'), 'File', 'HeadURL') AS munged
      FROM (SELECT n.change_id, n.part, CASE WHEN c.missing THEN decode(c.content)
                     ELSE '{KEYWORD_LINE}' || chr(10) || decode(c.content) END AS t
            FROM t_nodes n JOIN t_contents c USING (depot_path, rev)
            WHERE n.change_action IN ('Add', 'Edit') AND n.action <> 'PURGE'
              AND n.file_type IN ('text', 'unicode')))
""")
def munged_text_nodes(spark, sf_dir):
    options = replace(OPTIONS, munge_keywords=True)
    # The keyword line changes contents and so which revisions count as copies; records come from
    # the plain log, and only their text is looked up with the line added.
    plain, marked = Log(spark, sf_dir, options), Log(spark, sf_dir, options, keyword_line=True)
    rows = plain.nodes.where(F.col("content_form") == "text")
    return publish.with_content(rows, marked.contents, options).select(
        "change_id", "part", F.md5("content").alias("digest")
    )
