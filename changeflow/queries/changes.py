"""Selecting, mapping and numbering changes."""

from dataclasses import replace

from pyspark.sql import functions as F

from changeflow.functions import filetypes
from changeflow.functions.paths import map_paths, map_prefix
from changeflow.functions.text import byte_length
from changeflow.operators import changes, nodes
from changeflow.operators.numbering import identity_numbers, serial_numbers
from changeflow.operators.skew import running, segment_of
from changeflow.options import Branch, Hooks
from changeflow.queries.common import OPTIONS, Log
from changeflow.queries.registry import query
from changeflow.sources.event_log import table
from changeflow.session import scratch_path
from changeflow.sources import nested
from changeflow.sources.tables import change_details, changes_touching


@query("""
    SELECT CAST(o_orderkey AS INTEGER) AS change_id, 'u' || o_custkey AS username,
           o_orderpriority AS description
    FROM orders WHERE o_orderkey > 100 AND o_orderkey <= 1000000000
""")
def changelist_range_filter(spark, sf_dir):
    orders = changes.in_range(table(spark, sf_dir, "orders"), 100, 1_000_000_000, "o_orderkey")
    return orders.select(
        F.col("o_orderkey").cast("int").alias("change_id"),
        F.concat(F.lit("u"), F.col("o_custkey").cast("string")).alias("username"),
        F.col("o_orderpriority").alias("description"),
    )


@query("""
    SELECT o_custkey AS change_id, max(o_orderkey) AS seen, arg_max(o_orderstatus, o_orderkey) AS status,
           arg_max(o_orderpriority, o_orderkey) AS description
    FROM orders GROUP BY o_custkey
""")
def changelist_dedup_last(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("change_id"), F.col("o_orderkey").alias("seen"),
        F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("description"),
    )
    return changes.last_per_key(rows, "change_id", "seen")


@query("SELECT change_id, username, description FROM t_changes WHERE change_id IN (SELECT change_id FROM t_wanted)")
def changes_under_branches(spark, sf_dir):
    log = Log(spark, sf_dir)
    return changes_touching(log.changelists, log.events, OPTIONS).select("change_id", "username", "description")


@query("""
    SELECT change_id, file_ord, username, depot_path, action
    FROM t_files JOIN t_changes USING (change_id)
""")
def changelist_details(spark, sf_dir):
    log = Log(spark, sf_dir)
    return change_details(log.changelists, log.events).select(
        "change_id", "file_ord", "username", "depot_path", "action"
    )


@query("SELECT change_id, file_ord, svn_path FROM t_wanted")
def prefix_map(spark, sf_dir):
    return Log(spark, sf_dir).wanted_events.select("change_id", "file_ord", "svn_path")


OVERLAP = (
    Branch("//depot/", "all/", 5),
    Branch("//depot/main/", "trunk/", 1),
    Branch("//depot/main/u1", "users/one", 1),
    Branch("//depot/re", "re-", 3),
)


@query("""
    SELECT change_id, file_ord, CASE
        WHEN starts_with(depot_path, '//depot/main/u1') THEN 'users/one' || substr(depot_path, 16)
        WHEN starts_with(depot_path, '//depot/main/') THEN 'trunk/' || substr(depot_path, 14)
        WHEN starts_with(depot_path, '//depot/re') THEN 're-' || substr(depot_path, 11)
        ELSE 'all/' || substr(depot_path, 9) END AS svn_path
    FROM t_rows
""")
def prefix_map_overlap(spark, sf_dir):
    path = map_prefix(F.col("depot_path"), OVERLAP)
    return Log(spark, sf_dir).events.select("change_id", "file_ord", path.alias("svn_path"))


@query("""
    SELECT DISTINCT depot_path,
      'm' || (CAST(regexp_extract(depot_path, '^//depot/[a-z]+/u([0-9]+)/', 1) AS INTEGER)) || '/'
          || regexp_replace(depot_path, '^//depot/[a-z]+/u[0-9]+/', '') AS svn_path
    FROM t_rows
""")
def prefix_map_many(spark, sf_dir):
    # One branch per (root, user): a table that grows with the data.
    log = Log(spark, sf_dir)
    prefix = F.regexp_extract("depot_path", "^//depot/[a-z]+/u([0-9]+)/", 0)
    user = F.regexp_extract("depot_path", "^//depot/[a-z]+/u([0-9]+)/", 1)
    rows = log.events.select(
        prefix.alias("depot_prefix"), F.concat(F.lit("m"), user, F.lit("/")).alias("target_prefix"),
        F.lit(0).alias("priority"),
    ).distinct()
    return map_paths(log.events.select("depot_path").distinct(), rows)


@query("""
    SELECT doc_id, 'trunk/' || replace(lang || chr(160) || source || chr(160) || doc_id, chr(160),
                                       chr(194) || chr(160)) || '.txt' AS svn_path
    FROM documents
""")
def nbsp_fix(spark, sf_dir):
    nbsp = F.lit("\u00a0")
    path = F.concat(
        F.lit("//depot/main/"), "lang", nbsp, "source", nbsp, F.col("doc_id").cast("string"), F.lit(".txt")
    )
    mapped = map_prefix(path, OPTIONS.branches)
    return table(spark, sf_dir, "documents").select("doc_id", mapped.alias("svn_path"))


@query("SELECT change_id, file_ord, depot_path, action FROM t_wanted")
def wanted_files(spark, sf_dir):
    return Log(spark, sf_dir).wanted_events.select("change_id", "file_ord", "depot_path", "action")


@query("SELECT change_id FROM t_marked WHERE NOT kept")
def empty_changelists(spark, sf_dir):
    log = Log(spark, sf_dir)
    return changes.empty_changes(log.changelists, log.wanted_events)


@query("""
    SELECT o_orderkey AS change_id, coalesce(n, 0) AS n_files, coalesce(n, 0) > 0 AS kept FROM orders
    LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY l_orderkey) ON l_orderkey = o_orderkey
""")
def orders_without_lines(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("change_id"))
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("change_id"))
    return changes.mark_kept(orders, lines)


@query("""
    SELECT change_id, file_ord, action,
      CASE WHEN action IN ('ADD', 'PURGE', 'BRANCH') THEN 'Add' WHEN action = 'DELETE' THEN 'Delete'
           ELSE 'Edit' END AS change_action,
      CASE WHEN action IN ('ADD', 'PURGE', 'BRANCH') THEN 'add' WHEN action = 'DELETE' THEN 'delete'
           ELSE 'change' END AS node_action
    FROM t_wanted
""")
def action_routing(spark, sf_dir):
    change = nodes.change_action(F.col("action"), F.lit(False))
    return Log(spark, sf_dir).wanted_events.select(
        "change_id", "file_ord", "action", change.alias("change_action"),
        nodes.node_action(change).alias("node_action"),
    )


@query("""
    SELECT change_id, file_ord, action, 'unknown action' AS reason,
      '{"change_id":' || change_id || ',"file_ord":' || file_ord || ',"depot_path":"' || depot_path
        || '","action":"ARCHIVE","file_type":"' || file_type || '","svn_path":"' || svn_path || '"}' AS context
    FROM (SELECT * REPLACE ('ARCHIVE' AS action) FROM t_wanted WHERE action = 'EDIT')
""")
def unknown_action_rejects(spark, sf_dir):
    action = F.when(F.col("action") == "EDIT", "ARCHIVE").otherwise(F.col("action"))
    return nodes.rejects(Log(spark, sf_dir).wanted_events.withColumn("action", action))


TYPES = (
    "k", "ktext", "text+k", "+k", "+xk", "text", "unicode", "text+x", "xtext", "x", "kx", "+x", "cx",
    "xbinary+k", "symlink+x",
)


def _type_flags(spark, sf_dir, semantics):
    kind = F.get(F.array(*[F.lit(t) for t in TYPES]), (F.col("event_id") % len(TYPES)).cast("int"))
    rows = table(spark, sf_dir, "events").select("event_id", kind.alias("file_type"))
    return rows.select(
        "event_id", "file_type",
        filetypes.expands_keywords(F.col("file_type"), semantics).alias("keywords"),
        filetypes.is_executable(F.col("file_type"), semantics).alias("executable"),
        filetypes.is_text(F.col("file_type")).alias("is_text"),
        filetypes.is_symlink(F.col("file_type")).alias("is_symlink"),
    )


_TYPE_SQL = """
    SELECT event_id, file_type, {keywords} AS keywords, {executable} AS executable,
           file_type IN ('text', 'unicode') AS is_text, contains(file_type, 'symlink') AS is_symlink
    FROM (SELECT event_id, %s[CAST(event_id %% %d AS INTEGER) + 1] AS file_type FROM events)
""" % (list(TYPES), len(TYPES))


@query(_TYPE_SQL.format(
    keywords="regexp_full_match(file_type, 'k') OR regexp_full_match(file_type, '\\+.*k')",
    executable="regexp_full_match(file_type, '[cku]?x') OR regexp_full_match(file_type, '\\+.*x')",
))
def type_flags_faithful(spark, sf_dir):
    return _type_flags(spark, sf_dir, "faithful")


@query(_TYPE_SQL.format(
    keywords="regexp_matches(file_type, '^k') OR regexp_matches(file_type, '\\+.*k')",
    executable="regexp_matches(file_type, '^[cku]?x') OR regexp_matches(file_type, '\\+.*x')",
))
def type_flags_corrected(spark, sf_dir):
    return _type_flags(spark, sf_dir, "corrected")


@query("SELECT change_id, revision FROM t_numbered")
def revision_numbering(spark, sf_dir):
    return Log(spark, sf_dir).revisions


@query("SELECT change_id, revision FROM t_numbered")
def duplicate_changelists_numbered(spark, sf_dir):
    """Every third changelist is logged twice; the job gives it one number."""
    from changeflow.plans.pipeline import plan

    log = Log(spark, sf_dir)
    again = log.changelists.where("change_id % 3 = 0").withColumn("description", F.lit("logged again"))
    twice = replace(log.change_log, changelists=log.changelists.unionByName(again))
    return plan(twice, log.options).numbered.select("change_id", "revision")


@query("""
    SELECT change_id, CAST(CASE WHEN n > 0 THEN count(*) FILTER (n > 0) OVER (ORDER BY change_id) ELSE 0 END AS INTEGER)
        AS revision
    FROM (SELECT c.change_id, count(w.file_ord) AS n FROM t_changes c
          LEFT JOIN (SELECT * FROM t_wanted WHERE action <> 'DELETE') w ON w.change_id = c.change_id
          WHERE c.change_id % 5 <> 0 GROUP BY c.change_id)
""")
def hooks_reshape_a_plan(spark, sf_dir):
    """Hooks drop every fifth changelist and all deletions before anything is numbered."""
    from changeflow.plans.pipeline import plan

    hooks = Hooks(
        on_changelist=(lambda df: df.where("change_id % 5 <> 0"),), on_file=(lambda df: df.where("action <> 'DELETE'"),)
    )
    log = Log(spark, sf_dir)
    return plan(log.change_log, replace(log.options, hooks=hooks)).numbered.select("change_id", "revision")


@query("SELECT doc_id, CAST(length(text) AS INTEGER) AS narrow, CAST(octet_length(encode(text)) AS INTEGER) AS wide FROM documents")
def charset_lengths(spark, sf_dir):
    """Byte lengths in a one-byte charset and in UTF-8."""
    text = F.col("text")
    return table(spark, sf_dir, "documents").select(
        "doc_id", byte_length(text, "ISO-8859-1").alias("narrow"), byte_length(text).alias("wide")
    )


@query("SELECT change_id, CAST(CASE WHEN kept THEN revision + 1000 ELSE 0 END AS INTEGER) AS revision FROM t_numbered")
def revision_numbering_with_base(spark, sf_dir):
    return serial_numbers(Log(spark, sf_dir).marked, 1000).select("change_id", "revision")


@query("SELECT change_id, CASE WHEN kept THEN change_id ELSE 0 END AS revision FROM t_marked")
def identity_numbering(spark, sf_dir):
    return identity_numbers(Log(spark, sf_dir).marked).select("change_id", "revision")


@query("""
    SELECT CAST(o_orderkey AS INTEGER) AS change_id,
      CAST(CASE WHEN o_orderstatus <> 'F' THEN count(*) FILTER (o_orderstatus <> 'F') OVER (ORDER BY o_orderkey)
           ELSE 0 END AS INTEGER) AS revision
    FROM orders
""")
def order_numbering(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("int").alias("change_id"), (F.col("o_orderstatus") != "F").alias("kept")
    )
    return serial_numbers(rows).select("change_id", "revision")


@query("""
    SELECT conv_id, turn, role, row_number() OVER (PARTITION BY role ORDER BY conv_id, turn) AS rev
    FROM conversations
""")
def revisions_per_role(spark, sf_dir):
    # A log whose few keys each hold a large share of the rows.
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role")
    return running(rows, ["role"], ["conv_id", "turn"], segment_of(F.col("conv_id")), F.lit(1), "sum", "rev")


@query("""
    SELECT count(*) AS total_changes, max(change_id) AS last_change_id, max(revision) AS last_revision
    FROM t_numbered
""")
def run_summary(spark, sf_dir):
    return changes.run_summary(Log(spark, sf_dir).numbered)


@query("SELECT count(*) AS late_rows FROM t_changes WHERE change_id <= 50")
def late_changelists(spark, sf_dir):
    return changes.late_changes(Log(spark, sf_dir).changelists, 50)


@query("""
    SELECT change_id, file_ord, depot_path, rev, action, file_type, 'change ' || change_id AS description
    FROM t_files WHERE change_id > 40 AND change_id <= (SELECT max(change_id) // 2 FROM t_files)
""")
def nested_changes_in_range(spark, sf_dir):
    """Changes exported in nested form and read back by id range through the change source."""
    log = Log(spark, sf_dir)
    path = scratch_path(spark, "nested-changes")
    nested.export_changes(log.changelists, log.files, path, ids_per_file=200).agg(F.sum("changes")).collect()
    last = log.changelists.agg(F.max("change_id").alias("last")).first().last
    found = nested.read_changes(spark, path).where((F.col("change_id") > 40) & (F.col("change_id") <= last // 2))
    return nested.files_of(found).join(found.select("change_id", "description"), "change_id").select(
        "change_id", *nested.FILE_COLUMNS, "description"
    )
