"""Directory trees."""

from pyspark.sql import functions as F

from changeflow.functions.paths import ancestors_of, parent_of, url_path
from changeflow.operators import directories, nodes
from changeflow.queries.common import Log
from changeflow.queries.registry import query
from changeflow.queries.sqlbase import ancestors
from changeflow.sources.event_log import table


@query(f"""
    SELECT path, CAST(len(a) AS INTEGER) AS n_parents, a[len(a)] AS parent, array_to_string(a, ' ') AS parents
    FROM (SELECT path, {ancestors('path')} AS a FROM (
      SELECT DISTINCT depot_path AS path FROM t_rows
      UNION SELECT regexp_replace(url, '^[a-z]+://|[?#].*$', '', 'g') FROM pages))
""")
def path_parents(spark, sf_dir):
    paths = Log(spark, sf_dir).events.select(F.col("depot_path").alias("path"))
    urls = table(spark, sf_dir, "pages").select(url_path(F.col("url")).alias("path"))
    parents = ancestors_of(F.col("path"))
    return paths.union(urls).distinct().select(
        "path", F.size(parents).alias("n_parents"), parent_of(F.col("path")).alias("parent"),
        F.array_join(parents, " ").alias("parents"),
    )


@query("SELECT path, usage FROM t_usage")
def path_rollup_usage(spark, sf_dir):
    return directories.dir_usage(Log(spark, sf_dir).wanted_events)


@query(f"""
    SELECT path, count(*) AS n_pages, CAST(sum(n) AS BIGINT) AS html_bytes FROM (
      SELECT octet_length(encode(html)) AS n, unnest({ancestors('p')}) AS path FROM (
        SELECT html, regexp_replace(url, '^[a-z]+://|[?#].*$', '', 'g') AS p FROM pages))
    GROUP BY path
""")
def url_rollup_pages(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select(url_path(F.col("url")).alias("url"), "html")
    measures = {"n_pages": F.lit(1), "html_bytes": F.octet_length("html")}
    return directories.rollup_by_path(pages, "url", measures)


@query("""
    SELECT path, CAST(row_number() OVER (ORDER BY path DESC) AS INTEGER) AS part FROM t_usage WHERE usage = 0
""")
def empty_dirs_desc(spark, sf_dir):
    return directories.number_empty_dirs(path_rollup_usage(spark, sf_dir))


@query("SELECT change_id, path, file_ord FROM t_dir_uses")
def dir_adds_per_changelist(spark, sf_dir):
    wanted = Log(spark, sf_dir).wanted_events
    adding = wanted.where(F.col("action").isin("ADD", "BRANCH", "PURGE"))
    return directories.first_dir_uses(adding).select("change_id", "path", "file_ord")


@query("SELECT change_id, part, path, node_kind FROM t_nodes")
def part_numbers(spark, sf_dir):
    wanted = Log(spark, sf_dir).wanted_events
    files = wanted.select(
        "change_id", "file_ord", F.lit(1).alias("is_file"), F.col("svn_path").alias("path"),
        F.lit("file").alias("node_kind"),
    )
    rows = files.unionByName(nodes.dir_nodes(wanted).select(files.columns))
    return nodes.number_parts(rows).select("change_id", "part", "path", "node_kind")


@query("""
    SELECT path, usage FROM t_usage
""")
def usage_merged_over_runs(spark, sf_dir):
    """Two id ranges with directories of their own add up to the whole."""
    wanted = Log(spark, sf_dir).wanted_events
    early = F.col("change_id") % 1000 < 300
    return directories.merge_usage(directories.dir_usage(wanted.where(early)), directories.dir_usage(wanted.where(~early)))


@query(f"""
    SELECT change_id, path, CAST(1 AS INTEGER) AS file_ord FROM (
      SELECT page_id AS change_id, unnest({ancestors('p')}) AS path FROM (
        SELECT page_id, '/' || regexp_replace(url, '^[a-z]+://|[?#].*$', '', 'g') AS p FROM pages))
    WHERE path <> '/'
""")
def dir_adds_below_root(spark, sf_dir):
    """Paths that begin with a slash: the root itself is never added."""
    path = F.concat(F.lit("/"), url_path(F.col("url")))
    rows = table(spark, sf_dir, "pages").select(
        F.col("page_id").alias("change_id"), F.lit(1).alias("file_ord"), path.alias("svn_path")
    )
    return directories.first_dir_uses(rows).select("change_id", "path", "file_ord")


@query(f"""
    SELECT path, CAST(sum(delta) AS BIGINT) AS usage FROM (
      SELECT unnest({ancestors('path')}) AS path,
             CASE WHEN change_action = 'Delete' THEN -1 ELSE 1 END AS delta
      FROM t_replayed WHERE allowed AND node_kind = 'file' AND change_action IN ('Add', 'Add Copy', 'Delete'))
    GROUP BY path
""")
def usage_of_kept_records(spark, sf_dir):
    from changeflow.operators.replay import keep_allowed

    return directories.kept_usage(keep_allowed(Log(spark, sf_dir).records))
