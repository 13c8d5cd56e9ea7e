"""Shared table expressions for the check SQL; each query pulls in only those it names."""

from __future__ import annotations

import re

ANCESTORS = (
    "list_transform(list_filter(range(1, length({p})), lambda i: substr({p}, i, 1) = '/'), "
    "lambda i: substr({p}, 1, i))"
)


def ancestors(path: str) -> str:
    return ANCESTORS.format(p=path)


def prop(key: str, value: str) -> str:
    return (
        f"('K ' || octet_length(encode('{key}')) || chr(10) || '{key}' || chr(10) || "
        f"'V ' || octet_length(encode({value})) || chr(10) || {value} || chr(10))"
    )


NL = "chr(10)"
KEYWORD_WORDS = "HeadURL Id LastChangedBy LastChangedDate LastChangedRevision"
GMT = "strftime({ts}, '%Y-%m-%dT%H:%M:%S') || '.000000Z'"

TABLES = {
    "t_rows": """
        SELECT *,
          '//depot/' || CASE WHEN change_id % 10 = 0 OR user_id % 10 IN (8, 9) THEN 'scratch'
                             WHEN user_id % 2 = 0 THEN 'main' ELSE 'rel' END
            || '/u' || user_id || '/d' || (k % 3) || '/f' || (k % 6) || '.txt' AS depot_path,
          CASE event_type
            WHEN 'signup' THEN CASE WHEN k % 10 = 0 THEN 'PURGE' ELSE 'ADD' END
            WHEN 'click' THEN 'EDIT' WHEN 'view' THEN 'INTEGRATE'
            WHEN 'purchase' THEN 'BRANCH' WHEN 'error' THEN 'DELETE' END AS action,
          ['text', 'unicode', 'k', '+kx', 'binary', 'symlink', 'ktext', 'x'][CAST(k % 8 AS INTEGER) + 1] AS file_type
        FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
                CAST(event_id // 8 + 1 AS INTEGER) AS change_id,
                CAST(event_id % 8 + 1 AS INTEGER) AS file_ord FROM events)""",
    "t_files": """
        SELECT *, CAST(row_number() OVER (PARTITION BY depot_path ORDER BY event_id) AS INTEGER) AS rev
        FROM t_rows""",
    "t_wanted": """
        SELECT *, CASE WHEN depot_path LIKE '//depot/main/%' THEN 'trunk/' || substr(depot_path, 14)
                       ELSE 'branches/rel/' || substr(depot_path, 13) END AS svn_path
        FROM t_files WHERE depot_path LIKE '//depot/main/%' OR depot_path LIKE '//depot/rel/%'""",
    "t_changes": """
        SELECT change_id, 'u' || arg_min(user_id, event_id) AS username, max(ts) AS submitted_at,
               'change ' || change_id AS description
        FROM t_rows GROUP BY change_id""",
    "t_marked": """
        SELECT c.change_id, coalesce(n.n_files, 0) AS n_files, coalesce(n.n_files, 0) > 0 AS kept
        FROM t_changes c LEFT JOIN
          (SELECT change_id, count(*) AS n_files FROM t_wanted GROUP BY change_id) n USING (change_id)""",
    "t_numbered": """
        SELECT *, CAST(CASE WHEN kept THEN sum(CAST(kept AS INTEGER)) OVER (ORDER BY change_id) ELSE 0 END
                       AS INTEGER) AS revision FROM t_marked""",
    "t_integrations": """
        SELECT t.depot_path AS to_path, t.rev AS to_rev, s.seq,
          CASE WHEN t.k % 7 = 0 THEN 'merge into' WHEN t.action = 'BRANCH' THEN 'branch from'
               ELSE 'copy from' END AS how_from,
          f.depot_path AS from_path,
          CASE WHEN s.seq = 1 AND t.k % 11 = 0 THEN 0 ELSE f.rev END AS end_from_rev
        FROM t_files t CROSS JOIN (VALUES (1, 9), (2, 25)) s(seq, back)
        JOIN t_files f ON f.event_id = t.event_id - s.back
        WHERE t.action IN ('BRANCH', 'INTEGRATE')""",
    "t_picks": """
        SELECT * FROM (
          SELECT to_path, to_rev,
            arg_min(from_path, seq) FILTER (WHERE from_path IS NOT NULL) AS from_path,
            arg_min(end_from_rev, seq) FILTER (WHERE end_from_rev <> 0) AS from_rev
          FROM t_integrations WHERE contains(how_from, 'from') GROUP BY to_path, to_rev)
        WHERE from_path IS NOT NULL AND from_rev IS NOT NULL""",
    "t_contents": """
        SELECT f.change_id, f.file_ord, f.depot_path, f.rev, f.file_type, f.k = 97 AS missing,
          encode(CASE WHEN f.k = 97
            THEN 'Import Error: Failed to get file contents: ' || f.depot_path || '#' || f.rev
            ELSE d.text END) AS content
        FROM t_files f JOIN documents d
          ON d.doc_id = (f.event_id // 20 * 4 + f.k % 4) % (SELECT max(doc_id) + 1 FROM documents)""",
    "t_copies": """
        SELECT t.change_id, t.file_ord, s.svn_path AS copy_from_path, n.revision AS copy_from_rev,
               s.change_id AS from_change_id
        FROM t_wanted t
        JOIN t_picks p ON p.to_path = t.depot_path AND p.to_rev = t.rev
        JOIN t_wanted s ON s.depot_path = p.from_path AND s.rev = p.from_rev
        JOIN t_numbered n ON n.change_id = s.change_id AND n.revision <> 0
        JOIN t_contents a ON a.depot_path = t.depot_path AND a.rev = t.rev
        JOIN t_contents b ON b.depot_path = s.depot_path AND b.rev = s.rev
        WHERE t.action IN ('BRANCH', 'INTEGRATE') AND a.content = b.content""",
    "t_node_files": """
        SELECT w.change_id, w.file_ord, 1 AS is_file, w.svn_path AS path, w.depot_path, w.rev, w.action,
          w.file_type,
          CASE WHEN action IN ('ADD', 'PURGE') THEN 'Add' WHEN action = 'DELETE' THEN 'Delete'
               WHEN action = 'EDIT' THEN 'Edit'
               WHEN action = 'BRANCH' THEN CASE WHEN copy_from_path IS NULL THEN 'Add' ELSE 'Add Copy' END
               ELSE CASE WHEN copy_from_path IS NULL THEN 'Edit' ELSE 'Replace Copy' END END AS change_action,
          copy_from_path, copy_from_rev
        FROM t_wanted w LEFT JOIN t_copies c USING (change_id, file_ord)""",
    "t_dir_uses": f"""
        SELECT change_id, path, min(file_ord) AS file_ord FROM (
          SELECT change_id, file_ord, unnest({ancestors('svn_path')}) AS path FROM t_wanted
          WHERE action IN ('ADD', 'BRANCH', 'PURGE'))
        WHERE path <> '/' GROUP BY change_id, path""",
    "t_nodes": """
        SELECT *, CAST(row_number() OVER (PARTITION BY change_id ORDER BY file_ord, is_file, path) AS INTEGER)
                    AS part
        FROM (SELECT change_id, file_ord, is_file, path, depot_path, rev, action, file_type, change_action,
                     copy_from_path, copy_from_rev, 'file' AS node_kind FROM t_node_files
              UNION ALL
              SELECT change_id, file_ord, 0, path, NULL, NULL, NULL, NULL, 'Add', NULL, NULL, 'dir'
              FROM t_dir_uses)""",
    "t_replayed": """
        SELECT * EXCLUDE (before),
          CASE WHEN change_action IN ('Add', 'Add Copy') THEN before = 0 ELSE before = 1 END AS allowed
        FROM (SELECT *, coalesce(last_value(CASE WHEN change_action IN ('Add', 'Add Copy') THEN 1
                                                 WHEN change_action = 'Delete' THEN 0 END IGNORE NULLS)
                OVER (PARTITION BY path ORDER BY change_id, part
                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
              FROM t_nodes)""",
    "t_usage": f"""
        SELECT path, CAST(sum(delta) AS BIGINT) AS usage FROM (
          SELECT unnest({ancestors('svn_path')}) AS path,
                 CASE WHEN action = 'DELETE' THEN -1 ELSE 1 END AS delta
          FROM t_wanted WHERE action IN ('ADD', 'BRANCH', 'PURGE', 'DELETE'))
        GROUP BY path""",
    "t_headers": f"""
        SELECT change_id, revision, description AS log, username AS author,
               {GMT.format(ts='submitted_at')} AS date
        FROM t_changes JOIN t_numbered USING (change_id) WHERE kept""",
    "t_props": f"""
        SELECT *,
          CASE WHEN change_action IN ('Add', 'Edit') AND node_kind = 'file' THEN
            CASE WHEN file_type IN ('+kx', 'x') THEN {prop('svn:executable', "'on'")} ELSE '' END
            || CASE WHEN file_type IN ('k') THEN {prop('svn:keywords', f"'{KEYWORD_WORDS}'")} ELSE '' END
            || CASE WHEN file_type = 'symlink' AND action <> 'PURGE'
                    THEN {prop('svn:special', "'*'")} ELSE '' END
            ELSE '' END || 'PROPS-END' AS block
        FROM t_nodes""",
    "t_texts": """
        SELECT p.*, CASE WHEN change_action IN ('Add', 'Edit') AND node_kind = 'file' THEN
            CASE WHEN action = 'PURGE' THEN encode('Placeholder for file purged by Perforce.')
                 WHEN p.file_type = 'symlink' THEN encode('link ') || c.content ELSE c.content END
            END AS content
        FROM t_props p LEFT JOIN t_contents c USING (depot_path, rev)""",
    "t_records": f"""
        SELECT change_id, part, path,
          CASE WHEN node_kind = 'dir' THEN encode('Node-path: ' || path || {NL} || 'Node-kind: dir' || {NL}
                 || 'Node-action: add' || {NL} || 'Prop-content-length: 10' || {NL} || 'Content-length: 10'
                 || {NL} || {NL} || 'PROPS-END' || {NL} || {NL})
               WHEN change_action = 'Delete'
                 THEN encode('Node-path: ' || path || {NL} || 'Node-action: delete' || {NL} || {NL})
               WHEN copy_from_path IS NOT NULL
                 THEN encode('Node-path: ' || path || {NL} || 'Node-kind: file' || {NL} || 'Node-action: '
                   || CASE WHEN change_action = 'Add Copy' THEN 'add' ELSE 'replace' END || {NL}
                   || 'Node-copyfrom-rev: ' || copy_from_rev || {NL}
                   || 'Node-copyfrom-path: ' || copy_from_path || {NL} || {NL})
               ELSE encode('Node-path: ' || path || {NL} || 'Node-kind: file' || {NL} || 'Node-action: '
                   || CASE WHEN change_action = 'Add' THEN 'add' ELSE 'change' END || {NL}
                   || 'Text-content-length: ' || octet_length(content) || {NL}
                   || 'Text-content-md5: ' || md5(content) || {NL}
                   || 'Prop-content-length: ' || (octet_length(encode(block)) + 1) || {NL}
                   || 'Content-length: ' || (octet_length(encode(block)) + 1 + octet_length(content)) || {NL}
                   || {NL} || block || {NL}) || content || encode({NL} || {NL}) END AS record
        FROM t_texts
        UNION ALL
        SELECT change_id, 0, NULL, encode('Revision-number: ' || revision || {NL}
            || 'Prop-content-length: ' || (octet_length(encode(block)) + 1) || {NL}
            || 'Content-length: ' || (octet_length(encode(block)) + 1) || {NL} || {NL}
            || block || {NL} || {NL})
        FROM (SELECT *, {prop('svn:author', 'author')} || {prop('svn:date', 'date')}
                || {prop('svn:log', 'log')} || 'PROPS-END' AS block FROM t_headers)""",
}


def _needs(sql: str) -> list[str]:
    """Names of the shared tables a text uses, dependencies first."""
    found: list[str] = []
    for name in TABLES:
        if re.search(rf"\b{name}\b", sql):
            found += [n for n in [*_needs(TABLES[name]), name] if n not in found]
    return found


def with_tables(sql: str) -> str:
    names = _needs(sql)
    if not names:
        return sql
    return "WITH " + ",\n".join(f"{n} AS MATERIALIZED ({TABLES[n]})" for n in names) + "\n" + sql
