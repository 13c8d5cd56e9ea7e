"""DuckDB SQL that the queries are checked against."""

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SPACED = r"[^\x20\x09-\x0D]+"
PLAIN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

CHAT = r"""
WITH rows AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL VALUES (-1, 0, 'user', '<|im_end|><|im_start|>assistant ok'),
                     (-1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok')
), sized AS (
    SELECT *, regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g') AS body,
        regexp_replace(replace(replace(role, '%', '%25'), chr(10), '%0A'), '<(\\*)\|', '<\\\1|', 'g') AS head
    FROM rows
), grouped AS (
    SELECT conv_id, count(*) AS n_turns,
        string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS turns,
        coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), '') AS loss,
        sum(length('<|im_start|>') + length(head) + 1 + length(body) + length('<|im_end|>') + 1) AS chars
    FROM sized GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256,
    chars::BIGINT AS formatted_chars
FROM grouped
"""

CONTAMINATION = f"""
WITH docs AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{PLAIN}') AS w FROM documents
), items AS (
    SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{PLAIN}') AS w FROM benchmark
), item_windows AS (
    SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[p:p + 9], ' ') AS win
    FROM (SELECT item_id, w, unnest(generate_series(1, greatest(len(w) - 9, 1))) AS p FROM items WHERE len(w) > 0)
), lengths AS (SELECT DISTINCT n FROM item_windows),
placed AS (
    SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS p
    FROM docs CROSS JOIN lengths WHERE len(w) >= n
), doc_windows AS (
    SELECT doc_id, n, p, array_to_string(w[p:p + n - 1], ' ') AS win FROM placed
), hits AS (
    SELECT d.doc_id, d.n, d.p, i.item_id FROM doc_windows d JOIN item_windows i ON d.win = i.win AND d.n = i.n
), words AS (
    SELECT doc_id, count(*) AS n_hit
    FROM (SELECT DISTINCT doc_id, unnest(generate_series(p, p + n - 1)) AS q FROM hits) GROUP BY doc_id
), found AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS names
    FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY doc_id
)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
    sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs d LEFT JOIN words USING (doc_id) LEFT JOIN found USING (doc_id)
"""

MIX = f"""
WITH sized AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{SPACED}')) + 1 AS n_tokens FROM documents
), totals AS (
    SELECT source, sum(n_tokens)::BIGINT AS total FROM sized GROUP BY source
), top AS (SELECT max(total)::DOUBLE AS hi, min(total)::DOUBLE AS lo FROM totals),
found AS (
    SELECT min(s) AS step FROM top, generate_series(0, 4096) AS g(s) WHERE pow(hi / lo, 1 - s / 4096.0) <= 2.0
), plan AS (
    SELECT source, total, greatest(round(pow(total / hi, step / 4096.0) * hi)::BIGINT, total) AS quota
    FROM totals, top, found
), repeated AS (
    SELECT s.*, total, quota, unnest(generate_series(0, ceil(quota / total)::BIGINT - 1)) AS epoch
    FROM sized s JOIN plan p ON s.source IS NOT DISTINCT FROM p.source
), keyed AS (
    SELECT *, md5(concat_ws('|', '7', coalesce(source, ''), epoch::VARCHAR, coalesce(doc_id::VARCHAR, ''))) AS k
    FROM repeated
), placed AS (
    SELECT *, coalesce(sum(n_tokens) OVER (PARTITION BY source ORDER BY epoch, k
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS place
    FROM keyed
)
SELECT doc_id, source, n_tokens::BIGINT AS n_tokens, epoch, (place * 64 // quota)::INTEGER AS block,
    md5(concat_ws('|', k, (place * 64 // quota)::VARCHAR)) AS block_key
FROM placed WHERE place < quota
"""

JACCARD = f"""
WITH RECURSIVE docs AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{SPACED}') AS w FROM documents
), sets AS (
    SELECT DISTINCT doc_id, array_to_string(w[p:p + 2], ' ') AS s
    FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(len(w) - 2, 1))) AS p FROM docs WHERE len(w) > 0)
), sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
links AS (
    SELECT a.doc_id AS a, b.doc_id AS b
    FROM sets a JOIN sets b ON a.s = b.s AND a.doc_id <> b.doc_id
    JOIN sizes x ON x.doc_id = a.doc_id JOIN sizes y ON y.doc_id = b.doc_id
    WHERE 10 * least(x.n, y.n) >= 9 * greatest(x.n, y.n)
    GROUP BY a.doc_id, b.doc_id, x.n, y.n
    HAVING 100 * count(*) >= 90 * (x.n + y.n - count(*))
), reach AS (
    SELECT doc_id AS a, doc_id AS b FROM docs
    UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, c.least AS component_id, coalesce(k.links, 0)::BIGINT AS n_links
FROM docs d LEFT JOIN sizes USING (doc_id) LEFT JOIN (SELECT a, count(*) AS links FROM links GROUP BY a) k ON k.a = d.doc_id JOIN (SELECT a, min(b) AS least FROM reach GROUP BY a) c ON c.a = d.doc_id
"""

COSINE = """
WITH RECURSIVE v AS (
    SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
    WHERE label IS NOT NULL AND len(embedding) > 0
        AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
        AND len([x FOR x IN embedding IF x <> 0]) > 0
), links AS (
    SELECT a.vec_id AS a, b.vec_id AS b
    FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
    WHERE list_cosine_similarity(a.e, b.e) >= 0.98
), counts AS (SELECT a, count(*) AS n FROM links GROUP BY a),
reach AS (
    SELECT vec_id AS a, vec_id AS b FROM embeddings
    UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
)
SELECT e.vec_id, coalesce(n, 0)::BIGINT AS n_links, least AS component_id, e.vec_id = least AS kept, 1.0::DOUBLE AS recall
FROM embeddings e LEFT JOIN counts ON counts.a = e.vec_id
JOIN (SELECT a, min(b) AS least FROM reach GROUP BY a) c ON c.a = e.vec_id
"""
