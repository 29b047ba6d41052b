"""SQL counterparts of the queries that SQL can express."""

from __future__ import annotations

# Reflected polynomial of CRC-32, a table entry per byte.
CRC_TABLE = """
    (SELECT list(list_reduce(list_prepend(i, range(8)), lambda c, j: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i)
     FROM range(256) AS bytes(i))
"""


def crc32(text: str, table: str = "crc.entries") -> str:
    """CRC-32 of the UTF-8 bytes of a text below U+0800."""
    points = f"list_transform(string_split({text}, ''), lambda c: unicode(c)::BIGINT)"
    as_bytes = f"flatten(list_transform({points}, lambda p: CASE WHEN p < 128 THEN [p] ELSE [192 + (p >> 6), 128 + (p & 63)] END))"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {as_bytes}), lambda c, b: xor(c >> 8, {table}[1 + (xor(c, b) & 255)])), 4294967295)"


EXACT_TOPK = """
WITH whole AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::HUGEINT) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), pairs AS (
    SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS score
    FROM whole q JOIN whole c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score::BIGINT AS score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM pairs) WHERE rank <= 5
"""

SPELLING_VARIANTS = f"""
WITH RECURSIVE crc AS (SELECT {CRC_TABLE} AS entries),
found AS (
    SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\\x{{C0}}-\\x{{FF}}]{{5,}}')) AS run FROM documents
), runs AS (
    SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n FROM found GROUP BY ALL
), hashed AS (
    SELECT run, n, {crc32("coalesce(doc_id::VARCHAR, '') || ':' || run")} AS h FROM runs, crc
), slipped AS (
    SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word, n FROM hashed
), words AS (
    SELECT word, sum(n)::BIGINT AS n FROM slipped WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3
), places AS (
    SELECT word, n, unnest(range(length(word))) AS i FROM words
), shorter AS (
    SELECT DISTINCT word, n, substr(word, 1, i::INT) || substr(word, i::INT + 2) AS other FROM places
), masked AS (
    SELECT word, n, substr(word, 1, i::INT) || '*' || substr(word, i::INT + 2) AS mask FROM places
), near AS (
    SELECT s.word, w.word AS near, w.n AS near_n FROM shorter s JOIN words w ON s.other = w.word
    UNION ALL SELECT w.word, s.word, s.n FROM shorter s JOIN words w ON s.other = w.word
    UNION ALL SELECT a.word, b.word, b.n FROM masked a JOIN masked b ON a.mask = b.mask AND a.word <> b.word
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY word ORDER BY near_n DESC, near) AS r, count(*) OVER (PARTITION BY word) AS n_near FROM near
), formed AS (
    SELECT w.word, w.n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN near_n >= 2 * w.n THEN near END AS form,
        CASE WHEN near_n >= 2 * w.n THEN near_n END AS form_n
    FROM words w LEFT JOIN (SELECT * FROM ranked WHERE r = 1) b ON w.word = b.word
), walked AS (
    SELECT word, word AS root, form AS further FROM formed
    UNION ALL SELECT k.word, f.word, f.form FROM walked k JOIN formed f ON k.further = f.word
)
SELECT f.word, f.form, k.root, f.n, f.n_near, f.form_n FROM formed f JOIN walked k ON f.word = k.word AND k.further IS NULL
"""

PREFIX_TRIE = f"""
WITH crc AS (SELECT {CRC_TABLE} AS entries),
said AS (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS place
    FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
    SELECT conv_id, conv_id - conv_id % 20 AS base, ({crc32("conv_id::VARCHAR")} % 4)::BIGINT AS h
    FROM (SELECT DISTINCT conv_id FROM said), crc
), rebuilt AS (
    SELECT c.conv_id, 0 AS part, s.place, s.role, s.text FROM convs c JOIN said s ON s.conv_id = c.base AND s.place <= c.h
    UNION ALL SELECT c.conv_id, 1, s.place, s.role, s.text FROM convs c JOIN said s ON s.conv_id = c.conv_id AND s.place > c.h
), paths AS (
    SELECT conv_id, list({{'r': role, 't': text}}) OVER own AS path, text, row_number() OVER own AS depth
    FROM rebuilt WINDOW own AS (PARTITION BY conv_id ORDER BY part, place ROWS UNBOUNDED PRECEDING)
), members AS (
    SELECT conv_id, depth, sha256(path::JSON::VARCHAR) AS node, len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) AS words FROM paths
    UNION ALL SELECT conv_id, 0, '', 0 FROM convs
), sized AS (
    SELECT m.*, max(depth) OVER (PARTITION BY conv_id) AS final, lag(node) OVER (PARTITION BY conv_id ORDER BY depth) AS parent FROM members m
), nodes AS (
    SELECT node, depth, any_value(parent) AS parent, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(words) AS words,
        sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (depth = final), '')) AS ends_sha256
    FROM sized GROUP BY node, depth
), grown AS (
    SELECT n.*, p.conv_id AS parent_conv_id, coalesce(k.n_children, 0) AS n_children
    FROM nodes n LEFT JOIN nodes p ON n.parent = p.node
    LEFT JOIN (SELECT parent, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY parent) k ON k.parent = n.node
), below AS (
    SELECT s.node, sum(CASE WHEN g.n_children = 0 THEN 1 ELSE 0 END)::BIGINT AS n_leaves, sum((g.n_convs - 1) * g.words)::BIGINT AS saved_tokens
    FROM grown g JOIN sized s ON s.conv_id = g.conv_id AND s.depth <= g.depth GROUP BY s.node
)
SELECT conv_id, depth::BIGINT AS depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256
FROM grown JOIN below USING (node)
"""

ORACLE = {
    "op7_exact_topk": EXACT_TOPK,
    "op11_spelling_variants": SPELLING_VARIANTS,
    "op13_prefix_trie": PREFIX_TRIE,
}
