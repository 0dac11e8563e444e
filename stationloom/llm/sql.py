"""DuckDB counterparts of those queries that SQL can express."""

from __future__ import annotations

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

OP2 = r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT * FROM (VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]'))),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS rn, count(*) OVER (PARTITION BY conv_id) AS n,
    length('<s>[INST][/INST]</s>') + length(regexp_replace(role || text, '([\\<\[])', '\1\1', 'g')) AS size FROM c),
p AS (SELECT *, sum(size) OVER (PARTITION BY conv_id ORDER BY rn) AS upto FROM o)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY rn)) AS turns_sha256,
    coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY rn) FILTER (role = 'assistant'), '')) AS loss_sha256,
    sum(CASE WHEN role = 'assistant' OR rn = n THEN upto END)::BIGINT AS formatted_chars
FROM p GROUP BY conv_id
"""

OP3 = r"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
n AS (SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS i FROM d),
l AS (SELECT doc_id, i, ls[i] AS line, translate(regexp_replace(ls[i], '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM n),
r AS (SELECT key, max(doc_id) AS top FROM l WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5)
SELECT l.doc_id, count(*) AS n_lines, count(CASE WHEN r.top <> l.doc_id THEN 1 END) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (r.key IS NULL OR r.top = l.doc_id), '')) AS kept_sha256
FROM l LEFT JOIN r ON l.key = r.key GROUP BY l.doc_id
"""

OP7 = rf"""
WITH d AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
w AS (SELECT doc_id, ws, unnest(range(1, len(ws) + 1)) AS i FROM d),
h AS MATERIALIZED (SELECT doc_id, i, ws[i] AS word, CASE WHEN i + 49 <= len(ws) THEN md5(array_to_string(ws[i:i + 49], ' ')) END AS h FROM w),
m AS (SELECT h, min(doc_id) AS least FROM h WHERE h IS NOT NULL GROUP BY h),
g AS (SELECT h.doc_id, i, word, CASE WHEN m.least < h.doc_id THEN 1 ELSE 0 END AS hit FROM h LEFT JOIN m ON h.h = m.h),
c AS (SELECT doc_id, i, word, max(hit) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS gone FROM g),
k AS (SELECT doc_id, count(*) AS n_words, sum(gone) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (gone = 0) AS kept FROM c GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_words, 0)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k ON d.doc_id = k.doc_id
"""

OP5 = r"""
WITH t AS (SELECT item_id, regexp_extract_all(lower(text), '[^\x20\x09-\x0D]+') AS ws FROM benchmark WHERE text IS NOT NULL),
s AS (SELECT DISTINCT item_id, array_to_string(ws[i:i + 4], ' ') AS shingle FROM (SELECT item_id, ws, unnest(range(1, len(ws) - 3)) AS i FROM t)),
n AS (SELECT item_id, count(*) AS n_shingles FROM s GROUP BY item_id),
d AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[^\x20\x09-\x0D]+') AS ws FROM documents),
g AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i + 4], ' ') AS shingle FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 3)) AS i FROM d)),
c AS (SELECT doc_id, item_id, count(*) AS n_common FROM g JOIN s ON g.shingle = s.shingle GROUP BY doc_id, item_id)
SELECT doc_id, c.item_id, n_shingles, n_common, n_common / n_shingles AS containment
FROM c JOIN n ON c.item_id = n.item_id WHERE n_common >= 0.8 * n_shingles - 1e-9
"""

_TERMS = r"""regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""

OP11 = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS ws FROM documents WHERE text IS NOT NULL),
f AS (SELECT r, doc_id, len(ws) AS n, unnest(ws) AS term FROM d),
g AS (SELECT r, doc_id, n, term, count(*) AS tf FROM f GROUP BY r, doc_id, n, term),
s AS (SELECT count(*) FILTER (len(ws) > 0) AS docs, sum(len(ws))::BIGINT AS terms FROM d),
h AS (SELECT term, count(*) AS df FROM g GROUP BY term),
q AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark),
w AS (SELECT item_id, q.term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w FROM q JOIN h ON q.term = h.term, s),
c AS (SELECT item_id, r, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // terms))))::BIGINT AS score
    FROM w JOIN g ON w.term = g.term, s GROUP BY item_id, r, doc_id),
k AS (SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rn FROM c WHERE score > 0)
SELECT item_id, rn::INTEGER AS rank, doc_id, score FROM k WHERE rn <= 10
"""

ORACLES: dict[str, str] = {
    "op2_chat_formatting": OP2,
    "op3_line_dedup": OP3,
    "op5_benchmark_decontamination": OP5,
    "op7_substring_dedup": OP7,
    "op11_ranked_search": OP11,
}
