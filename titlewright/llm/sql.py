"""The registered queries that SQL can express, for DuckDB."""

from __future__ import annotations

from titlewright.llm import mixing, sharding

_WORDS = r"regexp_extract_all({text}, '[^\x20\x09-\x0D]+')"
_LOWER = "translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

WARC = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
d AS (SELECT page_id, octet_length(payload)::BIGINT AS payload_bytes, lower(sha1(payload)) AS payload_digest FROM p),
m AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS top FROM d)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN payload_bytes >= 1000 AND page_id < top THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN payload_bytes >= 1000 AND page_id < top THEN top END AS refers_to FROM m
"""

SUBSTRINGS = f"""
WITH d AS (SELECT doc_id, {_WORDS.format(text="coalesce(text, '')")} AS w FROM documents),
s AS (SELECT doc_id, unnest(range(1, len(w) - 18)) AS i, w FROM d WHERE len(w) >= 20),
h AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 19], ' ')) AS k FROM s),
r AS (SELECT doc_id, i, row_number() OVER (PARTITION BY k ORDER BY doc_id, i) > 1 AS again FROM h),
g AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS p FROM r WHERE again),
gone AS (SELECT doc_id, list(p) AS ps, count(*) AS n FROM g GROUP BY doc_id),
t AS (SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed, CASE WHEN ps IS NULL THEN w ELSE list_filter(w, lambda x, i: NOT list_contains(ps, i)) END AS kept FROM d LEFT JOIN gone USING (doc_id))
SELECT doc_id, n_words, n_removed, sha256(array_to_string(kept, ' ')) AS kept_sha256 FROM t
"""

LINES = f"""
WITH s AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, unnest(range(1, len(ls) + 1)) AS i, unnest(ls) AS line FROM s),
k AS (SELECT *, {_LOWER.format(text="trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))")} AS key FROM l),
c AS (SELECT key, max(doc_id) AS last FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
x AS (SELECT k.doc_id, k.i, k.line, c.key IS NOT NULL AND k.doc_id <> c.last AS gone FROM k LEFT JOIN c USING (key))
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (gone)::BIGINT AS n_dropped, sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256 FROM x GROUP BY doc_id
"""

NEAR = f"""
WITH RECURSIVE d AS (SELECT doc_id, {_WORDS.format(text=_LOWER.format(text="coalesce(text, '')"))} AS w FROM documents),
s AS (SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [md5(array_to_string(w, ' '))]
    ELSE list_transform(range(1, len(w) - 3), lambda i: md5(array_to_string(w[i:i + 4], ' '))) END) AS k FROM d),
n AS (SELECT doc_id, len(k)::BIGINT AS n_shingles FROM s),
f AS (SELECT doc_id, unnest(k) AS k FROM s),
b AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM f x JOIN f y ON x.k = y.k AND x.doc_id <> y.doc_id GROUP BY ALL),
e AS (SELECT a, b FROM b JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * c >= 75 * (p.n_shingles + q.n_shingles - c)),
reach AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM reach r JOIN e ON e.a = r.b),
o AS (SELECT a AS doc_id, min(b) AS low FROM reach GROUP BY a)
SELECT doc_id, n_shingles, least(doc_id, coalesce(low, doc_id)) AS component_id, doc_id = least(doc_id, coalesce(low, doc_id)) AS kept FROM n LEFT JOIN o USING (doc_id)
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_mixing": mixing.SQL, "op2_warc": WARC, "op3_substring_dedup": SUBSTRINGS, "op4_line_dedup": LINES, "op6_sharding": sharding.SQL, "op8_minhash": NEAR}
