"""DuckDB statements for the operators of this subpackage that SQL can express."""

from __future__ import annotations

_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

OP4 = f"""
WITH p AS (
  SELECT page_id, url, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS h FROM pages
), f AS (SELECT h, min(page_id) AS first FROM p GROUP BY h)
SELECT page_id, CAST(strlen(body) AS BIGINT) AS payload_bytes,
  list_aggregate(list_transform(range(8), lambda g: list_aggregate(list_transform(range(4), lambda d:
    substr('{_BASE32}', CAST((CAST('0x' || substr(p.h, g * 5 + 1, 5) AS BIGINT) >> CAST(15 - 5 * d AS BIGINT)) & 31 AS BIGINT) + 1, 1)),
    'string_agg', '')), 'string_agg', '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to, url
FROM p JOIN f USING (h)
"""

OP7 = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY rank <= 5
"""

OP9 = """
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x20\\x09-\\x0D]+') AS words FROM documents
), s AS (
  SELECT doc_id, list_distinct(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 3 THEN [array_to_string(words, ' ')]
    ELSE list_transform(range(1, len(words) - 1), lambda k: words[k] || ' ' || words[k + 1] || ' ' || words[k + 2]) END) AS sh FROM w
), x AS (SELECT doc_id, len(sh) AS n, unnest(sh) AS g FROM s),
pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM x a JOIN x b ON a.g = b.g AND a.doc_id <> b.doc_id
    AND 10 * least(a.n, b.n) >= 9 * greatest(a.n, b.n)
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 190 * count(*) >= 90 * (a.n + b.n)
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM s UNION SELECT r.a, p.b FROM reach r JOIN pairs p ON r.b = p.a
)
SELECT s.doc_id, CAST(len(sh) AS BIGINT) AS n_shingles, min(r.b) AS component_id
FROM s JOIN reach r ON r.a = s.doc_id GROUP BY s.doc_id, len(sh)
"""

# the checksum of a feature's bytes by a table of 256 steps; distinct features only
OP12 = """
WITH step AS (
  SELECT list_transform(range(256), lambda b: list_reduce(range(8), lambda c, k:
    CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, CAST(b AS BIGINT))) AS t
), texts AS (
  SELECT 0 AS side, doc_id AS id, text FROM documents UNION ALL SELECT 1, item_id, text FROM benchmark
), w AS (
  SELECT side, id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words FROM texts
), f AS (
  SELECT side, id, unnest(words) AS g FROM w
  UNION ALL SELECT side, id, unnest(list_transform(range(1, len(words)), lambda k: words[k] || ' ' || words[k + 1])) FROM w
  UNION ALL SELECT side, id, unnest(list_transform(range(1, len(words) - 1), lambda k: words[k] || ' ' || words[k + 1] || ' ' || words[k + 2])) FROM w
), n AS (SELECT side, id, g, count(*) AS c FROM f GROUP BY ALL),
named AS (
  SELECT g, xor(list_reduce(list_transform(range(CAST(strlen(g) AS BIGINT)), lambda k: CAST(CAST('0x' || substr(hex(encode(g)), 2 * k + 1, 2) AS INTEGER) AS BIGINT)),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), CAST(4294967295 AS BIGINT)), 4294967295) % 10000 AS bucket
  FROM (SELECT DISTINCT g FROM n), step
), b AS (
  SELECT bucket, coalesce(sum(c) FILTER (side = 0), 0) AS s, coalesce(sum(c) FILTER (side = 1), 0) AS t FROM n JOIN named USING (g) GROUP BY bucket
), total AS (SELECT coalesce(sum(s), 0) AS s, coalesce(sum(t), 0) AS t FROM b),
gain AS (
  SELECT bucket, CAST(floor(1000 * ln((CAST(b.t AS DOUBLE) + 1) * (CAST(total.s AS DOUBLE) + 10000)
    / ((CAST(b.s AS DOUBLE) + 1) * (CAST(total.t AS DOUBLE) + 10000)))) AS BIGINT) AS gain FROM b, total
), per AS (
  SELECT id, sum(c) AS n_features, sum(c * gain) AS weight FROM n JOIN named USING (g) JOIN gain USING (bucket) WHERE side = 0 GROUP BY id
), scored AS (
  SELECT doc_id, CAST(coalesce(n_features, 0) AS BIGINT) AS n_features, CAST(coalesce(weight, 0) AS BIGINT) AS weight,
    CAST(coalesce(weight, 0) + floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('42:' || doc_id), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score
  FROM documents LEFT JOIN per ON id = doc_id
), ordered AS (
  SELECT *, n_features >= 57 AS able, row_number() OVER (PARTITION BY n_features >= 57 ORDER BY score DESC, doc_id) AS r,
    count(*) OVER (PARTITION BY n_features >= 57) AS m FROM scored
)
SELECT doc_id, n_features, weight, score, CASE WHEN able AND r <= 5 * m // 100 THEN r END AS rank FROM ordered
"""

ORACLE_SQL: dict[str, str] = {"op4_warc": OP4, "op7_top_k": OP7, "op9_jaccard_join": OP9, "op12_resampling": OP12}
