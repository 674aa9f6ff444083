"""SQL for DuckDB of the operators that SQL can express on whole tables.

Not here, for lack of a way to say it in SQL: the classifier (1), SimHash windows (2),
the network (3), the tokenizer (6, 9), the scheduling heap (7), and sentence spans (10),
whose shortest runs depend on each other; tests compare these with brute force.
"""

TOP_K = """
WITH v AS (
  SELECT vec_id, [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len([1 FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank
  FROM (
    SELECT q.vec_id AS query_id, v.vec_id, CAST(list_inner_product(q.e, v.e) AS BIGINT) AS score
    FROM v AS q JOIN v ON q.vec_id % 50 = 0 AND v.vec_id <> q.vec_id AND len(v.e) = len(q.e)
  )
)
WHERE rank <= 5
"""

JACCARD = """
WITH RECURSIVE worded AS (
  SELECT doc_id, [x FOR x IN regexp_split_to_array(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[\\x20\\x09-\\x0D]+') IF x <> ''] AS w
  FROM documents
), sets AS (
  SELECT DISTINCT doc_id, unnest(CASE
    WHEN len(w) >= 3 THEN [concat_ws(' ', w[i], w[i + 1], w[i + 2]) FOR i IN range(1, len(w) - 1)]
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS shingle
  FROM worded
), sizes AS (
  SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id
), links AS (
  SELECT a, b FROM (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common
    FROM sets x JOIN sets y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id GROUP BY ALL
  ) JOIN sizes s ON s.doc_id = a JOIN sizes t ON t.doc_id = b
  WHERE 100 * common >= 90 * (s.n + t.n - common)
), reached AS (
  SELECT doc_id, doc_id AS node FROM documents
  UNION
  SELECT r.doc_id, l.b FROM reached r JOIN links l ON r.node = l.a
)
SELECT d.doc_id, coalesce(any_value(s.n), 0) AS n_shingles, min(r.node) AS component_id
FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id JOIN reached r ON r.doc_id = d.doc_id
GROUP BY d.doc_id
"""

_BITS = "['0000','0001','0010','0011','0100','0101','0110','0111',"
_BITS += "'1000','1001','1010','1011','1100','1101','1110','1111']"

WARC = f"""
WITH digests AS (
  SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS hex FROM pages
), bits AS (
  SELECT *, array_to_string(
    [{_BITS}[strpos('0123456789abcdef', c)] FOR c IN string_split(hex, '')], '') AS b,
    max(page_id) OVER (PARTITION BY payload) AS last
  FROM digests
)
SELECT page_id, strlen(payload) AS payload_bytes,
  array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    CAST(1 + 16 * CAST(b[5 * i + 1] AS INTEGER) + 8 * CAST(b[5 * i + 2] AS INTEGER)
      + 4 * CAST(b[5 * i + 3] AS INTEGER) + 2 * CAST(b[5 * i + 4] AS INTEGER)
      + CAST(b[5 * i + 5] AS INTEGER) AS INTEGER), 1) FOR i IN range(32)], '') AS payload_digest,
  CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> last THEN last END AS refers_to
FROM bits
"""



def _round(n: int) -> str:
    """Assign every part to the entries of round n - 1, then move the entries."""
    return f"""
), near{n} AS (
  SELECT r, p, CAST(min(d * 256 + e) % 256 AS BIGINT) AS e, CAST(min(d * 256 + e) // 256 AS BIGINT) AS d
  FROM (SELECT r, p, e, CAST(sum((x - y) * (x - y)) AS BIGINT) AS d
        FROM parts JOIN books{n - 1} USING (p, i) GROUP BY r, p, e)
  GROUP BY r, p
), sums{n} AS (
  SELECT e, p, i, CAST(sum(x) AS BIGINT) AS s, count(*) AS c
  FROM parts JOIN near{n} USING (r, p) GROUP BY e, p, i
), books{n} AS (
  SELECT e, p, i, coalesce((s - (s % c + c) % c) // c, y) AS y FROM books{n - 1} LEFT JOIN sums{n} USING (e, p, i)"""


CODES = f"""
WITH kept AS (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS r, vec_id, label, embedding
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
), parts AS (
  SELECT r, (i - 1) * 4 // len(embedding) AS p, i,
    CAST(floor(1024 * CAST(embedding[i] AS DOUBLE)) AS BIGINT) AS x
  FROM (SELECT *, unnest(range(1, len(embedding) + 1)) AS i FROM kept)
), books0 AS (
  SELECT r - 1 AS e, p, i, x AS y FROM parts WHERE r <= 256{"".join(map(_round, (1, 2, 3, 4, 5)))}
), coded AS (
  SELECT r, string_agg(printf('%02x', e), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error
  FROM near5 GROUP BY r
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
  (SELECT sha256(string_agg(CAST(y AS VARCHAR), ',' ORDER BY p, e, i)) FROM books4) AS codebooks_sha256
FROM coded JOIN kept USING (r)
"""

ORACLE = {
    "op13_value_dictionaries": CODES,
    "op4_maxscore_topk": TOP_K,
    "op5_ngram_jaccard_join": JACCARD,
    "op8_warc_normaliser": WARC,
}
