"""DuckDB SQL for the operators that SQL can express (same names and columns
as the queries). The others depend on trained models, tokenizers or hashes and
are tested against brute-force versions in ``tests/llm``."""

OP4_MINHASH = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, [x FOR x IN string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+') IF x <> ''] AS w
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE
    WHEN len(w) = 0 THEN []::VARCHAR[]
    WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE [w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] FOR i IN range(1, len(w) - 1)] END) AS g
  FROM d),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (
  SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS c
  FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (
  SELECT u, v FROM p JOIN n nu ON nu.doc_id = u JOIN n nv ON nv.doc_id = v
  WHERE 100 * c >= 85 * (nu.n + nv.n - c)),
r(a, b) AS (
  SELECT doc_id, doc_id FROM d
  UNION
  SELECT r.a, l.v FROM r JOIN l ON r.b = l.u),
m AS (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, m.component_id, d.doc_id = m.component_id AS kept
FROM d LEFT JOIN n ON n.doc_id = d.doc_id JOIN m ON m.doc_id = d.doc_id
"""

OP6_EXACT = """
SELECT doc_id,
       max(doc_id) OVER same AS keep_id,
       count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW same AS (PARTITION BY coalesce(text, ''))
"""

OP12_NEGATIVES = """
WITH e AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
         CAST(list_sum([a.v[i] * b.v[i] FOR i IN range(1, len(a.v) + 1)]) AS BIGINT) AS score
  FROM e a JOIN e b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
n AS (
  SELECT p.anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
         vec_id AS negative_id, positive_score, score AS negative_score
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
  WHERE 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score)
SELECT * FROM n WHERE rank <= 5
"""

#: crc32 bit by bit; then, row by row, the cheapest edits that lead to each
#: state (n nothing yet, s, u, a), ties by the edits' initials
OP13_REPAIR = r"""
WITH RECURSIVE c AS (
  SELECT row_number() OVER () AS rid, conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k
  FROM conversations),
z(rid, k, i, x) AS (
  SELECT rid, k, 0, CAST(4294967295 AS BIGINT) FROM c
  UNION ALL
  SELECT rid, k, i + 1, CASE WHEN y & 1 = 1 THEN xor(y >> 1, CAST(3988292384 AS BIGINT)) ELSE y >> 1 END
  FROM (SELECT rid, k, i, CASE WHEN i % 8 = 0 THEN xor(x, CAST(ascii(substr(k, i // 8 + 1, 1)) AS BIGINT)) ELSE x END AS y
        FROM z WHERE i < 8 * length(k))),
h AS (
  SELECT c.*, xor(x, CAST(4294967295 AS BIGINT)) % 20 AS how FROM c JOIN z USING (rid) WHERE i = 8 * length(z.k)),
d AS (
  SELECT conv_id, turn, rid, CASE WHEN how = 4 THEN 'user' ELSE role END AS role,
         CASE how WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(CASE WHEN how = 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM h WHERE how <> 0),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, rid, copy) AS i FROM d),
f AS (
  SELECT *, left(role, 1) AS ini, lead(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS nxt,
         NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again,
         NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') AS cut
  FROM o),
g AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) AS n,
         count(*) FILTER (blank) AS blank, count(*) FILTER (NOT blank AND again) AS duplicate,
         count(*) FILTER (NOT blank AND NOT again AND cut) AS truncated,
         count(*) FILTER (nxt IS NOT NULL AND ini || nxt NOT IN ('su', 'ua', 'au')) AS illegal
  FROM f GROUP BY conv_id),
e AS (
  SELECT *, blank OR again AS gone, CASE WHEN cut THEN 1 ELSE 0 END AS late FROM f),
p(conv_id, i, q, cost, audit, said) AS (
  SELECT conv_id, CAST(0 AS BIGINT), 'n', 0, '', CAST([] AS VARCHAR[]) FROM g
  UNION ALL
  SELECT conv_id, i, q, cost, audit, said FROM (
    SELECT x.conv_id, e.i, x.audit || t.edit AS audit,
           x.cost + CASE t.edit WHEN 'D' THEN 3 WHEN 'K' THEN late ELSE 2 + late END AS cost,
           CASE WHEN t.edit = 'D' THEN x.q WHEN t.edit = 'K' AND ini = 's' THEN 's' WHEN x.q = 'u' THEN 'a' ELSE 'u' END AS q,
           CASE t.edit WHEN 'D' THEN x.said WHEN 'K' THEN list_append(x.said, role || ':' || text)
             ELSE list_append(x.said, CASE WHEN x.q = 'u' THEN 'assistant:' ELSE 'user:' END || text) END AS said
    FROM (
      SELECT conv_id, i, q, cost, audit, said FROM p
      UNION ALL
      SELECT conv_id, i, CASE WHEN q = 'u' THEN 'a' ELSE 'u' END, cost + 2, audit || 'I',
             list_append(said, CASE WHEN q = 'u' THEN 'assistant:' ELSE 'user:' END) FROM p) x
    JOIN e ON e.conv_id IS NOT DISTINCT FROM x.conv_id AND e.i = x.i + 1
    JOIN (VALUES ('D'), ('K'), ('R')) t(edit)
      ON t.edit = 'D' OR NOT gone AND (t.edit = 'R' OR ini = 's' AND x.q = 'n' OR ini = 'u' AND x.q <> 'u' OR ini = 'a' AND x.q = 'u'))
  QUALIFY row_number() OVER (PARTITION BY conv_id, q ORDER BY cost, audit) = 1),
w AS (
  SELECT p.conv_id, cost + CASE q WHEN 's' THEN 4 WHEN 'u' THEN 2 ELSE 0 END AS cost,
         audit || CASE q WHEN 's' THEN 'II' WHEN 'u' THEN 'I' ELSE '' END AS audit,
         list_concat(said, CASE q WHEN 's' THEN ['user:', 'assistant:'] WHEN 'u' THEN ['assistant:'] ELSE CAST([] AS VARCHAR[]) END) AS said
  FROM p JOIN g ON g.conv_id IS NOT DISTINCT FROM p.conv_id AND p.i = g.n),
b AS (SELECT * FROM w QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY cost, audit) = 1)
SELECT a.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(coalesce(cost, 0) AS BIGINT) AS cost,
       coalesce(audit, '') AS audit, sha256(coalesce(array_to_string(said, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) a
LEFT JOIN g ON g.conv_id IS NOT DISTINCT FROM a.conv_id
LEFT JOIN b ON b.conv_id IS NOT DISTINCT FROM a.conv_id
"""

ORACLE: dict[str, str] = {
    "op4_minhash": OP4_MINHASH,
    "op6_exact": OP6_EXACT,
    "op12_negatives": OP12_NEGATIVES,
    "op13_repair": OP13_REPAIR,
}
