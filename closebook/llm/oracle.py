"""DuckDB SQL for the queries that SQL can express, written from the contract."""

OP1 = """
WITH v AS (
  SELECT vec_id, [floor(256 * x::DOUBLE) FOR x IN embedding] AS e, len(embedding) AS d
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR isnan(x) OR isinf(x)]) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND q.d = c.d),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank
  FROM scored)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 5
"""

OP6 = r"""
WITH d AS (
  SELECT source, lang, doc_id, min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS first,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS words,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]{25,}')) AS long_words,
    len(regexp_extract_all(coalesce(text, ''),
      '[A-Za-z\x{80}-\x{10FFFF}]+|[0-9]+|[^A-Za-z0-9\x{80}-\x{10FFFF}\x20\x09-\x0D]')) AS pieces
  FROM documents),
kept AS (SELECT * FROM d WHERE doc_id IS NULL OR doc_id = first)
SELECT source, lang, 'words-1' AS tokenizer, count(*) AS n_docs,
       CAST(sum(words - long_words) AS BIGINT) AS n_tokens FROM kept GROUP BY 1, 2
UNION ALL
SELECT source, lang, 'pieces-2', count(*), CAST(sum(pieces) AS BIGINT) FROM kept GROUP BY 1, 2
"""

# The capping order is walked source by source, as the sharing rule states it:
# a round takes the sources above three times their size out at that bound.
OP8 = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, source,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
  FROM documents),
s AS (
  SELECT source, sum(size)::DOUBLE AS held,
         (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS w
  FROM d GROUP BY source),
rounds AS (
  SELECT 0 AS n, sum(held) / sum(w) AS level FROM s
  UNION ALL
  SELECT r.n + 1, (
      SELECT (sum(held) - sum(CASE WHEN w * r.level > 3 * held THEN 3 * held ELSE 0 END))
             / sum(CASE WHEN w * r.level > 3 * held THEN 0 ELSE w END) FROM s)
  FROM rounds r WHERE r.n < 50),
final AS (
  SELECT source, held,
         least(3 * held, w * (SELECT level FROM rounds ORDER BY n DESC LIMIT 1)) AS target FROM s),
placed AS (
  SELECT d.doc_id, d.size, CAST(f.held AS BIGINT) AS source_size, f.target,
         CAST(floor(f.target + 0.5) AS BIGINT) AS budget,
         coalesce(sum(d.size) OVER (
           PARTITION BY d.source
           ORDER BY substr(md5('mix:' || coalesce(d.doc_id::VARCHAR, '')), 1, 15),
                    d.doc_id NULLS FIRST, d.size
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM d JOIN final f ON d.source IS NOT DISTINCT FROM f.source)
SELECT doc_id, size, source_size, target,
       CAST(CASE WHEN source_size = 0 THEN 0 ELSE
         least(3, budget // source_size) * size
         + greatest(0, least(size, budget - least(3, budget // source_size) * source_size - before))
       END AS BIGINT) AS taken
FROM placed
"""

OP10 = r"""
WITH lines AS (
  SELECT doc_id, row_id, generate_subscripts(l, 1) AS pos, unnest(l) AS line
  FROM (SELECT doc_id, row_number() OVER () AS row_id,
               string_split(coalesce(text, ''), chr(10)) AS l FROM documents)),
keyed AS (
  SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines),
shared AS (
  SELECT key, max(doc_id) AS keeper FROM keyed
  WHERE length(key) >= 40 AND doc_id IS NOT NULL GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
judged AS (
  SELECT k.*, coalesce(k.doc_id < s.keeper, FALSE) AS gone
  FROM keyed k LEFT JOIN shared s USING (key))
SELECT doc_id, count(*) AS n_lines, CAST(count(*) FILTER (WHERE gone) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), ''))
         AS kept_sha256
FROM judged GROUP BY doc_id, row_id
"""

OP11 = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, [x::DOUBLE FOR x IN embedding] AS e,
         coalesce(vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
           AND len([x FOR x IN embedding IF x IS NULL OR isnan(x) OR isinf(x)]) = 0
           AND len([x FOR x IN embedding IF x <> 0]) > 0, FALSE) AS fit
  FROM embeddings),
links AS (
  SELECT a.vec_id AS x, b.vec_id AS y
  FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE a.fit AND b.fit AND list_inner_product(a.e, b.e)
    / (sqrt(list_inner_product(a.e, a.e)) * sqrt(list_inner_product(b.e, b.e))) >= 0.93),
degrees AS (SELECT x, count(DISTINCT y) AS n FROM links GROUP BY x),
reach AS (
  SELECT x, x AS y FROM links
  UNION
  SELECT r.x, l.y FROM reach r JOIN links l ON l.x = r.y),
roots AS (SELECT x, min(y) AS root FROM reach GROUP BY x)
SELECT v.vec_id, CAST(coalesce(d.n, 0) AS BIGINT) AS n_links,
       coalesce(r.root, v.vec_id) AS component_id,
       coalesce(v.vec_id = coalesce(r.root, v.vec_id), FALSE) AS kept
FROM v LEFT JOIN degrees d ON d.x = v.vec_id LEFT JOIN roots r ON r.x = v.vec_id
"""

# CRC-32 of a number's digits by the usual table, made from its polynomial. A
# node is a list of turns; a subtree's nodes are those whose smallest member
# passes through its top.
OP13 = """
WITH crc_table AS (
  SELECT list(list_reduce(list_prepend(i, range(8)), lambda c, k:
           CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
  FROM range(256) r(i)),
ids AS (
  SELECT conv_id, xor(list_reduce(
           list_prepend(4294967295::BIGINT,
             [ascii(ch)::BIGINT FOR ch IN string_split(conv_id::VARCHAR, '')]),
           lambda c, b: xor(c >> 8, t[xor(c % 256, b) + 1])), 4294967295) % 6 AS h
  FROM (SELECT DISTINCT conv_id FROM conversations WHERE conv_id IS NOT NULL), crc_table),
turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
built AS (
  SELECT i.conv_id, t.pos, t.role, t.text FROM ids i JOIN turns t
    ON t.conv_id = i.conv_id - i.conv_id % 100 AND t.pos <= i.h
  UNION ALL
  SELECT i.conv_id, t.pos, t.role, t.text FROM ids i JOIN turns t
    ON t.conv_id = i.conv_id AND t.pos > i.h),
whole AS (
  SELECT i.conv_id, coalesce(list(md5(b.role || chr(31) || b.text) ORDER BY b.pos)
           FILTER (WHERE b.pos IS NOT NULL), []) AS turns,
         coalesce(list(length(b.text) ORDER BY b.pos) FILTER (WHERE b.pos IS NOT NULL), [])
           AS sizes
  FROM ids i LEFT JOIN built b ON b.conv_id = i.conv_id GROUP BY i.conv_id),
members AS (
  SELECT conv_id, d AS depth, turns[1:d] AS path, turns[1:d - 1] AS up, sizes[d] AS chars,
         len(turns) = d AS ends
  FROM whole, LATERAL (SELECT unnest(range(len(turns) + 1)) AS d)),
nodes AS (
  SELECT path, min(up) AS up, min(conv_id) AS conv_id, depth, count(*) AS n_convs,
         (count(*) - 1) * coalesce(min(chars), 0) AS saved,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)
                           FILTER (WHERE ends), '')) AS ends_sha256
  FROM members GROUP BY path, depth),
children AS (SELECT up AS path, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY up),
shaped AS (SELECT n.*, coalesce(c.n, 0) AS n_children FROM nodes n LEFT JOIN children c USING (path)),
totals AS (
  SELECT m.path, count(*) FILTER (WHERE s.n_children = 0) AS n_leaves, sum(s.saved) AS saved
  FROM shaped s JOIN members m ON m.conv_id = s.conv_id AND m.depth <= s.depth GROUP BY m.path)
SELECT s.conv_id, CAST(s.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, s.n_convs,
       CAST(s.n_children AS BIGINT) AS n_children, CAST(t.n_leaves AS BIGINT) AS n_leaves,
       CAST(t.saved AS BIGINT) AS saved_tokens, s.ends_sha256
FROM shaped s JOIN totals t USING (path)
LEFT JOIN nodes p ON s.depth > 0 AND p.path = s.up
"""

ORACLE_SQL = {"op1_exact_topk": OP1, "op6_token_rollup": OP6, "op8_mix_sources": OP8,
              "op10_line_dedup": OP10, "op11_embedding_dedup": OP11, "op13_prefix_trie": OP13}
