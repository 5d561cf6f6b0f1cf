"""DuckDB SQL for the results of registered queries, written from their contracts."""

MIX = r"""
WITH RECURSIVE sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 15) AS BIGINT) AS turn
  FROM documents
), per AS (
  SELECT *, CAST((sid % 3) + 1 AS DOUBLE) AS w, 3 * source_size AS cap
  FROM (SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
               row_number() OVER (ORDER BY source COLLATE "C" NULLS LAST) - 1 AS sid FROM sized GROUP BY source)
), levels AS (
  SELECT *, (t - done) / rest AS level, cap / w AS ratio FROM (
    SELECT *, (SELECT CAST(sum(source_size) AS BIGINT) FROM per) AS t,
      coalesce(CAST(sum(cap) OVER (ORDER BY cap / w, sid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS BIGINT), 0) AS done,
      sum(w) OVER (ORDER BY cap / w, sid ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest FROM per)
), targets AS (
  SELECT sid, source, source_size, least(CAST(cap AS DOUBLE),
    coalesce((SELECT min_by(level, ratio) FROM levels WHERE level <= ratio) * w, CAST(cap AS DOUBLE))) AS target
  FROM levels
), goals AS (
  SELECT *, CAST(floor(target + 0.5) AS BIGINT) AS goal, (source_size + 63) // 64 AS n_blocks FROM targets
), need AS (
  SELECT *, (goal // source_size) * n_blocks + (goal % source_size + 63) // 64 AS slots FROM goals WHERE source_size > 0 AND goal > 0
), shares AS (
  SELECT *, CAST(sum(slots) OVER (ORDER BY sid) AS BIGINT) AS hi, (SELECT CAST(sum(slots) AS BIGINT) FROM need) AS n FROM need
), points AS (
  SELECT slot, (slot % 2147483648) * 1327217885 % 2147483648 AS point
  FROM (SELECT unnest(range(CAST(max(n) + ceil(3 * max(n) / min(slots)) AS BIGINT))) AS slot FROM shares)
), drawn AS (
  SELECT s.*, p.slot, row_number() OVER (PARTITION BY s.sid ORDER BY p.slot) - 1 AS k
  FROM points p JOIN shares s ON p.point * (s.n / 2147483648.0::DOUBLE) >= s.hi - s.slots AND p.point * (s.n / 2147483648.0::DOUBLE) < s.hi
), takes AS (
  SELECT sid, block, least(64, source_size - block * 64, goal - (k // n_blocks) * source_size - block * 64) AS words
  FROM (SELECT *, k % n_blocks AS block FROM drawn)
), placed AS (
  SELECT z.doc_id, z.source, z.size, g.sid, g.source_size, g.target, row_number() OVER () AS rid,
    CAST(sum(z.size) OVER (PARTITION BY g.sid ORDER BY z.turn, z.doc_id NULLS FIRST, z.size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) - z.size AS start
  FROM sized z JOIN goals g ON z.source IS NOT DISTINCT FROM g.source
), pieces AS (
  SELECT rid, sid, start, size, unnest(range(start // 64, (start + size - 1) // 64 + 1)) AS block FROM placed WHERE size > 0
), taken AS (
  SELECT p.rid, CAST(sum(greatest(0, least(p.start + p.size - p.block * 64, t.words) - greatest(p.start - p.block * 64, 0))) AS BIGINT) AS taken
  FROM pieces p JOIN takes t ON t.sid = p.sid AND t.block = p.block AND t.words > 0 GROUP BY p.rid
)
SELECT p.doc_id, p.source, p.size, p.source_size, p.target, coalesce(t.taken, 0) AS taken
FROM placed p LEFT JOIN taken t ON t.rid = p.rid
"""

URLS = r"""
WITH rules(rule_host, rule_path, rule_verdict) AS (
  VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')
), rests AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), parts AS (
  SELECT page_id, row_number() OVER () AS rid,
    translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM rests
), fits AS (
  SELECT p.rid, arg_max(r.rule_host || r.rule_path, length(r.rule_host || r.rule_path)) AS rule,
    arg_max(r.rule_verdict, length(r.rule_host || r.rule_path)) AS verdict
  FROM parts p JOIN rules r ON (p.host = r.rule_host OR ends_with(p.host, '.' || r.rule_host)) AND starts_with(p.path, r.rule_path)
  GROUP BY p.rid
)
SELECT p.page_id, p.host, p.path, f.rule, coalesce(f.verdict, 'allow') AS verdict FROM parts p LEFT JOIN fits f ON f.rid = p.rid
"""

VECTORS = """
WITH RECURSIVE usable AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v, row_number() OVER () AS rid FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
    AND len([x FOR x IN embedding IF x <> 0]) > 0
), links AS (
  SELECT a.rid, a.vec_id AS u, b.vec_id AS v FROM usable a JOIN usable b
    ON a.label = b.label AND a.rid <> b.rid AND len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.98
), reach(u, v) AS (
  SELECT u, v FROM links UNION SELECT r.u, l.v FROM reach r JOIN links l ON l.u = r.v
), counts AS (SELECT u, rid, count(*) AS n FROM links GROUP BY u, rid
), lows AS (SELECT u, min(v) AS low FROM reach GROUP BY u)
SELECT e.vec_id, coalesce(c.n, 0) AS n_links, least(e.vec_id, coalesce(l.low, e.vec_id)) AS component_id,
  e.vec_id = least(e.vec_id, coalesce(l.low, e.vec_id)) AS kept
FROM (SELECT embeddings.vec_id, u.rid FROM embeddings LEFT JOIN usable u ON u.vec_id = embeddings.vec_id) e
LEFT JOIN counts c ON c.rid = e.rid LEFT JOIN lows l ON l.u = e.vec_id
"""

WARC = """
WITH payloads AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages
), digests AS (
  SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, max(page_id) OVER (PARTITION BY hex, payload_bytes) AS response,
    list_aggregate([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
      1 + ((CAST('0x' || substr(hex || '0', CAST((5 * i) // 4 + 1 AS BIGINT), 3) AS INTEGER) >> CAST(7 - (5 * i) % 4 AS INTEGER)) & 31), 1)
      FOR i IN range(32)], 'string_agg', '') AS payload_digest
  FROM payloads
)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id <> response THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id <> response THEN response END AS refers_to
FROM digests
"""

LEAKS = r"""
WITH item_words AS (
  SELECT DISTINCT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL
), doc_words AS (
  SELECT row_number() OVER () AS rid, doc_id,
    regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents WHERE text IS NOT NULL
), item_shingles AS (
  SELECT DISTINCT item_id, shingle FROM (
    SELECT item_id, unnest([array_to_string(w[i : i + 4], ' ') FOR i IN range(1, greatest(1, len(w) - 4) + 1)]) AS shingle FROM item_words WHERE len(w) > 0)
), doc_shingles AS (
  SELECT DISTINCT rid, doc_id, shingle FROM (
    SELECT rid, doc_id, unnest([array_to_string(w[i : i + 4], ' ') FOR i IN range(1, greatest(1, len(w) - 4) + 1)]) AS shingle FROM doc_words WHERE len(w) > 0)
), sizes AS (SELECT item_id, count(*) AS n_shingles FROM item_shingles GROUP BY item_id)
SELECT d.doc_id, s.item_id, s.n_shingles, count(*) AS n_shared, count(*) / s.n_shingles AS containment
FROM doc_shingles d JOIN item_shingles i USING (shingle) JOIN sizes s ON s.item_id = i.item_id
GROUP BY d.rid, d.doc_id, s.item_id, s.n_shingles HAVING count(*) >= 0.8 * s.n_shingles
"""

TOP_K = """
WITH whole AS (
  SELECT row_number() OVER () AS rid, vec_id, [floor(CAST(x AS DOUBLE) * 1024) FOR x IN embedding] AS v FROM embeddings
  WHERE len(embedding) > 0 AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), scored AS (
  SELECT q.rid, q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM whole q JOIN whole c ON q.rid <> c.rid AND len(q.v) = len(c.v) WHERE q.vec_id % 100 = 0
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY rid ORDER BY score DESC, vec_id NULLS LAST) AS INTEGER) AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""
