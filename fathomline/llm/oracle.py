"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations

_MIX = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         md5('fathomline-mix-1|' || coalesce(doc_id::VARCHAR, 'text|' || md5(coalesce(text, '')))) AS key
  FROM documents),
s0 AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
s1 AS (SELECT *, ((row_number() OVER (ORDER BY source COLLATE "C" NULLS LAST) - 1) % 3 + 1)::DOUBLE AS w, 3.0::DOUBLE * source_size AS most FROM s0),
s2 AS (
  SELECT *, most / w AS fill, (SELECT sum(source_size) FROM s0)::DOUBLE AS total,
         coalesce(sum(most) OVER (ORDER BY most / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS used,
         sum(w) OVER (ORDER BY most / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS free
  FROM s1),
level AS (SELECT (total - used) / free AS l FROM s2 WHERE fill >= (total - used) / free ORDER BY fill, source NULLS LAST LIMIT 1),
t AS (SELECT source, source_size, least(most, w * coalesce((SELECT l FROM level), 'infinity'::DOUBLE)) AS target FROM s1),
m AS (SELECT d.source, target, source_size, length(bin(size))::DOUBLE AS imp, sum(size)::DOUBLE AS mass FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source GROUP BY ALL),
c AS (
  SELECT *, (target - 3.0::DOUBLE * coalesce(sum(mass) OVER above, 0)) / nullif(sum(mass * imp) OVER below, 0) AS k
  FROM m WINDOW above AS (PARTITION BY source ORDER BY imp DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), below AS (PARTITION BY source ORDER BY imp DESC ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
k AS (SELECT source, CASE WHEN any_value(target) >= any_value(source_size) * (3.0::DOUBLE * (1 - 1e-12::DOUBLE)) THEN 'infinity'::DOUBLE ELSE coalesce(arg_max(k, imp) FILTER (WHERE k * imp < 3.0::DOUBLE), 0) END AS k FROM c GROUP BY source),
r AS (
  SELECT d.doc_id, d.source, d.size, d.key, t.source_size, t.target,
         CASE WHEN t.source_size > 0 THEN least(3.0::DOUBLE, k.k * length(bin(d.size))::DOUBLE) ELSE 0 END AS rate,
         (('0x' || substr(d.key, 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0::DOUBLE AS u
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source JOIN k ON d.source IS NOT DISTINCT FROM k.source),
q AS (
  SELECT *, floor(rate)::BIGINT AS whole, rate - floor(rate) AS part,
         CASE WHEN rate - floor(rate) > 0 THEN (u / (1 - u)) / ((rate - floor(rate)) / (1 - (rate - floor(rate)))) ELSE 0 END AS rank FROM r),
run AS (
  SELECT *, target - sum(whole * size) OVER (PARTITION BY source) AS "left",
         sum(CASE WHEN part > 0 THEN size ELSE 0 END) OVER (PARTITION BY source ORDER BY rank, key RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto FROM q),
gap AS (SELECT source, max("left") - coalesce(max(CASE WHEN upto <= "left" THEN upto END), 0) AS gap FROM run WHERE part > 0 GROUP BY source),
odd AS (
  SELECT run.source, arg_min(key, (abs(gap - size), rank, key)) AS odd FROM run JOIN gap ON run.source IS NOT DISTINCT FROM gap.source
  WHERE part > 0 AND upto > "left" AND size > 0 AND abs(gap - size) < gap GROUP BY run.source)
SELECT doc_id, size, source_size, round(target, 6) AS target,
       ((whole + CASE WHEN part > 0 AND (upto <= "left" OR key = odd.odd) THEN 1 ELSE 0 END) * size)::BIGINT AS taken
FROM run LEFT JOIN odd ON run.source IS NOT DISTINCT FROM odd.source
"""

_TOPK = r"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.e, c.e), lambda p: coalesce(p[1], 0) * coalesce(p[2], 0)))::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""

_EXACT = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS points, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256 FROM documents),
k AS (SELECT text_sha256, arg_min(doc_id, (-points, doc_id)) AS keep_id, count(*)::BIGINT AS group_size FROM d GROUP BY text_sha256)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, d.text_sha256 FROM d JOIN k ON d.text_sha256 = k.text_sha256
"""

_WARC = r"""
WITH p AS (SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT payload_digest, min(page_id) AS first FROM p WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT page_id, payload_bytes, p.payload_digest,
       CASE WHEN first IS NULL OR first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN first <> page_id THEN first END AS refers_to
FROM p LEFT JOIN f ON p.payload_digest = f.payload_digest AND payload_bytes >= 100
"""

_LINES = r"""
WITH parts AS (SELECT doc_id, text, coalesce('s' || source, 'none') AS site, unnest(string_split(text, chr(10))) AS raw, unnest(range(len(string_split(text, chr(10))))) AS pos FROM documents WHERE text IS NOT NULL),
l AS (SELECT *, trim(raw, ' ' || chr(9) || chr(13)) AS line FROM parts),
long AS (SELECT * FROM l WHERE len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) >= 3),
spread AS (SELECT line, arg_min({'d': doc_id, 'p': pos}, (doc_id, pos)) AS first FROM long GROUP BY line HAVING count(DISTINCT site) >= 2),
gone AS (SELECT doc_id, pos FROM long JOIN spread USING (line) WHERE NOT (doc_id = first.d AND pos = first.p)),
kept AS (
  SELECT l.doc_id, count(*) AS n_lines, count(g.pos) AS n_dropped, string_agg(CASE WHEN g.pos IS NULL THEN raw END, chr(10) ORDER BY l.pos) AS text
  FROM l LEFT JOIN gone g ON l.doc_id = g.doc_id AND l.pos = g.pos GROUP BY l.doc_id)
SELECT d.doc_id, coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_dropped, 0)::BIGINT AS n_dropped,
       CASE WHEN d.text IS NOT NULL THEN sha256(coalesce(kept.text, '')) END AS text_sha256
FROM documents d LEFT JOIN kept ON d.doc_id = kept.doc_id
"""

_RANKED = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
s AS (SELECT count(*)::BIGINT AS n_docs, sum(len(w))::BIGINT AS total FROM d WHERE len(w) > 0),
i AS (SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM (SELECT DISTINCT item_id, text FROM benchmark WHERE item_id IS NOT NULL)),
asked AS (SELECT item_id, term, count(*)::BIGINT AS repeats FROM i GROUP BY ALL),
p AS (SELECT r, doc_id, n, term, count(*)::BIGINT AS tf FROM (SELECT r, doc_id, len(w)::BIGINT AS n, unnest(w) AS term FROM d) WHERE term IN (SELECT term FROM asked) GROUP BY ALL),
df AS (SELECT term, count(*)::BIGINT AS df FROM p GROUP BY term),
e AS (
  SELECT r, doc_id, p.term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * n_docs) // total))) AS impact
  FROM p JOIN df ON p.term = df.term, s),
f AS (SELECT item_id, r, doc_id, sum(repeats * impact)::BIGINT AS score FROM asked JOIN e ON asked.term = e.term GROUP BY ALL),
k AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank, doc_id, score FROM f WHERE score > 0)
SELECT * FROM k WHERE rank <= 10
"""

_DIVERGENCE = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
g AS (SELECT DISTINCT lang, source FROM d),
t AS (SELECT lang, source, term, count(*)::BIGINT AS n, count(DISTINCT r)::BIGINT AS docs FROM (SELECT lang, source, r, unnest(w) AS term FROM d) GROUP BY ALL),
kept AS (SELECT lang, term, sum(n)::BIGINT AS lang_n FROM t GROUP BY ALL HAVING sum(docs) >= 10),
l AS (SELECT lang, count(*)::BIGINT AS v, sum(lang_n)::BIGINT AS lang_total FROM kept GROUP BY lang),
total AS (SELECT t.lang, source, sum(n)::BIGINT AS total FROM t JOIN kept ON t.lang = kept.lang AND t.term = kept.term GROUP BY ALL),
every AS (SELECT g.lang, g.source, k.term, k.lang_n, l.v, l.lang_total, coalesce(total.total, 0) AS total FROM g JOIN kept k ON g.lang = k.lang JOIN l ON g.lang = l.lang LEFT JOIN total ON g.lang = total.lang AND g.source = total.source),
p AS (
  SELECT e.lang, e.source, e.term, coalesce(t.n, 0) AS n, 1 + ((1000000000::HUGEINT * (coalesce(t.n, 0) + 2)) // (total + 2 * v))::BIGINT AS p, 1 + ((1000000000::HUGEINT * (lang_n + 2)) // (lang_total + 2 * v))::BIGINT AS q
  FROM every e LEFT JOIN t ON e.lang = t.lang AND e.source = t.source AND e.term = t.term),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p))::BIGINT AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
other AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN pairs ON pairs.lang = a.lang AND pairs.source = a.source AND pairs.item = b.source),
own AS (SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q)) // (p + q) AS value FROM p WHERE n > 0 AND p > q),
r AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM (SELECT * FROM other UNION ALL SELECT * FROM own))
SELECT lang, source, part, item, value, rank FROM r WHERE part = 'pair' OR rank <= 10
"""

ORACLE_SQL: dict[str, str] = {
    "op1_mix_sources": _MIX,
    "op4_topk_search": _TOPK,
    "op5_exact_dedup": _EXACT,
    "op7_archives": _WARC,
    "op9_line_dedup": _LINES,
    "op12_divergence": _DIVERGENCE,
    "op13_ranked_search": _RANKED,
}
