"""DuckDB SQL for the operators that SQL can express, on the registered tables.

Packing, sharding and mixing depend on their method, language identification on a fitted model and
the hash forest is approximate: those are tested against brute force in ``tests/llm``.
"""

SPACES = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"

OP1 = rf"""
WITH w AS (
  SELECT doc_id, source, text, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{WORD}') AS words FROM documents),
windows AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, words[i], words[i + 1], words[i + 2]) AS n
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM w)),
covered AS (
  SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words FROM windows, (SELECT unnest([0, 1, 2]) AS k) WHERE n > 1 GROUP BY doc_id),
lines AS (
  SELECT doc_id, source, text, trim(regexp_replace(lower(raw), '{SPACES}', ' ', 'g')) AS line
  FROM (SELECT doc_id, source, text, unnest(string_split(text, chr(10))) AS raw FROM documents)),
common AS (
  SELECT source, line, min(doc_id) AS first_doc FROM lines WHERE line <> '' GROUP BY source, line HAVING count(DISTINCT (doc_id, text)) > 10),
removed AS (
  SELECT l.doc_id, sum(len(string_split(l.line, ' ')))::BIGINT AS n FROM lines l
  JOIN common c ON l.source IS NOT DISTINCT FROM c.source AND l.line = c.line WHERE l.doc_id <> c.first_doc GROUP BY l.doc_id),
base AS (
  SELECT w.doc_id, len(words)::BIGINT AS n_words, length(regexp_replace(t, '{SPACES}', '', 'g'))::BIGINT AS word_chars,
    (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    (len(list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{WORD}')))
      - len(list_distinct(list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{WORD}')))))::BIGINT AS n_dup_lines,
    coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words, coalesce(r.n, 0)::BIGINT AS n_removed_words
  FROM w LEFT JOIN covered c ON c.doc_id = w.doc_id LEFT JOIN removed r ON r.doc_id = w.doc_id)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND n_words - n_removed_words >= 0.3 * n_words AS kept, n_removed_words
FROM base
"""

OP3 = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS k FROM turns),
lasts AS (
  SELECT conv_id, max(k) AS last, max_by(text, k) AS said FROM ranked WHERE role = 'assistant' GROUP BY conv_id),
others AS (
  SELECT a.conv_id, a.last, coalesce(
    (SELECT min_by(b.said, b.conv_id) FROM lasts b WHERE floor(b.conv_id / 1024) = floor(a.conv_id / 1024) AND b.conv_id > a.conv_id),
    (SELECT min_by(b.said, b.conv_id) FROM lasts b WHERE floor(b.conv_id / 1024) = floor(a.conv_id / 1024) AND b.conv_id < a.conv_id), '') AS other
  FROM lasts a),
sides AS (
  SELECT r.conv_id AS pair_id, list({'role': role, 'text': text} ORDER BY k) AS c,
    list({'role': role, 'text': CASE WHEN k = o.last THEN o.other ELSE text END} ORDER BY k) AS r
  FROM ranked r LEFT JOIN others o ON o.conv_id = r.conv_id GROUP BY r.conv_id),
pairs AS (
  SELECT pair_id, c, r, coalesce(list_position(list_transform(range(1, len(c) + 1), lambda i: c[i] <> r[i]), true) - 1, len(c))::INTEGER AS n_common
  FROM sides),
made AS (
  SELECT pair_id, n_common, list_transform(c, lambda t: '<|' || t.role || '|>' || chr(10) || t.text || '<|end|>' || chr(10)) AS cs,
    list_transform(r, lambda t: '<|' || t.role || '|>' || chr(10) || t.text || '<|end|>' || chr(10)) AS rs,
    list_transform(c, lambda t: t.role) AS cr, list_transform(r, lambda t: t.role) AS rr FROM pairs),
cut AS (
  SELECT pair_id, n_common, cs[1:n_common] AS p, cs[n_common + 1:] AS cs, rs[n_common + 1:] AS rs, cr[n_common + 1:] AS cr, rr[n_common + 1:] AS rr FROM made),
sized AS (
  SELECT *, list_transform(cs, lambda x: length(x)) AS cl, list_transform(rs, lambda x: length(x)) AS rl FROM cut)
SELECT pair_id, n_common, array_to_string(p, '') AS prompt, array_to_string(cs, '') AS chosen, array_to_string(rs, '') AS rejected,
  array_to_string(list_transform(list_filter(range(1, len(cs) + 1), lambda i: cr[i] = 'assistant'), lambda i:
    (coalesce(list_sum(cl[1:i - 1]), 0) + length(cr[i]) + 5)::BIGINT || '-' || list_sum(cl[1:i])::BIGINT), ',') AS chosen_spans,
  array_to_string(list_transform(list_filter(range(1, len(rs) + 1), lambda i: rr[i] = 'assistant'), lambda i:
    (coalesce(list_sum(rl[1:i - 1]), 0) + length(rr[i]) + 5)::BIGINT || '-' || list_sum(rl[1:i])::BIGINT), ',') AS rejected_spans
FROM sized
"""

OP4 = r"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, strlen(coalesce(text, ''))::BIGINT AS n_bytes FROM documents),
starts AS (
  SELECT doc_id, i, md5_number(substr(h, 2 * i + 1, 400)) AS s FROM (SELECT doc_id, h, unnest(range(0, n_bytes - 199)) AS i FROM d)),
twice AS (SELECT doc_id, i FROM starts WHERE s IN (SELECT s FROM starts GROUP BY s HAVING count(*) > 1)),
islands AS (
  SELECT doc_id, i, sum(CASE WHEN i - before <= 200 THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY i) AS k
  FROM (SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS before FROM twice)),
spans AS (SELECT doc_id, k, min(i) AS a, max(i) + 200 AS b FROM islands GROUP BY doc_id, k),
cuts AS (
  SELECT doc_id, sum(b - a)::BIGINT AS n_removed, count(*)::BIGINT AS n_spans,
    list_concat([0], list(b ORDER BY a)) AS begins, list(a ORDER BY a) AS ends FROM spans GROUP BY doc_id)
SELECT d.doc_id, n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
  sha256(unhex(CASE WHEN n_spans IS NULL THEN h ELSE array_to_string(list_transform(range(1, len(begins) + 1), lambda i:
    substr(h, 2 * begins[i] + 1, 2 * (coalesce(ends[i], n_bytes) - begins[i]))), '') END)) AS kept_sha256
FROM d LEFT JOIN cuts ON cuts.doc_id = d.doc_id
"""

OP6 = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
r AS (SELECT h, max(page_id) AS first FROM p GROUP BY h)
SELECT page_id, strlen(html)::BIGINT AS payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + ((('0x' || substr(p.h, (1 + 5 * (k // 4))::BIGINT, 5))::BIGINT >> (15 - 5 * (k % 4))::BIGINT) & 31)::BIGINT, 1)), '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to
FROM p JOIN r ON p.h = r.h
"""

OP10 = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}') AS words
  FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
    ELSE list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' ')) END) AS s FROM w),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (
  SELECT x, y FROM common JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y WHERE 100 * common.n >= 80 * (p.n + q.n - common.n)),
reach AS (SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT reach.x, links.y FROM reach JOIN links ON reach.y = links.x)
SELECT d.doc_id, coalesce(s.n, 0)::BIGINT AS n_shingles, r.component_id
FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id
JOIN (SELECT x, min(y) AS component_id FROM reach GROUP BY x) r ON r.x = d.doc_id
"""

OP11 = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{WORD}') AS words FROM documents),
firsts AS (SELECT t, min(doc_id) AS first FROM d GROUP BY t),
l AS (SELECT doc_id, max(quality) AS quality, max(toxic) AS toxic FROM labels GROUP BY doc_id),
docs AS (
  SELECT d.part, quality = 1 AS good, toxic = 1 AS toxic,
    array_to_string([CASE WHEN len(words) < 200 THEN 'A' ELSE '' END,
      CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 'B' ELSE '' END,
      CASE WHEN 100 * length(regexp_replace(d.t, '[^A-Z]', '', 'g')) > 3 * length(d.t) THEN 'C' ELSE '' END,
      CASE WHEN regexp_matches(d.t, '[#$%&*|]') THEN 'D' ELSE '' END,
      CASE WHEN d.doc_id > first THEN 'E' ELSE '' END], '') AS fails
  FROM d JOIN firsts f ON f.t = d.t LEFT JOIN l ON l.doc_id = d.doc_id),
cells AS (
  SELECT part, fails, count(*) AS n, count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE toxic) AS toxic FROM docs GROUP BY ALL),
orders AS (
  SELECT '' AS o UNION ALL
  SELECT o || f FROM orders, (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f) WHERE length(o) < 5 AND NOT contains(o, f)),
steps AS (
  SELECT o AS filter_order, step::INTEGER AS step, substr(o, step, 1) AS f, substr(o, 1, step - 1) AS before
  FROM orders, (SELECT unnest(range(1, 6)) AS step) WHERE length(o) = 5),
told AS (
  SELECT part, filter_order, step, f,
    sum(CASE WHEN translate(fails, before || f, '') = fails THEN n ELSE 0 END)::BIGINT AS kept,
    sum(CASE WHEN translate(fails, before, '') = fails AND contains(fails, f) THEN n ELSE 0 END)::BIGINT AS removed,
    sum(CASE WHEN translate(fails, before, '') <> fails AND contains(fails, f) THEN n ELSE 0 END)::BIGINT AS redundant,
    sum(CASE WHEN fails = f THEN n ELSE 0 END)::BIGINT AS unique_fails,
    sum(CASE WHEN translate(fails, before, '') = fails AND contains(fails, f) THEN good ELSE 0 END)::BIGINT AS good_lost,
    sum(CASE WHEN translate(fails, before, '') = fails AND contains(fails, f) THEN toxic ELSE 0 END)::BIGINT AS toxic_lost
  FROM cells, steps GROUP BY ALL)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  sum(removed) OVER (PARTITION BY part, f)::BIGINT AS shapley
FROM told
"""


OP12 = r"""
WITH RECURSIVE v AS (
  SELECT vec_id, e, sqrt(list_sum(list_transform(e, lambda x: x * x))) AS norm FROM (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings)
  WHERE len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_inner_product(a.e, b.e) / (a.norm * b.norm) >= 0.9),
reach AS (SELECT vec_id AS x, vec_id AS y FROM embeddings UNION SELECT reach.x, links.y FROM reach JOIN links ON reach.y = links.x),
classes AS (SELECT x, min(y) AS component_id FROM reach GROUP BY x)
SELECT vec_id, (SELECT count(*) FROM links WHERE x = vec_id)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN classes ON x = vec_id
"""


def _rounds(n: int) -> str:
    """CTEs of assignment and movement: centroids c0 (given) to c<n>, nearest centroids a0 to a<n>."""
    out = []
    for i in range(n + 1):
        out.append(f"""
d{i} AS (SELECT v.rid, c.cluster, sum((v.x - c.x) * (v.x - c.x))::BIGINT AS distance FROM v JOIN c{i} c ON c.d = v.d GROUP BY ALL),
a{i} AS (SELECT rid, min_by(cluster, (distance, cluster)) AS cluster, min(distance) AS distance FROM d{i} GROUP BY rid)""")
        if i < n:
            out.append(f"""
m{i} AS (SELECT a.cluster, v.d, sum(v.x)::BIGINT AS s, count(*) AS n FROM a{i} a JOIN v ON v.rid = a.rid GROUP BY ALL),
c{i + 1} AS (
  SELECT c.cluster, c.d, CASE WHEN n IS NULL THEN c.x WHEN s >= 0 THEN s // n ELSE -((n - 1 - s) // n) END AS x
  FROM c{i} c LEFT JOIN m{i} m ON m.cluster = c.cluster AND m.d = c.d)""")
    return ",".join(out)


OP13 = rf"""
WITH kept AS (
  SELECT row_number() OVER () AS rid, vec_id, embedding FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
v AS MATERIALIZED (
  SELECT rid, unnest(range(1, 65)) AS d, unnest(list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT)) AS x FROM kept),
starts AS (
  SELECT rid, (row_number() OVER (ORDER BY sha256('1:' || vec_id), embedding) - 1)::INTEGER AS cluster FROM kept
  ORDER BY cluster LIMIT 16),
c0 AS (SELECT s.cluster, v.d, v.x FROM starts s JOIN v ON v.rid = s.rid),{_rounds(3)},
digests AS (SELECT cluster, sha256(string_agg(x::VARCHAR, ',' ORDER BY d)) AS centroid_sha256 FROM c3 GROUP BY cluster)
SELECT k.vec_id, a.cluster, a.distance, (sum(a.distance) OVER (PARTITION BY a.cluster))::BIGINT AS cluster_inertia,
  (sum(a.distance) OVER ())::BIGINT AS inertia, g.centroid_sha256
FROM a3 a JOIN kept k ON k.rid = a.rid JOIN digests g ON g.cluster = a.cluster
"""

ORACLE = {"op1_quality_rules": OP1, "op3_preferences": OP3, "op4_suffix_dedup": OP4, "op6_warc": OP6, "op10_jaccard_join": OP10, "op11_filter_audit": OP11,
          "op12_embedding_neardup": OP12, "op13_centroid_clustering": OP13}
