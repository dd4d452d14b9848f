"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

_OP1 = """
WITH v AS (
  SELECT vec_id, min(list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 64) AS BIGINT))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
  GROUP BY vec_id
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id
  WHERE q.vec_id % 20 = 0
)
SELECT query_id, rank, vec_id, score FROM (
  SELECT query_id, vec_id, score,
         CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
  FROM s) WHERE rank <= 20
"""

# Windows as in the operator: budget 1024, history 256 tokens and 2 turns, 4 bytes a token.
_OP2 = r"""
WITH t AS (
  SELECT CAST(conv_id AS BIGINT) AS conv_id, CAST(turn AS BIGINT) AS turn, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), o AS (
  SELECT *, (strlen(text) + 3) // 4 + 4 AS tokens,
         row_number() OVER w - 1 AS idx
  FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
), p AS (
  SELECT *, sum(tokens) OVER (PARTITION BY conv_id ORDER BY idx) - tokens AS start,
         max(CASE WHEN idx = 0 AND role = 'system' THEN tokens END) OVER (PARTITION BY conv_id) AS sys,
         length(text) + length(regexp_replace(text, '[^\\<\[|]', '', 'g')) AS body,
         length(role) + length(regexp_replace(role, '[^\\<\[|]', '', 'g')) AS mark
  FROM o
), b AS (
  SELECT *, sys IS NOT NULL AND idx = 0 AS head, start - coalesce(sys, 0) AS bg,
         greatest(768 - coalesce(sys, 0), 256) AS room, mark + body + 5 + 8 AS chars
  FROM p
), w AS (
  SELECT *, CASE WHEN head THEN 0 ELSE
      2 * (bg // room) + CAST(bg + tokens > (bg // room + 1) * room AND bg > (bg // room) * room AS BIGINT) END AS win
  FROM b
), f AS (
  SELECT conv_id, win, min(idx) AS first, min(CASE WHEN head THEN 0 ELSE bg END) AS bg FROM w GROUP BY 1, 2
), h AS (
  SELECT f.conv_id, sum(w.chars) AS chars FROM f JOIN w
    ON w.conv_id = f.conv_id AND w.idx BETWEEN f.first - 2 AND f.first - 1 AND NOT w.head AND f.bg - w.bg <= 256
  GROUP BY 1
), s AS (
  SELECT f.conv_id, sum(w.chars) AS chars FROM f JOIN w ON w.conv_id = f.conv_id AND w.head WHERE f.first > 0 GROUP BY 1
), g AS (
  SELECT conv_id, count(*) AS n_turns, sum(chars) AS chars,
         string_agg(role || chr(10) || text || chr(10), '' ORDER BY idx) AS turns,
         coalesce(string_agg(text, '' ORDER BY idx) FILTER (WHERE role = 'assistant'), '') AS learned
  FROM w GROUP BY 1
), n AS (SELECT conv_id, count(*) AS n_windows FROM f GROUP BY 1)
SELECT g.conv_id, n_turns, sha256(turns) AS turns_sha256, CAST(length(learned) AS BIGINT) AS loss_chars,
       sha256(learned) AS loss_sha256,
       CAST(g.chars + coalesce(h.chars, 0) + coalesce(s.chars, 0) AS BIGINT) AS formatted_chars, n_windows
FROM g JOIN n USING (conv_id) LEFT JOIN h USING (conv_id) LEFT JOIN s USING (conv_id)
"""

# Absolute links only; the operator also resolves relative ones.
_OP3 = r"""
WITH RECURSIVE rules(action, host, path) AS (VALUES
  ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
  ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
links AS (
  SELECT url, unnest([
    regexp_extract(regexp_extract(html, '(?is)<link\b[^>]*\brel\s*=\s*["'']?canonical\b[^>]*>'), '(?is)\bhref\s*=\s*["'']?([^"''\s>]+)', 1),
    regexp_extract(regexp_extract(html, '(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*["'']?refresh\b[^>]*>'), '(?is)\burl\s*=\s*["'']?([^"''\s>]+)', 1)]) AS href
  FROM pages WHERE url IS NOT NULL AND html IS NOT NULL),
named AS (
  SELECT DISTINCT url, url[:strpos(url, '://') + 2]
    || translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')
    || regexp_replace(string_split(url[strpos(url, '://') + 3:], '#')[1], '^[^/?]*', '') AS node
  FROM (SELECT url FROM pages UNION SELECT replace(href, '&amp;', '&') FROM links) WHERE url LIKE '%://%'),
edges AS (
  SELECT a.node AS a, b.node AS b FROM links l JOIN named a ON a.url = l.url
  JOIN named b ON b.url = replace(l.href, '&amp;', '&') WHERE a.node <> b.node),
both_ways AS (SELECT a, b FROM edges UNION SELECT b, a FROM edges),
reach(a, b) AS (SELECT a, a FROM both_ways UNION SELECT r.a, e.b FROM reach r JOIN both_ways e ON r.b = e.a),
parts AS (
  SELECT url, translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path
  FROM (SELECT url FROM pages UNION SELECT node FROM named)),
own AS (
  SELECT p.url, arg_max(r.host || r.path, length(r.host || r.path)) AS rule, arg_max(r.action, length(r.host || r.path)) AS action
  FROM parts p JOIN rules r ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)
  GROUP BY p.url),
spread AS (
  SELECT r.a, min(r.b) AS component, bool_or(o.action = 'block') AS block FROM reach r LEFT JOIN own o ON o.url = r.b GROUP BY r.a)
SELECT p.page_id, coalesce(x.host, '') AS host, coalesce(x.path, '') AS path, o.rule,
       coalesce(o.action, CASE WHEN s.block THEN 'block' END, 'allow') AS verdict, coalesce(s.component, n.node) AS component
FROM pages p LEFT JOIN parts x ON x.url = p.url LEFT JOIN own o ON o.url = p.url
LEFT JOIN named n ON n.url = p.url LEFT JOIN spread s ON s.a = n.node
"""

_OP5 = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size,
         CAST('0x' || substr(md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) AS h
  FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source
), w AS (
  SELECT *, [3, 1, 2][(row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1] AS w FROM s
), c AS (
  SELECT *, 3 * (SELECT sum(source_size) FROM w) AS total, sum(w) OVER () AS weight,
         coalesce(sum(2 * source_size) OVER o, 0) AS caps, coalesce(sum(w) OVER o, 0) AS capped
  FROM w WINDOW o AS (ORDER BY 2 * source_size / w, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), f AS (
  SELECT *, w * (total - 2 * caps) >= 2 * source_size * 2 * (weight - capped) AS is_full FROM c
), l AS (
  SELECT *, total - 2 * coalesce(sum(2 * source_size) FILTER (WHERE is_full) OVER (), 0) AS lev,
         2 * (weight - coalesce(sum(w) FILTER (WHERE is_full) OVER (), 0)) AS den FROM f
), t AS (
  SELECT source, source_size, CASE WHEN is_full THEN CAST(2 * source_size AS DOUBLE)
         ELSE CAST(CAST(w * lev AS BIGINT) AS DOUBLE) / CAST(CAST(den AS BIGINT) AS DOUBLE) END AS target FROM l
), q AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS whole FROM t
), g AS (
  SELECT d.source, h, CAST(sum(size) AS BIGINT) AS words FROM d GROUP BY 1, 2
), r AS (
  SELECT source, h, words, coalesce(sum(words) OVER (PARTITION BY source ORDER BY h ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM g
), cut AS (
  SELECT r.source, max(h) AS cut FROM r JOIN q ON r.source IS NOT DISTINCT FROM q.source
  WHERE before + words / 2 < target - whole * source_size GROUP BY 1
)
SELECT doc_id, size, source_size, target, whole + CASE WHEN h <= cut THEN 1 ELSE 0 END AS copies,
       size * (whole + CASE WHEN h <= cut THEN 1 ELSE 0 END) AS taken
FROM d JOIN q ON d.source IS NOT DISTINCT FROM q.source LEFT JOIN cut ON d.source IS NOT DISTINCT FROM cut.source
"""

_OP7 = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, g FROM (
    SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
      ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS g FROM d)
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1
), p AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY 1, 2
), l AS (
  SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)
), r(a, b) AS (SELECT doc_id, doc_id FROM d UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a
), m AS (SELECT a, min(b) AS component_id FROM r GROUP BY 1)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, m.component_id FROM d LEFT JOIN n USING (doc_id) JOIN m ON m.a = d.doc_id
"""

_OP8 = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), x AS (
  SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d)
), m AS (SELECT g, min(doc_id) AS least FROM x GROUP BY g
), c AS (
  SELECT DISTINCT doc_id, i + k AS spot FROM (
    SELECT x.doc_id, x.i, unnest(range(13)) AS k FROM x JOIN m ON x.g = m.g WHERE m.least < x.doc_id)
), r AS (SELECT doc_id, list(spot) AS gone FROM c GROUP BY 1)
SELECT d.doc_id, len(w) AS n_words, coalesce(len(gone), 0) AS n_removed,
       sha256(array_to_string(CASE WHEN gone IS NULL THEN w
         ELSE list_filter(w, lambda v, j: NOT list_contains(gone, j)) END, ' ')) AS kept_sha256
FROM d LEFT JOIN r ON r.doc_id = d.doc_id
"""

_OP11 = """
WITH v AS (
  SELECT vec_id, min({'label': CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END,
    'v': list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 256) AS BIGINT))}) AS r
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
  GROUP BY vec_id
), s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.r.label = b.r.label AS same,
         CAST(list_sum(list_transform(list_zip(a.r.v, b.r.v), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0
), p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
), n AS (
  SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score,
         CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
  WHERE 50 * positive_score <= 100 * s.score AND 100 * s.score <= 95 * positive_score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3
"""

# crc32 bit by bit over the decimal digits; trees and folds level by level.
_OP12 = r"""
WITH RECURSIVE d AS (
  SELECT *, coalesce(xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ord(c) AS BIGINT))),
      lambda crc, b: list_reduce([xor(crc, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda a, z: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)
    ), 4294967295) % 7 = 0, false) AS hit FROM documents
), e AS (
  SELECT *, coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-') AS before,
         coalesce(strlen(text) || ':' || text, '-') AS after FROM d
), l AS (
  SELECT doc_id, lang, sha256(before || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') || after) AS leaf,
         sha256(before || coalesce(strlen(CAST(n_chars + hit::INT AS VARCHAR)) || ':' || (n_chars + hit::INT), '-') || after) AS altered FROM e
), o AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM l
), t(lang, k, i, h) AS (
  SELECT lang, 0, i, leaf FROM o
  UNION ALL
  SELECT lang, k + 1, i // 2, sha256(string_agg(h, '' ORDER BY i))
  FROM (SELECT *, count(*) OVER (PARTITION BY lang) AS n FROM t) WHERE n > 1 GROUP BY lang, k, i // 2
), s AS (
  SELECT lang, arg_max(h, k) AS subroot, max(k) AS height, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS i FROM t GROUP BY lang
), u(k, i, h) AS (
  SELECT 0, i, subroot FROM s
  UNION ALL
  SELECT k + 1, i // 2, sha256(string_agg(h, '' ORDER BY i)) FROM (SELECT *, count(*) OVER () AS n FROM u) WHERE n > 1 GROUP BY k, i // 2
), b AS (
  SELECT o.lang, o.i, t.k, t.h, (o.i >> t.k) % 2 = 1 AS before
  FROM o JOIN t ON o.lang IS NOT DISTINCT FROM t.lang AND t.i = xor(o.i >> t.k, 1)
  UNION ALL
  SELECT o.lang, o.i, s.height + u.k, u.h, (s.i >> u.k) % 2 = 1
  FROM o JOIN s ON o.lang IS NOT DISTINCT FROM s.lang JOIN u ON u.i = xor(s.i >> u.k, 1)
), f(lang, i, k, h) AS (
  SELECT lang, i, 0, altered FROM o
  UNION ALL
  SELECT f.lang, f.i, f.k + 1, sha256(CASE WHEN b.h IS NULL THEN f.h WHEN b.before THEN b.h || f.h ELSE f.h || b.h END)
  FROM f JOIN s ON f.lang IS NOT DISTINCT FROM s.lang
  LEFT JOIN b ON b.lang IS NOT DISTINCT FROM f.lang AND b.i = f.i AND b.k = f.k
  WHERE f.k < s.height + (SELECT max(k) FROM u)
), p AS (SELECT lang, i, string_agg(h, '' ORDER BY k) AS h FROM b GROUP BY 1, 2
), g AS (SELECT lang, i, arg_max(h, k) AS h FROM f GROUP BY 1, 2
)
SELECT o.doc_id, o.leaf, s.subroot, r.root, sha256(coalesce(p.h, '')) AS proof_sha256, g.h AS folded_root, g.h = r.root AS verified
FROM o JOIN s ON o.lang IS NOT DISTINCT FROM s.lang
JOIN g ON g.lang IS NOT DISTINCT FROM o.lang AND g.i = o.i
LEFT JOIN p ON p.lang IS NOT DISTINCT FROM o.lang AND p.i = o.i
CROSS JOIN (SELECT arg_max(h, k) AS root FROM u) r
"""

# The tree over all texts and edited texts.
_OP13 = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, CAST(length(coalesce(text, '')) AS BIGINT) AS n FROM documents
), o AS (
  SELECT *, coalesce(lead(text) OVER w, first_value(text) OVER w) AS next FROM d WINDOW w AS (ORDER BY doc_id DESC)
), e AS (
  SELECT *, substring(text, 1, n - n // 3) || substring(next, 1, n // 3) AS edited FROM o
), x AS (SELECT text AS t FROM e UNION SELECT edited FROM e
), s AS (
  SELECT t, list_transform(string_split(t, chr(10)), lambda p: list_transform(
           regexp_extract_all(p, '^[^.!?]{1,12}[.!?]*|[^.!?]{1,48}[.!?]*|[.!?]+'), lambda s: sha256(s))) AS ds FROM x
), p AS (
  SELECT t, list_transform(ds, lambda l: {'d': sha256(array_to_string(l, '')), 's': array_to_string(list_transform(l, lambda y: ',' || y[1:8]), '')}) AS ps,
         list_distinct(list_transform(flatten(ds), lambda y: y[1:8])) AS leaves FROM s
), c AS (
  SELECT *, list_filter(range(1, len(ps) + 1), lambda i: i = len(ps) OR ps[i].s = '' OR ps[i].d[1] < '4') AS ends FROM p
), g AS (
  SELECT t, leaves, list_transform(ends, lambda e, j: ps[CASE WHEN j = 1 THEN 1 ELSE ends[j - 1] + 1 END:e]) AS gs FROM c
), h AS (
  SELECT t, leaves, list_transform(gs, lambda g: {'d': sha256(array_to_string(list_transform(g, lambda p: p.d), '')),
           's': array_to_string(list_transform(g, lambda p: p.d[1:8] || p.s), ';')}) AS ss FROM g
), f AS (
  SELECT t, leaves, sha256(array_to_string(list_transform(ss, lambda s: s.d), ''))
           || array_to_string(list_transform(ss, lambda s: '|' || s.d[1:8] || ':' || s.s), '') AS f FROM h
)
SELECT doc_id, n AS n_chars, sha256(edited) AS edited_sha256, a.f AS fingerprint, b.f AS edited_fingerprint,
       CASE WHEN a.f[1:64] = b.f[1:64] THEN 1.0::DOUBLE WHEN len(a.leaves) + len(b.leaves) = 0 THEN 0.0::DOUBLE
         ELSE len(list_intersect(a.leaves, b.leaves))::DOUBLE / len(list_distinct(a.leaves || b.leaves)) END AS near_edited,
       CASE WHEN a.f[1:64] = c.f[1:64] THEN 1.0::DOUBLE WHEN len(a.leaves) + len(c.leaves) = 0 THEN 0.0::DOUBLE
         ELSE len(list_intersect(a.leaves, c.leaves))::DOUBLE / len(list_distinct(a.leaves || c.leaves)) END AS near_next
FROM e JOIN f a ON a.t = e.text JOIN f b ON b.t = e.edited JOIN f c ON c.t = e.next
"""

ORACLES: dict[str, str] = {
    "op1_exact_top_k": _OP1,
    "op2_chat_windows": _OP2,
    "op3_url_verdicts": _OP3,
    "op5_mix_words": _OP5,
    "op7_jaccard_groups": _OP7,
    "op8_fm_index_repeats": _OP8,
    "op11_hard_negatives": _OP11,
    "op12_merkle_manifest": _OP12,
    "op13_merkle_fingerprints": _OP13,
}
