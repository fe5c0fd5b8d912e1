"""DuckDB SQL for the operators that SQL expresses over whole tables."""

from __future__ import annotations

ORACLE_SQL: dict[str, str] = {}

#: Same order key, targets and prefix sums as ``mixing``, without buckets.
ORACLE_SQL["op4_mixing"] = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         ('0x' || substr(md5('mix-1' || coalesce(doc_id::VARCHAR, '') || md5(coalesce(text, ''))), 1, 12))::BIGINT AS k
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
r AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rk FROM s),
w AS (SELECT *, CASE rk % 3 WHEN 0 THEN 5.0 WHEN 1 THEN 2.0 ELSE 1.0 END::DOUBLE AS weight, 2 * source_size AS cap FROM r),
l AS (SELECT *, (sum(source_size) OVER ()::DOUBLE * 1.5 - coalesce(sum(cap) OVER b, 0)::DOUBLE)
                / (sum(weight) OVER () - coalesce(sum(weight) OVER b, 0)) AS level
      FROM w WINDOW b AS (ORDER BY cap / weight, rk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
c AS (SELECT (SELECT level FROM l WHERE level * weight <= cap ORDER BY cap / weight, rk LIMIT 1) AS lv),
t AS (SELECT source, source_size, rk, round(least(cap::DOUBLE, coalesce(lv * weight, cap::DOUBLE)), 6) AS target,
             CASE rk % 3 WHEN 0 THEN -0.5 WHEN 1 THEN 0.0 ELSE 0.5 END::DOUBLE AS slope FROM l, c),
p AS (SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY k, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS st FROM d),
j AS (SELECT p.doc_id, p.size, t.source_size, t.target, t.slope, p.st, floor(t.target + 0.5)::BIGINT AS whole
      FROM p JOIN t ON p.source IS NOT DISTINCT FROM t.source),
k AS (SELECT *, greatest(least(whole - st, size), 0)::BIGINT AS t1, greatest(least(whole - st - source_size, size), 0)::BIGINT AS t2,
             CASE WHEN target = 0 THEN NULL ELSE st::DOUBLE / target END AS f FROM j)
SELECT doc_id, size, source_size, target, t1 + t2 AS taken,
       CASE WHEN t1 > 0 THEN round(CASE WHEN slope = 0 THEN f ELSE 2 * f / ((1 - slope) + sqrt(greatest((1 - slope) * (1 - slope) + 4 * slope * f, 0.0))) END, 9) END AS position
FROM k
"""

#: Lines compared as text instead of hashes.
ORACLE_SQL["op3_line_dedup"] = r"""
WITH l AS (
  SELECT doc_id, line, i - 1 AS i FROM (SELECT doc_id, unnest(x) AS line, generate_subscripts(x, 1) AS i
         FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS x FROM documents))),
w AS (SELECT doc_id, i, regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g') AS t,
             row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1 AS n FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
z AS (SELECT doc_id, i, n, row_number() OVER (PARTITION BY t ORDER BY doc_id, n) > 1 AS gone FROM w),
e AS (SELECT doc_id, min(i) AS a, max(i) AS b FROM (SELECT *, n - row_number() OVER (PARTITION BY doc_id ORDER BY n) AS grp FROM z WHERE gone)
      GROUP BY doc_id, grp),
s AS (SELECT doc_id, string_agg(a || '-' || b, ',' ORDER BY a) AS runs FROM e GROUP BY doc_id),
c AS (SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_removed FROM z GROUP BY doc_id),
k AS (SELECT l.doc_id, string_agg(l.line, chr(10) ORDER BY l.i) AS kept FROM l LEFT JOIN z ON l.doc_id = z.doc_id AND l.i = z.i
      WHERE coalesce(NOT z.gone, true) GROUP BY l.doc_id)
SELECT d.doc_id, coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(runs, '') AS runs,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM documents d LEFT JOIN c USING (doc_id) LEFT JOIN s USING (doc_id) LEFT JOIN k USING (doc_id)
"""

#: Every prefix as a list of turns; crc32 by its bit rule (-1: one shift, others: a byte mixed in).
ORACLE_SQL["op13_conversation_trie"] = r"""
WITH t AS (
  SELECT conv_id, list(struct_pack(r := coalesce(role, ''), x := coalesce(text, '')) ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS own
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
b AS (SELECT conv_id, flatten(list_transform(string_split(conv_id::VARCHAR, ''), lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1])) AS steps FROM t),
h AS (SELECT conv_id, xor(list_reduce(list_concat([4294967295::BIGINT], steps), lambda a, s:
             CASE WHEN s >= 0 THEN xor(a, s) WHEN a % 2 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END), 4294967295::BIGINT) % 4 AS h FROM b),
p AS (SELECT t.conv_id, list_concat(coalesce(z.own, [])[1:h.h], t.own[h.h + 1:]) AS path
      FROM t JOIN h USING (conv_id) LEFT JOIN t z ON z.conv_id = t.conv_id - t.conv_id % 20),
m AS (SELECT conv_id, path[1:d] AS node, d, d = len(path) AS ends FROM (SELECT conv_id, path, unnest(range(0, len(path) + 1)) AS d FROM p)),
n AS (SELECT node, d, min(conv_id) AS conv_id, count(*) AS n_convs,
             sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256,
             CASE WHEN d = 0 THEN 0 ELSE (count(*) - 1) * len(regexp_extract_all(node[d].x, '[^\x20\x09-\x0D]+')) END AS own_saved
      FROM m GROUP BY node, d),
k AS (SELECT node[1:d - 1] AS node, count(*) AS n_children FROM n WHERE d > 0 GROUP BY 1),
f AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN k USING (node)),
u AS (SELECT up AS node, sum(own_saved) AS saved_tokens, count(*) FILTER (n_children = 0) AS n_leaves
      FROM (SELECT node[1:unnest(range(0, d + 1))] AS up, own_saved, n_children FROM f) GROUP BY up)
SELECT f.conv_id, f.d::BIGINT AS depth, q.conv_id AS parent_conv_id, f.n_convs::BIGINT AS n_convs, f.n_children::BIGINT AS n_children,
       u.n_leaves::BIGINT AS n_leaves, u.saved_tokens::BIGINT AS saved_tokens, f.ends_sha256
FROM f JOIN u ON u.node = f.node LEFT JOIN f q ON q.node = f.node[1:f.d - 1] AND q.d = f.d - 1 AND f.d > 0
"""
