"""DuckDB statements of the queries that SQL can express, written from the
definitions and not from the Spark plans."""

from __future__ import annotations

from .licences import TEMPLATES

# Highest quotients taken literally: every quotient of every shard is listed and ranked; what they
# miss of a source's target is settled in words, shard after shard.
MIX = r"""
WITH b AS (
  SELECT doc_id, source, CAST(COALESCE(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         substr(md5(COALESCE(text, '')), 1, 16) AS digest FROM documents
), e AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id, source, digest) - 1 AS copy FROM b
), d AS (
  SELECT *, CAST('0x' || substr(md5('mix-1|' || COALESCE(CAST(doc_id AS VARCHAR), 'null') || '|' || digest || '|' || copy),
                                1, 15) AS BIGINT) AS h FROM e
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS words, count(*) AS n,
         [3, 1, 2][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS w
  FROM d GROUP BY source
), c AS (  -- fill in the order in which sources reach their cap
  SELECT *, sum(2 * words) OVER o AS capped, sum(w) OVER () - sum(w) OVER o AS open,
         2 * words / w AS stops, 1.5 * sum(words) OVER () AS goal
  FROM s WINDOW o AS (ORDER BY 2 * words / w, source NULLS LAST ROWS UNBOUNDED PRECEDING)
), l AS (
  SELECT COALESCE(min(level), 0) AS level FROM (
    SELECT goal / total_w AS level, 0 AS reached, (SELECT min(stops) FROM c) AS nxt FROM (
      SELECT DISTINCT CAST(goal AS DOUBLE) AS goal, sum(w) OVER () AS total_w FROM c)
    UNION ALL
    SELECT (CAST(goal AS DOUBLE) - CAST(capped AS DOUBLE)) / CAST(open AS DOUBLE), stops,
           lead(stops) OVER (ORDER BY stops, source NULLS LAST) FROM c WHERE open > 0 OR open = 0
  ) WHERE level >= reached AND (nxt IS NULL OR level <= nxt) AND isfinite(level)
), t AS (
  SELECT source, words, least(w * level, CAST(2 * words AS DOUBLE)) AS target,
         greatest(ceil(words / 262144), ceil(n / 512), 1) AS k
  FROM s, l
), r AS (
  SELECT d.doc_id, d.size, d.source, t.words, t.target, d.h % CAST(t.k AS BIGINT) AS shard,
         COALESCE(sum(d.size) OVER (PARTITION BY d.source, d.h % CAST(t.k AS BIGINT)
           ORDER BY d.h, d.doc_id NULLS FIRST, d.digest, d.copy ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS a
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
), m AS (
  SELECT source, shard, CAST(sum(size) AS BIGINT) AS z, CAST(ceil(sum(size) / 64) AS BIGINT) AS nb,
         any_value(target) AS target, COALESCE(any_value(target) * CAST(ceil(sum(size) / 64) AS BIGINT)
                                               / nullif(any_value(words), 0), 0) AS quota
  FROM r GROUP BY source, shard
), q AS (
  SELECT source, shard, k, row_number() OVER (ORDER BY quota / (2 * k - 1) DESC, source NULLS LAST, shard, k) AS place
  FROM (SELECT source, shard, quota, unnest(range(1, 2 * nb + 1)) AS k FROM m WHERE quota > 0)
), seats AS (
  SELECT source, shard, count(*) AS seats FROM q
  WHERE place <= (SELECT floor(sum(quota) + 0.5) FROM m) GROUP BY source, shard
), p AS (  -- the short block of a shard comes at place `last` of its seeded order
  SELECT m.*, COALESCE(seats, 0) AS seats, greatest(nb, 1) AS one, 64 * nb - z AS short,
         CAST('0x' || substr(md5('mix-1|' || COALESCE(m.source, 'null') || '|' || m.shard), 1, 15) AS BIGINT)
           % greatest(nb, 1) AS turn,
         ((nb - 1) * (1000000007 % greatest(nb, 1)) + turn) % greatest(nb, 1) AS last
  FROM m LEFT JOIN seats x ON m.source IS NOT DISTINCT FROM x.source AND m.shard = x.shard
), g AS (
  SELECT *, seats // one * z + seats % one * 64 - CASE WHEN last < seats % one THEN short ELSE 0 END AS given FROM p
), f AS (
  SELECT *, floor(target + 0.5) - sum(given) OVER (PARTITION BY source) AS missed FROM g
), o AS (
  SELECT *, CASE WHEN missed > 0 THEN 2 * z - given ELSE given END AS room,
         COALESCE(sum(CASE WHEN missed > 0 THEN 2 * z - given ELSE given END) OVER (
           PARTITION BY source ORDER BY shard ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS reached FROM f
), w AS (
  SELECT *, CAST(given + sign(missed) * greatest(0, least(room, abs(missed) - reached)) AS BIGINT) AS take FROM o
), steps AS (  -- words of the first `place` blocks in seeded order
  SELECT source, shard, any_value(z) AS z, any_value(take) AS take, unnest(range(0, any_value(nb) + 1)) AS place,
         any_value(last) AS last, any_value(short) AS short FROM w WHERE nb > 0 GROUP BY source, shard
), x AS (
  SELECT source, shard, max(place) AS "full",
         any_value(take) % any_value(z) - max(64 * place - CASE WHEN last < place THEN short ELSE 0 END) AS rest
  FROM steps WHERE 64 * place - CASE WHEN last < place THEN short ELSE 0 END <= take % z GROUP BY source, shard
), j AS (
  SELECT r.doc_id, r.size, r.words, r.target, r.a, w.take // greatest(w.z, 1) AS passes, w.one, w.turn, x."full", x.rest,
         unnest(CASE WHEN r.size = 0 THEN [NULL]
                ELSE range(CAST(r.a // 64 AS BIGINT), CAST((r.a + r.size - 1) // 64 + 1 AS BIGINT)) END) AS j,
         row_number() OVER () AS id
  FROM r JOIN w ON r.source IS NOT DISTINCT FROM w.source AND r.shard = w.shard
  LEFT JOIN x ON r.source IS NOT DISTINCT FROM x.source AND r.shard = x.shard
), y AS (
  SELECT *, CASE WHEN (j * (1000000007 % one) + turn) % one < "full" THEN 64
                 WHEN (j * (1000000007 % one) + turn) % one = "full" THEN rest ELSE 0 END AS most FROM j
)
SELECT any_value(doc_id) AS doc_id, any_value(size) AS size, any_value(words) AS source_size,
       any_value(target) AS target,
       CAST(any_value(size) * any_value(passes) + COALESCE(sum(
         greatest(0, least(a + size, j * 64 + most) - greatest(a, j * 64))), 0) AS BIGINT) AS taken
FROM y GROUP BY id
"""

_TEMPLATES = ", ".join("('{}', '{}')".format(n, t.replace("'", "''")) for n, t in TEMPLATES)

# Every line and every text of several lines joined with every template of fitting size.
LICENCES = rf"""
WITH t AS (
  SELECT row_number() OVER () AS tid, name, string_split(trim(regexp_replace(lower(body), '[^a-z0-9]+', ' ', 'g')), ' ') AS w
  FROM (VALUES {_TEMPLATES}) v(name, body)
), tb AS (
  SELECT tid, b, count(*) AS c FROM (SELECT tid, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS b FROM t)
  GROUP BY tid, b
), d AS (
  SELECT row_number() OVER () AS id, doc_id, COALESCE(text, '') AS text,
         CASE WHEN COALESCE(text, '') = '' THEN [] ELSE string_split(text, chr(10)) END AS lines FROM documents
), u AS (
  SELECT id, row_number() OVER () AS uid, string_split(trim(regexp_replace(lower(x), '[^a-z0-9]+', ' ', 'g')), ' ') AS w
  FROM (SELECT id, unnest(lines) AS x FROM d UNION ALL SELECT id, text FROM d WHERE len(lines) > 1)
), p AS (
  SELECT u.id, u.uid, u.w, t.tid, t.name, len(u.w) - 1 AS n, len(t.w) - 1 AS m FROM u JOIN t
  ON 20 * least(len(u.w) - 1, len(t.w) - 1) >= 8 * (len(u.w) + len(t.w) - 2) AND len(u.w) > 1
), c AS (
  SELECT id, uid, tid, name, n, m, b, count(*) AS k
  FROM (SELECT *, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS b FROM p) GROUP BY ALL
), s AS (
  SELECT c.id, c.uid, c.name, 2.0::DOUBLE * sum(least(c.k, tb.c)) / (any_value(n) + any_value(m)) AS dice,
         20 * sum(least(c.k, tb.c)) >= 8 * (any_value(n) + any_value(m)) AS ok
  FROM c JOIN tb ON c.tid = tb.tid AND c.b = tb.b GROUP BY c.id, c.uid, c.tid, c.name
), best AS (
  SELECT id, uid, name, dice FROM s WHERE ok QUALIFY row_number() OVER (PARTITION BY uid ORDER BY dice DESC, name) = 1
), g AS (
  SELECT id, count(*) AS n, arg_min(name, (-dice, name)) AS name, max(dice) AS dice,
         list_sort(list_distinct(list(name))) AS names FROM best GROUP BY id
)
SELECT d.doc_id, CAST(len(d.lines) AS BIGINT) AS n_lines, CAST(COALESCE(g.n, 0) AS BIGINT) AS n_statements,
       g.name AS licence, g.dice AS dice, COALESCE(array_to_string(g.names, ','), '') AS licences
FROM d LEFT JOIN g USING (id)
"""

# Every anchor against every row, with plain inner products (of whole numbers, so exact in double).
NEGATIVES = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
), s AS (
  SELECT a.vec_id AS anchor_id, v.vec_id, a.label = v.label AS same,
         CAST(list_inner_product(a.q, v.q) AS BIGINT) AS score
  FROM v a JOIN v ON len(a.q) = len(v.q) WHERE a.vec_id % 100 = 0
), p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score,
         row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS place
  FROM s WHERE same AND vec_id <> anchor_id QUALIFY place <= 5
)
SELECT anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INT) AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score, CAST(place AS INT) AS positive_rank
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score QUALIFY rank <= 10
"""

_ROUND = """, a{i} AS MATERIALIZED (
  SELECT r, arg_min(c, (d, c)) AS c, min(d) AS d FROM (
    SELECT v.r, c.c, CAST(list_inner_product(v.q, v.q) - 2 * list_inner_product(v.q, c.q)
                          + list_inner_product(c.q, c.q) AS BIGINT) AS d FROM v, c{i} c) GROUP BY r
)"""
_MEANS = """, c{j} AS MATERIALIZED (
  SELECT c.c, COALESCE(any_value(m.q), any_value(c.q)) AS q FROM c{i} c LEFT JOIN (
    SELECT c, list(m ORDER BY place) AS q FROM (
      SELECT c, place, floor(sum(x) / count(*)) AS m FROM (
        SELECT a.c, unnest(v.q) AS x, unnest(range(64)) AS place FROM a{i} a JOIN v USING (r)) GROUP BY c, place)
    GROUP BY c) m USING (c) GROUP BY c.c
)"""

# Three rounds written out: all distances, then componentwise means.
CENTROIDS = """
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS q
  FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64
), c0 AS MATERIALIZED (
  SELECT CAST(row_number() OVER (ORDER BY sha256('1:' || vec_id) NULLS LAST, q) - 1 AS INT) AS c, q FROM v QUALIFY c < 16
)""" + "".join(_ROUND.format(i=i) + _MEANS.format(i=i, j=i + 1) for i in range(3)) + _ROUND.format(i=3) + """
SELECT vec_id, c AS cluster, d AS distance, CAST(sum(d) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia,
       CAST(sum(d) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(list_transform(c3.q, lambda x: CAST(CAST(x AS BIGINT) AS VARCHAR)), ',')) AS centroid_sha256
FROM a3 JOIN v USING (r) JOIN c3 USING (c)
"""

SQL = {"op2_licence_scan": LICENCES, "op8_sainte_lague_mix": MIX, "op11_hard_negatives": NEGATIVES,
       "op13_centroid_clusters": CENTROIDS}
