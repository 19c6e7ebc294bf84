"""DuckDB SQL of the clustering and the importance resampling queries."""

from __future__ import annotations


def kmeans_sql(k: int = 8, rounds: int = 10, size: int = 64, seed: str = "3:") -> str:
    """The rounds of ``op12_centroid_clusters``, one pair of CTEs for each."""
    nearest = """
nearest{0} AS MATERIALIZED (
  SELECT r, arg_min(c, (d, c)) AS c, min(d) AS d FROM (
    SELECT x.r, m.c, sum((x.x - m.x) * (x.x - m.x))::BIGINT AS d
    FROM parts x JOIN mean{0} m ON x.i = m.i GROUP BY x.r, m.c)
  GROUP BY r)"""
    moved = """
mean{1} AS MATERIALIZED (
  SELECT m.c, m.i, coalesce(s.x, m.x) AS x
  FROM mean{0} m LEFT JOIN (
    SELECT c, i, (sum(x) - (sum(x) % count(*) + count(*)) % count(*))::HUGEINT // count(*) AS x
    FROM parts JOIN nearest{0} USING (r) GROUP BY c, i) s ON m.c = s.c AND m.i = s.i)"""
    steps = [nearest.format(0)]
    for i in range(rounds):
        steps += [moved.format(i, i + 1), nearest.format(i + 1)]
    return f"""
WITH whole AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda e: floor(1024 * e::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE len(embedding) = {size} AND len(list_filter(embedding, lambda e: e IS NOT NULL AND isfinite(e))) = {size}),
parts AS MATERIALIZED (SELECT r, unnest(range(1, {size} + 1)) AS i, unnest(v) AS x FROM whole),
mean0 AS MATERIALIZED (
  SELECT c, unnest(range(1, {size} + 1)) AS i, unnest(v)::HUGEINT AS x FROM (
    SELECT row_number() OVER (ORDER BY sha256('{seed}' || vec_id)) - 1 AS c, v FROM whole
    QUALIFY c < {k})),{",".join(steps)},
hashes AS (SELECT c, sha256(string_agg(x::VARCHAR, ',' ORDER BY i)) AS h FROM mean{rounds} GROUP BY c)
SELECT vec_id, n.c::INTEGER AS cluster, d AS distance,
       sum(d) OVER (PARTITION BY n.c)::BIGINT AS cluster_inertia, sum(d) OVER ()::BIGINT AS inertia, h AS centroid_sha256
FROM nearest{rounds} n JOIN whole USING (r) JOIN hashes ON n.c = hashes.c
"""


RESAMPLING_SQL = r"""
WITH crc AS MATERIALIZED (
  SELECT list_transform(range(256), lambda b: list_reduce(list_prepend(b, range(8)),
    lambda a, k: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)) AS t),
texts AS MATERIALIZED (
  SELECT row_number() OVER () AS r, true AS mine, doc_id, text FROM documents
  UNION ALL SELECT -1, false, NULL, text FROM benchmark),
words AS MATERIALIZED (
  SELECT r, mine, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w
  FROM texts),
kinds AS MATERIALIZED (
  SELECT w, xor(list_reduce(list_prepend(4294967295, list_transform(range(1, length(h), 2),
           lambda i: ('0x' || substr(h, i, 2))::BIGINT)),
           lambda a, b: xor(a >> 8, crc.t[(xor(a, b) & 255) + 1])), 4294967295) % 10000 AS bucket
  FROM (SELECT DISTINCT w, hex(encode(w)) AS h FROM words), crc),
counts AS MATERIALIZED (
  SELECT bucket, count(*) FILTER (mine) AS s, count(*) FILTER (NOT mine) AS t FROM words JOIN kinds USING (w) GROUP BY bucket),
gains AS MATERIALIZED (
  SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * (s_all + 10000)::DOUBLE / ((s + 1)::DOUBLE * (t_all + 10000)::DOUBLE)))::BIGINT AS gain
  FROM counts, (SELECT sum(s) AS s_all, sum(t) AS t_all FROM counts)),
weights AS (
  SELECT r, count(*) AS n, sum(gain)::BIGINT AS g FROM words JOIN kinds USING (w) JOIN gains USING (bucket) WHERE mine GROUP BY r),
scores AS MATERIALIZED (
  SELECT r, doc_id, coalesce(n, 0) AS n_features, weight,
         weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
  FROM (SELECT texts.r, doc_id, n, coalesce((g - (g % n + n) % n) // n, 0) AS weight,
               ('0x' || substr(sha256('2024:' || doc_id), 1, 8))::BIGINT::DOUBLE AS h
        FROM texts LEFT JOIN weights ON texts.r = weights.r WHERE mine)),
places AS (
  SELECT r, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS n FROM scores WHERE n_features >= 20)
SELECT doc_id, n_features::BIGINT AS n_features, weight::BIGINT AS weight, score::BIGINT AS score,
       CASE WHEN place <= 10 * n // 100 THEN place END AS rank
FROM scores LEFT JOIN places USING (r)
"""
