"""DuckDB SQL of the queries that SQL can express on whole tables."""

from __future__ import annotations

_WARC = """
WITH p AS (
  SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages
), d AS (
  SELECT page_id, octet_length(payload) AS n, sha256(payload) AS digest FROM p
), f AS (
  SELECT digest, min(page_id) AS first FROM d WHERE n >= 100 GROUP BY digest
)
SELECT d.page_id, CAST(d.n AS BIGINT) AS payload_bytes, d.digest AS payload_digest,
       CASE WHEN f.first IS NOT NULL AND d.page_id IS DISTINCT FROM f.first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN f.first IS NOT NULL AND d.page_id IS DISTINCT FROM f.first THEN f.first END AS refers_to
FROM d LEFT JOIN f ON d.digest = f.digest
"""

# The closure of links: every node with everything it reaches (UNION ends at the closure).
_REACH = """
both_ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (
  SELECT node, node AS reached FROM nodes
  UNION
  SELECT reach.node, both_ways.b FROM reach JOIN both_ways ON both_ways.a = reach.reached
),
component AS (SELECT node, min(reached) AS component_id FROM reach GROUP BY node)
"""

_NEAR_DUPLICATES = f"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\\x20\\x09-\\x0D]+') AS ws
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
         ELSE [array_to_string(ws[i:i + 3], ' ') for i in range(1, len(ws) - 2)] END) AS sh
  FROM words
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), shared AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c
  FROM shingles x JOIN shingles y ON x.sh = y.sh AND x.doc_id < y.doc_id GROUP BY x.doc_id, y.doc_id
), links AS (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * c >= 80 * (x.n + y.n - c)
), nodes AS (SELECT DISTINCT doc_id AS node FROM documents), {_REACH}
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id JOIN component c ON c.node = d.doc_id
"""

_REPEATS = """
WITH d AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
), windows AS (
  SELECT doc_id, pos, substr(h, 2 * pos + 1, 100) AS w
  FROM (SELECT doc_id, h, unnest(range(0, len(h) // 2 - 49)) AS pos FROM d WHERE len(h) >= 100)
), firsts AS (
  SELECT w, min(doc_id) AS first FROM windows GROUP BY w
), hits AS (
  SELECT doc_id, pos, lag(pos) OVER (PARTITION BY doc_id ORDER BY pos) AS before
  FROM windows JOIN firsts USING (w) WHERE first < doc_id
), runs AS (
  SELECT doc_id, min(pos) AS s, max(pos) + 50 AS e
  FROM (SELECT doc_id, pos, sum(CASE WHEN before IS NULL OR pos > before + 50 THEN 1 ELSE 0 END)
               OVER (PARTITION BY doc_id ORDER BY pos) AS run FROM hits)
  GROUP BY doc_id, run
), gaps AS (
  SELECT doc_id, coalesce(lag(e) OVER (PARTITION BY doc_id ORDER BY s), 0) AS a, s AS b FROM runs
  UNION ALL SELECT doc_id, max(e), 1000000000000 FROM runs GROUP BY doc_id
), kept AS (
  SELECT g.doc_id, string_agg(substr(d.h, 2 * a + 1, 2 * (least(b, len(d.h) // 2) - a)), '' ORDER BY a) AS k
  FROM gaps g JOIN d ON d.doc_id = g.doc_id GROUP BY g.doc_id
), removed AS (
  SELECT doc_id, sum(e - s) AS n, count(*) AS spans FROM runs GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(d.h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(r.n, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(r.spans, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(k.k, d.h))) AS kept_sha256
FROM d LEFT JOIN removed r ON r.doc_id = d.doc_id LEFT JOIN kept k ON k.doc_id = d.doc_id
"""

_VECTORS = f"""
WITH RECURSIVE v AS (
  SELECT DISTINCT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len([x for x in embedding if x IS NULL OR isnan(x) OR isinf(x)]) = 0
    AND len([x for x in embedding if x <> 0]) > 0
), links AS (
  SELECT x.vec_id AS a, y.vec_id AS b FROM v x JOIN v y ON x.vec_id < y.vec_id AND len(x.e) = len(y.e)
  WHERE list_cosine_similarity(x.e, y.e) >= 0.9
), nodes AS (SELECT DISTINCT vec_id AS node FROM embeddings), {_REACH},
counts AS (SELECT a, count(*) AS n FROM both_ways GROUP BY a)
SELECT t.vec_id, coalesce(n.n, 0) AS n_links, c.component_id, t.vec_id = c.component_id AS kept
FROM embeddings t JOIN component c ON c.node = t.vec_id LEFT JOIN counts n ON n.a = t.vec_id
"""

# Integer vectors, one row per component; rows that hold a null or non-finite one are left out.
_COMPONENTS = """
kept AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, vec_id, label, [CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT) for x in embedding] AS v
  FROM embeddings WHERE embedding IS NOT NULL {where}
    AND len([x for x in embedding if x IS NULL OR isnan(x) OR isinf(x)]) = 0
),
component AS MATERIALIZED (SELECT rid, unnest(range(len(v))) AS i, unnest(v) AS x FROM kept)
"""


def _floor_mean(x: str) -> str:
    total, n = f"CAST(sum({x}) AS BIGINT)", "count(*)"
    return f"({total} - (({total} % {n}) + {n}) % {n}) // {n}"


def _clusters(k: int = 8, rounds: int = 10, size: int = 64) -> str:
    """Lloyd's rounds with every distance taken."""
    steps = [_COMPONENTS.format(where=f"AND len(embedding) = {size}"), f"""
center0 AS MATERIALIZED (
  SELECT c, unnest(range({size})) AS i, unnest(v) AS x
  FROM (SELECT row_number() OVER (ORDER BY sha256('3:' || vec_id), v) - 1 AS c, v FROM kept) WHERE c < {k}
)"""]
    for r in range(rounds + 1):
        steps.append(f"""
near{r} AS MATERIALIZED (
  SELECT rid, c, d FROM (
    SELECT rid, c, d, row_number() OVER (PARTITION BY rid ORDER BY d, c) AS nth FROM (
      SELECT a.rid, b.c, CAST(sum((a.x - b.x) * (a.x - b.x)) AS BIGINT) AS d
      FROM component a JOIN center{r} b ON a.i = b.i GROUP BY a.rid, b.c))
  WHERE nth = 1
)""")
        if r < rounds:
            steps.append(f"""
center{r + 1} AS MATERIALIZED (
  SELECT n.c, a.i, {_floor_mean("a.x")} AS x FROM component a JOIN near{r} n ON a.rid = n.rid GROUP BY n.c, a.i
  UNION ALL SELECT c, i, x FROM center{r} WHERE c NOT IN (SELECT c FROM near{r})
)""")
    return "WITH " + ",".join(steps) + f""",
per AS (SELECT c, CAST(sum(d) AS BIGINT) AS s FROM near{rounds} GROUP BY c),
names AS (SELECT c, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY i)) AS h FROM center{rounds} GROUP BY c)
SELECT k.vec_id, CAST(n.c AS INTEGER) AS cluster, n.d AS distance, per.s AS cluster_inertia,
       CAST((SELECT sum(s) FROM per) AS BIGINT) AS inertia, names.h AS centroid_sha256
FROM kept k JOIN near{rounds} n ON n.rid = k.rid JOIN per ON per.c = n.c JOIN names ON names.c = n.c
"""


def _codes(parts: int = 4, entries: int = 256, rounds: int = 4) -> str:
    """Product codes with every distance taken; all vectors have one length."""
    steps = [_COMPONENTS.format(where=""), f"""
piece AS MATERIALIZED (
  SELECT c.rid, c.i // (len(k.v) // {parts}) AS p, c.i % (len(k.v) // {parts}) AS i, c.x
  FROM component c JOIN kept k ON k.rid = c.rid
),
book0 AS MATERIALIZED (
  SELECT p.p, o.e, p.i, p.x FROM piece p
  JOIN (SELECT rid, row_number() OVER (ORDER BY vec_id, v) - 1 AS e FROM kept) o ON o.rid = p.rid WHERE o.e < {entries}
)"""]
    for r in range(rounds + 1):
        steps.append(f"""
near{r} AS MATERIALIZED (
  SELECT rid, p, e, d FROM (
    SELECT rid, p, e, d, row_number() OVER (PARTITION BY rid, p ORDER BY d, e) AS nth FROM (
      SELECT a.rid, a.p, b.e, CAST(sum((a.x - b.x) * (a.x - b.x)) AS BIGINT) AS d
      FROM piece a JOIN book{r} b ON a.p = b.p AND a.i = b.i GROUP BY a.rid, a.p, b.e))
  WHERE nth = 1
)""")
        if r < rounds:
            steps.append(f"""
book{r + 1} AS MATERIALIZED (
  SELECT a.p, n.e, a.i, {_floor_mean("a.x")} AS x FROM piece a JOIN near{r} n ON a.rid = n.rid AND a.p = n.p GROUP BY a.p, n.e, a.i
  UNION ALL SELECT b.p, b.e, b.i, b.x FROM book{r} b ANTI JOIN near{r} n ON n.p = b.p AND n.e = b.e
)""")
    return "WITH " + ",".join(steps) + f""",
coded AS (
  SELECT rid, string_agg(format('{{:02x}}', CAST(e AS INTEGER)), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error
  FROM near{rounds} GROUP BY rid
)
SELECT k.vec_id, c.code, c.error, CAST(sum(c.error) OVER (PARTITION BY k.label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY p, e, i)) FROM book{rounds}) AS codebooks_sha256
FROM kept k JOIN coded c ON c.rid = k.rid
"""


ORACLE_SQL: dict[str, str] = {
    "op1_minhash_forest": _NEAR_DUPLICATES,
    "op2_warc_zip": _WARC,
    "op4_suffix_runs": _REPEATS,
    "op6_embedding_graph": _VECTORS,
    "op11_ns_clusters": _clusters(),
    "op12_gnat_codes": _codes(),
}
