"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

ORACLE: dict[str, str] = {}

ORACLE["op4_exact_topk"] = """
WITH flat AS (
    SELECT vec_id, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS i FROM embeddings
), ints AS (
    SELECT vec_id, i, floor(64 * x)::BIGINT AS x FROM flat
), scores AS (
    SELECT q.vec_id AS query_id, c.vec_id, sum(q.x * c.x)::BIGINT AS score
    FROM ints q JOIN ints c ON q.i = c.i AND q.vec_id <> c.vec_id
    WHERE q.vec_id % 20 = 0
    GROUP BY ALL
)
SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id, score
FROM scores
QUALIFY rank <= 20
"""

ORACLE["op11_hard_negatives"] = """
WITH rows AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, embedding
    FROM embeddings
), flat AS (
    SELECT vec_id, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS i FROM rows
), ints AS (
    SELECT vec_id, i, floor(256 * x)::BIGINT AS x FROM flat
), products AS (
    SELECT q.vec_id AS anchor_id, c.vec_id, sum(q.x * c.x)::BIGINT AS score
    FROM ints q JOIN ints c ON q.i = c.i AND q.vec_id <> c.vec_id
    WHERE q.vec_id % 50 = 0
    GROUP BY ALL
), scores AS (
    SELECT p.*, a.label = c.label AS same
    FROM products p JOIN rows a ON a.vec_id = p.anchor_id JOIN rows c ON c.vec_id = p.vec_id
), positives AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score
    FROM scores WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, p.positive_id,
       (row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.vec_id))::INTEGER AS rank,
       n.vec_id AS negative_id, p.positive_score, n.score AS negative_score
FROM positives p JOIN scores n
  ON n.anchor_id = p.anchor_id AND NOT n.same
 AND 50 * p.positive_score <= 100 * n.score AND 100 * n.score <= 95 * p.positive_score
QUALIFY rank <= 3
"""
