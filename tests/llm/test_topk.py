from __future__ import annotations

import numpy as np
import pytest

from runlens.llm import topk
from runlens.llm.oracle import ORACLE
from runlens.llm.queries import QUERIES
from tests.oracle_check import connect, differences
from tests.test_queries import SF_DIR, needs_data


def brute(rows, width, k=20, every=20):
    vectors = {}
    for i, v in rows:
        if i is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        made = np.zeros(width, np.int64)
        made[: len(v)] = np.floor(64 * np.array(v, np.float32).astype(float))
        if i not in vectors or list(made) < list(vectors[i]):
            vectors[i] = made
    out = {}
    for q in vectors:
        if q % every == 0:
            scores = sorted((-int(vectors[i] @ vectors[q]), i) for i in vectors if i != q)[:k]
            out[q] = [(rank + 1, i, -s) for rank, (s, i) in enumerate(scores)]
    return {q: x for q, x in out.items() if x}


@pytest.mark.parametrize("small", [False, True])
def test_search_equals_brute_force(spark, monkeypatch, small):
    if small:
        for name, value in (("SEGMENT", 150), ("ANNULUS", 16), ("QUERIES", 10), ("PIVOTS", 6)):
            monkeypatch.setattr(topk, name, value)
    rng = np.random.default_rng(0)
    rows = [(i, [float(x) for x in rng.normal(size=6) * rng.choice([0.1, 1, 3])]) for i in range(500)]
    rows += [(2000 + i, [0.5] * 6) for i in range(200)]  # one vector holds a share of all rows
    rows += [(5000, None), (5001, [1.0, None]), (5020, [float("nan")] * 6), (5040, [float("inf")] * 6)]
    rows += [(5060, [1.0, 2.0]), (5080, []), (3, rows[3][1]), (None, [1.0] * 6), (20, [9.0] * 6)]
    vectors = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<float>, score int")
    found = {}
    for r in topk.search(vectors).collect():
        found.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert {q: sorted(x) for q, x in found.items()} == brute(rows, 6)


def test_few_or_no_vectors(spark):
    schema = "vec_id long, embedding array<float>"
    assert topk.search(spark.createDataFrame([], schema)).count() == 0
    two = spark.createDataFrame([(0, [1.0, 2.0]), (7, [0.5, -1.0])], schema)
    assert [tuple(r) for r in topk.search(two).collect()] == [(0, 1, 7, 64 * 32 - 128 * 64)]


def test_bounds_hold():
    rng = np.random.default_rng(2)
    points = rng.integers(-500, 500, (400, 5))
    pivots = topk.pivots_of(points[:100], 7)
    away = topk._distances(points, pivots)
    nearest = away.argmin(axis=1)
    made = topk.Segment(np.arange(400), points, nearest, away[np.arange(400), nearest], pivots)
    queries = rng.integers(-900, 900, (30, 5))
    bound, scores = made.bounds(queries), queries @ made.points.T
    for k, (i, j) in enumerate(zip(made.starts, made.ends)):
        assert (scores[:, i:j].max(axis=1) <= bound[:, k]).all()


@needs_data
def test_query_equals_sql(spark):
    found = QUERIES["op4_exact_topk"](spark, SF_DIR)
    assert differences(found, connect(SF_DIR), ORACLE["op4_exact_topk"]) is None
