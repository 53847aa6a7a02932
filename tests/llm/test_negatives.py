from __future__ import annotations

import numpy as np
import pytest

from runlens.llm import negatives
from runlens.llm.oracle import ORACLE
from runlens.llm.queries import QUERIES
from tests.oracle_check import connect, differences
from tests.test_queries import SF_DIR, needs_data

SCHEMA = "vec_id long, embedding array<float>, label int, key string, segment int"


def brute(rows, scale=256, every=50, positives=5, wanted=3, low=50, high=95):
    vectors = {}
    for i, v, label in rows:
        if i is None or v is None or label is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        made = [int(np.floor(scale * float(np.float32(x)))) for x in v]
        if i not in vectors or (label, v) < vectors[i][2]:
            vectors[i] = (made, label, (label, v))
    out = set()
    for a in vectors:
        if a % every:
            continue
        scored = []
        for i, (v, label, _) in vectors.items():
            if i != a:
                scored.append((-sum(x * y for x, y in zip(v, vectors[a][0])), i, label))
        scored.sort()
        for p, pid in [(-s, i) for s, i, label in scored if label == vectors[a][1]][:positives]:
            fit = [(-s, i) for s, i, label in scored if label != vectors[a][1] and low * p <= -100 * s <= high * p]
            out |= {(a, pid, rank, i, p, s) for rank, (s, i) in enumerate(fit[:wanted], 1)}
    return out


@pytest.mark.parametrize("small", [False, True])
def test_mine_equals_brute_force(spark, monkeypatch, small):
    if small:
        for name, value in (("SEGMENT", 4096), ("ANCHORS", 3), ("SCORES", 100), ("LEAST", 50)):
            monkeypatch.setattr(negatives, name, value)
    rng = np.random.default_rng(5)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(0.2, 1, 5)], int(rng.integers(3))) for i in range(400)]
    rows += [(1000 + i, [0.5, 0.25, 0.0, -1.0, 0.125], i % 2) for i in range(200)]  # ties, a vector with a third of all rows
    rows += [(2000 + 50 * i, [0.0] * 5, 1) for i in range(3)] + [(2500, [-0.01, 0.0, 0.0, 0.0, 0.0], 7)]
    rows += [(5000, None, 1), (5050, [1.0, None], 1), (5100, [float("nan")] * 5, 1), (5150, [float("inf")] * 5, 0)]
    rows += [(5200, [1.0, 2.0], 1), (5250, [], 0), (5300, [1.0] * 5, None), (None, [1.0] * 5, 1)]
    rows += [rows[50], rows[50], (100, [9.0] * 5, 2), (5350, [1.0, 1.0, 0.0, 0.0, 0.0], 99)]
    found = negatives.mine(spark.createDataFrame([(*r, "k", 3) for r in rows], SCHEMA).repartition(3))
    assert found.dtypes == [
        ("anchor_id", "bigint"),
        ("positive_id", "bigint"),
        ("rank", "int"),
        ("negative_id", "bigint"),
        ("positive_score", "bigint"),
        ("negative_score", "bigint"),
    ]
    found = [tuple(r) for r in found.collect()]
    assert len(found) == len(set(found)) and set(found) == brute(rows)


def test_few_or_no_vectors(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert negatives.mine(empty).count() == 0
    alone = spark.createDataFrame([(0, [1.0], 1, "", 0), (1, [1.0], 1, "", 0)], SCHEMA)
    assert negatives.mine(alone).count() == 0
    three = [(0, [1.0], 1), (1, [1.0], 1), (2, [0.75], 2)]
    made = spark.createDataFrame([(*r, "", 0) for r in three], SCHEMA)
    assert [tuple(r) for r in negatives.mine(made).collect()] == [(0, 1, 1, 2, 65536, 256 * 192)]


def test_components_beyond_exact_floats(spark):
    rows = [(0, [1e6, 3.0], 1), (1, [1e6, 2.0], 1), (2, [7e5, 1.0], 2), (3, [3e30, 0.0], 1), (4, [8e5, -1e6], 2)]
    made = negatives.mine(spark.createDataFrame([(*r, "", 0) for r in rows], SCHEMA))
    found = {(r.positive_id, r.negative_id, r.positive_score, r.negative_score) for r in made.collect()}
    first = 256 * 256 * (10**12 + 6)
    assert {x for x in found if x[0] == 1} == {(1, 2, first, 65536 * (7 * 10**11 + 3)), (1, 4, first, 65536 * (8 * 10**11 - 3 * 10**6))}
    assert not [x for x in found if x[0] == 3]  # its score counts as the largest long


def test_keys_sort_like_their_parts():
    rng = np.random.default_rng(1)
    parts = [(int(a), int(s), int(k), int(i)) for a, s, k, i in rng.integers(-3, 3, (300, 4))]
    parts += [(-(1 << 63), (1 << 63) - 1, 0, 5), ((1 << 63) - 1, -(1 << 63), 1, -5)]
    keys = []
    for a, s, k, i in parts:
        keys += negatives.packed_keys([a], [s], k & 1, [i]).to_pylist()
    expected = sorted((a, -s, k & 1, i) for a, s, k, i in parts)
    columns = negatives.unpacked_keys(negatives.pa.array(sorted(keys)))
    assert [(a, -s, k, i) for a, s, k, i in zip(*(x.tolist() for x in columns))] == expected


@needs_data
def test_query_equals_sql(spark):
    found = QUERIES["op11_hard_negatives"](spark, SF_DIR)
    assert differences(found, connect(SF_DIR), ORACLE["op11_hard_negatives"]) is None
