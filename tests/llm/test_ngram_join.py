from __future__ import annotations

import tracemalloc
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pytest

from runlens.llm import ngram_join
from runlens.llm.components import components
from tests.llm.helpers import ODD_ROWS, documents, near_components, near_copies


@pytest.mark.parametrize("frequent", [False, True])
def test_join_equals_brute_force(spark, monkeypatch, frequent):
    if frequent:  # windows of a few documents count as frequent, and their groups are dealt into blocks
        monkeypatch.setattr(ngram_join, "REPORTED", 2)
        monkeypatch.setattr(ngram_join, "BLOCK", 20)
    rows = near_copies(3) + [(9001, None), (9002, ""), (9003, " \n\t ")]
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.join(documents(spark, rows)).collect()}
    assert found == near_components(rows)


def test_odd_rows(spark):
    rows = [*ODD_ROWS, (5, "one two three four five six"), (5, "quite another text of six words"), (3, "ONE two three four five six")]
    found = ngram_join.join(documents(spark, rows)).collect()
    assert len(found) == len(rows)
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in found), key=repr)
    assert got == sorted(
        [(None, 1, None), (9001, 0, 9001), (9002, 0, 9002), (9003, 0, 9003), (9004, 1, 9004), (9004, 1, 9004),
         (5, 2, 3), (5, 2, 5), (3, 2, 3)], key=repr,
    )
    assert ngram_join.join(documents(spark, rows).limit(0)).count() == 0


def test_without_copies_keeps_one_of_each_group(spark):
    rows = near_copies(4) + ODD_ROWS
    docs = documents(spark, rows)
    kept = ngram_join.without_copies(docs)
    assert kept.columns == docs.columns
    parts = near_components([r for r in rows if r[0] is not None])
    expected = [i for i, (_, part) in parts.items() if i == part]
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == sorted(expected)


def test_tree_finds_every_pair_that_its_bound_allows():
    rng = np.random.default_rng(0)
    points = rng.poisson(rng.uniform(0, 4, (150, 1)), (150, 16)).astype(np.uint32)
    labels = rng.integers(0, 40, 150)
    found = set()
    for a, b, _ in ngram_join.CountTree(points, labels).pairs():
        found |= {tuple(sorted(x)) for x in zip(a.tolist(), b.tolist())}
    expected = set()
    for i in range(150):
        for j in range(i + 1, 150):
            shared, total = np.minimum(points[i], points[j]).sum(), points[i].sum() + points[j].sum()
            if labels[i] != labels[j] and 9 * int(shared) >= 4 * int(total):
                expected.add((i, j))
    assert found == expected


def test_prefixes_of_near_sets_meet():
    rng = np.random.default_rng(1)
    for _ in range(300):
        n = int(rng.integers(1, 60))
        a = np.unique(rng.integers(0, 1000, n))
        b = np.unique(np.concatenate([a[rng.random(len(a)) < 0.9], rng.integers(0, 1000, 2)]))
        shared = len(np.intersect1d(a, b))
        if 100 * shared >= 80 * (len(a) + len(b) - shared):
            assert shared >= ngram_join.least_overlap(len(a) + len(b))
            assert set(a[: ngram_join.prefix_length(len(a))]) & set(b[: ngram_join.prefix_length(len(b))])


def test_components(spark):
    rng = np.random.default_rng(2)
    links = [(int(a), int(b)) for a, b in rng.integers(0, 120, (80, 2))] + [(200 + i, 201 + i) for i in range(40)] + [(7, 7), (500, 300)]
    parent = {x: x for pair in links for x in pair}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = sorted((top(a), top(b)))
        parent[b] = a
    linked = {x for a, b in links if a != b for x in (a, b)}
    found = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {x: top(x) for x in linked}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_windows_are_counted_where_they_lie(monkeypatch):
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 1 << 62, 4000).astype(np.uint64) >> np.uint64(x)) for x in rng.choice([0, 54], 500)]
    n = sum(map(len, sets))
    monkeypatch.setattr(ngram_join, "HELD", n // 2)
    monkeypatch.setattr(ngram_join, "texts_of", lambda batch: batch)
    monkeypatch.setattr(ngram_join, "sets_of", lambda texts: (x.copy() for x in texts))
    runs = []

    def mapped(run, schema):
        runs.append(run)
        raise StopIteration

    docs = SimpleNamespace(select=lambda *_: SimpleNamespace(mapInArrow=mapped))
    with pytest.raises(StopIteration):
        ngram_join._frequent(docs, n)
    tracemalloc.start()
    (made,) = runs[0](iter([sets[:200], sets[200:]]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    expected = Counter(x for found in sets for x in found.tolist())
    expected = {x: k for x, k in expected.items() if k >= ngram_join.REPORTED}
    assert expected and dict(zip(made.column("window").to_pylist(), made.column("n").to_pylist())) == expected
    assert peak < 6 * 8 * ngram_join.HELD
