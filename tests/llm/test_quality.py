from __future__ import annotations

import random
import zlib

import numpy as np

from runlens.llm import quality
from tests.llm.helpers import ODD_ROWS, documents


def labelled(n, seed=0):
    rng = random.Random(seed)
    words = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 7))) for _ in range(500)]
    rows, labels = [], []
    for i in range(n):
        text = rng.choices(words, k=rng.randint(5, 60))
        good = rng.random() < 0.7
        if not good:
            text = [w + "###" for w in text] if rng.random() < 0.5 else [text[0]] * 30
        rows.append((i, " ".join(text)))
        labels.append((i, int(good), 0))
    return rows, labels


def test_classifier_tells_held_out_documents(spark):
    rows, labels = labelled(600)
    docs = documents(spark, rows + ODD_ROWS)
    marks = spark.createDataFrame(labels + [(None, 1, 0), (9004, None, 0), (3, labels[3][1], 1)], "doc_id long, quality int, toxic int")
    found = quality.classify(docs, marks).collect()
    assert len(found) == len(rows) + len(ODD_ROWS)
    truth = {i: y for i, y, _ in labels}
    held = [r for r in found if r.held_out and r.doc_id in truth]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in found if r.doc_id is not None)
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in found)
    kept = quality.accepted(docs, marks)
    assert kept.columns == docs.columns
    assert kept.count() == sum(r.predicted for r in found)


def test_held_out_labels_are_never_learned(spark):
    rows, labels = labelled(120)
    docs = documents(spark, rows).select("doc_id", "text")
    schema = "doc_id long, quality int, toxic int"
    turned = [(i, 1 - y if zlib.crc32(str(i).encode()) % 3 == 1 else y, t) for i, y, t in labels]
    one = quality.train(docs, spark.createDataFrame(labels, schema))
    two = quality.train(docs, spark.createDataFrame(turned, schema))
    assert (one == two).all() and one.any()


def test_without_labels_or_documents(spark):
    rows, _ = labelled(5)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r.score for r in quality.classify(documents(spark, rows), none).collect()} == {0.5}
    assert quality.classify(documents(spark, rows).limit(0), none).count() == 0


def test_weights_equal_a_plain_version():
    """The same updates, one coordinate at a time in plain Python."""
    rng = np.random.default_rng(1)
    rows = [(np.unique(rng.integers(0, 40, 6)), int(rng.integers(0, 2))) for _ in range(50)]
    leader, z, n = quality.Leader(), {}, {}
    for places, label in rows:
        values = np.linspace(0.1, 1, len(places))
        leader.learn(places, values, label)
        w = {}
        for p in places.tolist():
            a = z.get(p, 0.0)
            near = abs(a) <= quality.L1
            w[p] = 0.0 if near else -(a - np.sign(a) * quality.L1) / ((quality.BETA + n.get(p, 0.0) ** 0.5) / quality.ALPHA + quality.L2)
        slope = 1 / (1 + np.exp(-sum(w[p] * v for p, v in zip(places.tolist(), values)))) - label
        for p, v in zip(places.tolist(), values):
            g, old = slope * v, n.get(p, 0.0)
            n[p] = old + g * g
            z[p] = z.get(p, 0.0) + g - (n[p] ** 0.5 - old**0.5) / quality.ALPHA * w[p]
    assert all(abs(leader.z[p] - z[p]) < 1e-9 for p in z)
