"""A quality score from a logistic regression over hashed word n-grams.

Words and runs of marks, alone and in pairs, are hashed into a fixed number of
weights. The weights are learned with follow-the-regularised-leader updates, one
coordinate at a time, and a text's score is a sparse dot product.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runlens.llm.chunks import give_back
from runlens.llm.shared import pick, text_batches, texts_of
from runlens.llm.words import _BASE, is_capital, mixed, tokens_of

# Weights; labelled documents learned from at most; passes over them.
WEIGHTS = 1 << 18
LABELLED = 6_000
PASSES = 4
# Follow-the-regularised-leader: learning rate, its offset, and both regularisers.
ALPHA, BETA, L1, L2 = 1.0, 1.0, 0.02, 0.1

# Where all pairs of equal tokens are counted.
_SAME = np.uint64(12_345)


def features(texts: list[str]):
    """(weights' places, values) of each text: logs of counts, scaled to length one, and a constant.

    Counted are tokens, pairs of them, with one count for all pairs of equal tokens, and
    triples of token shapes (letters, digits or marks; first and last letter a capital).
    """
    for _, found in tokens_of(texts, lower=False):
        first, last = found.points[found.starts], found.points[found.ends - 1]
        capital = (is_capital(first) * 2 + is_capital(last)).astype(np.uint64)
        shapes = found.kinds.astype(np.uint64) * np.uint64(4) + capital + np.uint64(1)
        for i in range(len(found.first) - 1):
            one = found.hashes[found.first[i] : found.first[i + 1]]
            shape = shapes[found.first[i] : found.first[i + 1]]
            two = mixed(one[:-1] * np.uint64(_BASE) + one[1:])
            two[one[:-1] == one[1:]] = _SAME
            three = mixed(shape[:-2] * np.uint64(961) + shape[1:-1] * np.uint64(31) + shape[2:])
            every = np.concatenate([one, two, three])
            places, counts = np.unique(every % np.uint64(WEIGHTS - 1), return_counts=True)
            values = np.log1p(counts)
            norm = np.sqrt((values**2).sum())
            places = np.concatenate([places.astype(np.int64), [WEIGHTS - 1]])
            yield places, np.concatenate([values / norm if norm else values, [1.0]])


class Leader:
    """Follow-the-regularised-leader for logistic loss (McMahan et al., 2013)."""

    def __init__(self):
        self.z, self.n = np.zeros(WEIGHTS), np.zeros(WEIGHTS)

    def weights(self, places=slice(None)) -> np.ndarray:
        z, n = self.z[places], self.n[places]
        return -np.sign(z) * np.maximum(np.abs(z) - L1, 0) / ((BETA + np.sqrt(n)) / ALPHA + L2)

    def learn(self, places: np.ndarray, values: np.ndarray, label: int) -> None:
        w = self.weights(places)
        slope = (probability(w @ values) - label) * values
        n = self.n[places]
        sigma = (np.sqrt(n + slope**2) - np.sqrt(n)) / ALPHA
        self.z[places] += slope - sigma * w
        self.n[places] = n + slope**2


def probability(score):
    return 1 / (1 + np.exp(-np.clip(score, -50, 50)))


def held_out(doc_id: Column | str = "doc_id") -> Column:
    """Whether a document is never learned from."""
    name = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(name.cast("long").cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, most: int = LABELLED) -> np.ndarray:
    """Weights learned from up to `most` labelled documents that are not held out.

    Those with the smallest hashes of their id are taken, so one task learns from a
    bounded number of sparse vectors and the driver gets the weights alone. A label
    that is NULL is left out, and of several for a document the smallest counts.
    Without labelled documents all weights are zero and every score is one half.
    """
    labels = pick(labels, doc_id="long", quality="int").where("doc_id is not null and quality in (0, 1)")
    labels = labels.where(~held_out()).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    order = F.xxhash64(F.col("doc_id"), F.lit("order"))
    chosen = labels.orderBy(order, "doc_id").limit(most)

    def vectors(batches):
        give_back()
        for batch in batches:
            found = list(features(texts_of(batch)))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("quality"),
                    pa.array([x.tobytes() for x, _ in found], pa.binary()),
                    pa.array([x.tobytes() for _, x in found], pa.binary()),
                ],
                names=["doc_id", "quality", "places", "values"],
            )

    def learn(batches):
        rows, leader = [], Leader()
        for batch in batches:
            rows += zip(*(batch.column(x).to_pylist() for x in ("quality", "places", "values")), strict=True)
        rows = [(y, np.frombuffer(p, np.int64), np.frombuffer(v)) for y, p, v in rows]
        for turn in range(PASSES):
            for at in np.random.default_rng(turn).permutation(len(rows)):
                y, places, values = rows[at]
                leader.learn(places, values, y)
        made = leader.weights().astype(np.float32).tobytes()
        yield pa.RecordBatch.from_arrays([pa.array([made], pa.binary())], names=["weights"])

    known = docs.join(F.broadcast(chosen), "doc_id").select("doc_id", "quality", "text")
    sparse = known.mapInArrow(vectors, "doc_id long, quality int, places binary, values binary")
    one = sparse.dropDuplicates(["doc_id"]).repartitionByRange(1, "doc_id").sortWithinPartitions(order, "doc_id")
    made = one.mapInArrow(learn, "weights binary").collect()
    return np.frombuffer(made[0]["weights"], np.float32) if made else np.zeros(WEIGHTS, np.float32)


def score(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    """doc_id, held_out, score and predicted for every row of `docs` (doc_id, text)."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    def run(batches):
        for batch in batches:
            w = shared.value
            scores = [float(probability(w[places] @ values)) for places, values in features(texts_of(batch))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(scores, pa.float64()),
                 pa.array([int(x >= 0.5) for x in scores], pa.int32())],
                names=["doc_id", "held_out", "score", "predicted"],
            )

    rows = docs.select("doc_id", held_out().alias("held_out"), "text")
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Quality of every document: doc_id, held_out, score, predicted.

    One row per input row, from its whole text. A NULL or empty text has the constant
    alone as its features; a NULL doc_id is kept and not held out; repeated rows score
    alike; an empty table gives none; other columns are ignored.
    """
    text_batches(docs.sparkSession)
    docs = pick(docs, doc_id="long", text="string")
    return score(docs, train(docs, labels))


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of `docs`, with all their columns, that score one half or more."""
    text_batches(docs.sparkSession)
    plain = pick(docs, doc_id="long", text="string")
    shared = docs.sparkSession.sparkContext.broadcast(train(plain, labels))

    @F.pandas_udf("boolean")
    def good(texts):
        import pandas as pd

        give_back()
        w = shared.value
        found = features([x or "" for x in texts])
        return pd.Series([bool(probability(w[places] @ values) >= 0.5) for places, values in found], dtype=bool)

    return docs.where(good(F.col("text").cast("string")))
