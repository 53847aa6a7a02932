"""Exact top-k search by inner product with a pivot-distance index.

Every vector belongs to its nearest pivot and is filed under that pivot by its
distance to it. Runs of neighbours in that order are annuli; of each, the pivot, the
least and greatest distance and the greatest length are known. For a query q and an
annulus at distances r1..r2 from pivot p, the triangle inequality gives a least
distance d = max(|q-p| - r2, r1 - |q-p|, 0), and since 2 q.x = |q|^2 + |x|^2 - |q-x|^2
a greatest score (|q|^2 + max|x|^2 - d^2) / 2. A query looks through its own
annuli first and expands to others in the order of that bound, until the bound falls
below its k-th score.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from runlens.llm.shared import stored

# Vectors that pivots are chosen from, and pivots.
SAMPLED, PIVOTS = 4096, 64
# Vectors in an annulus and in a segment of neighbouring annuli; queries in a block.
ANNULUS, SEGMENT, QUERIES = 512, 32_768, 4096
SCALE = 64


def _exact(vectors: DataFrame) -> DataFrame:
    """(vec_id, vector) with components floor(64 x) as packed 64-bit integers; invalid rows are left out."""
    x = F.col("embedding").cast("array<double>")
    plain = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("x"))
    good = F.forall("x", lambda y: y.isNotNull() & ~F.isnan(y) & (F.abs(y) < float("inf")))
    plain = plain.where(F.col("vec_id").isNotNull() & F.col("x").isNotNull() & good)
    whole = F.transform("x", lambda y: F.floor(y * SCALE).cast("long"))
    return plain.select("vec_id", whole.alias("x")).groupBy("vec_id").agg(F.min("x").alias("x"))


def _matrix(column, width: int) -> np.ndarray:
    """Arrays of a column as rows of a matrix, short ones filled up with zeros."""
    out = np.zeros((len(column), width), np.int64)
    for i, x in enumerate(column.to_pylist()):
        out[i, : len(x)] = x
    return out


def pivots_of(sample: np.ndarray, most: int = PIVOTS) -> np.ndarray:
    """Pivots far from each other: each next one is the point farthest from those chosen."""
    if not len(sample):
        return sample.astype(np.float64)
    points = sample.astype(np.float64)
    chosen = [int(np.argmin(((points - points.mean(axis=0)) ** 2).sum(axis=1)))]
    away = ((points - points[chosen[0]]) ** 2).sum(axis=1)
    while len(chosen) < most and away.max() > 0:
        chosen.append(int(away.argmax()))
        away = np.minimum(away, ((points - points[chosen[-1]]) ** 2).sum(axis=1))
    return points[chosen]


def _distances(points: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    points = points.astype(np.float64)
    squares = (points**2).sum(axis=1)[:, None] + (pivots**2).sum(axis=1)[None] - 2 * points @ pivots.T
    return np.sqrt(np.maximum(squares, 0))


def _products(queries: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Inner products as integers; floating point while every partial sum is exact there."""
    largest = max(int(np.abs(queries).max(initial=0)), 1) * max(int(np.abs(points).max(initial=0)), 1)
    if largest * max(points.shape[1], 1) < 1 << 24:
        return (queries.astype(np.float32) @ points.astype(np.float32).T).astype(np.int64)
    if largest * max(points.shape[1], 1) < 1 << 53:
        return (queries.astype(np.float64) @ points.astype(np.float64).T).astype(np.int64)
    return queries @ points.T


class Segment:
    """Neighbouring annuli in memory, in the order of pivot and distance."""

    def __init__(self, ids, points, nearest, distance, pivots):
        order = np.lexsort((ids, distance, nearest))
        self.ids, self.points, self.pivots = ids[order], points[order], pivots
        nearest, distance = nearest[order], distance[order]
        # An annulus ends where the pivot changes, or when it is full.
        fresh = np.concatenate([[True], nearest[1:] != nearest[:-1]])
        starts = np.flatnonzero(fresh)
        within = np.arange(len(order)) - np.repeat(starts, np.diff(np.concatenate([starts, [len(order)]])))
        self.starts = np.flatnonzero(within % ANNULUS == 0)
        self.ends = np.concatenate([self.starts[1:], [len(order)]])
        self.nearest = nearest[self.starts]
        # Distances are rounded; the annulus is widened by more than that.
        self.low = np.minimum.reduceat(distance, self.starts) * (1 - 1e-9) - 1e-6
        self.high = np.maximum.reduceat(distance, self.starts) * (1 + 1e-9) + 1e-6
        squares = (self.points.astype(np.float64) ** 2).sum(axis=1)
        self.longest = np.maximum.reduceat(squares, self.starts)

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """Greatest score of each query in each annulus."""
        away = _distances(queries, self.pivots)[:, self.nearest]
        least = np.maximum(np.maximum(away - self.high, self.low - away), 0)
        squares = (queries.astype(np.float64) ** 2).sum(axis=1)[:, None]
        bound = (squares + self.longest[None] - least**2) / 2
        return bound + 1e-6 * (1 + np.abs(bound))

    def search(self, names, queries, floor, k):
        """(query, vector, score) of all that may be among the k best; `floor` is a known k-th score."""
        bound, floor = self.bounds(queries), floor.copy()
        pool = (np.zeros(0, np.int64),) * 3  # query's place, score, vector
        for at in np.argsort(-bound.max(axis=0, initial=-np.inf), kind="stable"):
            open_ = np.flatnonzero(bound[:, at] >= floor)
            if not len(open_):
                continue
            part = slice(self.starts[at], self.ends[at])
            ids, scores = self.ids[part], _products(queries[open_], self.points[part])
            hit = (scores >= floor[open_, None]) & (ids[None] != names[open_, None])
            row, column = np.nonzero(hit)
            if not len(row):
                continue
            found = (open_[row], scores[row, column], ids[column])
            pool = tuple(np.concatenate(x) for x in zip(pool, found, strict=True))
            order = np.lexsort((pool[2], -pool[1], pool[0]))
            query = pool[0][order]
            starts = np.flatnonzero(np.concatenate([[True], query[1:] != query[:-1]]))
            rank = np.arange(len(query)) - np.repeat(starts, np.diff(np.concatenate([starts, [len(query)]])))
            order = order[rank < k]
            pool = tuple(x[order] for x in pool)
            last = rank[rank < k] == k - 1
            floor[pool[0][last]] = np.maximum(floor[pool[0][last]], pool[1][last])
        return names[pool[0]], pool[2], pool[1]


def search(vectors: DataFrame, k: int = 20, every: int = 20) -> DataFrame:
    """query_id, rank, vec_id, score: the k best of all other rows for rows with vec_id % every = 0.

    Scores are inner products of floor(64 x); ties go to the smaller vec_id. Vectors that
    are NULL, hold a NULL or a component that isn't finite, or have no vec_id, take no
    part. An id has one vector: repeated rows count once, and of several vectors the
    smallest counts. Shorter vectors are filled up with zeros. Fewer than k others give
    all of them; an empty table gives none; other columns are ignored.

    Index segments and blocks of queries meet in pairs, one pair in a task at a time;
    segments are cut by count, so that equal vectors are no burden to one task.
    """
    spark = vectors.sparkSession
    exact = stored(_exact(vectors), "vectors")
    width, total = exact.agg(F.max(F.size("x")), F.count("*")).first()
    width = max(width or 0, 1)
    sample = exact.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLED).select("x").toArrow()
    pivots = spark.sparkContext.broadcast(pivots_of(_matrix(sample.column("x"), width)))

    def file(batches):
        for batch in batches:
            points = _matrix(batch.column("x"), width)
            away = _distances(points, pivots.value)
            nearest = away.argmin(axis=1)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id"),
                    pa.array([x.tobytes() for x in points], pa.binary()),
                    pa.array(nearest, pa.int64()),
                    pa.array(away[np.arange(len(points)), nearest]),
                ],
                names=["vec_id", "point", "pivot", "distance"],
            )

    segments = max(1, math.ceil(total / SEGMENT))
    filed = exact.mapInArrow(file, "vec_id long, point binary, pivot long, distance double")
    filed = filed.repartitionByRange(segments, "pivot", "distance", "vec_id")
    index = stored(filed.withColumn("segment", F.spark_partition_id().cast("long")), "index")

    queries = index.where(F.col("vec_id") % every == 0)
    blocks = max(1, math.ceil(total / every / QUERIES))

    def unpack(table):
        point = np.frombuffer(b"".join(x.as_py() for x in table.column("point")), np.int64).reshape(-1, width)
        return table.column("vec_id").to_numpy(), point

    def segment_of(table):
        ids, points = unpack(table)
        return Segment(ids, points, table.column("pivot").to_numpy(), table.column("distance").to_numpy(), pivots.value)

    def as_table(found):
        return pa.table(dict(zip(("query_id", "vec_id", "score"), map(pa.array, found), strict=True)))

    found = "query_id long, vec_id long, score long"

    def at_home(table):
        """Queries first look through the segment that they are filed in."""
        names, points = unpack(table)
        own = names % every == 0
        floor = np.full(int(own.sum()), np.iinfo(np.int64).min)
        return as_table(segment_of(table).search(names[own], points[own], floor, k))

    home = stored(index.groupBy("segment").applyInArrow(at_home, found), "home")
    floors = home.groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").alias("least"))
    floor = F.when(F.col("n") >= k, F.col("least")).alias("floor")
    queries = queries.join(floors.select(F.col("query_id").alias("vec_id"), floor), "vec_id", "left").select(
        F.col("vec_id").alias("query_id"),
        F.col("point").alias("goal"),
        F.col("segment").alias("home"),
        "floor",
        F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).alias("asked"),
    )
    queries = stored(queries, "queries")

    def elsewhere(left, right):
        """A block of queries expands to a segment, but for queries at home there."""
        if not left.num_rows or not right.num_rows:
            return as_table([np.zeros(0, np.int64)] * 3)
        goals = np.frombuffer(b"".join(x.as_py() for x in left.column("goal")), np.int64).reshape(-1, width)
        lowest = np.iinfo(np.int64).min
        floor = np.array([lowest if x is None else x for x in left.column("floor").to_pylist()], np.int64)
        guest = left.column("home").to_numpy() != right.column("segment")[0].as_py()
        names = left.column("query_id").to_numpy()[guest]
        return as_table(segment_of(right).search(names, goals[guest], floor[guest], k))

    every_segment = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(segments - 1).cast("long")))
    every_block = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long")))
    left = queries.withColumn("to", every_segment)
    right = index.withColumn("block", every_block)
    away = left.groupBy("asked", "to").cogroup(right.groupBy("block", "segment")).applyInArrow(elsewhere, found)

    # Each task keeps the k best of a query before they meet.
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = home.union(away).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
