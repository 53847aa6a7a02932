"""Hard negatives by a secondary sort of scored pairs.

Scored pairs are packed into keys whose bytes sort by anchor, then descending score,
then positives before negatives, then id. One shuffle brings the keys of an anchor
together and sorts them inside their partition; an iterator then goes down each
anchor's scores, opens a window whenever it passes a positive, and emits the
negatives that fall into the windows open. It never holds more than those windows.

Anchors and candidates meet in packed blocks, in one task for each run of candidates.
A task gives out only what may be among the first of a window: of the positives as
many as are wanted, and, once the positives of all tasks are known, of the different
labels as many for each window as are wanted. Nothing that could be returned is left
out, and an anchor's keys grow with the number of tasks, not with that of rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runlens.llm.shared import stored

# Bytes of vectors in a segment of candidates; anchors in a block; scores made at once.
SEGMENT, ANCHORS, SCORES = 32 << 20, 2048, 1 << 22
# Candidates in a segment at least, before there are more segments than twice the tasks.
LEAST = 1024

_KEY = np.dtype([("anchor", ">u8"), ("score", ">u8"), ("kind", "u1"), ("id", ">u8")])
_SIGN = np.uint64(1 << 63)
_LONG = (-(1 << 63), (1 << 63) - 1)
POSITIVE, NEGATIVE = 0, 1


def packed_keys(anchors, scores, kind: int, ids) -> pa.Array:
    """Keys whose bytes sort by anchor, descending score, kind and id."""
    out = np.empty(len(anchors), _KEY)
    out["anchor"] = np.asarray(anchors, np.int64).view(np.uint64) ^ _SIGN
    out["score"] = ~(np.asarray(scores, np.int64).view(np.uint64) ^ _SIGN)
    out["kind"] = kind
    out["id"] = np.asarray(ids, np.int64).view(np.uint64) ^ _SIGN
    ends = np.arange(len(out) + 1, dtype=np.int32) * np.int32(_KEY.itemsize)
    return pa.Array.from_buffers(pa.binary(), len(out), [None, pa.py_buffer(ends), pa.py_buffer(out.tobytes())])


def unpacked_keys(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchor, score, kind and id of each key."""
    keys = np.frombuffer(b"".join(column.to_pylist()), _KEY)
    plain = lambda x: (x.astype(np.uint64) ^ _SIGN).view(np.int64)
    return plain(keys["anchor"]), plain(~keys["score"]), keys["kind"], plain(keys["id"])


def window(score: int, low: int, high: int) -> tuple[int, int]:
    """Least and greatest score n with low * score <= 100 * n <= high * score."""
    return max(-(-low * score // 100), _LONG[0]), min(high * score // 100, _LONG[1])


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers, exact, at most what a long holds; what is missing in the shorter counts zero."""
    width = min(a.shape[1], b.shape[1])
    a, b = a[:, :width], b[:, :width]
    most = float(np.abs(a, dtype=np.float64).max(initial=0)) * float(np.abs(b, dtype=np.float64).max(initial=0))
    for kind, exact in ((np.float32, 2.0**24), (np.float64, 2.0**53)):
        if most * max(width, 1) < exact:
            return (a.astype(kind) @ b.astype(kind).T).astype(np.int64)
    whole = np.frompyfunc(int, 1, 1)
    out = whole(a.astype(np.float64)) @ whole(b.astype(np.float64)).T
    return np.clip(out, *_LONG).astype(np.int64) if width else np.zeros(out.shape, np.int64)


def _vectors(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, x) of the rows that take part, one for each vec_id."""
    x = F.col("embedding").cast("array<double>")
    plain = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), x.alias("x"))
    good = F.forall("x", lambda y: y.isNotNull() & ~F.isnan(y) & (F.abs(y) < float("inf")))
    plain = plain.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("x").isNotNull() & good)
    kept = plain.groupBy("vec_id").agg(F.min(F.struct("label", "x")).alias("kept"))
    return kept.select("vec_id", "kept.label", "kept.x")


_PACKED = "n long, width long, kind string, ids binary, labels binary, points binary"


def _as_row(ids, labels, points) -> list:
    """A block of vectors as the values of _PACKED; points are whole numbers."""
    kind = "<i2" if np.abs(points).max(initial=0) < 1 << 15 else "<f8"
    raw = [x.tobytes() for x in (ids.astype("<i8"), labels.astype("<i8"), points.astype(kind))]
    return [len(ids), points.shape[1], kind, *raw]


def _block(row: dict, prefix: str = "") -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids, labels and points of a block."""
    n, width, kind, ids, labels, points = (row[prefix + x.split()[0]] for x in _PACKED.split(", "))
    points = np.frombuffer(points, kind).reshape(n, width)
    return np.frombuffer(ids, "<i8"), np.frombuffer(labels, "<i8"), points


def _table(rows: list, schema: pa.Schema) -> pa.Table:
    columns = list(zip(*rows, strict=True)) or [()] * len(schema)
    return pa.table([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


_ROW = [("n", pa.int64()), ("width", pa.int64()), ("kind", pa.string()), *((x, pa.binary()) for x in ("ids", "labels", "points"))]


def _segments(vectors: DataFrame, scale: int) -> tuple[DataFrame, int]:
    """The vectors in packed rows, one for each segment, and the number of segments."""
    spark = vectors.sparkSession
    exact = _vectors(vectors)
    total, width = exact.agg(F.count("*"), F.max(F.size("x"))).first()
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    segments = max(1, math.ceil(total * (width or 0) * 8 / SEGMENT), min(2 * partitions, math.ceil(total / LEAST)))
    schema = pa.schema([("segment", pa.int64()), *_ROW])

    def pack(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        lists = table.column("x").combine_chunks()
        lengths = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        points = np.zeros((len(lengths), int(lengths.max(initial=0))))
        points[np.arange(points.shape[1]) < lengths[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
        most = np.finfo(np.float64).max
        points = np.clip(np.floor(np.clip(points, -most / scale, most / scale) * scale), -most, most)
        ids, labels = table.column("vec_id").to_numpy(), table.column("label").to_numpy()
        order = np.lexsort((ids, labels))
        return _table([[key[0].as_py(), *_as_row(ids[order], labels[order], points[order])]], schema)

    dealt = exact.withColumn("segment", F.pmod(F.xxhash64("vec_id"), F.lit(segments)))
    return stored(dealt.groupBy("segment").applyInArrow(pack, f"segment long, {_PACKED}"), "segments"), segments


def _anchors(packed: DataFrame, every: int) -> DataFrame:
    """The anchors of each segment, in blocks."""
    schema = pa.schema([("block", pa.int64()), *_ROW])

    def pick(batches):
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                ids, labels, points = _block(row)
                own = np.flatnonzero(ids % every == 0)
                for nth, at in enumerate(range(0, len(own), ANCHORS)):
                    some = own[at : at + ANCHORS]
                    rows.append([row["segment"] << 20 | nth, *_as_row(ids[some], labels[some], points[some])])
            yield from _table(rows, schema).to_batches()

    return packed.mapInArrow(pick, f"block long, {_PACKED}")


def _met(blocks: DataFrame, packed: DataFrame, segments: int) -> DataFrame:
    """Every block of anchors (columns a_...) with every segment."""
    names = [F.col(x).alias("a_" + x) for x in blocks.columns]
    to = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(segments - 1).cast("long"))).alias("segment")
    asked = blocks.select(*names, to).repartition(segments, "segment")
    return asked.join(packed.repartition(segments, "segment"), "segment")


def _first(rows, scores, ids, k: int):
    """Places of the k first of each row, by descending score and id."""
    order = np.lexsort((ids, -scores, rows))
    sorted_rows = rows[order]
    starts = np.flatnonzero(np.concatenate([[True], sorted_rows[1:] != sorted_rows[:-1]])) if len(order) else order
    rank = np.arange(len(order)) - np.repeat(starts, np.diff(np.concatenate([starts, [len(order)]])))
    return order[rank < k], rank[rank < k]


class _Pool:
    """The k first candidates of each anchor for one window."""

    def __init__(self, low: np.ndarray, high: np.ndarray, k: int):
        self.low, self.high, self.k = low.copy(), high, k
        self.rows = self.scores = self.ids = np.zeros(0, np.int64)

    def take(self, scores, free, ids) -> None:
        """Scores of all anchors (rows) with some candidates; `free` says which pairs count."""
        hit = (scores >= self.low[:, None]) & (scores <= self.high[:, None]) & free
        row, column = np.nonzero(hit)
        if not len(row):
            return
        self.rows = np.concatenate([self.rows, row])
        self.scores = np.concatenate([self.scores, scores[row, column]])
        self.ids = np.concatenate([self.ids, ids[column]])
        kept, rank = _first(self.rows, self.scores, self.ids, self.k)
        self.rows, self.scores, self.ids = self.rows[kept], self.scores[kept], self.ids[kept]
        last = rank == self.k - 1  # a window that is full asks for no less than its last one
        self.low[self.rows[last]] = self.scores[last]


def _parts(n: int, wide: int):
    """Slices of n candidates: short ones first, which soon tell what can be left out."""
    at, size = 0, 64
    while at < n:
        yield slice(at, min(n, at + min(size, wide)))
        at, size = at + min(size, wide), size * 4


def _searched(anchor_block, segment, pools: list[_Pool], same: bool) -> list[_Pool]:
    """Fills the pools of an anchor block with candidates of a segment, of the same or of other labels."""
    (names, labels, goals), (ids, others, points) = anchor_block, segment
    for part in _parts(len(ids), max(1, SCORES // max(len(names), 1))):
        equal = labels[:, None] == others[None, part]
        free = equal & (names[:, None] != ids[None, part]) if same else ~equal
        if free.any():
            scores = products(goals, points[part])
            for pool in pools:
                pool.take(scores, free, ids[part])
    return pools


_KEYS = pa.schema([("place", pa.int64()), ("key", pa.binary())])


def _keys(place, anchors, scores, kind, ids) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(place, pa.int64()), packed_keys(anchors, scores, kind, ids)], schema=_KEYS)


def mine(
    vectors: DataFrame,
    every: int = 50,
    positives: int = 5,
    negatives: int = 3,
    low: int = 50,
    high: int = 95,
    scale: int = 256,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Anchors are the rows with vec_id % every = 0. A score is the inner product of
    floor(scale * x); higher ones come first, ties by smaller vec_id. An anchor's
    positives are its first `positives` other rows of the same label, and of each the
    first `negatives` rows of other labels are returned whose score is `low` to `high`
    percent of the positive's; a positive below zero has none.

    Rows without vec_id, label or vector, or with a component that is NULL or not
    finite, take no part. An id has one vector: repeated rows count once, and of several
    the smallest by label and vector counts. Shorter vectors are filled up with zeros;
    scores beyond 64 bits count as the nearest that fits. Fewer rows than asked for give
    all of them; an empty table gives none; other columns are ignored.
    """
    packed, segments = _segments(vectors, scale)
    blocks = stored(_anchors(packed, every), "anchors")

    def nearest(batches):
        """Keys of what may be among an anchor's positives."""
        for batch in batches:
            for row in batch.to_pylist():
                block = _block(row, "a_")
                lowest, highest = np.full(len(block[0]), _LONG[0]), np.full(len(block[0]), _LONG[1])
                (found,) = _searched(block, _block(row), [_Pool(lowest, highest, positives)], True)
                if len(found.rows):
                    place = np.full(len(found.rows), row["a_block"])
                    yield _keys(place, block[0][found.rows], found.scores, POSITIVE, found.ids)

    def first_positives(batches):
        """Down the sorted keys of each anchor, its first positives."""
        last, n = None, 0
        for batch in batches:
            anchors, *_ = unpacked_keys(batch.column("key"))
            kept = []
            for i, anchor in enumerate(anchors.tolist()):
                n = n + 1 if anchor == last else 1
                last = anchor
                if n <= positives:
                    kept.append(i)
            yield batch.take(pa.array(kept, pa.int64()))

    together = "place long, key binary"
    keys = _met(blocks, packed, segments).mapInArrow(nearest, together)
    keys = keys.repartition("place").sortWithinPartitions("place", "key")
    chosen = stored(keys.mapInArrow(first_positives, together), "positives")

    def of_block(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        return pa.table({"block": pa.array([key[0].as_py()]), "chosen": [b"".join(table.column("key").to_pylist())]})

    wanted = chosen.groupBy("place").applyInArrow(of_block, "block long, chosen binary")
    asking = blocks.join(wanted, "block")

    def within(batches):
        """Keys of what may be among the first negatives of a window."""
        for batch in batches:
            for row in batch.to_pylist():
                block = _block(row, "a_")
                names = block[0]
                open_ = np.full((positives, 2, len(names)), [[1], [0]], np.int64)  # no score lies between
                order, seen = np.argsort(names), np.zeros(len(names), np.int64)
                anchors, scores, _, _ = unpacked_keys(pa.array([row["a_chosen"]]))
                for at, score in zip(order[np.searchsorted(names[order], anchors)].tolist(), scores.tolist(), strict=True):
                    open_[seen[at], :, at] = window(score, low, high)
                    seen[at] += 1
                pools = _searched(block, _block(row), [_Pool(*x, negatives) for x in open_], False)
                rows, scores, ids = (np.concatenate([getattr(p, x) for p in pools]) for x in ("rows", "scores", "ids"))
                if len(rows):
                    _, fresh = np.unique(np.stack([rows, ids]), axis=1, return_index=True)
                    found = names[rows[fresh]]
                    yield _keys(found, found, scores[fresh], NEGATIVE, ids[fresh])

    def by_anchor(batches):
        for batch in batches:
            anchors, *_ = unpacked_keys(batch.column("key"))
            yield pa.RecordBatch.from_arrays([pa.array(anchors), batch.column("key")], schema=_KEYS)

    out = pa.schema(
        [("anchor_id", pa.int64()), ("positive_id", pa.int64()), ("rank", pa.int32())]
        + [(x, pa.int64()) for x in ("negative_id", "positive_score", "negative_score")]
    )

    def emit(batches):
        """Down the sorted keys: a positive opens a window, a negative falls into those open."""
        last, open_, opened = None, [], 0
        for batch in batches:
            rows = []
            for anchor, score, kind, name in zip(*(x.tolist() for x in unpacked_keys(batch.column("key"))), strict=True):
                if anchor != last:
                    last, open_, opened = anchor, [], 0
                if kind == POSITIVE:
                    if opened < positives:
                        opened += 1
                        open_.append([*window(score, low, high), name, score, 0])
                    continue
                for one in open_:
                    if one[0] <= score <= one[1] and one[4] < negatives:
                        one[4] += 1
                        rows.append((anchor, one[2], one[4], name, one[3], score))
                open_ = [x for x in open_ if x[4] < negatives and x[0] <= score]
            yield from _table(rows, out).to_batches()

    keys = _met(asking, packed, segments).mapInArrow(within, together)
    keys = chosen.mapInArrow(by_anchor, together).union(keys)
    keys = keys.repartition("place").sortWithinPartitions("key")
    return keys.mapInArrow(
        emit,
        "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long",
    )
