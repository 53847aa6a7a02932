"""Documents whose sets of word windows overlap, as a join with a count-vector R-tree.

A document's distinct windows are hashed into groups; the number in each group makes
it a point. Two documents share at most the sum over groups of the smaller count, and
of two boxes of points no pair shares more than the sum of the smaller upper corners.
An R-tree over the points therefore leaves out whole subtrees, and only pairs whose
bound reaches the threshold are verified by their sets.

Points that can't meet never enter the same tree. Under a total order of all windows,
two sets that overlap enough share a window among their first few (prefix filtering),
so a tree is built per such window and holds the documents that have it. Frequent
windows come last in the order. Copies with equal sets are one class from the start.
Groups of near copies are first joined to one of them, and trees are searched only
for pairs that those links leave apart; so work grows with documents, not pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runlens.llm.chunks import release
from runlens.llm.components import components
from runlens.llm.meeting import lists_of, unpacked
from runlens.llm.shared import pick, stored, text_batches, texts_of
from runlens.llm.words import mixed, windows, word_hashes

WINDOW = 5
# Jaccard threshold as a fraction; compared in whole numbers.
NEAR = (80, 100)
# Groups that windows are hashed into: the dimensions of a tree. Points of long documents
# have more, about one for two windows, and bound a pair more closely.
GROUPS = 256
# Points in a leaf, and children of a node.
FANOUT = 16

# A window counts as frequent if so large a share of documents has it; at most so many
# are listed, the most frequent, so that the list is small whatever the input. It only
# sets the order of windows, on which results don't depend.
FREQUENT, LISTED = 1 / 4096, 65_536
# A task reports windows that so many of its documents share, and holds so many at once.
REPORTED, HELD = 16, 1 << 21
# Documents in a block of a frequent window's group.
BLOCK = 2048

_U8 = np.dtype("<u8")
_U4 = np.dtype("<u4")


def sets_of(texts: list[str]) -> Iterator[np.ndarray]:
    """Each text's distinct window hashes in ascending order."""
    for _, hashes, first in word_hashes([x.encode("utf-8") for x in texts]):
        for i in range(len(first) - 1):
            yield np.unique(windows(hashes[first[i] : first[i + 1]], WINDOW))


def name_of(found: np.ndarray) -> int:
    """64 bits that equal sets share; different ones do with a chance of about 2^-64."""
    return int(mixed(found ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64).astype(np.int64)) if len(found) else 0


def least_overlap(total):
    """Smallest overlap with which sets of `total` members together are near: o/(total-o) >= near."""
    near, of = NEAR
    return -(-near * total // (near + of))


def prefix_length(n: int) -> int:
    """How many first windows of a set of n must hold one of any set near to it."""
    near, of = NEAR
    return n - (-(-near * n // of)) + 1


def point_of(found: np.ndarray) -> bytes:
    """Counts of a set's members by group, packed: GROUPS of them, or about one for two members.

    Groups are told by the lowest bits of a hash, so a finer point folds into a coarser one.
    """
    groups = max(GROUPS, 1 << max(0, len(found) // 2 - 1).bit_length())
    counts = np.bincount((found & np.uint64(groups - 1)).astype(np.int64), minlength=groups)
    small = counts.max(initial=0) < 256
    return (b"\1" if small else b"\4") + counts.astype(np.uint8 if small else _U4).tobytes()


def unpacked_point(packed: bytes) -> np.ndarray:
    return np.frombuffer(packed, np.uint8 if packed[0] == 1 else _U4, offset=1)


def folded(point: np.ndarray, groups: int) -> np.ndarray:
    """The point's counts by fewer groups."""
    return point if len(point) == groups else point.reshape(-1, groups).sum(axis=0, dtype=np.int64)


def points_of(packed: list[bytes]) -> tuple[list[np.ndarray], np.ndarray]:
    """Points as they are, and folded to GROUPS as rows of a matrix."""
    fine = [unpacked_point(x) for x in packed]
    return fine, np.array([folded(x, GROUPS) for x in fine], np.int64).reshape(-1, GROUPS)


def shared_bound(p: np.ndarray, q: np.ndarray) -> int:
    """Most that two sets can share, by the finest groups that both points have."""
    groups = min(len(p), len(q))
    return int(np.minimum(folded(p, groups), folded(q, groups)).sum(dtype=np.int64))


class CountTree:
    """A bulk-loaded R-tree over count vectors, searched against itself."""

    def __init__(self, points: np.ndarray, labels: np.ndarray):
        sizes = points.sum(axis=1, dtype=np.int64)
        points = points.astype(np.min_scalar_type(int(points.max(initial=0))))
        # Neighbours in size first, then in their fullest groups.
        self.order = np.lexsort((points.argmax(axis=1), sizes))
        self.points, self.sizes, self.labels = points[self.order], sizes[self.order], labels[self.order]
        low = high = self.points
        least, small, large = self.sizes, self.labels, self.labels
        self.levels = []  # from the leaves' points up: upper corners, least sizes, range of labels
        while True:
            self.levels.append((high, least, small, large))
            if len(high) <= 1:
                break
            starts = np.arange(0, len(high), FANOUT)
            high = np.maximum.reduceat(high, starts, axis=0)
            least = np.minimum.reduceat(least, starts)
            small, large = np.minimum.reduceat(small, starts), np.maximum.reduceat(large, starts)

    def _bounded(self, level: int, a: np.ndarray, b: np.ndarray):
        """The pairs of nodes that may hold a near pair with different labels, and their bounds."""
        high, least, small, large = self.levels[level]
        apart = (small[a] != large[b]) | (large[a] != small[b])
        a, b = a[apart], b[apart]
        shared = np.zeros(len(a), np.int64)
        for at in range(0, len(a), 1 << 14):
            x, y = a[at : at + (1 << 14)], b[at : at + (1 << 14)]
            np.minimum(high[x], high[y]).sum(axis=1, dtype=np.int64, out=shared[at : at + (1 << 14)])
        near = shared >= least_overlap(least[a] + least[b])
        return a[near], b[near], shared[near]

    def pairs(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Pairs of points, by place in the input, that the bound lets through, and the similarity it allows."""
        top = len(self.levels) - 1
        stack = [(top, np.zeros(1, np.int64), np.zeros(1, np.int64))]
        while stack:
            level, a, b = stack.pop()
            a, b, shared = self._bounded(level, a, b)
            if not len(a):
                continue
            if level == 0:
                yield self.order[a], self.order[b], shared / (self.sizes[a] + self.sizes[b] - shared)
                continue
            n = len(self.levels[level - 1][0])
            for at in range(0, len(a), 256):
                x, y = a[at : at + 256], b[at : at + 256]
                child = np.arange(FANOUT)
                x = (x[:, None, None] * FANOUT + child[None, :, None]).repeat(FANOUT, 2).ravel()
                y = (y[:, None, None] * FANOUT + child[None, None, :]).repeat(FANOUT, 1).ravel()
                inside = (x < n) & (y < n) & (x < y if level == 1 else x <= y)
                stack.append((level - 1, x[inside], y[inside]))


def _frequent(docs: DataFrame, n_docs: int) -> np.ndarray:
    """Hashes of windows that a large share of documents has, from counts per task."""

    def run(batches):
        known, counts, held, n_held = np.zeros(0, _U8), np.zeros(0, np.int64), [], 0

        def merged():
            """The windows held that stand twice or are known, sorted where they lie: few besides are copied."""
            every = np.concatenate([np.zeros(0, _U8), *held])
            held.clear()
            every.sort()
            repeated = every[1:][every[1:] == every[:-1]]
            members = np.union1d(known, repeated)
            total = np.searchsorted(every, members, "right") - np.searchsorted(every, members)
            total[np.searchsorted(members, known)] += counts
            return members, total

        for batch in batches:
            for found in sets_of(texts_of(batch)):
                held.append(found)
                n_held += len(found)
                if n_held >= HELD:
                    known, counts = merged()
                    n_held = 0
        known, counts = merged()
        many = counts >= REPORTED
        release()
        yield pa.RecordBatch.from_arrays(
            [pa.array(known[many].view(np.int64)), pa.array(counts[many])], names=["window", "n"]
        )

    counted = docs.select("text").mapInArrow(run, "window long, n long").groupBy("window").agg(F.sum("n").alias("n"))
    frequent = counted.where(F.col("n") >= max(2 * REPORTED, math.ceil(n_docs * FREQUENT)))
    rows = frequent.orderBy(F.desc("n"), "window").limit(LISTED).collect()
    return np.sort(np.array([r["window"] for r in rows], np.int64).view(np.uint64))


def _first_windows(found: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The set's first windows, rare ones and then frequent ones, each by hash."""
    need = prefix_length(len(found)) if len(found) else 0
    usual = np.isin(found, last, assume_unique=True) if len(last) else np.zeros(len(found), bool)
    rare = found[~usual][:need]
    return rare, found[usual][: need - len(rare)]


def _described(docs: DataFrame, frequent) -> DataFrame:
    """Each document's set: size, class, point, and those first windows that are frequent."""

    def run(batches):
        for batch in batches:
            rows = []
            for found in sets_of(texts_of(batch)):
                common = _first_windows(found, frequent.value)[1]
                rows.append((len(found), name_of(found), point_of(found), common.tobytes()))
            columns = list(zip(*rows, strict=True)) or [()] * 4
            kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("row"), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))],
                names=["doc_id", "row", "n", "class", "point", "common"],
            )

    return docs.mapInArrow(run, "doc_id long, row long, n long, class long, point binary, common binary")


def _rare_windows(frequent):
    """For lists_of: the rare first windows of every set that the task has not seen yet."""

    def start():
        seen: set[int] = set()

        def hashed(batch):
            hashes, owners = [np.zeros(0, _U8)], [np.zeros(0, _U8)]
            if len(seen) > HELD:
                seen.clear()
            for found in sets_of(texts_of(batch)):
                name = name_of(found)
                if name in seen or not len(found):
                    continue  # a copy; its windows are on their way
                seen.add(name)
                hashes.append(_first_windows(found, frequent.value)[0])
                owners.append(np.full(len(hashes[-1]), name, np.int64).view(_U8))
            return np.concatenate(hashes), np.concatenate(owners)

        return hashed

    return start


def _bounded(pairs: DataFrame, points: DataFrame) -> DataFrame:
    """Pairs whose points allow enough overlap."""

    def run(batches):
        for batch in batches:
            points = zip(batch.column("p").to_pylist(), batch.column("q").to_pylist(), strict=True)
            shared = [shared_bound(unpacked_point(x), unpacked_point(y)) for x, y in points]
            total = batch.column("n_a").to_numpy() + batch.column("n_b").to_numpy()
            near = np.array(shared, np.int64) >= least_overlap(total)
            yield batch.select(["a", "b"]).filter(pa.array(near))

    near, of = NEAR
    p = points.select(F.col("class").alias("a"), F.col("n").alias("n_a"), F.col("point").alias("p"))
    q = points.select(F.col("class").alias("b"), F.col("n").alias("n_b"), F.col("point").alias("q"))
    # Sizes first, so that few points travel.
    sizes = pairs.join(p.drop("p"), "a").join(q.drop("q"), "b")
    sizes = sizes.where(F.least("n_a", "n_b") * of >= F.greatest("n_a", "n_b") * near).select("a", "b")
    return sizes.join(p, "a").join(q, "b").select("a", "b", "p", "q", "n_a", "n_b").mapInArrow(run, "a long, b long")


def _searched(points: DataFrame, most: int, *keys: str) -> DataFrame:
    """Pairs (a, b) with different roots that a group's R-tree lets through.

    Each member gives the `most` pairs in which the bound allows the greatest similarity;
    a group with more pairs than that also gives a row with its first key and no pair.
    """

    def search(table: pa.Table) -> pa.Table:
        ids = table.column("class").to_numpy()
        fine, at = points_of(table.column("point").to_pylist())
        found = list(CountTree(at, table.column("root").to_numpy()).pairs())
        if not found:
            none = pa.array([], pa.int64())
            return pa.table({"a": none, "b": none, "over": none})
        a, b, similar = (np.concatenate(x) for x in zip(*found, strict=True))
        # Long documents have finer points than the tree; they bound once more.
        groups, sizes = np.array([len(x) for x in fine]), at.sum(axis=1)
        for k in np.flatnonzero(np.minimum(groups[a], groups[b]) > GROUPS).tolist():
            shared, total = shared_bound(fine[a[k]], fine[b[k]]), sizes[a[k]] + sizes[b[k]]
            similar[k] = shared / (total - shared) if shared >= least_overlap(total) else -1
        a, b, similar = a[similar >= 0], b[similar >= 0], similar[similar >= 0]
        pair = np.tile(np.arange(len(a)), 2)
        node = np.concatenate([a, b])
        order = np.lexsort((np.tile(-similar, 2), node))
        starts = np.flatnonzero(np.concatenate([[True], np.diff(node[order]) > 0]))
        rank = np.arange(len(order)) - np.repeat(starts, np.diff(np.concatenate([starts, [len(order)]])))
        kept = np.unique(pair[order[rank < most]])
        x, y = ids[a[kept]], ids[b[kept]]
        x, y, over = pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y)), pa.nulls(len(x), pa.int64())
        if len(kept) < len(a):
            none, key = pa.nulls(1, pa.int64()), pa.array(table.column(keys[0])[:1].to_numpy())
            x, y, over = (pa.concat_arrays(z) for z in ((x, none), (y, none), (over, key)))
        return pa.table({"a": x, "b": y, "over": over})

    return points.groupBy(*keys).applyInArrow(search, "a long, b long, over long")


def _verified(pairs: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs of classes whose sets are near, by the sets themselves."""
    near, of = NEAR
    both = pairs.select(F.col("a").alias("class")).union(pairs.select("b")).distinct()
    wanted = stored(classes.join(both, "class", "left_semi").select("class", "rep", "n"), "wanted")

    def run(batches):
        for batch in batches:
            found = list(sets_of(texts_of(batch)))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([name_of(x) for x in found], pa.int64()),
                    pa.array([x.view(np.int64) for x in found], pa.list_(pa.int64())),
                ],
                names=["class", "found"],
            )

    texts = docs.join(wanted.select(F.col("rep").alias("doc_id")).distinct(), "doc_id", "left_semi")
    sets = texts.select("text").mapInArrow(run, "class long, found array<long>")
    sets = stored(sets.join(wanted, "class").dropDuplicates(["class"]).select("class", "n", "found"), "sets")
    a = sets.select(F.col("class").alias("a"), F.col("n").alias("n_a"), F.col("found").alias("found_a"))
    b = sets.select(F.col("class").alias("b"), F.col("n").alias("n_b"), F.col("found").alias("found_b"))
    shared = F.size(F.array_intersect("found_a", "found_b"))
    checked = pairs.join(b, "b").join(a, "a").select("a", "b", "n_a", "n_b", shared.alias("o"))
    return checked.where((F.col("n_a") + F.col("n_b") - F.col("o")) * near <= F.col("o") * of).select("a", "b")


def join(docs: DataFrame) -> DataFrame:
    """Sets and components of near documents: doc_id, n_shingles, component_id, class_id.

    One row per input row. Documents with the same class_id have equal sets. A NULL or
    empty text, or one of white space, has no set (n_shingles 0), links with nothing and
    is its own component. Repeated rows are alike; rows that repeat an id with other
    texts are documents of their own. A NULL doc_id stays NULL and links nothing. Other
    columns are ignored; an empty table gives none.
    """
    return _joined(docs).drop("row")


def without_copies(docs: DataFrame) -> DataFrame:
    """`docs` with one document of each component, the one with the smallest doc_id.

    All columns stay. Documents without words or without a doc_id stay; of rows that
    agree in doc_id and text one stays.
    """
    found = stored(_joined(docs).select("doc_id", "row", "component_id"), "near-copies")
    gone = found.where("component_id <> doc_id").select("doc_id", "row").distinct()
    twice = found.where("doc_id is not null").groupBy("doc_id", "row").count().where("count > 1")
    twice = stored(twice.select("doc_id", "row"), "repeated-rows")

    def among(rows: DataFrame, other: DataFrame, how: str) -> DataFrame:
        same = (F.col("d.doc_id").cast("long") == F.col("o.doc_id")) & (
            F.xxhash64(F.col("d.text").cast("string")) == F.col("o.row")
        )
        return rows.alias("d").join(other.alias("o"), same, how)

    left = among(docs, stored(gone, "copies"), "left_anti")
    if twice.isEmpty():
        return left
    return among(left, twice, "left_anti").unionByName(among(left, twice, "left_semi").dropDuplicates(["doc_id", "text"]))


def _joined(docs: DataFrame) -> DataFrame:
    """What `join` gives, with `row`, a hash of the text."""
    spark: SparkSession = docs.sparkSession
    text_batches(spark)
    docs = pick(docs, doc_id="long", text="string").withColumn("row", F.xxhash64("text"))
    frequent = spark.sparkContext.broadcast(_frequent(docs, docs.count()))
    described = stored(_described(docs, frequent), "sets")
    linkable = described.where("n > 0 and doc_id is not null")
    named = linkable.groupBy("class").agg(
        F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("point").alias("point")
    )
    classes = stored(named, "classes")

    # Groups of classes that share a rare first window.
    n_windows = (classes.agg(F.sum("n")).first()[0] or 0) * (NEAR[1] - NEAR[0]) // NEAR[1]
    lists = lists_of(docs.where("doc_id is not null").select("text"), _rare_windows(frequent), n_windows)
    groups = stored(lists.withColumn("gid", F.monotonically_increasing_id()), "groups")
    rare = unpacked(groups).withColumnRenamed("member", "class")

    # Frequent windows, no more than are listed: their members stay where they are.
    def listed(batches):
        for batch in batches:
            raw = [np.frombuffer(x, np.int64) for x in batch.column("common").to_pylist()]
            if raw:
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate(raw)),
                        pa.array(np.repeat(batch.column("class").to_numpy(), [len(x) for x in raw])),
                    ],
                    names=["window", "class"],
                )

    common = linkable.where(F.octet_length("common") > 0).select("class", "common")
    common = stored(common.mapInArrow(listed, "window long, class long").distinct(), "common-members")

    # First every member with the first of its group, if the bound allows.
    leaders = F.broadcast(common.groupBy("window").agg(F.min("class").alias("a")))
    first = _firsts(groups)
    stars = first.union(common.join(leaders, "window").select("a", F.col("class").alias("b")))
    stars = stored(_bounded(stars.where("a <> b").distinct(), classes), "stars")
    links = stored(_verified(stars, classes, docs), "star-links")
    roots = stored(components(links), "roots")

    # Then what links leave apart, by trees over the points of a group. Most members need
    # few more links to hang together, so members give few pairs at first, and more in groups
    # that have others left: at the end every pair is linked already or has been tried.
    rare = stored(rare, "rare-members")
    points = classes.select("class", "point")
    roots = stored(components(links), "roots", narrow=True)
    tried, most = stars, 2
    while True:
        searched = _apart(rare, roots, points, most).withColumn("wide", F.lit(False)).union(
            _apart_wide(common, roots, points, most).withColumn("wide", F.lit(True))
        )
        found = stored(searched.distinct(), "tree-pairs")
        pairs = found.where("a is not null").select("a", "b").distinct()
        fresh = stored(pairs.join(tried, ["a", "b"], "left_anti"), "fresh-pairs", narrow=True)
        links = stored(links.union(_verified(fresh, classes, docs)), "links", narrow=True)
        roots = stored(components(links), "roots", narrow=True)
        over = found.where("a is null").select("wide", "over").distinct()
        if over.isEmpty():
            break
        tried = stored(tried.union(fresh), "tried-pairs", narrow=True)
        rare = rare.join(over.where("not wide").select(F.col("over").alias("gid")), "gid", "left_semi")
        rare = stored(rare, "rare-members", narrow=True)
        common = common.join(over.where("wide").select(F.col("over").alias("window")), "window", "left_semi")
        common = stored(common, "common-members", narrow=True)
        most *= 16

    placed = roots.join(classes.select(F.col("class").alias("node"), "rep"), "node")
    least = stored(placed.groupBy("root").agg(F.min("rep").alias("least")), "least")
    linked = stored(placed.join(least, "root").select(F.col("node").alias("class"), "least"), "linked")
    of_class = classes.join(linked, "class", "left").select(
        "class", F.coalesce("least", "rep").alias("component_id")
    )
    of_class = stored(of_class, "of-class")
    linked = F.when(F.col("n") > 0, F.col("component_id"))
    return described.select("doc_id", "row", "n", "class").join(of_class, "class", "left").select(
        "doc_id",
        "row",
        F.col("n").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce(linked, "doc_id")).alias("component_id"),
        F.when(F.col("n") > 0, F.col("class")).alias("class_id"),
    )


def _rooted(members: DataFrame, roots: DataFrame, key: str) -> DataFrame:
    root = F.coalesce("root", "class").alias("root")
    return members.join(roots, F.col("class") == F.col("node"), "left").select(key, "class", root)


def _apart(members: DataFrame, roots: DataFrame, points: DataFrame, most: int) -> DataFrame:
    """Pairs from the groups that links leave in several parts."""
    at = stored(_rooted(members, roots, "gid"), "rooted")
    apart = at.groupBy("gid").agg(F.min("root").alias("x"), F.max("root").alias("y"), F.count("*").alias("m"))
    apart = apart.where("x <> y and m > 2").select("gid")
    return _searched(at.join(apart, "gid", "left_semi").join(points, "class"), most, "gid")


def _apart_wide(members: DataFrame, roots: DataFrame, points: DataFrame, most: int) -> DataFrame:
    """The same for groups of any size: each is dealt into blocks, and pairs of blocks are searched."""
    wide = _rooted(members, roots, "window")
    apart = wide.groupBy("window").agg(F.min("root").alias("x"), F.max("root").alias("y"), F.count("*").alias("m"))
    blocks = F.ceil(F.col("m") / BLOCK).alias("blocks")
    apart = stored(apart.where("x <> y and m > 2").select("window", blocks), "wide-apart")
    wide = wide.join(F.broadcast(apart), "window").withColumn("i", F.pmod(F.xxhash64("class"), F.col("blocks")))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    wide = wide.withColumn("j", other).select(
        "window", "class", "root", F.least("i", "j").alias("i"), F.greatest("i", "j").alias("j")
    )
    return _searched(wide.join(points, "class"), most, "window", "i", "j")


def _firsts(groups: DataFrame) -> DataFrame:
    """(a, b): the first member of each list with every other."""

    def run(batches):
        for batch in batches:
            found = [np.frombuffer(x, np.int64) for x in batch.column("members").to_pylist()]
            if found:
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate([np.full(len(x) - 1, x[0]) for x in found])),
                        pa.array(np.concatenate([x[1:] for x in found])),
                    ],
                    names=["a", "b"],
                )

    return groups.select("members").mapInArrow(run, "a long, b long")
