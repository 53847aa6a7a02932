"""Removal of lines that are near copies of an earlier line, by a segment-partition edit join.

If two lines are at most `edits` edits apart, one of `edits + 1` segments of the
shorter stands unchanged in the longer, near its own place. Segments of every line are
indexed by the line's length, their number and content; lines look up their own
substrings that may match, for their own length and the shorter ones in reach (the
windows of Pass-Join's multi-match rule). Lines that meet are verified with a banded
bit-parallel edit distance, for many pairs at once.

Short lines get fewer edits, one for every CHARS_PER_EDIT characters of the shorter
line: one edit makes another line of a few letters. Those too short for any go as exact
copies only, which every line that is not blank is counted for.

Order is by doc_id, then by line. A line goes if any earlier line is at most as many
edits apart, so the outcome doesn't depend on how the work is split.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from runlens.llm.chunks import give_back
from runlens.llm.meeting import lists_of, unpacked
from runlens.llm.shared import runs_of, stored, text_batches, texts_of
from runlens.llm.words import _BASE, BUFFER, _powers, mixed

# Most edits between a line and its near copy, and characters of the shorter for each edit.
EDITS = 2
CHARS_PER_EDIT = 12
# Classes that characters are counted in, for a quick bound on the distance.
CLASSES = 16
# Lines of a group that are searched together.
BLOCK = 4096
# Lines that a task remembers having looked up.
HELD = 1 << 18
# Characters of line pairs verified at once.
VERIFIED = 1 << 21

_characters: list[np.ndarray] = []


def _values(points: np.ndarray) -> np.ndarray:
    """A 64-bit value for each character."""
    if not _characters:
        _characters.append(mixed(np.arange(1, 0x110001, dtype=np.uint64) * np.uint64(_BASE)))
    return _characters[0][points]


def lines_in(text: str) -> list[str]:
    """The text's lines, without white space around them."""
    return [x.strip() for x in text.split("\n")]


def key_of(line: str) -> bytes:
    return hashlib.blake2b(line.encode("utf-8"), digest_size=16).digest()


def segment(length, number: int, parts: int):
    """(start, length) of a segment; the last segments take what doesn't divide."""
    even, over = length // parts, length % parts
    return number * even + np.maximum(0, number - (parts - over)), even + (number >= parts - over)


def _probes(edits: int):
    """(shorter by, segment, shift) of every substring that a line looks up."""
    for less in range(edits + 1):
        for number in range(edits + 1):
            for shift in range(max(-number, less - (edits - number)), min(number, less + edits - number) + 1):
                yield less, number, shift


def edits_of(lengths: np.ndarray, edits: int, per: int) -> np.ndarray:
    """Edits that pairs may have whose shorter line has these lengths; all if `per` is 0."""
    return np.minimum(edits, lengths // per) if per else np.full(len(lengths), edits)


def segment_hashes(lines: list[str], edits: int = EDITS, per: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, line's place, whether it is the line's own segment) of all lookups."""
    levels = range(1, edits + 1) if per else [edits]
    hashes, places, own = [], [], []
    for part in runs_of([len(x) for x in lines], BUFFER):
        some = lines[part]
        points = np.frombuffer("".join(some).encode("utf-32-le"), "<u4")
        lengths = np.fromiter(map(len, some), np.int64, len(some))
        starts = np.concatenate([[0], np.cumsum(lengths)])[:-1]
        _powers.grow(len(points) + 1)
        sums = np.zeros(len(points) + 1, np.uint64)
        np.cumsum(_values(points) * _powers.up[: len(points)], out=sums[1:])
        for level, (less, number, shift) in ((x, y) for x in levels for y in _probes(x)):
            of = lengths - less
            at, size = segment(of, number, level + 1)
            at = at + shift
            good = (at >= 0) & (at + size <= lengths) & (size > 0) & (edits_of(of, edits, per) == level)
            begin, size, of = (starts + at)[good], size[good], of[good]
            found = (sums[begin + size] - sums[begin]) * _powers.down[begin]
            kind = mixed(of.astype(np.uint64) * np.uint64(256) + np.uint64(number + 1))
            hashes.append(mixed(found ^ kind))
            places.append(np.flatnonzero(good) + part.start)
            own.append(np.full(len(begin), less == 0 and shift == 0))
    empty = np.zeros(0, np.int64)
    return (
        np.concatenate([empty.astype(np.uint64), *hashes]),
        np.concatenate([empty, *places]),
        np.concatenate([empty.astype(bool), *own]),
    )


def within(lines: list[str], others: list[str], edits: int = EDITS) -> np.ndarray:
    """Which pairs are at most `edits` (31 or fewer) edits apart.

    The band of diagonals around the main one is a machine word: bit k of column j is
    row j - edits + k. Vertical differences of the band are kept as two words, moved
    down by one row with each column, and the score follows the band's lowest row.
    """
    out = np.zeros(len(lines), bool)
    lengths = np.array([[len(a), len(b)] for a, b in zip(lines, others, strict=True)], np.int64).reshape(-1, 2)
    near = np.flatnonzero(np.abs(lengths[:, 0] - lengths[:, 1]) <= edits)
    near = near[np.argsort(-lengths[near, 1], kind="stable")]
    for part in runs_of([int(lengths[i].max()) + 4 * edits for i in near], VERIFIED):
        some = near[part]
        out[some] = _within([lines[i] for i in some], [others[i] for i in some], edits)
    return out


def near(lines: list[str], others: list[str], edits: int, per: int) -> np.ndarray:
    """Which pairs are as near as the length of the shorter line allows."""
    shorter = np.array([min(len(a), len(b)) for a, b in zip(lines, others, strict=True)], np.int64)
    allowed = edits_of(shorter, edits, per)
    out = np.zeros(len(lines), bool)
    for level in np.unique(allowed).tolist():
        at = np.flatnonzero(allowed == level)
        out[at] = within([lines[i] for i in at], [others[i] for i in at], level)
    return out


def _padded(texts: list[str], before: int, width: int, filler: int) -> np.ndarray:
    made = np.full((len(texts), width), filler, np.uint32)
    for i, x in enumerate(texts):
        made[i, before : before + len(x)] = np.frombuffer(x.encode("utf-32-le"), "<u4")
    return made


def _within(lines: list[str], others: list[str], edits: int) -> np.ndarray:
    """The same for pairs in descending order of the second's length."""
    m = np.array([len(x) for x in lines], np.int64)
    n = np.array([len(x) for x in others], np.int64)
    most, width = int(n.max(initial=0)), 2 * edits + 1
    # Rows outside the line never match: their filler is no character.
    rows = np.ascontiguousarray(_padded(lines, edits, most + 3 * edits + 1, 0xFFFFFFFF).T)
    columns = np.ascontiguousarray(_padded(others, 0, most, 0xFFFFFFFE).T)
    one, mask, top = np.uint64(1), np.uint64((1 << width) - 1), np.uint64(1 << (width - 1))
    up = np.full(len(m), ((1 << edits) - 1) << (edits + 1), np.uint64)
    down = np.zeros(len(m), np.uint64)
    score = np.full(len(m), edits, np.int64)
    active = len(m)
    ends = np.searchsorted(-n, -np.arange(1, most + 1), side="right")
    for j in range(most):
        if ends[j] < active:  # these have seen their last column
            active = int(ends[j])
        v, w = up[:active] >> one | top, down[:active] >> one
        c = columns[j, :active]
        equal = np.zeros(active, np.uint64)
        for k in range(width):
            equal |= (rows[j + k, :active] == c).astype(np.uint64) << np.uint64(k)
        same = ((((equal & v) + v) ^ v) | equal | w) & mask
        right_up, right_down = (w | ~(same | v)) & mask, same & v
        score[:active] += (same & top) == 0
        right_up = right_up << one | one
        right_down = right_down << one
        up[:active] = (right_down | ~(same | right_up)) & mask
        down[:active] = right_up & same & mask
    # From the band's lowest row, n + edits, back up to row m.
    above = np.clip(m - n + edits + 1, 0, width).astype(np.uint64)
    tail = ~((one << above) - one) & mask
    distance = score - np.bitwise_count(up & tail).astype(np.int64) + np.bitwise_count(down & tail).astype(np.int64)
    return distance <= edits


def _occurrences(docs: DataFrame) -> DataFrame:
    """Every line that is not blank: its key, its place, and counts of its characters."""

    def run(batches):
        give_back()
        for batch in batches:
            out = [[], [], [], []]
            ids, rows = batch.column("doc_id").to_pylist(), batch.column("row").to_pylist()
            lines = []
            for name, row, text in zip(ids, rows, texts_of(batch), strict=True):
                for number, line in enumerate(lines_in(text)):
                    if line:
                        lines.append(line)
                        for to, x in zip(out, (key_of(line), name, row, number), strict=True):
                            to.append(x)
            raw = np.frombuffer(b"".join(out[0]), "<i8").reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(raw[:, 0] & ~np.int64(1)),
                    pa.array(raw[:, 1]),
                    pa.array(_counts(lines), pa.binary()),
                    pa.array(out[1], pa.int64()),
                    pa.array(out[2], pa.int64()),
                    pa.array(out[3], pa.int64()),
                ],
                names=["line", "check", "counts", "doc_id", "row", "number"],
            )

    schema = "line long, check long, counts binary, doc_id long, row long, number long"
    return docs.mapInArrow(run, schema)


def _counts(lines: list[str]) -> list[bytes]:
    """How many characters of each class a line has, 255 at most."""
    out = []
    for part in runs_of([len(x) for x in lines], BUFFER):
        some = lines[part]
        points = np.frombuffer("".join(some).encode("utf-32-le"), "<u4")
        of = np.repeat(np.arange(len(some)), [len(x) for x in some])
        found = np.bincount(of * CLASSES + (points % CLASSES), minlength=len(some) * CLASSES)
        raw = np.minimum(found, 255).astype(np.uint8).tobytes()
        out += [raw[i : i + CLASSES] for i in range(0, len(raw), CLASSES)]
    return out


def _bounded(pairs: DataFrame, edits: int, per: int) -> DataFrame:
    """Pairs whose counts allow a distance within the limit: an edit changes two by one."""

    def run(batches):
        for batch in batches:
            a = np.frombuffer(b"".join(batch.column("counts_a").to_pylist()), np.uint8).reshape(-1, CLASSES)
            b = np.frombuffer(b"".join(batch.column("counts_b").to_pylist()), np.uint8).reshape(-1, CLASSES)
            a, b = a.astype(np.int64), b.astype(np.int64)
            allowed = edits_of(_longest(np.minimum(a.sum(axis=1), b.sum(axis=1))), edits, per)
            near = np.abs(a - b).sum(axis=1) <= 2 * allowed
            yield batch.select(["a", "b"]).filter(pa.array(near))

    return pairs.select("a", "b", "counts_a", "counts_b").mapInArrow(run, "a long, b long")


def _longest(sums: np.ndarray) -> np.ndarray:
    """The lengths of lines from their summed counts; a full count may stand for more."""
    return np.where(sums >= 255, 1 << 40, sums)


def _searched(states: DataFrame, edits: int, per: int) -> DataFrame:
    """(a, b): each open line b with every earlier line a of a group that the counts allow.

    Groups are dealt into blocks, and pairs of blocks are searched, each in one task.
    """
    blocks = F.ceil(F.col("m") / BLOCK).cast("long")
    dealt = states.withColumn("i", F.pmod(F.xxhash64("line"), blocks))
    other = F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1))
    dealt = dealt.withColumn("j", other).select(
        "gid", "line", "at.*", "counts", "open", F.least("i", "j").alias("i"), F.greatest("i", "j").alias("j")
    )

    def search(table: pa.Table) -> pa.Table:
        lines, is_open = table.column("line").to_numpy(), table.column("open").to_numpy(zero_copy_only=False)
        known = pc.is_valid(table.column("doc_id")).to_numpy(zero_copy_only=False)
        place = [pc.fill_null(table.column(x), 0).to_numpy() for x in ("number", "row", "doc_id")]
        rank = np.empty(len(lines), np.int64)
        rank[np.lexsort((*place, known))] = np.arange(len(lines))
        counts = np.frombuffer(b"".join(x.as_py() for x in table.column("counts")), np.uint8)
        counts = counts.reshape(-1, CLASSES).astype(np.int16)
        # An edit changes the sum of counts by one at most: only near sums can be near lines.
        sums = counts.sum(axis=1)
        order = np.argsort(sums, kind="stable")
        low = np.searchsorted(sums[order], sums - edits)
        high = np.searchsorted(sums[order], sums + edits, side="right")
        a, b = [lines[:0]], [lines[:0]]
        for x in np.flatnonzero(is_open).tolist():
            near = order[low[x] : high[x]]
            near = near[rank[near] < rank[x]]
            allowed = edits_of(_longest(np.minimum(sums[near], sums[x])), edits, per)
            near = near[np.abs(counts[near] - counts[x]).sum(axis=1) <= 2 * allowed]
            a.append(lines[near])
            b.append(np.full(len(near), lines[x]))
        return pa.table({"a": np.concatenate(a), "b": np.concatenate(b)})

    return dealt.groupBy("gid", "i", "j").applyInArrow(search, "a long, b long")


def _verified(pairs: DataFrame, first: DataFrame, docs: DataFrame, edits: int, per: int) -> DataFrame:
    """The pairs of lines that are near enough, by their texts."""
    both = pairs.select(F.col("a").alias("line")).union(pairs.select("b")).distinct()
    wanted = stored(first.join(both, "line", "left_semi").select("line", "doc_id", "row"), "wanted")

    def cut(batches):
        for batch in batches:
            lines = [y for x in texts_of(batch) for y in lines_in(x) if len(y) >= per]
            keys = np.frombuffer(b"".join(map(key_of, lines)), "<i8").reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys[:, 0] & ~np.int64(1)), pa.array(lines, pa.string())], names=["line", "text"]
            )

    there = wanted.select("doc_id", "row").distinct()
    same = docs["doc_id"].eqNullSafe(there["doc_id"]) & (docs["row"] == there["row"])
    cut_lines = docs.join(there, same, "left_semi").select("text").mapInArrow(cut, "line long, text string")
    texts = stored(cut_lines.join(wanted.select("line"), "line", "left_semi").dropDuplicates(["line"]), "texts")

    @F.pandas_udf(T.BooleanType())
    def are_near(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series(near(a.tolist(), b.tolist(), edits, per))

    a = texts.select(F.col("line").alias("a"), F.col("text").alias("text_a"))
    b = texts.select(F.col("line").alias("b"), F.col("text").alias("text_b"))
    return pairs.join(b, "b").join(a, "a").where(are_near("text_a", "text_b")).select("a", "b")


def repeated(docs: DataFrame, edits: int = EDITS, per: int = CHARS_PER_EDIT) -> DataFrame:
    """(doc_id, row, number) of every line that goes; `docs` has doc_id, row and text."""
    seen = stored(_occurrences(docs), "lines")
    place = F.struct("doc_id", "row", "number")
    lines = seen.groupBy("line", "check").agg(
        F.min(place).alias("first"), F.count("*").alias("n"), F.first("counts").alias("counts")
    )
    lines = stored(lines.select("line", "check", "first.*", "n", "counts"), "distinct-lines")
    often = stored(lines.where("n > 1").select("line", "check", *(F.col(x).alias(f"first_{x}") for x in ("doc_id", "row", "number"))), "often")
    again = seen.join(often, ["line", "check"]).where(
        ~(F.col("doc_id").eqNullSafe(F.col("first_doc_id")) & (F.col("row") == F.col("first_row")) & (F.col("number") == F.col("first_number")))
    )

    def start():
        give_back()
        seen: set[int] = set()

        def hashed(batch):
            found = {y for x in texts_of(batch) for y in lines_in(x) if len(y) >= per}
            found = {int.from_bytes(key_of(x)[:8], "little") & ~1: x for x in found}
            if len(seen) > HELD:
                seen.clear()
            names = np.array(sorted(found.keys() - seen), np.uint64)
            seen.update(names.tolist())
            hashes, places, own = segment_hashes([found[x] for x in names.tolist()], edits, per)
            return hashes, names[places] | own.astype(np.uint64)

        return hashed

    n_lines = lines.count()
    lists = lists_of(docs.select("text"), start, n_lines * sum(1 for _ in _probes(edits)), marked=True)
    groups = stored(lists.withColumn("gid", F.monotonically_increasing_id()), "groups")
    met = unpacked(groups).withColumnRenamed("member", "line")
    # Two lines whose 64 bits agree by chance count as the earlier one here.
    one = F.min(F.struct("doc_id", "row", "number", "counts")).alias("at")
    unique = lines.groupBy("line").agg(one).select("line", F.struct("at.doc_id", "at.row", "at.number").alias("at"), "at.counts")
    unique = stored(unique, "unique-lines")
    met = stored(met.join(unique, "line").select("gid", "line", "at", "counts"), "met")

    # Each line with the first of its group; what is verified is settled.
    leaders = met.groupBy("gid").agg(F.min(F.struct("at", "line", "counts")).alias("x"))
    leaders = leaders.select("gid", F.col("x.line").alias("a"), F.col("x.counts").alias("counts_a"))
    stars = met.join(leaders, "gid").where("a <> line").select("a", F.col("line").alias("b"), "counts_a", F.col("counts").alias("counts_b"))
    stars = stored(_bounded(stars, edits, per).distinct(), "stars")
    places = unique.select("line", "at.*")
    late = stored(_verified(stars, places, docs, edits, per).select(F.col("b").alias("line")).distinct(), "late")

    # The others with earlier lines of their groups that the counts allow.
    first = met.groupBy("gid").agg(F.min("at").alias("first"), F.count("*").alias("m"))
    states = met.join(late.withColumn("settled", F.lit(True)), "line", "left").join(first, "gid")
    is_open = F.col("settled").isNull() & (F.col("at") != F.col("first"))
    states = states.select("gid", "line", "at", "counts", "m", is_open.alias("open"))
    wanted = states.where("open and m > 2").select("gid").distinct()
    pairs = _searched(states.join(wanted, "gid", "left_semi"), edits, per)
    pairs = stored(pairs.distinct().join(stars, ["a", "b"], "left_anti"), "pairs")
    more = _verified(pairs, places, docs, edits, per).select(F.col("b").alias("line")).distinct()
    gone = late.union(more)
    near = places.join(gone, "line", "left_semi").select("doc_id", "row", "number")
    return again.select("doc_id", "row", "number").union(near).distinct()


def without_repeats(docs: DataFrame, edits: int = EDITS, per: int = CHARS_PER_EDIT) -> DataFrame:
    """`docs` with its repeated lines taken out of `text`, and n_lines, n_removed.

    One row per input row, with all its columns; columns named n_lines or n_removed are
    replaced. Lines are what stands between line breaks; white space around them does
    not count, and blank lines stay. Every other line goes if it stands earlier, or one of
    `edits` edits does, or of fewer for short lines: one for every `per` characters. A NULL text stays NULL
    with no lines, an empty one has one, empty line. Rows that agree in doc_id and text
    are one document given twice, and lose the same lines; a NULL doc_id comes first in
    the order. Lines without a loss keep their exact text. An empty table gives none.
    """
    text_batches(docs.sparkSession)
    text = F.col("text").cast("string")
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("row"), text.alias("text"))
    gone = repeated(plain, edits, per)
    gone = gone.groupBy("doc_id", "row").agg(F.collect_list("number").alias("numbers"))
    gone = gone.select(F.struct(F.col("doc_id"), "row").alias("of"), "numbers")
    gone = stored(gone, "repeated-lines")
    names = _free(docs, "of", "numbers")
    gone = gone.toDF(*names)
    here = docs.withColumn("doc_id", F.col("doc_id").cast("long"))
    same = F.col("doc_id").eqNullSafe(F.col(f"{names[0]}.doc_id")) & (F.xxhash64(text) == F.col(f"{names[0]}.row"))
    joined = here.join(gone, same, "left")
    removed = F.coalesce(F.size(names[1]), F.lit(0))
    kept = F.when(removed > 0, _kept(F.col("text"), F.col(names[1]))).otherwise(F.col("text"))
    return (
        joined.withColumn("n_lines", F.coalesce(F.size(F.split("text", "\n", -1)), F.lit(0)).cast("long"))
        .withColumn("n_removed", F.greatest(removed, F.lit(0)).cast("long"))
        .withColumn("text", kept)
        .drop(*names)
    )


@F.pandas_udf(T.StringType())
def _kept(text: pd.Series, numbers: pd.Series) -> pd.Series:
    out = []
    for x, gone in zip(text, numbers, strict=True):
        if x is not None and gone is not None:
            without = set(gone)
            x = "\n".join(y for i, y in enumerate(x.split("\n")) if i not in without)
        out.append(x)
    return pd.Series(out, dtype=object)


def _free(docs: DataFrame, *names: str) -> list[str]:
    """Names like the given ones that no column of `docs` has, whatever their case."""
    used = {x.lower() for x in docs.columns}
    out = []
    for name in names:
        while name.lower() in used:
            name += "_"
        out.append(name)
    return out

