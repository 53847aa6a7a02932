"""Best-fit packing of whole documents into sequences of a fixed length.

Documents of the same length are interchangeable, so a packing is decided over
length classes with counts: never more rows than the capacity, however many
documents there are. It is made in bulk-synchronous rounds. In each, the classes
left and the gaps are sorted by size; one sweep gives every document the smallest
gap that holds it (its successor among the gaps); documents that ask for the same
gaps are told apart by their rank in their class; gaps are updated; and the next
round begins. What comes out are runs: "documents of rank r to r + n of length s go
to sequences q to q + n / k, k in each, from offset o". Spark makes the tokens, the
counts, the rank of each piece, and places each piece by its run.
"""

from __future__ import annotations

import bisect
import functools
import gc
import os
import re
import struct
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runlens.llm.chunks import Generations, chosen, numbered, put_together, together, words_of
from runlens.llm.shared import pick, stored, text_batches
from runlens.llm.tokens import byte_symbols, chunks_of

# Characters of the pieces that one generation of a worker's table holds.
KEPT = 5_000_000
# Bytes of texts encoded at once, unless one batch from Spark has more.
TOGETHER = 1 << 24
# The same where memory is short.
SPARING = 1 << 20
# Lower-case letters that the library takes as they are, and as one word.
_WORD = re.compile(r"[a-zà-öø-ʯ]+")
_SYMBOLS = dict(enumerate(byte_symbols()))
_KIND = np.dtype("<u4")

_RUN = "length long, first_rank long, n long, each long, sequence long, at long"


class Ids:
    """Ids of texts by the library; each piece between spaces is encoded once in a while."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.model = self.library.model
        self.known = Generations(KEPT)

    def _learn(self, pieces: list[str]) -> dict[str, bytes]:
        """Pieces between spaces may have other white space; most are one chunk."""
        cut = [[x] if x.isalnum() else chunks_of(x) for x in pieces]
        made = self._made({x for chunks in cut for x in chunks})
        found = {piece: b"".join([made[x] for x in chunks]) for piece, chunks in zip(pieces, cut, strict=True)}
        self.known.add_all(found)
        return found

    def _made(self, chunks: set[str]) -> dict[str, bytes]:
        """Chunks of letters, and perhaps a mark, are put together from a word and the mark."""
        parts, wanted = [], set()
        for chunk in chunks:
            mark = chunk[-1] if chunk[-1] in ".," else ""
            word = chunk[:-1] if mark else chunk
            if not word.isalpha() or "Σ" in word:  # lower() treats a last sigma in its own way
                word, mark = chunk, ""
            else:
                word = word.lower()
            parts.append((chunk, word, mark))
            wanted.add(word)
            wanted.add(mark)
        known = self.known.all(list(wanted))
        others = []
        for word in [x for x, ids in known.items() if ids is None]:
            if _WORD.fullmatch(word):  # goes to the model without being looked for
                symbols = word if word.isascii() else word.encode().decode("latin-1").translate(_SYMBOLS)
                ids = [x.id for x in self.model.tokenize(symbols)]
                known[word] = struct.pack(f"<{len(ids)}I", *ids)
                self.known.add(word, known[word])
            else:
                others.append(word)
        for at in range(0, len(others), 20_000):
            some = others[at : at + 20_000]
            for word, made in zip(some, self.library.encode_batch_fast(some, add_special_tokens=False), strict=True):
                known[word] = struct.pack(f"<{len(made.ids)}I", *made.ids)
        return {chunk: known[word] + known[mark] for chunk, word, mark in parts}

    def of(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit numbers."""
        ids, ends = self.batch(pa.array(texts, pa.string()), b"")
        return [x.tobytes() for x in np.split(ids, ends[:-1])] if texts else []

    def batch(self, texts: pa.Array, last: bytes) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, `last` behind each, and where each ends among them.

        Arrow tells the words of pieces from the marks behind them, so that of most pieces only
        distinct words are strings here.
        """
        edges, codes, names = numbered(texts)
        words = words_of(names, lower=True)
        # Nothing cyclic is made here, and the collector would go over all that is
        # kept again and again.
        gc.disable()
        try:
            self.known.turn()
            marks = words.marks.to_pylist()
            of_marks = {"": b"", **self._made({x for x in marks if x})}
            of_words = self._words(words.words.to_pylist())
            found = self.known.all(words.others)
            found.update(self._learn([x for x, ids in found.items() if ids is None]))
        finally:
            gc.enable()
        of_others = [found[x] for x in words.others]
        made, ends = put_together(words, of_words, [of_marks[x] for x in marks], of_others, _KIND)
        made = np.concatenate([made, np.frombuffer(last, _KIND)])
        ends = np.append(ends, len(made))
        ids, stops = chosen(made, ends, np.insert(codes, edges[1:], len(names)))
        return ids, stops[edges[1:] + np.arange(len(edges) - 1)]

    def _words(self, words: list[str]) -> list[bytes]:
        """The ids of distinct lower-case words, which go to the model without being looked for."""
        found = self.known.all(words)
        tokenize, new = self.model.tokenize, {}
        for word in [x for x, ids in found.items() if ids is None]:
            symbols = word if word.isascii() else word.encode().decode("latin-1").translate(_SYMBOLS)
            made = [x.id for x in tokenize(symbols)]
            new[word] = struct.pack(f"<{len(made)}I", *made)
        self.known.add_all(new)
        found.update(new)
        return [*found.values()]


@functools.cache
def ids(path: str) -> Ids:
    """One encoder per worker process and vocabulary file."""
    return Ids(path)


def pieces(docs: DataFrame, vocabulary: str, capacity: int, sparing: bool = False) -> DataFrame:
    """Each document's ids and a closing id 0, cut after every `capacity` ids.

    `task` and `nth` tell pieces of one length apart: the nth piece of that length
    that the task made.
    """
    text_batches(docs.sparkSession)

    def run(batches):
        encode, task, seen = ids(vocabulary), TaskContext.get().partitionId(), Counter()
        for batch in together(batches, SPARING if sparing else TOGETHER):
            out = []
            names = batch.column("doc_id").to_pylist()
            found, ends = encode.batch(pc.fill_null(batch.column("text"), ""), b"\0\0\0\0")
            raw, begin = memoryview(found.tobytes()), 0
            for name, end in zip(names, ends.tolist(), strict=True):
                for number, start in enumerate(range(0, end - begin, capacity)):
                    length = min(capacity, end - begin - start)
                    crc = zlib.crc32(raw[4 * (begin + start) : 4 * (begin + start + length)])
                    out.append((name, number, start, length, crc, task, seen[length]))
                    seen[length] += 1
                begin = end
            columns = list(zip(*out, strict=True)) or [()] * 7
            kinds = [pa.int64(), pa.int32(), *[pa.int64()] * 5]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "task", "nth"],
            )
            if sparing:
                encode.known.forget()
        if not sparing:
            encode.known.rest()

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, task long, nth long"
    return pick(docs, doc_id="long", text="string").mapInArrow(run, schema)


def plan(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Runs (length, first rank, pieces, pieces in each sequence, first sequence, offset).

    `counts` has the number of pieces of each length up to `capacity`.
    """
    runs, sequences = [], 0
    taken = Counter()
    left = {s: n for s, n in counts.items() if n}
    gaps: dict[int, list[tuple[int, int]]] = {}  # by gap: runs (first sequence, sequences)

    def fill(length, n, each, sequence, at):
        runs.append((length, taken[length], n, each, sequence, at))
        taken[length] += n

    def into(size, gap, wanted):
        """Puts up to `wanted` pieces of `size` into sequences with `gap` left; how many it put."""
        put = 0
        each = gap // size
        while put < wanted and gaps.get(gap):
            first, n = gaps[gap].pop()
            full = min(n, (wanted - put) // each)
            if full:
                fill(size, full * each, each, first, capacity - gap)
                opened.append((gap - full_of(size, each), first, full))
                put += full * each
                first, n = first + full, n - full
            if n and put < wanted:  # the last one gets fewer
                rest = min(wanted - put, each)
                fill(size, rest, rest, first, capacity - gap)
                opened.append((gap - full_of(size, rest), first, 1))
                put += rest
                first, n = first + 1, n - 1
            if n:
                gaps[gap].append((first, n))
        return put

    def full_of(size, each):
        return size * each

    while left:
        # Sweep: from the largest class down, each takes its successors among the gaps.
        opened: list[tuple[int, int, int]] = []
        sizes = sorted(g for g, r in gaps.items() if r and g)
        for size in sorted(left, reverse=True):
            at = bisect.bisect_left(sizes, size)
            while left[size] and at < len(sizes):
                left[size] -= into(size, sizes[at], left[size])
                if gaps[sizes[at]]:
                    break  # pieces of this class have run out first
                sizes.pop(at)
        left = {s: n for s, n in left.items() if n}
        for gap, first, n in opened:
            gaps.setdefault(gap, []).append((first, n))
        if opened or not left:
            continue
        # Nothing fits: the largest class opens sequences of its own.
        size = max(left)
        each = capacity // size
        n = left.pop(size)
        for number, per in ((n // each, each), (min(1, n % each), n % each)):
            if number:
                fill(size, number * per, per, sequences, 0)
                gaps.setdefault(capacity - size * per, []).append((sequences, number))
                sequences += number
    return runs


def pack(docs: DataFrame, vocabulary: str, capacity: int = 2048, sparing: bool = False) -> DataFrame:
    """Places every piece of every document in a sequence of at most `capacity` ids.

    One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.
    A NULL or empty text is its closing id alone; rows with the same or no doc_id are
    documents of their own; an empty table gives no rows; other columns are ignored.

    One pass makes the pieces, which are written to the shared folder as a few numbers
    each. Ranks within a length come from counts per task, so no window holds the
    pieces of a length together and a common length is no burden.

    With `sparing`, fewer texts are encoded at once, and tables of words end with them
    instead of staying for the worker's next task: where earlier stages have left more workers than
    there are cores, tasks go round them, and each would hold tables.
    """
    spark = docs.sparkSession
    made = stored(pieces(docs, vocabulary, capacity, sparing), "pieces")
    counted = made.groupBy("length", "task").agg(F.count("*").alias("n"))
    by_length = {r["length"]: r["n"] for r in counted.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    runs = spark.createDataFrame(plan(by_length, capacity), _RUN)
    before = F.sum("n").over(_tasks_before())
    ranks = counted.select("length", "task", (F.coalesce(before, F.lit(0))).alias("ranked"))
    ranked = made.join(ranks, ["length", "task"]).withColumn("rank", F.col("ranked") + F.col("nth"))
    run = F.broadcast(runs.withColumnRenamed("length", "run_length"))
    inside = (F.col("rank") >= F.col("first_rank")) & (F.col("rank") < F.col("first_rank") + F.col("n"))
    nth = F.col("rank") - F.col("first_rank")
    return ranked.join(run, (F.col("length") == F.col("run_length")) & inside).select(
        "doc_id",
        "piece",
        "start",
        "length",
        "ids_crc32",
        (F.col("sequence") + F.floor(nth / F.col("each"))).cast("long").alias("sequence_id"),
        (F.col("at") + F.col("length") * (nth % F.col("each"))).cast("long").alias("offset"),
    )


def _tasks_before():
    from pyspark.sql import Window

    return Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
