"""Token ids of documents as binary files with Elias-Fano coded boundaries.

A file set is a folder of shards in ascending order of doc_id. A shard is one binary
image: the ids of its documents one after another, 16 bits each if the vocabulary
allows, else 32; the ends of the documents among them and their doc_ids, both
Elias-Fano coded, so that a boundary takes a few bits instead of 64 and is still found
without reading the others. Spark writes the images as rows of Parquet files, so they
go to any file system that Spark can reach and are committed as a whole.

Layout of an image, little-endian: 4 bytes "RLTI"; version and bytes of an id (16 bits
each); documents, documents without a doc_id (they come first), first doc_id, bytes of
both codes (64 bits each); the code of doc_id - first doc_id; the code of the ends; the ids.
"""

from __future__ import annotations

import functools
import gc
import json
import math
import os
import re
import struct
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from runlens.llm.chunks import Pieces, chosen, joined, numbered, put_together, together, words_of
from runlens.llm.elias_fano import EliasFano, encoded
from runlens.llm.shared import pick, stored, text_batches
from runlens.llm.tokens import byte_symbols

# Ids and documents of a shard, unless one document has more; ids of a writing task.
SHARD_IDS, SHARD_DOCS, TASK_IDS = 1 << 21, 1 << 16, 1 << 25
# Bytes of texts encoded at once, unless one batch from Spark has more.
TOGETHER = 1 << 24

# A word and ASCII marks behind it, but for the apostrophe, which may begin a token of letters.
_WORD = re.compile(r" [A-Za-zÀ-ÖØ-öø-ʯ]+")
_MARKED = re.compile(rf"({_WORD.pattern})([!-&(-/:-@\[-`{{-~]+)")
_SYMBOLS = dict(enumerate(byte_symbols()))
_SPACE = _SYMBOLS[32]
# Runs of marks whose ids a worker keeps.
KEPT_MARKS = 20_000
# Pieces of fewer ids are packed by functions made once.
PACKERS = 32

MAGIC, VERSION = b"RLTI", 1
_HEADER = struct.Struct("<4sHHQQqQQ")


class Encoder:
    """Ids of texts by the library, packed; each piece of text is encoded once in a while."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.library = Tokenizer.from_file(path)
        self.model = self.library.model
        self.kind = np.dtype("<u2" if self.library.get_vocab_size() <= 1 << 16 else "<u4")
        self.packers = [struct.Struct(f"<{n}{self.kind.char}").pack for n in range(PACKERS)]
        self.pieces = Pieces(self._together, self._alone, spaced=False) if can_be_cut(spec) else None
        self.marks: dict[str, bytes] = {}
        if self.pieces:
            self.lengths = byte_lengths(self.library)

    def _packed(self, ids: list[int]) -> bytes:
        n = len(ids)
        return self.packers[n](*ids) if n < len(self.packers) else struct.pack(f"<{n}{self.kind.char}", *ids)

    def _alone(self, piece: str, _: bool) -> bytes:
        return self._packed(self.library.encode(piece, add_special_tokens=False).ids)

    def _together(self, pieces: list[str]) -> list[bytes]:
        """Pieces of a word and marks are put together from the two: no token has some of both."""
        out, others, known = [b""] * len(pieces), [], self.pieces.known
        tokenize, packed = self.model.tokenize, self._packed
        for i, piece in enumerate(pieces):
            if piece[0] == " " and piece.isascii() and piece[1:].isalpha():
                out[i] = packed([x.id for x in tokenize(_SPACE + piece[1:])])
            elif _WORD.fullmatch(piece):
                out[i] = self._word(piece)
            elif found := _MARKED.fullmatch(piece):
                word, marks = found.groups()
                ids = known.find(word[1:])
                if ids is None:
                    ids = self._word(word)
                    known.add(word[1:], ids)
                out[i] = ids + self._marks(marks)
            else:
                others.append(i)
        if others:
            for i, ids in zip(others, self._encoded([pieces[i] for i in others]), strict=True):
                out[i] = ids
        return out

    def _marks(self, marks: str) -> bytes:
        ids = self.marks.get(marks)
        if ids is None:
            if len(self.marks) > KEPT_MARKS:
                self.marks.clear()
            ids = self.marks[marks] = self._alone(marks, True)
        return ids

    def _word(self, word: str) -> bytes:
        """A space and letters are one word to the library, and go to its model without being looked for."""
        if word.isascii():
            symbols = _SPACE + word[1:]
        else:
            symbols = word.encode().decode("latin-1").translate(_SYMBOLS)
        return self._packed([x.id for x in self.model.tokenize(symbols)])

    def _encoded(self, pieces: list[str]) -> list[bytes]:
        """Pieces encoded as one text, and cut where each ends."""
        (made,) = self.library.encode_batch_fast(["".join(pieces)], add_special_tokens=False)
        ids = np.array(made.ids, np.int64)
        ends = np.cumsum([len(x.encode()) for x in pieces])
        cuts = np.searchsorted(np.cumsum(self.lengths[ids]), ends) + 1
        raw, size = ids.astype(self.kind).tobytes(), self.kind.itemsize
        return [raw[i * size : j * size] for i, j in zip([0, *cuts.tolist()], cuts.tolist(), strict=False)]

    def of(self, texts: list[str]) -> list[bytes]:
        """Packed ids of each text."""
        ids, ends = self.batch(pa.array(texts, pa.string()), b"")
        return [x.tobytes() for x in np.split(ids, ends[:-1])] if texts else []

    def batch(self, texts: pa.Array, last: bytes) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, `last` behind each, and where each ends among them.

        Arrow cuts the texts and numbers the pieces, so that only those that a batch has are
        strings here, once each; the ids of all are then gathered by number.
        """
        if not self.pieces:
            values = [self._alone(x, True) + last for x in texts.to_pylist()]
            ids = np.frombuffer(b"".join(values), self.kind)
            return ids, np.cumsum([len(x) // self.kind.itemsize for x in values], dtype=np.int64)
        edges, codes, names = numbered(texts)
        heads, n = edges[:-1], len(names)
        behind = np.ones(len(codes), bool)
        behind[heads] = False
        used = np.zeros(n, bool)
        used[codes[behind]] = True
        made, ends, odd = self._values(names, used)
        # A text with a piece that can't be cut off is looked at by itself, whole.
        whole = np.zeros(len(heads), bool)
        whole[np.searchsorted(edges, np.flatnonzero(behind & odd[codes]), "right") - 1] = True
        numbers, values = codes.astype(np.int64), [b""]
        firsts = names.take(pa.array(codes[heads])).to_pylist()
        for i, (head, first) in enumerate(zip(heads.tolist(), firsts, strict=True)):
            value = None if whole[i] else self.pieces.head(first)
            if value is None:
                value = b"".join(self.pieces.of([texts[i].as_py()])[0])
                numbers[edges[i] : edges[i + 1]] = n  # nothing
            numbers[head] = n + 1 + i
            values.append(value)
        values.append(last)
        numbers = np.insert(numbers, edges[1:], n + len(values) - 1)
        more, stops = joined(values, self.kind)
        ids, stops = chosen(np.concatenate([made, more]), np.concatenate([ends, stops + len(made)]), numbers)
        return ids, stops[edges[1:] + np.arange(len(heads))]

    def _values(self, names: pa.Array, used: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The ids of pieces that are used, nothing for others, where each ends; which can't be cut off."""
        at = np.flatnonzero(used)
        words = words_of(names.take(pa.array(at)))
        gc.disable()  # as in Pieces
        try:
            self.pieces.known.turn()
            marks = [self._marks(x) if x else b"" for x in words.marks.to_pylist()]
            of_words = self._words(words.words.to_pylist())
        finally:
            gc.enable()
        found, new = self.pieces.values(words.others)
        made, stops = put_together(words, of_words, marks, [found.get(x) or b"" for x in words.others], self.kind)
        lengths = np.zeros(len(names), np.int64)
        lengths[at] = np.diff(stops, prepend=0)
        odd = np.zeros(len(names), bool)
        if new:
            odd[at[~words.plain]] = [x in new for x in words.others]
        return made, np.cumsum(lengths), odd

    def _words(self, words: list[str]) -> list[bytes]:
        """The ids of words behind a space, or behind the line break in front of them."""
        found = self.pieces.known.all(words)
        tokenize, packed, line, new = self.model.tokenize, self._packed, self._marks("\n"), {}
        for word in [x for x, ids in found.items() if ids is None]:
            symbols = word if word.isascii() else word.encode().decode("latin-1").translate(_SYMBOLS)
            if word[0] != "\n":
                new[word] = packed([x.id for x in tokenize(_SPACE + symbols)])
            else:
                new[word] = line + packed([x.id for x in tokenize(symbols[1:])])
        self.pieces.known.add_all(new)
        found.update(new)
        return [*found.values()]


def can_be_cut(spec: dict) -> bool:
    """Whether pieces of a text can be encoded apart: byte-level words, nothing else that looks around."""
    words = spec["pre_tokenizer"] or {}
    plain = words.get("type") == "ByteLevel" and words.get("use_regex", True) and not words.get("add_prefix_space")
    added = all(
        not (x["lstrip"] or x["rstrip"] or x["single_word"]) and x["content"].split() == [x["content"]]
        for x in spec["added_tokens"]
    )
    return bool(plain and added and not spec["normalizer"] and not spec["truncation"] and not spec["padding"])


def byte_lengths(library) -> np.ndarray:
    """Bytes that each id of a byte-level vocabulary stands for."""
    vocabulary = library.get_vocab(with_added_tokens=False)
    out = np.zeros(max([0, *library.get_vocab().values()]) + 1, np.int64)
    for token, number in vocabulary.items():
        out[number] = len(token)
    for number, token in library.get_added_tokens_decoder().items():
        out[number] = len(token.content.encode())
    return out


@functools.cache
def encoder(path: str) -> Encoder:
    """One encoder per worker process and vocabulary file."""
    return Encoder(path)


def image_of(names: list[int | None], parts: list[bytes], kind: np.dtype) -> bytes:
    """A shard of documents in ascending order of their doc_ids, those without one first."""
    own = np.array([x for x in names if x is not None], np.int64)
    first = int(own[0]) if len(own) else 0
    offsets = (own.view(np.uint64) - np.uint64(first % (1 << 64))) if len(own) else own.view(np.uint64)
    codes = [encoded(offsets), encoded(np.cumsum([len(x) // kind.itemsize for x in parts]))]
    header = _HEADER.pack(MAGIC, VERSION, kind.itemsize, len(names), len(names) - len(own), first, *map(len, codes))
    return b"".join([header, *codes, *parts])


class Shard:
    """A shard in memory."""

    def __init__(self, image: bytes):
        magic, version, width, self.n_docs, self.n_nameless, self.first, names, ends = _HEADER.unpack_from(image)
        if magic != MAGIC or version != VERSION:
            raise ValueError("not a shard of token ids")
        at, image = _HEADER.size, memoryview(image)
        self._names = EliasFano(image[at : at + names])
        self.ends = EliasFano(image[at + names : at + names + ends])
        self.ids = np.frombuffer(image, f"<u{width}", offset=at + names + ends)

    def names(self) -> list[int | None]:
        """The doc_id of each document."""
        numbers = (self._names.all() + np.uint64(self.first % (1 << 64))).view(np.int64)
        return [None] * self.n_nameless + numbers.tolist()

    def document(self, i: int) -> np.ndarray:
        """The ids of the i-th document; two boundaries are looked up, no other is read."""
        return self.ids[self.ends[i - 1] if i else 0 : self.ends[i]]


_IDS = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("ids", pa.binary())])
_SHARDS = pa.schema([*((x, pa.int64()) for x in ("task", "nth", "at", "n_ids")), ("image", pa.binary())])
_SHARDS_DDL = "task long, nth long, at long, n_ids long, image binary"


def token_ids(docs: DataFrame, vocabulary: str, end: int | None) -> DataFrame:
    """(doc_id, n, ids) with the packed ids of every text, and the end id behind them."""
    text_batches(docs.sparkSession)

    def run(batches):
        encode = encoder(vocabulary)
        last = b"" if end is None else np.array([end], encode.kind).tobytes()
        for batch in together(batches, TOGETHER):
            ids, ends = encode.batch(pc.fill_null(batch.column("text"), ""), last)
            counts = np.diff(ends, prepend=0)
            raw = np.concatenate([[0], ends]) * encode.kind.itemsize
            packed = pa.Array.from_buffers(
                pa.large_binary(), len(ends), [None, pa.py_buffer(raw.astype(np.int64)), pa.py_buffer(ids.tobytes())]
            ).cast(pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(counts), packed], schema=_IDS)
        if encode.pieces:
            encode.pieces.known.rest()

    return pick(docs, doc_id="long", text="string").mapInArrow(run, "doc_id long, n long, ids binary")


def write(docs: DataFrame, vocabulary: str, path: str, end: int | None = 2) -> None:
    """Writes the ids of every text, with `end` behind each document, as a file set at `path`.

    NULL counts as the empty text; documents without a doc_id come first; of documents with
    the same doc_id each is written, in any order; a document is never split, so a very long
    one makes a shard by itself. An empty table gives an empty set; other columns are ignored.

    Ids are made in one pass over the texts and stored; only they are shuffled, by ranges of
    doc_id and, within one, of rows, so that a repeated doc_id is no burden to one task.
    """
    spark = docs.sparkSession
    made = stored(token_ids(docs, vocabulary, end), "ids")
    total = made.agg(F.sum("n")).first()[0] or 0
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(total / TASK_IDS))
    order = [F.asc_nulls_first("doc_id"), "row"]
    dealt = made.withColumn("row", F.monotonically_increasing_id()).repartitionByRange(tasks, *order)

    def shards(batches):
        encode, task = encoder(vocabulary), TaskContext.get().partitionId()
        kind = encode.kind
        if encode.pieces:  # all ids are made by now
            encode.pieces.known.forget()
        names, parts, size, nth, at = [], [], 0, 0, 0

        def shard():
            row = [[task], [nth], [at], [size], [image_of(names, parts, kind)]]
            return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(row, _SHARDS, strict=True)], schema=_SHARDS)

        for batch in batches:
            for name, n, ids in zip(*(batch.column(x).to_pylist() for x in ("doc_id", "n", "ids")), strict=True):
                if parts and (size + n > SHARD_IDS or len(parts) == SHARD_DOCS):
                    yield shard()
                    names, parts, size, nth, at = [], [], 0, nth + 1, at + size
                names.append(name)
                parts.append(ids)
                size += n
        if parts:
            yield shard()

    images = dealt.sortWithinPartitions(*order).select("doc_id", "n", "ids").mapInArrow(shards, _SHARDS_DDL)
    images.write.option("compression", "zstd").parquet(path)


def shards_of(spark: SparkSession, path: str) -> DataFrame:
    """(start, n_ids, image) of each shard at `path`; `start` counts the ids of all shards before it."""
    files = spark.read.schema(_SHARDS_DDL).parquet(path)
    # One row for each task that wrote, however many shards and documents there are.
    tasks = files.groupBy("task").agg(F.max(F.col("at") + F.col("n_ids")).alias("n"))
    before = F.sum("n").over(Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1))
    starts = tasks.select("task", F.coalesce(before, F.lit(0)).alias("before"))
    start = (F.col("before") + F.col("at")).alias("start")
    return files.join(F.broadcast(starts), "task").select(start, "n_ids", "image")


def read(spark: SparkSession, path: str, ids: bool = True) -> DataFrame:
    """Every document of a file set: doc_id, start, n_tokens, ids_crc32 and, if asked for, ids.

    `start` counts the ids of all documents before it; ids_crc32 is the unsigned CRC-32 of
    the ids as little-endian unsigned 32-bit numbers.
    """
    names = ["doc_id", "start", "n_tokens", "ids_crc32"]
    schema = pa.schema([(x, pa.int64()) for x in names] + [("ids", pa.list_(pa.int64()))] * ids)

    def run(batches):
        for batch in batches:
            for start, image in zip(batch.column("start").to_pylist(), batch.column("image").to_pylist(), strict=True):
                shard = Shard(image)
                ends = shard.ends.all().astype(np.int64)
                starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
                edges = list(zip(starts.tolist(), ends.tolist(), strict=True))
                crc = [zlib.crc32(shard.ids[i:j].astype("<u4")) for i, j in edges]
                columns = [shard.names(), start + starts, ends - starts, crc]
                if ids:
                    columns.append([shard.ids[i:j] for i, j in edges])
                arrays = [pa.array(x, f.type) for x, f in zip(columns, schema, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    kinds = ", ".join(f"{x} long" for x in names) + (", ids array<long>" if ids else "")
    return shards_of(spark, path).select("start", "image").mapInArrow(run, kinds)
