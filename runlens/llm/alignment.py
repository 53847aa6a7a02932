"""Alignment of two tokenizers over the same texts.

Tokens end where the bytes that they decode to do: offsets that the libraries give are
coarse where bytes of one character went to several tokens. What comes out are the ends
of both tokenizers' tokens as byte offsets. Offsets where both end cut the tokens into
groups; between any two neighbouring ends lies exactly one pair of overlapping tokens, a
link.

A text is taken with a space in front, as the piece tokenizer does by itself. A text
whose tokens do not decode to it has none.
"""

from __future__ import annotations

import functools
import hashlib
import json
import os
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runlens.llm.chunks import Pieces
from runlens.llm.shared import pick, stored, text_batches, texts_of
from runlens.llm.token_files import can_be_cut
from runlens.llm.tokens import byte_symbols

# Links of a block of documents, unless one document has more.
BLOCK = 1 << 22
# Characters in the pieces that one generation of a worker's table holds.
KEPT = 2_400_000

# What stands in front of pieces that are aligned together.
_BEFORE = " x"


class Cuts(NamedTuple):
    """Ids of both tokenizers' tokens and the byte offsets of their ends."""

    a: np.ndarray
    a_ends: np.ndarray
    b: np.ndarray
    b_ends: np.ndarray


class Piece(NamedTuple):
    """What a piece of text adds to its document; links are packed pairs of ids."""

    n_a: int
    n_b: int
    n_groups: int
    links: bytes
    groups: str


class Aligner:
    """Aligns a byte-level vocabulary (A) and a vocabulary of pieces with byte fallback (B)."""

    def __init__(self, a_path: str, b_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        number = {c: i for i, c in enumerate(byte_symbols())}
        self.a_bytes = {i: bytes(map(number.__getitem__, t)) for t, i in self.a.get_vocab(with_added_tokens=False).items() if set(t) <= number.keys()}
        self.b = SentencePieceProcessor(model_file=b_path)
        size = self.b.get_piece_size()
        names = [self.b.id_to_piece(i) for i in range(size)]
        self.b_bytes = [
            bytes([int(x[3:5], 16)]) if self.b.is_byte(i) else x.replace("▁", " ").encode() for i, x in enumerate(names)
        ]
        self.shift = (size - 1).bit_length()
        wide = max(self.a_bytes).bit_length() + self.shift
        self.kind = np.dtype("<u4" if wide <= 32 else "<u8")
        self.a_lengths = np.zeros(max(self.a_bytes) + 1, np.int64)
        for i, x in self.a_bytes.items():
            self.a_lengths[i] = len(x)
        self.b_lengths = np.array([len(x) for x in self.b_bytes], np.int64)
        # Ids as groups have them: what stands behind an id of A and of B, and behind the last of a group.
        of_a = [f"{i}{x}" for i in range(len(self.a_lengths)) for x in ",|"]
        self.names, self.first_b = [*of_a, *(f"{i}{x}" for i in range(size) for x in ",;")], len(of_a)
        with open(a_path, encoding="utf-8") as file:
            cut = can_be_cut(json.load(file)) and _words_stand_alone(self.b, names)
        self.pieces = Pieces(self._together, self._alone, spaced=True, kept=KEPT) if cut else None

    def cuts(self, text: str) -> Cuts | None:
        """Tokens of a text that begins with a space."""
        raw = text.encode()
        (made,) = self.a.encode_batch_fast([text], add_special_tokens=False)
        a, b = made.ids, self.b.encode(text[1:])
        if b"".join([self.a_bytes.get(i, b"") for i in a]) != raw or b"".join(map(self.b_bytes.__getitem__, b)) != raw:
            return None
        a, b = np.array(a, np.int64), np.array(b, np.int64)
        return Cuts(a, np.cumsum(self.a_lengths[a]), b, np.cumsum(self.b_lengths[b]))

    def values(self, cuts: Cuts, ends: np.ndarray) -> list[Piece] | None:
        """The pieces that end at these byte offsets; None if some token crosses one."""
        a, a_ends, b, b_ends = cuts
        both = a_ends[np.isin(a_ends, b_ends, assume_unique=True)]
        if not np.isin(ends, both).all():
            return None
        every = np.union1d(a_ends, b_ends)
        links = a[np.searchsorted(a_ends, every)] << self.shift | b[np.searchsorted(b_ends, every)]
        links, wide = links.astype(self.kind).tobytes(), self.kind.itemsize
        names = self._named(a, np.searchsorted(a_ends, both, "right"), b, np.searchsorted(b_ends, both, "right"))
        edges = [np.searchsorted(x, ends, "right").tolist() for x in (a_ends, b_ends, both, every)]
        out, last = [], (0, 0, 0, 0)
        for now in zip(*edges, strict=True):
            n_a, n_b, n_groups = (y - x for x, y in zip(last[:3], now, strict=False))
            some = links[last[3] * wide : now[3] * wide]
            out.append(Piece(n_a, n_b, n_groups, some, "".join(names[last[0] + last[1] : now[0] + now[1]])[:-1]))
            last = now
        return out

    def _named(self, a: np.ndarray, of_a: np.ndarray, b: np.ndarray, of_b: np.ndarray) -> list[str]:
        """Ids with what stands behind each, by group those of A and then those of B; of_a, of_b: where groups end."""
        last_a, last_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        last_a[of_a - 1] = last_b[of_b - 1] = 1
        n_a, n_b = np.diff(of_a, prepend=0), np.diff(of_b, prepend=0)
        out = np.empty(len(a) + len(b), np.int64)
        out[np.arange(len(a)) + np.repeat(of_b - n_b, n_a)] = 2 * a + last_a
        out[np.arange(len(b)) + np.repeat(of_a, n_b)] = self.first_b + 2 * b + last_b
        return [*map(self.names.__getitem__, out.tolist())]

    def _behind(self, pieces: list[str]) -> list[Piece] | None:
        """Pieces aligned as one text, behind a word of their own."""
        cuts = self.cuts(_BEFORE + "".join(pieces))
        if cuts is None:
            return None
        ends = len(_BEFORE) + np.cumsum([0, *(len(x.encode()) for x in pieces)])
        made = self.values(cuts, ends)
        return made and made[1:]

    def _together(self, pieces: list[str]) -> list[Piece | tuple]:
        return self._behind(pieces) or [self._alone(x, False) for x in pieces]

    def _alone(self, piece: str, _: bool) -> Piece | tuple:
        """The piece, or () if its tokens don't decode to it."""
        if piece[0] != " ":
            made = self._behind([piece])
            return made[0] if made else ()
        cuts = self.cuts(piece)
        return self.values(cuts, cuts.a_ends[-1:])[0] if cuts else ()

    def of(self, texts: list[str]) -> list[list[Piece] | None]:
        """The pieces of each text, or None for one without tokens."""
        if self.pieces:
            found = self.pieces.of(texts)
        else:
            found = [[self._alone(" " + x, True)] for x in texts]
        return [parts if text and all(parts) else None for text, parts in zip(texts, found, strict=True)]


def _words_stand_alone(pieces, names: list[str]) -> bool:
    """Whether no piece reaches over the beginning of a word or a line, and texts are taken as they are."""
    from sentencepiece import sentencepiece_model_pb2

    spec = sentencepiece_model_pb2.ModelProto.FromString(pieces.serialized_model_proto())
    rules, kinds = spec.normalizer_spec, type(spec).SentencePiece
    return bool(
        spec.trainer_spec.model_type == spec.trainer_spec.BPE
        and (rules.name == "identity" or not rules.precompiled_charsmap)
        and rules.add_dummy_prefix
        and rules.escape_whitespaces
        and not rules.remove_extra_whitespaces
        and not any(x.type == kinds.USER_DEFINED for x in spec.pieces)
        and not any("▁" in x.lstrip("▁") or "\n" in x or " " in x for x in names)
    )


@functools.cache
def aligner(a_path: str, b_path: str) -> Aligner:
    """One aligner per worker process and pair of vocabulary files."""
    return Aligner(a_path, b_path)


_COUNTS = ["doc_id", "n_a", "n_b", "n_groups", "n_links"]
_MADE = pa.schema(
    [(x, pa.int64()) for x in [*_COUNTS, "block"]] + [("groups_sha256", pa.string()), ("links", pa.binary())]
)
_MADE_DDL = ", ".join(f"{x} long" for x in [*_COUNTS, "block"]) + ", groups_sha256 string, links binary"


def links_of(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """One row per document: its counts, the SHA-256 of its groups, its links (packed, ascending), its block."""
    text_batches(docs.sparkSession)

    def run(batches):
        align, task = aligner(a_path, b_path), TaskContext.get().partitionId()
        block, size = task << 32, 0
        for batch in batches:
            rows = []
            for name, parts in zip(batch.column("doc_id").to_pylist(), align.of(texts_of(batch)), strict=True):
                if parts is None:
                    rows.append((name, 0, 0, 0, 0, block, "", b""))
                    continue
                n_a, n_b, n_groups, links, groups = zip(*parts, strict=True)
                links = np.sort(np.frombuffer(b"".join(links), align.kind))
                if size and size + len(links) > BLOCK:
                    block, size = block + 1, 0
                size += len(links)
                digest = hashlib.sha256(";".join(groups).encode()).hexdigest()
                rows.append((name, sum(n_a), sum(n_b), sum(n_groups), len(links), block, digest, links.tobytes()))
            columns = list(zip(*rows, strict=True)) or [()] * len(_MADE)
            arrays = [pa.array(c, f.type) for c, f in zip(columns, _MADE, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, schema=_MADE)

    return pick(docs, doc_id="long", text="string").mapInArrow(run, _MADE_DDL)


def align(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Alignment of every text and how usual its links are.

    One row per row: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.
    A pair's count is the number of documents in which it is linked; n_best counts the links
    whose pair has the highest count of all pairs of its A id, count_sum adds up the counts
    of all links. A text that is NULL, empty, or not what its tokens decode to has no tokens:
    zeros and ''. Rows with the same or no doc_id are documents of their own; very long texts
    are aligned whole; an empty table gives none; other columns are ignored.

    Documents are dealt to blocks with a bounded number of links. A block asks once for each
    pair that it holds, so what is shuffled by pair is blocks times distinct pairs, and a
    pair has a row for each block at most.
    """
    first = aligner(a_path, b_path)
    kind, shift = first.kind, first.shift
    made = stored(links_of(docs, a_path, b_path), "links")
    asked = pa.schema([("block", pa.int64()), ("pair", pa.int64()), ("n", pa.int64())])

    def ask(batches):
        """For each block, the pairs that it holds and the number of documents that do."""
        held, now, size = [], None, 0

        def given():
            pairs, n = np.unique(np.concatenate(held), return_counts=True)
            columns = [np.full(len(pairs), now), pairs.astype(np.int64), n]
            return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in columns], schema=asked)

        for batch in batches:
            for block, raw in zip(batch.column("block").to_pylist(), batch.column("links").to_pylist(), strict=True):
                if held and (block != now or size > BLOCK):
                    yield given()
                    held, size = [], 0
                now = block
                links = np.frombuffer(raw, kind)
                if len(links):
                    held.append(links[np.concatenate([[True], links[1:] != links[:-1]])])
                    size += len(held[-1])
        if held:
            yield given()

    asks = stored(made.select("block", "links").mapInArrow(ask, "block long, pair long, n long"), "asked")
    counts = stored(asks.groupBy("pair").agg(F.sum("n").alias("count")), "counts", narrow=True)
    of_a = F.shiftright("pair", shift)
    # A row for each id of A's vocabulary at most.
    highest = counts.groupBy(of_a.alias("a")).agg(F.max("count").alias("highest"))
    judged = counts.join(F.broadcast(highest), of_a == F.col("a")).select(
        "pair", "count", (F.col("count") == F.col("highest")).cast("long").alias("best")
    )
    answers = asks.select("block", "pair").join(judged, "pair")
    names = [*_COUNTS, "n_best", "count_sum"]
    out = pa.schema([(x, pa.int64()) for x in names] + [("groups_sha256", pa.string())])

    def add_up(left: pa.Table, right: pa.Table) -> pa.Table:
        pairs, at = np.unique(right.column("pair").to_numpy(), return_index=True)
        count, best = right.column("count").to_numpy()[at], right.column("best").to_numpy()[at]
        sums = []
        for raw in left.column("links").to_pylist():
            place = np.searchsorted(pairs, np.frombuffer(raw, kind).astype(np.int64))
            sums.append((int(best[place].sum()), int(count[place].sum())))
        n_best, count_sum = zip(*sums, strict=True) if sums else ((), ())
        columns = [left.column(x) for x in _COUNTS] + [pa.array(x, pa.int64()) for x in (n_best, count_sum)]
        return pa.table([*columns, left.column("groups_sha256")], schema=out)

    kinds = ", ".join(f"{x} long" for x in names) + ", groups_sha256 string"
    return made.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(add_up, kinds)


def groups(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """The groups themselves: doc_id, group, start, end (byte offsets in space + text), a_ids, b_ids."""
    text_batches(docs.sparkSession)
    schema = pa.schema(
        [(x, pa.int64()) for x in ("doc_id", "group", "start", "end")]
        + [(x, pa.list_(pa.int64())) for x in ("a_ids", "b_ids")]
    )

    def run(batches):
        made = aligner(a_path, b_path)
        for batch in batches:
            for name, text in zip(batch.column("doc_id").to_pylist(), texts_of(batch), strict=True):
                cuts = made.cuts(" " + text) if text else None
                if cuts is None:
                    continue
                both = cuts.a_ends[np.isin(cuts.a_ends, cuts.b_ends, assume_unique=True)]
                of_a, of_b = (np.searchsorted(x, both, "right")[:-1] for x in (cuts.a_ends, cuts.b_ends))
                columns = [
                    np.full(len(both), name) if name is not None else [None] * len(both),
                    np.arange(len(both)),
                    np.concatenate([[0], both[:-1]]),
                    both,
                    np.split(cuts.a, of_a),
                    np.split(cuts.b, of_b),
                ]
                arrays = [pa.array(x, f.type) for x, f in zip(columns, schema, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    kinds = "doc_id long, group long, start long, end long, a_ids array<long>, b_ids array<long>"
    return pick(docs, doc_id="long", text="string").mapInArrow(run, kinds.replace("end long", "`end` long"))
