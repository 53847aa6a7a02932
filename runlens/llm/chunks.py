"""Texts cut where no token crosses, and what is known of the pieces, in a table of bounded size.

A byte-level vocabulary takes one space along with the word behind it, and none of
its rules looks past a word that ends there; a vocabulary that marks words with a
space does alike. So a text can be cut before a single space or line break that
stands between two other characters, and the pieces be encoded apart from each other,
or next to any others that are cut in the same way. Pieces repeat, so what is made of
each is kept.
"""

from __future__ import annotations

import ctypes
import gc
import re
import weakref
from collections.abc import Callable, Iterable, Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Characters in the pieces that one generation of a table holds, unless said otherwise.
KEPT = 5_000_000
# Characters of new pieces that are put together for one call.
TOGETHER = 1 << 14

_CUT = re.compile(r"(?<=\S)(?=[ \n]\S)")

# Letters whose lower case is one letter, in Arrow as in Python; ASCII marks but for the apostrophe, which may
# begin a token of letters.
LETTERS = "[A-Za-zÀ-ÖØ-öø-\u012f\u0131-\u0239\u023b-\u023d\u023f-\u02af]+"
MARKS = r"[!-&(-/:-@\[-`{-~]"
_TRIMMED = "".join(x for x in map(chr, range(128)) if re.fullmatch(MARKS, x))

# Marks of keys that aren't pieces behind a space; no text holds these characters.
_HEAD, _WHOLE = "\ud800", "\ud801"


def together(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Neighbouring batches as one, up to so many bytes: the more texts, the fewer pieces are new in each."""
    held, size = [], 0
    for batch in batches:
        if held and size + batch.nbytes > most:
            whole = pa.concat_batches(held)
            held, size = [], 0
            yield whole
        held.append(batch)
        size += batch.nbytes
    if held:
        whole = pa.concat_batches(held)
        held.clear()
        yield whole


def numbered(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Where the pieces of each text between spaces begin and end, the number of each, and the pieces.

    A line break begins a piece of its own. Nothing is made a Python string here.
    """
    parts = pc.split_pattern(pc.replace_substring(texts, "\n", " \n"), " ")
    pieces = parts.flatten().dictionary_encode()
    return parts.offsets.to_numpy().astype(np.int64), pieces.indices.to_numpy(), pieces.dictionary


class Words(NamedTuple):
    """Pieces of a word and marks, `plain` ones: the distinct words and marks, and the numbers of those of each piece."""

    plain: np.ndarray
    words: pa.Array
    word: np.ndarray
    marks: pa.Array
    mark: np.ndarray
    others: list[str]


def words_of(pieces: pa.Array, lower: bool = False) -> Words:
    """Tells words, with the line break in front unless lower-cased, and the marks behind them from other pieces."""
    plain = pc.match_substring_regex(pieces, f"^\n?{LETTERS}{MARKS}*$")
    some = pieces.filter(plain)
    words = pc.utf8_rtrim(some, _TRIMMED)
    if lower:
        words = pc.utf8_lower(pc.utf8_ltrim(words, "\n"))
    words = words.dictionary_encode()
    marks = pc.replace_substring_regex(some, f"^\n?{LETTERS}", "").dictionary_encode()
    others = pieces.filter(pc.invert(plain)).to_pylist()
    plain = plain.to_numpy(zero_copy_only=False)
    return Words(plain, words.dictionary, words.indices.to_numpy(), marks.dictionary, marks.indices.to_numpy(), others)


def joined(values: list[bytes], kind: np.dtype) -> tuple[np.ndarray, np.ndarray]:
    """The packed numbers of all values one after another, and where each value ends."""
    lengths = np.fromiter(map(len, values), np.int64, len(values)) // kind.itemsize
    return np.frombuffer(b"".join(values), kind), np.cumsum(lengths)


def put_together(words: Words, of_words: list[bytes], of_marks: list[bytes], of_others: list[bytes], kind: np.dtype):
    """The numbers of all pieces as `joined` gives them: those of a piece's word, then of its marks."""
    halves = np.full((len(words.plain), 2), len(of_words) + len(of_marks) + len(of_others))  # nothing
    halves[words.plain, 0] = words.word
    halves[words.plain, 1] = words.mark + len(of_words)
    halves[~words.plain, 0] = np.arange(len(of_others)) + len(of_words) + len(of_marks)
    found, stops = gathered([*of_words, *of_marks, *of_others, b""], halves.ravel(), kind)
    return found, stops[1::2]


def gathered(values: list[bytes], numbers: np.ndarray, kind: np.dtype) -> tuple[np.ndarray, np.ndarray]:
    """The packed numbers of `values`, those that `numbers` names one after another, and where each ends."""
    return chosen(*joined(values, kind), numbers)


def chosen(found: np.ndarray, ends: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same of numbers that are joined already."""
    lengths = np.diff(ends, prepend=0)
    few = np.int32 if len(found) < 1 << 31 else np.int64
    starts = (ends - lengths).astype(few)
    sizes = lengths.astype(few)[numbers]
    stops = np.cumsum(sizes, dtype=np.int64)
    n = int(stops[-1]) if len(stops) else 0
    wide = few if n < 1 << 31 else np.int64
    firsts = starts[numbers] - (stops - sizes).astype(wide)
    at = np.repeat(firsts, sizes)
    at += np.arange(n, dtype=wide)
    return found[at], stops


# The tables of this process.
_made: list[weakref.ref] = []


class Generations(dict):
    """A dict that forgets: what hasn't been looked up since the last turn but one is gone. No value is None."""

    def __init__(self, most: int):
        super().__init__()
        self.most, self.size, self.old = most, 0, {}
        _made.append(weakref.ref(self))

    def add(self, key: str, value) -> None:
        self[key] = value
        self.size += len(key)

    def add_all(self, found: dict) -> None:
        self.update(found)
        self.size += sum(map(len, found))

    def find(self, key: str):
        """The value, or None."""
        value = self.get(key)
        if value is None:
            value = self.old.get(key)
            if value is not None:
                self.add(key, value)
        return value

    def all(self, keys: Iterable[str]) -> dict:
        """Each key with its value, or None; keys are a list or a dict."""
        found = dict(zip(keys, map(self.get, keys), strict=True))
        if self.old:
            missing = [x for x, value in found.items() if value is None]
            values = map(self.old.get, missing)
            again = {x: value for x, value in zip(missing, values, strict=True) if value is not None}
            found.update(again)
            self.add_all(again)
        return found

    def rest(self) -> None:
        """Gives back what may not be needed again, as at the end of a task whose process goes on to another."""
        self.old = {}
        release()

    def forget(self) -> None:
        """Gives back everything, as where a process goes on to tasks that look nothing up."""
        self.clear()
        self.size = 0
        self.rest()

    def turn(self) -> None:
        if self.size > self.most:
            self.old, self.size = dict(self), 0
            self.clear()


def give_back() -> None:
    """Gives back all tables of this process, for tasks that look nothing up and follow others that did."""
    for table in [x() for x in _made]:
        if table is not None and (table or table.old):
            table.forget()


def release() -> None:
    """Gives memory that is free to the system, not only to this process."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def _is_regular(piece: str) -> bool:
    """Whether a piece between spaces is one that the text can be cut around."""
    body = piece[1:] if piece[:1] == "\n" else piece
    return bool(body) and not body[0].isspace() and not body[-1].isspace()


class Pieces:
    """Values of the pieces of texts, none of which is None.

    `together` gives the values of many pieces, each with the space or line break in
    front of it, that may be encoded as one text; `alone` the value of a piece that has
    to be encoded by itself, and whether it is the start of its text. With `spaced`,
    texts are taken to begin with a space.
    """

    def __init__(
        self,
        together: Callable[[list[str]], Iterable],
        alone: Callable[[str, bool], object],
        spaced: bool,
        kept: int | None = None,
    ):
        self.together, self.alone, self.spaced = together, alone, spaced
        self.known = Generations(kept or KEPT)

    def _cut(self, text: str) -> list[str]:
        """Keys of the pieces, if the text is one that can be cut at every space and line break."""
        parts = text.replace("\n", " \n").split(" ")
        if not self.spaced:
            parts[0] = _HEAD + parts[0]
        return parts

    def _cut_with_care(self, text: str) -> list[str]:
        out = []
        for nth, piece in enumerate(_CUT.split(" " + text if self.spaced else text)):
            if not nth and not self.spaced:
                out.append(_HEAD + piece)
            elif piece[0] == " " and _is_regular(piece[1:]) and piece[1] != "\n":
                out.append(piece[1:])
            elif piece[0] == "\n" and _is_regular(piece):
                out.append(piece)
            else:
                out.append(_WHOLE + piece)
        return out

    def _learn(self, keys: list[str]) -> None:
        some, size = [], 0

        def learn():
            pieces = [x if x[0] == "\n" else " " + x for x in some]
            self.known.add_all(dict(zip(some, self.together(pieces), strict=True)))

        for key in keys:
            if key[0] in (_HEAD, _WHOLE):
                self.known.add(key, self.alone(key[1:], key[0] == _HEAD))
                continue
            some.append(key)
            size += len(key) + 1
            if size > TOGETHER:
                learn()
                some, size = [], 0
        if some:
            learn()

    def of(self, texts: list[str]) -> list[list]:
        """The values of the pieces of each text, in their order."""
        # Nothing cyclic is made here, and the collector would go over all that is kept
        # again and again.
        gc.disable()
        try:
            return self._of(texts)
        finally:
            gc.enable()

    def values(self, pieces: list[str]) -> tuple[dict, set[str]]:
        """The values of pieces that stood behind a space, and those that no text can be cut around.

        A piece at the start of a line has the line break in front.
        """
        gc.disable()
        try:
            self.known.turn()
            own = self.known.all(pieces)
            new = [x for x, value in own.items() if value is None]
            odd = {x for x in new if not (x.isalnum() or _is_regular(x))}
            new = [x for x in new if x not in odd]
            self._learn(new)
            for key in new:
                own[key] = self.known[key]
            return own, odd
        finally:
            gc.enable()

    def head(self, piece: str):
        """The value of the piece that a text begins with, or None if the text can't be cut behind it."""
        if not _is_regular(piece) or piece[0] == "\n":
            return None
        value = self.known.find(_HEAD + piece)
        if value is None:
            value = self.alone(piece, True)
            self.known.add(_HEAD + piece, value)
        return value

    def _of(self, texts: list[str]) -> list[list]:
        self.known.turn()
        cut = [self._cut(x) for x in texts]
        # What the batch needs is looked up once in the large table, and then in one of its own.
        own, new = self._known(cut)
        odd = {x for x in new if not _is_regular(x.removeprefix(_HEAD))}
        if odd:
            cut = [parts if odd.isdisjoint(parts) else self._cut_with_care(x) for parts, x in zip(cut, texts, strict=True)]
            own, new = self._known(cut)
        self._learn(new)
        for key in new:
            own[key] = self.known[key]
        return [list(map(own.__getitem__, parts)) for parts in cut]

    def _known(self, cut: list[list[str]]) -> tuple[dict, list[str]]:
        """The values of all pieces, and those without one."""
        own = self.known.all(dict.fromkeys(chain.from_iterable(cut)))
        return own, [x for x, value in own.items() if value is None]
