"""Hashes of words and word windows for many texts at once, in numpy.

A word's hash is a polynomial over its bytes modulo 2^64, finished with a mixer; a
window's is a polynomial over its words' hashes. Both are computed for a whole buffer
of texts with array operations. Two different words or windows agree with a chance
of about 2^-64.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np

from runlens.llm.shared import runs_of

# Bytes of text hashed at once; longer texts are hashed alone and whole.
BUFFER = 1 << 18

_BASE = 0x9E3779B97F4A7C15


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


_BYTE = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BREAK = np.zeros(256, bool)
_BREAK[[32, *range(9, 14)]] = True


class _Powers:
    """Powers of the base and of its inverse modulo 2^64, as far as needed so far."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def grow(self, n: int) -> None:
        if len(self.up) >= n:
            return
        n = 1 << (n - 1).bit_length()
        inverse = pow(_BASE, -1, 1 << 64)
        for name, base in (("up", _BASE), ("down", inverse)):
            made = np.full(n, base, np.uint64)
            made[0] = 1
            setattr(self, name, np.multiply.accumulate(made))


_powers = _Powers()


def word_hashes(texts: list[bytes], lower: bool = True) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first text, hashes of all words, first word of each text and the end) by buffer.

    Words are what stands between white space (space and bytes 9 to 13); A to Z are
    lower-cased unless told otherwise.
    """
    for part in runs_of([len(x) + 1 for x in texts], BUFFER):
        some = texts[part]
        raw = np.frombuffer(b" ".join([b"", *some, b""]), np.uint8)
        if lower:
            raw = _LOWER[raw]
        gap = _BREAK[raw]
        starts = np.flatnonzero(~gap[1:] & gap[:-1]) + 1
        lengths = np.fromiter(map(len, some), np.int64, len(some))
        edges = np.concatenate([[0], np.cumsum(lengths + 1)])
        first = np.searchsorted(starts, edges)
        if len(starts):
            _powers.grow(len(raw))
            values = _BYTE[raw]
            values *= _powers.up[: len(raw)]
            values[gap] = 0
            hashes = mixed(np.add.reduceat(values, starts) * _powers.down[starts])
        else:
            hashes = np.zeros(0, np.uint64)
        yield part.start, hashes, first


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of each window of `size` words; a shorter sequence is one window of its own kind."""
    if not len(hashes):
        return hashes
    n = min(size, len(hashes))
    total = np.full(len(hashes) - n + 1, n, np.uint64)
    for i in range(n):
        total *= np.uint64(_BASE)
        total += hashes[i : len(hashes) - n + 1 + i]
    return mixed(total)


# Kinds of characters.
LETTER, DIGIT, MARK, GAP = 1, 2, 3, 0

_tables: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []


def _characters() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Kind, lower case and 64-bit value of each character of the basic plane; others are letters."""
    if not _tables:
        kinds = np.full(0x10001, LETTER, np.uint8)
        lower = np.arange(0x10001, dtype=np.uint32)
        for i in range(0x10000):
            c = chr(i)
            if c.isspace():
                kinds[i] = GAP
            elif c.isdecimal():
                kinds[i] = DIGIT
            elif not c.isalpha() and unicodedata.category(c)[0] != "M":
                kinds[i] = MARK
            if len(c.lower()) == 1:
                lower[i] = ord(c.lower())
        _tables.append((kinds, lower, mixed(np.arange(1, 0x10002, dtype=np.uint64) * np.uint64(_BASE))))
    return _tables[0]


def is_capital(points: np.ndarray) -> np.ndarray:
    return _characters()[1][points] != points


class Tokens(NamedTuple):
    """Tokens of a buffer of texts: runs of letters, of digits, or of other marks.

    `first` has the first token of each text and the end; `text` is the buffer that
    `starts` and `ends` point into.
    """

    text: str
    starts: np.ndarray
    ends: np.ndarray
    kinds: np.ndarray
    hashes: np.ndarray
    first: np.ndarray
    points: np.ndarray


def tokens_of(texts: list[str], lower: bool) -> Iterator[tuple[int, Tokens]]:
    """(first text, its tokens and those of its neighbours) by buffer.

    A point or comma between two digits belongs to the number.
    """
    kind_of, lower_of, value_of = _characters()
    for part in runs_of([len(x) + 1 for x in texts], BUFFER):
        some = texts[part]
        text = "\n".join(["", *some, ""])
        points = np.minimum(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4"), 0x10000)
        kinds = kind_of[points]
        inside = np.zeros(len(points), bool)
        digit = kinds == DIGIT
        inside[1:-1] = digit[:-2] & digit[2:] & ((points[1:-1] == 44) | (points[1:-1] == 46))
        kinds[inside] = DIGIT
        starts = np.flatnonzero((kinds[1:] != kinds[:-1]) & (kinds[1:] != GAP)) + 1
        ends = np.flatnonzero((kinds[1:] != kinds[:-1]) & (kinds[:-1] != GAP)) + 1
        lengths = np.fromiter(map(len, some), np.int64, len(some))
        edges = np.concatenate([[1], 1 + np.cumsum(lengths + 1)])
        first = np.searchsorted(starts, edges)
        if len(starts):
            _powers.grow(len(points))
            values = value_of[lower_of[points] if lower else points] * _powers.up[: len(points)]
            values[kinds == GAP] = 0
            hashes = mixed(np.add.reduceat(values, starts) * _powers.down[starts])
        else:
            hashes = np.zeros(0, np.uint64)
        yield part.start, Tokens(text, starts, ends, kinds[starts], hashes, first, points)
