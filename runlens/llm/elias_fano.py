"""Elias-Fano coding of ascending numbers, with select.

Of n numbers up to u, the log2(u / n) low bits of each stand next to each other, and
the rest in unary: number i has the bit at (its high part) + i set. That makes
2 + log2(u / n) bits a number at most. The position of every 256th set bit is kept, from
which the i-th number is found by looking at a few words.

Layout, little-endian: n, low bits of a number, bytes of the low part, bytes of the
high part (64 bits each); low part; high part; positions (32 bits each). Parts are
filled up to multiples of 8 bytes. The high part has less than 2n bits, and may have 2^32.
"""

from __future__ import annotations

import struct

import numpy as np

SAMPLED = 256
_HEADER = struct.Struct("<4Q")


def _padded(bits: np.ndarray) -> bytes:
    raw = np.packbits(bits, bitorder="little").tobytes()
    return raw + b"\0" * (-len(raw) % 8)


def encoded(numbers: np.ndarray) -> bytes:
    """The code of numbers from 0 on (unsigned 64-bit) in ascending order, repeats allowed."""
    x = np.asarray(numbers, np.uint64)
    n = len(x)
    low = max(0, (int(x[-1]) // n).bit_length() - 1) if n else 0
    shifts = np.arange(low, dtype=np.uint64)
    lower = _padded(((x[:, None] >> shifts) & np.uint64(1)).astype(np.uint8).ravel())
    ones = (x >> np.uint64(low)).astype(np.int64) + np.arange(n)
    if n and ones[-1] >= 1 << 32:
        raise ValueError("too many numbers for one code")
    upper = np.zeros(int(ones[-1]) + 1 if n else 0, np.uint8)
    upper[ones] = 1
    upper = _padded(upper)
    return _HEADER.pack(n, low, len(lower), len(upper)) + lower + upper + ones[::SAMPLED].astype("<u4").tobytes()


class EliasFano:
    """Coded numbers in memory."""

    def __init__(self, code: bytes | memoryview):
        self.n, self.low, lower, upper = _HEADER.unpack_from(code)
        at = _HEADER.size
        self._lower = np.frombuffer(code, np.uint8, lower, at)
        self._upper = np.frombuffer(code, "<u8", upper // 8, at + lower)
        self._samples = np.frombuffer(code, "<u4", -(-self.n // SAMPLED), at + lower + upper)
        self.n_bytes = at + lower + upper + self._samples.nbytes

    def __len__(self) -> int:
        return self.n

    def __getitem__(self, i: int) -> int:
        """The i-th number: the place of the i-th set bit, found from the nearest one kept."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        at, left = int(self._samples[i // SAMPLED]), i % SAMPLED
        word = at // 64
        bits = int(self._upper[word]) >> (at % 64) << (at % 64)
        while (ones := bits.bit_count()) <= left:
            left -= ones
            word += 1
            bits = int(self._upper[word])
        for _ in range(left):
            bits &= bits - 1
        high = 64 * word + (bits & -bits).bit_length() - 1 - i
        first = i * self.low
        some = self._lower[first // 8 : (first + self.low + 7) // 8].tobytes()
        return high << self.low | int.from_bytes(some, "little") >> (first % 8) & ((1 << self.low) - 1)

    def all(self) -> np.ndarray:
        """All numbers."""
        ones = np.flatnonzero(np.unpackbits(self._upper.view(np.uint8), bitorder="little"))
        out = (ones - np.arange(self.n)).astype(np.uint64) << np.uint64(self.low)
        if self.low:
            bits = np.unpackbits(self._lower, count=self.n * self.low, bitorder="little").reshape(self.n, self.low)
            for i in range(self.low):
                out |= bits[:, i].astype(np.uint64) << np.uint64(i)
        return out
