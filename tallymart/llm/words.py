"""Words, lines and their hashes of many texts at once: numpy over the UTF-8 bytes.

A word is a run of bytes other than space and the five ASCII controls 9 to 13.  None of
these bytes occurs inside a longer UTF-8 sequence, so bytes and code points agree.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
BLANK = np.zeros(256, bool)
BLANK[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: A byte's value in the polynomial hash; drawn once from a fixed seed, so equal in every task.
BYTE_VALUE = np.random.default_rng(20240501).integers(1, 2**64, 256, dtype=np.uint64)
BASE = U(0x9E3779B97F4A7C15)
INVERSE = U(pow(int(BASE), -1, 2**64))

_powers: dict[U, np.ndarray] = {}


def powers(base: U, n: int) -> np.ndarray:
    kept = _powers.get(base)
    if kept is None or len(kept) < n:
        kept = np.full(max(n, 1 << 16), base, U)
        kept[0] = 1
        np.multiply.accumulate(kept, out=kept)
        if n <= 1 << 23:
            _powers[base] = kept
    return kept[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: every bit of the result hangs on every bit of ``x``."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


@dataclass
class Texts:
    """Bytes of a block of texts one after another; text i lies at start[i]:start[i + 1]. Null is empty."""

    data: np.ndarray
    start: np.ndarray

    @classmethod
    def of(cls, column: pa.Array) -> Texts:
        column = pc.fill_null(column.cast(pa.large_string()), "")
        offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
        held = column.buffers()[2]
        data = np.frombuffer(held, np.uint8)[offsets[0] : offsets[-1]] if held is not None and held.size else np.zeros(0, np.uint8)
        return cls(data, offsets - offsets[0])

    def __len__(self) -> int:
        return len(self.start) - 1

    def runs(self, inside: np.ndarray) -> Runs:
        """Maximal runs of True in ``inside``, none across texts."""
        before = np.zeros(len(inside), bool)
        before[1:] = inside[:-1]
        first = self.start[:-1][np.diff(self.start) > 0]
        before[first] = False
        begin = np.flatnonzero(inside & ~before)
        after = np.zeros(len(inside), bool)
        after[:-1] = inside[1:]
        after[first[1:] - 1] = False
        end = np.flatnonzero(inside & ~after) + 1
        return Runs(self, begin, end, np.searchsorted(self.start, begin, "right") - 1)

    def words(self) -> Runs:
        return self.runs(~BLANK[self.data])

    def lines(self) -> Runs:
        """Every line that holds a byte; empty lines have no run."""
        return self.runs(self.data != 10)

    def code_points(self) -> np.ndarray:
        """True at the first byte of every code point."""
        return (self.data & 0xC0) != 0x80


@dataclass
class Runs:
    texts: Texts
    begin: np.ndarray
    end: np.ndarray
    owner: np.ndarray

    def counts(self) -> np.ndarray:
        return np.bincount(self.owner, minlength=len(self.texts))

    def sums(self, flags: np.ndarray) -> np.ndarray:
        """For each run the sum of ``flags`` over its bytes."""
        total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
        return total[self.end] - total[self.begin]

    def hashes(self, lower: bool = False) -> np.ndarray:
        data = self.texts.data
        if not len(data) or not len(self.begin):
            return np.zeros(len(self.begin), U)
        total = np.zeros(len(data) + 1, U)
        np.cumsum(BYTE_VALUE[LOWER[data] if lower else data] * powers(BASE, len(data)), out=total[1:])
        raw = (total[self.end] - total[self.begin]) * powers(INVERSE, len(data))[self.begin]
        return mix(raw + (self.end - self.begin).astype(U))


def windows(hashes: np.ndarray, owner: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and position of the first word of every ``k`` following words of one text."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, U), np.zeros(0, np.int64)
    at = np.flatnonzero(owner[:n] == owner[k - 1 :])
    h = np.full(len(at), U(k), U)
    for j in range(k):
        h = mix(h * BASE + hashes[at + j])
    return h, at
