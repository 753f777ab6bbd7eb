"""A counting quotient filter over packed keys, lossless and mergeable.

A key is one limb of ``bits`` bits or three limbs of 64. It is permuted by a
bijection, its leading bits are the quotient, all others the remainder, and the
remainder is kept whole, so counts are exact and keys can be read back. Entries
stand in order of (quotient, remainder); written out, a filter holds one run
length per quotient, the remainders, and one byte per count that is small.
Filters of one kind merge as sorted lists.
"""

from __future__ import annotations

import struct
from collections.abc import Iterable

import numpy as np

U = np.uint64
# Multipliers of the permutation.
ODD = (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9)
WIDE = 64  # bits of a limb of keys that need three


def _mixed(x: np.ndarray) -> np.ndarray:
    for m in ODD:
        x = (x ^ (x >> U(31))) * U(m)
    return x ^ (x >> U(29))


def _turn(keys: np.ndarray, bits: int, back: bool) -> np.ndarray:
    """The bijection or its inverse, on keys of shape (n, limbs)."""
    if keys.shape[1] == 1:
        mask, half, x = U((1 << bits) - 1), U(bits - bits // 2), keys[:, 0]
        for m in reversed(ODD) if back else ODD:
            if back:
                x = ((x ^ (x >> half)) * U(pow(m, -1, 1 << bits))) & mask
            else:
                x = (x * U(m & ((1 << bits) - 1))) & mask
                x ^= x >> half
        return x[:, None]
    x = keys.copy()
    steps = ((0, 1), (1, 2), (2, 0), (0, 1), (0, 2))
    for i, j in reversed(steps) if back else steps:
        x[:, i] ^= _mixed(x[:, j])
    return x


def _small(values: np.ndarray) -> bytes:
    """One byte a value; 255 stands for the next of the eight-byte values that follow."""
    large = values[values >= 255].astype("<u8")
    return struct.pack("<QQ", len(values), len(large)) + np.minimum(values, 255).astype(np.uint8).tobytes() + large.tobytes()


def _read_small(blob: memoryview, at: int) -> tuple[np.ndarray, int]:
    n, large = struct.unpack_from("<QQ", blob, at)
    values = np.frombuffer(blob, np.uint8, n, at + 16).astype(np.int64)
    values[values == 255] = np.frombuffer(blob, "<u8", large, at + 16 + n).astype(np.int64)
    return values, at + 16 + n + 8 * large


class QuotientFilter:
    """Counts of keys; ``rows`` are permuted keys in order, ``counts`` theirs."""

    def __init__(self, bits: int, rows: np.ndarray, counts: np.ndarray):
        self.bits, self.rows, self.counts = bits, rows, counts

    @classmethod
    def of(cls, bits: int, keys: np.ndarray) -> QuotientFilter:
        """The filter of keys of shape (n, limbs), each counted once."""
        return cls._summed(bits, _turn(keys, bits, False), None)

    @classmethod
    def merged(cls, bits: int, filters: Iterable[QuotientFilter], limbs: int) -> QuotientFilter:
        held = list(filters)
        if not held:
            return cls(bits, np.empty((0, limbs), U), np.empty(0, np.int64))
        return cls._summed(bits, np.concatenate([f.rows for f in held]), np.concatenate([f.counts for f in held]))

    @classmethod
    def _summed(cls, bits: int, rows: np.ndarray, counts: np.ndarray | None) -> QuotientFilter:
        if counts is None and rows.shape[1] == 1:
            rows = np.sort(rows, axis=0)
        else:  # a stable sort merges what is sorted already
            order = np.argsort(rows[:, 0], kind="stable") if rows.shape[1] == 1 else np.lexsort(rows.T[::-1])
            rows, counts = rows[order], None if counts is None else counts[order]
        first = np.flatnonzero(np.r_[True, (rows[1:] != rows[:-1]).any(axis=1)]) if len(rows) else np.empty(0, np.int64)
        summed = np.diff(np.r_[first, len(rows)]) if counts is None else np.add.reduceat(counts, first) if len(rows) else counts
        return cls(bits, rows[first], summed)

    def __len__(self) -> int:
        return len(self.rows)

    def at_least(self, least: int) -> tuple[np.ndarray, np.ndarray]:
        """(keys, counts) of the keys counted ``least`` times or more."""
        kept = self.counts >= least
        return _turn(self.rows[kept], self.bits, True), self.counts[kept]

    def parts(self, n_bits: int) -> Iterable[tuple[int, QuotientFilter]]:
        """The filter in pieces by the first ``n_bits`` bits of the quotient."""
        part = self.rows[:, 0] >> U(self.bits - n_bits)
        starts = np.flatnonzero(np.r_[True, part[1:] != part[:-1]]) if len(part) else []
        for a, b in zip(starts, [*starts[1:], len(part)]):
            yield int(part[a]), QuotientFilter(self.bits, self.rows[a:b], self.counts[a:b])

    def to_bytes(self) -> bytes:
        """Quotients of about one entry each within the span from the least to the greatest key."""
        lead = self.rows[:, 0]
        low = int(lead[0]) if len(lead) else 0
        span = (int(lead[-1]) - low if len(lead) else 0).bit_length()
        left = max(0, span - max(1, len(lead)).bit_length())  # bits of the remainder in the first limb
        moved = lead - U(low)
        runs = np.bincount((moved >> U(left)).astype(np.int64)) if len(lead) else np.empty(0, np.int64)
        width = -(-left // 8)
        rest = (moved & U((1 << left) - 1)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]
        head = struct.pack("<QQQ", low, left, self.rows.shape[1])
        return head + _small(runs) + _small(self.counts) + rest.tobytes() + self.rows[:, 1:].astype("<u8").tobytes()

    @classmethod
    def from_bytes(cls, bits: int, blob: bytes) -> QuotientFilter:
        view = memoryview(blob)
        low, left, limbs = struct.unpack_from("<QQQ", view)
        runs, at = _read_small(view, 24)
        counts, at = _read_small(view, at)
        n, width = len(counts), -(-left // 8)
        rest = np.zeros((n, 8), np.uint8)
        rest[:, :width] = np.frombuffer(view, np.uint8, n * width, at).reshape(n, width)
        rows = np.empty((n, limbs), U)
        rows[:, 0] = (np.repeat(np.arange(len(runs), dtype=U), runs) << U(left)) + rest.view("<u8")[:, 0] + U(low)
        rows[:, 1:] = np.frombuffer(view, "<u8", n * (limbs - 1), at + n * width).reshape(n, limbs - 1)
        return cls(bits, rows, counts)
