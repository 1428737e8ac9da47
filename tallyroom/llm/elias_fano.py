"""Elias-Fano coded rising sequences of 64-bit numbers, searched in place."""

from __future__ import annotations

import numpy as np

U64 = np.uint64


def _pack(values: np.ndarray, bits: int) -> np.ndarray:
    """The low ``bits`` of each value, one after the other, and eight bytes to spare."""
    out = [np.zeros(0, dtype=np.uint8)]
    for lo in range(0, len(values), 1 << 16):  # a multiple of eight values: pieces end at a byte
        part = values[lo : lo + (1 << 16)]
        rows = ((part[:, None] >> np.arange(bits, dtype=U64)) & U64(1)).astype(np.uint8)
        out.append(np.packbits(rows.ravel(), bitorder="little"))
    return np.concatenate([*out, np.zeros(8, dtype=np.uint8)])


class EliasFano:
    """``n`` numbers in rising order below ``universe``: low bits packed, high parts in unary.

    ``low`` and ``high`` are flat byte arrays (slices of a file or buffer); a
    query reads only the places it needs, besides one directory of the gaps.
    """

    def __init__(self, n: int, bits: int, low: np.ndarray, high: np.ndarray):
        self.n, self.bits, self.low, self.high = n, bits, low, high
        # ends[h]: how many numbers have a high part of at most h
        zeros = np.flatnonzero(np.unpackbits(high, bitorder="little") == 0)
        self.ends = zeros - np.arange(len(zeros))

    @classmethod
    def encode(cls, values: np.ndarray, universe: int) -> EliasFano:
        n = len(values)
        bits = min(56, max(0, (universe // max(1, n)).bit_length() - 1))
        high = (values >> U64(bits)).astype(np.int64)
        flags = np.zeros(n + (universe >> bits) + 2, dtype=np.uint8)
        flags[high + np.arange(n)] = 1
        return cls(n, bits, _pack(values, bits) if bits else np.zeros(8, np.uint8), np.packbits(flags, bitorder="little"))

    def to_bytes(self) -> bytes:
        return np.array([self.n, self.bits, len(self.low)], dtype=np.int64).tobytes() + self.low.tobytes() + self.high.tobytes()

    @classmethod
    def from_bytes(cls, raw: bytes) -> EliasFano:
        n, bits, size = np.frombuffer(raw, dtype=np.int64, count=3)
        flat = np.frombuffer(raw, dtype=np.uint8, offset=24)
        return cls(int(n), int(bits), flat[:size], flat[size:])

    def _low(self, i: np.ndarray) -> np.ndarray:
        if not self.bits:
            return np.zeros(len(i), dtype=U64)
        at = i * self.bits
        window = self.low[(at >> 3)[:, None] + np.arange(8)].view(U64).ravel()
        return (window >> (at & 7).astype(U64)) & U64((1 << self.bits) - 1)

    def get(self, i: np.ndarray) -> np.ndarray:
        """The i-th numbers."""
        high = np.searchsorted(self.ends, i, side="right")
        return (high.astype(U64) << U64(self.bits)) | self._low(i)

    def successor(self, x: np.ndarray) -> np.ndarray:
        """Index of the first number not below each ``x`` (``n`` if none)."""
        high = np.minimum(x >> U64(self.bits), U64(len(self.ends) - 1)).astype(np.int64)
        lo, hi = np.where(high > 0, self.ends[np.maximum(high - 1, 0)], 0), self.ends[high]
        low = x & U64((1 << self.bits) - 1)
        low = np.where((x >> U64(self.bits)) > high.astype(U64), U64((1 << 63) - 1), low)
        open_ = np.flatnonzero(lo < hi)
        while len(open_):
            mid = (lo[open_] + hi[open_]) >> 1
            below = self._low(mid) < low[open_]
            lo[open_[below]] = mid[below] + 1
            hi[open_[~below]] = mid[~below]
            open_ = open_[lo[open_] < hi[open_]]
        return lo
