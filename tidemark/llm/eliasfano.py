"""Elias-Fano coded monotone sequences in one block of bytes, read in place."""

from __future__ import annotations

import struct

import numpy as np

U = np.uint64


class EliasFano:
    """n increasing (or equal) 64-bit values. Each keeps its l low bits in a packed array; the
    high parts are unary in a bitmap: bit (value >> l) + i is set for the i-th value. That is
    about 2 + log2(range / n) bits a value."""

    def __init__(self, block: bytes | memoryview, at: int = 0) -> None:
        self.n, self.l, self.base, n_high = struct.unpack_from("<QQQQ", block, at)
        n_low = (self.n * self.l + 7) // 8 + 8 if self.n else 0
        view = np.frombuffer(block, dtype=np.uint8)
        self.low = view[at + 32 : at + 32 + n_low]
        high = view[at + 32 + n_low : at + 32 + n_low + n_high]
        self.end = at + 32 + n_low + n_high
        self.ones = np.flatnonzero(np.unpackbits(high, bitorder="little")).astype(np.uint32 if n_high < 1 << 28 else np.int64)

    @staticmethod
    def encode(values: np.ndarray) -> bytes:
        values = values.astype(U)
        n = len(values)
        if not n:
            return struct.pack("<QQQQ", 0, 0, 0, 0)
        base = values[0]
        rest = values - base
        l = max(0, (int(rest[-1]) // n).bit_length() - 1) if n else 0
        low = np.zeros((n * l + 7) // 8 + 8, dtype=np.uint8)
        if l:
            # Whole 8-value groups fill whole bytes, so groups are packed independently.
            bits = ((rest[:, None] >> np.arange(l, dtype=U)) & U(1)).astype(np.uint8) if n * l < 1 << 22 else None
            if bits is not None:
                packed = np.packbits(bits.ravel(), bitorder="little")
                low[: len(packed)] = packed
            else:
                step = (1 << 16) // 8 * 8
                for i in range(0, n, step):
                    part = ((rest[i : i + step, None] >> np.arange(l, dtype=U)) & U(1)).astype(np.uint8)
                    packed = np.packbits(part.ravel(), bitorder="little")
                    low[i * l // 8 : i * l // 8 + len(packed)] = packed
        places = (rest >> U(l)).astype(np.int64) + np.arange(n)
        high = np.zeros(int(places[-1]) + 1, dtype=np.uint8)
        high[places] = 1
        high = np.packbits(high, bitorder="little")
        return struct.pack("<QQQQ", n, l, int(base), len(high)) + low.tobytes() + high.tobytes()

    def access(self, i: np.ndarray) -> np.ndarray:
        """Values at the places i."""
        i = np.asarray(i, dtype=np.int64)
        out = (self.ones[i].astype(np.int64) - i).astype(U) << U(self.l)
        if self.l:
            bit = i * self.l
            byte, shift = bit >> 3, (bit & 7).astype(U)
            word = np.zeros(len(i), dtype=U)
            for j in range(8):
                word |= self.low[byte + j].astype(U) << U(8 * j)
            low = word >> shift
            if self.l > 56:
                more = self.low[np.minimum(byte + 8, len(self.low) - 1)].astype(U)
                low = np.where(shift > 0, low | (more << (U(64) - np.maximum(shift, U(1)))), low)
            out |= low & U((1 << self.l) - 1)
        return out + U(self.base)

    def decode(self) -> np.ndarray:
        parts = [self.access(np.arange(i, min(i + (1 << 18), self.n))) for i in range(0, self.n, 1 << 18)]
        return np.concatenate(parts) if parts else np.zeros(0, U)

    def search(self, low: np.ndarray, high: np.ndarray, x: np.ndarray) -> np.ndarray:
        """First place in [low, high) whose value is at least x, or high."""
        low, high = low.astype(np.int64).copy(), high.astype(np.int64).copy()
        active = np.flatnonzero(low < high)
        while len(active):
            middle = (low[active] + high[active]) >> 1
            less = self.access(middle) < x[active]
            low[active[less]] = middle[less] + 1
            high[active[~less]] = middle[~less]
            active = active[low[active] < high[active]]
        return low
