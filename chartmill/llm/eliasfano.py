"""Elias-Fano codes: a non-decreasing sequence in about two bits a value more than its mean step needs.

Each value is cut into low bits, stored as they are, and a high part.  The high parts are written in
unary: the bit at ``(value >> low_bits) + i`` is set for the ``i``-th value.  Finding a value is to *select*
the ``i``-th set bit; the place of every ``STEP``-th one is kept in 32 bits, and the rest is counted from
there.  A value is therefore read without reading those before it.
"""

from __future__ import annotations

import numpy as np

STEP = 512  # set bits between two remembered places
CHUNK = 1 << 16  # values packed at a time; a multiple of 8, so that chunks end on whole bytes


def _low(values: np.ndarray, bits: int) -> np.ndarray:
    shifts = np.arange(bits - 1, -1, -1, dtype=np.uint64)
    return np.packbits(((values[:, None] >> shifts) & np.uint64(1)).astype(np.uint8))


class EliasFano:
    """``count`` values; arrays are views of the bytes they were read from."""

    def __init__(self, count: int, base: int, low_bits: int, low: np.ndarray, high: np.ndarray, places: np.ndarray):
        self.count, self.base, self.low_bits, self.low, self.high, self.places = count, base, low_bits, low, high, places

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        """Encode non-decreasing 64-bit whole numbers, negative ones too, fewer than 2**30 of them."""
        values = np.asarray(values, np.int64)
        n = len(values)
        if not n:
            return cls(0, 0, 0, np.empty(0, np.uint8), np.empty(0, np.uint8), np.empty(0, "<u4"))
        if n >= 1 << 30 or (values[1:] < values[:-1]).any():
            raise ValueError("values must not decrease, and be fewer than 2**30")
        steps = values.view(np.uint64) - values[:1].view(np.uint64)  # differences up to 2**64 wrap around rightly
        low_bits = max(0, (int(steps[-1]) // n).bit_length() - 1)
        low = [_low(steps[at : at + CHUNK], low_bits) for at in range(0, n, CHUNK)] if low_bits else []
        ones = (steps >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        high = np.zeros(int(ones[-1]) // 8 + 1, np.uint8)
        np.bitwise_or.at(high, ones >> 3, np.uint8(128) >> (ones & 7).astype(np.uint8))
        places = ones[::STEP].astype("<u4")
        return cls(n, int(values[0]), low_bits, np.concatenate(low) if low else np.empty(0, np.uint8), high, places)

    def range(self, start: int, stop: int) -> np.ndarray:
        """The values at ``start`` to ``stop - 1``."""
        stop = min(stop, self.count)
        if start >= stop:
            return np.empty(0, np.int64)
        first = start // STEP
        begin = int(self.places[first])
        last = (stop - 1) // STEP + 1
        end = int(self.places[last]) if last < len(self.places) else len(self.high) * 8
        bits = np.unpackbits(self.high[begin // 8 : end // 8 + 1])
        ones = np.flatnonzero(bits[begin % 8 :])[start - first * STEP :][: stop - start] + begin
        values = (ones - np.arange(start, stop)).astype(np.uint64) << np.uint64(self.low_bits)
        if self.low_bits:
            begin, end = start * self.low_bits, stop * self.low_bits
            bits = np.unpackbits(self.low[begin // 8 : -(-end // 8)])[begin % 8 :][: end - begin].reshape(-1, self.low_bits)
            for k in range(self.low_bits):
                values |= bits[:, k].astype(np.uint64) << np.uint64(self.low_bits - 1 - k)
        return (values + np.array([self.base], np.int64).view(np.uint64)).view(np.int64)

    def __getitem__(self, i: int) -> int:
        if not 0 <= i < self.count:
            raise IndexError(i)
        return int(self.range(i, i + 1)[0])

    def sections(self) -> tuple[dict[str, int], list[bytes]]:
        """What :meth:`read` needs: numbers, and the bytes of low bits, high bits and places."""
        parts = [self.low.tobytes(), self.high.tobytes(), self.places.tobytes()]
        numbers = {"count": self.count, "base": self.base, "low_bits": self.low_bits, "low": len(parts[0]), "high": len(parts[1])}
        return numbers, parts

    @classmethod
    def read(cls, numbers: dict[str, int], data: memoryview) -> EliasFano:
        low, high = numbers["low"], numbers["high"]
        raw = np.frombuffer(data, np.uint8)
        return cls(
            numbers["count"], numbers["base"], numbers["low_bits"], raw[:low], raw[low : low + high],
            raw[low + high :].view("<u4"),
        )
