"""Non-decreasing whole numbers in near-minimal space, with select.

Each value's low bits are stored as they are; its high part is written in unary, as a one at place
``high + index`` of a bit string. The number of low bits is chosen so that this takes about
``2 + log2(largest / count)`` bits a value. The byte of every 256th one is kept as a 32-bit number (its
number of ones before that one in the same byte as 8 bits), so ``select`` looks at a short stretch of
bits only."""

from __future__ import annotations

import struct

import numpy as np

_EVERY = 256
_HEAD = struct.Struct("<QBQ")


def encode(values: np.ndarray) -> bytes:
    """The sequence as bytes; values of 2**63 and more may be given as unsigned numbers, and are read as
    the signed ones of the same bits."""
    values = np.asarray(values)
    n = len(values)
    if not n:
        return _HEAD.pack(0, 0, 0)
    if values[0] < 0 or (values[1:] < values[:-1]).any():
        raise ValueError("values must not be negative and must not decrease")
    values = values.astype(np.uint64)
    low_bits = max(0, int(int(values[-1]) // n).bit_length() - 1)
    ones = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
    upper = np.zeros(int(ones[-1]) // 8 + 1, np.uint8)
    np.bitwise_or.at(upper, ones >> 3, (1 << (ones & 7)).astype(np.uint8))
    sampled = ones[::_EVERY]
    within = np.array([bin(int(upper[p >> 3]) & ((1 << (p & 7)) - 1)).count("1") for p in sampled.tolist()], np.uint8)
    if low_bits:
        bits = (values[:, None] >> np.arange(low_bits, dtype=np.uint64)) & np.uint64(1)
        lower = np.packbits(bits.astype(np.uint8).ravel(), bitorder="little")
    else:
        lower = np.zeros(0, np.uint8)
    return b"".join(
        (
            _HEAD.pack(n, low_bits, len(upper)),
            lower.tobytes(),
            upper.tobytes(),
            (sampled >> 3).astype("<u4").tobytes(),
            within.tobytes(),
        )
    )


class EliasFano:
    """Reads what :func:`encode` wrote."""

    def __init__(self, data: bytes) -> None:
        self.n, self.low_bits, upper_bytes = _HEAD.unpack_from(data)
        at = _HEAD.size
        lower_bytes = -(-self.n * self.low_bits // 8)
        samples = -(-self.n // _EVERY)
        self.lower = np.frombuffer(data, np.uint8, lower_bytes, at)
        self.upper = np.frombuffer(data, np.uint8, upper_bytes, at + lower_bytes)
        self.sampled = np.frombuffer(data, "<u4", samples, at + lower_bytes + upper_bytes)
        self.within = np.frombuffer(data, np.uint8, samples, at + lower_bytes + upper_bytes + 4 * samples)

    def __len__(self) -> int:
        return self.n

    def select(self, i: int) -> int:
        """Value number ``i``."""
        return int(self.slice(i, i + 1)[0])

    def slice(self, start: int, end: int) -> np.ndarray:
        """Values ``start`` to ``end``, the latter excluded."""
        if not 0 <= start <= end <= self.n:
            raise IndexError(f"[{start}, {end}) of {self.n} values")
        if start == end:
            return np.zeros(0, np.int64)
        first, last = start // _EVERY, (end - 1) // _EVERY + 1
        a = int(self.sampled[first])
        b = int(self.sampled[last]) + 1 if last < len(self.sampled) else len(self.upper)
        ones = np.flatnonzero(np.unpackbits(self.upper[a:b], bitorder="little")) + 8 * a
        skip = int(self.within[first]) + start - first * _EVERY
        high = ones[skip : skip + end - start] - np.arange(start, end)
        return (high.astype(np.int64) << self.low_bits) | self._low(start, end)

    def _low(self, start: int, end: int) -> np.ndarray:
        width = self.low_bits
        if not width:
            return np.zeros(end - start, np.int64)
        a, b = start * width, end * width
        bits = np.unpackbits(self.lower[a >> 3 : (b + 7) >> 3], bitorder="little")[a & 7 :][: b - a]
        return bits.reshape(-1, width).astype(np.int64) @ (1 << np.arange(width, dtype=np.int64))
