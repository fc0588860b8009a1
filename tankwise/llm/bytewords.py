"""Words of many texts at once: splitting and hashing over Arrow's bytes with numpy.

A word is a run of bytes of a given class. Its hash is a polynomial over a random table of byte values
modulo 2**64, taken from prefix sums, so that the cost does not depend on how long words are. Texts are
handled in chunks of whole texts of about ``CHUNK`` bytes, which bounds the memory of a task."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK = 1 << 19

_rng = np.random.default_rng(20240229)
_VALUE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0xD1342543DE82EF95)
_INVERSE = np.uint64(pow(int(_BASE), -1, 2**64))

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def byte_class(*ranges: tuple[int, int]) -> np.ndarray:
    """A table that is true for the bytes in the given inclusive ranges."""
    table = np.zeros(256, bool)
    for low, high in ranges:
        table[low : high + 1] = True
    return table


#: ``[^\x20\x09-\x0D]+``: everything but white space.
NOT_SPACE = ~byte_class((0x20, 0x20), (0x09, 0x0D))
#: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after lower-casing: digits, letters and all beyond ASCII.
ALPHANUMERIC = byte_class((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF))


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class _Powers:
    """Powers of the base and of its inverse, grown on demand and kept by the process."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * CHUNK)
            ones = np.full(size, _BASE, np.uint64)
            ones[0] = 1
            back = np.full(size, _INVERSE, np.uint64)
            back[0] = 1
            up, down = np.multiply.accumulate(ones), np.multiply.accumulate(back)
            if size > 8 * CHUNK:  # for one very long text only
                return up, down
            self.up, self.down = up, down
        return self.up, self.down


_POWERS = _Powers()


@dataclass
class Chunk:
    """Some whole texts: lower-cased bytes, words as [start, end), a hash for each, words of text i at
    ``first[i]:first[i + 1]``. ``row`` is the number of the first text in the batch."""

    row: int
    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    first: np.ndarray

    @property
    def texts(self) -> int:
        return len(self.first) - 1

    def shingles(self, size: int) -> np.ndarray:
        """Hash of ``size`` words from each word on; the last ``size - 1`` places are not shingles.

        Whether the words belong to one text is for the caller to see to."""
        n = len(self.hashes) - size + 1
        if n <= 0:
            return np.zeros(0, np.uint64)
        return join_hashes([self.hashes[k : k + n] for k in range(size)])

    def words(self, start: int, size: int) -> bytes:
        """Lower-cased words joined by a space."""
        return b" ".join(
            self.data[a:b].tobytes()
            for a, b in zip(self.starts[start : start + size], self.ends[start : start + size])
        )


def join_hashes(parts: list[np.ndarray]) -> np.ndarray:
    """One hash for a sequence of word hashes; its length counts too."""
    total = np.full(len(parts[0]), len(parts), np.uint64)
    for part in parts:
        total = total * _STEP + part
    return mix(total)


def chunks(column: pa.Array, kind: np.ndarray) -> Iterator[Chunk]:
    """Split a text column (null: no bytes) into words of the byte class ``kind``."""
    column = column.cast(pa.large_string()).fill_null("")
    if not len(column):
        return
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        end = int(np.searchsorted(offsets, offsets[row] + CHUNK, "right")) - 1
        end = min(max(end, row + 1), len(column))
        yield _chunk(row, whole[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row], kind)
        row = end


def _chunk(row: int, raw: np.ndarray, offsets: np.ndarray, kind: np.ndarray) -> Chunk:
    data = LOWER[raw]
    n = len(data)
    if not n:
        none = np.zeros(0, np.int64)
        return Chunk(row, data, none, none, np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64))
    inside = np.zeros(n + 2, bool)
    inside[1:-1] = kind[data]
    border = np.zeros(n + 1, bool)
    border[offsets] = True
    starts = np.flatnonzero(inside[1:] & (~inside[:-1] | border))
    ends = np.flatnonzero(inside[:-1] & (~inside[1:] | border))
    up, down = _POWERS.get(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_VALUE[data] * up[:n], out=sums[1:])
    hashes = mix((sums[ends] - sums[starts]) * down[starts])
    return Chunk(row, data, starts, ends, hashes, np.searchsorted(starts, offsets))
