"""Texts of an Arrow batch as one flat byte array, and words, hashes and counts taken from it with numpy.

Everything works on UTF-8 bytes, a slice of about a megabyte at a time, so memory does not depend on the
size of a batch, and a single very long text is its own slice.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_MIX_1, _MIX_2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_powers: dict[str, np.ndarray] = {}


def byte_class(test) -> np.ndarray:
    """A 256-entry truth table from a test of a byte."""
    return np.array([bool(test(b)) for b in range(256)])


LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)


def _power(name: str, factor: np.uint64, size: int) -> np.ndarray:
    """factor**0, factor**1, ... modulo 2**64; kept for the size of a usual slice."""
    usual = SLICE_BYTES + 1024
    have = _powers.get(name)
    if have is None or len(have) < size:
        have = np.full(max(size, usual), factor, np.uint64)
        have[0] = 1
        have = np.multiply.accumulate(have)
        _powers[name] = have[:usual].copy()
    return have[:size]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit keys."""
    h = h ^ (h >> np.uint64(30))
    h *= _MIX_1
    h ^= h >> np.uint64(27)
    h *= _MIX_2
    h ^= h >> np.uint64(31)
    return h


class Flat:
    """`data`: bytes of n texts end to end; `at`: their n + 1 bounds. A null text is empty."""

    def __init__(self, data: np.ndarray, at: np.ndarray):
        self.data, self.at, self.n = data, at, len(at) - 1
        self._sums: np.ndarray | None = None

    def mapped(self, table: np.ndarray) -> "Flat":
        return Flat(table[self.data], self.at)

    def runs(self, member: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts, ends and texts of the longest runs of bytes of a class; no run crosses two texts."""
        inside = member[self.data]
        edge = np.zeros(len(inside) + 1, np.int8)
        edge[:-1] = inside
        edge[1:] -= inside
        starts, ends = edge == 1, edge == -1
        cut = self.at[(self.at > 0) & (self.at < len(inside))]
        cut = cut[inside[cut] & inside[cut - 1]]
        starts[cut] = ends[cut] = True
        starts, ends = np.flatnonzero(starts), np.flatnonzero(ends)
        return starts, ends, self.owner(starts)

    def owner(self, positions: np.ndarray) -> np.ndarray:
        """The text that holds each byte position."""
        return np.searchsorted(self.at, positions, "right") - 1

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """64-bit keys of byte ranges: equal for equal bytes wherever they stand."""
        size = len(self.data)
        if self._sums is None:
            sums = np.zeros(size + 1, np.uint64)
            np.cumsum((self.data.astype(np.uint64) + np.uint64(1)) * _power("base", _BASE, size)[:size], out=sums[1:])
            self._sums = sums
        h = (self._sums[ends] - self._sums[starts]) * _power("inverse", _INVERSE, size + 1)[starts]
        return mix(h + (ends - starts).astype(np.uint64) * _MIX_1)

    def count(self, member: np.ndarray) -> np.ndarray:
        """Bytes of a class in each text."""
        sums = np.zeros(len(self.data) + 1, np.int64)
        np.cumsum(member[self.data], out=sums[1:])
        return sums[self.at[1:]] - sums[self.at[:-1]]

    def per_text(self, owner: np.ndarray, weights: np.ndarray | None = None) -> np.ndarray:
        return np.bincount(owner, weights, self.n)


def flat_slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, Flat]]:
    """(first row, end row, Flat) for consecutive slices of at most `limit` bytes or one text."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    n = len(texts)
    if n == 0:
        return
    _, bounds, values = texts.buffers()
    at = np.frombuffer(bounds, np.int64)[texts.offset : texts.offset + n + 1]
    data = np.frombuffer(values, np.uint8) if values is not None else np.zeros(0, np.uint8)
    row = 0
    while row < n:
        end = max(row + 1, int(np.searchsorted(at, at[row] + limit, "right")) - 1)
        end = min(end, n)
        yield row, end, Flat(data[at[row] : at[end]], at[row : end + 1] - at[row])
        row = end


def ngram_keys(keys: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys of n consecutive words and the position of their first word; none crosses two texts."""
    if len(keys) < n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    last = len(keys) - n + 1
    out = keys[:last].copy()
    for i in range(1, n):
        out *= _BASE
        out += keys[i : last + i]
    at = np.flatnonzero(owner[:last] == owner[n - 1 :])
    return mix(out[at]), at


def with_owner(keys: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Keys that are equal only within one text."""
    return mix(keys + owner.astype(np.uint64) * _BASE)


def covered(size: int, starts: np.ndarray, lengths) -> np.ndarray:
    """Truth for the positions that any interval covers."""
    edge = np.zeros(size + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + lengths, -1)
    return np.cumsum(edge[:-1]) > 0


def firsts(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of equal keys: the first position of each distinct one, the distinct one of every key, and counts."""
    _, first, inverse, counts = np.unique(keys, return_index=True, return_inverse=True, return_counts=True)
    return first, inverse, counts
