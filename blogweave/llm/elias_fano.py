"""Elias-Fano sequences in numpy, and files of arrays for memory mapping."""

from __future__ import annotations

import json
import struct

import numpy as np

from .store import mapped

_ONE = np.uint64(1)

#: Place of the r-th set bit of a byte.
_SELECT8 = np.zeros((256, 8), np.uint8)
for _b in range(256):
    for _r, _p in enumerate([p for p in range(8) if _b >> p & 1]):
        _SELECT8[_b, _r] = _p


def _put(words: np.ndarray, where: np.ndarray, bits: np.ndarray) -> None:
    """words[where] |= bits, for ascending ``where``."""
    if len(where):
        starts = np.flatnonzero(np.concatenate([[True], where[1:] != where[:-1]]))
        words[where[starts]] |= np.bitwise_or.reduceat(bits, starts)


def _select_in_word(word: np.ndarray, r: np.ndarray) -> np.ndarray:
    parts = np.ascontiguousarray(word, "<u8").view(np.uint8).reshape(-1, 8)
    total = np.cumsum(np.bitwise_count(parts), axis=1, dtype=np.int64)
    j = (total <= r[:, None]).sum(axis=1)
    row = np.arange(len(word))
    before = np.where(j > 0, total[row, np.maximum(j - 1, 0)], 0)
    return j * 8 + _SELECT8[parts[row, j], r - before]


class EliasFano:
    """A non-decreasing sequence: the low bits of each value as they are, the
    high ones in unary, with the number of set bits before every 512."""

    AT_ONCE = 1 << 17

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray, rank: np.ndarray):
        self.n, self.low_bits, self.low, self.high, self.rank = n, low_bits, low, high, rank
        self.zeros = np.arange(len(rank), dtype=np.int64) * 512 - rank

    @classmethod
    def build(cls, values: np.ndarray, universe: int) -> "EliasFano":
        values, n = values.astype(np.uint64), len(values)
        bits = max(0, (max(1, int(universe)) // max(1, n)).bit_length() - 1)
        low = np.zeros(n * bits // 64 + 2, np.uint64)
        index = np.arange(n, dtype=np.int64)
        if bits and n:
            part = values & ((_ONE << np.uint64(bits)) - _ONE)
            at, shift = index * bits >> 6, (index * bits & 63).astype(np.uint64)
            _put(low, at, part << shift)
            over = shift.astype(np.int64) + bits > 64
            _put(low, at[over] + 1, part[over] >> (np.uint64(64) - shift[over]))
        top = int(values[-1] >> np.uint64(bits)) if n else 0
        place = (values >> np.uint64(bits)).astype(np.int64) + index
        high = np.zeros((n + top + 1 + 512) // 512 * 8, np.uint64)
        _put(high, place >> 6, _ONE << (place & 63).astype(np.uint64))
        rank = np.zeros(len(high) // 8 + 1, np.int64)
        np.cumsum(np.bitwise_count(high).reshape(-1, 8).sum(axis=1), out=rank[1:])
        return cls(n, bits, low, high, rank)

    def arrays(self, name: str) -> dict[str, np.ndarray]:
        return {f"{name}.shape": np.array([self.n, self.low_bits], np.int64), f"{name}.low": self.low,
                f"{name}.high": self.high, f"{name}.rank": self.rank}

    @classmethod
    def of(cls, arrays: dict[str, np.ndarray], name: str) -> "EliasFano":
        n, bits = (int(x) for x in arrays[f"{name}.shape"])
        return cls(n, bits, arrays[f"{name}.low"], arrays[f"{name}.high"], arrays[f"{name}.rank"])

    def _low_at(self, i: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(i), np.uint64)
        at, shift = i * self.low_bits >> 6, (i * self.low_bits & 63).astype(np.uint64)
        word = self.low[at] >> shift | (self.low[at + 1] << _ONE) << (np.uint64(63) - shift)
        return word & ((_ONE << np.uint64(self.low_bits)) - _ONE)

    def _select(self, k: np.ndarray, ones: bool) -> np.ndarray:
        before = self.rank if ones else self.zeros
        block = np.searchsorted(before, k, side="right") - 1
        words = self.high[block[:, None] * 8 + np.arange(8)]
        words = words if ones else ~words
        total = np.cumsum(np.bitwise_count(words), axis=1, dtype=np.int64)
        r = k - before[block]
        j = (total <= r[:, None]).sum(axis=1)
        row = np.arange(len(k))
        r = r - np.where(j > 0, total[row, np.maximum(j - 1, 0)], 0)
        return block * 512 + j * 64 + _select_in_word(words[row, j], r)

    def values(self, i: np.ndarray) -> np.ndarray:
        """Values at the places ``i``."""
        out = np.zeros(len(i), np.uint64)
        for a in range(0, len(i), self.AT_ONCE):
            k = i[a:a + self.AT_ONCE].astype(np.int64)
            out[a:a + len(k)] = (self._select(k, True) - k).astype(np.uint64) << np.uint64(self.low_bits) | self._low_at(k)
        return out

    def decode(self) -> np.ndarray:
        bits = np.unpackbits(np.ascontiguousarray(self.high, "<u8").view(np.uint8), bitorder="little")
        index = np.arange(self.n, dtype=np.int64)
        return (np.flatnonzero(bits) - index).astype(np.uint64) << np.uint64(self.low_bits) | self._low_at(index)

    def find(self, x: np.ndarray) -> np.ndarray:
        """Successor search: the place of the first value that equals x, else -1."""
        out = np.full(len(x), -1, np.int64)
        if not self.n:
            return out
        for a in range(0, len(x), self.AT_ONCE):
            part = x[a:a + self.AT_ONCE].astype(np.uint64)
            h = (part >> np.uint64(self.low_bits)).astype(np.int64)
            live = np.flatnonzero(h <= int(self.zeros[-1]) - 1)     # the bit vector ends after its last value's high part
            h = h[live]
            low = np.zeros(len(live), np.int64)         # the values with this high part: places low to high
            later = h > 0
            low[later] = self._select(h[later] - 1, False) + 1 - h[later]
            high = self._select(h, False) - h
            end = high.copy()
            want = part[live] & ((_ONE << np.uint64(self.low_bits)) - _ONE)
            open_ = np.flatnonzero(low < high)
            while len(open_):
                middle = (low[open_] + high[open_]) >> 1
                right = self._low_at(middle) < want[open_]
                low[open_[right]] = middle[right] + 1
                high[open_[~right]] = middle[~right]
                open_ = open_[low[open_] < high[open_]]
            some = np.flatnonzero(low < end)
            some = some[self._low_at(low[some]) == want[some]]
            out[a + live[some]] = low[some]
        return out


def write_arrays(out, arrays: dict[str, np.ndarray]) -> None:
    """A JSON header (its length first), then the arrays, each on 8 bytes."""
    header, at = {}, 0
    for name, a in arrays.items():
        header[name] = [a.dtype.str, len(a), at]
        at += -(-a.nbytes // 8) * 8
    head = json.dumps(header).encode()
    head += b" " * (-len(head) % 8)
    out.write(struct.pack("<Q", len(head)) + head)
    for a in arrays.values():
        out.write(np.ascontiguousarray(a).tobytes() + b"\0" * (-a.nbytes % 8))


def map_arrays(path: str) -> dict[str, np.ndarray]:
    data = mapped(path)
    size = int(data[:8].view("<u8")[0])
    header = json.loads(bytes(data[8:8 + size]))
    return {name: data[8 + size + at:8 + size + at + n * np.dtype(kind).itemsize].view(kind)
            for name, (kind, n, at) in header.items()}


def array_bytes(arrays: dict[str, np.ndarray]) -> bytes:
    import io
    out = io.BytesIO()
    write_arrays(out, arrays)
    return out.getvalue()


def arrays_of(data) -> dict[str, np.ndarray]:
    """The arrays in a buffer that ``array_bytes`` gave."""
    raw = np.frombuffer(data, np.uint8)
    size = int(raw[:8].copy().view("<u8")[0])
    header = json.loads(bytes(raw[8:8 + size]))
    return {name: np.frombuffer(raw[8 + size + at:8 + size + at + n * np.dtype(kind).itemsize].tobytes(), kind)
            for name, (kind, n, at) in header.items()}
