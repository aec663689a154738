"""Text columns as numpy byte blocks, inside Python workers.

The operators read texts through ``mapInArrow``: a batch's string column is
cut into blocks of whole rows of at most ``max_bytes`` (one longer row is a
block of its own), so a worker's memory follows the block and not the batch.
All byte positions are positions in UTF-8.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 4 << 20

#: ASCII upper case to lower case, other bytes as they are.
ASCII_LOWER = np.arange(256, dtype=np.uint8)
ASCII_LOWER[65:91] += 32

#: Bytes of a word: ASCII letters and digits, and everything beyond ASCII.
ALNUM = np.zeros(256, bool)
ALNUM[48:58] = ALNUM[65:91] = ALNUM[97:123] = ALNUM[128:] = True

#: Bytes other than the six white-space characters of ASCII.
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[9, 10, 11, 12, 13, 32]] = False


class Block(NamedTuple):
    rows: slice           # rows of the batch
    data: np.ndarray      # uint8, their bytes one after the other
    offsets: np.ndarray   # int64, len(rows) + 1


def string_column(batch: pa.RecordBatch, name: str) -> pa.Array:
    """The column as strings without nulls (null: empty)."""
    return batch.column(batch.schema.get_field_index(name)).cast(pa.large_string()).fill_null("")


def blocks(column: pa.Array, max_bytes: int = BLOCK_BYTES) -> Iterator[Block]:
    n = len(column)
    if not n:
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + n + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + max_bytes, side="right")) - 1)
        j = min(j, n)
        yield Block(slice(i, j), data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
        i = j


def spans(block: Block, member: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of member bytes that stay within a row: starts, ends, and
    per row the number of the first run (len(rows) + 1 values)."""
    n = len(block.data)
    inside = np.zeros(n + 2, bool)
    inside[1:-1] = member[block.data]
    edge = np.zeros(n + 1, bool)
    edge[block.offsets] = True
    starts = np.flatnonzero(inside[1:] & (~inside[:-1] | edge))
    ends = np.flatnonzero(inside[:-1] & (~inside[1:] | edge))
    return starts, ends, np.searchsorted(starts, block.offsets)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64): every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans, eight bytes a step."""
    lengths = ends - starts
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray((len(data) + 1,), "<u8", padded, 0, (1,))
    h = lengths.astype(np.uint64) * _GOLDEN
    live, at, left = np.arange(len(starts)), starts, lengths
    while len(live):
        drop = (np.maximum(8 - left, 0) * 8).astype(np.uint64)
        word = np.where(left > 0, eight[at], np.uint64(0))
        word = (word << drop) >> drop if len(drop) else word
        h[live] = mix(h[live] ^ word) + _GOLDEN
        more = left > 8
        live, at, left = live[more], at[more] + 8, left[more] - 8
    return h


def windows(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hashes of k consecutive values (len(hashes) - k + 1 of them)."""
    n = max(0, len(hashes) - k + 1)
    out = np.zeros(n, np.uint64)
    for j in range(k):
        out = mix(out ^ hashes[j:j + n]) + _GOLDEN
    return out


def sections(counts: np.ndarray) -> np.ndarray:
    """Offsets of sections with these counts."""
    out = np.zeros(len(counts) + 1, np.int64)
    np.cumsum(counts, out=out[1:])
    return out


def releasing(run: Callable) -> Callable:
    """``run`` for ``mapInArrow``; what Arrow holds without use at a task's end
    goes back to the system, as Spark keeps the worker for other stages."""
    def tidy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
    return tidy


def map_batches(schema: pa.Schema, work: Callable[[pa.RecordBatch], Iterable[list]]) -> Callable:
    """A ``mapInArrow`` function; ``work`` yields lists of column arrays."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                for columns in work(batch):
                    yield pa.RecordBatch.from_arrays(
                        [c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)
    return releasing(run)


def span_strings(block: Block, starts: np.ndarray, ends: np.ndarray, member: np.ndarray) -> pa.Array:
    """The runs that ``spans`` found, as a binary array."""
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(starts),
        [None, pa.py_buffer(sections(ends - starts)), pa.py_buffer(np.ascontiguousarray(block.data[member[block.data]]))])


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of a large string or binary array."""
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    return offsets - offsets[0] if len(offsets) else np.zeros(1, np.int64), data[offsets[0]:offsets[-1]] if len(offsets) else data
