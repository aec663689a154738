"""Packing by lexical retrieval: windows of documents about the same words.

Documents are dealt by range of their rarest vocabulary entry (a BPE
vocabulary lists merges by falling frequency, so that is the largest id) into
partitions, and each partition is worked through in shards of about
``SHARD_TOKENS`` tokens.  A shard has a BM25 inverted index over token ids with
document frequencies of the whole corpus.  The first unused document seeds a
window; the seed's best-scoring unused neighbours fill it one after the other,
and the one that does not fit is cut, its rest staying in the index.  What is
left of a shard's last window goes into the next shard; a partition's last
window is cut into sequences of powers of two, which need no padding.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .encode import WORD_BPE, Encoder, public_path, shared_dictionary, with_end
from .store import kept
from .textblocks import map_batches, releasing, sections, string_column

WINDOW = 2048
SHARD_TOKENS = 1 << 19
K1, B = 1.2, 0.75


class Item(NamedTuple):
    key: int | None
    ids: np.ndarray      # what is left of the document, or a stretch of it
    start: int
    total: int           # ids of the whole document


def document_frequencies(ids: np.ndarray, at: np.ndarray, vocabulary: int) -> np.ndarray:
    """In how many rows each id occurs; row r has ids[at[r]:at[r + 1]].  Rows
    are marked in a table of bytes of 8 MB, and so few that a byte can count them."""
    group = max(1, min(255, (8 << 20) // vocabulary, len(at) - 1))
    seen = np.zeros((group, vocabulary), np.uint8)
    out = np.zeros(vocabulary, np.int64)
    for i in range(0, len(at) - 1, group):
        j = min(i + group, len(at) - 1)
        seen[np.repeat(np.arange(j - i), np.diff(at[i:j + 1])), ids[at[i]:at[j]]] = 1
        out += seen[:j - i].sum(axis=0, dtype=np.uint8)
        seen[:j - i] = 0
    return out


def encoded(docs: DataFrame, key: str, text: str, tokenizer: str, end: int) -> DataFrame:
    """kind, key, topic, n, ids: a "doc" row per document (ids as little-endian
    unsigned integers of two or four bytes), and a "df" row per task and 64 Ki
    vocabulary entries with the documents that have each of them."""
    dictionary = shared_dictionary(docs, text, tokenizer, words=True)

    def run(batches):
        encoder = Encoder(tokenizer, True, dictionary)
        size = max(encoder.vocabulary, end + 1)
        dtype = "<u2" if size <= 1 << 16 else "<u4"
        frequency, documents, tokens = np.zeros(size, np.int64), 0, 0
        for batch in batches:
            for rows, ids, sizes in encoder.encode(string_column(batch, text)):
                at = sections(sizes)
                frequency += document_frequencies(ids, at, size)
                top = np.zeros(len(sizes), np.int64)
                full = np.flatnonzero(sizes)
                if len(full):
                    top[full] = np.maximum.reduceat(ids, at[full])
                ids, total = with_end(ids, sizes, end)
                documents, tokens = documents + len(sizes), tokens + len(ids)
                column = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(total), [
                    None, pa.py_buffer(sections(total) * int(dtype[2])), pa.py_buffer(ids.astype(dtype))])
                yield pa.RecordBatch.from_arrays([pa.array(["doc"] * len(total)), batch.column(0)[rows.start:rows.stop], pa.array(top),
                                                  pa.array(total), column.cast(pa.binary())], names=["kind", key, "topic", "n", "ids"])
        if documents:
            counts = np.concatenate([frequency, [documents, tokens]])
            yield pa.RecordBatch.from_arrays([pa.array(["df"]), pa.array([None], pa.int64()), pa.array([0], pa.int64()), pa.array([0], pa.int64()),
                                              pa.array([counts.astype("<i8").tobytes()], pa.binary())], names=["kind", key, "topic", "n", "ids"])

    return (docs.select(F.col(key).cast("long").alias(key), text)
            .mapInArrow(releasing(run), f"kind string, `{key}` long, topic long, n long, ids binary"))


def statistics(coded: DataFrame) -> np.ndarray:
    """Document frequencies by id, then the numbers of documents and tokens:
    the vocabulary bounds what reaches the driver."""
    schema = pa.schema([("id", pa.int64()), ("n", pa.int64())])

    def work(batch):
        total = sum(np.frombuffer(x.as_buffer(), "<i8") for x in batch.column(0))
        hit = np.flatnonzero(total)
        yield [hit, total[hit]]

    got = (coded.filter("kind = 'df'").select("ids").mapInArrow(map_batches(schema, work), "id long, n long")
           .groupBy("id").agg(F.sum("n").alias("n")).toPandas())
    out = np.zeros(int(got["id"].max()) + 1 if len(got) else 2, np.int64)
    out[got["id"].to_numpy(dtype=np.int64)] = got["n"].to_numpy(dtype=np.int64)
    return out


class Index:
    """BM25 over the items of one shard."""

    def __init__(self, items: list[Item], idf: np.ndarray, mean: float):
        size = len(idf)
        row = np.repeat(np.arange(len(items)), [len(x.ids) for x in items])
        pair, tf = np.unique(row * size + np.concatenate([x.ids for x in items]).astype(np.int64), return_counts=True)
        self.row, term = pair // size, pair % size
        self.first = np.searchsorted(self.row, np.arange(len(items) + 1))
        length = np.array([len(x.ids) for x in items])[self.row]
        weight = idf[term] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * length / max(mean, 1.0)))
        order = np.argsort(term, kind="stable")
        self.entry, self.weight = self.row[order], weight[order]
        entries, where = np.unique(term[order], return_index=True)
        self.begin = where
        self.size = np.diff(np.concatenate([where, [len(term)]]))
        self.slot = np.searchsorted(entries, term)
        self.items = self.listed = len(items)

    def narrow(self, items: np.ndarray) -> None:
        """Only the marked items are scored from now on; the others get 0."""
        stay = items[self.entry]
        self.size = np.bincount(np.repeat(np.arange(len(self.size)), self.size)[stay], minlength=len(self.size))
        self.begin = sections(self.size)[:-1]
        self.entry, self.weight, self.listed = self.entry[stay], self.weight[stay], int(items.sum())

    def scores(self, item: int) -> np.ndarray:
        """Of all items against the words of one."""
        slots = self.slot[self.first[item]:self.first[item + 1]]
        sizes = self.size[slots]
        ends = sections(sizes)
        at = np.repeat(self.begin[slots] - ends[:-1], sizes) + np.arange(ends[-1])
        return np.bincount(self.entry[at], self.weight[at], self.items)


def windows(items: list[Item], idf: np.ndarray, mean: float, window: int) -> tuple[list[list[Item]], list[Item]]:
    """Full windows, and the pieces of the last one if it is not full."""
    index = Index(items, idf, mean)
    rest = list(items)
    unused = np.ones(len(items), bool)
    full: list[list[Item]] = []
    seed = 0
    while seed < len(items):
        if not unused[seed]:
            seed += 1
            continue
        unused[seed] = False
        pieces, room = [rest[seed]], window - len(rest[seed].ids)
        scores = None
        while room:
            if scores is None:
                if 4 * int(unused.sum()) < 3 * index.listed:
                    index.narrow(unused)
                scores = np.where(unused, index.scores(seed), -1.0)
            best = int(scores.argmax())       # ties: the first in the shard's order
            if scores[best] < 0:
                return full, pieces
            item = rest[best]
            piece = item._replace(ids=item.ids[:room])
            pieces.append(piece)
            room -= len(piece.ids)
            if len(piece.ids) < len(item.ids):
                rest[best] = item._replace(ids=item.ids[len(piece.ids):], start=item.start + len(piece.ids))
            else:
                unused[best] = False
                scores[best] = -1.0
        full.append(pieces)
    return full, []


def powers(pieces: list[Item]) -> Iterator[list[Item]]:
    """The same ids, in order, as sequences whose lengths are powers of two."""
    left = sum(len(p.ids) for p in pieces)
    pieces = list(pieces)
    while left:
        room = 1 << (left.bit_length() - 1)
        left -= room
        out = []
        while room:
            p = pieces.pop(0)
            out.append(p._replace(ids=p.ids[:room]))
            if len(p.ids) > room:
                pieces.insert(0, p._replace(ids=p.ids[room:], start=p.start + room))
            room -= len(out[-1].ids)
        yield out


def pack_documents(docs: DataFrame, window: int = WINDOW, end: int = 1, key: str = "doc_id", text: str = "text",
                   tokenizer: str | None = None, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """One row per piece: key, start, length, ids_crc32, doc_tokens,
    sequence_id, offset.

    Every id of every row of ``docs`` is in exactly one piece; a null or empty
    text is its end id.  Sequences hold ``window`` ids but for those, of powers
    of two, that end a partition.  Other columns are ignored; rows that share
    a key are packed one by one.
    """
    coded = kept(encoded(docs, key, text, tokenizer or public_path(WORD_BPE), end), "packing-ids")
    counts = statistics(coded)
    frequency, documents, tokens = counts[:-2], int(counts[-2]), int(counts[-1])
    idf = np.log1p((documents - frequency + 0.5) / (frequency + 0.5))
    idf = np.concatenate([idf, np.zeros(max(0, end + 1 - len(idf)))])
    idf[end] = 0.0
    mean = tokens / max(documents, 1)
    dtype = "<u2" if len(idf) <= 1 << 16 else "<u4"

    def run(batches):
        sequence = TaskContext.get().partitionId() << 40
        out: list[tuple] = []

        def emit(pieces: list[Item]) -> None:
            nonlocal sequence
            offset = 0
            for p in pieces:
                out.append((p.key, p.start, len(p.ids), zlib.crc32(p.ids.astype("<u4").tobytes()), p.total, sequence, offset))
                offset += len(p.ids)
            sequence += 1

        def flush():
            columns = list(zip(*out)) or [()] * 7
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns],
                                              names=[key, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

        pool: list[Item] = []
        waiting = 0
        for batch in batches:
            for k, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = np.frombuffer(data.as_buffer(), dtype)
                whole = len(ids) // window * window
                for i in range(0, whole, window):
                    emit([Item(k, ids[i:i + window], i, len(ids))])
                if whole < len(ids):
                    pool.append(Item(k, ids[whole:].copy(), whole, len(ids)))
                    waiting += len(ids) - whole
                if waiting >= shard_tokens:
                    full, pool = windows(pool, idf, mean, window)
                    waiting = sum(len(p.ids) for p in pool)
                    for pieces in full:
                        emit(pieces)
                if len(out) > 20_000:
                    yield flush()
        if pool:
            full, pool = windows(pool, idf, mean, window)
            for pieces in full:
                emit(pieces)
            for pieces in powers(pool):
                emit(pieces)
        yield flush()

    order = [F.col("topic"), F.col(key)]
    return (coded.filter("kind = 'doc'").select("topic", key, "ids").repartitionByRange(*order)
            .sortWithinPartitions(*order, F.xxhash64("ids")).select(key, "ids")
            .mapInArrow(releasing(run), f"`{key}` long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"))
