"""Token ids by the ``tokenizers`` library, repeated chunks encoded once.

Both public vocabularies split a text before they merge, and never across a
space that is followed by something else than white space.  So a text is cut
there, equal chunks of a block are found with Arrow's dictionary encoding, and
the ids put together are those of the whole text.

A Spark job first counts all chunks and encodes those that several blocks
have, the ``DICTIONARY`` most frequent at most, into files that tasks map into
memory; a task encodes by itself what is not among them.
"""

from __future__ import annotations

import os
import string
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from .elias_fano import array_bytes, arrays_of, map_arrays, write_arrays
from .store import folder, kept, write_file
from .textblocks import ASCII_LOWER, NOT_SPACE, Block, blocks, bytes_of, releasing, sections, span_hashes, spans, string_column

BYTE_BPE, WORD_BPE = "byte_bpe_50k.json", "word_bpe_49k.json"

#: Bound of the shared dictionary, in chunks.
DICTIONARY = 8_000_000
#: Chunks that a mapper counts before it hands them on.
GATHERED = 1_000_000

#: A space before one of these may belong to a longer run of white space
#: (the lead bytes are those of white space beyond ASCII).
_MAY_BE_SPACE = np.zeros(256, bool)
_MAY_BE_SPACE[[9, 10, 11, 12, 13, 28, 29, 30, 31, 32, 0xC2, 0xE1, 0xE2, 0xE3]] = True
_CHECK = np.uint64(0xC0FFEE1234567)
_LOWER, _SPACE = ASCII_LOWER.tobytes(), np.flatnonzero(~NOT_SPACE).astype(np.uint8).tobytes()


def public_path(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


@lru_cache(maxsize=2)
def tokenizer_of(path: str):
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")   # Spark's tasks are the parallelism
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True                     # in a text, their strings are ordinary text
    return tokenizer


def chunks_of(block: Block, words: bool) -> tuple[pa.Array, np.ndarray]:
    """A block's chunks in order, and the first one of each row."""
    if words:
        starts, ends, first = spans(block, NOT_SPACE)
        data = block.data.tobytes().translate(_LOWER, _SPACE)
        return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(sections(ends - starts)), pa.py_buffer(data)]), first
    data = block.data
    cut = np.zeros(len(data) + 1, bool)
    if len(data) > 1:
        cut[:-2] = (data[:-1] == 32) & ~_MAY_BE_SPACE[data[1:]]
    cut[block.offsets] = True
    edges = np.flatnonzero(cut)
    column = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(edges) - 1,
                                              [None, pa.py_buffer(edges.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))])
    return column, np.searchsorted(edges, block.offsets)


def _hashes(chunks: pa.Array) -> np.ndarray:
    at, data = bytes_of(chunks)
    return span_hashes(data, at[:-1], at[1:])


class Plain:
    """Chunks that a vocabulary's normalizer leaves as they are, and that it cuts
    just where letters, digits and punctuation meet (before and after each digit).

    These are put through the vocabulary's merges with spaces at the cuts, many
    chunks at a time; the ids that end a word tell which are whose.  The letters
    are below U+0800, where none composes with the one before it; an apostrophe
    may belong to the letters after it and is not plain."""

    LETTER, DIGIT, SIGN = 1, 2, 3
    #: Chunks that are encoded as one string.
    JOINED = 64

    def __init__(self, tokenizer):
        from tokenizers import Tokenizer, pre_tokenizers
        suffix = getattr(tokenizer.model, "end_of_word_suffix", None)
        self.kind = np.zeros(0x800, np.uint8)
        if not suffix or tokenizer.normalizer is None or tokenizer.pre_tokenizer is None:
            return
        self.kind[[ord(c) for c in string.punctuation if c != "'"]] = self.SIGN
        self.kind[48:58] = self.DIGIT
        for c in range(97, 0x800):
            x = chr(c)
            if unicodedata.category(x)[0] == "L" and tokenizer.normalizer.normalize_str(x) == x:
                self.kind[c] = self.LETTER if len(tokenizer.pre_tokenizer.pre_tokenize_str(f"a{x}a")) == 1 else 0
        self.last = np.zeros(max(tokenizer.get_vocab().values()) + 1, bool)
        self.last[[i for token, i in tokenizer.get_vocab().items() if token.endswith(suffix)]] = True
        self.merges = Tokenizer(tokenizer.model)
        self.merges.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.CharDelimiterSplit(" "), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        own = [chr(c) for c in np.flatnonzero(self.kind)]
        probe = pa.array([x.encode() for x in [*own, *(f"a{x}b1" for x in own), "".join(own)]], pa.large_binary())
        ids, sizes = _one_by_one(tokenizer, probe)
        mine = self.encode(probe)
        if mine is None or not (np.array_equal(mine[0], ids) and np.array_equal(mine[1], sizes)):
            self.kind[:] = 0                      # another kind of vocabulary

    def kinds(self, data: np.ndarray) -> np.ndarray:
        """Of each byte, that of its character; 0: not plain."""
        tail = np.append((data & 0xC0) == 0x80, False)
        two = ((data & 0xE0) == 0xC0) & tail[1:]
        code = np.where(data < 0x80, data, 0).astype(np.int64)
        at = np.flatnonzero(two)
        code[at] = (data[at] & np.int64(31)) << 6 | data[at + 1] & np.int64(63)
        out = self.kind[code]
        out[at + 1] = out[at]
        return out

    def which(self, chunks: pa.Array) -> np.ndarray:
        """The plain ones among the chunks."""
        if not self.kind.any():
            return np.zeros(0, np.int64)
        at, data = bytes_of(chunks)
        other = sections(self.kinds(data) == 0)
        return np.flatnonzero((other[at[1:]] == other[at[:-1]]) & (at[1:] > at[:-1]))

    def encode(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray] | None:
        """Plain chunks' ids one after the other, and each one's number of them;
        none if they cannot be told apart."""
        at, data = bytes_of(chunks)
        kind = self.kinds(data)
        cut = np.zeros(len(data) + 1, bool)
        cut[1:-1] = (kind[1:] != kind[:-1]) | (kind[1:] == self.DIGIT)
        cut[at] = True
        words = sections(cut[:-1])[at]                # before each chunk
        place = np.arange(len(data)) + np.cumsum(cut[:-1]) - 1
        spaced = np.full(len(data) + int(words[-1]), 32, np.uint8)
        spaced[place] = data
        raw, edges = spaced.tobytes(), np.append(place[at[:-1:self.JOINED]], len(spaced)).tolist()
        coded = self.merges.encode_batch_fast([raw[a:b].decode().rstrip(" ") for a, b in zip(edges, edges[1:])], add_special_tokens=False)
        ids = np.fromiter(chain.from_iterable(e.ids for e in coded), np.uint32)
        ends = np.flatnonzero(self.last[ids]) + 1
        if len(ends) != words[-1]:
            return None
        return ids, np.diff(ends[words[1:] - 1], prepend=0)


@lru_cache(maxsize=2)
def _plain(path: str) -> Plain:
    return Plain(tokenizer_of(path))


def _one_by_one(tokenizer, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    coded = [e.ids for e in tokenizer.encode_batch_fast(chunks.cast(pa.large_string()).to_pylist(), add_special_tokens=False)]
    sizes = np.fromiter(map(len, coded), np.int64, len(coded))
    return np.fromiter(chain.from_iterable(coded), np.uint32, int(sizes.sum())), sizes


def _encoded(path: str, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The chunks' ids one after the other, and each one's number of them."""
    plain = _plain(path).which(chunks)
    mine = _plain(path).encode(chunks.take(pa.array(plain))) if len(plain) else None
    if mine is None:
        return _one_by_one(tokenizer_of(path), chunks)
    rest = np.setdiff1d(np.arange(len(chunks)), plain, assume_unique=True)
    more = _one_by_one(tokenizer_of(path), chunks.take(pa.array(rest)))
    sizes, start = np.zeros(len(chunks), np.int64), np.zeros(len(chunks), np.int64)
    sizes[plain], sizes[rest] = mine[1], more[1]
    start[plain], start[rest] = sections(mine[1])[:-1], len(mine[0]) + sections(more[1])[:-1]
    return gather(np.concatenate([mine[0], more[0]]), start, sizes), sizes


def gather(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sections of ``values``, one after the other."""
    ends = sections(sizes)
    return values[np.repeat(starts - ends[:-1], sizes) + np.arange(ends[-1])]


def _counted(parts: list[tuple[pa.Array, np.ndarray]]) -> tuple[pa.Array, np.ndarray]:
    coded = pa.concat_arrays([c for c, _ in parts]).dictionary_encode()
    counts = np.bincount(coded.indices.to_numpy(zero_copy_only=False), np.concatenate([n for _, n in parts]), len(coded.dictionary))
    return coded.dictionary, counts.astype(np.int64)


class Dictionary:
    """Files of encoded chunks by range of their hashes; a chunk is known by
    its hash of 64 bits and 32 more bits."""

    def __init__(self, paths: tuple[str, ...]):
        self.files = [map_arrays(p) if p else None for p in paths]
        self.bits = (len(paths) - 1).bit_length()

    def look_up(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of the known chunks, and each chunk's start among them and its
        number (-1: unknown)."""
        h = _hashes(chunks)
        order = np.argsort(h, kind="stable")
        ordered = h[order]
        check = ((ordered ^ _CHECK) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)).astype(np.uint32) ^ np.diff(bytes_of(chunks)[0])[order].astype(np.uint32)
        edges = [0, *np.searchsorted(ordered, [np.uint64(k << (64 - self.bits)) for k in range(1, len(self.files))]).tolist(), len(h)]
        start, size, pool, filled = np.zeros(len(h), np.int64), np.full(len(h), -1, np.int64), [], 0
        for file, a, b in zip(self.files, edges, edges[1:]):
            if b > a and file is not None and len(file["hash"]):
                at = np.minimum(np.searchsorted(file["hash"], ordered[a:b]), len(file["hash"]) - 1)
                same = np.flatnonzero((file["hash"][at] == ordered[a:b]) & (file["check"][at] == check[a:b]))
                at = at[same]
                sizes = file["start"][at + 1] - file["start"][at]
                pool.append(gather(file["ids"], file["start"][at], sizes))
                spot = order[a + same]
                start[spot], size[spot] = filled + sections(sizes)[:-1], sizes
                filled += len(pool[-1])
        return np.concatenate(pool) if pool else np.zeros(0, np.uint32), start, size


@lru_cache(maxsize=2)
def _mapped(paths: tuple[str, ...]) -> Dictionary:
    return Dictionary(paths)


class Encoder:
    """``words``: white space is dropped and case is folded by the vocabulary
    itself (``word_bpe_49k.json``), else it is byte-level with spaces kept."""

    def __init__(self, path: str, words: bool, dictionary: tuple[str, ...] = ()):
        self.path, self.words = path, words
        self.known = _mapped(dictionary) if dictionary else None
        self.vocabulary = tokenizer_of(path).get_vocab_size()

    def _all(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if self.known is None:
            ids, sizes = _encoded(self.path, chunks)
            return ids, sections(sizes)[:-1], sizes
        ids, start, size = self.known.look_up(chunks)
        new = np.flatnonzero(size < 0)
        if len(new):
            more, sizes = _encoded(self.path, chunks.take(pa.array(new)))
            start[new], size[new] = len(ids) + sections(sizes)[:-1], sizes
            ids = np.concatenate([ids, more])
        return ids, start, size

    def encode(self, column: pa.Array) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
        """For blocks of rows: the rows, their ids one after the other, and each row's number of ids."""
        for block in blocks(column):
            chunks, first = chunks_of(block, self.words)
            if not len(chunks):
                yield block.rows, np.zeros(0, np.uint32), np.zeros(len(first) - 1, np.int64)
                continue
            coded = chunks.dictionary_encode()
            ids, start, size = self._all(coded.dictionary)
            use = coded.indices.to_numpy(zero_copy_only=False)
            ends = sections(size[use])
            yield block.rows, gather(ids, start[use], size[use]), ends[first[1:]] - ends[first[:-1]]


def shared_dictionary(docs: DataFrame, text: str, path: str, words: bool, most: int = DICTIONARY) -> tuple[str, ...]:
    """Files with the chunks that more than one block of ``docs`` has, the
    most frequent ``most`` of them at most (by blocks); one row per file comes
    to the driver."""
    spark = docs.sparkSession
    root = folder(spark, "chunks")
    bits = (int(spark.conf.get("spark.sql.shuffle.partitions")) - 1).bit_length()
    count = 1 << bits
    schema = pa.schema([("shard", pa.int64()), ("data", pa.binary())])

    def run(batches):
        parts: list[tuple[pa.Array, np.ndarray]] = []

        squeeze = zstandard.ZstdCompressor(level=1).compress

        def flush():
            chunks, n = _counted(parts)
            parts.clear()
            shard = (_hashes(chunks) >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(chunks), np.int64)
            order = np.argsort(shard, kind="stable")
            names, at = np.unique(shard[order], return_index=True)
            data = []
            for a, b in zip(at.tolist(), [*at.tolist()[1:], len(order)]):
                offsets, raw = bytes_of(chunks.take(pa.array(order[a:b])))
                data.append(squeeze(array_bytes({"data": raw, "sizes": np.diff(offsets).astype(np.uint32), "n": n[order[a:b]].astype(np.uint32)})))
            return pa.RecordBatch.from_arrays([pa.array(names), pa.array(data, pa.binary())], schema=schema)

        for batch in batches:
            for block in blocks(string_column(batch, text)):
                chunks = chunks_of(block, words)[0]
                if len(chunks):
                    own = chunks.dictionary_encode().dictionary
                    parts.append((own, np.ones(len(own), np.int64)))
                if sum(len(n) for _, n in parts) > GATHERED:
                    yield flush()
        if parts:
            yield flush()

    def file(group: pa.Table) -> pa.Table:
        shard, parts, expand = group.column("shard")[0].as_py(), [], zstandard.ZstdDecompressor().decompress
        for x in group.column("data"):
            a = arrays_of(expand(x.as_buffer()))
            parts.append((pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(a["sizes"]), [
                None, pa.py_buffer(sections(a["sizes"])), pa.py_buffer(a["data"])]), a["n"]))
        chunks, n = _counted(parts)
        rows = np.flatnonzero(n > 1)
        rows = rows[np.argsort(-n[rows], kind="stable")[:max(1, most // count)]]
        target = ""
        if len(rows):
            chunks = chunks.take(pa.array(rows))
            h = _hashes(chunks)
            order = np.argsort(h, kind="stable")
            chunks, h = chunks.take(pa.array(order)), h[order]
            lengths = np.diff(bytes_of(chunks)[0]).astype(np.uint32)
            ids, sizes = _encoded(path, chunks)
            target = f"{root}/{shard:06d}"
            arrays = {"hash": h, "check": ((h ^ _CHECK) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)).astype(np.uint32) ^ lengths,
                      "start": sections(sizes), "ids": ids}
            write_file(target, lambda out: write_arrays(out, arrays))
        return pa.table({"shard": [shard], "path": [target]})

    made = kept(docs.select(text).mapInArrow(releasing(run), "shard long, data binary").groupBy("shard").applyInArrow(file, "shard long, path string"), "chunk-files")
    paths = {r.shard: r.path for r in made.collect()}
    return tuple(paths.get(k, "") for k in range(count)) if any(paths.values()) else ()


def with_end(ids: np.ndarray, sizes: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """The same with ``end`` after each row."""
    total = sizes + 1
    out = np.full(len(ids) + len(sizes), end, np.uint32)
    body = np.ones(len(out), bool)
    body[np.cumsum(total) - 1] = False
    out[body] = ids
    return out, total
