"""Token ids as fixed-width bit-packed files.

A shard holds documents in ascending order of their id.  Token ids are stored
in the fewest bits that the vocabulary needs, most significant bit first, in
blocks of ``BLOCK_IDS`` ids that each start on a byte; then follow the blocks'
byte offsets, the documents' ids (with a flag for null ones), the documents'
first token ids' places, and a footer of fixed size:

    blocks | offsets u64[blocks + 1] | doc ids i64[docs] | null flags u8[docs]
    | starts u64[docs + 1] | footer: magic, bits, ids a block, docs, ids, blocks

Any document, or any range of ids, is read by seeking to its blocks.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .encode import BYTE_BPE, Encoder, public_path, shared_dictionary, with_end
from .store import folder, kept, open_file, write_file
from .textblocks import sections, string_column

BLOCK_IDS = 1 << 16
_FOOTER = struct.Struct("<8sIIQQQ")
_MAGIC = b"BWPACK01"


def width(vocabulary: int) -> int:
    """Bits that the ids below ``vocabulary`` need."""
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    if bits in (8, 16, 32):
        return ids.astype(f">u{bits // 8}").tobytes()
    each = np.unpackbits(ids.astype(">u4").view(np.uint8).reshape(-1, 4), axis=1)[:, 32 - bits:]
    return np.packbits(each.reshape(-1)).tobytes()


def unpack(data: bytes, bits: int, n: int) -> np.ndarray:
    if bits in (8, 16, 32):
        return np.frombuffer(data, f">u{bits // 8}", n).astype(np.uint32)
    each = np.zeros((n, 32), np.uint8)
    each[:, 32 - bits:] = np.unpackbits(np.frombuffer(data, np.uint8), count=n * bits).reshape(n, bits)
    return np.packbits(each, axis=1).view(">u4").reshape(-1).astype(np.uint32)


def write_shard(out, parts: Iterator[tuple[list, np.ndarray, np.ndarray]], bits: int) -> tuple[int, int]:
    """``parts``: document ids, token ids, token ids of each document.
    Returns the numbers of documents and ids."""
    keys, sizes, offsets, rest = [], [], [0], np.zeros(0, np.uint32)

    def put(ids: np.ndarray) -> None:
        data = pack(ids, bits)
        out.write(data)
        offsets.append(offsets[-1] + len(data))

    for key, ids, size in parts:
        keys.extend(key)
        sizes.append(size)
        rest = np.concatenate([rest, ids])
        whole = len(rest) // BLOCK_IDS * BLOCK_IDS
        for i in range(0, whole, BLOCK_IDS):
            put(rest[i:i + BLOCK_IDS])
        rest = rest[whole:]
    if len(rest):
        put(rest)
    starts = sections(np.concatenate(sizes) if sizes else np.zeros(0, np.int64))
    out.write(np.array(offsets, "<u8").tobytes())
    out.write(np.array([k or 0 for k in keys], "<i8").tobytes())
    out.write(np.array([k is None for k in keys], "u1").tobytes())
    out.write(starts.astype("<u8").tobytes())
    out.write(_FOOTER.pack(_MAGIC, bits, BLOCK_IDS, len(keys), int(starts[-1]), len(offsets) - 1))
    return len(keys), int(starts[-1])


class Shard:
    """Random access to a shard in an open seekable file."""

    def __init__(self, file):
        self.file = file
        size = file.seek(0, 2)
        file.seek(size - _FOOTER.size)
        magic, self.bits, self.each, self.docs, self.ids, self.blocks = _FOOTER.unpack(file.read(_FOOTER.size))
        if magic != _MAGIC:
            raise ValueError("not a packed shard")
        tail = 8 * (self.blocks + 1) + 17 * self.docs + 8
        file.seek(size - _FOOTER.size - tail)
        data = file.read(tail)
        a, b = 8 * (self.blocks + 1), 8 * (self.blocks + 1) + 8 * self.docs
        self.offsets = np.frombuffer(data, "<u8", self.blocks + 1).astype(np.int64)
        self.keys = np.frombuffer(data, "<i8", self.docs, a)
        self.null = np.frombuffer(data, "u1", self.docs, b).astype(bool)
        self.starts = np.frombuffer(data, "<u8", self.docs + 1, b + self.docs).astype(np.int64)

    def read(self, start: int, stop: int) -> np.ndarray:
        """Ids start to stop of the shard."""
        if stop <= start:
            return np.zeros(0, np.uint32)
        first, last = start // self.each, (stop - 1) // self.each
        self.file.seek(int(self.offsets[first]))
        data = self.file.read(int(self.offsets[last + 1] - self.offsets[first]))
        parts = [unpack(data[self.offsets[k] - self.offsets[first]:self.offsets[k + 1] - self.offsets[first]], self.bits,
                        min(self.each, self.ids - k * self.each)) for k in range(first, last + 1)]
        return np.concatenate(parts)[start - first * self.each:stop - first * self.each]


def write_packed(docs: DataFrame, path: str, end: int, key: str = "doc_id", text: str = "text",
                 tokenizer: str | None = None) -> DataFrame:
    """Encode every text and write shards below ``path``, in ascending order
    of ``key`` (ties by the text's hash, nulls first).  Returns one row per
    shard: shard, path, docs, ids, start (ids of all shards before it)."""
    tokenizer = tokenizer or public_path(BYTE_BPE)
    dictionary = shared_dictionary(docs, text, tokenizer, words=False)

    def run(batches):
        first = next((b for b in batches if b.num_rows), None)
        if first is None:
            return
        encoder = Encoder(tokenizer, False, dictionary)
        bits = width(max(encoder.vocabulary, end + 1))

        def parts():
            for batch in (b for source in ((first,), batches) for b in source):
                keys = batch.column(0).to_pylist()
                for rows, ids, sizes in encoder.encode(string_column(batch, text)):
                    yield keys[rows], *with_end(ids, sizes, end)

        shard = TaskContext.get().partitionId()
        target, made = f"{path}/shard-{shard:06d}.bin", []
        write_file(target, lambda out: made.append(write_shard(out, parts(), bits)))
        yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int64()), pa.array([target]), pa.array([made[0][0]], pa.int64()),
                                          pa.array([made[0][1]], pa.int64())], names=["shard", "path", "docs", "ids"])

    order = [F.col(key).asc_nulls_first(), F.xxhash64(text)]
    shards = kept(docs.select(F.col(key).cast("long").alias(key), text).repartitionByRange(*order).sortWithinPartitions(*order)
                  .mapInArrow(run, "shard long, path string, docs long, ids long"), "packed-shards")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)   # a row per shard, not per document
    return shards.withColumn("start", F.coalesce(F.sum("ids").over(before), F.lit(0)).cast("long"))


def read_packed(shards: DataFrame, key: str = "doc_id", ids_at_once: int = 1 << 20) -> DataFrame:
    """Per document, from the files: key, start, n_tokens, ids_crc32."""
    def run(batches):
        for batch in batches:
            for path, before in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with open_file(path) as file:
                    shard = Shard(file)
                    i = 0
                    while i < shard.docs:
                        j = int(np.searchsorted(shard.starts, shard.starts[i] + ids_at_once, side="right")) - 1
                        j = min(max(i + 1, j), shard.docs)
                        at = shard.starts[i:j + 1] - shard.starts[i]
                        ids = shard.read(int(shard.starts[i]), int(shard.starts[j])).astype("<u4")
                        crc = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(at[:-1], at[1:])]
                        yield pa.RecordBatch.from_arrays([
                            pa.array(shard.keys[i:j], pa.int64(), mask=shard.null[i:j]), pa.array(shard.starts[i:j] + before),
                            pa.array(np.diff(at)), pa.array(crc, pa.int64())], names=[key, "start", "n_tokens", "ids_crc32"])
                        i = j

    n = max(1, shards.count())
    return (shards.select("path", "start", "shard").repartition(n, "shard").select("path", "start")
            .mapInArrow(run, f"`{key}` long, start long, n_tokens long, ids_crc32 long"))


def pack_tokens(docs: DataFrame, end: int = 2, **options) -> DataFrame:
    """Write ``docs`` and read the files back: a row per row of ``docs``.
    Null texts are empty and have the end id alone; a null doc_id sorts first;
    other columns are ignored; an empty table gives no file and no row."""
    return read_packed(write_packed(docs, folder(docs.sparkSession, "packed"), end, **options))
