"""Best-fit packing by sums of squares.

Documents of at most a window's tokens stay whole; only longer ones are cut,
into windows and a rest.  What is shorter than a window is put in a bin so that
the squared numbers of open bins per residual gap add up to least: a bin of
another gap, one that becomes full, or a new one.

Pieces are dealt by hash into groups of a bounded size, and each is packed by
decreasing length.  Bins that are exactly full are done.  The rest of all groups
is dealt again into as many groups as it still needs, round after round, so the
open bins that each group ends with are not left half empty; in the last round
a bin is opened only for what fits into none.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .encode import WORD_BPE, Encoder, public_path, shared_dictionary, with_end
from .store import kept
from .textblocks import sections, string_column

WINDOW = 4096
#: Pieces that are packed by one task at a time.
GROUP_ROWS = 8192


def pieces_of(docs: DataFrame, window: int, end: int, key: str, text: str, tokenizer: str) -> DataFrame:
    """row, key, piece, start, n, ids of every piece, written once; ids are
    little-endian unsigned integers of two bytes, or four if the vocabulary needs them."""
    dictionary = shared_dictionary(docs, text, tokenizer, words=True)

    def run(batches):
        encoder = Encoder(tokenizer, True, dictionary)
        dtype = np.dtype("<u2" if max(encoder.vocabulary, end + 1) <= 1 << 16 else "<u4")
        for batch in batches:
            for rows, ids, sizes in encoder.encode(string_column(batch, text)):
                ids, total = with_end(ids, sizes, end)
                count = -(-total // window)
                doc = np.repeat(np.arange(len(total)), count)
                piece = np.arange(len(doc)) - sections(count)[doc]
                n = np.minimum(window, total[doc] - piece * window)
                column = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(n), [
                    None, pa.py_buffer(sections(n) * dtype.itemsize), pa.py_buffer(ids.astype(dtype))])
                yield pa.RecordBatch.from_arrays([
                    batch.column(0)[rows.start:rows.stop].take(pa.array(doc)), pa.array(piece.astype(np.int32)), pa.array(piece * window),
                    pa.array(n), column.cast(pa.binary())], names=[key, "piece", "start", "n", "ids"])

    coded = docs.select(F.col(key).cast("long").alias(key), text).mapInArrow(
        run, f"`{key}` long, piece int, start long, n long, ids binary")
    return kept(coded.withColumn("row", F.monotonically_increasing_id()), "packing-pieces")


def sum_of_squares(sizes: np.ndarray, window: int, thrifty: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of each size (below ``window``, in this order), and the
    bins' gaps at the end.

    With N(g) open bins of gap g, a size s in a bin of gap g changes the sum of
    squares by 2 (N(g - s) - N(g)) + 2, or by 1 - 2 N(s) if it fills the bin,
    and in a new one by 2 N(window - s) + 1.  Ties go to the smallest gap, a
    new bin last; the oldest of equal bins is taken first.  ``thrifty``: new
    bins only for what fits into no open one."""
    count = np.zeros(window, np.int64)
    having: list[list[int]] = [[] for _ in range(window)]        # open bins by gap
    bins, offsets, gaps = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64), []
    never = np.iinfo(np.int64).max
    for i, s in enumerate(sizes.tolist()):
        there = count[s:]
        cost = 2 * (count[:window - s] - there) + 2
        cost[0] = 1 - 2 * there[0]
        cost[there == 0] = never
        best = int(cost.argmin())
        if cost[best] < never and (thrifty or cost[best] <= 2 * count[window - s] + 1):
            gap, of = best, having[best + s].pop(0)
            count[best + s] -= 1
            offsets[i] = window - best - s
            gaps[of] = gap
        else:
            gap, of = window - s, len(gaps)
            offsets[i] = 0
            gaps.append(gap)
        bins[i] = of
        if gap:
            count[gap] += 1
            having[gap].append(of)
    return bins, offsets, np.array(gaps, np.int64)


def packer(window: int, turn: int, last: bool):
    """Packs one group (row, n, group) in one round."""
    def pack(group: pa.Table) -> pa.Table:
        n, row = group.column("n").to_numpy(), group.column("row").to_numpy()
        order = np.lexsort([row, -n])                 # decreasing, ties by row: the same on every run
        bins, offsets, gaps = sum_of_squares(n[order], window, last)
        first = (turn << 56) + (group.column("group")[0].as_py() << 24)
        return pa.table({"row": row[order], "n": n[order], "sequence_id": first + bins, "offset": offsets,
                         "open": (gaps[bins] > 0) & (not last)})
    return pack


def places(pieces: DataFrame, window: int, group_rows: int = GROUP_ROWS) -> DataFrame:
    """row, sequence_id (from 0), offset of every piece (row, n) that is shorter than the window."""
    done, left = [], pieces.filter(F.col("n") < window).select("row", "n")
    count, turn, stuck = left.count(), 0, False
    while True:
        groups = max(1, -(-count // group_rows))
        last = groups == 1 or stuck
        dealt = left.withColumn("group", F.pmod(F.xxhash64("row", F.lit(turn)), F.lit(groups)))
        got = kept(dealt.groupBy("group").applyInArrow(packer(window, turn, last), "row long, n long, sequence_id long, offset long, open boolean"), "packing-places")
        done.append(got.filter("NOT open").select("row", "sequence_id", "offset"))
        if last:
            break
        still = got.filter("open").count()
        stuck, count, turn = 4 * still > 3 * count, still, turn + 1     # sizes that hardly fill bins: one more round for what is left
        left = got.filter("open").select("row", "n")
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def pack_documents(docs: DataFrame, window: int = WINDOW, end: int = 1, key: str = "doc_id", text: str = "text",
                   tokenizer: str | None = None, group_rows: int = GROUP_ROWS) -> DataFrame:
    """One row per piece: key, piece, start, ids (binary, as in ``pieces_of``),
    length, sequence_id, offset.

    Every id of every row of ``docs`` is in exactly one piece, and no document
    of at most ``window`` ids is cut; a null or empty text is its end id.
    Sequence ids are unique but not dense (those of whole windows are
    negative).  Rows that share a key are packed one by one; null keys stay
    null; other columns are ignored; an empty table gives no row."""
    pieces = pieces_of(docs, window, end, key, text, tokenizer or public_path(WORD_BPE))
    placed = pieces.join(places(pieces, window, group_rows), "row", "left")
    return placed.select(key, "piece", "start", F.col("n").alias("length"), "ids",
                         F.coalesce("sequence_id", -1 - F.col("row")).alias("sequence_id"),
                         F.coalesce("offset", F.lit(0)).cast("long").alias("offset"))


def token_sequences(packed: DataFrame) -> DataFrame:
    """sequence_id, length, ids: the sequences themselves (a group is at most a window)."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    whole = F.aggregate(parts, F.lit(b""), lambda a, p: F.concat(a, p["ids"]))
    return packed.groupBy("sequence_id").agg(F.sum("length").alias("length"), whole.alias("ids"))


def digest(packed: DataFrame, key: str = "doc_id") -> DataFrame:
    """The pieces with the CRC-32 of their ids, as unsigned 32-bit integers, in place of the ids."""
    def run(batches):
        for batch in batches:
            crc = []
            for data, n in zip(batch.column("ids"), batch.column("length").to_pylist()):
                raw = data.as_buffer()
                crc.append(zlib.crc32(np.frombuffer(raw, f"<u{raw.size // n}").astype("<u4").tobytes()))
            columns = dict(zip(batch.schema.names, batch.columns)) | {"ids_crc32": pa.array(crc, pa.int64())}
            yield pa.RecordBatch.from_arrays([columns[n] for n in names], names=names)

    names = [key, "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    return packed.select(key, "piece", "start", "length", "ids", "sequence_id", "offset").mapInArrow(
        run, f"`{key}` long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
