"""Benchmark decontamination by template canonicalisation.

A text becomes a sequence of tokens in which numbers (digits, number words),
names (capitalised words within a sentence) and units (after a number) are
typed placeholders, each keeping its value as a slot.  Windows of ``WINDOW``
tokens of the documents and of the benchmark are joined by their hash; a
window needs ``LITERALS`` tokens that are no placeholders.  Matches of a
document and an item at one distance are a leak if a window matches without
slots, or if the slots agree: each value of the item always stands for the
same value of the document, and the other way round.  That finds questions
whose numbers, names or units were exchanged, and leaves out chance matches
whose values contradict each other.

Where no such window matches at a distance, two others count: one whose words
are all the same, whatever their types (a name that begins a sentence is no
placeholder, and a window of names and numbers only has no template); and, for
an item that has no window of enough literals but ``WHOLE`` of them in all, its
windows of fewer, if all of them match and the slots agree.  Of fewer than
``WHOLE`` tokens, only windows with a literal count.

The benchmark's windows reach the tasks as a bitmap of a fixed size, whatever
their number; windows that hit it are joined exactly.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bitmaps import bitmap_of, passes
from .license_scan import WordIndex, _hash_words
from .store import kept
from .textblocks import ALNUM, ASCII_LOWER, Block, blocks, map_batches, mix, span_hashes, spans, string_column, windows

WINDOW, LITERALS, WHOLE = 8, 5, 3
# Kinds of windows: enough literals; by all words; fewer literals, by template.
ENOUGH, SAME, TEMPLATE = 0, 1, 2

# Words that are numbers, and words that are units when a number stands before them.
NUMBER_WORDS = ("zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen "
                "eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion").split()
UNITS = ("mm cm m km in inch inches ft foot feet yd yard yards mi mile miles mg g kg t oz lb lbs pound pounds ton tons ml l liter liters "
         "litre litres gallon gallons s sec second seconds min minute minutes h hr hour hours day days week weeks month months year years "
         "c f k degree degrees percent usd eur gbp dollar dollars euro euros cent cents mph kmh hz khz mhz ghz b kb mb gb tb v w kw a j n pa").split()

NUM, NAME, UNIT = np.uint64(0xA11CE0000001), np.uint64(0xA11CE0000002), np.uint64(0xA11CE0000003)
_DIGIT, _SMALL, _BIG, _STOP, _BLANK = (np.zeros(256, bool) for _ in range(5))
_DIGIT[48:58] = _SMALL[97:123] = _BIG[65:91] = True
_STOP[[33, 46, 63, 58, 10, 13]] = True          # a sentence starts after these
_BLANK[[9, 32, 34, 39, 40, 41, 45]] = True      # looked through on the way back to them


class Canonical:
    """A block's tokens: ``code`` (hash of the lower-case word, or the
    placeholder's type), ``slot`` (0: literal, else 1 to 3), spans and rows."""

    def __init__(self, block: Block, numbers: WordIndex, units: WordIndex):
        data = block.data
        self.lower = ASCII_LOWER[data]
        self.starts, self.ends, self.first = spans(Block(block.rows, self.lower, block.offsets), ALNUM)
        n = len(self.starts)
        self.row = np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))
        word = span_hashes(self.lower, self.starts, self.ends)
        digits = np.zeros(len(data) + 1, np.int64)
        np.cumsum(_DIGIT[data], out=digits[1:])
        number = digits[self.ends] - digits[self.starts] == self.ends - self.starts
        number[numbers.hits(word)[0]] = True
        after = np.zeros(n, bool)
        after[1:] = number[:-1] & (self.row[1:] == self.row[:-1])
        unit = np.zeros(n, bool)
        unit[units.hits(word)[0]] = True
        unit &= after & ~number
        second = data[np.minimum(self.starts + 1, max(len(data) - 1, 0))]
        capital = _BIG[data[self.starts]] & _SMALL[second] & (self.ends - self.starts > 1)
        # a capitalised word is a name unless a sentence starts there
        name = np.zeros(n, bool)
        at = np.flatnonzero(capital & ~number & ~unit)
        back = self.starts[at] - 1
        begin = block.offsets[self.row[at]]
        while len(at):
            inside = back >= begin
            stop = np.ones(len(at), bool)
            stop[inside] = _STOP[data[back[inside]]]
            name[at[~stop & ~_BLANK[data[np.maximum(back, 0)]]]] = True
            go = ~stop & _BLANK[data[np.maximum(back, 0)]]
            at, back, begin = at[go], back[go] - 1, begin[go]
        self.slot = number * 1 + name * 2 + unit * 3
        self.code = np.where(number, NUM, np.where(name, NAME, np.where(unit, UNIT, word)))
        self.value = word

    def windows(self, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts, hashes and kinds of the windows; those without literals have no template."""
        hashes = windows(self.code, size)
        start = np.arange(len(hashes))
        literal = np.zeros(len(self.slot) + 1, np.int64)
        np.cumsum(self.slot == 0, out=literal[1:])
        inside, literals = start + size <= self.first[self.row[:len(hashes)] + 1], literal[start + size] - literal[start]
        ok = inside & (literals >= min(LITERALS, size))
        few = inside & ~ok & (literals > 0)
        same = inside & ((literals > 0) | (size >= WHOLE))
        return (np.concatenate([start[ok], start[same], start[few]]),
                np.concatenate([hashes[ok], mix(windows(self.value, size)[same]), hashes[few]]),
                np.repeat(np.array([ENOUGH, SAME, TEMPLATE]), [ok.sum(), same.sum(), few.sum()]))

    def slots(self, start: int, size: int) -> list[str]:
        """The window's slot values, each with its place and type."""
        return [f"{i - start}:{self.slot[i]}:{bytes(self.lower[self.starts[i]:self.ends[i]]).decode('utf-8', 'replace')}"
                for i in range(start, start + size) if self.slot[i]]


def _indexes() -> tuple[WordIndex, WordIndex]:
    return WordIndex(_hash_words(NUMBER_WORDS)), WordIndex(_hash_words(UNITS))


_WINDOWS = pa.schema([("id", pa.int64()), ("at", pa.int64()), ("size", pa.int32()), ("hash", pa.int64()), ("slots", pa.list_(pa.string())),
                     ("kind", pa.int32()), ("need", pa.int32())])
_WINDOWS_SQL = "id long, at long, size int, hash long, slots array<string>, kind int, need int"


def template_windows(df: DataFrame, key: str, text: str, sizes: tuple[int, ...], bitmap: np.ndarray | None) -> DataFrame:
    """Windows of these sizes; only those that hit the bitmap, if one is given.
    Without one, a text shorter than the first size gives one window of all its tokens,
    and ``need`` is the number of windows of kind ``TEMPLATE`` that the text has."""
    numbers, units = _indexes()

    def work(batch):
        ids = batch.column(0).to_pylist()
        for block in blocks(string_column(batch, text)):
            c = Canonical(block, numbers, units)
            length = np.diff(c.first)
            out: list[tuple] = []
            for size in range(1, sizes[0] + 1) if bitmap is None else sizes:
                start, hashes, kind = c.windows(size)
                need = np.zeros(len(length), np.int64)
                if bitmap is None:
                    fits = (length[c.row[start]] >= size) if size == sizes[0] else (length[c.row[start]] == size)
                    whole = np.bincount(c.row[c.slot == 0], minlength=len(length)) >= WHOLE
                    whole[c.row[start[fits & (kind == ENOUGH)]]] = False
                    fits &= (kind != TEMPLATE) | whole[c.row[start]]
                    need = np.bincount(c.row[start[fits & (kind == TEMPLATE)]], minlength=len(length))
                else:
                    fits = passes(bitmap, hashes)
                for i, h, k in zip(start[fits].tolist(), hashes[fits].view(np.int64).tolist(), kind[fits].tolist()):
                    r = int(c.row[i])
                    out.append((ids[block.rows.start + r], i - int(c.first[r]), size, h, c.slots(i, size), k, int(need[r])))
            if out:
                yield [pa.array(x, f.type) for x, f in zip(zip(*out), _WINDOWS)]

    return df.select(F.col(key).cast("long").alias("id"), text).mapInArrow(map_batches(_WINDOWS, work), _WINDOWS_SQL)


def find_leaks(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id",
               item_text: str = "text", window: int = WINDOW) -> DataFrame:
    """One row per document and item that leaks into it: key, item, n_windows
    (places of the document where a window of the item matches), first_token,
    exact (no slot's value was exchanged).

    Null and empty texts and items have no windows; rows without a key or an
    item id take no part; rows that share a key are looked at each and share
    the result; other columns are ignored.
    """
    items = kept(template_windows(benchmark, item, item_text, (window,), None).filter("id IS NOT NULL").distinct(), "benchmark-windows")
    sizes = tuple(sorted((r[0] for r in items.select("size").distinct().collect()), reverse=True))     # at most ``window`` sizes
    if not sizes:
        return docs.sparkSession.createDataFrame([], f"`{key}` long, `{item}` long, n_windows long, first_token long, exact boolean")
    hits = template_windows(docs, key, text, sizes, bitmap_of(items, "hash")).filter("id IS NOT NULL").distinct()
    matched = (hits.alias("d").join(items.alias("b"), (F.col("d.hash") == F.col("b.hash")) & (F.col("d.size") == F.col("b.size"))
                                           & (F.col("d.kind") == F.col("b.kind")))
               .select(F.col("d.id").alias("doc"), F.col("b.id").alias("item"), F.col("d.at").alias("at"),
                       (F.col("d.at") - F.col("b.at")).alias("distance"), "b.kind", "b.need",
                       # a slot's value in the item and in the document: same place, same type
                       F.zip_with("b.slots", "d.slots", lambda x, y: F.struct(
                           F.regexp_replace(x, "^[0-9]+:", "").alias("theirs"), F.regexp_replace(y, "^[0-9]+:", "").alias("ours"))).alias("pairs")))
    # a document's matches with an item at one distance are at most as many as the item has windows
    def of_kind(kind: int, column: str) -> Column:
        return F.collect_set(F.when(F.col("kind") == kind, F.col(column)))

    def one_to_one(pairs: str) -> Column:
        return ((F.size(F.array_distinct(F.transform(pairs, lambda p: p["theirs"]))) == F.size(pairs))
                & (F.size(F.array_distinct(F.transform(pairs, lambda p: p["ours"]))) == F.size(pairs)))

    def unchanged(pairs: str) -> Column:
        return F.forall(pairs, lambda p: p["theirs"] == p["ours"])

    lined = (matched.groupBy("doc", "item", "distance")
             .agg(of_kind(ENOUGH, "at").alias("places"), F.max((F.col("kind") == ENOUGH) & (F.size("pairs") == 0)).alias("plain"),
                  F.array_distinct(F.flatten(of_kind(ENOUGH, "pairs"))).alias("pairs"), of_kind(SAME, "at").alias("same"),
                  of_kind(TEMPLATE, "at").alias("whole"), F.array_distinct(F.flatten(of_kind(TEMPLATE, "pairs"))).alias("exchanged"),
                  F.max("need").alias("need")))
    enough = F.size("places") > 0
    whole = (F.size("whole") > 0) & (F.size("whole") >= F.col("need")) & one_to_one("exchanged")
    found = F.when(enough, F.col("plain") | one_to_one("pairs")).otherwise(whole | (F.size("same") > 0))
    places = F.when(enough, F.col("places")).when(whole, F.col("whole")).otherwise(F.col("same"))
    exact = F.when(enough, unchanged("pairs")).when(whole, unchanged("exchanged")).otherwise(True)
    leaks = lined.filter(found).select("doc", "item", F.size(places).alias("n"), F.array_min(places).alias("first"), exact.alias("exact"))
    return (leaks.groupBy("doc", "item").agg(F.sum("n").cast("long").alias("n_windows"), F.min("first").alias("first_token"), F.max("exact").alias("exact"))
            .withColumnsRenamed({"doc": key, "item": item}))


def keep_clean(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", **options) -> DataFrame:
    """The rows into which no item leaks, with all their columns."""
    leaky = find_leaks(docs, benchmark, key, **options).select(key).distinct()
    return docs.join(leaky, key, "left_anti").select(*docs.columns)
