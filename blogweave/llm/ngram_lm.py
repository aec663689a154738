"""Language-model scoring with an Elias-Fano n-gram trie.

The model is a word bigram model with Dirichlet smoothing towards add-one
unigrams: P(w|c) = (n(c,w) + mu P(w)) / (n(c) + mu).  A text's tokens are its
words (runs of other than ASCII white space, A-Z lower-cased) and one end; the
end is also what stands before the first word.

It is counted by Spark jobs over all training texts and lies in the shared
folder as files that scoring tasks map into memory:

* vocabulary files by range of the words' 64-bit hashes (the word's id is its
  hash's rank): hashes as an Elias-Fano sequence, counts, and the tokens
  before each word, which place a bigram (c, w) at
  before(c) + n(c) before(w) / N on the line of all N tokens;
* trie files by range of that place, so that a frequent context is split by
  its successors: contexts, monotone pointers to their successors, the
  successors made monotone by adding the last value of the range before, and
  quantised log probabilities.

A look-up finds the context, takes its range from the pointers and searches
for the successor relative to the value before the range.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .elias_fano import EliasFano, array_bytes, arrays_of, map_arrays, write_arrays
from .language_id import held_out
from .store import folder, kept, write_file
from .textblocks import ASCII_LOWER, NOT_SPACE, Block, blocks, map_batches, sections, span_hashes, spans, string_column

MU = 200.0
#: Bigram occurrences a trie file is meant for, and a mapper gathers at once.
SHARD_TOKENS = 1 << 22
#: Log probabilities from 0 down to FLOOR, in 65536 steps.
FLOOR = -24.0

#: The end's "hash": no word has it but with a chance of 2**-64.
END = np.uint64(0x5EED0FE2D0000001)


def tokens(column: pa.Array) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    """Per block: its rows, all tokens' hashes (each row's end included), and
    the first token of each row."""
    for block in blocks(column):
        lower = Block(block.rows, ASCII_LOWER[block.data], block.offsets)
        starts, ends, first = spans(lower, NOT_SPACE)
        n = len(block.offsets) - 1
        at = first + np.arange(n + 1)
        out = np.full(len(starts) + n, END, np.uint64)
        body = np.ones(len(out), bool)
        body[at[1:] - 1] = False
        out[body] = span_hashes(lower.data, starts, ends)
        yield block.rows, out, at


def _add_up(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[starts], np.add.reduceat(counts[order], starts) if len(keys) else counts


def _rows(shard: np.ndarray, keys: np.ndarray, counts: np.ndarray) -> list:
    """One row per shard with its sorted keys, compressed, and their counts;
    ``shard`` does not fall."""
    names, at = np.unique(shard, return_index=True)
    cut = [*at.tolist(), len(shard)]
    data = []
    for a, b in zip(cut, cut[1:]):
        base = keys[a]
        many = np.flatnonzero(counts[a:b] > 1)
        data.append(array_bytes({"base": np.array([base]), **EliasFano.build(keys[a:b] - base, int(keys[b - 1] - base) + 1).arrays("keys"),
                                 "many": many.astype(np.uint32), "counts": counts[a:b][many].astype(np.int64)}))
    return [names.astype(np.int64), pa.array(data, pa.binary())]


def _read_rows(payloads: list) -> tuple[np.ndarray, np.ndarray]:
    keys, counts = [], []
    for p in payloads:
        arrays = arrays_of(p)
        k = EliasFano.of(arrays, "keys").decode() + arrays["base"][0]
        n = np.ones(len(k), np.int64)
        n[arrays["many"]] = arrays["counts"]
        keys.append(k)
        counts.append(n)
    return _add_up(np.concatenate(keys), np.concatenate(counts))


_PARTS = pa.schema([("shard", pa.int64()), ("data", pa.binary())])


def _gathered(column: str, key_of, limit: int):
    """A ``mapInArrow`` function that counts keys over up to ``limit`` tokens
    at a time and yields them by shard; ``key_of(hashes, at)`` gives keys and
    ``shard_of(sorted keys)``."""
    def run(batches):
        waiting, size = [], 0

        def flush(shard_of):
            keys, counts = _add_up(np.concatenate(waiting), np.ones(size, np.int64))
            shard = shard_of(keys)
            return pa.RecordBatch.from_arrays([pa.array(x) if isinstance(x, np.ndarray) else x for x in _rows(shard, keys, counts)], schema=_PARTS)

        shard_of = None
        for batch in batches:
            for _, hashes, at in tokens(string_column(batch, column)):
                keys, shard_of = key_of(hashes, at)
                waiting.append(keys)
                size += len(keys)
                if size >= limit:
                    yield flush(shard_of)
                    waiting, size = [], 0
        if size:
            yield flush(shard_of)
    return run


class Vocabulary:
    """The vocabulary files, mapped; ids are ranks of hashes."""

    def __init__(self, paths: tuple[str, ...], bits: int, sizes: tuple[int, ...]):
        self.bits, self.first = bits, sections(np.array(sizes, np.int64))
        self.files = [map_arrays(p) if n else None for p, n in zip(paths, sizes)]
        self.hashes = [EliasFano.of(f, "hash") if f else None for f in self.files]

    def ids(self, hashes: np.ndarray) -> np.ndarray:
        """Ids of some hashes (-1: unknown)."""
        order = np.argsort(hashes, kind="stable")
        ordered = hashes[order]
        out = np.full(len(hashes), -1, np.int64)
        low = np.uint64(64 - self.bits)
        edges = np.searchsorted(ordered, [np.uint64(k << (64 - self.bits)) for k in range(len(self.files))]) if self.bits else np.zeros(1, np.int64)
        edges = [*edges.tolist(), len(ordered)]
        for k, (a, b) in enumerate(zip(edges, edges[1:])):
            if b > a and self.files[k] is not None:
                part = ordered[a:b]
                found = self.hashes[k].find(part - np.uint64(k << (64 - self.bits)) if self.bits else part)
                out[order[a:b]] = np.where(found >= 0, found + self.first[k], -1)
        return out

    def take(self, name: str, ids: np.ndarray) -> np.ndarray:
        """Counts, or tokens before, of known ids."""
        out = np.zeros(len(ids), np.int64)
        file = np.searchsorted(self.first, ids, side="right") - 1
        for k in np.unique(file):
            here = file == k
            out[here] = self.files[k][name][ids[here] - self.first[k]]
        return out


@lru_cache(maxsize=2)
def _vocabulary(paths: tuple[str, ...], bits: int, sizes: tuple[int, ...]) -> Vocabulary:
    return Vocabulary(paths, bits, sizes)


@lru_cache(maxsize=4096)
def _trie_file(path: str) -> tuple:
    f = map_arrays(path)
    return EliasFano.of(f, "contexts"), EliasFano.of(f, "pointers"), EliasFano.of(f, "successors"), f["codes"]


def _codes(probability: np.ndarray) -> np.ndarray:
    return np.round(np.clip(np.log10(probability) / FLOOR, 0, 1) * 65535).astype(np.uint16)


def _trie_shard(c: np.ndarray, w: np.ndarray, n: np.ndarray, vocabulary: Vocabulary, total: int, mu: float) -> dict:
    size = int(vocabulary.first[-1])
    starts = np.flatnonzero(np.concatenate([[True], c[1:] != c[:-1]]))
    contexts, edges = c[starts], np.append(starts, len(c))
    last = w[edges[1:] - 1] + 1
    before = sections(last)[:-1]                 # the last value of the range before
    monotone = np.repeat(before, np.diff(edges)) + w + 1
    seen = vocabulary.take("count", contexts)
    unigram = (vocabulary.take("count", w) + 1) / (total + size + 1)
    probability = (n + mu * unigram) / (np.repeat(seen, np.diff(edges)) + mu)
    return {**EliasFano.build(contexts, size).arrays("contexts"), **EliasFano.build(edges, len(c) + 1).arrays("pointers"),
            **EliasFano.build(monotone, int(monotone[-1]) + 1).arrays("successors"), "codes": _codes(probability)}


def _look_up(trie: tuple, c: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Log10 probabilities of bigrams in a trie file; NaN where it has none.
    ``c`` does not fall."""
    contexts, pointers, successors, codes = trie
    out = np.full(len(c), np.nan)
    own, index = np.unique(c, return_inverse=True)
    at = contexts.find(own)
    known = at >= 0
    a, b = np.zeros(len(own), np.int64), np.zeros(len(own), np.int64)
    a[known], b[known] = pointers.values(at[known]).astype(np.int64), pointers.values(at[known] + 1).astype(np.int64)
    before = np.zeros(len(own), np.uint64)
    later = a > 0
    before[later] = successors.values(a[later] - 1)
    ask = np.flatnonzero(known[index])
    k = index[ask]
    found = successors.find(before[k] + w[ask].astype(np.uint64) + np.uint64(1))
    inside = (found >= a[k]) & (found < b[k])
    out[ask[inside]] = codes[found[inside]].astype(np.float64) / 65535 * FLOOR
    return out


def _place(vocabulary: Vocabulary, c: np.ndarray, w: np.ndarray, total: int, shards: int) -> np.ndarray:
    """The trie file of each bigram; does not fall as (c, w) rises."""
    cs, ci = np.unique(c, return_inverse=True)
    ws, wi = np.unique(w, return_inverse=True)
    within = vocabulary.take("before", ws) / max(total, 1)
    place = vocabulary.take("before", cs)[ci] + np.floor(vocabulary.take("count", cs)[ci] * within[wi])
    return np.minimum(place * shards // max(total, 1), shards - 1).astype(np.int64)


def fit(training: DataFrame, text: str = "text", mu: float = MU, shard_tokens: int = SHARD_TOKENS) -> dict:
    """Count all of ``training`` and write the model; what comes to the driver
    is one row per file."""
    spark = training.sparkSession
    root = folder(spark, "ngram-model")
    bits = (int(spark.conf.get("spark.sql.shuffle.partitions")) - 1).bit_length()
    low = np.uint64(64 - bits) if bits else None

    def by_hash(hashes, at):
        return hashes, lambda keys: (keys >> low).astype(np.int64) if bits else np.zeros(len(keys), np.int64)

    def vocabulary_file(group: pa.Table) -> pa.Table:
        shard = group.column("shard")[0].as_py()
        keys, counts = _read_rows([x.as_buffer() for x in group.column("data")])
        base = np.uint64(shard << (64 - bits)) if bits else np.uint64(0)
        path = f"{root}/vocabulary-{shard:06d}"
        write_file(path, lambda out: write_arrays(out, {**EliasFano.build(keys - base, 1 << (64 - bits)).arrays("hash"), "count": counts}))
        return pa.table({"shard": [shard], "path": [path], "size": [len(keys)], "tokens": [int(counts.sum())]})

    files = kept(training.select(text).mapInArrow(_gathered(text, by_hash, shard_tokens), "shard long, data binary")
                 .groupBy("shard").applyInArrow(vocabulary_file, "shard long, path string, size long, tokens long"), "ngram-vocabulary")
    made = {r.shard: r for r in files.collect()}
    count = 1 << bits
    total = sum(r.tokens for r in made.values())
    tokens_before = sections(np.array([made[k].tokens if k in made else 0 for k in range(count)], np.int64))

    def with_places(batch):
        for shard, path in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            arrays = dict(map_arrays(path))
            arrays["before"] = tokens_before[shard] + sections(arrays["count"])[:-1]
            write_file(path + ".placed", lambda out: write_arrays(out, arrays))
            yield [pa.array([shard], pa.int64())]

    if made:
        (files.select("shard", "path").repartition(len(made), "shard")
         .mapInArrow(map_batches(pa.schema([("shard", pa.int64())]), with_places), "shard long").count())
    names = tuple(made[k].path + ".placed" if k in made else "" for k in range(count))
    sizes = tuple(made[k].size if k in made else 0 for k in range(count))
    size = sum(sizes)
    shards = max(1, -(-total // shard_tokens))
    wide = np.uint64(max(size, 1))

    def by_place(hashes, at):
        vocabulary = _vocabulary(names, bits, sizes)
        distinct, index = np.unique(hashes, return_inverse=True)
        ids = vocabulary.ids(distinct)[index]
        previous = np.concatenate([[0], ids[:-1]])
        previous[at[:-1]] = vocabulary.ids(np.array([END]))[0]
        keys = previous.astype(np.uint64) * wide + ids.astype(np.uint64)
        return keys, lambda k: _place(vocabulary, (k // wide).astype(np.int64), (k % wide).astype(np.int64), total, shards)

    def trie_file(group: pa.Table) -> pa.Table:
        shard = group.column("shard")[0].as_py()
        keys, counts = _read_rows([x.as_buffer() for x in group.column("data")])
        path = f"{root}/trie-{shard:06d}"
        arrays = _trie_shard((keys // wide).astype(np.int64), (keys % wide).astype(np.int64), counts,
                             _vocabulary(names, bits, sizes), total, mu)
        write_file(path, lambda out: write_arrays(out, arrays))
        return pa.table({"shard": [shard], "path": [path], "size": [len(keys)]})

    tries = kept(training.select(text).mapInArrow(_gathered(text, by_place, shard_tokens), "shard long, data binary")
                 .groupBy("shard").applyInArrow(trie_file, "shard long, path string, size long"), "ngram-tries")
    return {"vocabulary": names, "bits": bits, "sizes": sizes, "tokens": total, "mu": mu, "shards": shards,
            "tries": {r.shard: r.path for r in tries.collect()}}


def score(docs: DataFrame, model: dict, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, the other columns, n_tokens, n_known, train_tokens, base_score, score."""
    names, bits, sizes = model["vocabulary"], model["bits"], model["sizes"]
    total, mu, shards, tries = model["tokens"], model["mu"], model["shards"], model["tries"]
    size = sum(sizes)
    unknown = np.int64(size)       # an id of its own
    others = [f for f in docs.schema.fields if f.name != text]

    def run(batches):
        vocabulary = _vocabulary(names, bits, sizes)
        for batch in batches:
            n = batch.num_rows
            counted, known, base, like = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n), np.zeros(n)
            for rows, hashes, at in tokens(string_column(batch, text)):
                distinct, index = np.unique(hashes, return_inverse=True)
                ids = vocabulary.ids(distinct)
                had = ids >= 0
                count = np.zeros(len(ids), np.int64)
                count[had] = vocabulary.take("count", ids[had])
                unigram = np.log10((count + 1) / (total + size + 1))
                ids = np.where(had, ids, unknown)[index]
                end = vocabulary.ids(np.array([END]))[0] if size else -1
                previous = np.concatenate([[0], ids[:-1]])
                previous[at[:-1]] = end if end >= 0 else unknown
                pair, which = np.unique(previous.astype(np.uint64) * np.uint64(size + 1) + ids.astype(np.uint64), return_inverse=True)
                c, w = (pair // np.uint64(size + 1)).astype(np.int64), (pair % np.uint64(size + 1)).astype(np.int64)
                found = np.full(len(pair), np.nan)
                both = np.flatnonzero((c < size) & (w < size))
                if len(both):
                    file = _place(vocabulary, c[both], w[both], total, shards)
                    edges = np.searchsorted(file, np.arange(shards + 1))
                    for k in np.unique(file):
                        part = both[edges[k]:edges[k + 1]]
                        if int(k) in tries:
                            found[part] = _look_up(_trie_file(tries[int(k)]), c[part], w[part])
                missing = np.isnan(found)
                seen = np.zeros(len(pair))
                inside = missing & (c < size)
                seen[inside] = vocabulary.take("count", c[inside])
                back_off = np.log10(mu / (seen + mu))
                per_token = np.where(missing[which], back_off[which] + unigram[index], found[which])
                for target, value in ((counted, np.ones(len(hashes), np.int64)), (known, had[index].astype(np.int64)),
                                      (base, unigram[index]), (like, per_token)):
                    target[rows] = np.add.reduceat(value, at[:-1])       # a row has one token at least
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(counted), pa.array(known), pa.array(np.full(n, total, np.int64)), pa.array(base), pa.array(like)],
                names=[*[f.name for f in others], "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    spark_schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in others]
                             + ["n_tokens long", "n_known long", "train_tokens long", "base_score double", "score double"])
    return docs.select(*[F.col(f"`{f.name}`") for f in others], text).mapInArrow(run, spark_schema)


def score_documents(docs: DataFrame, **options) -> DataFrame:
    """doc_id, held_out and scores of every row of ``docs``, learned from the
    rows that are not held out.  Null and empty texts have the end alone;
    without training rows everything is unknown (train_tokens 0); repeated
    rows count and are scored each; other columns are ignored."""
    out = held_out(F.col("doc_id"), 7, 2)
    model = fit(docs.filter(~out).select("text"), **options)
    return score(docs.select("doc_id", out.alias("held_out"), "text"), model)
