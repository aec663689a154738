"""Language identification by segmentation-marginalised unigrams.

Each language has a probability for every piece of a fixed public vocabulary
(``piece_bpe_32k.model``, single bytes included, so that every word can be
segmented).  A word's probability in a language is the sum over all its
segmentations into pieces, found by a forward pass over its bytes; a text's
is the product over its words.  The pieces' probabilities are fitted by
expectation maximisation, with expected counts from the forward and backward
passes over the words of a bounded sample of labelled documents.

Words are runs of lower-cased letters (and of anything beyond ASCII), of any
length: every ``SPAN`` bytes of a word the sums are scaled to 1 at that place,
and the scales' logarithms add up.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import kept
from .textblocks import Block, blocks, bytes_of, map_batches, releasing, sections, span_strings, spans, string_column

#: Bytes between two scalings; at least the length of any piece.
SPAN = 32
#: A lattice is many times its words' size: smaller blocks than elsewhere.
BLOCK_BYTES, FIT_BYTES = 2 << 20, 1 << 20
#: Distinct words of a block that are scored at a time, in bytes.
SCORE_BYTES = 1 << 16
#: Keeps products over ``SPAN`` bytes near 1: the usual probability of a byte.
PER_BYTE = 0.1

LETTER = np.zeros(256, bool)
LETTER[97:123] = LETTER[65:91] = LETTER[128:] = True


def vocabulary_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


def _pieces(path: str) -> list[tuple[int, bytes]]:
    """The pieces that can occur in a word, as (id, bytes).  Pieces that
    lower-casing changes cannot, and are left out with those of over ``SPAN``
    bytes; a word's start is a space."""
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    out = []
    for i in range(model.get_piece_size()):
        if model.is_control(i) or model.is_unknown(i):
            continue
        name = model.id_to_piece(i)
        piece = bytes([int(name[1:-1], 16)]) if model.is_byte(i) else name.replace("▁", " ").encode()
        if model.is_byte(i) or name.lower() == name and len(piece) <= SPAN:
            out.append((i, piece))
    return out


@lru_cache(maxsize=2)
def _lengths(path: str) -> np.ndarray:
    """Each piece's bytes (0: cannot occur); all that the driver needs of the vocabulary."""
    import sentencepiece
    out = np.zeros(sentencepiece.SentencePieceProcessor(model_file=path).get_piece_size(), np.int64)
    for i, piece in _pieces(path):
        out[i] = len(piece)
    return out


@lru_cache(maxsize=2)
def _trie(path: str) -> tuple[np.ndarray, np.ndarray]:
    """Successors by byte (0: none) of the nodes that have any, which come
    first, and the piece that ends at each node (-1: none)."""
    nodes: list[dict[int, int]] = [{}]
    ends: dict[int, int] = {}
    for i, piece in _pieces(path):
        at = 0
        for b in piece:
            if b not in nodes[at]:
                nodes[at][b] = len(nodes)
                nodes.append({})
            at = nodes[at][b]
        ends.setdefault(at, i)
    inner = [n for n, by in enumerate(nodes) if by or not n]
    number = np.zeros(len(nodes), np.uint16 if len(nodes) <= 1 << 16 else np.int32)
    number[inner + [n for n, by in enumerate(nodes) if n and not by]] = np.arange(len(nodes))
    follow = np.zeros((len(inner), 256), number.dtype)
    for row, n in zip(follow, inner):
        for b, to in nodes[n].items():
            row[b] = number[to]
    piece_at = np.full(len(nodes), -1, np.int32)
    for n, i in ends.items():
        piece_at[number[n]] = i
    return follow, piece_at


class Lattice:
    """All pieces within each of some words (a binary array), ordered by the
    place in the word where they start.

    A word has a node before each of its bytes and one at its end.  Sums of
    segmentations up to a node are kept over the product of the word's scales
    so far (``norm``: one per word, ``SPAN`` bytes and language; the first is 1).
    """

    def __init__(self, words: pa.Array, path: str):
        follow, piece_at = _trie(path)
        offsets, data = bytes_of(words)
        n = len(words)
        spaced = np.full(len(data) + n, 32, np.uint8)          # a space before each word
        body = np.ones(len(spaced), bool)
        first = offsets[:-1] + np.arange(n)
        body[first] = False
        spaced[body] = data
        self.size = np.diff(offsets) + 1
        self.node = first + np.arange(n)                        # lattice node of a word's start
        self.nodes = len(spaced) + n
        longest = int(self.size.max()) if n else 0
        place = (np.arange(len(spaced)) - np.repeat(first, self.size)).astype(np.int16 if longest < 1 << 15 else np.int64)
        word = np.repeat(np.arange(n, dtype=np.int32), self.size)
        left = np.minimum(self.size[word] - place, SPAN + 1).astype(np.int8)
        live, state, length = np.arange(len(spaced)), np.zeros(len(spaced), np.int32), 0
        found: list[tuple] = []
        while len(live):
            state = follow[state, spaced[live + length]]
            length += 1
            hit = np.flatnonzero(piece_at[state] >= 0)
            at = live[hit]
            found.append((place[at], (at + word[at]).astype(np.int32), np.full(len(at), length, np.int32), piece_at[state[hit]]))
            go = (state > 0) & (state < len(follow)) & (left[live] > length)
            live, state = live[go], state[go]
        if found:
            where, self.source, span, self.piece = (np.concatenate(x) for x in zip(*found))
        else:
            where = self.source = span = self.piece = np.zeros(0, np.int32)
        order = np.argsort(where, kind="stable")
        self.source, self.piece, where = self.source[order], self.piece[order], where[order]
        self.target = self.source + span[order]
        self.steps = np.searchsorted(where, np.arange(longest + 1))
        self.spans = sections(self.size // SPAN + 1)            # first scale of each word
        # arcs into the next SPAN bytes are taken over the scale found there
        self.crossing = np.flatnonzero(where % SPAN + span[order] >= SPAN)
        at = self.source[self.crossing]
        self.scale = self.spans[np.searchsorted(self.node, at, "right") - 1] + where[self.crossing] // SPAN + 1

    def forward(self, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Summed weight of all segmentations up to each node, and the scales."""
        a, norm = np.zeros((self.nodes, weight.shape[1])), np.ones((self.spans[-1], weight.shape[1]))
        a[self.node] = 1.0
        live = np.arange(len(self.size))
        for place in range(len(self.steps)):
            if place and place % SPAN == 0:
                live = live[self.size[live] >= place]
                at = self.node[live] + place
                norm[self.spans[live] + place // SPAN] = now = a[at]
                ahead = np.minimum(at[:, None] + np.arange(SPAN), (self.node + self.size)[live][:, None])
                a[ahead] = a[ahead] / now[:, None]
            i, j = self.steps[place:place + 2] if place + 1 < len(self.steps) else (0, 0)
            if j > i:   # the targets of one step are distinct
                a[self.target[i:j]] += a[self.source[i:j]] * weight[self.piece[i:j]]
        return a, norm

    def expected(self, weight: np.ndarray, seen: np.ndarray) -> np.ndarray:
        """How often each piece is used, over all segmentations by their share,
        where the words are seen so many times; one language."""
        a, norm = (x[:, 0] for x in self.forward(weight[:, None]))
        arc = weight[self.piece]
        arc[self.crossing] /= norm[self.scale]
        end, b = self.node + self.size, np.zeros(self.nodes)
        b[end] = 1 / a[end]                                     # sums from each node to the end, over the whole sum
        for i, j in zip(self.steps[-2::-1], self.steps[:0:-1]):
            if j > i:
                np.add.at(b, self.source[i:j], b[self.target[i:j]] * arc[i:j])
        return np.bincount(self.piece, a[self.source] * arc * b[self.target] * np.repeat(seen, self.size + 1)[self.source], len(weight))

    def log_likelihood(self, weight: np.ndarray) -> np.ndarray:
        """Per word and language, with weights scaled by ``PER_BYTE``."""
        a, norm = self.forward(weight)
        total = np.log(a[self.node + self.size]) + self.size[:, None] * math.log(PER_BYTE)
        return total + np.add.reduceat(np.log(norm), self.spans[:-1], axis=0) if len(total) else total


def word_likelihoods(words: pa.Array, weight: np.ndarray, path: str) -> np.ndarray:
    """Log likelihood per word and language, a lattice of some words at a time."""
    part = bytes_of(words)[0][:-1] // SCORE_BYTES
    edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(words)]
    return np.concatenate([Lattice(words.slice(i, j - i), path).log_likelihood(weight) for i, j in zip(edges, edges[1:])])


def scaled(probability: np.ndarray, path: str) -> np.ndarray:
    return probability * (1 / PER_BYTE) ** _lengths(path)[:, None]


def _words(block: Block) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct words, each word's index among them, first word of each row."""
    starts, ends, first = spans(block, LETTER)
    coded = span_strings(block, starts, ends, LETTER).dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy(zero_copy_only=False), first


def word_counts(df: DataFrame, label: str, text: str) -> DataFrame:
    """(label, word, n) over lower-cased texts."""
    schema = pa.schema([("label", pa.string()), ("word", pa.large_binary()), ("n", pa.int64())])

    def work(batch):
        texts = pc.utf8_lower(string_column(batch, text))
        labels = batch.column(batch.schema.get_field_index(label)).cast(pa.string()).dictionary_encode()
        code = labels.indices.to_numpy(zero_copy_only=False)
        for block in blocks(texts, BLOCK_BYTES):
            words, index, first = _words(block)
            key = np.repeat(code[block.rows], np.diff(first)).astype(np.int64) * max(1, len(words)) + index
            pair, n = np.unique(key, return_counts=True)
            yield [labels.dictionary.take(pa.array(pair // max(1, len(words)))).cast(pa.string()),
                   words.take(pa.array(pair % max(1, len(words)))), n]

    return (df.select(label, text).mapInArrow(map_batches(schema, work), "label string, word binary, n long")
            .groupBy("label", "word").agg(F.sum("n").alias("n")))


def fit(labelled: DataFrame, label: str, text: str, row_key: Column, sample_per_label: int = 1500,
        rounds: int = 3, smoothing: float = 0.05, path: str | None = None) -> dict:
    """Piece probabilities per language.

    At most about ``sample_per_label`` rows of each label are learned from
    (those with the lowest hashes of ``row_key``, by a threshold found from
    the label's count); null labels and texts are left out.  The label set
    and the vocabulary bound what reaches the driver.
    """
    path = path or vocabulary_path()
    rows = labelled.filter(F.col(label).isNotNull() & F.col(text).isNotNull())
    sizes = {r[0]: r[1] for r in rows.groupBy(label).count().collect()}
    names = sorted(sizes)
    if not names:
        return {"names": [], "probability": np.zeros((0, 0)), "path": path}
    share = F.create_map(*[F.lit(x) for k in names for x in (k, min(1.0, sample_per_label / sizes[k]))])
    draw = F.pmod(F.xxhash64(row_key), F.lit(1_000_003)) / 1_000_003.0
    counts = kept(word_counts(rows.filter(draw < share[F.col(label)]), label, text), "langid-words")
    size = len(_lengths(path))
    probability = np.full((size, len(names)), 1.0 / size)
    schema = pa.schema([("label", pa.string()), ("piece", pa.int32()), ("n", pa.float64())])
    for _ in range(rounds):
        weight = scaled(probability, path)

        def expected(batch, weight=weight):
            labels = np.asarray(batch.column(0).to_pylist(), dtype=object)
            n = batch.column(2).to_numpy(zero_copy_only=False)
            words = batch.column(1).cast(pa.large_binary())
            for k, name in enumerate(names):
                rows = np.flatnonzero(labels == name)
                some = words.take(pa.array(rows))
                part = bytes_of(some)[0][:-1] // FIT_BYTES
                seen = sum((Lattice(some.take(pa.array(at)), path).expected(weight[:, k], n[rows[at]])
                            for at in np.split(np.arange(len(rows)), np.flatnonzero(np.diff(part)) + 1)), np.zeros(size))
                hit = np.flatnonzero(seen)
                yield [pa.array([name] * len(hit), pa.string()), hit.astype(np.int32), seen[hit]]

        got = (counts.mapInArrow(map_batches(schema, expected), "label string, piece int, n double")
               .groupBy("label", "piece").agg(F.sum("n").alias("n")).toPandas())
        seen = np.zeros_like(probability)
        seen[got["piece"].to_numpy(), [names.index(x) for x in got["label"]]] = got["n"].to_numpy()
        probability = (seen + smoothing) / (seen.sum(axis=0) + smoothing * size)
    return {"names": names, "probability": probability, "path": path}


def predict(df: DataFrame, text: str, model: dict, keep_text: bool = False) -> DataFrame:
    """``df``'s other columns (and ``text``, if it is kept), then lang_pred and
    score (the predicted language's share of the likelihood over all languages).

    A text that is null, empty or without a letter is ``und`` with score 0,
    and so is every text if no language was learned.  Ties go to the first
    language by name.
    """
    names, path = model["names"], model["path"]
    weight = scaled(model["probability"], path) if names else None
    others = [f for f in df.schema.fields if f.name != text]
    carried = df.select(*[F.col(f"`{f.name}`") for f in others], text)
    given = carried.schema.fields if keep_text else others
    spark_schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in given] + ["lang_pred string", "score double"])

    def run(batches):
        for batch in batches:
            texts = string_column(batch, text)
            lower = pc.utf8_lower(texts)
            pred, score = np.full(batch.num_rows, "und", dtype=object), np.zeros(batch.num_rows)
            for block in blocks(lower, BLOCK_BYTES) if names else ():
                words, index, first = _words(block)
                if not len(index):
                    continue
                per_word = word_likelihoods(words, weight, path)[index]
                total = np.zeros((len(per_word) + 1, len(names)))
                np.cumsum(per_word, axis=0, out=total[1:])
                like = total[first[1:]] - total[first[:-1]]
                best = like.argmax(axis=1)
                share = 1 / np.exp(like - like.max(axis=1, keepdims=True)).sum(axis=1)
                sure = np.zeros(len(block.data) + 1, np.int64)
                np.cumsum(LETTER[block.data] & (block.data < 128), out=sure[1:])
                known = sure[block.offsets[1:]] > sure[block.offsets[:-1]]
                for i in np.flatnonzero(~known & (np.diff(first) > 0)):
                    known[i] = any(c.isalpha() for c in lower[block.rows.start + int(i)].as_py())
                rows = np.arange(block.rows.start, block.rows.stop)[known]
                pred[rows], score[rows] = np.asarray(names, dtype=object)[best[known]], share[known]
            yield pa.RecordBatch.from_arrays(
                batch.columns[:len(given)] + [pa.array(pred, pa.string()), pa.array(score)],
                names=[f.name for f in given] + ["lang_pred", "score"])

    return carried.mapInArrow(releasing(run), spark_schema)


def held_out(key: Column, modulus: int, remainder: int) -> Column:
    """crc32 of the key's text, modulo; a null key is not held out."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % modulus == remainder, F.lit(False))


def identify_languages(docs: DataFrame, **options) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row of ``docs``; learned
    from the text and lang of rows that are not held out.  Repeated rows stay
    repeated, extra columns are ignored, an empty table gives no rows."""
    out = held_out(F.col("doc_id"), 5, 0)
    model = fit(docs.filter(~out).select("doc_id", "text", "lang"), "lang", "text", F.col("doc_id"), **options)
    return predict(docs.select("doc_id", out.alias("held_out"), "text"), "text", model)


def keep_identified(docs: DataFrame, least_score: float = 0.5, **options) -> DataFrame:
    """The rows whose language is found with that score at least, with all
    their columns; where no language can be learned, nothing is left out."""
    model = fit(docs.filter(~held_out(F.col("doc_id"), 5, 0)).select("doc_id", "text", "lang"), "lang", "text", F.col("doc_id"), **options)
    if not model["names"]:
        return docs
    named = [(f"c{i}", c) for i, c in enumerate(docs.columns)]          # apart from the names that are added
    found = predict(docs.select(*[F.col(f"`{c}`").alias(n) for n, c in named]), dict((c, n) for n, c in named)["text"], model, keep_text=True)
    return (found.filter((F.col("lang_pred") != "und") & (F.col("score") >= least_score))
            .select(*[F.col(n).alias(c) for n, c in named]))
