"""Quality classifier by co-training.

A document is good if it is labelled of quality and not toxic.  Two logistic
models look at different things: the content view at which words and signs a
text has (hashed), the metadata view at the page's source, language, length
and layout (shares of kinds of characters, line lengths, repetition), in
bins.  Both start from a bounded sample of labelled documents.  Over some rounds
both score every unlabelled document on the executors, from features written
once, and the different texts that a view is most sure of are handed to the
other one to learn from.  Both are calibrated on labelled documents kept out of
the fits, their calibrated log odds combined there, and every document is
scored.  The driver holds the labelled sample, what was handed over, and the
weights.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import kept
from .textblocks import ALNUM, ASCII_LOWER, NOT_SPACE, Block, blocks, bytes_of, mix, releasing, sections, span_hashes, spans, string_column

#: Hashed words and signs (content view), and cells of the metadata view.
CONTENT_BITS, META_SIZE = 18, 4096
LABELLED = 16_000                         # bound of the labelled documents that are learned from
ROUNDS, HANDED = 3, 400                   # of co-training; documents that a view hands on a round, of all unlabelled ones
SHARE = 0.05                              # and at most this share of them
BLOCK_BYTES = 1 << 20                     # of text, whose features take some fifty times as much at a time
LEAST_DOCUMENTS = 5                       # a word must be in so many documents of the sample to have a weight
CALIBRATION_FOLD = 5                      # one in so many labelled documents is kept for calibration

_SIGNS = NOT_SPACE & ~ALNUM
_UPPER, _DIGIT, _SPACE, _NEWLINE = (np.zeros(256, bool) for _ in range(4))
_UPPER[65:91] = _DIGIT[48:58] = _SPACE[[9, 10, 11, 12, 13, 32]] = _NEWLINE[10] = True
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def _unique_per_row(row: np.ndarray, value: np.ndarray, rows: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of each row: the values, and each row's section."""
    key = np.unique(row.astype(np.int64) * size + value)
    return (key % size).astype(np.int32), np.searchsorted(key, np.arange(rows + 1, dtype=np.int64) * size)


def content_features(block: Block) -> tuple[np.ndarray, np.ndarray]:
    n = len(block.offsets) - 1
    lower = Block(block.rows, ASCII_LOWER[block.data], block.offsets)
    rows, values = [], []
    for member, salt in ((ALNUM, 1), (_SIGNS, 2)):
        starts, ends, first = spans(lower, member)
        h = mix(span_hashes(lower.data, starts, ends) ^ np.uint64(salt))
        rows.append(np.repeat(np.arange(n), np.diff(first)))
        values.append((h >> np.uint64(64 - CONTENT_BITS)).astype(np.int64))
    return _unique_per_row(np.concatenate(rows), np.concatenate(values), n, 1 << CONTENT_BITS)


def layout(block: Block) -> np.ndarray:
    """Per row: log of bytes, of words and of lines, bytes a word, bytes a
    line, shares of upper case, digits, signs and bytes beyond ASCII, share of
    words followed by themselves, distinct words over words."""
    n = len(block.offsets) - 1
    size = np.diff(block.offsets).astype(float)

    def count(member: np.ndarray) -> np.ndarray:
        total = np.zeros(len(block.data) + 1, np.int64)
        np.cumsum(member[block.data], out=total[1:])
        return np.diff(total[block.offsets]).astype(float)

    beyond = np.arange(256) >= 128
    lower = Block(block.rows, ASCII_LOWER[block.data], block.offsets)
    starts, ends, first = spans(lower, ALNUM)
    words = np.diff(first).astype(float)
    h = span_hashes(lower.data, starts, ends)
    row = np.repeat(np.arange(n), np.diff(first))
    again = np.zeros(n)
    if len(h) > 1:
        same = (h[1:] == h[:-1]) & (row[1:] == row[:-1])
        again = np.bincount(row[1:][same], minlength=n).astype(float)
    pair = np.unique(mix(h ^ (row.astype(np.uint64) + np.uint64(1)) * _GOLDEN), return_index=True)[1]
    distinct = np.bincount(row[pair], minlength=n).astype(float)
    lines = count(_NEWLINE) + 1
    some, any_word = np.maximum(size, 1), np.maximum(words, 1)
    return np.stack([np.log1p(size), np.log1p(words), np.log1p(lines), size / any_word, np.log1p(size / lines), count(_UPPER) / some,
                     count(_DIGIT) / some, count(_SIGNS) / some, count(beyond) / some, again / any_word, distinct / any_word], axis=1)


def feature_rows(df: DataFrame) -> DataFrame:
    """doc_id and the other columns but text, source, lang and n_chars; content
    (hashed words), meta (numbers) and category (source and language, hashed)."""
    others = [f for f in df.schema.fields if f.name not in ("text", "source", "lang", "n_chars")]

    def run(batches):
        for batch in batches:
            texts = string_column(batch, "text")
            if not batch.num_rows:
                continue
            columns = [batch.column(batch.schema.get_field_index(f.name)) for f in others]
            for block in blocks(texts, BLOCK_BYTES):
                content, at = content_features(block)
                meta = np.concatenate([layout(block), _declared(batch, block)], axis=1)
                raw, numbers = content.astype("<i4").tobytes(), meta.astype("<f4").tobytes()
                width = 4 * meta.shape[1]
                yield pa.RecordBatch.from_arrays(
                    [c[block.rows.start:block.rows.stop] for c in columns]
                    + [pa.array([raw[4 * i:4 * j] for i, j in zip(at[:-1], at[1:])], pa.binary()),
                       pa.array([numbers[i:i + width] for i in range(0, len(numbers), width)], pa.binary()),
                       pa.array(list(_categories(batch, block)), pa.list_(pa.int32()))],
                    names=[f.name for f in others] + ["content", "meta", "category"])

    kinds = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in others] + ["content binary", "meta binary", "category array<int>"])
    return df.mapInArrow(releasing(run), kinds)


def _declared(batch: pa.RecordBatch, block: Block) -> np.ndarray:
    n = batch.column(batch.schema.get_field_index("n_chars")).cast(pa.float64()).fill_null(0.0).to_numpy(zero_copy_only=False)
    return np.log1p(np.maximum(n[block.rows], 0))[:, None]


def _categories(batch: pa.RecordBatch, block: Block) -> np.ndarray:
    """Cells of the upper half of the metadata view."""
    out = np.zeros((len(block.offsets) - 1, 2), np.int32)
    for j, name in enumerate(("source", "lang")):
        values = batch.column(batch.schema.get_field_index(name)).cast(pa.string()).fill_null("\0").dictionary_encode()
        names = [v.encode() for v in values.dictionary.to_pylist()]
        ends = np.cumsum([len(v) for v in names])
        h = span_hashes(np.frombuffer(b"".join(names), np.uint8), ends - [len(v) for v in names], ends) if names else np.zeros(0, np.uint64)
        cell = META_SIZE // 2 + (mix(h ^ np.uint64(j + 1)) % np.uint64(META_SIZE // 2)).astype(np.int32)
        out[:, j] = cell[values.indices.to_numpy(zero_copy_only=False)[block.rows]]
    return out


class Sparse(NamedTuple):
    """Rows of distinct cells."""
    cells: np.ndarray
    at: np.ndarray

    def take(self, rows: np.ndarray) -> "Sparse":
        sizes = np.diff(self.at)[rows]
        ends = sections(sizes)
        return Sparse(self.cells[np.repeat(self.at[rows] - ends[:-1], sizes) + np.arange(ends[-1])], ends)

    def joined(self, other: "Sparse") -> "Sparse":
        return Sparse(np.concatenate([self.cells, other.cells]), np.concatenate([self.at, other.at[1:] + self.at[-1]]))

    def dot(self, weight: np.ndarray) -> np.ndarray:
        total = np.zeros(len(self.cells) + 1)
        np.cumsum(weight[self.cells], out=total[1:])
        return total[self.at[1:]] - total[self.at[:-1]]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Logistic:
    """Logistic regression on presence of cells, fitted by AdaGrad with an L1
    penalty, which leaves words without weight that tell little."""

    def __init__(self, size: int, epochs: int = 15, rate: float = 0.2, penalty: float = 1.0):
        self.weight, self.bias = np.zeros(size), 0.0
        self.epochs, self.rate, self.penalty = epochs, rate, penalty

    def fit(self, x: Sparse, y: np.ndarray, least: int) -> "Logistic":
        size = len(self.weight)
        self.weight[:] = 0.0
        # only cells of ``least`` rows or more are learned: the fit works on those
        names = np.flatnonzero(np.bincount(x.cells, minlength=size) >= least)
        place = np.full(size, -1, np.int32)
        place[names] = np.arange(len(names), dtype=np.int32)
        cells, sizes = [], []
        for i in range(0, len(x.at) - 1, 1024):              # by rows, so that nothing is as long as the sample but its cells
            at = x.at[i:i + 1025]
            part = place[x.cells[at[0]:at[-1]]]
            total = np.concatenate([[0], np.cumsum(part >= 0)])
            cells.append(part[part >= 0])
            sizes.append(np.diff(total[at - at[0]]))
        x = Sparse(np.concatenate(cells) if cells else np.zeros(0, np.int32), sections(np.concatenate(sizes) if sizes else np.zeros(0, np.int64)))
        share = np.clip(y.mean() if len(y) else 0.5, 1e-3, 1 - 1e-3)
        self.bias = float(np.log(share / (1 - share)))
        weight, squares, order = np.zeros(len(names)), np.full(len(names), 1e-4), np.random.default_rng(7)
        shrink, bias_squares = self.penalty / max(1, len(y)), 1e-4
        for _ in range(self.epochs if len(y) else 0):
            for rows in np.array_split(order.permutation(len(y)), max(1, len(y) // 200)):
                part = x.take(rows)
                error = _sigmoid(part.dot(weight) + self.bias) - y[rows]
                slope = np.bincount(part.cells, np.repeat(error, np.diff(part.at)), len(names)) / len(rows)
                squares += slope ** 2
                step = self.rate / np.sqrt(squares)
                weight -= step * slope
                weight = np.sign(weight) * np.maximum(np.abs(weight) - step * shrink, 0)
                bias_squares += error.mean() ** 2
                self.bias -= self.rate * error.mean() / np.sqrt(bias_squares)
        self.weight[names] = weight
        return self

    def odds(self, x: Sparse) -> np.ndarray:
        return x.dot(self.weight) + self.bias


def _line(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights and bias of a small dense logistic regression (Newton's method with a ridge)."""
    a = np.concatenate([x, np.ones((len(x), 1))], axis=1)
    w = np.concatenate([np.full(x.shape[1], 1.0 / x.shape[1]), [0.0]])
    if len(set(y.tolist())) < 2:
        return w
    prior = w.copy()
    for _ in range(25):
        p = _sigmoid(a @ w)
        slope = a.T @ (p - y) + 1e-2 * (w - prior)
        w = w - np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + 1e-2 * np.eye(len(w)), slope)
    return w


class Views:
    """Features of documents as both models see them; the metadata view's bins
    are those of the first sample."""

    def __init__(self, content: Sparse, meta: np.ndarray, category: np.ndarray, edges: np.ndarray | None = None):
        self.content = content
        self.edges = np.quantile(meta, np.linspace(0, 1, 33)[1:-1], axis=0).T if edges is None else edges
        bins = np.stack([np.searchsorted(e, m) + 32 * j for j, (e, m) in enumerate(zip(self.edges, meta.T))], axis=1)
        both = np.concatenate([bins, category], axis=1).astype(np.int32)
        self.meta = Sparse(both.reshape(-1), np.arange(len(both) + 1) * both.shape[1])

    @classmethod
    def of(cls, table: pa.Table | pa.RecordBatch, edges: np.ndarray | None = None) -> "Views":
        """From the columns of ``feature_rows``, without a copy per document."""
        def binary(name: str, dtype: str) -> tuple[np.ndarray, np.ndarray]:
            column = table.column(name)
            column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
            at, data = bytes_of(column.cast(pa.large_binary()))
            return np.frombuffer(data, dtype), at // 4
        cells, at = binary("content", "<i4")
        numbers, _ = binary("meta", "<f4")
        category = np.array(table.column("category").to_pylist(), np.int32).reshape(table.num_rows, 2)
        return cls(Sparse(cells, at), numbers.reshape(table.num_rows, -1).astype(float), category, edges)


def _draw(key: Column, salt: int, share: float) -> Column:
    """A share of rows by the hash of their key; a null key is drawn like any."""
    return F.pmod(F.xxhash64(F.coalesce(key.cast("string"), F.lit("")), F.lit(salt)), F.lit(1_000_003)) < int(share * 1_000_003) + 1


_COLUMNS = {"doc_id": "long", "text": "string", "lang": "string", "source": "string", "n_chars": "long"}


def _columns(docs: DataFrame) -> list[Column]:
    return [(F.col(f"`{c}`") if c in docs.columns else F.lit(None)).cast(t).alias(c) for c, t in _COLUMNS.items()]


def _odds(features: DataFrame, weights: dict, bias: dict, edges: np.ndarray) -> DataFrame:
    """row, doc_id, text (a hash of the features) and both views' log odds of every document."""
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            views = Views.of(batch, edges)
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index(c)) for c in ("row", "doc_id", "same")]
                + [pa.array(x.dot(weights[v]) + bias[v]) for v, x in (("content", views.content), ("meta", views.meta))],
                names=["row", "doc_id", "same", "content_odds", "meta_odds"])

    return (features.select("row", "doc_id", F.xxhash64("content").alias("same"), "content", "meta", "category")
            .mapInArrow(releasing(run), "row long, doc_id long, same long, content_odds double, meta_odds double"))


def surest(odds: DataFrame, view: str, ups: int, downs: int) -> dict[int, int]:
    """The rows that a view is most sure to be good (1) or not (0), as many as asked for, ties by row."""
    up = odds.orderBy(F.col(f"{view}_odds").desc(), "row").limit(ups).collect()
    down = odds.orderBy(F.col(f"{view}_odds"), "row").limit(downs).collect()
    return {r.row: 0 for r in down} | {r.row: 1 for r in up}


def fit(docs: DataFrame, labels: DataFrame, labelled: int = LABELLED, handed: int = HANDED, rounds: int = ROUNDS,
        share: float = SHARE) -> dict | None:
    """Both views and their combination; None without labelled documents.

    Learns from about ``labelled`` labelled documents at most, drawn by hashes
    of doc_id, and from those of **all** unlabelled documents that the views are
    most sure of: ``handed`` a view and round (at most ``share`` of them), of
    documents with equal words the first.  A document with several labels is
    good if all agree on it; a quality that is null counts as no label unless
    the document is toxic.
    """
    docs = docs.select(*_columns(docs))
    good = F.when(F.coalesce("toxic", F.lit(0)) == 1, 0).when(F.col("quality").isNotNull(), (F.col("quality") == 1).cast("int"))
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), good.alias("good")).filter("doc_id IS NOT NULL AND good IS NOT NULL")
    known = kept(known.groupBy("doc_id").agg(F.min("good").alias("good")), "cotraining-labels")
    n_labels = known.count()
    if not n_labels:
        return None
    features = kept(feature_rows(docs).withColumn("row", F.monotonically_increasing_id()), "cotraining-features")
    first = _draw(F.col("doc_id"), 1, min(1.0, labelled / n_labels))
    few = features.filter(first).join(known.filter(first), "doc_id").dropDuplicates(["doc_id"]).orderBy("doc_id").toArrow()
    if not few.num_rows:
        return None
    views = Views.of(few)
    y = few.column("good").to_numpy().astype(int)
    del few
    mine = np.arange(len(y))
    held = mine[mine % CALIBRATION_FOLD == 0] if len(mine) >= 20 * CALIBRATION_FOLD else mine
    start = np.setdiff1d(mine, held) if len(held) < len(mine) else mine
    sizes = {"content": (1 << CONTENT_BITS, LEAST_DOCUMENTS), "meta": (META_SIZE, 1)}
    learned: dict[str, dict[int, int]] = {v: {} for v in sizes}            # pseudo-labels by row
    models: dict[str, Logistic] = {}
    extra: Views | None = None
    place: dict[int, int] = {}
    for round_ in range(rounds + 1):
        for v, (size, least) in sizes.items():
            rows = sorted(learned[v])
            x = getattr(views, v).take(start)
            if rows:
                x = x.joined(getattr(extra, v).take(np.array([place[r] for r in rows])))
            target = np.concatenate([y[start], [learned[v][r] for r in rows]]).astype(float)
            models[v] = Logistic(size).fit(x, target, min(least, max(1, len(target) // 20)))
        if round_ == rounds:
            break
        weights, bias = {v: m.weight.astype(np.float32) for v, m in models.items()}, {v: m.bias for v, m in models.items()}
        odds = _odds(features, weights, bias, views.edges).join(known.select("doc_id"), "doc_id", "left_anti").filter("doc_id IS NOT NULL")
        odds = kept(odds.groupBy("same").agg(F.min_by(F.struct("row", "content_odds", "meta_odds"), "row").alias("r")).select("r.*"), "cotraining-odds")
        many, rate = min(handed, int(share * odds.count())), y[start].mean()
        ups, downs = int(round(many * rate)), int(round(many * (1 - rate)))
        for v, other in (("content", "meta"), ("meta", "content")):
            for row, label in surest(odds, v, ups, downs).items():
                learned[other].setdefault(row, label)
        wanted = sorted({r for rows in learned.values() for r in rows})
        if not wanted:
            break
        # at most 4 * handed rows a round
        chosen = features.join(F.broadcast(features.sparkSession.createDataFrame([(r,) for r in wanted], "row long")), "row").toArrow()
        extra, place = Views.of(chosen, views.edges), {r: i for i, r in enumerate(chosen.column("row").to_pylist())}
    odds = np.stack([models[v].odds(getattr(views, v).take(held)) for v in sizes], axis=1)
    target = y[held].astype(float)
    lines = [_line(odds[:, [j]], target) for j in range(2)]
    calibrated = np.stack([odds[:, j] * lines[j][0] + lines[j][1] for j in range(2)], axis=1)
    return {"weights": {v: m.weight.astype(np.float32) for v, m in models.items()}, "bias": {v: m.bias for v, m in models.items()},
            "edges": views.edges, "lines": lines, "both": _line(calibrated, target)}


def score(docs: DataFrame, model: dict, keep_columns: bool = False) -> DataFrame:
    """doc_id (or all columns of ``docs``, as c0, c1, …), then content_score,
    meta_score and score of every row."""
    roles = {c: (docs.columns.index(c) if c in docs.columns else None) for c in _COLUMNS}
    if keep_columns:
        df = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)])
    else:
        df = docs.select(*_columns(docs))
        roles = {c: i for i, c in enumerate(_COLUMNS)}
    given = df.schema.fields if keep_columns else df.schema.fields[:1]

    def run(batches):
        for whole in batches:
            batch = pa.RecordBatch.from_arrays([whole.column(i) if i is not None else pa.nulls(whole.num_rows) for i in roles.values()],
                                               names=list(roles))
            for block in blocks(string_column(batch, "text"), BLOCK_BYTES):
                cells, at = content_features(block)
                views = Views(Sparse(cells, at), np.concatenate([layout(block), _declared(batch, block)], axis=1).astype(np.float32).astype(float),
                              _categories(batch, block), model["edges"])
                odds = {"content": views.content.dot(model["weights"]["content"]) + model["bias"]["content"],
                        "meta": views.meta.dot(model["weights"]["meta"]) + model["bias"]["meta"]}
                one, two = (odds[v] * line[0] + line[1] for v, line in zip(("content", "meta"), model["lines"]))
                w = model["both"]
                yield pa.RecordBatch.from_arrays(
                    [c[block.rows.start:block.rows.stop] for c in whole.columns[:len(given)]]
                    + [pa.array(_sigmoid(x)) for x in (one, two, one * w[0] + two * w[1] + w[2])],
                    names=[*[f.name for f in given], "content_score", "meta_score", "score"])

    kinds = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in given], "content_score double, meta_score double, score double"])
    return df.mapInArrow(releasing(run), kinds)


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, **options) -> DataFrame:
    """One row per row of ``docs``: doc_id, content_score, meta_score, score
    (the probability of being good) and keep (score at or above the threshold).

    Null and empty texts have no content features and are scored like any;
    missing columns of ``docs`` count as null, extra ones are ignored.  Without
    labelled documents all scores are 0.5 and every document is kept.
    """
    model = fit(docs, labels, **options)
    if model is None:
        half = F.lit(0.5)
        scored = docs.select(_columns(docs)[0], half.alias("content_score"), half.alias("meta_score"), half.alias("score"))
        return scored.withColumn("keep", F.lit(True))
    return score(docs, model).withColumn("keep", F.col("score") >= threshold)


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, **options) -> DataFrame:
    """The rows that ``classify`` keeps, with all their columns."""
    model = fit(docs, labels, **options)
    if model is None:
        return docs
    scored = score(docs, model, keep_columns=True).filter(F.col("score") >= threshold)
    return scored.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)])
