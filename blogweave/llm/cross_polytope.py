"""Approximate nearest neighbours (largest inner product) by cross-polytope hashing.

Vectors are scaled by the largest norm and given one more coordinate that
makes them unit vectors, which turns the largest inner product into the
smallest angle.  Each of ``tables`` hash tables has pseudo-random rotations
(three rounds of random signs and a fast Hadamard transform); a vector's
bucket is the signed axis nearest to it, or the tuple of ``k`` such axes.  A
query probes each table's buckets in the order of how little it would have to
move, as far as a bounded sample of queries, searched exactly, shows to be
needed for ``recall``; where probes are not enough, all vectors are one bucket.
Candidates are scored exactly, in blocks of a bucket, and the best of all
blocks merged.  Equal vectors are searched once, as a class.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .store import kept

TABLES = 8
RECALL = 0.95
SAMPLE = 100             # queries that are searched exactly to set the number of probes
MOST_PROBES = 4096
BASE_BLOCK, QUERY_BLOCK = 4096, 2048
_SEED = 20_240_229


def hadamard(x: np.ndarray) -> np.ndarray:
    n, h = x.shape[1], 1
    while h < n:
        y = x.reshape(len(x), -1, 2, h)
        x = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], axis=2).reshape(len(x), n)
        h *= 2
    return x / math.sqrt(n)


class Hashes:
    def __init__(self, dims: int, norm: float, tables: int, k: int):
        self.norm, self.tables, self.k = norm, tables, k
        self.size = 1 << dims.bit_length()           # a power of two, beyond dims
        self.axes = 2 * self.size
        self.signs = np.random.default_rng(_SEED).choice([-1.0, 1.0], (tables, k, 3, self.size))

    def lifted(self, vectors: np.ndarray, query: bool) -> np.ndarray:
        out = np.zeros((len(vectors), self.size))
        d = vectors.shape[1]
        if query:
            out[:, :d] = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
        else:
            out[:, :d] = vectors / self.norm
            out[:, d] = np.sqrt(np.maximum(0.0, 1.0 - (out[:, :d] ** 2).sum(axis=1)))
        return out

    def _axes(self, lifted: np.ndarray, table: int, j: int) -> np.ndarray:
        x = lifted
        for signs in self.signs[table, j]:
            x = hadamard(x * signs)
        return np.concatenate([x, -x], axis=1)

    def buckets(self, vectors: np.ndarray) -> np.ndarray:
        lifted = self.lifted(vectors, query=False)
        out = np.zeros((len(vectors), self.tables), np.int64)
        for t in range(self.tables):
            for j in range(self.k):
                out[:, t] = out[:, t] * self.axes + self._axes(lifted, t, j).argmax(axis=1)
        return out

    def probes(self, vectors: np.ndarray, n: int) -> np.ndarray:
        """The n buckets of each table that a query comes to first."""
        lifted = self.lifted(vectors, query=True)
        n = min(n, self.axes ** self.k)
        out = np.zeros((len(vectors), self.tables, n), np.int64)
        for i in range(0, len(vectors), 256):
            some = lifted[i:i + 256]
            for t in range(self.tables):
                loss, code = np.zeros((len(some), 1)), np.zeros((len(some), 1), np.int64)
                for j in range(self.k):
                    value = self._axes(some, t, j)
                    own = (value.max(axis=1, keepdims=True) - value) ** 2
                    order = np.argsort(own, axis=1, kind="stable")[:, :n]
                    total = (loss[:, :, None] + np.take_along_axis(own, order, 1)[:, None, :]).reshape(len(some), -1)
                    codes = (code[:, :, None] * self.axes + order[:, None, :]).reshape(len(some), -1)
                    best = np.argsort(total, axis=1, kind="stable")[:, :n]
                    loss, code = np.take_along_axis(total, best, 1), np.take_along_axis(codes, best, 1)
                out[i:i + 256, t] = code
        return out


def _matrix(column: pa.Array, kind: str) -> np.ndarray:
    if not len(column):
        return np.zeros((0, 1))
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), -1).astype(np.float64)


def best_of(queries: np.ndarray, base: np.ndarray, ids: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and exact scores of each query's n best (ties: smaller id)."""
    rough = queries @ base.T
    few = min(len(ids), n)
    out, scores = np.zeros((len(queries), few), np.int64), np.zeros((len(queries), few))
    if not few:
        return out, scores
    # whatever rounding can hide among the n best, ties too, is scored exactly
    error = 4 * (base.shape[1] + 2) * np.finfo(float).eps * np.linalg.norm(queries, axis=1) * np.linalg.norm(base, axis=1).max()
    cut = np.partition(rough, len(ids) - few, axis=1)[:, len(ids) - few] - error
    for i, q in enumerate(queries):
        near = np.flatnonzero(rough[i] >= cut[i])
        exact = (base[near] * q).sum(axis=1)
        order = np.lexsort((ids[near], -exact))[:few]
        out[i], scores[i] = ids[near[order]], exact[order]
    return out, scores


_BEST = "qid long, ids array<long>, scores array<double>"


def _best_table(qids, ids: np.ndarray, scores: np.ndarray) -> pa.Table:
    return pa.table({"qid": pa.array(qids, pa.int64()), "ids": pa.array(list(ids), pa.list_(pa.int64())),
                     "scores": pa.array(list(scores), pa.list_(pa.float64()))})


def _merged(parts: DataFrame, n: int) -> DataFrame:
    """One row per query: its n best of all parts, each id once."""
    pair = F.explode(F.arrays_zip("ids", "scores")).alias("c")
    one = parts.select("qid", pair).select("qid", F.col("c.ids").alias("id"), F.col("c.scores").alias("score")).distinct()
    order = Window.partitionBy("qid").orderBy(F.col("score").desc(), "id")
    return one.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n)


def valid(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """id, v (doubles), raw (their bytes): rows with an id and a finite vector other than zero."""
    v = F.col("v")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (vectors.select(F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{vector}`").cast("array<double>").alias("v"))
            .filter(F.col("id").isNotNull() & v.isNotNull() & finite & F.exists(v, lambda x: x != 0)).distinct())


def nearest(vectors: DataFrame, is_query, n: int = 20, key: str = "vec_id", vector: str = "embedding", tables: int = TABLES,
            recall: float = RECALL, sample: int = SAMPLE) -> DataFrame:
    """query_id, rank, vec_id, score: the n nearest found of each query.

    ``is_query`` takes the id column and gives a condition.  Vectors that are
    null, zero or hold null or non-finite components take no part, nor do rows
    without an id, nor vectors of another number of components than most have
    (ties: the smaller number).  A row that repeats another's id and vector
    counts once.  An empty table gives no rows.

    Queries whose probes find fewer than n classes, and all of them where
    ``MOST_PROBES`` do not reach ``recall`` on the sample, are searched exactly:
    against all vectors, block by block.
    """
    spark = vectors.sparkSession
    empty = "query_id long, rank int, vec_id long, score double"
    rows = valid(vectors, key, vector).withColumn("h", F.xxhash64("v"))
    single = vectors.schema[vector].dataType.simpleString() == "array<float>"       # vectors travel as they came
    kind, width = ("<f4", 4) if single else ("<f8", 8)
    classes = kept(rows.groupBy("h", "v").agg(F.min("id").alias("cid"), F.max(is_query(F.col("id")).cast("int")).alias("asks"),
                                              F.count("*").alias("members")), "ann-classes")
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))
    facts = (classes.groupBy(F.size("v").alias("dims")).agg(F.sum("members").alias("members"), F.count("*").alias("classes"), F.max(norm).alias("norm"))
             .orderBy(F.col("members").desc(), "dims").first())
    if facts is None:
        return spark.createDataFrame([], empty)
    dims = facts.dims
    classes = classes.filter(F.size("v") == dims)
    k = max(1, round(math.log(max(facts.classes, 1000) / 1000) / math.log(4 * dims)))
    hashes = Hashes(dims, facts.norm, tables, k)
    more = n + 1                                         # a query's own row is among its class's best

    def packed(df: DataFrame) -> DataFrame:
        def run(batches):
            for b in batches:
                flat = b.column(1)
                data = flat.flatten().to_numpy(zero_copy_only=False).astype(kind).tobytes()
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.FixedSizeBinaryArray.from_buffers(
                    pa.binary(width * dims), len(flat), [None, pa.py_buffer(data)]).cast(pa.binary())], names=["cid", "asks", "raw"])
        return df.select("cid", "v", "asks").mapInArrow(run, "cid long, asks int, raw binary")

    base = packed(classes)
    ask = base.filter("asks = 1").select("cid", "raw")
    drawn = ask.orderBy(F.xxhash64("cid"), "cid").limit(sample).collect()      # bounded: ``sample`` vectors
    if not drawn:
        return spark.createDataFrame([], empty)
    few = np.stack([np.frombuffer(r.raw, kind).astype(float) for r in drawn])
    few_ids = np.array([r.cid for r in drawn])

    def exact(batches):
        for b in batches:
            ids, scores = best_of(few, _matrix(b.column(2), kind), b.column(0).to_numpy(), more)
            yield from _best_table(few_ids, ids, scores).to_batches()

    truth = _merged(base.mapInArrow(exact, _BEST), more).join(base.select(F.col("cid").alias("id"), "raw"), "id")
    truth = truth.select("qid", "id", "raw").collect()                          # bounded: ``sample`` times n + 1
    place = {int(q): i for i, q in enumerate(few_ids)}
    order = hashes.probes(few, MOST_PROBES)
    near = hashes.buckets(np.stack([np.frombuffer(r.raw, kind).astype(float) for r in truth]))
    needed = []
    for r, own in zip(truth, near):
        if r.qid != r.id:
            same = order[place[r.qid]] == own[:, None]
            needed.append(np.where(same.any(axis=1), same.argmax(axis=1) + 1, order.shape[2] + 1).min())
    probes = int(np.quantile(needed, recall, method="higher")) if needed else 1
    reached = probes <= order.shape[2]

    def bucketed(batches):
        for b in batches:
            own = hashes.buckets(_matrix(b.column(2), kind))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(list(own), pa.list_(pa.int64()))], names=["id", "raw", "codes"])

    def probing(batches):
        for b in batches:
            own = hashes.probes(_matrix(b.column(1), kind), probes).reshape(b.num_rows, -1)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(list(own), pa.list_(pa.int64()))], names=["id", "raw", "codes"])

    schema = "id long, raw binary, codes array<long>"
    indexed = kept(base.mapInArrow(bucketed, schema), "ann-index")
    asking = kept(ask.mapInArrow(probing, schema), "ann-queries")

    def rows_of(df: DataFrame, per_table: int) -> DataFrame:
        return (df.select("id", "raw", F.posexplode("codes").alias("at", "bucket"))
                .select("id", "raw", F.floor(F.col("at") / per_table).cast("int").alias("t"), "bucket"))

    # A bucket's base rows and queries are dealt into blocks, and every pair of blocks is one group: a hot bucket is many tasks' work.
    own, theirs = rows_of(indexed, 1), rows_of(asking, order_width(hashes, probes))
    sizes = (own.groupBy("t", "bucket").agg(F.count("*").alias("n_base"))
             .join(theirs.groupBy("t", "bucket").agg(F.count("*").alias("n_ask")), ["t", "bucket"])
             .select("t", "bucket", F.ceil(F.col("n_base") / BASE_BLOCK).cast("int").alias("bs"),
                     F.ceil(F.col("n_ask") / QUERY_BLOCK).cast("int").alias("qs")))

    def dealt(df: DataFrame, sizes: DataFrame, mine: str, other: str, side: int) -> DataFrame:
        block = F.pmod(F.xxhash64("id"), F.col(mine)).cast("int")
        wide = df.join(sizes, ["t", "bucket"]).select("t", "bucket", "id", "raw", block.alias(mine),
                                                      F.explode(F.sequence(F.lit(0), F.col(other) - 1)).alias(other))
        return wide.select("t", "bucket", "bs", "qs", F.lit(side).alias("side"), "id", "raw")

    def search(group: pa.Table) -> pa.Table:
        side, ids, raw = group.column("side").to_numpy(), group.column("id").to_numpy(), group.column("raw")
        a, q = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        if not len(a) or not len(q):
            return _best_table([], [], [])
        found, scores = best_of(_matrix(raw.take(pa.array(q)), kind), _matrix(raw.take(pa.array(a)), kind), ids[a], more)
        return _best_table(ids[q], found, scores)

    def searched(own: DataFrame, theirs: DataFrame, sizes: DataFrame, name: str) -> DataFrame:
        parts = (dealt(own, sizes, "bs", "qs", 0).unionByName(dealt(theirs, sizes, "qs", "bs", 1))
                 .groupBy("t", "bucket", "bs", "qs").applyInArrow(search, _BEST))
        return kept(_merged(parts, more), name)

    rest, best = ask, None
    if reached:
        best = searched(own, theirs, kept(sizes, "ann-blocks"), "ann-best")
        full = best.groupBy("qid").agg(F.count("*").alias("found")).filter(F.col("found") >= min(more, facts.classes))
        rest = kept(ask.join(full, F.col("cid") == F.col("qid"), "left_anti"), "ann-rest")
    left = rest.count()
    if left:                                             # one bucket of all vectors, in blocks like any other
        one = [F.lit(-1).alias("t"), F.lit(0).cast("long").alias("bucket")]
        blocks = spark.createDataFrame([(-1, 0, -(-facts.classes // BASE_BLOCK), -(-left // QUERY_BLOCK))], "t int, bucket long, bs int, qs int")
        exactly = searched(base.select(F.col("cid").alias("id"), "raw", *one), rest.select(F.col("cid").alias("id"), "raw", *one), blocks, "ann-exact")
        best = exactly if best is None else best.join(rest.select(F.col("cid").alias("qid")), "qid", "left_anti").unionByName(exactly)

    # Classes back to rows: the n + 1 first of each class are enough, as equal scores go by id.
    members = (rows.filter(F.col("h").isNotNull()).join(classes.select("h", "v", "cid"), ["h", "v"])
               .withColumn("m", F.row_number().over(Window.partitionBy("cid").orderBy("id"))).filter(F.col("m") <= more).select("cid", "id"))
    listed = (best.select("qid", F.col("id").alias("cid"), "score").join(members, "cid")
              .withColumn("r", F.row_number().over(Window.partitionBy("qid").orderBy(F.col("score").desc(), "id"))).filter(F.col("r") <= more)
              .groupBy("qid").agg(F.sort_array(F.collect_list(F.struct("r", "id", "score"))).alias("near")))      # n + 1 entries
    queries = rows.filter(is_query(F.col("id"))).join(classes.select("h", "v", F.col("cid").alias("qid")), ["h", "v"]).select("qid", "id")
    return (queries.join(listed, "qid")
            .select(F.col("id").alias("query_id"),
                    F.posexplode(F.slice(F.filter("near", lambda x: x["id"] != F.col("id")), 1, n)).alias("at", "c"))
            .select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("c.id").alias("vec_id"), F.col("c.score").alias("score")))


def order_width(hashes: Hashes, probes: int) -> int:
    return min(probes, hashes.axes ** hashes.k)


def search_embeddings(embeddings: DataFrame, **options) -> DataFrame:
    """Queries: rows whose vec_id is divisible by 20."""
    def asks(key: Column) -> Column:
        return F.coalesce(key % 20 == 0, F.lit(False))
    return nearest(embeddings, asks, **options)
