import math

import numpy as np
import pytest
from llm.conftest import SF01
from pyspark.sql import functions as F

from blogweave.llm import cross_polytope


def brute(rows, n, is_query):
    """Rows with equal id and vector count once."""
    rows = {(k, tuple(v)) for k, v in rows if k is not None and v is not None and None not in v
            and all(math.isfinite(x) for x in v) and any(v)}
    out = {}
    for k, v in rows:
        if is_query(k):
            near = sorted((-math.fsum(a * b for a, b in zip(v, w)), j) for j, w in rows if j != k)
            out[k] = [(j, -s) for s, j in near[:n]]
    return out


def test_recall_and_scores(spark):
    e = spark.read.parquet(f"{SF01}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in e.select("vec_id", "embedding").collect()]
    want = brute(rows, 20, lambda k: k % 20 == 0)
    vectors = dict(rows)
    got = {}
    for r in cross_polytope.search_embeddings(e).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r)
    assert set(got) == set(want)
    hits = 0
    for q, near in got.items():
        assert [r.rank for r in near] == list(range(1, 21))
        assert q not in [r.vec_id for r in near]
        assert [(-r.score, r.vec_id) for r in near] == sorted((-r.score, r.vec_id) for r in near)
        for r in near:
            assert r.score == pytest.approx(math.fsum(a * b for a, b in zip(vectors[q], vectors[r.vec_id])), abs=1e-12)
        hits += len({r.vec_id for r in near} & {j for j, _ in want[q]})
    assert hits >= 0.9 * 20 * len(want)


def test_odd_vectors_are_left_out_and_ties_go_by_id(spark):
    rng = np.random.default_rng(2)
    same = [1.0, 2.0, 0.0, -1.0]
    rows = [(i, same) for i in range(0, 60)] + [(100 + i, rng.normal(size=4).tolist()) for i in range(80)]
    rows += [(20, same), (None, same), (300, None), (320, [0.0] * 4), (340, [1.0, None, 0.0, 0.0]), (360, [math.nan, 1.0, 0.0, 0.0]),
             (380, [math.inf, 1.0, 0.0, 0.0]), (400, [10.0, 20.0, 0.0, -10.0])]
    df = spark.createDataFrame([(*r, 1.0) for r in rows], "vec_id long, embedding array<double>, score double").repartition(4)
    want = brute(rows, 20, lambda k: k % 20 == 0)
    got = {}
    for r in cross_polytope.search_embeddings(df, recall=1.0).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert set(got) == set(want) == {0, 20, 40, 100, 120, 140, 160, 400}
    for q in (0, 20, 40, 400):          # the group of equal vectors is found whole
        assert [j for j, _ in got[q]] == [j for j, _ in want[q]]


def test_few_rows(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (3, [0.5, 0.5]), (40, [-1.0, 0.2])], "vec_id long, embedding array<float>")
    got = {}
    for r in cross_polytope.search_embeddings(df).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    assert got == {0: [3, 40], 40: [3, 0]}
    assert cross_polytope.search_embeddings(df.limit(0)).collect() == []
    assert cross_polytope.search_embeddings(df.filter("vec_id = 3")).collect() == []


def test_two_axes_a_table():
    """Longer bucket names, as for large tables: probes come in the order of the summed losses."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(40, 6))
    h = cross_polytope.Hashes(6, float(np.linalg.norm(x, axis=1).max()), 3, 2)
    order = h.probes(x, 200)
    assert order.shape == (40, 3, 200) and all(len(set(t.tolist())) == 200 for q in order for t in q)
    unit = x / np.linalg.norm(x, axis=1, keepdims=True) * h.norm
    assert (h.buckets(unit) == order[:, :, 0]).all()


def test_hot_buckets_are_split(spark, monkeypatch):
    monkeypatch.setattr(cross_polytope, "BASE_BLOCK", 16)
    monkeypatch.setattr(cross_polytope, "QUERY_BLOCK", 4)
    rng = np.random.default_rng(4)
    rows = [(i, (np.array([5.0, 0, 0, 0, 0]) + 0.01 * rng.normal(size=5)).tolist()) for i in range(300)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    want = brute(rows, 20, lambda k: k % 20 == 0)
    got = {}
    for r in cross_polytope.search_embeddings(df, recall=1.0).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    assert sum(len(got[q] & {j for j, _ in want[q]}) for q in want) >= 0.9 * 20 * len(want)


def test_key_is_any_condition(spark):
    df = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(10)], "vec_id long, embedding array<float>")
    got = cross_polytope.nearest(df, lambda k: F.coalesce(k == 9, F.lit(False)), n=3, recall=1.0).orderBy("rank").collect()
    assert [r.vec_id for r in got] == [8, 7, 6]


def test_all_ties_reach_the_exact_ranking():
    rng = np.random.default_rng(6)
    base = np.tile(rng.normal(size=6), (400, 1)) * np.where(np.arange(400) % 2, 1.0, 1.0 + 1e-17)[:, None]
    ids, scores = cross_polytope.best_of(rng.normal(size=(3, 6)), base, np.arange(400)[::-1].copy(), 21)
    assert (ids == np.arange(21)).all() and (scores == scores[:, :1]).all()
    ids, scores = cross_polytope.best_of(np.ones((2, 3)), np.ones((4, 3)), np.array([9, 3, 5, 1]), 21)
    assert ids.tolist() == [[1, 3, 5, 9]] * 2


@pytest.mark.parametrize("probes", [cross_polytope.MOST_PROBES, 1])
def test_one_long_vector_and_too_few_probes(spark, monkeypatch, probes):
    """One norm puts all other vectors into few buckets; then every query still has its 20, exact where probes do not do."""
    monkeypatch.setattr(cross_polytope, "MOST_PROBES", probes)
    monkeypatch.setattr(cross_polytope, "BASE_BLOCK", 256)
    monkeypatch.setattr(cross_polytope, "QUERY_BLOCK", 32)
    rng = np.random.default_rng(7)
    rows = [(i, (rng.normal(size=8) * (1e4 if i == 17 else 1)).tolist()) for i in range(1000)]
    df = spark.createDataFrame(rows + [(2000, [1.0, 2.0]), (2001, [3.0])], "vec_id long, embedding array<double>")
    want = brute(rows, 20, lambda k: k % 20 == 0)
    got = {}
    for r in cross_polytope.search_embeddings(df).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    assert set(got) == set(want) and all(len(near) == 20 for near in got.values())
    hits = sum(len(set(got[q]) & {j for j, _ in want[q]}) for q in want)
    assert hits >= 0.9 * 20 * len(want) and (probes > 1 or hits == 20 * len(want))
