"""Importance resampling against plain Python and its SQL."""

import hashlib
import math
import re
import zlib

import pytest
from pyspark.sql import functions as F

from blogweave.llm import importance_resampling as R
from oracle_compare import duck_connection


def words_of(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def runs_of(text, longest):
    w = words_of(text)
    return [" ".join(w[i:i + n]) for n in range(1, longest + 1) for i in range(len(w) - n + 1)]


def brute(docs, target, percent=10, least=20, longest=1, buckets=10_000):
    def count(texts):
        out = [0] * buckets
        for t in texts:
            for f in runs_of(t, longest):
                out[zlib.crc32(f.encode()) % buckets] += 1
        return out
    s, t = count(x for _, x in docs), count(target)
    gain = [math.floor(1000 * math.log((t[b] + 1.0) * (sum(s) + buckets) / ((s[b] + 1.0) * (sum(t) + buckets)))) for b in range(buckets)]
    rows = []
    for key, text in docs:
        f = runs_of(text, longest)
        weight = sum(gain[zlib.crc32(x.encode()) % buckets] for x in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"2024:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        rows.append([key, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(words_of(text))])
    able = sorted((r for r in rows if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    for i, r in enumerate(able[:percent * len(able) // 100]):
        r[4] = i + 1
    return sorted((tuple(r[:5]) for r in rows), key=repr)


def rows_of(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_features", "weight", "score", "rank").collect()), key=repr)


def plain(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]


def test_all_documents(spark, documents):
    target = spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet")
    got = rows_of(R.resample(documents, target))
    assert got == brute(plain(documents, "doc_id", "text"), [t for t, in plain(target, "text")])
    con = duck_connection("/root/testdata/sf0.01")
    assert got == sorted(con.sql(R.resample_sql()).project("doc_id, n_features, weight, score, rank").fetchall(), key=repr)


@pytest.mark.parametrize("longest, percent, least", [(1, 50, 1), (3, 40, 2), (1, 100, 0), (1, 0, 1)])
def test_odd_documents(spark, odd_documents, longest, percent, least):
    target = spark.createDataFrame([("word the one",), (None,), ("",)], "text string")
    got = rows_of(R.resample(odd_documents, target, percent, least, longest, buckets=97))
    assert got == brute(plain(odd_documents, "doc_id", "text"), ["word the one", None, ""], percent, least, longest, 97)


def test_ties_and_repeated_ids(spark):
    """Many rows of one score: by id, null ids last, rows that share an id one by one."""
    keys = [5, 3, 3, 3, None, None, 9, -2**63, 2**63 - 1, 4]
    docs = spark.createDataFrame([(k, "same words here", 1) for k in keys], "doc_id long, text string, score int")
    target = spark.createDataFrame([], "text string")
    for percent in (20, 50, 80):
        got = rows_of(R.resample(docs, target, percent, 1))
        assert got == brute([(k, "same words here") for k in keys], [], percent, 1)


def test_cutoff_counts_every_tie(spark):
    rows = spark.range(1000).select(F.lit(7).cast("long").alias("score"), (F.col("id") * 3 - 900).alias("doc_id"))
    for need in (1, 2, 500, 999, 1000):
        assert R.cutoff(rows, need, "doc_id") == R.Cutoff(7, (need - 1) * 3 - 900, False)


def test_bisection(spark):
    rows = spark.createDataFrame([(v,) for v in (-5, -5, 0, 3, 3, 3, 8, 100_000)], "v long")
    for need, want in ((1, 100_000), (3, 3), (6, 0), (8, -5)):
        for levels in (2, 5):
            assert R.reached_by(rows, F.col("v"), need, -5, 100_000, levels) == want


def test_no_documents(spark, no_documents, documents):
    target = spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet")
    got = R.resample(no_documents, target)
    assert got.collect() == [] and [t for _, t in got.dtypes] == ["bigint"] * 5
