"""The trie's scores against plain counting."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from blogweave.llm import ngram_lm
from blogweave.llm.elias_fano import EliasFano, array_bytes, arrays_of

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(0, 2**40), max_size=200), st.integers(0, 40))
def test_elias_fano(values, shift):
    values = np.sort(np.array([v >> shift for v in values], np.uint64))
    seq = EliasFano.of(arrays_of(array_bytes(EliasFano.build(values, int(values[-1]) + 1 if len(values) else 1).arrays("x"))), "x")
    assert seq.decode().tolist() == values.tolist()
    assert seq.values(np.arange(len(values))).tolist() == values.tolist()
    ask = np.unique(np.concatenate([values, values + np.uint64(1), [np.uint64(0), np.uint64(1 << 41)]]).astype(np.uint64))
    for x, at in zip(ask.tolist(), seq.find(ask).tolist()):
        assert at == (values.tolist().index(x) if x in values.tolist() else -1)


def brute(rows, mu):
    def words(t):
        return re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER)) + [None]
    def out(k):
        return k is not None and zlib.crc32(str(k).encode()) % 7 == 2
    unigrams, bigrams = Counter(), Counter()
    for k, t in rows:
        if not out(k):
            w = words(t)
            unigrams.update(w)
            bigrams.update(zip([None, *w], w))
    n, v = sum(unigrams.values()), len(unigrams)
    result = []
    for k, t in rows:
        w = words(t)
        base = like = 0.0
        for c, x in zip([None, *w], w):
            p = (unigrams[x] + 1) / (n + v + 1)
            base += math.log10(p)
            like += math.log10((bigrams[c, x] + mu * p) / (unigrams[c] + mu))
        result.append((k, out(k), len(w), sum(x in unigrams for x in w), n, base, like))
    return result


@pytest.mark.parametrize("shard_tokens", [ngram_lm.SHARD_TOKENS, 5000])
def test_scores_equal_counting(documents, odd_documents, shard_tokens):
    for docs in (documents, odd_documents):
        want = sorted(brute([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()], ngram_lm.MU), key=repr)
        got = sorted((tuple(r) for r in ngram_lm.score_documents(docs, shard_tokens=shard_tokens).collect()), key=repr)
        assert [g[:5] for g in got] == [w[:5] for w in want]
        for g, w in zip(got, want):
            assert g[5] == pytest.approx(w[5], rel=1e-9)
            assert g[6] == pytest.approx(w[6], abs=2e-4 * w[2] + 1e-9)      # quantised


def test_nothing_to_learn_from(spark, no_documents):
    assert ngram_lm.score_documents(no_documents).collect() == []
    held = [k for k in range(100) if zlib.crc32(str(k).encode()) % 7 == 2][:2]
    got = ngram_lm.score_documents(spark.createDataFrame([(k, "a b") for k in held], "doc_id long, text string")).collect()
    assert {(r.n_tokens, r.n_known, r.train_tokens) for r in got} == {(3, 0, 0)}
    assert all(r.score == r.base_score == 0.0 for r in got)
