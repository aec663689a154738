"""Sum-of-squares packing against the tokenizers library and plain sums of squares."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm.conftest import crc_of
from llm.test_token_files import plain

from blogweave.llm import best_fit_packing as B
from blogweave.llm.encode import WORD_BPE


def by_definition(sizes, window, thrifty):
    """Try every place, add up all squares anew."""
    bins = []                                              # gaps
    out = []
    for s in sizes:
        def squares(i):
            after = bins + [window - s] if i == len(bins) else bins[:i] + [bins[i] - s] + bins[i + 1:]
            return sum(after.count(g) ** 2 for g in set(after) if g)
        options = sorted((squares(i), bins[i] - s, i) for i in range(len(bins)) if bins[i] >= s)
        new = squares(len(bins))
        if options and (thrifty or options[0][0] <= new):
            i = options[0][2]
            out.append((window - bins[i], bins[i] - s))
            bins[i] -= s
        else:
            out.append((0, window - s))
            bins.append(window - s)
    return out, sorted(bins)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 11), max_size=40), st.booleans())
def test_each_place_has_the_least_sum(sizes, thrifty):
    bins, offsets, gaps = B.sum_of_squares(np.array(sizes, np.int64), 12, thrifty)
    want, left = by_definition(sizes, 12, thrifty)
    assert offsets.tolist() == [o for o, _ in want] and sorted(gaps.tolist()) == left
    fill = {}
    for b, o, s in zip(bins.tolist(), offsets.tolist(), sizes):
        assert fill.get(b, 0) == o
        fill[b] = o + s
    assert all(f == 12 - gaps[b] for b, f in fill.items())


def fewest(sizes, window):
    """Best fit, decreasing."""
    gaps = []
    for s in sorted(sizes, reverse=True):
        fits = [(g, i) for i, g in enumerate(gaps) if g >= s]
        if fits:
            gaps[min(fits)[1]] -= s
        else:
            gaps.append(window - s)
    return len(gaps)


def check(docs, window=4096, **options):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    ids = plain(WORD_BPE, [t for _, t in rows], 1)
    packed = B.pack_documents(docs, window, **options)
    got = B.digest(packed).collect()
    want = sorted(((k, p, p * window, len(x[p * window:(p + 1) * window]), crc_of(x[p * window:(p + 1) * window]))
                   for (k, _), x in zip(rows, ids) for p in range(-(-len(x) // window))), key=repr)
    assert sorted((tuple(r)[:5] for r in got), key=repr) == want
    bins = {}
    for r in got:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in bins.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= window
    sizes = [len(x) % window for x in ids if len(x) % window]
    return got, len(bins), sum(len(x) // window for x in ids) + fewest(sizes, window)


@pytest.mark.parametrize("group_rows, more", [(8192, 1.0), (150, 1.02)])      # groups of 150 pieces end with more gaps
def test_documents(documents, group_rows, more):
    got, n, good = check(documents, group_rows=group_rows)
    assert n <= good * more + 1


def test_odd_documents(odd_documents, no_documents):
    check(odd_documents)
    check(odd_documents, window=7, group_rows=2)
    assert check(no_documents)[0] == []


def test_sizes_that_never_fill_a_bin_end(spark):
    """Nothing to gain from further rounds: they end all the same."""
    docs = spark.createDataFrame([(i, "word " * 5) for i in range(300)], "doc_id long, text string")
    assert check(docs, window=10, group_rows=16)[1] == 300


def test_sequences(spark, odd_documents):
    packed = B.pack_documents(odd_documents, 50)
    by = {}
    for r in packed.collect():
        by.setdefault(r.sequence_id, []).append((r.offset, bytes(r.ids)))
    got = {r.sequence_id: (r.length, bytes(r.ids)) for r in B.token_sequences(packed).collect()}
    assert got == {k: (sum(len(x) // 2 for _, x in v), b"".join(x for _, x in sorted(v))) for k, v in by.items()}
