"""Document frequencies of the packing by lexical retrieval, against a plain count and a table summed as long integers."""

import time

import numpy as np

from blogweave.llm import lexical_packing
from blogweave.llm.textblocks import sections


def plain(ids, at, vocabulary):
    out = np.zeros(vocabulary, np.int64)
    for a, b in zip(at, at[1:]):
        out[np.unique(ids[a:b])] += 1
    return out


def test_frequencies_equal_a_plain_count():
    rng = np.random.default_rng(1)
    for vocabulary, rows in ((7, 2000), (49_153, 300), (9_000_000, 3), (50, 0)):
        sizes = rng.integers(0, 30, rows)
        ids = rng.integers(0, min(vocabulary, 40), sizes.sum()).astype(np.uint32)
        at = sections(sizes)
        assert np.array_equal(lexical_packing.document_frequencies(ids, at, vocabulary), plain(ids, at, vocabulary))


def test_frequencies_cost_less_than_a_sum_of_long_integers():
    rng, size = np.random.default_rng(2), 49_153
    sizes = rng.integers(50, 700, 1000)
    ids, at = (rng.zipf(1.3, sizes.sum()) % size).astype(np.uint32), sections(sizes)
    row = np.repeat(np.arange(len(sizes)), sizes)

    def summed():
        out = np.zeros(size, np.int64)
        for i in range(0, len(sizes), 170):
            part = slice(at[i], at[min(i + 170, len(sizes))])
            seen = np.zeros((min(170, len(sizes) - i), size), bool)
            seen[row[part] - i, ids[part]] = True
            out += seen.sum(axis=0)
        return out

    def least(f):
        took = []
        for _ in range(5):
            began = time.process_time()
            f()
            took.append(time.process_time() - began)
        return min(took)

    assert np.array_equal(summed(), lexical_packing.document_frequencies(ids, at, size))
    assert least(lambda: lexical_packing.document_frequencies(ids, at, size)) < 0.7 * least(summed)
