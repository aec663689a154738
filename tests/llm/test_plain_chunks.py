"""Chunks that are encoded many at a time, against the tokenizers library one by one."""

import random
import time

import numpy as np
import pyarrow as pa
from blogweave.llm import encode, lexical_packing
from blogweave.llm.textblocks import blocks

PATH = encode.public_path(encode.WORD_BPE)
#: Marks that compose with the letter before them, forms that are decomposed, capitals that have no ASCII, apostrophes, digits and special strings.
ODD = ["é", "́a", "ּ", "ﬁn", "İx", "Σ", "ς", "it's", "'s", ",'s", "'-s", "x's,", "3'd", "a1b22c", "²", "x²", "٤",
       "</w>", "a</w>b", "<|endoftext|>", "<|startoftext|>x", "«été»", "…,", "a\x01b", "\x1cx", "\x85y", "中文", "\U0001f642ok",
       "привет,", "й", "й", "ÿz", "ŉ", "ſ", "가", "don't!!!", "%%%", "x,###y", "2024-01", "~", "a"]


def column(words):
    return pa.array([x.encode() for x in words], pa.large_binary())


def plainly(words):
    return [x.ids for x in encode.tokenizer_of(PATH).encode_batch_fast(words, add_special_tokens=False)]


def words_of(seed, n):
    rnd = random.Random(seed)
    letters = "etaoinshrdlucmfwypvbgkjqxzéèñüßо"
    return [*dict.fromkeys("".join(rnd.choices(letters, k=rnd.randint(2, 12))) + rnd.choice(["", "", ",", ".", "!!"]) for _ in range(n))]


def test_ids_equal_the_librarys():
    rnd, below = random.Random(3), [chr(c) for c in range(33, 0x800) if not chr(c).isspace()]
    mixed = ["".join(rnd.choices(below + ["'"] * 40 + [chr(c) for c in range(33, 127)] * 20, k=rnd.randint(1, 9))) for _ in range(20_000)]
    for words in (ODD, [a + b for a in ODD for b in ODD], mixed, words_of(4, 3000), ["plain"], ["中"], []):
        ids, sizes = encode._encoded(PATH, column(words))
        want = plainly(words)
        assert sizes.tolist() == [len(x) for x in want]
        assert ids.tolist() == [i for x in want for i in x]


def test_other_vocabularies_have_no_plain_chunks():
    path = encode.public_path(encode.BYTE_BPE)
    words = ["a", " b", " c,d  ", "it's"]
    ids, _ = encode._encoded(path, column(words))
    assert ids.tolist() == [i for x in encode.tokenizer_of(path).encode_batch_fast(words, add_special_tokens=False) for i in x.ids]


def test_distinct_words_cost_less_than_one_by_one():
    words = words_of(5, 30_000)
    chunks = column(words)

    def one_by_one():
        coded = [e.ids for e in encode.tokenizer_of(PATH).encode_batch_fast(chunks.cast(pa.large_string()).to_pylist(), add_special_tokens=False)]
        return np.fromiter((i for ids in coded for i in ids), np.uint32)

    def least(f):
        took = []
        for _ in range(5):
            began = time.process_time()
            f()
            took.append(time.process_time() - began)
        return min(took)

    assert np.array_equal(encode._encoded(PATH, chunks)[0], one_by_one())
    assert least(lambda: encode._encoded(PATH, chunks)) < 0.75 * least(one_by_one)


def test_chunks_are_the_lower_cased_words():
    texts = ["", " A b\tC\x0bd\x0c", "ÉTÉ  x", "x" * 50, "\r\n", "Ab cd"]
    for block in blocks(pa.array(texts, pa.large_string()), 16):
        chunks, first = encode.chunks_of(block, True)
        for i, text in enumerate(texts[block.rows]):
            assert chunks[first[i]:first[i + 1]].to_pylist() == text.encode().lower().split()


def test_a_narrowed_index_scores_its_items_alike():
    rng = np.random.default_rng(6)
    items = [lexical_packing.Item(i, (rng.zipf(1.4, rng.integers(1, 300)) % 500).astype("<u2"), 0, 1) for i in range(80)]
    idf = rng.random(500)
    whole, some = lexical_packing.Index(items, idf, 100.0), lexical_packing.Index(items, idf, 100.0)
    keep = np.ones(80, bool)
    for drop in (range(0, 80, 3), range(1, 80, 2), range(80)):
        keep[list(drop)] = False
        some.narrow(keep)
        assert some.listed == keep.sum() and len(some.entry) == keep[whole.entry].sum()
        for i in range(80):
            assert np.array_equal(some.scores(i), np.where(keep, whole.scores(i), 0.0))


def test_windows_are_those_of_an_index_that_is_not_narrowed(monkeypatch):
    rng = np.random.default_rng(7)
    items = [lexical_packing.Item(i, (rng.zipf(1.3, rng.integers(1, 90)) % 400).astype("<u2"), 0, 1) for i in range(300)]
    idf = rng.random(400)

    def packed():
        full, rest = lexical_packing.windows(items, idf, 45.0, 128)
        return [[(p.key, p.start, p.ids.tolist()) for p in pieces] for pieces in [*full, rest]]

    narrowed = []
    narrow = lexical_packing.Index.narrow
    monkeypatch.setattr(lexical_packing.Index, "narrow", lambda self, items: (narrowed.append(1), narrow(self, items))[1])
    got = packed()
    assert len(narrowed) > 3
    monkeypatch.setattr(lexical_packing.Index, "narrow", lambda self, items: None)
    assert got == packed()
