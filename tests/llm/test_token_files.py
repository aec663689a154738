"""Bit packing and lexical packing against the tokenizers library alone."""

import numpy as np
import pytest
from llm.conftest import crc_of
from hypothesis import given, settings
from hypothesis import strategies as st

import pyarrow as pa
from blogweave.llm import bit_packing, lexical_packing
from blogweave.llm.encode import BYTE_BPE, WORD_BPE, Encoder, public_path


def plain(name, texts, end):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(public_path(name))
    t.encode_special_tokens = True
    return [[*e.ids, end] for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


@pytest.mark.parametrize("name, words", [(BYTE_BPE, False), (WORD_BPE, True)])
@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="ab A\n\t\r 1!.'sé́ñ  \u0085　\x1c漢"), min_size=1, max_size=20))
def test_chunks_give_the_ids_of_whole_texts(name, words, texts):
    got = []
    for _, ids, sizes in Encoder(public_path(name), words).encode(pa.array(texts, pa.large_string())):
        at = np.concatenate([[0], np.cumsum(sizes)])
        got += [ids[a:b].tolist() for a, b in zip(at, at[1:])]
    assert got == [x[:-1] for x in plain(name, texts, 0)]


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 32), st.lists(st.integers(0, 2**32 - 1), max_size=300))
def test_bits_round_trip(bits, values):
    ids = np.array([v & ((1 << bits) - 1) for v in values], np.uint32)
    data = bit_packing.pack(ids, bits)
    assert len(data) == -(-len(ids) * bits // 8)
    assert bit_packing.unpack(data, bits, len(ids)).tolist() == ids.tolist()


def test_width():
    assert [bit_packing.width(n) for n in (1, 2, 3, 256, 257, 50_257)] == [1, 1, 2, 8, 9, 16]


def test_random_access(tmp_path, monkeypatch):
    monkeypatch.setattr(bit_packing, "BLOCK_IDS", 7)
    rng = np.random.default_rng(0)
    docs = [rng.integers(0, 1000, n).astype(np.uint32) for n in (0, 3, 30, 1, 7)]
    path = tmp_path / "shard"
    with open(path, "wb") as out:
        bit_packing.write_shard(out, iter([([1, 2, None], np.concatenate(docs[:3]), np.array([0, 3, 30])),
                                           ([4, 5], np.concatenate(docs[3:]), np.array([1, 7]))]), 10)
    with open(path, "rb") as file:
        shard = bit_packing.Shard(file)
        for i in (4, 2, 0, 3, 1):
            assert shard.read(int(shard.starts[i]), int(shard.starts[i + 1])).tolist() == docs[i].tolist()
        assert shard.null.tolist() == [False, False, True, False, False]


def expected_rows(docs):
    rows = sorted(((r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()), key=lambda r: (r[0] is not None, r[0] or 0))
    ids = plain(BYTE_BPE, [t for _, t in rows], 2)
    start, out = 0, []
    for (k, _), x in zip(rows, ids):
        out.append((k, start, len(x), crc_of(x)))
        start += len(x)
    return out


def test_packed_files_give_back_all_ids(documents, odd_documents, no_documents):
    for docs in (documents, odd_documents):
        got = sorted(map(tuple, bit_packing.pack_tokens(docs).collect()), key=lambda r: r[1])
        assert got == expected_rows(docs)
    assert bit_packing.pack_tokens(no_documents).collect() == []


def check_packing(docs, window=2048, **options):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    ids = plain(WORD_BPE, [t for _, t in rows], 1)
    got = lexical_packing.pack_documents(docs, window=window, **options).collect()
    left = {}
    for (k, _), x in zip(rows, ids):
        left.setdefault(k, []).append(x)
    pieces = {}
    for r in got:
        pieces.setdefault(r.doc_id, []).append(r)
    assert set(pieces) == set(left)
    for k, texts in left.items():                       # rows with one key have one text here
        text, copies = texts[0], len(texts)
        cover = np.zeros(len(text), int)
        for r in pieces[k]:
            assert r.doc_tokens == len(text) and crc_of(text[r.start:r.start + r.length]) == r.ids_crc32 and r.length > 0
            cover[r.start:r.start + r.length] += 1
        assert (cover == copies).all()
    sequences = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append(r)
    for parts in sequences.values():
        at = 0
        for r in sorted(parts, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= window and (at == window or at & (at - 1) == 0)
    return got


def test_every_id_is_packed_once(documents, odd_documents, no_documents):
    check_packing(documents)
    check_packing(documents, window=100, shard_tokens=3000)
    check_packing(odd_documents, window=64)
    assert lexical_packing.pack_documents(no_documents).collect() == []


def test_neighbours_share_a_window(spark):
    """Documents about the same words are packed together, though dealt in turn."""
    topics = ["zebra giraffe lion savanna grass", "violin cello sonata orchestra tempo"]
    docs = spark.createDataFrame([(i, " ".join([topics[i % 2]] * 5)) for i in range(40)], "doc_id long, text string")
    got = lexical_packing.pack_documents(docs, window=128).collect()
    mixed = {}
    for r in got:
        mixed.setdefault(r.sequence_id, set()).add(r.doc_id % 2)
    assert sum(len(x) == 1 for x in mixed.values()) >= len(mixed) - 2


def test_scores_are_bm25():
    rng = np.random.default_rng(1)
    items = [lexical_packing.Item(i, rng.integers(0, 30, rng.integers(1, 40)).astype(np.uint16), 0, 0) for i in range(12)]
    idf, mean = rng.random(30), 17.0
    index = lexical_packing.Index(items, idf, mean)
    for q in range(len(items)):
        want = []
        for d in items:
            total = 0.0
            for t in set(items[q].ids.tolist()):
                tf = (d.ids == t).sum()
                total += idf[t] * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(d.ids) / mean))
            want.append(total)
        assert np.allclose(index.scores(q), want)
