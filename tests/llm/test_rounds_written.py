"""What the rounds of the near-duplicates write to the shared folder."""

import random

from blogweave.llm import components as contraction
from blogweave.llm import order_minhash


def counting(monkeypatch, module):
    names, plain = [], module.kept

    def kept(df, name):
        names.append(name)
        return plain(df, name)

    monkeypatch.setattr(module, "kept", kept)
    return names


def test_a_round_of_stars_is_written_once(spark, monkeypatch):
    written = counting(monkeypatch, contraction)
    edges = spark.createDataFrame([(0, i) for i in range(1, 60)] + [(0, 5), (7, 0), (100, 101), (3, 3)], "a long, b long")
    assert {r.node: r.root for r in contraction.components(edges).collect()} == {**{i: 0 for i in range(60)}, 100: 100, 101: 100}
    assert len(written) == 2, written                # the edges, and one round


def test_pairs_are_written_with_their_similarity_only(spark, monkeypatch):
    """A class, its near copies and strangers: sketches, classes, members and texts, one write a round, and the open buckets."""
    rng = random.Random(4)
    word = lambda: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=9))
    base = [word() for _ in range(200)]
    rows = [(i, " ".join([*base[:i * 20], word(), *base[i * 20 + 1:]])) for i in range(10)] + [(50 + i, " ".join(word() for _ in range(80))) for i in range(5)]
    written = counting(monkeypatch, order_minhash)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: r.class_id for r in order_minhash.near_duplicates(docs).collect()} == {k: 0 if k < 50 else k for k, _ in rows}
    rounds = written.count("omh-tried")
    assert rounds and len(written) <= 4 + 3 * rounds and not {"omh-pairs", "omh-buckets"} & set(written), written
