"""What a Python worker holds while it scores a batch of long texts."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql.types import StructType

from blogweave.llm import cotraining, language_id


class Caught:
    """Stands for a data frame; keeps the function that tasks would run."""
    schema = StructType([])

    def select(self, *_):
        return self

    def mapInArrow(self, run, _):
        self.run = run
        return self


@pytest.fixture(scope="module")
def batch():
    """Some 2 MB of distinct words in 40 rows."""
    rng = random.Random(5)
    texts = [" ".join("".join(rng.choices("abcdefghijklmnop", k=8)) for _ in range(5000)) for _ in range(40)]
    return pa.record_batch({"text": texts, "source": ["a"] * 40, "lang": ["en"] * 40, "n_chars": pa.array([1] * 40, pa.int64())})


def peak_mb(run, batch):
    tracemalloc.start()
    try:
        for _ in run([batch]):
            pass
        return tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def test_languages_are_scored_some_words_at_a_time(spark, batch):
    path = language_id.vocabulary_path()
    probability = np.full((len(language_id._lengths(path)), 4), 1e-4)
    language_id.Lattice(pa.array([b"a"], pa.large_binary()), path)
    run = language_id.predict(Caught(), "text", {"names": list("abcd"), "probability": probability, "path": path}).run
    assert peak_mb(run, batch.select(["text"])) < 90
    assert sum(x.nbytes for x in language_id._trie(path)) < 20e6


def test_words_score_the_same_in_any_part(monkeypatch):
    path = language_id.vocabulary_path()
    weight = language_id.scaled(np.random.default_rng(3).random((len(language_id._lengths(path)), 3)) / 1e4, path)
    words = pa.array([b"word", b"x" * 90, "ñandú".encode(), b"a", b"language" * 20, b"the"], pa.large_binary())
    whole = language_id.Lattice(words, path).log_likelihood(weight)
    monkeypatch.setattr(language_id, "SCORE_BYTES", 16)
    assert (language_id.word_likelihoods(words, weight, path) == whole).all()


def test_features_are_made_of_small_blocks(spark, batch):
    longer = pa.Table.from_batches([batch] * 3).combine_chunks().to_batches()[0]
    assert peak_mb(cotraining.feature_rows(Caught()).run, longer) < 80
