import math
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from llm.conftest import SF01

from blogweave.llm import jobs, language_id, license_scan
from oracle_compare import duck_connection, rows_of


@pytest.mark.parametrize("name", ["op2_license_scan", "op4_warc"])
def test_sql(spark, name):
    df = jobs.QUERIES[name](spark, SF01)
    want = duck_connection(SF01).sql(jobs.SQL[name])
    assert sorted(df.columns) == sorted(want.columns)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(want.columns, want.fetchall())


MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation
files (the "Software"), to deal in the Software without restriction, including"""


def test_templates(spark):
    texts = [MIT, MIT.replace("this software", "this very software"), MIT.replace("associated documentation", "x " * 9), MIT.replace("free of charge", "for a fee"),
             "under the MIT license; Apache-License, version 2.0! CC BY-NC", "Licensed under the GNU General Public License, version 3.", None, "", "ünder the mit license",
             "CC-BY-NC " * 3, MIT.split("to deal")[0]]
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)] + [(None, "under the mit license", 1)], "doc_id long, text string, labels int")
    got = {r.doc_id: r for r in license_scan.scan_licenses(docs).collect()}
    assert [got[i].labels for i in range(6)] == ["mit", "mit", "", "", "apache-2,cc-by-nc,mit", "gpl-3"]
    assert [got[i].score for i in range(6)] == [1.0, 1.0, 1.0, 0.5, 1.0, 1.0]
    assert got[10].labels == "" and got[10].score == 0.5
    assert (got[4].n_base, got[4].first_word, got[4].last_word, got[4].base_labels) == (3, 0, 9, "apache-2,cc-by-nc,mit")
    assert tuple(got[6][1:]) == tuple(got[7][1:]) == (0, 0, None, None, "", "", 0.0)
    assert got[8].n_base == 0 and got[9].n_base == 3 and got[None].base_labels == "mit"


def test_scan_of_odd_documents(odd_documents, no_documents):
    rows = {}
    for r in odd_documents.select("doc_id", "text").collect():
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), r.text or ""))
        rows[r.doc_id] = len(w)
    assert {r.doc_id: r.n_words for r in license_scan.scan_licenses(odd_documents).collect()} == rows
    assert license_scan.scan_licenses(odd_documents).count() == odd_documents.count()
    assert license_scan.scan_licenses(no_documents).collect() == []


def plain_sums(word, weights, pieces):
    """Logarithms of the sums over all segmentations up to each place and from
    each place, by plain recursion over the whole word."""
    def pass_over(text, known):
        total = [0.0] + [-math.inf] * len(text)
        for j in range(1, len(text) + 1):
            ways = [total[i] + math.log(weights[known[text[i:j]]]) for i in range(max(0, j - 40), j) if text[i:j] in known]
            top = max(ways)
            total[j] = top + math.log(math.fsum(math.exp(w - top) for w in ways))
        return total
    return pass_over(word, pieces), pass_over(word[::-1], {k[::-1]: v for k, v in pieces.items()})[::-1]


def test_sums_over_all_segmentations_of_words_of_any_length():
    path = language_id.vocabulary_path()
    pieces = {}
    for i, piece in language_id._pieces(path):
        pieces.setdefault(piece, i)
    rng = np.random.default_rng(0)
    probability = rng.random((len(language_id._lengths(path)), 2)) ** 4 / 5000 + 1e-9
    weights = language_id.scaled(probability, path)
    words = [b"hello", b"the", "señor".encode(), b"x", b"a" * 75, "漢字".encode(), b"b" * 31, b"c" * 32, b"d" * 63, b"e" * 64,
             "достопримечательностями".encode() * 2, "東京都渋谷区。".encode() * 60, b"internationalisation" * 9]
    lattice = language_id.Lattice(pa.array(words, pa.large_binary()), path)
    got = lattice.log_likelihood(weights)
    seen = np.arange(1.0, len(words) + 1)
    want = np.zeros(len(probability))
    for k, w in enumerate(words):
        spaced = b" " + w
        for lang in range(2):
            up, down = plain_sums(spaced, probability[:, lang], pieces)
            assert np.isclose(got[k, lang], up[-1], rtol=1e-9) and np.isclose(up[-1], down[0])
            if lang == 0:
                for i in range(len(spaced)):
                    for j in range(i + 1, min(len(spaced), i + 40) + 1):
                        if spaced[i:j] in pieces:
                            piece = pieces[spaced[i:j]]
                            want[piece] += seen[k] * math.exp(up[i] + math.log(probability[piece, 0]) + down[j] - up[-1])
    assert np.allclose(lattice.expected(weights[:, 0], seen), want)
    assert language_id.Lattice(pa.array([], pa.large_binary()), path).log_likelihood(weights).shape == (0, 2)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    got = {r.doc_id: r for r in language_id.identify_languages(docs).collect()}
    rows = docs.select("doc_id", "lang").collect()
    assert set(got) == {r.doc_id for r in rows}
    assert all(got[r.doc_id].held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    held = [r for r in rows if got[r.doc_id].held_out]
    assert sum(got[r.doc_id].lang_pred == r.lang for r in held) >= 0.98 * len(held)
    assert all(0 <= r.score <= 1 for r in got.values())


def test_undetermined(spark, odd_documents, no_documents):
    docs = spark.createDataFrame([(1, "the cat and the dog", "en"), (2, "le chat et le chien", "fr"), (3, None, "fr"), (4, "", "en"), (6, "12 34 !?", "en"),
                                  (7, "—…“”", "en"), (8, "ж", None), (None, "the dog", None)], "doc_id long, text string, lang string")
    got = {r.doc_id: r.lang_pred for r in language_id.identify_languages(docs).collect()}
    assert [got[k] for k in (3, 4, 6, 7)] == ["und"] * 4 and got[8] in ("en", "fr") and got[None] == "en"
    assert language_id.identify_languages(odd_documents).count() == odd_documents.count()
    assert language_id.identify_languages(no_documents).collect() == []
    none = language_id.identify_languages(docs.selectExpr("doc_id", "text", "CAST(NULL AS STRING) AS lang")).collect()
    assert {(r.lang_pred, r.score) for r in none} == {("und", 0.0)}
