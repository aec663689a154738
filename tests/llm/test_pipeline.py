"""The pipeline's stages against plain code, each on what the stage before it kept."""

import corpus_pipeline
import pytest
from llm.test_near_duplicates import brute as duplicate_classes
from llm.test_quality_and_leaks import brute as leaks
from llm.test_token_files import check_packing

import __spark_entry__
from blogweave.llm import cotraining, language_id
from blogweave.llm.store import kept, table

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark):
    """Each stage's input and result."""
    docs, out = table(spark, SF, "documents"), {}
    for name, stage in corpus_pipeline.STAGES:
        result = kept(stage(spark, docs, SF), f"test-{name}")
        out[name] = (docs, result)
        docs = result
    return out


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def test_stages_keep_the_documents_columns(stages):
    assert list(stages) == ["quality", "language", "deduplication", "decontamination", "packing"]
    for name, (docs, result) in stages.items():
        if name != "packing":
            assert result.schema == docs.schema and 0 < result.count() < docs.count() or name in ("language", "decontamination")


def test_quality_drops_what_the_classifier_rejects(spark, stages):
    docs, result = stages["quality"]
    labels = table(spark, SF, "labels")
    assert ids(result) == ids(cotraining.classify(docs, labels).filter("keep"))
    kept_ids = set(ids(result))
    rows = labels.collect()
    good = [r.doc_id in kept_ids for r in rows if r.quality == 1 and r.toxic == 0]
    bad = [r.doc_id in kept_ids for r in rows if r.quality == 0 or r.toxic == 1]
    assert sum(good) >= 0.97 * len(good) and sum(bad) <= 0.3 * len(bad)


def test_language_drops_what_is_not_found(stages):
    docs, result = stages["language"]
    assert ids(result) == ids(language_id.identify_languages(docs).filter("lang_pred <> 'und' AND score >= 0.5"))


def test_one_of_each_group_stays(stages):
    docs, result = stages["deduplication"]
    classes = duplicate_classes([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    assert ids(result) == sorted({c for _, c, _ in classes})


def test_leaking_documents_go(spark, stages):
    docs, result = stages["decontamination"]
    found = leaks([tuple(r) for r in docs.select("doc_id", "text").collect()],
                  [tuple(r) for r in table(spark, SF, "benchmark").select("item_id", "text").collect()])
    assert ids(result) == sorted(set(ids(docs)) - {f[0] for f in found})


def test_all_that_is_left_is_packed(stages):
    docs, result = stages["packing"]
    got = check_packing(docs)
    assert sorted(map(tuple, got)) == sorted(map(tuple, result.collect()))


def test_registered(spark):
    assert __spark_entry__.queries()["pipeline"] is corpus_pipeline.run
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
    assert {f"op{n}" for n in range(1, 11)} <= {q.split("_")[0] for q in __spark_entry__.queries()}


def test_stages_take_odd_and_no_documents(spark, odd_documents, no_documents):
    for docs in (odd_documents.withColumnRenamed("score", "n_chars"), no_documents):
        for _, stage in corpus_pipeline.STAGES:
            docs = kept(stage(spark, docs, SF), "test-odd")
        assert docs.columns[0] == "doc_id"
