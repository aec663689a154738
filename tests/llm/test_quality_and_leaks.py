import random
import re

import numpy as np
import pytest
from llm.conftest import SF01
from pyspark.sql import functions as F

from blogweave.llm import cotraining, decontamination


def test_labels_are_found_again(spark):
    docs, labels = (spark.read.parquet(f"{SF01}/../sf0.1/{t}.parquet") for t in ("documents", "labels"))
    held = F.pmod(F.xxhash64("doc_id", F.lit(99)), F.lit(4)) == 0
    got = cotraining.classify(docs, labels.filter(~held)).join(labels.filter(held), "doc_id")
    rows = got.select("keep", ((F.col("quality") == 1) & (F.col("toxic") == 0)).alias("good"), "toxic", "quality").collect()
    good, low, toxic = ([r.keep for r in rows if r.good], [r.keep for r in rows if r.quality == 0], [r.keep for r in rows if r.toxic])
    assert sum(good) >= 0.97 * len(good) and sum(low) <= 0.05 * len(low) and sum(toxic) <= 0.4 * len(toxic)


def test_views_teach_each_other(spark):
    """Few labels, many other documents: the second view learns from the first one's labels."""
    rng = np.random.default_rng(0)
    rows, labels = [], []
    for i in range(600):
        good = i % 2
        words = rng.choice(["fine", "clear", "sound"] if good else ["bad", "wrong", "awful"], 30)
        rows.append((i, " ".join(words), "en", "a" if good else "b", 100))
        if i < 40:
            labels.append((i, int(good), 0))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = cotraining.classify(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    assert sum(r.keep == bool(r.doc_id % 2) for r in got) >= 0.97 * len(got)


def test_odd_rows_and_no_labels(spark, odd_documents, no_documents):
    labels = spark.createDataFrame([(i, i % 2, None) for i in range(12)] + [(None, 1, 0), (3, None, 1), (3, 1, 0), (5, None, None)],
                                   "doc_id long, quality int, toxic int")
    got = cotraining.classify(odd_documents, labels)
    assert got.count() == odd_documents.count() and got.filter("score IS NULL OR score < 0 OR score > 1").count() == 0
    assert cotraining.keep_good(odd_documents, labels).columns == odd_documents.columns
    none = cotraining.classify(odd_documents, labels.limit(0))
    assert none.filter("keep AND score = 0.5").count() == odd_documents.count()
    assert cotraining.keep_good(odd_documents, labels.limit(0)).count() == odd_documents.count()
    assert cotraining.classify(no_documents, labels).collect() == []


NUMBERS, UNITS = set(decontamination.NUMBER_WORDS), set(decontamination.UNITS)


def canonical(text):
    """(type or word, value) of each token, by regular expressions."""
    text, out, last = text or "", [], None
    for m in re.finditer(r"[A-Za-z0-9\u0080-\U0010ffff]+", text):
        word = re.sub("[A-Z]", lambda c: c[0].lower(), m[0])
        before = re.sub(r"[\t \"'()\-]+\Z", "", text[:m.start()])
        if re.fullmatch("[0-9]+", word) or word in NUMBERS:
            kind = "<num>"
        elif last == "<num>" and word in UNITS:
            kind = "<unit>"
        elif re.match("[A-Z][a-z]", m[0]) and before and before[-1] not in "!.?:\n\r":
            kind = "<name>"
        else:
            kind = word
        out.append((kind, word))
        last = kind
    return out


def brute(docs, items, w=8, literals=5, whole=3):
    def count(tokens):
        return sum(not x.startswith("<") for x, _ in tokens)

    out, windows, words = {}, {}, {}
    for j, t in items:
        c = canonical(t)
        size = min(w, len(c))
        own = [c[i:i + size] for i in range(len(c) - size + 1)] if c and j is not None else []
        enough = [count(x) >= min(literals, size) for x in own]
        template = count(c) >= whole and not any(enough)
        need = sum(count(x) > 0 for x in own) if template else 0
        for i, x in enumerate(own):
            windows.setdefault(tuple(k for k, _ in x), []).append((j, i, x, enough[i], need))
            if count(x) or size >= whole:
                words.setdefault(tuple(v for _, v in x), []).append((j, i))
    for k, t in docs:
        c = canonical(t)
        found = {}
        for size in range(1, w + 1):
            for i in range(len(c) - size + 1) if k is not None else ():
                ours = c[i:i + size]
                for j, at in words.get(tuple(v for _, v in ours), ()) if count(ours) or size >= whole else ():
                    found.setdefault((j, i - at), ([], [], [], [0]))[1].append((i, []))
                for j, at, theirs, enough, need in windows.get(tuple(x for x, _ in ours), ()):
                    slots = [((x, a), (x, b)) for (x, a), (_, b) in zip(theirs, ours) if x.startswith("<")]
                    many, _, template, needed = found.setdefault((j, i - at), ([], [], [], [0]))
                    needed[0] = need
                    if enough:
                        many.append((i, slots))
                    elif need and count(ours):
                        template.append((i, slots))
        for (j, _), (many, same, template, need) in found.items():
            def agree(hits):
                pairs = {p for _, s in hits for p in s}
                return len(pairs) == len({a for a, _ in pairs}) == len({b for _, b in pairs})

            if many:
                hits = many if agree(many) or any(not s for _, s in many) else []
            else:
                hits = template if need[0] and len(template) >= need[0] and agree(template) else same
            if hits:
                n, first, exact = out.get((k, j), (0, 1 << 62, False))
                places = {i for i, _ in hits}
                out[k, j] = (n + len(places), min(first, min(places)), exact or all(a == b for _, s in hits for a, b in s))
    return sorted((k, j, *v) for (k, j), v in out.items())


def got(df):
    return sorted(map(tuple, df.select("doc_id", "item_id", "n_windows", "first_token", "exact").collect()))


def test_leaks_equal_plain_search(spark):
    docs, bench = (spark.read.parquet(f"{SF01}/{t}.parquet") for t in ("documents", "benchmark"))
    want = brute([tuple(r) for r in docs.select("doc_id", "text").collect()], [tuple(r) for r in bench.select("item_id", "text").collect()])
    assert len(want) > 5 and got(decontamination.find_leaks(docs, bench)) == want


QUESTION = "A train leaves Boston at 60 mph and another train leaves Denver at 45 mph, so after how many hours will Boston be 300 miles away from Denver?"


@pytest.mark.parametrize("text, leak, exact", [
    (QUESTION, True, True),
    ("Look here: " + QUESTION.upper(), True, True),                    # upper case hides the names, not the other words
    (QUESTION.replace("60", "seventy").replace("45", "50").replace("Boston", "Paris").replace("Denver", "Lyon").replace("mph", "km"), True, False),
    (QUESTION.replace("Boston", "Paris", 1).replace("Denver", "Paris", 1), False, False),      # two names became one, one became two
    (QUESTION.replace("train", "ship").replace("hours", "days").replace("away", "off").replace("leaves", "left")
     .replace("so after", "in"), False, False),
    (None, False, False), ("", False, False), ("what is this", False, False)])
def test_slots(spark, text, leak, exact):
    docs = spark.createDataFrame([(1, text, 9)], "doc_id long, text string, item_id long")
    bench = spark.createDataFrame([(5, QUESTION, 1), (6, None, 1), (None, QUESTION, 1), (7, "", 1)], "item_id long, text string, doc_id long")
    found = decontamination.find_leaks(docs, bench).collect()
    assert [(r.doc_id, r.item_id, r.exact) for r in found] == ([(1, 5, exact)] if leak else [])
    assert got(decontamination.find_leaks(docs, bench)) == brute([(1, text)], [(5, QUESTION), (6, None), (7, "")])


def test_short_items_and_odd_documents(spark, odd_documents, no_documents):
    bench = spark.createDataFrame([(1, "five six seven"), (2, "漢字 é́ x"), (3, "one"), (4, "the the"), (5, "nothing of it is there")], "item_id long, text string")
    rows = [tuple(r) for r in odd_documents.select("doc_id", "text").collect() if r.doc_id not in (6, 7)]
    some = odd_documents.filter("doc_id IS NULL OR doc_id NOT IN (6, 7)")
    items = [tuple(r) for r in bench.collect()]
    assert got(decontamination.find_leaks(some, bench)) == brute(list(dict.fromkeys(rows)), items)
    left = decontamination.keep_clean(odd_documents, bench)
    assert left.columns == odd_documents.columns and left.filter("doc_id IS NULL").count() == 1
    assert got(decontamination.find_leaks(odd_documents, bench.limit(0))) == []
    assert got(decontamination.find_leaks(no_documents, bench)) == []


def test_items_of_few_literals(spark):
    """Questions of numbers and names mostly: as they are, with other values, with values that contradict each other, in part."""
    items = ["What is 17 plus 25?", "How much is 3 times 4?", "Who wrote Pride and Prejudice in 1813?", "Is Paris north of Rome?",
             "Was Johann Wolfgang Goethe born in Frankfurt on 28 August 1749?"]
    other = ["What is 8 plus 9?", "How much is 5 times 6?", "Who wrote War and Peace in 1869?", "Is Oslo north of Bern?",
             "Was Jane Mary Austen born in Steventon on 16 December 1775?"]
    texts = [f"We asked this. {t} Nobody knew." for t in items + other] + ["What is 5 plus 5?", "It says Goethe born in Frankfurt on 28 August 1749", "17 plus 25"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    found = {(r.doc_id, r.item_id): r.exact for r in decontamination.find_leaks(docs, bench).collect()}
    assert found == {**{(i, i): True for i in range(5)}, **{(5 + i, i): False for i in range(5)}, (11, 4): True}


def test_items_of_any_number_of_literals_equal_plain_search(spark):
    """Questions made of few words, so that windows of 0 to 8 literals occur, among texts that hold them as they are, changed or in part."""
    rng = random.Random(8)
    words = ["what", "is", "of", "the", "Goethe", "Schiller", "1805", "five", "six", "7", "km", "Paris", "was", "born"]
    items = ["Goethe Schiller 1805", "five six seven", "7", "five six", "the Goethe"]
    items += [" ".join(rng.choice(words) for _ in range(rng.randint(1, 12))) for _ in range(60)]
    change = {"Goethe": "Kant", "1805": "1724", "five": "nine", "Paris": "Rome"}
    texts = ["it says Goethe Schiller 1805 there", "count: five six seven eight", "five six nine"]
    for t in items * 3:
        own = t.split()[rng.choice([0, 0, 0, 1]):]
        texts.append("so it was " + " ".join(change.get(x, x) if rng.random() < 0.3 else x for x in own) + rng.choice([" .", " and so on", ""]))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    want = brute(list(enumerate(texts)), list(enumerate(items)))
    assert {(0, 0), (1, 1)} <= {x[:2] for x in want} and (2, 1) not in {x[:2] for x in want}
    assert got(decontamination.find_leaks(docs, bench)) == want


def test_the_surest_of_all_rows_are_handed_over(spark):
    """By plain sorting, ties to the smaller row."""
    rng = np.random.default_rng(5)
    rows = [(i, float(rng.integers(-20, 20)), float(rng.normal())) for i in range(3000)]
    odds = spark.createDataFrame(rows, "row long, content_odds double, meta_odds double").repartition(7)
    for j, view in ((1, "content"), (2, "meta")):
        up, down = sorted(rows, key=lambda r: (-r[j], r[0]))[:30], sorted(rows, key=lambda r: (r[j], r[0]))[:70]
        assert cotraining.surest(odds, view, 30, 70) == {r[0]: 0 for r in down} | {r[0]: 1 for r in up}


def test_every_unlabelled_document_is_scored_each_round(spark, monkeypatch):
    """Copies count once; labelled documents and null ids are not handed over."""
    seen = []
    real = cotraining.surest
    monkeypatch.setattr(cotraining, "surest", lambda odds, *a: seen.append(sorted(r.row for r in odds.collect())) or real(odds, *a))
    rows = [(i, f"{'fine' if i % 2 else 'bad'} word{i}", "en", "s", 1) for i in range(200)] + [(500, "fine word1", "en", "s", 1), (None, "no id", "en", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(0, 40)], "doc_id long, quality int, toxic int")
    cotraining.fit(docs, labels)
    assert len(seen) == 2 * cotraining.ROUNDS and {len(s) for s in seen} == {161}
