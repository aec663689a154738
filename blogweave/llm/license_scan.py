"""Licence scan by a positional rare-token index.

Every template is a licence text (or notice) with mandatory key phrases.  The
index maps each key phrase's rarest word (highest inverse document frequency
over the whole corpus; ties by word) to its postings: phrase and place in the
phrase.  A file's words are looked up there, each posting is intersected with
the file by relative position, which gives the places where a whole key phrase
stands, and a template counts when its mandatory phrases follow each other at
the template's distances, give or take ``slack`` words.  As a text with all
the phrases has each phrase's rarest word, the look-up loses nothing.

Word comparisons are by 64-bit hashes and word lengths.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textblocks import ALNUM, ASCII_LOWER, Block, blocks, map_batches, span_hashes, spans, string_column

# Phrases and labels that must be found by themselves.
BASE = (("under the mit license", "mit"),
        ("apache license version 2", "apache-2"),
        ("cc by nc", "cc-by-nc"))

# Notices of public licences; key phrases stand between braces.
NOTICES = (
    ("mit", "{permission is hereby granted free of charge to any person obtaining a copy} of this software and associated "
            "documentation files the software {to deal in the software without restriction}"),
    ("apache-2", "{licensed under the apache license version 2 0} the license "
                 "{you may not use this file except in compliance with the license}"),
    ("bsd", "{redistribution and use in source and binary forms with or without modification are permitted} provided that "
            "the following conditions are met {redistributions of source code must retain the above copyright notice}"),
    ("gpl-2", "{under the terms of the gnu general public license} as published by the free software foundation "
              "{either version 2 of the license}"),
    ("gpl-3", "{under the terms of the gnu general public license} as published by the free software foundation "
              "{either version 3 of the license}"),
    ("gpl-2", "{gnu general public license version 2}"),
    ("gpl-3", "{gnu general public license version 3}"),
    ("lgpl", "{under the terms of the gnu lesser general public license}"),
    ("agpl-3", "{under the terms of the gnu affero general public license}"),
    ("mpl-2", "this source code form is {subject to the terms of the mozilla public license v 2 0}"),
    ("isc", "{permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted}"),
    ("unlicense", "{this is free and unencumbered software released into the public domain}"),
    ("cc0", "{the person who associated a work with this deed has dedicated the work to the public domain}"),
    ("cc-by", "this work is {licensed under a creative commons attribution} 4 0 international license"),
    ("mit", "{spdx license identifier mit}"),
    ("apache-2", "{spdx license identifier apache 2 0}"),
    ("mit", "{released under the mit license}"),
)
SLACK = 4


class Template(NamedTuple):
    label: str
    phrases: tuple[str, ...]
    gaps: tuple[int, ...]     # words from one phrase's start to the next one's


def templates() -> list[Template]:
    out = []
    for label, text in NOTICES:
        phrases, starts, at = [], [], 0
        for i, part in enumerate(text.replace("}", "{").split("{")):
            if i % 2:
                phrases.append(part)
                starts.append(at)
            at += len(part.split())
        out.append(Template(label, tuple(phrases), tuple(b - a for a, b in zip(starts, starts[1:]))))
    return out


def phrases() -> list[str]:
    return sorted({p for p, _ in BASE} | {p for t in templates() for p in t.phrases})


def _hash_words(words: list[str]) -> np.ndarray:
    data = np.frombuffer("".join(words).encode(), np.uint8)
    ends = np.cumsum([len(w.encode()) for w in words])
    return span_hashes(data, np.concatenate([[0], ends[:-1]]), ends)


class WordIndex:
    """Membership of word hashes in a small set, by a table of their top bits."""

    def __init__(self, hashes: np.ndarray):
        self.values = np.sort(hashes)
        self.maybe = np.zeros(1 << 16, bool)
        self.maybe[(self.values >> np.uint64(48)).astype(np.int64)] = True

    def hits(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in ``hashes`` that are members, and which member."""
        at = np.flatnonzero(self.maybe[(hashes >> np.uint64(48)).astype(np.int64)])
        which = np.minimum(np.searchsorted(self.values, hashes[at]), len(self.values) - 1)
        same = self.values[which] == hashes[at]
        return at[same], which[same]


def _words(block: Block) -> tuple[np.ndarray, np.ndarray]:
    lower = Block(block.rows, ASCII_LOWER[block.data], block.offsets)
    starts, ends, first = spans(lower, ALNUM)
    return span_hashes(lower.data, starts, ends), first


def document_frequencies(docs: DataFrame, text: str, words: list[str]) -> dict[str, int]:
    """In how many texts each of these words stands; ``words`` bounds the result."""
    hashes = _hash_words(words)
    index = WordIndex(hashes)
    place = {int(h): i for i, h in enumerate(hashes)}
    schema = pa.schema([("word", pa.int32()), ("n", pa.int64())])

    def work(batch):
        total = np.zeros(len(words), np.int64)
        for block in blocks(string_column(batch, text)):
            found, first = _words(block)
            at, which = index.hits(found)
            row = np.searchsorted(first, at, side="right") - 1
            total += np.bincount(np.unique(row * len(words) + which) % len(words), minlength=len(words))
        yield [np.array([place[int(h)] for h in index.values], np.int32), total]

    counted = docs.select(text).mapInArrow(map_batches(schema, work), "word int, n long").groupBy("word").agg(F.sum("n"))
    seen = {r[0]: r[1] for r in counted.collect()}
    return {w: seen.get(i, 0) for i, w in enumerate(words)}


def _chained(places: dict[str, np.ndarray], template: Template, slack: int) -> bool:
    reach = places.get(template.phrases[0])
    for phrase, gap in zip(template.phrases[1:], template.gaps):
        there = places.get(phrase)
        if reach is None or there is None or not len(reach):
            return False
        low = np.searchsorted(reach, there - gap - slack)
        high = np.searchsorted(reach, there - gap + slack, side="right")
        reach = there[high > low]
    return reach is not None and len(reach) > 0


def scan_licenses(docs: DataFrame, key: str = "doc_id", text: str = "text", slack: int = SLACK) -> DataFrame:
    """One row per row of ``docs``: key, n_words, n_base, first_word,
    last_word, base_labels, labels, score.

    ``score`` is the largest share of a template's distinct key phrases that
    the text has (a base phrase counts as a template).  Null and empty texts
    have no words, empty labels and score 0; other columns are ignored.
    """
    wanted, rules = phrases(), templates()
    base = dict(BASE)
    frequency = document_frequencies(docs, text, sorted({w for p in wanted for w in p.split()}))
    anchors: dict[str, list[tuple[int, int]]] = {}
    for i, p in enumerate(wanted):
        rarest = min(p.split(), key=lambda w: (frequency[w], w))
        anchors.setdefault(rarest, []).append((i, p.split().index(rarest)))
    names = sorted(anchors)
    anchor_hash = _hash_words(names)
    postings = {int(h): anchors[w] for w, h in zip(names, anchor_hash)}
    index = WordIndex(anchor_hash)
    spelled = [_hash_words(p.split()) for p in wanted]
    schema = pa.schema([("row", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()),
                        ("last_word", pa.int64()), ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64())])

    def work(batch):
        n = batch.num_rows
        out = {"n_words": np.zeros(n, np.int64), "n_base": np.zeros(n, np.int64), "first": [None] * n, "last": [None] * n,
               "base": [""] * n, "labels": [""] * n, "score": np.zeros(n)}
        for block in blocks(string_column(batch, text)):
            found, first = _words(block)
            out["n_words"][block.rows] = np.diff(first)
            at, which = index.hits(found)
            by_row: dict[int, dict[str, np.ndarray]] = {}
            for k in np.unique(which):
                spots = at[which == k]
                for i, offset in postings[int(index.values[k])]:
                    size = len(spelled[i])
                    row = np.searchsorted(first, spots, side="right") - 1
                    start = spots - offset
                    fits = (start >= first[row]) & (start + size <= first[row + 1])
                    start, row = start[fits], row[fits]
                    for j in range(size):
                        same = found[start + j] == spelled[i][j]
                        start, row = start[same], row[same]
                    for r in np.unique(row):
                        by_row.setdefault(int(r), {})[wanted[i]] = start[row == r] - first[r]
            for r, places in by_row.items():
                spot = block.rows.start + r
                of_base = [p for p in places if p in base]
                labels = {base[p] for p in of_base}
                if of_base:
                    everywhere = np.concatenate([places[p] for p in of_base])
                    out["n_base"][spot], out["first"][spot], out["last"][spot] = len(everywhere), int(everywhere.min()), int(everywhere.max())
                    out["base"][spot] = ",".join(sorted(labels))
                share = 1.0 if of_base else 0.0
                for rule in rules:
                    had = sum(p in places for p in set(rule.phrases)) / len(set(rule.phrases))
                    share = max(share, had)
                    if had == 1 and _chained(places, rule, slack):
                        labels.add(rule.label)
                out["labels"][spot], out["score"][spot] = ",".join(sorted(labels)), share
        return [batch.column(0), out["n_words"], out["n_base"], pa.array(out["first"], pa.int64()), pa.array(out["last"], pa.int64()),
                out["base"], out["labels"], out["score"]]

    kind = docs.schema[key].dataType.simpleString()

    def run(batches):
        for batch in batches:
            columns = work(batch)
            yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema)],
                                             names=[key, *schema.names[1:]])

    return docs.select(key, text).mapInArrow(
        run, f"`{key}` {kind}, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double")


def scan_sql() -> str:
    """DuckDB SQL of ``scan_licenses`` over ``documents``, by plain text search."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    word = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"

    def starts(phrase: str) -> str:
        k = len(phrase.split())
        return f"[i - 1 for i in range(1, len(words) - {k} + 2) if array_to_string(words[i:i + {k - 1}], ' ') = '{phrase}']"

    def chain(rule: Template) -> str:
        text = rule.phrases[0]
        for before, phrase, gap in zip(rule.phrases, rule.phrases[1:], rule.gaps):
            between = gap - len(before.split())
            text += f"( [^ ]+){{{max(0, between - SLACK)},{between + SLACK}}} {phrase}"
        return f"regexp_matches(joined, ' {text} ')"

    base = " || ".join(starts(p) for p, _ in BASE)
    labels = sorted({x for _, x in BASE} | {t.label for t in templates()})
    has = {x: [f"contains(joined, ' {p} ')" for p, y in BASE if y == x] for x in labels}
    base_list = ", ".join(f"CASE WHEN {has[x][0]} THEN '{x}' END" for x in labels if has[x])
    every = ", ".join("CASE WHEN " + " OR ".join(has[x] + [chain(t) for t in templates() if t.label == x]) + f" THEN '{x}' END" for x in labels)
    shares = [f"CAST(contains(joined, ' {p} ') AS INT) * 1.0" for p, _ in BASE] + [
        "(" + " + ".join(f"CAST(contains(joined, ' {p} ') AS INT)" for p in sorted(set(t.phrases))) + f") / {len(set(t.phrases))}.0"
        for t in templates()]
    return f"""
WITH w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'), '{word}') AS words FROM documents),
j AS (SELECT doc_id, words, ' ' || array_to_string(words, ' ') || ' ' AS joined FROM w),
b AS (SELECT *, CASE WHEN {' OR '.join(x for x in sum(has.values(), []))} THEN {base} ELSE [] END AS places FROM j)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(places) AS BIGINT) AS n_base,
       CAST(list_min(places) AS BIGINT) AS first_word, CAST(list_max(places) AS BIGINT) AS last_word,
       array_to_string([x for x in [{base_list}] if x IS NOT NULL], ',') AS base_labels,
       array_to_string([x for x in [{every}] if x IS NOT NULL], ',') AS labels,
       CAST(greatest({', '.join(shares)}) AS DOUBLE) AS score
FROM b"""
