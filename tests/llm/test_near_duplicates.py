"""Order MinHash near-duplicates against all pairs by plain alignment."""

import random
import re
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from blogweave.llm import order_minhash
from blogweave.llm.components import components
from llm.conftest import ODD_TEXTS

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    w = re.findall(r"[a-z0-9\u0080-\U0010ffff]+", (text or "").translate(LOWER))
    return [tuple(w[i:i + 5]) for i in range(len(w) - 4)] if len(w) >= 5 else [tuple(w)] if w else []


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b):
            last, row[j + 1] = row[j + 1], last + 1 if x == y else max(row[j + 1], row[j])
    return row[-1]


def similar(a, b, least=0.8):
    need = least / (1 + least) * (len(a) + len(b)) - 1e-9
    if sum((Counter(a) & Counter(b)).values()) < need:
        return False
    length = lcs(a, b)
    return length >= need


def brute(rows):
    """class_id and copy_of of each (key, text)."""
    seqs = {}
    for k, t in rows:
        if k is not None:
            seqs.setdefault(tuple(shingles(t)) or ("", "".join((t or "").split())), []).append(k)
    names = list(seqs)
    root = {s: s for s in names}

    def find(s):
        while root[s] is not s:
            s = root[s]
        return s

    where = {}
    for s in names:
        for g in set(s):
            where.setdefault(g, []).append(s)
    for s in names:      # similar texts share a shingle
        for o in {id(x): x for g in set(s) for x in where[g]}.values():
            if o is not s and find(o) is not find(s) and similar(s, o):
                root[find(o)] = find(s)
    least = {}
    for s in names:
        r = find(s)
        least[r] = min(least.get(r, 1 << 62), min(seqs[s]))
    out = [(None, None, None) for k, _ in rows if k is None]
    for s in names:
        out += [(k, least[find(s)], min(seqs[s])) for k in seqs[s]]
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r) for r in df.select("doc_id", "class_id", "copy_of").collect()), key=repr)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 6), max_size=25), st.lists(st.integers(0, 6), max_size=25))
def test_alignment(a, b):
    assert order_minhash.common(np.array(a), np.array(b), 100) == lcs(a, b)
    s = order_minhash.ordered_similarity(np.array(a), np.array(b), 0.8) if a and b else 0.0
    true = lcs(a, b) / (len(a) + len(b) - lcs(a, b)) if a and b else 0.0
    assert (s >= 0.8) == (true >= 0.8 - 1e-12)
    if s:
        assert abs(s - true) < 1e-12


def test_classes_equal_all_pairs(documents):
    rows = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    want = brute(rows)
    assert any(k != c for k, c, _ in want) and any(c != o for _, c, o in want)
    assert got(order_minhash.near_duplicates(documents)) == want


def test_odd_rows(odd_documents, no_documents):
    rows = [(r.doc_id, r.text) for r in odd_documents.select("doc_id", "text").collect() if r.doc_id not in (7,)]
    some = odd_documents.filter("doc_id IS NULL OR doc_id <> 7")          # plain alignment is too slow for it
    assert got(order_minhash.near_duplicates(some)) == brute(rows)
    assert len(got(order_minhash.near_duplicates(odd_documents))) == len(ODD_TEXTS) + 3
    assert got(order_minhash.near_duplicates(no_documents)) == []


def test_a_large_group_and_a_shared_passage(spark):
    """A drifting group (neighbours alike, ends not), a hub with many near
    copies, and unlike texts that share a passage."""
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    base = [word() for _ in range(120)]
    rows, text = [], list(base)
    for i in range(25):
        rows.append(" ".join(text))
        text[4 * i:4 * i + 2] = [word(), word()]
    hub = [word() for _ in range(150)]
    for _ in range(150):
        t = list(hub)
        t[rng.randrange(150)] = word()
        rows.append(" ".join(t))
    passage = " ".join(word() for _ in range(60))
    rows += [" ".join(word() for _ in range(60)) + " " + passage + " " + " ".join(word() for _ in range(60)) for _ in range(150)]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    assert got(order_minhash.near_duplicates(docs)) == brute(list(enumerate(rows)))


def test_near_copies_behind_a_shared_passage(spark):
    """Strangers share 300 of 360 shingles (0.71), and each has a near copy: no leader of their bucket meets both."""
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(7))
    passage, rows = [word() for _ in range(304)], []
    for _ in range(150):
        own = [word() for _ in range(60)]
        rows += [" ".join(passage + own), " ".join(passage + own[:30] + [word() for _ in range(30)])]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    assert all(similar(*map(shingles, rows[i:i + 2])) for i in range(0, 300, 2)) and not similar(shingles(rows[0]), shingles(rows[3]))
    assert got(order_minhash.near_duplicates(docs)) == sorted(((i, i - i % 2, i) for i in range(300)), key=repr)


def test_groups_linked_by_members_only(spark):
    """Two hubs with near copies are unlike (0.72), but one member of each drifts until those two are alike."""
    rng = random.Random(12)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(7))
    rows = []
    for _ in range(12):
        one = [word() for _ in range(200)]
        two = one[:80] + [word() for _ in range(28)] + one[108:]
        near, far = one[:80] + two[80:89] + one[89:], one[:80] + two[80:99] + one[99:]
        assert similar(*(shingles(" ".join(t)) for t in (near, far)))
        group = [one, two, near, far]
        for hub in (one, two):
            for _ in range(15):
                t = list(hub)
                t[rng.randrange(80)] = word()
                group.append(t)
        rows += [" ".join(t) for t in group]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    assert {r.doc_id: r.class_id for r in order_minhash.near_duplicates(docs).collect()} == {i: i - i % 34 for i in range(len(rows))}


def test_order_matters(spark):
    """The same sentences in another order are no near-duplicate."""
    rng = random.Random(5)
    parts = [" ".join("".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(40)) for _ in range(6)]
    docs = spark.createDataFrame([(0, " ".join(parts)), (1, " ".join(parts[3:] + parts[:3]))], "doc_id long, text string")
    assert {r.class_id for r in order_minhash.near_duplicates(docs).collect()} == {0, 1}


def test_one_of_each_stays(odd_documents):
    left = order_minhash.keep_one_of_each(odd_documents)
    classes = {r.class_id for r in order_minhash.near_duplicates(odd_documents).collect() if r.class_id is not None}
    assert left.columns == odd_documents.columns
    assert sorted(r.doc_id for r in left.collect() if r.doc_id is not None) == sorted(classes)
    assert left.filter("doc_id IS NULL").count() == 1


def test_rows_that_share_a_key_lose_no_text(spark):
    x, y = " ".join(f"w{i}" for i in range(30)), " ".join(f"v{i}" for i in range(30))
    for rows, want in (([(3, x), (5, x), (5, y)], [(3, x), (5, y)]), ([(5, y), (5, x), (3, x), (3, x)], [(3, x), (5, y)]),
                       ([(7, x), (7, y)], [(7, y), (7, x)]), ([(7, x), (7, x + "!"), (9, x)], None), ([(1, "!!!"), (2, "--"), (3, "! !!"), (4, None), (5, " ")],
                                                                                                    [(1, "!!!"), (2, "--"), (4, None)])):
        df = spark.createDataFrame([(k, t, 1, 2) for k, t in rows], "doc_id long, text string, id int, raw int")
        left = order_minhash.keep_one_of_each(df)
        assert left.columns == df.columns
        got = sorted((r.doc_id, r.text) for r in left.collect())
        assert (got if want else [k for k, _ in got]) == (want or [7])


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(150)] + [(1000 + i, 1001 + i) for i in range(40)] + [(5000, 5001 + i) for i in range(200)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    df = spark.createDataFrame(edges, "a long, b long")
    assert {r.node: r.root for r in components(df).collect()} == {x: find(x) for x in list(root)}
    assert components(df.limit(0)).collect() == []


def test_a_member_is_joined_once_with_all_leaders(spark):
    """Sixteen buckets of the same near copies: a row per member and bucket, and each leader once, however many buckets it leads."""
    rows = [(t, 5, bytes([n]), 100, n) for t in range(16) for n in range(60)] + [(99, 7, b"x", 100, 1), (99, 7, bytes([3]), 10, 9)]
    members = spark.createDataFrame(rows, "t int, key long, node binary, n long, met long")
    led = {bytes(r.node): sorted(r.led) for r in order_minhash._led(members, 3, 0.8).collect()}
    top = ["39", "3A", "3B"]
    assert led == {bytes([n]): [x for x in top if x != f"{n:02X}"] for n in range(60)}
    pairs = order_minhash._candidates(members, 3, 0.8)
    assert {tuple(map(bytes, r)) for r in pairs.collect()} == {tuple(sorted((bytes([n]), bytes([m])))) for n in range(60) for m in (57, 58, 59) if n != m}


def test_groups_of_a_bucket_meet_few_leaders_each(spark, monkeypatch):
    """Pairs of texts behind one passage: a round's pairs grow with the buckets' groups, not with their square."""
    rng = random.Random(11)
    word = lambda: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=9))
    passage = [word() for _ in range(300)]
    rows = []
    for i in range(120):
        own = [word() for _ in range(60)]
        rows += [(2 * i, " ".join(passage + own)), (2 * i + 1, " ".join(passage + own[:-1] + [word()]))]
    made, plain = [], order_minhash._candidates

    def counted(members, *rest):
        pairs = plain(members, *rest)
        made.append((pairs.count(), members.count()))
        return pairs

    monkeypatch.setattr(order_minhash, "_candidates", counted)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.class_id for r in order_minhash.near_duplicates(docs).collect()}
    assert got == {k: k - k % 2 for k, _ in rows}
    assert len(made) > 1 and all(pairs <= 3 * members for pairs, members in made), made
