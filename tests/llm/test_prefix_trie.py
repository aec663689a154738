"""The prefix trie against plain Python and its SQL."""

import hashlib
import math
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from blogweave.llm import ordering
from blogweave.llm import prefix_trie as T
from oracle_compare import duck_connection

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def brute(rows):
    own = defaultdict(list)
    for c, n, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            name = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            own[c].append((n is not None, n or 0, name, (role, text)))
    own = {c: [x[3] for x in sorted(v, key=lambda x: x[:3])] for c, v in own.items()}
    whole = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        whole[c] = own.get(c - int(math.fmod(c, 5)), [])[:h] + turns[h:]
    members = defaultdict(list)
    for c, turns in whole.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for node in members:
        if node:
            children[node[:-1]] += 1
    for node, m in members.items():
        for d in range(len(node) + 1):
            saved[node[:d]] += (len(m) - 1) * len(node[-1][1].encode()) if node else 0
            leaves[node[:d]] += not children[node]
    out = []
    for node, m in members.items():
        ended = ",".join(str(c) for c in sorted(m) if len(whole[c]) == len(node))
        out.append((min(m), len(node), min(members[node[:-1]]) if node else None, len(m), children[node], leaves[node], saved[node],
                    hashlib.sha256(ended.encode()).hexdigest()))
    return sorted(out, key=repr)


def rows_of(df):
    assert [t for c, t in df.select(*COLUMNS[:-1]).dtypes] == ["bigint"] * 7
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=repr)


@pytest.mark.parametrize("block", [50, T.BLOCK])
def test_given_conversations(spark, block):
    conversations = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    got = rows_of(T.conversation_trie(conversations, block))
    assert got == brute([tuple(r) for r in conversations.select("conv_id", "turn", "role", "text").collect()])
    if block == T.BLOCK:
        sql = duck_connection("/root/testdata/sf0.01").sql(T.SQL).project(", ".join(COLUMNS)).fetchall()
        assert got == sorted(sql, key=repr)


def made(seed):
    """Few different turns, so that paths are shared; null and repeated turns, ids far apart and negative, a long conversation."""
    rng = random.Random(seed)
    rows = []
    for c in [*range(60), -7, -6, -5, 10**12, 10**12 + 1, 2**62 + 3]:
        for n in range(rng.choice([0, 1, 2, 3, 5, 8, 12])):
            rows.append((c, rng.choice([n, n, n, None, 0]), rng.choice(["user", "assistant", None, ""]), rng.choice(["é", "b", "", None, "long text"])))
    rows += [rows[0]] * 3 + [(None, 0, "user", "nobody's")] * 2
    rows += [(20, n, "user", str(n % 3)) for n in range(300)] + [(21, n, "user", str(n % 3)) for n in range(300)]
    return rows


def test_made_conversations(spark, monkeypatch):
    monkeypatch.setattr(T, "LISTED", 3)
    rows = made(1)
    got = rows_of(T.conversation_trie(spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA + ", digest string, total int"), 16))
    assert got == brute(rows)


def test_copies_of_one_conversation(spark):
    rows = [(5 * c, n, "user", f"turn {n}") for c in range(400) for n in range(2)]
    assert rows_of(T.conversation_trie(spark.createDataFrame(rows, SCHEMA))) == brute(rows)


def test_no_conversations(spark):
    assert T.conversation_trie(spark.createDataFrame([], SCHEMA)).collect() == []
    assert T.conversation_trie(spark.createDataFrame([(None, 1, "a", "b")], SCHEMA)).collect() == []


def test_list_ranking_of_a_shuffled_list(spark):
    """Successors all over the blocks: nothing is contracted, links are doubled."""
    order = list(range(999))
    random.Random(3).shuffle(order)
    after = dict(zip(order, order[1:]))
    arcs = spark.createDataFrame([(a, after.get(a), 0, 0) for a in range(999)], "arc long, next long, leaves long, saved long")
    got = {r.arc: r.place for r in T.ranked(arcs, 100).collect()}
    assert [got[a] for a in order] == list(range(999))


def test_running_sums_over_blocks(spark):
    rows = [(g, i, (i * 7 + g) % 11) for g, n in ((97, 95), (98, 10), (99, 1), (100, 30)) for i in range(n)]
    df = spark.createDataFrame(rows, "g long, i long, v long")
    want, sums = {}, defaultdict(int)
    for g, i, v in rows:
        sums[g] += v
        want[g, i] = sums[g]
    got = ordering.running_sums(df, "i", {"v": "s"}, ("g",), block=10).collect()
    assert {(r.g, r.i): r.s for r in got} == want
    line = ordering.running_sums(df.filter("g = 97"), "i", {"v": "s"}, block=10).collect()
    assert {r.i: r.s for r in line} == {i: s for (g, i), s in want.items() if g == 97}


def test_numbered(spark):
    df = spark.range(1000).select((F.col("id") * 37 % 1000).alias("v"))
    got = ordering.numbered(df, F.col("v").desc()).collect()
    assert {r.v: r.place for r in got} == {v: 999 - v for v in range(1000)}
