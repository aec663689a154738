import datetime as dt

from conftest import rows
from pyspark.sql import functions as F

from blogweave.operators import tree, upsert
from blogweave.operators.collection import KeyedCollection
from blogweave.streaming import upsert_stream as ustream

COMMENTS = ("post_id long, comment_id long, parent_id long, banned boolean, time timestamp_ntz, "
            "username string, link string, votes int, message_html string")
T0 = dt.datetime(2024, 1, 1, 10, 0, 0)


def _chain(spark, n, post_id=1):
    data = [(post_id, i, i - 1 if i else None, i % 5 == 0, T0 + dt.timedelta(minutes=i), f"u{i}", f"#{i}", i, "m")
            for i in range(n)]
    return spark.createDataFrame(data, COMMENTS)


def test_depth_150_tree_flattens_completely(spark):
    nested = tree.nest_comments(_chain(spark, 150), depth=8)
    flat = tree.flatten_comments(nested, depth=8)
    got = flat.select("depth", "link", "time", "banned").orderBy("depth").collect()
    assert len(got) == 150 and got[-1].depth == 149 and got[-1].link == "#149"
    assert got[149].time == T0 + dt.timedelta(minutes=149)
    assert [r.banned for r in got[:6]] == [True, False, False, False, False, True]


def test_nest_flatten_identity_with_banned_parents_and_siblings(spark):
    data = [(1, 1, None, True, None, None, "#1", None, None),
            (1, 2, 1, False, T0, "a", "#2", 1, "m"), (1, 3, 1, False, T0, "b", "#3", 2, "m"),
            (1, 4, 3, False, T0, "c", "#4", 3, "m"), (1, 5, None, False, T0, "d", "#5", 4, "m"),
            (2, 6, None, False, T0, "e", "#6", 5, "m")]
    c = spark.createDataFrame(data, COMMENTS)
    flat = tree.flatten_comments(tree.nest_comments(c))
    got = rows(flat.select("post_id", F.array_join(F.transform("path", lambda x: x.cast("string")), ".").alias("p"),
                           "link", "depth"))
    assert got == [(1, "0", "#1", 0), (1, "0.0", "#2", 1), (1, "0.1", "#3", 1), (1, "0.1.0", "#4", 2),
                   (1, "1", "#5", 0), (2, "0", "#6", 0)]


def test_empty_tree_and_orphans(spark):
    c = spark.createDataFrame([(1, 10, 99, False, T0, "x", "#", 1, "m")], COMMENTS)   # parent missing
    assert tree.comment_depths(c).count() == 0
    assert tree.nest_comments(c).count() == 0 and tree.flat_tree(c).count() == 0
    assert rows(tree.tree_dead_letters(c), "comment_id", "error") == [(10, "missing parent")]
    loop = spark.createDataFrame([(1, 1, 2, False, T0, "x", "#", 1, "m"), (1, 2, 1, False, T0, "x", "#", 1, "m"),
                                  (1, 3, None, False, T0, "x", "#", 1, "m")], COMMENTS)
    assert rows(tree.flat_tree(loop), "comment_id", "depth") == [(3, 0)]
    assert rows(tree.tree_dead_letters(loop), "comment_id", "error") == [(1, "unreachable"), (2, "unreachable")]


RECORDS = "_type string, _id string, updated_at timestamp_ntz, seq long, body string"


def test_upsert_latest_wins_and_replay_is_idempotent(spark):
    t = lambda h: T0 + dt.timedelta(hours=h)
    old = spark.createDataFrame([("post", "a", t(1), 0, "a1"), ("post", "b", t(1), 0, "b1")], RECORDS)
    batch = spark.createDataFrame([("post", "a", t(3), 0, "a3"), ("post", "a", t(2), 0, "a2"),
                                   ("user", "a", t(0), 0, "ua"), ("post", "b", t(1), 1, "b1'")], RECORDS)
    new = upsert.upsert(old, batch)
    got = rows(new, "_type", "_id", "body")
    assert got == [("post", "a", "a3"), ("post", "b", "b1'"), ("user", "a", "ua")]
    again = upsert.upsert(new, batch)                      # replaying the batch changes nothing
    assert rows(again, "_type", "_id", "body") == got
    stale = spark.createDataFrame([("post", "a", t(0), 0, "a0")], RECORDS)
    assert rows(upsert.upsert(new, stale), "_type", "_id", "body") == got


def test_hot_key_with_many_versions(spark):
    many = spark.range(0, 30000).select(
        F.lit("post").alias("_type"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("_id"),
        F.lit(T0).cast("timestamp_ntz").alias("updated_at"), F.col("id").alias("seq"), F.col("id").cast("string").alias("body"))
    out = upsert.latest_per_key(many)
    assert out.count() == 20001
    assert out.where("_id = 'hot'").first().body == "29997"


def test_stream_equals_batch(spark, tmp_path):
    t = lambda h: T0 + dt.timedelta(hours=h)
    recs = spark.createDataFrame([("post", str(i % 7), t(i), i, f"v{i}") for i in range(40)], RECORDS)
    src = str(tmp_path / "in")
    recs.withColumn("part", F.col("seq") % 4).write.partitionBy("part").parquet(src)
    import glob
    import shutil
    flat = str(tmp_path / "flat")
    import os
    os.makedirs(flat)
    for i, f in enumerate(sorted(glob.glob(src + "/part=*/*.parquet"))):
        shutil.copy(f, f"{flat}/f{i}.parquet")
    root, ckpt = str(tmp_path / "coll"), str(tmp_path / "ckpt")
    q = ustream.upsert_stream(spark, flat, recs.schema, root, ckpt, max_files_per_trigger=1)
    q.awaitTermination()
    assert KeyedCollection(spark, root).version() >= 2           # several micro-batches
    got = rows(ustream.read_collection(spark, root), "_type", "_id", "body")
    assert got == rows(upsert.upsert(None, recs), "_type", "_id", "body")


def test_deep_tree_survives_json_documents(spark, tmp_path):
    from blogweave.operators import exports
    from blogweave.sources import json_posts
    c = _chain(spark, 12, post_id=7)
    nested = tree.nest_comments(c)                     # default typed depth: deeper levels as VARIANT
    posts = spark.createDataFrame([(7, "b/7", "b", "u", "t", T0, T0, [], [], "c", "x", [], 1, 2, 3, None, None,
                                    None, None, None, 4)],
                                  "post_id long, _id string, blog_id string, url string, title string, "
                                  "published timestamp_ntz, updated_at timestamp_ntz, flags array<string>, "
                                  "hubs array<struct<name:string,url:string>>, company_blog string, "
                                  "content_html string, tags array<string>, pageviews int, favs_count int, "
                                  "voting_score int, author string, author_url string, author_rating double, "
                                  "author_company string, author_user string, comments_count int")
    path = exports.export_posts(exports.with_nested_comments(posts, nested), str(tmp_path / "docs"))
    text = open(next(p for p in (tmp_path / "docs").iterdir() if p.name.startswith("part-") and p.stat().st_size)).read()
    assert text.count('"replies":[') == 12 and '"replies":"' not in text      # real nested arrays
    back = json_posts.normalise_posts(json_posts.read_post_documents(spark, path))
    flat = tree.flatten_comments(back.select("post_id", "comments"))
    assert sorted(r.link for r in flat.collect()) == sorted(f"#{i}" for i in range(12))
    assert flat.agg(F.max("depth")).first()[0] == 11


def test_stream_restart_continues_from_checkpoint(spark, tmp_path):
    t = lambda h: T0 + dt.timedelta(hours=h)
    src, root, ckpt = str(tmp_path / "in"), str(tmp_path / "coll"), str(tmp_path / "ckpt")
    first = spark.createDataFrame([("post", "a", t(1), 0, "a1"), ("post", "b", t(1), 0, "b1")], RECORDS)
    first.coalesce(1).write.parquet(src, mode="append")
    ustream.upsert_stream(spark, src, first.schema, root, ckpt).awaitTermination()
    n1 = KeyedCollection(spark, root).version()
    ustream.upsert_stream(spark, src, first.schema, root, ckpt).awaitTermination()   # nothing new: no snapshot
    assert KeyedCollection(spark, root).version() == n1
    later = spark.createDataFrame([("post", "a", t(2), 0, "a2"), ("post", "c", t(0), 0, "c0")], RECORDS)
    later.coalesce(1).write.parquet(src, mode="append")
    ustream.upsert_stream(spark, src, first.schema, root, ckpt).awaitTermination()
    assert rows(ustream.read_collection(spark, root), "_id", "body") == [("a", "a2"), ("b", "b1"), ("c", "c0")]


def test_collection_rewrites_only_touched_buckets(spark, tmp_path):
    t = lambda h: T0 + dt.timedelta(hours=h)
    coll = KeyedCollection(spark, str(tmp_path / "c"), buckets=16)
    first = spark.createDataFrame([("post", str(i), t(0), 0, f"v0_{i}") for i in range(200)] + [(None, "x", t(0), 0, "lost")], RECORDS)
    assert coll.read() is None and len(coll.merge(first)) == 16
    assert rows(upsert.keyless(first), "body") == [("lost",)]
    one = spark.createDataFrame([("post", "7", t(1), 0, "v1_7")], RECORDS)
    assert len(coll.merge(one)) == 1
    assert sum("v=000000000002" in p for p in coll._pointer()["paths"].values()) == 1      # one bucket has the new version
    got = {r._id: r.body for r in coll.read().collect()}
    assert len(got) == 200 and got["7"] == "v1_7" and got["8"] == "v0_8"
    coll.merge(one)                                                    # the same batch again: unchanged
    assert {r._id: r.body for r in coll.read().collect()} == got
    assert coll.merge(one.limit(0)) == []


def test_narrow_batch_keeps_columns(spark, tmp_path):
    t = lambda h: T0 + dt.timedelta(hours=h)
    coll = KeyedCollection(spark, str(tmp_path / "c"), buckets=1)
    coll.merge(spark.createDataFrame([("post", "a", t(0), 0, "a0"), ("post", "b", t(0), 0, "b0")], RECORDS))
    coll.merge(spark.createDataFrame([("post", "b", t(1), 0, 5)], "_type string, _id string, updated_at timestamp_ntz, seq long, votes int"))
    assert rows(coll.read(), "_id", "body", "votes") == [("a", "a0", None), ("b", None, 5)]      # a record is replaced whole


def test_replayed_batches_and_a_new_checkpoint(spark, tmp_path):
    t = lambda h: T0 + dt.timedelta(hours=h)
    coll = KeyedCollection(spark, str(tmp_path / "c"), buckets=2)
    a = spark.createDataFrame([("post", "a", t(0), 0, "a0")], RECORDS)
    b = spark.createDataFrame([("post", "b", t(0), 0, "b0")], RECORDS)
    assert coll.merge(a, "s", 0) and coll.merge(b, "s", 0) == []       # batch 0 of s was merged: a replay
    assert coll.merge(b, "another", 0)                                 # batch 0 of another stream counts
    assert rows(coll.read(), "_id") == [("a",), ("b",)]


def test_stream_with_a_new_checkpoint_on_an_old_collection(spark, tmp_path):
    t = lambda h: T0 + dt.timedelta(hours=h)
    root = str(tmp_path / "coll")
    for k, body in enumerate(("a", "b")):
        src = str(tmp_path / f"in{k}")
        recs = spark.createDataFrame([("post", body, t(k), 0, body)], RECORDS)
        recs.coalesce(1).write.parquet(src)
        ustream.upsert_stream(spark, src, recs.schema, root, str(tmp_path / f"ckpt{k}")).awaitTermination()
    assert rows(ustream.read_collection(spark, root), "_id") == [("a",), ("b",)]


def test_hot_post_tree(spark):
    # Post 0 holds a third of all comments; its tree is wide and deep.
    data, cid = [], 0
    for post in range(60):
        n = 1500 if post == 0 else 50
        first = cid
        for k in range(n):
            parent = None if k == 0 else first + (k - 1) // 3
            data.append((post, cid, parent, k % 11 == 0, T0, f"u{k % 97}", f"#{cid}", k, "m"))
            cid += 1
    c = spark.createDataFrame(data, COMMENTS)
    depths = {r.comment_id: r.depth for r in tree.comment_depths(c).collect()}
    def depth(k):                                                  # ternary tree: parent (k - 1) // 3
        return 0 if k == 0 else 1 + depth((k - 1) // 3)
    assert len(depths) == len(data) and all(depths[k] == depth(k) for k in range(1500))
    assert {r.comment_id: r.depth for r in tree.flat_tree(c).collect()} == depths
    flat = tree.flatten_comments(tree.nest_comments(c))
    nested = {(r.post_id, tuple(r.path), r.link) for r in flat.collect()}
    assert nested == {(r.post_id, tuple(r.path), r.link) for r in tree.flat_tree(c).collect()}
    got = flat.groupBy("post_id").count().collect()
    assert {r.post_id: r["count"] for r in got} == {p: (1500 if p == 0 else 50) for p in range(60)}


def test_collection_expire_keeps_what_readers_need(spark, tmp_path):
    t = lambda h: T0 + dt.timedelta(hours=h)
    coll = KeyedCollection(spark, str(tmp_path / "c"), buckets=2)
    for v in (1, 2, 3, 4):   # rewrite every bucket each time: versions 1-3 become unreferenced
        coll.merge(spark.createDataFrame([("post", str(i), t(v), 0, f"v{v}") for i in range(20)], RECORDS))
    before = {r._id: r.body for r in coll.read().collect()}
    assert coll.expire(keep=2) == [1, 2]
    assert {r._id: r.body for r in coll.read().collect()} == before == {str(i): "v4" for i in range(20)}
