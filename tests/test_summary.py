import datetime as dt

from conftest import rows

from blogweave.operators import summary

COMMENTS = ("post_id long, comment_id long, parent_id long, banned boolean, time timestamp_ntz, "
            "username string, link string, votes int, message_html string")
POSTS = ("post_id long, updated_at timestamp_ntz, published timestamp_ntz, title string, author string, "
         "favs_count int, pageviews int, comments_count int, tags array<string>, content_html string, "
         "hubs array<struct<name:string,url:string>>")
T0 = dt.datetime(2024, 1, 1, 10, 0)


def _posts(spark):
    hubs = [("Python", "http://x.ru/hub/python/"), ("Go", "http://x.ru/hub/go/")]
    return spark.createDataFrame([
        (1, T0, T0, "a", "alice", None, 10, 3, ["t1", "t2"], "<p>xy</p>", hubs),
        (2, T0, T0, "b", None, 5, 20, 0, [], "", []),
        (3, T0, T0, "c", "bob", 1, 30, None, ["t"], "z", hubs[:1]),
    ], POSTS)


def _comments(spark):
    t = lambda m: T0 + dt.timedelta(minutes=m)
    return spark.createDataFrame([
        (1, 10, None, True, None, None, None, None, None),          # banned root
        (1, 11, 10, False, t(5), "alice", "#11", 1, "m"),           # live reply under banned
        (1, 12, 11, False, t(1), "carol", "#12", 2, "m"),
        (1, 13, 10, False, None, "alice", "#13", 0, "m"),           # no time: counted nowhere
        (2, 20, None, False, t(9), "dave", "#20", 1, "m"),
    ], COMMENTS)


def test_comment_stats_counts_and_times(spark):
    got = {r.post_id: r for r in summary.comment_stats(_comments(spark), _posts(spark)).collect()}
    assert got[1].comments_parsed == 2 and got[1].comments_banned == 1
    assert got[1].first_comment_time == T0 + dt.timedelta(minutes=1)
    assert got[1].last_comment_time == T0 + dt.timedelta(minutes=5)
    assert got[1].author_comments == 1          # alice's timed comment only
    assert got[2].author_comments == 0          # post without author


def test_author_key_none_reproduces_original_quirk(spark):
    got = {r.post_id: r.author_comments
           for r in summary.comment_stats(_comments(spark), _posts(spark), author_key=None).collect()}
    # No comment carries the looked-up key: parsed count when the post has no author, else 0.
    assert got == {1: 0, 2: 1}


def test_summary_keeps_posts_without_comments_and_orders_columns(spark):
    out = summary.post_summary(_posts(spark), _comments(spark))
    assert out.columns[:3] == ["post_id", "last_update", "published"] and out.columns[-1] == "hubs"
    got = {r.post_id: r for r in out.collect()}
    assert set(got) == {1, 2, 3}
    assert got[3].comments_parsed == 0 and got[3].first_comment_time is None
    assert got[1].hubs == "Python,Go" and got[1].hubs_count == 2 and got[1].tags == 2
    assert got[1].content_length == len("<p>xy</p>")
    assert [r.post_id for r in out.collect()] == [1, 2, 3]


def test_skewed_post_with_many_comments(spark):
    # One post holds most comments: the aggregation pre-reduces per task.
    from pyspark.sql import functions as F
    hot = (spark.range(0, 20000).select(
        F.when(F.col("id") % 10 < 8, F.lit(1)).otherwise(F.col("id") % 50 + 2).cast("long").alias("post_id"),
        F.col("id").alias("comment_id"), F.lit(None).cast("long").alias("parent_id"),
        (F.col("id") % 7 == 0).alias("banned"), F.lit(T0).cast("timestamp_ntz").alias("time"),
        F.concat(F.lit("u"), (F.col("id") % 100).cast("string")).alias("username"),
        F.lit("#").alias("link"), F.lit(1).alias("votes"), F.lit("m").alias("message_html")))
    got = {r.post_id: r for r in summary.comment_stats(hot).collect()}
    assert got[1].comments_parsed + got[1].comments_banned == 16000
    assert sum(r.comments_parsed + r.comments_banned for r in got.values()) == 20000


def test_participants_unwind_equals_pairs(spark):
    from blogweave.operators import corpus
    from blogweave.sources.dims import sites_frame
    posts = spark.createDataFrame([(1, "b0", "alice/"), (2, "b1", None), (3, "b0", "bob")],
                                  "post_id long, blog_id string, author_user string")
    comments = spark.createDataFrame([(1, False, "alice"), (1, False, "carol"), (1, True, None), (2, False, "carol"),
                                      (3, False, None)], "post_id long, banned boolean, username string")
    docs = corpus.post_participants(posts, comments)
    got = {r.post_id: r.users_participated for r in docs.collect()}
    assert got == {1: ["alice", "carol"], 2: ["carol"], 3: ["bob"]}
    a = corpus.participant_activity(corpus.unwind_participants(docs), sites_frame(spark))
    b = corpus.participant_activity(corpus.pairs_with_blog(posts, corpus.participant_pairs(posts, comments)),
                                    sites_frame(spark))
    assert a.collect() == b.collect()
    assert [(r.username, r["count"], r.priority) for r in a.collect()][:2] == [("alice", 1, 1), ("alice", 1, 0)]


def test_cluster_conf_sizes_partitions():
    from blogweave.session import cluster_conf
    c = cluster_conf(100 * 2**40, 8000)
    assert int(c["spark.sql.shuffle.partitions"]) == 409600
    assert cluster_conf(2**20, 16)["spark.sql.shuffle.partitions"] == "32"
