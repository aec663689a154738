import datetime as dt
import json

from conftest import rows

from blogweave.sources import json_posts

V1 = {"_id": 501, "_last_update": "2031-02-03T04:05:06", "title": "A kettle that counts", "published": "2030-12-24 08:00:00",
      "author": "tea", "author_url": "http://habrahabr.ru/users/tea/", "author_rating": -0.5,
      "hubs": [["Kitchens", "http://habrahabr.ru/hub/kitchens/"]], "favs_count": None, "pageviews": 12,
      "tags": ["kettle"], "comments_count": 2, "content_html": "<p>boil</p>",
      "comments": [{"banned": True, "replies": [{"banned": False, "time": "2030-12-24T09:30:00.25", "username": "cup",
                                                  "link": "#c2", "votes": -2, "message_html": "hot", "replies": []}]}]}
V2 = {"_id": "502", "last_update": "2031-03-01T00:00:00", "title": "Toast", "published": "2031-01-01T00:00:00",
      "flags": ["tutorial"], "hubs": [["Bread", "http://habrahabr.ru/hub/bread/"], ["Oven", "http://habrahabr.ru/company/oven/"]],
      "content_html": "crust", "tags": [], "pageviews": 5, "favs_count": 0, "author": "rye", "author_rating": 1.0,
      "comments_count": "3", "comments": []}
V3 = {"_id": "geektimes/503", "blog_id": "geektimes", "post_id": 503, "url": "http://geektimes.ru/post/503/",
      "_updated": "2031-04-01T00:00:00", "title": "Jam", "published": "2031-02-01T00:00:00", "flags": [],
      "hubs": ["fruit"], "company_blog": "jars", "content_html": "sweet", "tags": ["plum"], "pageviews": 1,
      "favs_count": None, "voting_score": -4, "author_company": None, "author_user": "plum",
      "users_participated": ["plum"], "comments_count": " 0 ", "comments": []}


def test_documents_one_per_file_three_shapes(spark, tmp_path):
    d = tmp_path / "habr_posts"
    d.mkdir()
    (d / "501").write_text(json.dumps(V1, indent=2))
    (d / "502").write_text(json.dumps(V2, indent=2))
    (d / "503").write_text(json.dumps(V3, indent=2))
    (d / "._404_11").write_text("")                  # outcome markers are skipped
    (d / "12").write_text("{not json")               # corrupt: kept aside
    raw = json_posts.read_post_documents(spark, str(d), multi_line=True)
    assert json_posts.corrupt_documents(raw).count() == 1
    got = {r.post_id: r for r in json_posts.normalise_posts(raw, default_blog_id="habrahabr").collect()}
    assert set(got) == {501, 502, 503}
    a, b, c = got[501], got[502], got[503]
    assert (a.shape, a._id, a.author, a.updated_at) == ("v1", "habrahabr/501", "tea", dt.datetime(2031, 2, 3, 4, 5, 6))
    assert [h.name for h in a.hubs] == ["Kitchens"] and a.hub_ids == ["kitchens"] and a.published == dt.datetime(2030, 12, 24, 8) and a.comments_count == 2
    assert (b.shape, b.favs_count, b.comments_count, b.hub_ids, b.flags) == ("v2", 0, 3, ["bread"], ["tutorial"])
    assert (c.shape, c._id, c.blog_id, c.hub_ids, c.author, c.voting_score, c.comments_count) == (
        "v3", "geektimes/503", "geektimes", ["fruit"], "plum", -4, 0)
    from blogweave.operators import tree
    flat = tree.flatten_comments(json_posts.normalise_posts(raw, "habrahabr").select("post_id", "comments"))
    assert rows(flat, "post_id", "depth", "banned", "votes") == [(501, 0, True, None), (501, 1, False, -2)]


def test_corpus_export_is_ordered_across_part_files(spark, tmp_path):
    import glob

    from conftest import SF001

    from blogweave.operators import corpus, exports
    from blogweave.fixtures.views import comments_view, posts_view
    posts = posts_view(spark, SF001)
    lines = corpus.corpus_lines(posts, corpus.modality_terms(posts, comments_view(spark, SF001)))
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")        # keep several part files at this tiny scale
    try:
        path = exports.export_corpus(lines, str(tmp_path / "corpus"))
    finally:
        spark.conf.set(key, "true")
    parts = sorted(glob.glob(path + "/part-*"))
    assert len(parts) > 1
    ids = [int(line.split(" ", 1)[0][1:]) for p in parts for line in open(p, encoding="utf-8") if line.strip()]
    assert ids == sorted(ids) and len(ids) == posts.count()


def test_documents_to_summary_csv(spark, tmp_path):
    """The original's main flow on the public API: post documents (one JSON
    per file) → unified posts + flat comments → summary → CSV."""
    d = tmp_path / "posts"
    d.mkdir()
    (d / "501").write_text(json.dumps(V1))
    (d / "502").write_text(json.dumps(V2))
    from blogweave.operators import exports, summary, tree
    posts = json_posts.normalise_posts(json_posts.read_post_documents(spark, str(d), multi_line=True), "habrahabr")
    comments = tree.flatten_comments(posts.select("post_id", "comments"))
    out = exports.export_summary(summary.post_summary(posts, comments), str(tmp_path / "summary"))
    got = {r.post_id: r for r in exports.read_summary(spark, out).collect()}
    a = got[501]
    assert (a.comments_parsed, a.comments_banned, a.author_comments, a.hubs, a.hubs_count, a.tags) == (1, 1, 0, "Kitchens", 1, 1)
    assert a.first_comment_time == dt.datetime(2030, 12, 24, 9, 30, 0, 250000) and a.favs_count is None
    assert (got[502].comments_parsed, got[502].hubs, got[502].content_length) == (0, "Bread,Oven", 5)
