"""Adapter views: the driver tables seen as blog posts and comments.

``documents`` stands for posts and ``events`` for comments (ten events
per document id, forming a tree of depth 0..3 per post).  The same
definitions exist as SQL text in :mod:`blogweave.plans.oracle`, so DuckDB
can check every job on identical inputs.  Everything here is a narrow
projection over one scan: no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from blogweave.sources.dims import FIXTURE_DOMAIN
from blogweave.sources.tables import read_table

EPOCH = "2024-01-01 00:00:00"


def _blog_id(doc_id: Column) -> Column:
    return F.concat(F.lit("b"), (doc_id % 3).cast("string"))


def _base_url(blog_id: Column) -> Column:
    return F.concat(F.lit("https://"), blog_id, F.lit("." + FIXTURE_DOMAIN))


def content_html(text: Column, lang: Column) -> Column:
    """A text as post markup, with a comment and a script in it."""
    for sign, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        text = F.replace(text, F.lit(sign), F.lit(entity))
    return F.concat(F.lit('<p class="lead">'), text, F.lit("</p><!-- cut "), lang,
                    F.lit(" --><script>if (a<b && c) {}</script><br>"))


def posts_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` → posts in the unified model (see FIXTURES.md §3)."""
    d = read_table(spark, sf_dir, "documents", "doc_id", "text", "lang", "source", "n_chars")
    blog = _blog_id(F.col("doc_id"))
    base = _base_url(blog)
    published = F.timestamp_add("HOUR", F.col("doc_id"), F.lit(EPOCH).cast("timestamp_ntz"))
    author = F.when(F.col("doc_id") % 17 != 0,
                    F.concat(F.lit("u"), (F.col("doc_id") % 150).cast("string")))
    return d.select(
        F.concat(blog, F.lit("/"), F.col("doc_id").cast("string")).alias("_id"),
        blog.alias("blog_id"),
        F.col("doc_id").alias("post_id"),
        F.concat(base, F.lit("/post/"), F.col("doc_id").cast("string"), F.lit("/")).alias("url"),
        F.concat("source", F.lit(" #"), F.col("doc_id").cast("string")).alias("title"),
        published.alias("published"),
        F.timestamp_add("MINUTE", F.col("n_chars") % 1000, published).alias("updated_at"),
        F.array_compact(F.array(
            F.when(F.col("n_chars") % 4 == 0, F.lit("tutorial")),
            F.when(F.col("n_chars") % 6 == 0, F.lit("translation")),
        )).alias("flags"),
        F.array(
            F.struct(F.col("lang").alias("name"),
                     F.concat(base, F.lit("/hub/"), F.col("lang"), F.lit("/")).alias("url")),
            F.struct(F.col("source").alias("name"),
                     F.concat(base, F.lit("/company/"), F.col("source"), F.lit("/")).alias("url")),
        ).alias("hubs"),
        F.col("source").alias("company_blog"),
        content_html(F.col("text"), F.col("lang")).alias("content_html"),
        F.array(F.col("lang"), F.col("source")).alias("tags"),
        F.col("n_chars").cast("int").alias("pageviews"),
        F.when(F.col("doc_id") % 5 != 0, F.col("n_chars") % 100).cast("int").alias("favs_count"),
        ((F.col("n_chars") % 21) - 10).cast("int").alias("voting_score"),
        author.alias("author"),
        F.concat(base, F.lit("/users/"), author, F.lit("/")).alias("author_url"),
        ((F.col("n_chars") % 500).cast("double") / 10).alias("author_rating"),
        F.lit(None).cast("string").alias("author_company"),
        author.alias("author_user"),
        F.when(F.col("doc_id") % 11 != 0, F.col("n_chars") % 50).cast("int").alias("comments_count"),
    )


def comments_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` → flat comments with parent links (FIXTURES.md §3)."""
    e = read_table(spark, sf_dir, "events", "event_id", "ts", "user_id", "event_type", "props")
    k = F.col("event_id") % 10
    post_id = F.expr("event_id div 10")
    banned = F.col("event_type") == "error"
    return e.select(
        post_id.alias("post_id"),
        F.col("event_id").alias("comment_id"),
        F.when(k != 0, post_id * 10 + F.expr("(event_id % 10 - 1) div 2")).alias("parent_id"),
        banned.alias("banned"),
        F.when(~F.col("event_type").isin("error", "signup"), F.col("ts")).alias("time"),
        F.when(~banned & (F.col("event_id") % 37 != 0),
               F.concat(F.lit("u"), F.col("user_id").cast("string"))).alias("username"),
        F.concat(F.lit("#comment_"), F.col("event_id").cast("string")).alias("link"),
        F.when(~banned, F.regexp_extract("props", r"(-?[0-9]+)", 1).cast("int")).alias("votes"),
        F.concat(F.lit("<p>"), F.col("event_type"), F.lit(" by u"),
                 F.col("user_id").cast("string"), F.lit("</p>")).alias("message_html"),
    )


def deep_comments_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` → comments of 100 per post: a chain 30 deep, 30 siblings, a
    ternary tree, two comments on a cycle, an orphan with a reply, and roots."""
    e = comments_view(spark, sf_dir)
    k, post = F.col("comment_id") % 100, F.expr("comment_id div 100")
    parent = (F.when(k.between(1, 30), F.col("comment_id") - 1)
              .when(k.between(31, 60), post * 100)
              .when(k.between(61, 90), post * 100 + F.expr("(comment_id % 100 - 1) div 3"))
              .when(k == 91, F.col("comment_id") + 1).when(k == 92, F.col("comment_id") - 1)
              .when(k == 93, -1 - F.col("comment_id")).when(k == 94, F.col("comment_id") - 1))
    return e.withColumns({"post_id": post, "parent_id": parent})
