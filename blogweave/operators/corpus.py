"""Topic-modelling corpus (J11–J14, J25) and participants.

Every modality is a long table ``(post_id, modality, term, n)`` built with
``explode`` + ``groupBy`` (partial aggregation map-side, so a post with a
huge text or a third of all comments is pre-reduced per task).  The line
per post is one ``groupBy(post_id)`` whose group holds only that post's
distinct terms.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blogweave.functions import html as H
from blogweave.functions import text as X
from blogweave.functions import urls as U


def _tokens(posts: DataFrame, keep_comments: bool) -> DataFrame:
    """``(post_id, modality, term)``: normalised tokens longer than two
    characters of each post's visible text, one row each.  The texts are dealt
    out by post, which is less than their words by post would be, and then
    counting the words needs no shuffle."""
    texts = posts.select("post_id", "content_html").repartition("post_id")
    return (texts.select("post_id", F.explode(X.long_tokens(H.visible_text("content_html", keep_comments))).alias("tok"))
            .select("post_id", F.lit("words").alias("modality"), X.normalise_token("tok").alias("term")))


def vocabulary(posts: DataFrame) -> DataFrame:
    """The distinct words (``token``) of all posts."""
    return _lemmatised(_tokens(posts, True), None).select(F.col("term").alias("token")).distinct()


def _lemmatised(terms: DataFrame, lemmas: DataFrame | None) -> DataFrame:
    """Replace words by their lemma (identity when unknown), drop empty ones.
    The dictionary join is left to the planner."""
    if lemmas is not None:
        known = lemmas.select(F.lit("words").alias("modality"), F.col("token").alias("term"), "lemma")
        terms = terms.join(known, ["modality", "term"], "left").withColumn("term", F.coalesce("lemma", "term")).drop("lemma")
    return terms.where(F.length("term") > 0)


def _counted(terms: DataFrame) -> DataFrame:
    return terms.groupBy("post_id", "modality", "term").agg(F.count(F.lit(1)).alias("n"))


def word_counts(posts: DataFrame, lemmas: DataFrame | None = None, keep_comments: bool = True) -> DataFrame:
    """``(post_id, lemma, n)`` over the visible text of each post.

    Tokens longer than two characters are lower-cased, ``ё`` → ``е``, then
    mapped through the optional ``lemmas(token, lemma)`` dictionary (identity
    when absent); empty lemmas are dropped.
    """
    return _counted(_lemmatised(_tokens(posts, keep_comments), lemmas)).select("post_id", F.col("term").alias("lemma"), "n")


def user_counts(comments: DataFrame) -> DataFrame:
    """``(post_id, username, n)`` over comments not banned with a user."""
    return (comments.where(~F.col("banned") & F.col("username").isNotNull())
            .groupBy("post_id", "username").agg(F.count(F.lit(1)).alias("n")))


def _tags_and_hubs():
    """A post's distinct ``struct(kind, term)`` of tags and hub terms."""
    def of(kind: str, terms):
        return F.transform(terms, lambda t: F.struct(F.lit(kind).alias("kind"), t.alias("term")))

    both = F.concat(F.coalesce(of("tag", F.col("tags")), F.array()),
                    F.coalesce(of("hub", F.transform("hubs", lambda h: U.hub_term(h["url"]))), F.array()))
    return F.array_distinct(F.filter(both, lambda x: x["term"].isNotNull()))


def tag_hub_terms(posts: DataFrame) -> DataFrame:
    """Distinct ``(post_id, kind, term)`` of tags and hub terms, made
    distinct within each post's row (a post is one row): no shuffle."""
    return posts.select("post_id", F.inline(_tags_and_hubs()))


def modality_terms(posts: DataFrame, comments: DataFrame, lemmas: DataFrame | None = None) -> DataFrame:
    """Long union of the five modalities ``(post_id, modality, term, n)``.
    One scan of the texts gives the words, one of the narrow columns author,
    tags and hubs, which are distinct within a post's row and need no shuffle."""
    rest = F.transform(_tags_and_hubs(), lambda x: F.struct(
        F.when(x["kind"] == "tag", F.lit("tags")).otherwise(F.lit("hubs")).alias("modality"), x["term"].alias("term")))
    author = F.transform(F.array_compact(F.array("author")), lambda t: F.struct(F.lit("author").alias("modality"), t.alias("term")))
    words = _counted(_lemmatised(_tokens(posts, True), lemmas))
    narrow = posts.select("post_id", F.inline(F.concat(author, rest))).withColumn("n", F.lit(1).cast("bigint"))
    users = user_counts(comments).select("post_id", F.lit("users").alias("modality"), F.col("username").alias("term"), "n")
    return words.unionByName(narrow).unionByName(users)


def corpus_lines(posts: DataFrame, terms: DataFrame) -> DataFrame:
    """``'<id> |words … |author … |users … |tags … |hubs …`` per post.

    Items are escaped after counting (colliding terms stay two items) and
    sorted inside each modality; every post gets a line.
    """
    items = terms.select("post_id", "modality", X.bag_item("term", "n").alias("item"))
    grouped = items.groupBy("post_id").agg(F.collect_list(F.struct("modality", "item")).alias("its"))
    def bag(m: str):
        of_m = F.filter("its", lambda x: x["modality"] == F.lit(m))
        return F.array_join(F.sort_array(F.transform(of_m, lambda x: x["item"])), " ").alias(m)

    bags = [bag(m) for m in X.MODALITIES]
    per_post = grouped.select("post_id", *bags)
    parts = [F.concat(F.lit("'"), F.col("post_id").cast("string"))]
    for m in X.MODALITIES:
        parts += [F.lit("|" + m), F.nullif(F.col(m), F.lit(""))]
    return (posts.select("post_id").join(per_post, "post_id", "left")
            .select("post_id", F.concat_ws(" ", *parts).alias("line")))


def participant_pairs(posts: DataFrame, comments: DataFrame) -> DataFrame:
    """Distinct ``(post_id, user)``: the author and every commenter not
    banned.  Author ids lose surrounding slashes so an author who comments
    counts once.  The ``distinct`` shuffles on both columns, so a post with
    a third of all comments still spreads over many tasks."""
    authors = posts.select("post_id", F.regexp_replace("author_user", "^/+|/+$", "").alias("user"))
    commenters = comments.where(~F.col("banned")).select("post_id", F.col("username").alias("user"))
    return authors.unionByName(commenters).where(F.col("user").isNotNull()).distinct()


def post_participants(posts: DataFrame, comments: DataFrame) -> DataFrame:
    """Distinct participants per post as the sorted array the post
    documents store (one post's distinct users in its row)."""
    pairs = participant_pairs(posts, comments)
    per_post = pairs.groupBy("post_id").agg(F.sort_array(F.collect_list("user")).alias("users_participated"))
    return (posts.select("post_id", "blog_id").join(per_post, "post_id", "left")
            .select("post_id", "blog_id",
                    F.coalesce("users_participated", F.array().cast("array<string>")).alias("users_participated")))


def unwind_participants(posts_with_users: DataFrame) -> DataFrame:
    """``(username, blog_id)`` rows of stored documents: ``explode`` drops
    null and empty arrays like an unwind stage."""
    return posts_with_users.select(F.explode("users_participated").alias("username"), "blog_id")


def pairs_with_blog(posts: DataFrame, pairs: DataFrame) -> DataFrame:
    """``(username, blog_id)`` per participation, straight from the pairs."""
    return pairs.join(posts.select("post_id", "blog_id"), "post_id").select(F.col("user").alias("username"),
                                                                             "blog_id")


def participant_activity(participations: DataFrame, sites: DataFrame) -> DataFrame:
    """Posts per (participant, blog), descending, with two URLs each.

    ``participations`` is one ``(username, blog_id)`` row per post a user
    took part in (from :func:`unwind_participants` or
    :func:`pairs_with_blog`).  The favourites URL gets priority 1, the
    profile URL priority 0.
    """
    counts = participations.groupBy("username", "blog_id").agg(F.count(F.lit(1)).alias("count"))
    base = sites.select("blog_id", F.regexp_replace("base_url", "/+$", "").alias("_origin"))
    profile = F.concat("_origin", F.lit("/users/"), "username", F.lit("/"))
    both = F.array(F.struct(F.concat(profile, F.lit("favorites/")).alias("url"), F.lit(1).alias("priority")),
                   F.struct(profile.alias("url"), F.lit(0).alias("priority")))
    return (counts.join(base, "blog_id").select("username", "blog_id", "count", F.inline(both))
            .orderBy(F.desc("count"), "blog_id", "username", F.desc("priority")))


def participant_total(participations: DataFrame) -> DataFrame:
    """Number of distinct (participant, blog) pairs."""
    return participations.select("username", "blog_id").distinct().agg(F.count(F.lit(1)).alias("total"))
