"""Registry of the jobs J01…J31, each a ``(spark, sf_dir) -> DataFrame``.

Every job reads the driver tables through the adapter views (or data
Spark derives from them) and runs over the whole tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blogweave.fixtures import render
from blogweave.fixtures.site_pages import known_variants, link_variants, page_graph, site_pages
from blogweave.fixtures.views import EPOCH, comments_view, deep_comments_view, posts_view
from blogweave.operators import corpus, exports, extract, favourites, frontier, normalise, profiles, reach, scoped_links, summary, tree
from blogweave.operators import pages as pg
from blogweave.operators import upsert as ups
from blogweave.operators.collection import KeyedCollection
from blogweave.session import configure, materialize, scratch_path, spread
from blogweave.sources import json_posts
from blogweave.sources.dims import fixture_sites, sites_frame
from blogweave.sources.tables import read_table
from blogweave.streaming import upsert_stream as ustream

Job = Callable[[SparkSession, str], DataFrame]
JOBS: dict[str, Job] = {}


def job(name: str):
    def register(fn: Job) -> Job:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            configure(spark)
            return fn(spark, sf_dir)
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        JOBS[name] = run
        return run
    return register


@job("J02_post_summary")
def post_summary(spark, sf_dir):
    """Flagship: 17-column summary per post, ascending post id."""
    return summary.post_summary(posts_view(spark, sf_dir), comments_view(spark, sf_dir))


@job("J03_comment_stats")
def comment_stats(spark, sf_dir):
    """Per post with comments: parsed, banned, first/last time, author comments."""
    return summary.comment_stats(comments_view(spark, sf_dir), posts_view(spark, sf_dir))


# ---------------------------------------------------------------- pages

# Parameters of the fixture's sites.
FIXTURE_ALLOWED_DOMAINS = ["example.com", "example.org"]
FIXTURE_DENY_HOSTS = r"^m\."
FIXTURE_FEED_ROOT = "https://feed.example.org/"


def _pages(spark, sf_dir, *cols):
    """The driver's pages with site markup: page_id, url, html, status."""
    return site_pages(read_table(spark, sf_dir, "pages", "page_id", "url", "html")).select(*(cols or ("page_id", "url", "html")))


@job("J08_extract_links")
def extract_links(spark, sf_dir):
    """Every anchor of every page with kind and absolute URL."""
    return pg.extract_links(_pages(spark, sf_dir))


@job("J09_url_ids")
def url_ids(spark, sf_dir):
    """Blog, company, post, user and hub ids of each page URL."""
    return pg.url_ids(_pages(spark, sf_dir), sites_frame(spark))


@job("J15_visible_text")
def visible_text(spark, sf_dir):
    """Text nodes of each page, joined with no separator."""
    return pg.visible_text(_pages(spark, sf_dir, "page_id", "html"))


@job("J16_usable_pages")
def usable_pages(spark, sf_dir):
    """Pages that are not restricted and have the container element."""
    return pg.usable_pages(_pages(spark, sf_dir))


@job("J17_extraction_outcomes")
def extraction_outcomes(spark, sf_dir):
    """Outcome per fetched page: stored, 404, forbidden or exception."""
    return frontier.extraction_outcomes(_pages(spark, sf_dir, "page_id", "html", "status"))


@job("J18_pending_pages")
def pending_pages(spark, sf_dir):
    """Ids of [0, 2·(max id + 1)) still to fetch after the stored outcomes."""
    p = _pages(spark, sf_dir, "page_id", "html", "status")
    top = p.agg(F.max("page_id").alias("m")).first()["m"]
    return frontier.pending_pages(spark, frontier.extraction_outcomes(p), 0, 2 * (top + 1))


@job("J19_frontier_seeds")
def frontier_seeds(spark, sf_dir):
    """Post id range of the posts × blog sites, plus feed seeds."""
    b = posts_view(spark, sf_dir).agg(F.min("post_id").alias("lo"), F.max("post_id").alias("hi")).first()
    bases = [s[2] for s in fixture_sites()]
    return frontier.frontier_seeds(spark, b["lo"], b["hi"], bases, root=FIXTURE_FEED_ROOT)


def _routed(spark, sf_dir):
    return frontier.route_links(pg.extract_links(_pages(spark, sf_dir)),
                                FIXTURE_ALLOWED_DOMAINS, FIXTURE_DENY_HOSTS)


@job("J20_route_links")
def route_links(spark, sf_dir):
    """First matching routing rule and host checks for every link."""
    return _routed(spark, sf_dir).select("page_id", "pos", "abs_url", "host", "denied", "route", "on_site")


@job("J21_new_links")
def new_links(spark, sf_dir):
    """Distinct on-site links not among the fetched page URLs."""
    return frontier.new_links(_routed(spark, sf_dir), _pages(spark, sf_dir, "url"))


@job("J21_link_identities")
def link_identities(spark, sf_dir):
    """Addresses written in several ways, each counted once, less the known ones."""
    pages = read_table(spark, sf_dir, "pages", "page_id")
    return frontier.link_identities(link_variants(pages), known_variants(pages))


@job("J21_reachable_pages")
def reachable_pages(spark, sf_dir):
    """Depth and first referrer of every page that the stored links lead to from the seeds."""
    pages = read_table(spark, sf_dir, "pages", "page_id", "url")
    return reach.reachable(page_graph(pages), pages.where("page_id % 40 = 3").select("url"))


def _placed(spark, sf_dir, places):
    links = scoped_links.scoped_links(_pages(spark, sf_dir), places)
    return links.select("page_id", "kind", "pos", "href", "abs_url", "priority")


@job("J26_feed_links")
def feed_links(spark, sf_dir):
    """Post titles of the feed and its navigation, by their place in the page."""
    return _placed(spark, sf_dir, scoped_links.FEED)


@job("J08_side_links")
def side_links(spark, sf_dir):
    """Posts and hubs of the side blocks, authors and commenters."""
    return _placed(spark, sf_dir, scoped_links.SIDE)


@job("J19_explicit_seeds")
def explicit_seeds(spark, sf_dir):
    """Seeds of an explicit list of post ids on the first site."""
    return frontier.explicit_post_seeds(posts_view(spark, sf_dir).select("post_id"), fixture_sites()[0][2])


# --------------------------------------------------------------- corpus


@job("J04_post_participants")
def post_participants(spark, sf_dir):
    """Distinct participants per post (author ∪ commenters), sorted."""
    pp = corpus.post_participants(posts_view(spark, sf_dir), comments_view(spark, sf_dir))
    return pp.select("post_id", "blog_id",
                     F.array_join("users_participated", " ").alias("participants"),
                     F.size("users_participated").alias("n_participants"))


@job("J11_word_counts")
def word_counts(spark, sf_dir):
    """(post_id, lemma, n) over the text of every post."""
    return corpus.word_counts(posts_view(spark, sf_dir))


def lemma_dictionary(posts: DataFrame) -> DataFrame:
    """A dictionary made from the corpus itself: tokens of four letters and
    more lose their last one, tokens that end in "x" have an empty lemma."""
    tokens = corpus.vocabulary(posts)
    lemma = F.when(F.col("token").endswith("x"), F.lit("")).otherwise(F.expr("left(token, length(token) - 1)"))
    return tokens.where(F.length("token") >= 4).select("token", lemma.alias("lemma"))


@job("J11_lemma_counts")
def lemma_counts(spark, sf_dir):
    """(post_id, lemma, n) through a dictionary (tokens without one stay)."""
    posts = posts_view(spark, sf_dir)
    return corpus.word_counts(posts, lemma_dictionary(posts))


@job("J12_tag_hub_terms")
def tag_hub_terms(spark, sf_dir):
    """Distinct tag and hub terms per post."""
    return corpus.tag_hub_terms(posts_view(spark, sf_dir))


@job("J13_user_counts")
def user_counts(spark, sf_dir):
    """(post_id, username, n) over comments not banned."""
    return corpus.user_counts(comments_view(spark, sf_dir))


@job("J25_modality_terms")
def modality_terms(spark, sf_dir):
    """Long union of words, author, users, tags and hubs per post."""
    return corpus.modality_terms(posts_view(spark, sf_dir), comments_view(spark, sf_dir))


@job("J14_corpus_lines")
def corpus_lines(spark, sf_dir):
    """One bag-of-words line per post with five modalities."""
    posts = posts_view(spark, sf_dir)
    return corpus.corpus_lines(posts, corpus.modality_terms(posts, comments_view(spark, sf_dir)))


def _participations(spark, sf_dir):
    posts = posts_view(spark, sf_dir)
    return corpus.pairs_with_blog(posts, corpus.participant_pairs(posts, comments_view(spark, sf_dir)))


@job("J22_participant_activity")
def participant_activity(spark, sf_dir):
    """(username, blog, count) descending, with favourites and profile URLs."""
    return corpus.participant_activity(_participations(spark, sf_dir), sites_frame(spark))


@job("J22_participant_total")
def participant_total(spark, sf_dir):
    """Number of distinct (participant, blog) pairs."""
    return corpus.participant_total(_participations(spark, sf_dir))


@job("J22_stored_ranking")
def stored_ranking(spark, sf_dir):
    """The same ranking from posts stored in a keyed collection."""
    posts = posts_view(spark, sf_dir)
    documents = corpus.post_participants(posts, comments_view(spark, sf_dir)).join(posts.select("post_id", "_id", "updated_at"), "post_id")
    coll = KeyedCollection(spark, scratch_path(spark, "posts"), buckets=8)
    coll.merge(documents.select(F.lit("posts").alias("_type"), "_id", "updated_at", F.lit(0).cast("bigint").alias("seq"),
                                "blog_id", "users_participated"))
    return corpus.participant_activity(corpus.unwind_participants(coll.read()), sites_frame(spark))


# --------------------------------------------------------------- fields


@job("J10_normalise_fields")
def normalise_fields(spark, sf_dir):
    """Site texts rendered from ``events`` and parsed back to typed fields."""
    ev = read_table(spark, sf_dir, "events", "event_id", "ts", "value", "props")
    return normalise.normalise_fields(normalise.render_fields(ev))


# ---------------------------------------------------------------- trees


def path_text(col: str = "path"):
    return F.array_join(F.transform(col, lambda x: x.cast("string")), ".")


@job("J24_comment_tree")
def comment_tree(spark, sf_dir):
    """Comments with parent links → flat rows with path and depth."""
    flat = tree.flat_tree(deep_comments_view(spark, sf_dir))
    return flat.select("post_id", path_text().alias("path"), "depth", "banned", "time",
                       "username", "link", "votes", "message_html")


@job("J24_tree_dead_letters")
def tree_dead_letters(spark, sf_dir):
    """Comments that no root leads to: missing parents, replies to those, cycles."""
    return tree.tree_dead_letters(deep_comments_view(spark, sf_dir))


# ------------------------------------------------------ documents, exports


def _posts_nested(spark, sf_dir):
    return exports.with_nested_comments(posts_view(spark, sf_dir),
                                        tree.nest_comments(deep_comments_view(spark, sf_dir)))


def _comment_paths(posts: DataFrame) -> DataFrame:
    """Per post: number of comments and all their paths, sorted."""
    paths = F.array_join(F.array_sort(F.collect_list(path_text())), " ")
    return (tree.flatten_comments(posts.select("post_id", "comments"))
            .groupBy("post_id").agg(F.count(F.lit(1)).alias("n_comments"), paths.alias("comment_paths")))


def _document_summary(posts: DataFrame) -> DataFrame:
    """Scalar columns of normalised documents plus their comment count."""
    return (posts.join(_comment_paths(posts), "post_id", "left")
            .select("post_id", "blog_id", "shape", "title", "published", "updated_at", "favs_count",
                    "pageviews", "comments_count", "author",
                    F.array_join("hub_ids", ",").alias("hub_ids"),
                    F.array_join("tags", ",").alias("tags"),
                    F.coalesce("n_comments", F.lit(0)).alias("n_comments"), "comment_paths"))


@job("J01_posts_scan")
def posts_scan(spark, sf_dir):
    """Documents written in the three historical shapes, read back and unified."""
    shape = F.element_at(F.array(F.lit("v1"), F.lit("v2"), F.lit("v3")),
                         (F.col("post_id") % 3 + 1).cast("int"))
    path = write_lines(spark, exports.render_documents(_posts_nested(spark, sf_dir), shape), "documents")
    raw = json_posts.read_post_documents(spark, path)
    return _document_summary(json_posts.normalise_posts(raw))


@job("J01_corrupt_documents")
def corrupt_documents(spark, sf_dir):
    """Half a document after every whole one: the halves are kept aside."""
    posts = posts_view(spark, sf_dir)
    whole = F.to_json(F.struct("post_id", "blog_id", "title"))
    lines = posts.select(F.explode(F.array(whole, F.concat(F.lit('{"post_id": '), F.col("post_id").cast("string"), F.lit(', "title')))).alias("value"))
    path = scratch_path(spark, "half-documents")
    lines.write.text(path)
    return json_posts.corrupt_documents(json_posts.read_post_documents(spark, path)).select(F.col(json_posts.CORRUPT).alias("line"))


def write_lines(spark, lines: DataFrame, name: str) -> str:
    return exports.write_lines(lines, scratch_path(spark, name))


@job("J29_export_posts")
def export_posts(spark, sf_dir):
    """Unified documents exported as JSON lines and read back."""
    path = exports.export_posts(_posts_nested(spark, sf_dir), scratch_path(spark, "posts-json"))
    back = json_posts.normalise_posts(json_posts.read_post_documents(spark, path))
    return (back.join(_comment_paths(back), "post_id", "left")
            .select("post_id", "_id", "blog_id", "url", "title", "published", "updated_at",
                    F.array_join("flags", ",").alias("flags"), F.array_join("hub_ids", ",").alias("hub_ids"),
                    "company_blog", "favs_count", "voting_score", "author", "comments_count",
                    F.length("content_html").alias("content_length"),
                    F.coalesce("n_comments", F.lit(0)).alias("n_comments"), "comment_paths"))


@job("J30_export_summary")
def export_summary(spark, sf_dir):
    """The post summary written as CSV with header and read back."""
    path = exports.export_summary(post_summary(spark, sf_dir), scratch_path(spark, "summary-csv"))
    return exports.read_summary(spark, path)


@job("J31_export_corpus")
def export_corpus(spark, sf_dir):
    """Corpus lines written as ordered text and read back."""
    path = exports.export_corpus(corpus_lines(spark, sf_dir), scratch_path(spark, "corpus-txt"))
    return exports.read_corpus(spark, path)


# ---------------------------------------------------------- collections


def conversation_records(spark, sf_dir) -> DataFrame:
    """Messages as versioned records: key (role, conversation), version = turn."""
    conv = read_table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    ts = F.timestamp_add("MINUTE", F.col("turn"),
                         F.timestamp_add("HOUR", F.col("conv_id"), F.lit(EPOCH).cast("timestamp_ntz")))
    return ups.with_record_keys(conv.withColumn("ts", ts), "role", ["conv_id"], "ts", "turn")


@job("J27_upsert_latest")
def upsert_latest(spark, sf_dir):
    """Collection of the first two turns, upserted with all later turns."""
    rec = conversation_records(spark, sf_dir)
    collection = ups.upsert(None, rec.where(F.col("turn") < 2))
    return ups.upsert(collection, rec.where(F.col("turn") >= 2))


@job("J28_upsert_stream")
def upsert_stream(spark, sf_dir):
    """The same records streamed file by file, a micro-batch each, into versioned snapshots."""
    rec = conversation_records(spark, sf_dir)
    src = scratch_path(spark, "records-in")
    rec.repartitionByRange(4, "turn").write.parquet(src)
    root, ckpt = scratch_path(spark, "collection"), scratch_path(spark, "stream-ckpt")
    ustream.upsert_stream(spark, src, rec.schema, root, ckpt, buckets=8, max_files_per_trigger=1).awaitTermination()
    return ustream.read_collection(spark, root)


# ----------------------------------------------------------- extraction


def _post_pages(spark, sf_dir, comments):
    return spread(render.post_pages(posts_view(spark, sf_dir), comments))


def _post_columns(posts: DataFrame) -> DataFrame:
    return posts.select("post_id", "blog_id", "url", "title", "published",
                        F.array_join("flags", ",").alias("flags"), F.array_join("hub_ids", ",").alias("hub_ids"),
                        "company_blog", "content_html", F.array_join("tags", ",").alias("tags"),
                        "pageviews", "favs_count", "voting_score", "author_user", "author_company",
                        "comments_count")


@job("J05_extract_posts")
def extract_posts(spark, sf_dir):
    """Post pages rendered from the posts, parsed back into post records."""
    raw = extract.extract_post_pages(_post_pages(spark, sf_dir, comments_view(spark, sf_dir)))
    return _post_columns(extract.posts_from_pages(raw, sites_frame(spark)))


def _stored(pages: DataFrame) -> DataFrame:
    """Rendered pages, written and read like fetched ones, as several files."""
    return materialize(spread(pages), "pages")[0]


def _faulty_pages(spark, sf_dir) -> DataFrame:
    """Post pages of which most have something wrong, by post id."""
    pages = render.post_pages(posts_view(spark, sf_dir), None)
    n, html = F.col("page_id"), F.col("html")
    own = F.concat(F.lit(' id="post_'), n.cast("string"), F.lit('"'))

    def swap(old, new):
        return F.replace(html, old if not isinstance(old, str) else F.lit(old), F.lit(new))

    deep = F.concat(F.repeat(F.lit("<b>"), F.lit(3000)), F.lit("deep"))
    fault = (F.when(n % 8 == 1, swap(own, "")).when(n % 8 == 2, swap(own, ' id="post_99999999999999999999"'))
             .when(n % 8 == 3, swap(".example.org/post/", ".unknown.test/post/"))
             .when(n % 8 == 4, F.replace(html, F.lit('<p class="lead">'), deep))
             .when(n % 8 == 5, swap('<p class="lead">', "<![foo[ x ]]><p>")).when(n % 8 == 6, swap(own, ' id="article_7"'))
             .when(n % 8 == 7, swap('class="post shortcuts_item"', 'class="posts"')).otherwise(html))
    return pages.withColumn("html", fault)


@job("J05_extraction_errors")
def extraction_errors(spark, sf_dir):
    """Every page, whole or faulty, with its post or its error."""
    typed = extract.typed_posts(extract.extract_post_pages(_stored(_faulty_pages(spark, sf_dir))), sites_frame(spark))
    return typed.select("page_id", F.when(F.col("error").isNull(), F.col("_id")).alias("_id"), "error")


@job("J06_extract_comments")
def extract_comments(spark, sf_dir):
    """Comment trees of the rendered post pages, parsed back into flat rows."""
    pages = _post_pages(spark, sf_dir, deep_comments_view(spark, sf_dir))
    c = extract.comments_from_pages(extract.extract_comment_pages(pages))
    return c.select("post_id", path_text().alias("path"), "depth", "banned", "time", "username",
                    "link", "votes", "message_html")


@job("J06_page_participants")
def page_participants(spark, sf_dir):
    """Author and commenters of each rendered post page."""
    raw = extract.extract_post_pages(_post_pages(spark, sf_dir, comments_view(spark, sf_dir)), participants=True)
    return extract.posts_from_pages(raw, sites_frame(spark)).select("post_id", F.array_join("users_participated", " ").alias("participants"))


def _joined(col):
    return F.array_join(col, ",")


def _info_text(col):
    return F.array_join(F.transform(col, lambda e: F.concat(e["key"], F.lit("="), e["value"])), ";")


def _user_pages(spark, sf_dir):
    return render.user_pages(read_table(spark, sf_dir, "customer", "c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"))


@job("J07_user_profiles")
def user_profiles(spark, sf_dir):
    """User pages rendered from ``customer``, parsed back into profiles."""
    u = profiles.user_profiles(profiles.extract_profile_pages(_stored(_user_pages(spark, sf_dir))), sites_frame(spark))
    return u.select("_type", "_id", "blog_id", "page_id", "user_id", "username", "fullname", "avatar_url",
                    "registration_date", "last_activity", "karma", "rating", "about_html", "website_url",
                    _joined("working_companies").alias("working_companies"),
                    _joined("favorite_companies").alias("favorite_companies"),
                    _joined("hubs").alias("hubs"), _joined("tags").alias("tags"),
                    _joined("invites").alias("invites"), _info_text("info").alias("info"))


@job("J07_company_profiles")
def company_profiles(spark, sf_dir):
    """Company pages rendered from ``supplier``, parsed back into profiles."""
    sup = read_table(spark, sf_dir, "supplier", "s_suppkey", "s_name", "s_nationkey")
    c = profiles.company_profiles(profiles.extract_profile_pages(_stored(render.company_pages(sup))), sites_frame(spark))
    return c.select("_type", "_id", "blog_id", "page_id", "company_id", "name", "icon_url", "about_html",
                    "website_url", "registration_date", _joined("staff_users").alias("staff_users"),
                    _info_text("info").alias("info"))


@job("J07_profile_dead_letters")
def profile_dead_letters(spark, sf_dir):
    """User pages of which most lack a header, a known host or an id."""
    n, html = F.col("page_id"), F.col("html")
    pages = _user_pages(spark, sf_dir).withColumn("html", F.when(n % 4 == 1, F.replace(html, F.lit("user_header"), F.lit("header")))
                                                  .when(n % 4 == 2, F.replace(html, F.lit(".example.org/users/"), F.lit(".unknown.test/users/")))
                                                  .when(n % 4 == 3, F.replace(html, F.lit(".example.org/users/"), F.lit(".example.org/people/"))).otherwise(html))
    return profiles.profile_dead_letters(profiles.extract_profile_pages(_stored(pages)), sites_frame(spark)).select("page_id", "error")


def _favourites(spark, sf_dir):
    return render.favourites_pages(comments_view(spark, sf_dir), posts_view(spark, sf_dir))


@job("J23_favourite_edges")
def favourite_edges(spark, sf_dir):
    """Favourites pages rendered from the comments, parsed into (user, post) edges."""
    return favourites.favourite_edges(_favourites(spark, sf_dir), sites_frame(spark))


@job("J23_favourite_pages")
def favourite_pages(spark, sf_dir):
    """Further favourites pages to fetch, before everything else."""
    return favourites.favourite_pages(_favourites(spark, sf_dir))


@job("J05_post_dead_letters")
def post_dead_letters(spark, sf_dir):
    """The driver's pages with site markup through the post extraction: pages
    without a post container or on an unknown host."""
    return extract.post_dead_letters(extract.extract_post_pages(_pages(spark, sf_dir)), sites_frame(spark))
