"""Post documents and file exports (J01 inputs, J29, J30, J31).

Documents are written many per file (one JSON object per line), never one
file per post.  Ordered text outputs are range-partitioned on the post id
and sorted inside each partition: globally ordered across part files
without funnelling everything through one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from blogweave.functions import urls as U
from blogweave.functions.fields import iso
from blogweave.schemas import SUMMARY_COLUMNS, TREE_DEPTH, comment_tree_type

SUMMARY_SCHEMA = T.StructType([
    T.StructField("post_id", T.LongType()),
    T.StructField("last_update", T.TimestampNTZType()),
    T.StructField("published", T.TimestampNTZType()),
    T.StructField("title", T.StringType()),
    T.StructField("author", T.StringType()),
    T.StructField("favs_count", T.IntegerType()),
    T.StructField("pageviews", T.IntegerType()),
    T.StructField("comments_count", T.IntegerType()),
    T.StructField("comments_parsed", T.LongType()),
    T.StructField("comments_banned", T.LongType()),
    T.StructField("first_comment_time", T.TimestampNTZType()),
    T.StructField("last_comment_time", T.TimestampNTZType()),
    T.StructField("author_comments", T.LongType()),
    T.StructField("tags", T.IntegerType()),
    T.StructField("content_length", T.IntegerType()),
    T.StructField("hubs_count", T.IntegerType()),
    T.StructField("hubs", T.StringType()),
])
assert [f.name for f in SUMMARY_SCHEMA.fields] == SUMMARY_COLUMNS

CSV_OPTIONS = {
    "header": "true",
    "quote": '"',
    "escape": '"',          # RFC 4180: quotes doubled inside quoted fields
    "multiLine": "true",
    "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss[.SSSSSS]",
    "encoding": "UTF-8",
    # Values are written exactly (the writer trims by default).
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def with_nested_comments(posts: DataFrame, nested: DataFrame, depth: int = TREE_DEPTH) -> DataFrame:
    """Posts ⟕ their nested comment arrays (posts without comments get [])."""
    empty = F.array().cast(comment_tree_type(depth))
    return (posts.join(nested, "post_id", "left")
            .withColumn("comments", F.coalesce("comments", empty)))


def _pairs(hubs: Column) -> Column:
    return F.transform(hubs, lambda h: F.array(h["name"], h["url"]))


def _hub_ids(hubs: Column) -> Column:
    return F.filter(F.transform(hubs, lambda h: U.hub_id(h["url"])), lambda x: x.isNotNull())


def _company_blog(hubs: Column) -> Column:
    """Company of the last company hub (later hubs win)."""
    companies = F.filter(F.transform(hubs, lambda h: U.company_id(h["url"])), lambda x: x.isNotNull())
    return F.when(F.size(companies) > 0, F.element_at(companies, -1))


def document_v1() -> Column:
    return F.struct(
        F.col("post_id").alias("_id"), iso("updated_at").alias("_last_update"),
        "title", iso("published").alias("published"), "author", "author_url", "author_rating",
        _pairs(F.col("hubs")).alias("hubs"), "favs_count", "pageviews", "tags",
        "comments_count", "content_html", "comments")


def document_v2() -> Column:
    return F.struct(
        F.col("post_id").cast("string").alias("_id"), iso("updated_at").alias("last_update"),
        "title", iso("published").alias("published"), "flags", _pairs(F.col("hubs")).alias("hubs"),
        "content_html", "tags", "pageviews",
        F.coalesce("favs_count", F.lit(0)).alias("favs_count"),   # v2 wrote 0 when missing
        "author", "author_rating", F.col("comments_count").cast("string").alias("comments_count"),
        "comments")


def document_v3() -> Column:
    return F.struct(
        "_id", "blog_id", "post_id", "url", iso("updated_at").alias("_updated"), "title",
        iso("published").alias("published"), "flags", _hub_ids(F.col("hubs")).alias("hubs"),
        _company_blog(F.col("hubs")).alias("company_blog"), "content_html", "tags", "pageviews",
        "favs_count", "voting_score", "author_company", "author_user",
        F.col("comments_count").cast("string").alias("comments_count"), "comments")


def render_documents(posts_nested: DataFrame, shape: Column | str = "v3") -> DataFrame:
    """One JSON text line per post in the given shape (a column may mix them)."""
    shape_col = F.lit(shape) if isinstance(shape, str) else shape
    text = (F.when(shape_col == "v1", F.to_json(document_v1()))
            .when(shape_col == "v2", F.to_json(document_v2()))
            .otherwise(F.to_json(document_v3())))
    return posts_nested.select(text.alias("value"))


def write_lines(lines: DataFrame, path: str) -> str:
    lines.select("value").write.mode("error").text(path)
    return path


def export_posts(posts_nested: DataFrame, path: str) -> str:
    """Unified documents as JSON lines, many posts per file."""
    posts_nested.select(document_v3().alias("d")).select("d.*").write.mode("error").json(path)
    return path


def export_summary(summary: DataFrame, path: str) -> str:
    """Summary CSV with header, fixed column order, ascending post id."""
    (summary.select(*SUMMARY_COLUMNS).repartitionByRange("post_id").sortWithinPartitions("post_id")
     .write.mode("error").options(**CSV_OPTIONS).csv(path))
    return path


def read_summary(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SUMMARY_SCHEMA).options(**CSV_OPTIONS).csv(path)


def export_corpus(lines: DataFrame, path: str) -> str:
    """One corpus line per post, ascending post id across part files."""
    (lines.repartitionByRange("post_id").sortWithinPartitions("post_id")
     .select(F.col("line").alias("value")).write.mode("error").text(path))
    return path


def read_corpus(spark: SparkSession, path: str) -> DataFrame:
    lines = spark.read.text(path)
    return lines.select(F.regexp_extract("value", r"^'([0-9]+)", 1).cast("bigint").alias("post_id"),
                        F.col("value").alias("line"))
