"""Post documents stored as JSON, in the three historical shapes.

Read with one explicit schema (never inferred), one document per line or
one per file (``multi_line``); malformed documents are kept aside in
``_corrupt_record`` instead of failing the job.  ``normalise_posts`` maps
the three shapes onto the unified post columns:

* v1 — integer ``_id``, ``_last_update``, hub ``[name, url]`` pairs,
  ``author``/``author_url``/``author_rating``, integer comment count;
* v2 — string ``_id``, ``last_update``, pairs, flags, missing favourites
  written as 0, comment count as text;
* v3 — ``blog_id``/``post_id``/``url``, ``_updated``, hub ids, company
  blog, voting score, ``author_user``/``author_company``, participants.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from blogweave.functions import urls as U
from blogweave.functions.fields import parse_iso
from blogweave.schemas import HUB, TREE_DEPTH, post_document_schema

CORRUPT = "_corrupt_record"


def document_schema(depth: int = TREE_DEPTH) -> T.StructType:
    return T.StructType(post_document_schema(depth).fields + [T.StructField(CORRUPT, T.StringType())])


def read_post_documents(spark: SparkSession, path: str, depth: int = TREE_DEPTH,
                        multi_line: bool = False) -> DataFrame:
    """Read JSON post documents (files starting with ``.`` or ``_`` are skipped)."""
    return (spark.read.schema(document_schema(depth))
            .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
            .option("multiLine", multi_line)
            .json(path))


def document_shape() -> F.Column:
    return (F.when(F.col("blog_id").isNotNull() | F.col("post_id").isNotNull(), F.lit("v3"))
            .when(F.col("_last_update").isNotNull(), F.lit("v1"))
            .otherwise(F.lit("v2")))


def normalise_posts(raw: DataFrame, default_blog_id: str | None = None) -> DataFrame:
    """Documents of any shape → unified post columns (comments kept nested)."""
    if CORRUPT in raw.columns:
        raw = raw.where(F.col(CORRUPT).isNull())
    shape = document_shape()
    pairs = F.from_json("hubs", T.ArrayType(T.ArrayType(T.StringType())))
    ids = F.from_json("hubs", T.ArrayType(T.StringType()))
    hub_pairs = F.when(shape != "v3", F.transform(pairs, lambda p: F.struct(
        p[0].alias("name"), p[1].alias("url")).cast(HUB)))
    hub_ids = F.when(shape == "v3", ids).otherwise(
        F.filter(F.transform(pairs, lambda p: U.hub_id(p[1])), lambda x: x.isNotNull()))
    post_id = F.coalesce(F.col("post_id"), F.col("_id").try_cast("bigint"))
    blog_id = F.coalesce(F.col("blog_id"), F.lit(default_blog_id))
    return raw.select(
        F.coalesce(F.when(shape == "v3", F.col("_id")),
                   F.concat(blog_id, F.lit("/"), post_id.cast("string"))).alias("_id"),
        shape.alias("shape"),
        blog_id.alias("blog_id"),
        post_id.alias("post_id"),
        "url", "title",
        parse_iso("published").alias("published"),
        parse_iso(F.coalesce("_updated", "_last_update", "last_update")).alias("updated_at"),
        F.coalesce("flags", F.array().cast("array<string>")).alias("flags"),
        hub_pairs.alias("hubs"),
        hub_ids.alias("hub_ids"),
        "company_blog", "content_html",
        F.coalesce("tags", F.array().cast("array<string>")).alias("tags"),
        F.col("pageviews").cast("int").alias("pageviews"),
        F.col("favs_count").cast("int").alias("favs_count"),
        F.col("voting_score").cast("int").alias("voting_score"),
        F.coalesce("author", "author_user").alias("author"),
        "author_url", "author_rating", "author_company", "author_user",
        "users_participated",
        F.trim(F.col("comments_count")).try_cast("int").alias("comments_count"),
        "comments",
    )


def corrupt_documents(raw: DataFrame) -> DataFrame:
    """Dead letters: the raw text of documents that failed to parse, with
    the file they came from, written to the shared scratch folder (Spark
    does not query raw JSON for the corrupt-record column alone, so the
    dead letters are saved once and read back)."""
    from blogweave.session import materialize
    out, _ = materialize(raw.where(F.col(CORRUPT).isNotNull()).select(
        F.input_file_name().alias("file"), "_id", CORRUPT), "corrupt-documents")
    return out
