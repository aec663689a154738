"""Comment trees: flat parent links ⇄ nested documents.

Flat model used by every analytic job: one row per comment with
``path`` (sibling positions from the root), ``depth`` and ``parent_path``.

*Paths* come straight from the parent links (:func:`flat_tree`): sibling
positions by a range-partitioned sort, put together along each comment's
lineage by pointer jumping; no post is gathered.

*Flatten* (nested → flat) is a pure expression over each post row:
``transform``/``flatten`` per level of the depth-limited schema, then one
``inline``; no shuffle, no Python.  Subtrees deeper than the schema arrive
as raw JSON (VARIANT) in the last level and are walked by a small ``mapInPandas``
stack (only those rows go to Python).

*Nest* (flat → nested) is needed to write post documents: a post's comments
sorted by lineage are in pre-order, are written as JSON text with one
``groupBy(post_id)`` and decoded once with ``from_json``.  A post document
holds all its comments, so this group is the output's own size.
"""

from __future__ import annotations

import json
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from blogweave.functions.fields import iso, parse_iso
from blogweave.schemas import TREE_DEPTH, comment_tree_type
from blogweave.session import materialize

NODE_FIELDS = ["banned", "time", "username", "link", "votes", "message_html"]

FLAT_SCHEMA = T.StructType([
    T.StructField("post_id", T.LongType()),
    T.StructField("path", T.ArrayType(T.IntegerType())),
    T.StructField("banned", T.BooleanType()),
    T.StructField("time", T.StringType()),
    T.StructField("username", T.StringType()),
    T.StructField("link", T.StringType()),
    T.StructField("votes", T.IntegerType()),
    T.StructField("message_html", T.StringType()),
])


def _node_type(level: int, depth: int) -> T.StructType:
    """Struct type of a node at ``level`` (0 = top) in the depth-``depth`` schema."""
    return comment_tree_type(depth - level).elementType


def _flat_node(p: Column) -> Column:
    n = p["node"]
    return F.struct(p["path"].alias("path"), *[n[f].alias(f) for f in NODE_FIELDS])


def flatten_comments(posts: DataFrame, col: str = "comments", depth: int = TREE_DEPTH,
                     key: str = "post_id") -> DataFrame:
    """Nested comment arrays → flat rows ``(post_id, path, depth, parent_path, …)``.

    Pre-order within a post is the order of ``path``; the replies of banned
    comments are visited like all others.
    """
    df = posts.select(key, F.col(col).alias("_l0"))
    df = df.withColumn("_l0", F.transform("_l0", lambda c, i: F.struct(F.array(i).alias("path"), c.alias("node"))))
    for k in range(1, depth):
        prev = f"_l{k - 1}"
        df = df.withColumn(f"_l{k}", F.flatten(F.transform(prev, lambda p: F.transform(
            p["node"]["replies"],
            lambda c, i: F.struct(F.concat(p["path"], F.array(i)).alias("path"), c.alias("node"))))))
    last = f"_l{depth - 1}"
    nodes = F.concat(*[F.transform(f"_l{k}", _flat_node) for k in range(depth)])
    overflow = F.filter(last, lambda p: p["node"]["replies"].isNotNull()
                        & (F.to_json(p["node"]["replies"]) != "[]"))
    # Typed levels by expressions; what lies below them is raw JSON and walked.
    per_post = df.select(key, nodes.alias("_nodes"), overflow.alias("_over"))
    deep = per_post.where(F.size("_over") > 0).select(
        key, F.inline(F.transform("_over", lambda p: F.struct(
            p["path"].alias("path"), F.to_json(p["node"]["replies"]).alias("replies")))))
    flat = per_post.select(key, F.inline("_nodes")).unionByName(_walk_deep(deep, key))
    return flat.select(
        key, "path",
        (F.size("path") - 1).alias("depth"),
        F.slice("path", 1, F.size("path") - 1).alias("parent_path"),
        "banned", parse_iso("time").alias("time"), "username", "link", "votes", "message_html")


_NODE_TYPES = [("banned", bool), ("time", str), ("username", str), ("link", str), ("votes", int), ("message_html", str)]


def _typed(value, kind: type):
    """The value if it has the field's type (a number beyond 32 bits has not),
    else null, as in the typed levels."""
    if type(value) is not kind or kind is int and not -2**31 <= value < 2**31:
        return None
    return value


def _walk_deep(deep: DataFrame, key: str) -> DataFrame:
    """Subtrees below the schema depth: explicit-stack walk of the JSON text."""
    schema = FLAT_SCHEMA if key == "post_id" else T.StructType(
        [T.StructField(key, deep.schema[key].dataType)] + FLAT_SCHEMA.fields[1:])

    def walk(batches):
        for pdf in batches:
            out = []
            for k, prefix, text in zip(pdf[key], pdf["path"], pdf["replies"]):
                stack = [(list(prefix), json.loads(text))]
                while stack:
                    base, items = stack.pop()
                    for i, node in enumerate(items or []):
                        path = base + [i]
                        out.append((k, path, *(_typed(node.get(f), t) for f, t in _NODE_TYPES)))
                        stack.append((path, node.get("replies")))
            yield pd.DataFrame(out, columns=[f.name for f in schema.fields])

    return deep.mapInPandas(walk, schema)


def sibling_positions(comments: DataFrame) -> DataFrame:
    """``(comment_id, parent_id, sib)``: place among the comments of the same
    parent, by id.

    All comments are sorted by range of (post, parent, id); a comment's place
    is its place in that order less the first place of its parent's, so a
    parent with any number of replies is never one task's window.
    """
    order = ["post_id", "parent_id", "comment_id"]
    placed, _ = materialize(
        comments.select(*order).repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumn("_at", F.monotonically_increasing_id()), "tree-order")
    # The id counts rows within a partition: partition << 33, then the row.
    part, row = F.shiftright("_at", 33), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))        # one row per task
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    ranked = placed.withColumns({"_part": part, "_row": row}).join(starts, "_part").select(
        *order, (F.col("_start") + F.col("_row")).alias("_rank"))
    first = ranked.groupBy("post_id", "parent_id").agg(F.min("_rank").alias("_first")).select(
        F.col("post_id").alias("_p"), F.col("parent_id").alias("_q"), "_first")
    same = (F.col("post_id") == F.col("_p")) & F.col("parent_id").eqNullSafe(F.col("_q"))
    return ranked.join(first, same).select("comment_id", "parent_id", (F.col("_rank") - F.col("_first")).cast("int").alias("sib"))


def _lineages(links: DataFrame, step: str) -> DataFrame:
    """``(comment_id, depth, seg)``: the values of column ``step`` from the
    root to each comment reachable from a root (``parent_id`` null).

    Pointer jumping: each pending comment keeps an ancestor and what lies
    between; one round replaces the ancestor by the ancestor's own ancestor,
    so the remaining distance halves and a tree of depth D needs about
    log2(D) rounds, whatever D is.  A comment resolves when its ancestor is
    a resolved one.  Every round joins only the pending comments and is
    written to the shared scratch folder (short lineage, one job per round,
    resolved count observed on the way).  Comments under a missing parent drop
    out; comments on a cycle never resolve, and the walk ends when a round
    resolves nothing.
    """
    base, _ = materialize(links.select("comment_id", "parent_id", F.col(step).alias("step")), "tree-links")
    pieces = [base.where(F.col("parent_id").isNull()).select("comment_id", F.array("step").alias("seg"))]
    pending = base.where(F.col("parent_id").isNotNull()).select("comment_id", F.col("parent_id").alias("anc"), F.array("step").alias("seg"))
    while True:
        resolved = pieces[0]
        for p in pieces[1:]:
            resolved = resolved.unionByName(p)
        look = (resolved.select(F.col("comment_id").alias("l_id"), F.lit(None).cast("long").alias("l_anc"), F.col("seg").alias("l_seg"))
                .unionByName(pending.select(F.col("comment_id").alias("l_id"), F.col("anc").alias("l_anc"), F.col("seg").alias("l_seg"))))
        round_, seen = materialize(
            pending.join(look, pending.anc == look.l_id)
            .select("comment_id", F.col("l_anc").alias("anc"), F.concat("l_seg", "seg").alias("seg")),
            "tree-round", newly=F.count_if(F.col("anc").isNull()), left=F.count_if(F.col("anc").isNotNull()))
        if not seen.get("newly"):
            break       # nothing reachable is left (orphans, cycles)
        pieces.append(round_.where(F.col("anc").isNull()).select("comment_id", "seg"))
        pending = round_.where(F.col("anc").isNotNull())
        if not seen.get("left"):
            break       # everything resolved
    out = pieces[0]
    for p in pieces[1:]:
        out = out.unionByName(p)
    return out.select("comment_id", (F.size("seg") - 1).alias("depth"), "seg")


def comment_depths(comments: DataFrame, lineage: bool = False) -> DataFrame:
    """Depth of every comment reachable from a root; ``lineage=True`` also
    returns the comment ids from the root down to the comment: sorting a
    post's comments by it gives pre-order with siblings by id."""
    out = _lineages(comments, "comment_id")
    return out.withColumnRenamed("seg", "lineage") if lineage else out.drop("seg")


def flat_tree(comments: DataFrame) -> DataFrame:
    """Comments with parent links → the same rows with ``path``, ``depth`` and
    ``parent_path``; no row or group holds a whole post.  Comments that no
    root leads to are in :func:`tree_dead_letters`."""
    paths = _lineages(sibling_positions(comments), "sib").withColumnRenamed("seg", "path")
    return comments.join(paths, "comment_id").withColumn("parent_path", F.slice("path", 1, F.size("path") - 1))


def tree_dead_letters(comments: DataFrame) -> DataFrame:
    """Comments that cannot be placed: ``missing parent`` where the parent is
    no comment, ``unreachable`` below such a comment or on a cycle."""
    lost = comments.join(comment_depths(comments).select("comment_id"), "comment_id", "left_anti")
    known = comments.select(F.col("comment_id").alias("_known"))
    return (lost.join(known, lost.parent_id == known._known, "left")
            .select("post_id", "comment_id", "parent_id",
                    F.when(F.col("_known").isNull(), F.lit("missing parent")).otherwise(F.lit("unreachable")).alias("error")))


def preorder(comments: DataFrame, value: Column, name: str = "items") -> DataFrame:
    """``(post_id, items)``: each post's ``struct(lineage, depth, value)``
    in pre-order (siblings by comment id); one ``groupBy(post_id)``."""
    lin = comment_depths(comments, lineage=True)
    rows = comments.join(lin, "comment_id")
    return (rows.select("post_id", F.struct("lineage", "depth", value.alias("v")).alias("it"))
            .groupBy("post_id").agg(F.array_sort(F.collect_list("it")).alias(name)))


def serialize_preorder(items: str, open_: Callable[[Column], Column], close: str,
                       sep: str = "") -> Column:
    """Text of nested trees from pre-order items: each opening, a separator
    unless it follows its parent, and as many closings as the depth drops
    to the next item (all remaining ones after the last)."""
    arr = F.col(items)

    def one(x, i):
        prev = F.try_element_at(arr, i)["depth"] if sep else None
        nxt = F.try_element_at(arr, i + 2)["depth"]
        lead = (F.when((i > 0) & (prev >= x["depth"]), F.lit(sep)).otherwise(F.lit(""))) if sep else F.lit("")
        return F.concat(lead, open_(x["v"]), F.repeat(F.lit(close), x["depth"] - F.coalesce(nxt, F.lit(0)) + 1))

    return F.array_join(F.transform(arr, one), "")


def nest_comments(comments: DataFrame, depth: int = TREE_DEPTH) -> DataFrame:
    """Flat comments with parent links → ``(post_id, comments)`` nested arrays.

    The trees are written as JSON text in pre-order (see :func:`preorder`)
    and decoded once with ``from_json`` into the depth-limited type; levels
    below ``depth`` stay raw JSON (``VARIANT``) in the last typed level.
    Siblings are ordered by ``comment_id``; times become ISO text as in the
    stored documents.
    """
    fields = F.struct(F.col("banned"), iso("time").alias("time"), F.col("username"), F.col("link"),
                      F.col("votes").cast("int").alias("votes"), F.col("message_html"))
    node_open = F.concat(F.regexp_replace(F.to_json(fields), "}$", ""), F.lit(',"replies":['))
    items = preorder(comments, node_open)
    text = F.concat(F.lit("["), serialize_preorder("items", lambda v: v, "]}", sep=","), F.lit("]"))
    return items.select("post_id", F.from_json(text, comment_tree_type(depth)).alias("comments"))
