"""Prefix trie of conversations, summed up by the Euler-tour technique.

A node is a distinct sequence of first turns.  It is known by its depth and the
sums of four 32-bit parts of a hash over (place, turn) pairs, so prefixes need
running sums only and no turn is gathered with the others of its conversation.
The smallest member and the depth name a node, too, and in that order nodes get
dense numbers.

Every node has an arc that enters it and one that leaves it; each arc's
successor follows from the node's first child, next sibling and parent.  The
list of arcs is ranked in two steps: blocks of arcs are contracted to the
segments that stay within them, then segments double their links, round after
round, each written to the shared folder.  Prefix sums of leaves and savings
along the tour then give every subtree's totals as the difference between the
two places of its node.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .ordering import numbered, running_sums
from .sqltext import crc32_sql
from .store import kept

#: Arcs that a task contracts at a time, and places that it sums at a time.
BLOCK = 1 << 16
#: Members that one piece of a node's list of ended conversations holds.
LISTED = 4096
_KEY = ("s0", "s1", "s2", "s3")


def turn_digest(role: Column, text: Column) -> Column:
    return F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)


def rebuilt(conversations: DataFrame, step: int = 5, heads: int = 9) -> tuple[DataFrame, DataFrame]:
    """(conv_id, depth from 1, digest, bytes) of every rebuilt turn and
    (conv_id, total) of every conversation.

    Conversation c has the first h turns of c - c % ``step``, then its own from
    the (h + 1)th on; h = crc32(c as text) % ``heads``.  Turns are ordered by
    ``turn``, nulls first; those of equal numbers by a hash of role and text.
    A null role or text is empty; rows without a conv_id belong to none."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    turns = kept(conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn"), turn_digest(role, text).alias("digest"),
        F.octet_length(text).cast("long").alias("bytes")), "trie-turns")
    placed = numbered(turns, F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("digest"), name="trie-places")
    own = placed.groupBy("conv_id").agg(F.min("place").alias("first"), F.count("*").alias("n"))
    own = own.withColumn("h", F.crc32(F.col("conv_id").cast("string")) % heads).withColumn("base", F.col("conv_id") - F.col("conv_id") % step)
    own = kept(own, "trie-conversations")
    base = own.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"))
    convs = kept(own.join(base, "base", "left").withColumn("taken", F.least("h", F.coalesce("base_n", F.lit(0))))
                 .withColumn("total", F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0))), "trie-conversations")
    at = placed.join(convs.select("conv_id", "first", "h", "taken"), "conv_id").withColumn("i", F.col("place") - F.col("first") + 1)
    rest = at.filter("i > h").select("conv_id", (F.col("taken") + F.col("i") - F.col("h")).alias("depth"), "digest", "bytes")
    first = at.filter(F.col("i") < heads).select(F.col("conv_id").alias("base"), F.col("i").alias("depth"), "digest", "bytes")
    shared = first.join(convs.select("conv_id", "base", "h"), "base").filter("depth <= h").select("conv_id", "depth", "digest", "bytes")
    return rest.unionByName(shared), convs.select("conv_id", "total")


def nodes_of(turns: DataFrame, convs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The nodes (id, conv_id, depth, n_convs, bytes, parent's and own key) and
    where each conversation ends (depth, key, conv_id)."""
    parts = F.md5(F.concat_ws(":", F.col("depth").cast("string"), "digest"))
    turns = turns.withColumn("_h", parts).select(
        "conv_id", "depth", "bytes", (F.col("depth") - 1).alias("at"),
        *[F.conv(F.substring("_h", 1 + 8 * i, 8), 16, 10).cast("long").alias(f"p{i}") for i in range(4)])
    sums = running_sums(kept(turns, "trie-rebuilt"), "at", {f"p{i}": f"s{i}" for i in range(4)}, ("conv_id",))
    prefixes = kept(sums.join(convs, "conv_id").withColumn("ends", F.col("depth") == F.col("total")), "trie-prefixes")
    nodes = prefixes.groupBy("depth", *_KEY).agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.max("bytes").alias("bytes"),
        *[F.max(F.col(f"s{i}") - F.col(f"p{i}")).alias(f"above{i}") for i in range(4)])
    zero, none = F.lit(0).cast("long"), F.lit(None).cast("long")
    root = convs.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).filter("n_convs > 0").select(
        zero.alias("depth"), *[zero.alias(k) for k in _KEY], "conv_id", "n_convs", zero.alias("bytes"), *[none.alias(f"above{i}") for i in range(4)])
    ends = prefixes.filter("ends").select("depth", *_KEY, "conv_id").unionByName(
        convs.filter("total = 0").select(zero.alias("depth"), *[zero.alias(k) for k in _KEY], "conv_id"))
    return numbered(kept(nodes.unionByName(root), "trie-nodes"), F.col("conv_id"), F.col("depth"), column="id", name="trie-numbered"), ends


def listed(ends: DataFrame) -> DataFrame:
    """(depth, key, ends_sha256): of the ended conversations' ids, ascending,
    joined by commas.  The ids are ordered by range and put together in pieces
    of ``LISTED``; one task hashes a node's pieces one after the other."""
    key = ["depth", *_KEY]
    placed = numbered(kept(ends, "trie-ends"), *map(F.col, key), F.col("conv_id"), name="trie-ends")
    pieces = (placed.withColumn("piece", F.expr(f"place div {LISTED}")).groupBy(*key, "piece")
              .agg(F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string")), ",").alias("ids")))

    def run(batches):
        now, state = None, None
        for batch in batches:
            keys, out = zip(*[c.to_pylist() for c in batch.columns[:5]]) if batch.num_rows else (), []
            for k, ids in zip(keys, batch.column(5).to_pylist()):
                if k == now:
                    state.update(b",")
                else:
                    if now is not None:
                        out.append((*now, state.hexdigest()))
                    now, state = k, hashlib.sha256()
                state.update(ids.encode())
            if out:
                yield rows(out)
        if now is not None:
            yield rows([(*now, state.hexdigest())])

    def rows(out):
        columns = list(zip(*out))
        return pa.RecordBatch.from_arrays([*[pa.array(c, pa.int64()) for c in columns[:5]], pa.array(columns[5])], names=[*key, "ends_sha256"])

    return (pieces.repartition(*key).sortWithinPartitions(*key, "piece").select(*key, "ids")
            .mapInArrow(run, "depth long, s0 long, s1 long, s2 long, s3 long, ends_sha256 string"))


def tree_of(nodes: DataFrame, ends: DataFrame) -> DataFrame:
    """The nodes with parent, first child, next sibling (ids), n_children and ends_sha256."""
    above = nodes.select((F.col("depth") + 1).alias("depth"), *[F.col(k).alias(f"above{i}") for i, k in enumerate(_KEY)],
                         F.col("id").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    linked = nodes.join(above, ["depth", *[f"above{i}" for i in range(4)]], "left")
    linked = linked.join(listed(ends), ["depth", *_KEY], "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)))
    linked = kept(linked.select("id", "conv_id", "depth", "n_convs", "bytes", "parent", "parent_conv_id", "ends_sha256"), "trie-linked")
    siblings = numbered(linked.filter("parent IS NOT NULL").select("parent", "id"), F.col("parent"), F.col("id"), name="trie-siblings")
    following = siblings.select("parent", (F.col("place") - 1).alias("place"), F.col("id").alias("sibling"))
    following = siblings.join(following, ["place", "parent"]).select("id", "sibling")
    children = siblings.groupBy("parent").agg(F.min("id").alias("child"), F.count("*").alias("n_children")).withColumnRenamed("parent", "id")
    return kept(linked.join(children, "id", "left").join(following, "id", "left")
                .withColumn("n_children", F.coalesce("n_children", F.lit(0)).cast("long")), "trie-tree")


def arcs_of(tree: DataFrame) -> DataFrame:
    """(arc, next, leaves, saved): 2 id enters and 2 id + 1 leaves a node; values stand at the entry."""
    enter, leave = 2 * F.col("id"), 2 * F.col("id") + 1
    zero = F.lit(0).cast("long")
    both = F.array(
        F.struct(enter.alias("arc"), F.coalesce(2 * F.col("child"), leave).alias("next"), (F.col("n_children") == 0).cast("long").alias("leaves"),
                 ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved")),
        F.struct(leave.alias("arc"), F.coalesce(2 * F.col("sibling"), 2 * F.col("parent") + 1).alias("next"), zero.alias("leaves"), zero.alias("saved")))
    return tree.select(F.inline(both))


def contract(group: pa.Table) -> pa.Table:
    """Segments of the list within a block of arcs: each arc's first arc there
    (``head``) and distance from it; of a head, the segment's length and successor."""
    arc = group.column("arc").to_numpy()
    order = np.argsort(arc)
    arc = arc[order]
    following = group.column("next").fill_null(-1).to_numpy()[order]
    at = np.minimum(np.searchsorted(arc, following), len(arc) - 1)
    inside = arc[at] == following
    pointer = np.arange(len(arc))
    pointer[at[inside]] = np.flatnonzero(inside)               # to the arc before, or to itself
    steps = (pointer != np.arange(len(arc))).astype(np.int64)
    while True:
        further = pointer[pointer]
        if (further == pointer).all():
            break
        steps, pointer = steps + steps[pointer], further
    length, after = np.zeros(len(arc), np.int64), np.full(len(arc), -1)
    tails = np.flatnonzero(~inside)
    length[pointer[tails]], after[pointer[tails]] = steps[tails] + 1, following[tails]
    return pa.table({"arc": arc, "leaves": group.column("leaves").to_numpy()[order], "saved": group.column("saved").to_numpy()[order],
                     "head": arc[pointer], "steps": steps, "length": length, "next": pa.array(after, mask=after < 0)})


def ranked(arcs: DataFrame, block: int = BLOCK) -> DataFrame:
    """``arcs`` with their places (from 0) in the list; arcs are dense numbers."""
    parts = kept(arcs.withColumn("_block", F.expr(f"arc div {block}")).groupBy("_block")
                 .applyInArrow(contract, "arc long, leaves long, saved long, head long, steps long, length long, next long"), "trie-segments")
    # how many arcs there are from a segment's first one to the list's end
    now, left = materialize(parts.filter("arc = head").select("head", F.col("next"), F.col("length").alias("to_end")), "trie-ranks",
                            open=F.count("next"))
    while left["open"]:
        other = now.select(F.col("head").alias("next"), F.col("next").alias("_next"), F.col("to_end").alias("_more"))
        now, left = materialize(now.join(other, "next", "left").select(
            "head", F.col("_next").alias("next"), (F.col("to_end") + F.coalesce("_more", F.lit(0))).alias("to_end")), "trie-ranks", open=F.count("next"))
    total = arcs.count()
    return parts.join(now.select("head", "to_end"), "head").select(
        "arc", "leaves", "saved", (F.lit(total) - F.col("to_end") + F.col("steps")).alias("place"))


def prefix_trie(turns: DataFrame, convs: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row per node of the trie of ``turns`` (conv_id, depth from 1 without
    gaps, digest, bytes) and ``convs`` (conv_id, total), all long but
    ends_sha256: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256.  No conversation gives no node, not even a root."""
    tree = tree_of(*nodes_of(turns, convs))
    along = running_sums(kept(ranked(arcs_of(tree), block), "trie-tour"), "place", {"leaves": "all_leaves", "saved": "all_saved"}, block=block)
    below = along.groupBy(F.expr("arc div 2").alias("id")).agg(
        (F.max("all_leaves") - F.min("all_leaves") + F.max("leaves")).alias("n_leaves"),
        (F.max("all_saved") - F.min("all_saved") + F.max("saved")).alias("saved_tokens"))
    return tree.join(below, "id").select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def conversation_trie(conversations: DataFrame, block: int = BLOCK) -> DataFrame:
    """The trie of the rebuilt ``conversations`` (conv_id, turn, role, text);
    other columns are ignored, and rows that repeat are turns of their own."""
    return prefix_trie(*rebuilt(conversations), block)


#: DuckDB SQL of ``conversation_trie``: prefixes as lists, subtrees by all of a node's ancestors.
SQL = f"""
WITH own AS (
  SELECT conv_id, {{'r': role, 't': text}} AS turn,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(octet_length(encode(role))::VARCHAR || ':' || role || text)) AS i
  FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL)),
heads AS (SELECT conv_id, conv_id - conv_id % 5 AS base, {crc32_sql('conv_id::VARCHAR')} % 9 AS h FROM (SELECT DISTINCT conv_id FROM own)),
turns AS (
  SELECT heads.conv_id, 0 AS part, own.i, own.turn FROM heads JOIN own ON own.conv_id = heads.base AND own.i <= heads.h
  UNION ALL SELECT heads.conv_id, 1, own.i, own.turn FROM heads JOIN own ON own.conv_id = heads.conv_id AND own.i > heads.h),
convs AS (
  SELECT conv_id, coalesce(list(turn ORDER BY part, i) FILTER (turn IS NOT NULL), []) AS turns
  FROM heads LEFT JOIN turns USING (conv_id) GROUP BY conv_id),
prefixes AS (SELECT conv_id, unnest(range(0, len(turns) + 1)) AS depth, turns FROM convs),
nodes AS (
  SELECT depth, turns[:depth] AS prefix, min(conv_id) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (len(turns) = depth), '')) AS ends_sha256
  FROM prefixes GROUP BY depth, turns[:depth]),
children AS (SELECT depth - 1 AS depth, prefix[:depth - 1] AS prefix, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY ALL),
tree AS (
  SELECT nodes.*, coalesce(n_children, 0) AS n_children,
    CASE WHEN nodes.depth > 0 THEN (n_convs - 1) * octet_length(encode(nodes.prefix[nodes.depth].t)) ELSE 0 END AS saved
  FROM nodes LEFT JOIN children USING (depth, prefix)),
above AS (SELECT unnest(range(0, depth + 1)) AS depth, prefix AS whole, n_children, saved FROM tree),
below AS (
  SELECT depth, whole[:depth] AS prefix, count(*) FILTER (n_children = 0) AS n_leaves, sum(saved)::BIGINT AS saved_tokens
  FROM above GROUP BY depth, whole[:depth])
SELECT tree.conv_id, tree.depth::BIGINT AS depth, parents.conv_id AS parent_conv_id, tree.n_convs, tree.n_children, below.n_leaves,
  below.saved_tokens, tree.ends_sha256
FROM tree JOIN below USING (depth, prefix)
LEFT JOIN nodes AS parents ON parents.depth = tree.depth - 1 AND parents.prefix = tree.prefix[:tree.depth - 1]"""
