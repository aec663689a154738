"""Near-duplicate documents by Order MinHash.

A document is the sequence of its k-mers of ``K`` words (words: runs of
letters, digits and anything beyond ASCII, A-Z lower-cased); a document of
fewer words is one k-mer.  Two documents are near-duplicates when their
ordered similarity L / (n1 + n2 - L) is ``similarity`` or more, L being the
longest common subsequence of the two sequences of n1 and n2 k-mers.

Each of ``tables`` sketches takes the ``LEAST`` k-mers with the smallest hashes,
k-mers labelled by their occurrence in the document, and keeps them in text
order; equal sketches make candidates.  Documents of equal sequences are one
class from the start.  In a bucket, every class is a candidate with a few
leaders, so that a bucket's pairs grow with its size only.  Leaders are the
classes that meet most others over all tables: what many were copied from is
nearer to each copy than the copies are to each other, and meets most of them.
Then the groups that a bucket still holds are, each by one member, candidates
with as many of them, until a round finds no new link: more leaders would pair
small buckets in full.  What leaders leave open is settled without a cap: all
members of buckets that still hold several groups are joined, across groups, by
their rarest k-mers, as many of them as any two similar sequences must share
one of.
Candidates are verified by a banded alignment.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bitmaps import bitmap_of, dense, passes
from .components import joined, stars
from .store import kept
from .textblocks import ALNUM, ASCII_LOWER, Block, blocks, map_batches, mix, sections, span_hashes, spans, string_column, windows

K, LEAST, TABLES, SIMILARITY = 5, 3, 16, 0.8
LEADERS = 3
CELL_BITS = 20           # k-mers are counted by so many bits: 1 M counts, whatever the number of texts
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_WHITE = b" \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f"


def kmers(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """All rows' k-mers, and the first k-mer of each row."""
    lower = Block(block.rows, ASCII_LOWER[block.data], block.offsets)
    starts, ends, first = spans(lower, ALNUM)
    words = span_hashes(lower.data, starts, ends)
    n = np.diff(first)
    whole = windows(words, K)
    # a window belongs to the row where it starts if it ends there too
    row = np.repeat(np.arange(len(n)), n)[:len(whole)]
    inside = np.arange(len(whole)) + K <= first[row + 1]
    counts = np.where(n >= K, n - K + 1, np.minimum(n, 1))
    at = sections(counts)
    out = np.zeros(at[-1], np.uint64)
    long = np.repeat(n >= K, counts)
    out[long] = whole[inside]
    for r in np.flatnonzero((n > 0) & (n < K)):
        out[at[r]] = windows(words[first[r]:first[r + 1]], int(n[r]))[0] ^ np.uint64(n[r])
    return out, at


def _labelled(values: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Each k-mer's hash with its occurrence in the row."""
    own = values ^ mix(row.astype(np.uint64) + _GOLDEN)
    order = np.argsort(own, kind="stable")
    ordered = own[order]
    new = np.concatenate([[True], ordered[1:] != ordered[:-1]]) if len(ordered) else np.zeros(0, bool)
    start = np.maximum.accumulate(np.where(new, np.arange(len(ordered)), 0)) if len(ordered) else np.zeros(0, np.int64)
    nth = np.empty(len(values), np.uint64)
    nth[order] = (np.arange(len(ordered)) - start).astype(np.uint64)
    return mix(values + nth * _GOLDEN)


def sketches(values: np.ndarray, at: np.ndarray, tables: int = TABLES) -> np.ndarray:
    """Per row and table, a hash of its least labelled k-mers in text order."""
    counts = np.diff(at)
    full = np.flatnonzero(counts)
    out = np.zeros((len(counts), tables), np.uint64)
    if not len(full):
        return out
    begin, sizes = at[full], counts[full]
    row = np.repeat(np.arange(len(full)), sizes)
    labelled = _labelled(values, row)
    top = np.uint64(2**64 - 1)
    for t in range(tables):
        h = mix(labelled ^ mix(np.array([t + 1], np.uint64) * _GOLDEN))
        place = np.full((LEAST, len(full)), np.iinfo(np.int64).max)
        for j in range(LEAST):
            least = np.minimum.reduceat(h, begin)
            hit = np.flatnonzero((h == least[row]) & (h != top))
            rows, firsts = np.unique(row[hit], return_index=True)
            place[j, rows] = hit[firsts]
            h[hit[firsts]] = top
        place.sort(axis=0)
        key = np.full(len(full), t, np.uint64)
        for j in range(LEAST):
            had = place[j] < np.iinfo(np.int64).max
            key[had] = mix(key[had] ^ labelled[place[j][had]]) + _GOLDEN
        out[full, t] = key
    return out


def _nodes(values: np.ndarray, at: np.ndarray) -> list[bytes]:
    """128-bit names of the rows' sequences."""
    counts = np.diff(at)
    place = (np.arange(len(values)) - np.repeat(at[:-1], counts)).astype(np.uint64)
    out = np.zeros((len(counts), 2), "<u8")
    full = np.flatnonzero(counts)
    for j, seed in enumerate((0x1234567, 0x89ABCDEF)):
        own = mix(values ^ mix(place + mix(np.array([seed], np.uint64))))
        if len(full):
            out[full, j] = np.add.reduceat(own, at[full])
        out[:, j] ^= counts.astype(np.uint64)
    raw = out.tobytes()
    return [raw[i:i + 16] for i in range(0, len(raw), 16)]


def common(a: np.ndarray, b: np.ndarray, band: int) -> int:
    """Longest common subsequence by an alignment within ``band`` of the
    diagonal: a row of the alignment is one integer of bits, matches outside
    the band are masked out."""
    n = min(len(a), len(b))
    same = a[:n] == b[:n]
    head = n if same.all() else int(same.argmin())
    a, b, n = a[head:], b[head:], n - head
    same = a[len(a) - n:][::-1] == b[len(b) - n:][::-1]
    tail = n if same.all() else int(same.argmin())
    a, b = a[:len(a) - tail].tolist(), b[:len(b) - tail].tolist()
    if not a or not b:
        return head + tail
    where: dict[int, int] = {}
    for i, x in enumerate(a):
        where[x] = where.get(x, 0) | 1 << i
    every = (1 << len(a)) - 1
    width = (1 << (2 * band + 1)) - 1
    row = every
    for j, x in enumerate(b):
        match = where.get(x)
        if match:
            low = j - band
            match &= width << low if low >= 0 else width >> -low
            hit = row & match
            row = (row + hit | row - hit) & every
    return head + tail + len(a) - row.bit_count()


def ordered_similarity(a: np.ndarray, b: np.ndarray, least: float) -> float:
    """L / (n1 + n2 - L), or 0 where it is below ``least``."""
    total = len(a) + len(b)
    need = math.ceil(total * least / (1 + least) - 1e-9)
    if min(len(a), len(b)) < need:
        return 0.0
    # No alignment has more matches than the multisets share.
    x, nx = np.unique(a, return_counts=True)
    y, ny = np.unique(b, return_counts=True)
    _, i, j = np.intersect1d(x, y, assume_unique=True, return_indices=True)
    if np.minimum(nx[i], ny[j]).sum() < need:
        return 0.0
    length = common(a, b, total - 2 * need)       # as many insertions and deletions can be in a close pair
    return length / (total - length) if length >= need else 0.0


def sketch_table(docs: DataFrame, key: str, text: str, tables: int) -> DataFrame:
    """id, node (the sequence's name; of a text without words, a name of its
    characters other than white space), n (its k-mers), sketches, and a hash of
    the text as it is."""
    schema = pa.schema([("id", pa.int64()), ("node", pa.binary()), ("n", pa.int64()), ("keys", pa.list_(pa.int64())), ("raw", pa.int64())])

    def work(batch):
        ids = batch.column(0)
        for block in blocks(string_column(batch, text)):
            values, at = kmers(block)
            nodes = _nodes(values, at)
            for r in np.flatnonzero(np.diff(at) == 0):
                nodes[r] = hashlib.md5(block.data[block.offsets[r]:block.offsets[r + 1]].tobytes().translate(None, _WHITE)).digest()
            keys = sketches(values, at, tables).view(np.int64)
            flat = pa.ListArray.from_arrays(pa.array(np.arange(0, keys.size + 1, tables, dtype=np.int32)), pa.array(keys.reshape(-1)))
            yield [ids[block.rows], pa.array(nodes, pa.binary()), np.diff(at), flat, batch.column(2)[block.rows]]

    return docs.select(F.col(key).cast("long").alias("id"), text, F.xxhash64(text).alias("raw")).mapInArrow(
        map_batches(schema, work), "id long, node binary, n long, keys array<long>, raw long")


def sequences(docs: DataFrame, text: str, wanted: np.ndarray) -> DataFrame:
    """node, grams (k-mers as unsigned integers of four bytes) of the rows
    whose node passes the bitmap; copies may repeat."""
    schema = pa.schema([("node", pa.binary()), ("grams", pa.binary())])

    def work(batch):
        for block in blocks(string_column(batch, text)):
            values, at = kmers(block)
            nodes = _nodes(values, at)
            rows = np.flatnonzero(passes(wanted, np.frombuffer(b"".join(nodes), "<u8")[::2]))
            if len(rows):
                short = (values >> np.uint64(32)).astype("<u4")
                yield [pa.array([nodes[r] for r in rows], pa.binary()), pa.array([short[at[r]:at[r + 1]].tobytes() for r in rows], pa.binary())]

    return docs.select(text).mapInArrow(map_batches(schema, work), "node binary, grams binary")


def node_hashes(nodes: DataFrame) -> DataFrame:
    schema = pa.schema([("hash", pa.int64())])

    def work(batch):
        yield [np.frombuffer(b"".join(batch.column(0).to_pylist()), "<i8")[::2].copy()]

    return nodes.select("node").mapInArrow(map_batches(schema, work), "hash long")


def verified(pairs: DataFrame, grams: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) with their similarity, 0 where it is too low."""
    schema = pa.schema([("a", pa.binary()), ("b", pa.binary()), ("similarity", pa.float64())])

    def work(batch):
        yield [batch.column(0), batch.column(1),
               pa.array([ordered_similarity(np.frombuffer(x, "<u4"), np.frombuffer(y, "<u4"), similarity)
                         for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())], pa.float64())]

    both = (pairs.join(grams.select(F.col("node").alias("a"), F.col("grams").alias("x")), "a")
            .join(grams.select(F.col("node").alias("b"), F.col("grams").alias("y")), "b").select("a", "b", "x", "y"))
    return both.mapInArrow(map_batches(schema, work), "a binary, b binary, similarity double")


def _led(members: DataFrame, leaders: int, similarity: float) -> DataFrame:
    """Per node of the members (t, key, node, n, met): the leaders of its
    buckets, each once, where their lengths allow the similarity.  A bucket's
    leaders are one row, so that each member is joined once, whatever their number."""
    most = Window.partitionBy("t", "key").orderBy(F.col("met").desc(), "node")
    led = (members.withColumn("r", F.row_number().over(most)).filter(F.col("r") <= leaders)
           .groupBy("t", "key").agg(F.collect_list(F.struct("node", "n")).alias("led")))
    fits = lambda x: F.least("n", x["n"]) >= F.lit(similarity - 1e-9) * F.greatest("n", x["n"])
    own = F.filter("led", lambda x: (x["node"] != F.col("node")) & fits(x))
    names = F.transform(own, lambda x: F.hex(x["node"]))       # arrays of text are made distinct by hashing
    return (members.join(led, ["t", "key"]).select("node", names.alias("led")).filter(F.size("led") > 0)
            .groupBy("node").agg(F.array_distinct(F.flatten(F.collect_list("led"))).alias("led")))


def _candidates(members: DataFrame, leaders: int, similarity: float) -> DataFrame:
    """Each member of a bucket with the bucket's leaders, as pairs (a, b)."""
    rows = _led(members, leaders, similarity).select("node", F.explode("led").alias("led")).select("node", F.unhex("led").alias("leader"))
    return rows.select(F.least("node", "leader").alias("a"), F.greatest("node", "leader").alias("b")).distinct()


def rarity(grams: DataFrame) -> np.ndarray:
    """How many k-mers of these sequences are in each cell of k-mers."""
    def work(batches):
        counts = np.zeros(1 << CELL_BITS, np.int64)
        for batch in batches:
            for g in batch.column(0).to_pylist():
                np.add.at(counts, np.frombuffer(g, "<u4") >> np.uint32(32 - CELL_BITS), 1)
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(counts[some])], names=["cell", "n"])

    seen = grams.select("grams").mapInArrow(work, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    return dense(seen, "cell", "n", 1 << CELL_BITS, "<i8")


def prefix(grams: np.ndarray, counts: np.ndarray, similarity: float) -> np.ndarray:
    """The rarest k-mers, labelled by their occurrence, in an order that is the
    same for all sequences; as many as a similar one must share one of."""
    ordered = np.sort(grams)
    new = np.concatenate([[True], ordered[1:] != ordered[:-1]])
    start = np.maximum.accumulate(np.where(new, np.arange(len(ordered)), 0))
    token = ordered.astype(np.uint64) << np.uint64(32) | (np.arange(len(ordered)) - start).astype(np.uint64)
    order = np.lexsort((token, counts[ordered >> np.uint32(32 - CELL_BITS)]))
    return token[order[:len(grams) - math.ceil(similarity * len(grams) - 1e-9) + 1]]


def pairs_across(apart: DataFrame, similarity: float) -> DataFrame:
    """All pairs (a, b) of sequences (node, root, grams) of different roots
    that can be similar; only what cannot be is left out.

    Two sequences of m <= n k-mers with an overlap of ``need`` or more have
    their first common k-mer, in any one order, at a place that leaves ``need``
    k-mers in both: among the n - s n + 1 first of the longer one, and, as need
    is at least 2 s m / (1 + s), among still fewer of the shorter one.
    """
    counts = rarity(apart)
    schema = pa.schema([("node", pa.binary()), ("root", pa.binary()), ("n", pa.int64()), ("tokens", pa.list_(pa.int64()))])

    def work(batch):
        grams = [np.frombuffer(g, "<u4") for g in batch.column(2).to_pylist()]
        yield [batch.column(0), batch.column(1), pa.array([len(g) for g in grams], pa.int64()),
               pa.array([prefix(g, counts, similarity).view(np.int64) for g in grams], pa.list_(pa.int64()))]

    share = similarity / (1 + similarity)
    rows = apart.select("node", "root", "grams").mapInArrow(map_batches(schema, work), "node binary, root binary, n long, tokens array<long>")
    rows = rows.select("node", "root", "n", F.posexplode("tokens").alias("at", "token"))
    # a k-mer of one group only joins nothing
    several = rows.groupBy("token").agg(F.min("root").alias("one"), F.max("root").alias("other")).filter("one != other").select("token")
    rows = kept(rows.join(several, "token").select("token", "root", "node", "n", (F.col("n") - F.col("at")).alias("rest")), "omh-prefixes")
    short = rows.filter(F.col("rest") >= F.ceil(2 * share * F.col("n") - 1e-9))

    def sides(df: DataFrame, side: str) -> DataFrame:
        return df.select("token", *[F.col(c).alias(c + side) for c in df.columns if c != "token"])

    def of_groups(df: DataFrame) -> DataFrame:
        return df.groupBy("token", "root").agg(F.min("n").alias("least"), F.max("n").alias("most"), F.max("rest").alias("rest"))

    # Groups first: the members of one group are never paired with each other.
    groups = (sides(of_groups(short), "1").join(sides(of_groups(rows), "2"), "token")
              .filter((F.col("root1") != F.col("root2")) & (F.col("least1") <= F.col("most2")) & (F.col("most1") >= similarity * F.col("least2") - 1e-9)
                      & (F.least("rest1", "rest2") >= F.ceil(share * (F.col("least1") + F.col("least2")) - 1e-9)))
              .select("token", "root1", "root2"))
    met = (sides(short, "1").join(groups, ["token", "root1"]).join(sides(rows, "2"), ["token", "root2"])
           .filter((F.col("n1") <= F.col("n2")) & (F.col("n1") >= similarity * F.col("n2") - 1e-9)
                   & (F.least("rest1", "rest2") >= F.ceil(share * (F.col("n1") + F.col("n2")) - 1e-9))))
    return met.select(F.least("node1", "node2").alias("a"), F.greatest("node1", "node2").alias("b")).distinct()


def _linked(roots: DataFrame | None, links: DataFrame) -> DataFrame:
    """of, root of the nodes that hang on another; a node that is not there is its own root."""
    edges = links.select("a", "b")
    return (stars(edges) if roots is None else kept(joined(roots, edges), "omh-components")).withColumnRenamed("node", "of")


def _open(members: DataFrame, roots: DataFrame | None) -> DataFrame:
    """The members (t, key, node, n, met) of the buckets that hold several
    groups, with their roots and the bucket's size."""
    own = members.select("t", "key", "node", "n", "met")
    own = (own.withColumn("root", F.col("node")) if roots is None else
           own.join(roots, own.node == roots.of, "left").select("t", "key", "node", "n", "met", F.coalesce("root", "node").alias("root")))
    several = (own.groupBy("t", "key").agg(F.count("*").alias("size"), F.min("root").alias("one"), F.max("root").alias("other"))
               .filter("one != other").select("t", "key", "size"))
    # dealt out for the join alone, as in _with_least: a large bucket's rows can be split over tasks
    spot = F.xxhash64("t", "key")
    return kept(own.withColumn("h", spot).join(several.withColumn("h", spot), ["h", "t", "key"]).drop("h"), "omh-open")


def _classified(docs: DataFrame, key: str, text: str, similarity: float, tables: int) -> DataFrame:
    """Per row of ``docs``: id, raw (a hash of its text), node, copy_of, class_id and root (a node that stands for the class)."""
    sketched = kept(sketch_table(docs, key, text, tables), "omh-sketches")
    # all rows of a node have the same sketches
    classes = kept(sketched.filter("id IS NOT NULL").groupBy("node").agg(F.min("id").alias("rep"), F.min("n").alias("n"), F.first("keys").alias("keys")),
                   "omh-classes")
    members = (classes.filter("n > 0").select("node", "n", F.posexplode("keys").alias("t", "key")))
    shared = members.groupBy("t", "key").agg(F.count("*").alias("size")).filter("size > 1")
    # a node has a bucket a table at most
    members = (members.join(shared, ["t", "key"]).groupBy("node")
               .agg(F.first("n").alias("n"), F.sum("size").alias("met"), F.collect_list(F.struct("t", "key")).alias("buckets")))
    members = kept(members.select("node", "n", "met", F.inline("buckets")), "omh-members")
    # every class that shares a bucket may be asked for, in this round or a later one
    wanted = bitmap_of(node_hashes(members), "hash")
    texts = kept(sequences(docs, text, wanted).dropDuplicates(["node"]), "omh-texts")

    # Of each round, the buckets that hold several groups go into the next one.
    roots, left = None, members
    tried = kept(verified(_candidates(members, LEADERS, similarity), texts, similarity), "omh-tried")
    new = tried.filter(F.col("similarity") >= similarity)
    while new.limit(1).count():
        roots = _linked(roots, new)
        left = _open(left, roots)
        # a bucket's groups, each by one member
        most = Window.partitionBy("t", "key", "root").orderBy(F.col("met").desc(), "node")
        chosen = left.withColumn("r", F.row_number().over(most)).filter(F.col("r") == 1).select("t", "key", "node", "n", "met")
        pairs = _candidates(chosen, LEADERS, similarity).join(tried, ["a", "b"], "left_anti")
        more = kept(verified(pairs, texts, similarity), "omh-tried")
        tried, new = tried.unionByName(more), more.filter(F.col("similarity") >= similarity)
    if roots is None:
        left = _open(left, roots)
    # What leaders leave open: members of different groups in the same bucket.
    # A bucket of LEADERS + 1 has had all its pairs in the first round.
    apart = left.filter(F.col("size") > LEADERS + 1)
    if apart.limit(1).count():
        apart = kept(apart.select("node", "root").distinct().join(texts, "node"), "omh-apart-texts")
        pairs = pairs_across(apart, similarity).join(tried, ["a", "b"], "left_anti")
        new = kept(verified(pairs, texts, similarity).filter(F.col("similarity") >= similarity), "omh-links")
        if new.limit(1).count():
            roots = _linked(roots, new)
    grouped = classes.select("node", "rep")
    linked = (grouped.withColumn("root", F.col("node")) if roots is None else
              grouped.join(roots, grouped.node == roots.of, "left").select("node", "rep", F.coalesce("root", "node").alias("root")))
    least = linked.groupBy("root").agg(F.min("rep").alias("class_id"))
    named = linked.join(least, "root").select("node", F.col("rep").alias("copy_of"), "class_id", "root")
    return sketched.select("id", "raw", "node").join(named, "node", "left")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", similarity: float = SIMILARITY,
                    tables: int = TABLES) -> DataFrame:
    """One row per row of ``docs``: key, class_id (the smallest key among all
    documents linked with it, directly or not) and copy_of (the smallest key
    among documents of the same words).

    Texts without words are copies of each other if they are equal without
    their white space (null: empty).  A row without a key has null classes and
    links nothing; rows that share a key and differ in text are looked at each.
    Other columns are ignored; an empty table gives no rows.
    """
    out = _classified(docs, key, text, similarity, tables)
    blank = F.col("id").isNull()
    return out.select(F.col("id").alias(key), F.when(~blank, F.col("class_id")).alias("class_id"), F.when(~blank, F.col("copy_of")).alias("copy_of"))


def keep_one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text", similarity: float = SIMILARITY,
                     tables: int = TABLES) -> DataFrame:
    """One row of each class, with all its columns: that of the smallest key
    and, where rows share it, of one of their texts.  Rows that share a key but
    belong to different classes stay, as do rows without a key."""
    first = (_classified(docs, key, text, similarity, tables).filter(F.col("class_id") == F.col("id"))
             .groupBy("root").agg(F.min(F.struct("id", "node", "raw")).alias("one")).select("one.id", "one.raw"))
    first = kept(first, "omh-first")
    named = docs.withColumnsRenamed({c: f"c{i}" for i, c in enumerate(docs.columns)})         # apart from the names that are added
    own, words = (f"c{docs.columns.index(c)}" for c in (key, text))
    raw = F.xxhash64(words)
    left = named.join(first, (F.col(own).cast("long") == F.col("id")) & (raw == F.col("raw")), "left_semi").withColumn("raw", raw)
    return (left.dropDuplicates([own, "raw"]).drop("raw").unionByName(named.filter(F.col(own).isNull()))
            .withColumnsRenamed({f"c{i}": c for i, c in enumerate(docs.columns)}))
