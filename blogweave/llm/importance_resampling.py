"""Importance resampling towards a target's distribution of words.

Every run of up to ``longest`` words of a text is a feature, and falls into one
of a fixed number of buckets.  A bucket's gain is the logarithm of how much more
common it is in the target than in the corpus; a document's weight is the mean
gain of its features, looked up in an array of one gain per bucket.  A draw
without replacement is the ``n`` highest sums of a weight and a Gumbel variable
that the document's id and the seed give, so it is the same on every run.

The draw never sorts the corpus.  Scores are persisted once with the ids that
break ties; the lowest drawn score is found by bisection, each round one job
that counts exactly how many rows reach each of a few thresholds, and the same
is done with the ids of those that tie.  Only drawn rows are then dealt by range
and numbered.
"""

from __future__ import annotations

import math
import string
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ordering import numbered
from .sqltext import crc32_sql
from .store import kept

#: Words: ASCII letters and digits, and everything beyond ASCII.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BUCKETS = 10_000
SEED = 2024
#: Thresholds are the midpoints of so many levels of halving, counted in one job.
LEVELS = 4


def features(text: Column, longest: int = 1) -> Column:
    """Runs of 1 to ``longest`` consecutive words, joined by one space; of case, only A-Z is folded."""
    words = F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase), F.lit(WORD), F.lit(0))
    if longest == 1:
        return words

    def runs(w: Column, n: int) -> Column:
        starts = F.when(F.size(w) >= n, F.sequence(F.lit(1), F.size(w) - (n - 1))).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.array_join(F.slice(w, i, F.lit(n)), " "))
    # bound to a variable, so that the text is split once and not once per run
    return F.transform(F.array(words), lambda w: F.concat(w, *[runs(w, n) for n in range(2, longest + 1)]))[0]


def bucketed(df: DataFrame, text: str, longest: int, buckets: int, *more: Column) -> DataFrame:
    """``more`` columns and the buckets of the row's features, written once: the text is not read again."""
    column = F.transform(features(F.col(text), longest), lambda f: F.crc32(f) % buckets)
    return kept(df.select(*more, column.cast("array<int>").alias("buckets")), "buckets")


def bucket_counts(coded: DataFrame, buckets: int) -> list[int]:
    """Features by bucket: one number per bucket reaches the driver."""
    rows = coded.select(F.explode("buckets").alias("bucket")).groupBy("bucket").agg(F.count("*").alias("n")).collect()
    out = [0] * buckets
    for r in rows:
        out[r.bucket] = r.n
    return out


def gains(corpus: list[int], target: list[int]) -> list[int]:
    """floor(1000 ln of the ratio of smoothed shares), by bucket."""
    n, s, t = len(corpus), sum(corpus), sum(target)
    return [math.floor(1000 * math.log(float(y + 1) * float(s + n) / (float(x + 1) * float(t + n)))) for x, y in zip(corpus, target)]


def gumbel(key: str, seed: int) -> Column:
    """floor(1000 g) of the standard Gumbel variable that ``seed:key`` gives; a null key counts as an empty one."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))), 256), 1, 8), 16, 10)
    return F.floor(-1000 * F.log(-F.log((h.cast("double") + 0.5) / 4294967296.0)))


def scored(coded: DataFrame, gain: list[int], key: str, seed: int) -> DataFrame:
    """n_features, weight and score by row, from the array of gains."""
    lookup = F.split(F.lit(",".join(map(str, gain))), ",").cast("array<bigint>")       # folded to one array of constants
    total = F.aggregate("buckets", F.lit(0).cast("long"), lambda a, b: a + F.get(lookup, b))
    n = F.size("buckets").cast("long")
    out = coded.withColumn("n_features", n).withColumn("_sum", total)
    weight = F.when(F.col("n_features") > 0, F.expr("(_sum - pmod(_sum, n_features)) div n_features")).otherwise(F.lit(0))
    return (out.withColumn("weight", weight.cast("long")).withColumn("score", F.col("weight") + gumbel(key, seed))
            .drop("_sum", "buckets"))


def reached_by(rows: DataFrame, value: Column, need: int, low: int, high: int, levels: int = LEVELS) -> int:
    """The greatest number that the ``value`` of at least ``need`` rows
    reaches, between ``low`` (which so many do reach) and ``high``: bisection
    by exact counts over ``rows``, several midpoints a job."""
    while low < high:
        parts = min(1 << levels, high - low + 1)
        marks = sorted({low - (low - high) * j // parts for j in range(1, parts)} | {low + 1})
        counts = rows.agg(*[F.count_if(value >= F.lit(m)).alias(f"_{j}") for j, m in enumerate(marks)]).first()
        enough = [m for m, n in zip(marks, counts) if n >= need]
        short = [m for m, n in zip(marks, counts) if n < need]
        low, high = max([low, *enough]), min([high, *[m - 1 for m in short]])
    return low


class Cutoff(NamedTuple):
    score: int
    last_key: int | None     # of rows with just that score: the greatest id that is drawn
    nulls: bool              # and those without id, after it


def cutoff(rows: DataFrame, need: int, key: str) -> Cutoff:
    """Where the ``need`` rows end that come first by falling score, ids rising, null ids last."""
    bounds = rows.agg(F.min("score"), F.max("score")).first()
    score = reached_by(rows, F.col("score"), need, bounds[0], bounds[1])
    above = rows.filter(F.col("score") > score).count()
    ties = rows.filter(F.col("score") == score)
    least, most, n = ties.agg(F.min(key), F.max(key), F.count(key)).first()
    if n < need - above:
        return Cutoff(score, most, True)
    # ~id falls where the id rises, and no id overflows
    return Cutoff(score, ~reached_by(ties, F.bitwise_not(F.col(key)), need - above, ~most, ~least), False)


def resample(docs: DataFrame, target: DataFrame, percent: int = 10, least_words: int = 20, longest: int = 1, buckets: int = BUCKETS,
             seed: int = SEED, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: key, n_features, weight, score, rank
    (all long; rank: 1, 2, 3, … of the drawn rows, else null).

    Drawn are floor(percent * N / 100) of the N rows with at least
    ``least_words`` words, by falling score, then rising key, null keys last;
    rows that share a key are ranked one by one.  A null or empty text has no
    feature and weight 0.  An empty target leaves every gain to the corpus
    alone; an empty ``docs`` gives no row.  Other columns are ignored."""
    docs = docs.select(F.col(key).cast("long").alias(key), F.col(text).alias("_text"))
    coded = bucketed(docs, "_text", longest, buckets, F.monotonically_increasing_id().alias("_row"), F.col(key))
    aim = bucketed(target.select(F.col(text).alias("_text")), "_text", longest, buckets)
    gain = gains(bucket_counts(coded, buckets), bucket_counts(aim, buckets))
    table = kept(scored(coded, gain, key, seed), "scores")
    # a text of w words has w features of one word, w - 1 of two, …
    fewest = sum(max(0, least_words - n) for n in range(longest))
    able = table.filter(F.col("n_features") >= max(fewest, 0))
    need = able.count() * percent // 100
    columns = [F.col(key), *map(F.col, ("n_features", "weight", "score"))]
    if not need:
        return table.select(*columns, F.lit(None).cast("long").alias("rank"))
    at = cutoff(able.select("score", key), need, key)
    tie = F.col(key) <= F.lit(at.last_key) if at.last_key is not None else F.lit(False)
    if at.nulls:
        tie = tie | F.col(key).isNull()
    drawn = (F.col("n_features") >= fewest) & ((F.col("score") > at.score) | ((F.col("score") == at.score) & F.coalesce(tie, F.lit(False))))
    ranked = numbered(table.filter(drawn), F.col("score").desc(), F.col(key).asc_nulls_last(), F.col("_row").asc(), column="rank", name="drawn")
    place = F.col("rank") + 1        # rows that repeat the last key may be more than are needed
    return (ranked.select(*columns, F.when(place <= need, place).alias("rank"))
            .unionByName(table.filter(~drawn).select(*columns, F.lit(None).cast("long").alias("rank"))))


def resample_sql(percent: int = 10, least_words: int = 20, buckets: int = BUCKETS, seed: int = SEED) -> str:
    """DuckDB SQL of ``resample`` for runs of one word, over documents and benchmark."""
    split = f"unnest(regexp_extract_all(translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}'), '{WORD}'))"
    return f"""
WITH corpus AS (SELECT row, doc_id, {split} AS word FROM (SELECT row_number() OVER () AS row, * FROM documents)),
target AS (SELECT {split} AS word FROM benchmark),
coded AS (
  SELECT word, {crc32_sql('word')} % {buckets} AS bucket
  FROM (SELECT word FROM corpus UNION SELECT word FROM target)),
s AS (SELECT bucket, count(*) AS n FROM corpus JOIN coded USING (word) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS n FROM target JOIN coded USING (word) GROUP BY bucket),
gains AS (
  SELECT bucket, floor(1000 * ln((coalesce(t.n, 0) + 1)::DOUBLE * ((SELECT count(*) FROM corpus) + {buckets})::DOUBLE
      / ((s.n + 1)::DOUBLE * ((SELECT count(*) FROM target) + {buckets})::DOUBLE)))::BIGINT AS gain
  FROM s LEFT JOIN t USING (bucket)),
sums AS (SELECT row, count(*) AS n, sum(gain)::BIGINT AS total FROM corpus JOIN coded USING (word) JOIN gains USING (bucket) GROUP BY row),
weights AS (
  SELECT doc_id, coalesce(n, 0) AS n_features, CASE WHEN n > 0 THEN (total - ((total % n) + n) % n) // n ELSE 0 END AS weight,
    ('0x' || sha256('{seed}:' || coalesce(doc_id::VARCHAR, ''))[:8])::BIGINT AS h
  FROM (SELECT row_number() OVER () AS row, * FROM documents) LEFT JOIN sums USING (row)),
scores AS (SELECT doc_id, n_features, weight, weight + floor(-1000 * ln(-ln((h + 0.5)::DOUBLE / 4294967296::DOUBLE)))::BIGINT AS score FROM weights),
places AS (
  SELECT *, row_number() OVER (PARTITION BY n_features >= {least_words} ORDER BY score DESC, doc_id) AS place,
    count(*) FILTER (n_features >= {least_words}) OVER () AS able FROM scores)
SELECT doc_id, n_features::BIGINT AS n_features, weight::BIGINT AS weight, score::BIGINT AS score,
  CASE WHEN n_features >= {least_words} AND place <= {percent} * able // 100 THEN place END::BIGINT AS rank
FROM places"""
