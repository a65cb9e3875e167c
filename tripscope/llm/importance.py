"""Resampling towards a target distribution by importance weights.

1. Hashed word n-grams of the documents and of the target texts are counted into
   one array per task; the arrays' sums (``buckets`` numbers) reach the driver and
   become one gain per bucket: how much likelier the target is to use it.
2. A document's weight is the mean gain of its features, one array look-up each;
   its score adds Gumbel noise seeded by its key, so that the highest scores are a
   draw without replacement by weight.
3. The cutoff is found without sorting all: a quantile sketch gives a bracket of
   scores, exact counts of what lies above and inside it validate the bracket or
   widen it, and only the rows inside are sorted.
4. The drawn rows are numbered in order of their score: a range-partitioned sort,
   each partition counting on from the ones before it.

Texts are never shuffled; what is sorted are rows of six numbers.
"""

from __future__ import annotations

import math
import string
from collections.abc import Iterator
from itertools import repeat
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tripscope.llm.common import mapped, slices, table, written

BUCKETS = 10_000
#: Accuracy of the quantile sketch: a rank is off by at most one part in so many.
ACCURACY = 10_000
_LETTERS = string.ascii_lowercase.encode()
#: Upper-case letters to lower case; all that no word holds (of ASCII, all but
#: digits and letters) to a space.
_FOLD = bytes(b | 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or b in _LETTERS else 32 for b in range(256))


def feature_buckets(text: bytes, buckets: int = BUCKETS, piece: int = 1 << 20) -> Iterator[tuple[int, np.ndarray]]:
    """(number of words, buckets of the features) of a UTF-8 text, a piece at a
    time: what is held does not follow the length of the text.  A pair that
    spans two pieces counts in the second."""
    text, start, before = text.translate(_FOLD), 0, None
    while start < len(text):
        end = text.find(b" ", start + piece)
        end = len(text) if end < 0 else end
        words = text[start:end].split()
        start = end
        if not words:
            continue
        ones = list(map(crc32, words))
        # A checksum goes on from that of the first word and the space.
        opened = list(map(crc32, repeat(b" "), ones))
        pairs = list(map(crc32, words[1:], opened))
        if before is not None:
            pairs.append(crc32(words[0], before))
        before = opened[-1]
        yield len(words), np.array(ones + pairs, np.uint32) % np.uint32(buckets)


def bucket_counts(df: DataFrame, text: str = "text", buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all texts fall into each bucket.  A task keeps one
    array; at most ``buckets`` sums reach the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(buckets, np.int64)
        for batch in batches:
            for part in slices(batch, 0):
                for t in part.column(0).cast(pa.binary()).to_pylist():
                    for _, found in feature_buckets(t or b"", buckets):
                        sums += np.bincount(found, minlength=buckets)
        at = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(sums[at])], ["bucket", "n"])

    rows = df.select(F.col(text).alias("text")).transform(mapped, count, "bucket long, n long")
    out = np.zeros(buckets, np.int64)
    for r in rows.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """A thousand times the log ratio of the smoothed shares, rounded down."""
    buckets = len(source)
    s_all, t_all = float(source.sum() + buckets), float(target.sum() + buckets)
    return np.array(
        [math.floor(1000 * math.log((t + 1.0) * s_all / ((s + 1.0) * t_all))) for s, t in zip(source.tolist(), target.tolist(), strict=True)],
        np.int64,
    )


def weighed(docs: DataFrame, gain: np.ndarray, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_words, n_features, weight per row.  No shuffle."""
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1):
                got = []
                for t in part.column(1).cast(pa.binary()).to_pylist():
                    words = n = total = 0
                    for w, found in feature_buckets(t or b"", len(gain)):
                        words, n, total = words + w, n + len(found), total + int(gain[found].sum())
                    got.append((words, n, total // n if n else 0))
                columns = [pa.array(c, pa.int64()) for c in zip(*got)]
                yield pa.RecordBatch.from_arrays([part.column(0), *columns], ["key", "n_words", "n_features", "weight"])

    kind = rows.schema["key"].dataType.simpleString()
    return rows.transform(mapped, weigh, f"key {kind}, n_words long, n_features long, weight long")


def gumbel(key: Column, seed: int) -> Column:
    """A thousand times standard Gumbel noise, rounded down, from the first 32 bits
    of sha256("<seed>:<key>")."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def numbered(df: DataFrame, order: list[Column], name: str, label: str) -> DataFrame:
    """``df`` with 1, 2, 3... in the given order, which must be total: sorted by
    range partitions, each written with its rows' places; the partitions' sizes
    (one number each) are then added up."""
    at = F.monotonically_increasing_id()  # partition number, then the place in it
    placed = written(df.orderBy(*order).withColumn(name, at), label)
    part = F.shiftright(F.col(name), 33)
    sizes = placed.groupBy(part.alias(f"{name} part")).agg(F.count("*").alias(f"{name} size"))
    before = Window.orderBy(f"{name} part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(f"{name} part", F.coalesce(F.sum(f"{name} size").over(before), F.lit(0)).alias(f"{name} before"))
    place = F.col(name).bitwiseAND(F.lit((1 << 33) - 1))
    return placed.join(sizes, part == F.col(f"{name} part")).select(
        *[c for c in df.columns], (F.col(f"{name} before") + place + 1).alias(name)
    )


def draw_order() -> list[Column]:
    """Score down, key up (NULL last), row number up: a total order."""
    return [F.desc("score"), F.asc_nulls_last("key"), F.asc("row")]


def cutoff(rows: DataFrame, k: int, n: int, *, accuracy: int = ACCURACY, margin: int = 2):
    """The ``k``-th of ``n`` rows in the order score down, key up, row number up.

    The sketch's bracket is ``margin`` of its errors wide on both sides; as long
    as the exact counts show that the k-th row is outside, the margin grows
    fourfold (in the end the bracket holds all scores)."""
    while True:
        at = 1.0 - k / n
        low, high = (min(1.0, max(0.0, at + side * margin / accuracy)) for side in (-1, 1))
        bracket = rows.agg(
            F.percentile_approx("score", [low, high], accuracy).alias("p"), F.min("score").alias("least"), F.max("score").alias("most")
        ).first()
        low = bracket["least"] if low <= 0 else bracket["p"][0]
        high = bracket["most"] if high >= 1 else bracket["p"][1]
        inside = F.col("score").between(low, high)
        exact = rows.agg(F.count_if(F.col("score") > high).alias("above"), F.count_if(inside).alias("inside")).first()
        if exact["above"] < k <= exact["above"] + exact["inside"]:
            break
        margin *= 4
    found = numbered(rows.where(inside).select("score", "key", "row"), draw_order(), "place", "importance-bracket")
    return found.where(F.col("place") == k - exact["above"]).select("score", "key", "row").first()


def resample(
    docs: DataFrame, target: DataFrame, *, key: str = "doc_id", text: str = "text", percent: int = 25, min_words: int = 20,
    seed: int = 7, buckets: int = BUCKETS, accuracy: int = ACCURACY, margin: int = 2,
) -> DataFrame:
    """One row per row of ``docs``: key, n_words, n_features, weight, score and
    rank (1 for the highest score; NULL if not drawn).

    Of the rows with ``min_words`` words or more, ``percent`` per cent are drawn,
    rounded down.  NULL and empty texts have no features, weight 0 and are never
    drawn if ``min_words`` is above 0.  A NULL key is hashed as an empty one and
    comes after the others of its score.  Rows that repeat key and text tie; they
    get ranks of their own, in any order.  An empty target gives gains by the
    smoothing alone; an empty table gives an empty result."""
    gain = gains(bucket_counts(docs, text, buckets), bucket_counts(target, text, buckets))
    scored = written(
        weighed(docs, gain, key=key, text=text)
        .withColumn("score", F.col("weight") + gumbel(F.col("key"), seed))
        .withColumn("row", F.monotonically_increasing_id()),
        "importance-scored",
    )
    able = scored.where(F.col("n_words") >= min_words)
    n = able.count()
    k = n * percent // 100
    if k == 0:
        ranked = scored.withColumn("rank", F.lit(None).cast("long"))
    else:
        edge = cutoff(able, k, n, accuracy=accuracy, margin=margin)
        # In the order up to the edge: NULL keys come last.
        kind = scored.schema["key"].dataType
        last = F.lit(edge["key"]).cast(kind)
        before = (
            F.col("key").isNotNull() & last.isNull() | F.coalesce(F.col("key") < last, F.lit(False))
            | F.col("key").eqNullSafe(last) & (F.col("row") <= edge["row"])
        )
        drawn = (F.col("n_words") >= min_words) & (
            (F.col("score") > edge["score"]) | (F.col("score") == edge["score"]) & before
        )
        ranked = numbered(scored.where(drawn), draw_order(), "rank", "importance-drawn").unionByName(
            scored.where(~drawn).withColumn("rank", F.lit(None).cast("long"))
        )
    return ranked.select(F.col("key").alias(key), "n_words", "n_features", "weight", "score", "rank")


def op11_importance(spark, sf_dir):
    drawn = resample(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "benchmark", "text"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


#: crc32 of each distinct feature is computed byte by byte over its hexadecimal form.
OP11_SQL = rf"""
WITH both_texts AS (
  SELECT 0 AS target, doc_id, row_number() OVER () AS r, text FROM documents
  UNION ALL SELECT 1, NULL, -row_number() OVER (), text FROM benchmark),
w AS (
  SELECT target, doc_id, r, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM both_texts),
f AS (
  SELECT target, r, unnest(w || list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS f FROM w),
crc_table AS (
  SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
         lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))) AS crc),
named AS (
  SELECT f, xor(list_reduce(
           [4294967295::BIGINT] || list_transform(range(len(hex(f)) // 2), lambda i: ('0x' || hex(f)[2 * i + 1:2 * i + 2])::BIGINT),
           lambda c, b: xor(c >> 8, crc[(xor(c, b) & 255) + 1])), 4294967295) % {BUCKETS} AS bucket
  FROM (SELECT DISTINCT f FROM f), crc_table),
n AS (
  SELECT bucket, count(*) FILTER (target = 0) AS s, count(*) FILTER (target = 1) AS t FROM f JOIN named USING (f) GROUP BY bucket),
g AS (
  SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * ((SELECT sum(s) FROM n) + {BUCKETS})::DOUBLE
         / ((s + 1)::DOUBLE * ((SELECT sum(t) FROM n) + {BUCKETS})::DOUBLE)))::BIGINT AS gain FROM n),
d AS (
  SELECT r, count(*) AS n_features, floor(sum(gain)::DOUBLE / count(*))::BIGINT AS weight
  FROM f JOIN named USING (f) JOIN g USING (bucket) WHERE target = 0 GROUP BY r),
u AS (
  SELECT w.r, doc_id, len(w) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
         ('0x' || sha256('7:' || doc_id)[1:8])::BIGINT AS h
  FROM w LEFT JOIN d ON w.r = d.r WHERE target = 0),
v AS (SELECT *, weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score FROM u),
k AS (
  SELECT r, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS n FROM v WHERE n_words >= 20)
SELECT doc_id, n_features::BIGINT AS n_features, weight, score, CASE WHEN rank <= 25 * n // 100 THEN rank END AS rank
FROM v LEFT JOIN k ON v.r = k.r
"""
