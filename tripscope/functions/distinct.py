"""Mergeable counts of distinct values.

``bitmap``: one bit per value, exact, for whole numbers; 4 KB per group and
32,768 values.  ``sketch``: an HLL sketch, for anything, of at most 2**lg_k bytes and
a relative standard error of 1.04 / sqrt(2**lg_k).  Both are stored per day and
hour and united at read time, so the distinct count over any range of days
needs no trip row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LG_K = 12


def bitmaps(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """keys, bucket, bits: NULLs and NULL-only groups leave no bit."""
    v = F.col(value)
    return (
        df.where(v.isNotNull())
        .groupBy(*keys, F.bitmap_bucket_number(v).alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(v)).alias("bits"))
    )


def distinct_of_bitmaps(stored: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """keys, ``name``: the exact distinct count of the united bitmaps."""
    united = stored.groupBy(*keys, "bucket").agg(F.bitmap_count(F.bitmap_or_agg("bits")).alias("n"))
    return united.groupBy(*keys).agg(F.sum("n").alias(name))


def sketches(df: DataFrame, keys: Sequence[str], value: str, lg_k: int = LG_K) -> DataFrame:
    """keys, sketch."""
    return df.groupBy(*keys).agg(F.hll_sketch_agg(value, F.lit(lg_k)).alias("sketch"))


def distinct_of_sketches(stored: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """keys, ``name``: the estimate of the united sketches."""
    return stored.groupBy(*keys).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias(name))
