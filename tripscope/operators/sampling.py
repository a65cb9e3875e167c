"""Exactly n rows, the same ones in every run.

An unordered ``limit`` gathers whatever rows come first into one task.  Here a row's
place is a hash of its key columns, and the n smallest are taken: the rows are
counted per prefix of the hash, which finds the one prefix in which the n-th row
lies; that prefix is counted by the next digits until few rows are left in it.
All smaller prefixes are taken whole by a filter, and only the last prefix's few
rows are put in order.  Nothing is sorted as a whole and the driver gets at most
16**DIGITS counts a round.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Hexadecimal digits by which a prefix grows in a round.
DIGITS = 3
#: A prefix with at most so many rows is put in order.
FEW_ROWS = 100_000
HASH_DIGITS = 32


def sample_n(df: DataFrame, n: int, keys: Sequence[str], seed: int = 0, few_rows: int = FEW_ROWS, digits: int = DIGITS) -> DataFrame:
    """``n`` rows of ``df`` (all, if it has no more), by the md5 of the seed and
    the values of ``keys``; equal input gives equal rows whatever its partitions.

    ``keys`` should identify a row: rows alike in them are alike here, and of those
    at the very edge any are taken.  NULLs in keys are values of their own."""
    if n <= 0:
        return df.limit(0)
    name = "_place"
    while name in df.columns:
        name = f"_{name}"
    parts = [F.coalesce(F.concat(F.lit("="), F.col(k).cast("string")), F.lit("-")) for k in keys]
    placed = df.withColumn(name, F.md5(F.concat_ws("|", F.lit(str(seed)), *parts)))
    place, prefix, need = F.col(name), "", n
    while len(prefix) < HASH_DIGITS:
        inside = placed.where(place.startswith(prefix)) if prefix else placed
        longer = min(len(prefix) + digits, HASH_DIGITS)
        counts = inside.groupBy(F.substring(place, 1, longer).alias("p")).agg(F.count(F.lit(1)).alias("rows"))
        for p, rows in sorted((r["p"], r["rows"]) for r in counts.collect()):
            if rows >= need:
                break
            need -= rows
        else:
            return df  # no more than n rows
        prefix = p
        if rows <= few_rows:
            break
    below = placed.where(place < prefix)
    edge = placed.where(place.startswith(prefix)).orderBy(place, *keys).limit(need)
    return below.unionByName(edge).drop(name)
