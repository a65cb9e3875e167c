"""Exploration (EDA): schema, statistics, null counts, top zones, extremes.

Every statistic is one aggregate over one scan: the null counts of all
columns in a single pass, describe's five measures of all columns in a
single pass (then unpivoted with ``stack`` on the one result row).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripscope.functions.columns import mean


def eda_schema(df: DataFrame) -> DataFrame:
    """name, type, nullable of each column (from the schema, no scan)."""
    rows = [(f.name, f.dataType.simpleString(), f.nullable) for f in df.schema.fields]
    return df.sparkSession.createDataFrame(
        rows, "column_name string, data_type string, nullable boolean"
    )


def eda_describe(df: DataFrame, cols: Sequence[str] = ("trip_distance", "total_amount")) -> DataFrame:
    """Per column: n (non-null), mean, sample stddev, min, max - doubles.
    The deviation is Spark's streaming ``stddev_samp`` over doubles: sums of
    squares in DECIMAL overflow on large input; it holds about the digits
    that a streaming form can, so show it rounded."""
    aggs = []
    for i, c in enumerate(cols):
        x = F.col(c)
        aggs += [
            F.count(x).alias(f"n{i}"),
            mean(x).alias(f"mean{i}"),
            F.stddev_samp(x.cast("double")).alias(f"sd{i}"),
            F.min(x).cast("double").alias(f"min{i}"),
            F.max(x).cast("double").alias(f"max{i}"),
        ]
    one = df.agg(*aggs)
    parts = ", ".join(
        f"'{c}', n{i}, mean{i}, sd{i}, min{i}, max{i}" for i, c in enumerate(cols)
    )
    return one.selectExpr(
        f"stack({len(cols)}, {parts}) AS (column_name, n, mean, stddev, min, max)"
    )


def eda_null_counts(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """One row: the number of NULLs of every column, in one pass."""
    cols = list(cols) if cols is not None else df.columns
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])


def eda_top_zones(trips: DataFrame, zones: DataFrame, k: int = 10) -> DataFrame:
    """Top k pick-up zone names by trips.  Trips are counted per id
    first; only those counts meet the dimension."""
    per_id = trips.groupBy("pu_location_id").agg(F.count(F.lit(1)).alias("n"))
    named = per_id.join(zones, F.col("pu_location_id") == F.col("LocationID"))
    return (
        named.groupBy(F.col("Zone").alias("zone"))
        .agg(F.sum("n").alias("trips"))
        .orderBy(F.desc("trips"), "zone")
        .limit(k)
    )


def eda_extremes(
    df: DataFrame, max_col: str = "trip_distance", min_col: str = "total_amount"
) -> DataFrame:
    """The row with the largest ``max_col`` and the one with the smallest
    ``min_col`` (ties broken by the other column, descending; NULLs do not
    count), tagged: one aggregate over one scan, unpivoted."""
    hi, lo = F.col(max_col).cast("double"), F.col(min_col).cast("double")
    one = df.agg(
        F.max(F.when(hi.isNotNull(), F.struct(hi.alias("hi"), lo.alias("lo")))).alias("top"),
        F.min(F.when(lo.isNotNull(), F.struct(lo.alias("lo"), (-hi).alias("hi")))).alias("low"),
    )
    return one.selectExpr(
        f"stack(2, 'max_{max_col}', top.hi, top.lo, 'min_{min_col}', -low.hi, low.lo) AS (kind, {max_col}, {min_col})"
    )
