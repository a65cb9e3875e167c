"""Origin-destination change between the two halves of the month (Q6b).

Default plan: one aggregate of conditional sums per (pu, do, hour) - one
scan, one shuffle - then "present in both halves with support" is
``trips_h1 >= min_trips and trips_h2 > 0``, which equals the reference's
inner join of the two half aggregates.  The split reads the stored
``pickup_day`` (the partition column), so ``days`` filters prune files.
The reference's two-branch join is kept as ``method="join"``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripscope.functions.columns import ratio
from tripscope.operators.quality import od_valid_filter

KEYS = ["pu_location_id", "do_location_id", "pickup_hour"]
OUT = KEYS + [
    "trips_h1",
    "trips_h2",
    "avg_fare_h1",
    "avg_fare_h2",
    "avg_total_h1",
    "avg_total_h2",
    "trips_change_pct",
    "fare_change_pct",
]


def _cond_mean(cond: Column, c: str) -> Column:
    v = F.when(cond, F.col(c))
    return ratio(F.sum(v), F.count(v))


def _halves_one_pass(t: DataFrame, split_day: int, day_col: str) -> DataFrame:
    h1, h2 = F.col(day_col) <= split_day, F.col(day_col) > split_day
    return t.groupBy(*KEYS).agg(
        F.count_if(h1).alias("trips_h1"),
        F.count_if(h2).alias("trips_h2"),
        _cond_mean(h1, "fare_amount").alias("avg_fare_h1"),
        _cond_mean(h2, "fare_amount").alias("avg_fare_h2"),
        _cond_mean(h1, "total_amount").alias("avg_total_h1"),
        _cond_mean(h2, "total_amount").alias("avg_total_h2"),
    )


def half_aggregate(trips: DataFrame, half: int, split_day: int, day_col: str = "pickup_day") -> DataFrame:
    """Trips, mean fare and mean total per (pu, do, hour) of one half of the month."""
    cond = F.col(day_col) <= split_day if half == 1 else F.col(day_col) > split_day
    return od_valid_filter(trips).where(cond).groupBy(*KEYS).agg(
        F.count(F.lit(1)).alias(f"trips_h{half}"),
        ratio(F.sum("fare_amount"), F.count("fare_amount")).alias(f"avg_fare_h{half}"),
        ratio(F.sum("total_amount"), F.count("total_amount")).alias(f"avg_total_h{half}"),
    )


def _halves_join(trips: DataFrame, split_day: int, day_col: str) -> DataFrame:
    first, second = (half_aggregate(trips, half, split_day, day_col) for half in (1, 2))
    return first.join(second, KEYS, "inner")


def _pct(new: Column, old: Column) -> Column:
    return F.round(F.try_divide((new - old) * 100, old), 2)


def od_halves_change(
    trips: DataFrame,
    split_day: int = 15,
    min_trips: int = 50,
    method: str = "one_pass",
    day_col: str = "pickup_day",
) -> DataFrame:
    """Per (pu, do, hour) present in both halves with ``min_trips`` in the
    first: trips, mean fare and mean total of each half, change of trips
    and of mean fare in percent (rounded to 2)."""
    if method == "one_pass":
        halves = _halves_one_pass(od_valid_filter(trips), split_day, day_col).where(F.col("trips_h2") > 0)
    elif method == "join":
        halves = _halves_join(trips, split_day, day_col)
    else:
        raise ValueError(f"unknown method {method!r}")
    return change_of(halves, min_trips)


def change_of(halves: DataFrame, min_trips: int) -> DataFrame:
    """The changes from both halves' aggregates, joined on ``KEYS``."""
    g = halves.where(F.col("trips_h1") >= min_trips).withColumns(
        {
            "trips_change_pct": _pct(F.col("trips_h2"), F.col("trips_h1")),
            "fare_change_pct": _pct(F.col("avg_fare_h2"), F.col("avg_fare_h1")),
        }
    )
    return g.select(*OUT)


def top_change(change: DataFrame, ascending: bool, k: int) -> DataFrame:
    """The ``k`` largest drops (``ascending``) or rises among the changes."""
    pct = F.col("trips_change_pct")
    return (
        change.orderBy(pct.asc() if ascending else pct.desc(), *KEYS)
        .limit(k)
        .select(*KEYS, "trips_h1", "trips_h2", "trips_change_pct")
    )


def od_top_growth(trips: DataFrame, split_day: int = 15, min_trips: int = 50, k: int = 5) -> DataFrame:
    return top_change(od_halves_change(trips, split_day, min_trips), False, k)


def od_top_decline(trips: DataFrame, split_day: int = 15, min_trips: int = 50, k: int = 5) -> DataFrame:
    return top_change(od_halves_change(trips, split_day, min_trips), True, k)
