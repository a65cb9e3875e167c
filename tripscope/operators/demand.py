"""Demand profile (Q1): busiest (date or day, hour) groups in a window.

One shuffle: trips are aggregated per (date, hour) with partial
aggregation on the map side; the share of the window is a global window
sum over the aggregated groups (dates x hours rows, never trip rows); the
top k is ``TakeOrderedAndProject`` (k rows per partition, then k).
The distinct zone count is exact (Spark plans it as an aggregate on
(group, zone) first, so a hot group costs one row per zone per task), or
an HLL++ sketch with ``approx_rsd`` (one aggregation level).
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripscope.functions.columns import mean, ratio, stored_seconds, time_band
from tripscope.operators.quality import demand_window, quality_filter

# The reference's personal window: days 20-22, hours 3-6.
WINDOW_DAYS = (20, 21, 22)
WINDOW_HOURS = (3, 4, 5, 6)


def time_band_profile(trips: DataFrame, hour_col: str = "pickup_hour") -> DataFrame:
    """Trips per time band of the pick-up hour."""
    return (
        trips.groupBy(time_band(hour_col).alias("time_band"))
        .agg(F.count(F.lit(1)).alias("trips"))
        .orderBy(F.desc("trips"), "time_band")
    )


def _distinct(c: Column, approx_rsd: float | None) -> Column:
    # Exact by default; at scale an HLL++ sketch (one aggregation level,
    # no Expand and no extra exchange) with relative error ``approx_rsd``.
    return F.countDistinct(c) if approx_rsd is None else F.approx_count_distinct(c, approx_rsd)


def _profile(
    trips: DataFrame,
    keys: list[str],
    k: int | None,
    null_as_zero: bool = False,
    order: Iterable[Column] | None = None,
    approx_rsd: float | None = None,
) -> DataFrame:
    dur = stored_seconds(trips.columns)
    if null_as_zero:
        # The reference's row-function form: a NULL measure counts as 0 in
        # the mean (every row is in the denominator); zone 0 and NULL are
        # not zones.
        zero = lambda c: F.coalesce(F.col(c), F.lit(0))
        n = F.count(F.lit(1))
        aggs = [
            _distinct(F.nullif(F.col("pu_location_id"), F.lit(0)), approx_rsd).alias("unique_pickup_zones"),
            ratio(F.sum(zero("passenger_count")), n).alias("avg_passenger_count"),
            (ratio(F.sum(dur), n) / F.lit(60.0)).alias("avg_duration_minutes"),
            ratio(F.sum(zero("trip_distance")), n).alias("avg_trip_distance"),
            ratio(F.sum(zero("total_amount")), n).alias("avg_total_amount"),
            F.sum(zero("total_amount")).cast("double").alias("total_revenue"),
        ]
    else:
        aggs = [
            _distinct(F.col("pu_location_id"), approx_rsd).alias("unique_pickup_zones"),
            mean("passenger_count").alias("avg_passenger_count"),
            (mean(dur) / F.lit(60.0)).alias("avg_duration_minutes"),
            mean("trip_distance").alias("avg_trip_distance"),
            mean("total_amount").alias("avg_total_amount"),
            F.sum("total_amount").cast("double").alias("total_revenue"),
        ]
    g = trips.groupBy(*keys).agg(F.count(F.lit(1)).alias("trips"), *aggs)
    share = ratio(F.col("trips"), F.sum("trips").over(Window.partitionBy())) * 100
    g = g.withColumn("trip_share", share)
    order = list(order) if order is not None else [
        F.desc("trips"), F.desc("total_revenue"), *[F.asc(c) for c in keys]
    ]
    g = g.orderBy(*order)
    return g.limit(k) if k else g


def demand_profile_by_date(
    trips: DataFrame,
    days: Iterable[int] = WINDOW_DAYS,
    hours: Iterable[int] = WINDOW_HOURS,
    k: int | None = 12,
    approx_rsd: float | None = None,
) -> DataFrame:
    """Quality-filtered trips of the window, per (pickup_date, pickup_hour);
    order trips desc, revenue desc, date, hour; top k.  ``approx_rsd``
    switches the distinct zone count to an HLL++ sketch."""
    t = demand_window(quality_filter(trips), days, hours)
    return _profile(t, ["pickup_date", "pickup_hour"], k, approx_rsd=approx_rsd)


def _hour_range(trips: DataFrame, hours: tuple[int, int]) -> DataFrame:
    lo, hi = hours
    return trips.where(F.col("pickup_hour").between(lo, hi))


def demand_profile_by_day(
    trips: DataFrame, hours: tuple[int, int] = (3, 6), k: int | None = 12, approx_rsd: float | None = None
) -> DataFrame:
    """All trips of the hour range (no quality or day filter), per
    (pickup_day, pickup_hour); the same measures; top k."""
    return _profile(_hour_range(trips, hours), ["pickup_day", "pickup_hour"], k, approx_rsd=approx_rsd)


def demand_profile_null_as_zero(
    trips: DataFrame, hours: tuple[int, int] = (3, 6), k: int | None = 12
) -> DataFrame:
    """As ``demand_profile_by_day`` with both timestamps required and NULL
    passengers, distance and total counted as 0 in the means."""
    t = _hour_range(trips, hours).where(
        F.col("pickup_ts").isNotNull() & F.col("dropoff_ts").isNotNull()
    )
    return _profile(t, ["pickup_day", "pickup_hour"], k, null_as_zero=True)
