"""Row filters of the jobs.  Each is one ``where`` on stored columns, so
Catalyst pushes the comparisons into the Parquet scan (``PushedFilters``)
and a filter on ``pickup_day`` prunes partitions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def quality_filter(df: DataFrame) -> DataFrame:
    """Both timestamps present, duration, distance and total all > 0."""
    return df.where(
        F.col("pickup_ts").isNotNull()
        & F.col("dropoff_ts").isNotNull()
        & (F.col("duration_minutes") > 0)
        & (F.col("trip_distance") > 0)
        & (F.col("total_amount") > 0)
    )


def demand_window(
    df: DataFrame,
    days: Iterable[int],
    hours: Iterable[int],
    day_col: str = "pickup_day",
    hour_col: str = "pickup_hour",
) -> DataFrame:
    """Day of month in ``days`` and hour in ``hours``.

    The stored ``pickup_day`` is the partition column, so the day test is
    a partition filter; recomputing ``dayofmonth(pickup_ts)`` would lose it.
    """
    return df.where(F.col(day_col).isin(list(days)) & F.col(hour_col).isin(list(hours)))


def fare_quality_filter(df: DataFrame) -> DataFrame:
    """Duration, distance, fare and total all > 0."""
    return df.where(
        (F.col("duration_minutes") > 0)
        & (F.col("trip_distance") > 0)
        & (F.col("fare_amount") > 0)
        & (F.col("total_amount") > 0)
    )


def geo_valid_filter(
    df: DataFrame,
    lon_range: tuple[float, float] = (-75.0, -73.0),
    lat_range: tuple[float, float] = (40.0, 42.0),
    pickup_col: str = "pickup_ts",
    dropoff_col: str = "dropoff_ts",
) -> DataFrame:
    """Distance > 0, drop-off after pick-up, all four coordinates inside
    the box (bounds inclusive)."""
    lo_lon, hi_lon = lon_range
    lo_lat, hi_lat = lat_range
    return df.where(
        (F.col("trip_distance") > 0)
        & (F.col(dropoff_col) > F.col(pickup_col))
        & F.col("pickup_longitude").between(lo_lon, hi_lon)
        & F.col("pickup_latitude").between(lo_lat, hi_lat)
        & F.col("dropoff_longitude").between(lo_lon, hi_lon)
        & F.col("dropoff_latitude").between(lo_lat, hi_lat)
    )


def activity_filter(df: DataFrame) -> DataFrame:
    """Pick-up present, duration > 0, total > 0 (no distance test)."""
    return df.where(
        F.col("pickup_ts").isNotNull()
        & (F.col("duration_minutes") > 0)
        & (F.col("total_amount") > 0)
    )


def od_valid_filter(df: DataFrame) -> DataFrame:
    """Duration, distance and fare > 0."""
    return df.where(
        (F.col("duration_minutes") > 0)
        & (F.col("trip_distance") > 0)
        & (F.col("fare_amount") > 0)
    )
