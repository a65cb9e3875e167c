"""Speed, great-circle distance and detour (Q2).

The pipeline is one narrow stage per partition (filter, project) up to
the hourly aggregate; the haversine is a built-in expression inside
whole-stage codegen.  ``haversine_udf`` is the same formula as an
Arrow-batched pandas UDF, kept to compare the two paths; it is never the
default.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripscope.functions.columns import (
    EARTH_RADIUS_KM,
    KM_PER_MILE,
    duration_seconds,
    haversine_km,
    maybe_round,
    ratio,
)
from tripscope.functions.udfs import haversine_arrow_udf
from tripscope.operators.quality import geo_valid_filter

COORDS = ("pickup_latitude", "pickup_longitude", "dropoff_latitude", "dropoff_longitude")


def trip_speed(
    df: DataFrame,
    km_per_mile: float = KM_PER_MILE,
    pickup_col: str = "pickup_ts",
    dropoff_col: str = "dropoff_ts",
) -> DataFrame:
    """duration_hours from whole seconds; speed_kmh = km / hours
    (NULL for a zero duration instead of an ANSI error)."""
    hours = duration_seconds(pickup_col, dropoff_col).cast("double") / F.lit(3600.0)
    return df.withColumn("duration_hours", hours).withColumn(
        "speed_kmh",
        F.try_divide(F.col("trip_distance") * F.lit(km_per_mile), F.col("duration_hours")),
    )


def haversine_builtin(
    df: DataFrame,
    lat1: str = "pickup_latitude",
    lon1: str = "pickup_longitude",
    lat2: str = "dropoff_latitude",
    lon2: str = "dropoff_longitude",
    radius: float = EARTH_RADIUS_KM,
) -> DataFrame:
    return df.withColumn("haversine_km", haversine_km(lat1, lon1, lat2, lon2, radius))


def haversine_udf(
    df: DataFrame,
    lat1: str = "pickup_latitude",
    lon1: str = "pickup_longitude",
    lat2: str = "dropoff_latitude",
    lon2: str = "dropoff_longitude",
    radius: float = EARTH_RADIUS_KM,
) -> DataFrame:
    """The same distance computed by a pandas UDF (NULL if any input is NULL)."""
    udf = haversine_arrow_udf(radius)
    return df.withColumn("haversine_km", udf(F.col(lat1), F.col(lon1), F.col(lat2), F.col(lon2)))


def detour_ratio(
    df: DataFrame, max_speed: float = 120.0, km_per_mile: float = KM_PER_MILE
) -> DataFrame:
    """Keep haversine > 0 and 0 < speed < max_speed; detour = km / haversine."""
    kept = df.where(
        (F.col("haversine_km") > 0) & (F.col("speed_kmh") > 0) & (F.col("speed_kmh") < max_speed)
    )
    return kept.withColumn(
        "detour_ratio", (F.col("trip_distance") * F.lit(km_per_mile)) / F.col("haversine_km")
    )


def speed_metrics(
    trips: DataFrame, max_speed: float = 120.0, use_udf: bool = False
) -> DataFrame:
    """geo_valid_filter -> trip_speed -> haversine -> detour_ratio."""
    t = trip_speed(geo_valid_filter(trips))
    t = haversine_udf(t) if use_udf else haversine_builtin(t)
    return detour_ratio(t, max_speed)


def speed_by_hour(metrics: DataFrame, digits: int | None = None) -> DataFrame:
    """Mean speed and mean detour per pick-up hour."""
    g = metrics.groupBy("pickup_hour").agg(
        ratio(F.sum("speed_kmh"), F.count("speed_kmh")).alias("avg_speed_kmh"),
        ratio(F.sum("detour_ratio"), F.count("detour_ratio")).alias("avg_detour_ratio"),
    )
    return g.select(
        "pickup_hour",
        maybe_round(F.col("avg_speed_kmh"), digits).alias("avg_speed_kmh"),
        maybe_round(F.col("avg_detour_ratio"), digits).alias("avg_detour_ratio"),
    ).orderBy("pickup_hour")


def _extreme_trips(metrics: DataFrame, k: int, fastest: bool, digits: int | None) -> DataFrame:
    speed = F.col("speed_kmh")
    # Order by the raw speed (not a rounded alias), then every output column.
    order = [speed.desc() if fastest else speed.asc(), "pickup_ts", "dropoff_ts", "trip_distance"]
    top = metrics.orderBy(*order).limit(k)
    return top.select(
        "pickup_ts",
        "dropoff_ts",
        maybe_round(F.col("trip_distance"), digits).alias("dist_miles"),
        maybe_round(speed, digits).alias("speed_kmh"),
    )


def fastest_trips(metrics: DataFrame, k: int = 5, digits: int | None = None) -> DataFrame:
    return _extreme_trips(metrics, k, True, digits)


def slowest_trips(metrics: DataFrame, k: int = 5, digits: int | None = None) -> DataFrame:
    return _extreme_trips(metrics, k, False, digits)
