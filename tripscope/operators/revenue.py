"""Zone revenue by distance bucket (Q3).

``zone_revenue`` aggregates trips per (pick-up id, bucket) first - at most
|zones| x 4 groups, partial aggregation on the map side - and joins only
those sums to the zone names, then re-aggregates by name (two ids can
share a zone name; the reference groups by name).  Ratios are ratios of
sums, carried as sums so that the two levels compose exactly.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripscope.functions.columns import (
    DISTANCE_EDGES,
    DISTANCE_LABELS,
    SURCHARGE_CANDIDATES,
    distance_bucket as bucket_expr,
    maybe_round,
    ratio,
    stored_seconds,
    total_surcharges as surcharge_expr,
    zone_role,
)
from tripscope.operators.quality import fare_quality_filter

GROUP = ["pickup_borough", "pickup_zone", "distance_bucket"]


def distance_bucket(
    trips: DataFrame,
    edges: Sequence[float] = DISTANCE_EDGES,
    labels: Sequence[str] = DISTANCE_LABELS,
) -> DataFrame:
    """Trips per distance bucket."""
    return (
        trips.groupBy(bucket_expr("trip_distance", edges, labels).alias("distance_bucket"))
        .agg(F.count(F.lit(1)).alias("trips"))
        .orderBy("distance_bucket")
    )


def zone_enrich(
    trips: DataFrame,
    zones: DataFrame,
    id_col: str = "pu_location_id",
    prefix: str = "pickup",
) -> DataFrame:
    """Trips with the borough and zone of ``id_col`` (inner join: trips of
    unknown zones drop).  A row-level join; how is left to the planner's
    estimate of the dimension's bytes and to adaptive execution: a small one
    is broadcast, a large one sort-merged with hot zones split."""
    z = zone_role(zones, prefix).withColumnRenamed(f"{prefix}_id", "_zone_id")
    return trips.join(z, F.col(id_col) == F.col("_zone_id")).drop("_zone_id")


def total_surcharges(
    trips: DataFrame, candidates: Sequence[str] = SURCHARGE_CANDIDATES
) -> DataFrame:
    """Trips with the sum of the present surcharge columns (NULL as 0)."""
    return trips.withColumn("total_surcharges", surcharge_expr(trips.columns, candidates))


def _id_bucket_sums(
    trips: DataFrame, edges: Sequence[float], candidates: Sequence[str]
) -> DataFrame:
    t = fare_quality_filter(trips)
    dur = stored_seconds(t.columns)
    return t.groupBy(
        "pu_location_id", bucket_expr("trip_distance", edges).alias("distance_bucket")
    ).agg(
        F.count("total_amount").alias("n_total"),
        F.sum("total_amount").alias("s_total"),
        F.sum("trip_distance").alias("s_dist"),
        F.sum(dur).alias("s_dur"),
        F.sum("fare_amount").alias("s_fare"),
        F.count("fare_amount").alias("n_fare"),
        F.sum("tip_amount").alias("s_tip"),
        F.count("tip_amount").alias("n_tip"),
        F.sum(surcharge_expr(t.columns, candidates)).alias("s_sur"),
    )


def zone_revenue(
    trips: DataFrame,
    zones: DataFrame,
    edges: Sequence[float] = DISTANCE_EDGES,
    candidates: Sequence[str] = SURCHARGE_CANDIDATES,
) -> DataFrame:
    """Per (pickup_borough, pickup_zone, distance_bucket): trips (non-null
    totals), revenue, mean total, revenue per mile and per minute (ratios
    of sums), mean fare, mean tip, surcharge share of revenue."""
    sums = _id_bucket_sums(trips, edges, candidates)
    named = sums.join(zone_role(zones, "pickup"), F.col("pu_location_id") == F.col("pickup_id"))
    s_total = F.sum("s_total")
    return named.groupBy(*GROUP).agg(
        F.sum("n_total").alias("trips"),
        s_total.cast("double").alias("total_revenue"),
        ratio(s_total, F.sum("n_total")).alias("avg_revenue_per_trip"),
        ratio(s_total, F.sum("s_dist")).alias("revenue_per_mile"),
        F.try_divide(s_total.cast("double"), F.sum("s_dur").cast("double") / F.lit(60.0)).alias(
            "revenue_per_minute"
        ),
        ratio(F.sum("s_fare"), F.sum("n_fare")).alias("avg_fare_amount"),
        ratio(F.sum("s_tip"), F.sum("n_tip")).alias("avg_tip_amount"),
        ratio(F.sum("s_sur"), s_total).alias("surcharge_share"),
    )


def top_groups(groups: DataFrame, measure: str, alias: str, k: int, digits: int | None = None) -> DataFrame:
    """The ``k`` first groups of ``zone_revenue`` by a measure."""
    return (
        groups.orderBy(F.desc(measure), *GROUP)
        .limit(k)
        .select(*GROUP, "trips", maybe_round(F.col(measure), digits).alias(alias))
    )


def top_revenue(groups: DataFrame, k: int = 5, digits: int | None = None) -> DataFrame:
    """Of ``zone_revenue``'s groups the top k by revenue, no support limit."""
    return top_groups(groups, "total_revenue", "total_revenue", k, digits)


def top_per_mile(groups: DataFrame, min_trips: int = 50, k: int = 5, digits: int | None = None) -> DataFrame:
    """Groups with at least ``min_trips`` trips, top k by revenue per mile."""
    return top_groups(groups.where(F.col("trips") >= min_trips), "revenue_per_mile", "rev_per_mile", k, digits)


def top_per_minute(groups: DataFrame, min_trips: int = 50, k: int = 5, digits: int | None = None) -> DataFrame:
    """Groups with at least ``min_trips`` trips, top k by revenue per minute."""
    return top_groups(groups.where(F.col("trips") >= min_trips), "revenue_per_minute", "rev_per_min", k, digits)


def low_support(groups: DataFrame, max_trips: int = 10, k: int = 3, digits: int | None = None) -> DataFrame:
    """Groups with fewer than ``max_trips`` trips, top k by revenue per
    mile: the outliers a support limit removes."""
    return top_groups(groups.where(F.col("trips") < max_trips), "revenue_per_mile", "rev_per_mile", k, digits)


def zone_top_revenue(trips: DataFrame, zones: DataFrame, **options) -> DataFrame:
    return top_revenue(zone_revenue(trips, zones), **options)


def zone_top_per_mile(trips: DataFrame, zones: DataFrame, **options) -> DataFrame:
    return top_per_mile(zone_revenue(trips, zones), **options)


def zone_top_per_minute(trips: DataFrame, zones: DataFrame, **options) -> DataFrame:
    return top_per_minute(zone_revenue(trips, zones), **options)


def zone_low_support(trips: DataFrame, zones: DataFrame, **options) -> DataFrame:
    return low_support(zone_revenue(trips, zones), **options)


def sampled_source(trips: DataFrame, key: str = "l_orderkey", every: int = 10) -> DataFrame:
    """A repeatable trial-run sample: the trips whose ``key`` is a multiple
    of ``every``.  Distributed (a filter in every task), unlike an
    unordered ``limit`` that gathers arbitrary rows into one partition."""
    return trips.where(F.pmod(F.col(key), F.lit(every)) == 0)
