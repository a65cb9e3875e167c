"""Origin-destination flows between boroughs and airport trips (Q5).

Plan shape (all but the sort-merge variant): trips are first aggregated
by (pick-up id, drop-off id) - at most |zones|^2 groups, partial
aggregation on the map side - and only those sums are joined to the zone
names, twice, and re-aggregated.  The fact table is never joined, so the
dimension join costs nothing at any scale, and a hot pair (Manhattan to
Manhattan holds most trips) is one pre-aggregated row per task rather
than a skewed join key.  Means are carried as (sum, count) pairs: exact
for DECIMAL money and integral seconds.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripscope.functions.columns import (
    AIRPORT_REGION,
    AIRPORT_TOKENS,
    airport_flag as airport_expr,
    maybe_round,
    present_columns,
    ratio,
    stored_seconds,
    zone_role,
)


def _airport_fee_col(df: DataFrame) -> str | None:
    found = present_columns(df.columns, ["airport_fee"])
    return found[0] if found else None


def _valid(trips: DataFrame) -> DataFrame:
    """The trips that the flow jobs count.  A duration above 0 implies both
    timestamps, so neither is read where preparation left the duration."""
    return trips.where((F.col("duration_minutes") > 0) & (F.col("trip_distance") > 0) & (F.col("total_amount") > 0))


def pair_sums(trips: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Valid trips reduced to one row per (pu id, do id), and ``by``."""
    dur = stored_seconds(trips.columns)
    fee = _airport_fee_col(trips)
    fee_aggs = (
        [F.sum(fee).alias("s_fee"), F.count(fee).alias("n_fee")]
        if fee
        else [F.lit(None).cast("double").alias("s_fee"), F.lit(0).cast("long").alias("n_fee")]
    )
    return _valid(trips).groupBy(*by, "pu_location_id", "do_location_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("total_amount").alias("s_total"),
        F.count("total_amount").alias("n_total"),
        F.sum("trip_distance").alias("s_dist"),
        F.count("trip_distance").alias("n_dist"),
        F.sum(dur).alias("s_dur"),
        F.count(dur).alias("n_dur"),
        *fee_aggs,
    )


def named_pairs(
    sums: DataFrame,
    zones: DataFrame,
    tokens: Sequence[str] = AIRPORT_TOKENS,
    region: str = AIRPORT_REGION,
) -> DataFrame:
    """Pair sums with both zones' names (inner joins: unknown ids drop)
    and the airport flag of the pair."""
    pu, do = zone_role(zones, "pu"), zone_role(zones, "do")
    named = (
        sums.join(pu, F.col("pu_location_id") == F.col("pu_id"))
        .join(do, F.col("do_location_id") == F.col("do_id"))
    )
    return named.withColumn(
        "is_airport", airport_expr("pu_zone", "do_zone", "pu_borough", "do_borough", tokens, region)
    )


def _mean(s: str, n: str) -> Column:
    return ratio(F.sum(s), F.sum(n))


def region_flows(
    trips: DataFrame,
    zones: DataFrame,
    tokens: Sequence[str] = AIRPORT_TOKENS,
    region: str = AIRPORT_REGION,
    digits: int | None = None,
) -> DataFrame:
    """Per (pick-up borough, drop-off borough): trips, share of all joined
    trips, revenue, mean total, distance, duration, airport share."""
    return region_flows_of(pair_sums(trips), zones, tokens, region, digits)


def region_flows_of(
    sums: DataFrame,
    zones: DataFrame,
    tokens: Sequence[str] = AIRPORT_TOKENS,
    region: str = AIRPORT_REGION,
    digits: int | None = None,
) -> DataFrame:
    """``region_flows`` from sums per pair of ids (``pair_sums``, or stored ones)."""
    g = named_pairs(sums, zones, tokens, region).groupBy("pu_borough", "do_borough").agg(
        F.sum("n").alias("trips"),
        F.sum("s_total").cast("double").alias("total_revenue"),
        _mean("s_total", "n_total").alias("avg_total_amount"),
        _mean("s_dist", "n_dist").alias("avg_trip_distance"),
        (_mean("s_dur", "n_dur") / F.lit(60.0)).alias("avg_duration_minutes"),
        ratio(F.sum(F.col("n") * F.col("is_airport")), F.sum("n")).alias("airport_trip_share"),
    )
    # Global share over the aggregated borough pairs (|boroughs|^2 rows).
    share = ratio(F.col("trips"), F.sum("trips").over(Window.partitionBy()))
    out = g.select(
        "pu_borough",
        "do_borough",
        "trips",
        maybe_round(share, digits and 4).alias("trip_share"),
        maybe_round(F.col("total_revenue"), digits).alias("total_revenue"),
        maybe_round(F.col("avg_total_amount"), digits).alias("avg_total_amount"),
        maybe_round(F.col("avg_trip_distance"), digits).alias("avg_trip_distance"),
        maybe_round(F.col("avg_duration_minutes"), digits).alias("avg_duration_minutes"),
        maybe_round(F.col("airport_trip_share"), digits and 4).alias("airport_trip_share"),
    )
    return out.orderBy(F.desc("trips"), "pu_borough", "do_borough")


def region_flow_counts(trips: DataFrame, zones: DataFrame, strategy: str = "merge") -> DataFrame:
    """Trips per borough pair, from counts per pair of ids: the fact table
    is aggregated before it meets the zones, so no trip row is shuffled on a
    zone and a hot zone is a few rows.

    ``strategy``: ``"merge"`` forces sort-merge joins with a hint on the
    dimension (not a session-wide setting); ``"auto"`` leaves the choice to
    the planner's size estimate and adaptive execution."""
    if strategy not in ("merge", "auto"):
        raise ValueError(f"unknown strategy {strategy!r}")
    pairs = _valid(trips).groupBy("pu_location_id", "do_location_id").agg(F.count(F.lit(1)).alias("n"))
    pu, do = (zone_role(zones, p).hint("merge") if strategy == "merge" else zone_role(zones, p) for p in ("pu", "do"))
    joined = pairs.join(pu, F.col("pu_location_id") == F.col("pu_id")).join(do, F.col("do_location_id") == F.col("do_id"))
    counts = joined.groupBy("pu_borough", "do_borough").agg(F.sum("n").alias("trips"))
    return counts.orderBy(F.desc("trips"), "pu_borough", "do_borough")


def region_flow_counts_merge(trips: DataFrame, zones: DataFrame) -> DataFrame:
    return region_flow_counts(trips, zones, "merge")


def airport_flag(
    trips: DataFrame,
    zones: DataFrame,
    tokens: Sequence[str] = AIRPORT_TOKENS,
    region: str = AIRPORT_REGION,
) -> DataFrame:
    """Trips per airport flag (1 = airport trip)."""
    g = named_pairs(pair_sums(trips), zones, tokens, region).groupBy("is_airport").agg(
        F.sum("n").alias("trips")
    )
    return g.select(F.col("is_airport").cast("int").alias("is_airport"), "trips").orderBy("is_airport")


def airport_flows(
    trips: DataFrame,
    zones: DataFrame,
    tokens: Sequence[str] = AIRPORT_TOKENS,
    region: str = AIRPORT_REGION,
    digits: int | None = None,
) -> DataFrame:
    """Airport trips per (pick-up zone, drop-off zone) name: trips, mean
    airport fee (NULLs ignored), total, duration, distance."""
    g = (
        named_pairs(pair_sums(trips), zones, tokens, region)
        .where(F.col("is_airport") == 1)
        .groupBy("pu_zone", "do_zone")
        .agg(
            F.sum("n").alias("trips"),
            _mean("s_fee", "n_fee").alias("avg_airport_fee"),
            _mean("s_total", "n_total").alias("avg_total_amount"),
            (_mean("s_dur", "n_dur") / F.lit(60.0)).alias("avg_duration_minutes"),
            _mean("s_dist", "n_dist").alias("avg_trip_distance"),
        )
    )
    out = g.select(
        "pu_zone",
        "do_zone",
        "trips",
        *[
            maybe_round(F.col(c), digits).alias(c)
            for c in ("avg_airport_fee", "avg_total_amount", "avg_duration_minutes", "avg_trip_distance")
        ],
    )
    return out.orderBy(F.desc("trips"), "pu_zone", "do_zone")
