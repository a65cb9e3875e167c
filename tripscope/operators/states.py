"""Stored mergeable aggregates: partial states per day, merged at read time.

A *state* is an aggregate whose measures can be added up: counts, exact sums and
the limb sums of ``functions.exact``; distinct zones are bitmaps.  It is computed
per day and kept in a ``DayTable``, so a new or corrected day costs a scan of that
day alone, and a question over any range of days reads a few rows per group and
day instead of the trips.  The demand, payment and flow questions answered from
states give the same values as their full scans.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripscope.functions import exact
from tripscope.functions.columns import PAYMENT_LABELS, ratio, stored_seconds
from tripscope.functions.distinct import bitmaps, distinct_of_bitmaps
from tripscope.operators.flows import pair_sums, region_flows_of
from tripscope.operators.payments import payment_label, payment_trips
from tripscope.operators.quality import quality_filter
from tripscope.sources.days import DayTable

DAY = "pickup_day"


@dataclass(frozen=True)
class State:
    """``partial(trips)``: additive measures per ``keys`` and day."""

    name: str
    keys: tuple[str, ...]
    partial: Callable[[DataFrame], DataFrame]

    def merged(self, states: DataFrame, keys: Iterable[str] | None = None) -> DataFrame:
        """The measures per ``keys`` (a part of the state's) over all days read."""
        keys = list(self.keys if keys is None else keys)
        measures = [c for c in states.columns if c not in {DAY, *self.keys}]
        return states.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in measures])


def refresh(table: DayTable, trips: DataFrame, state: State, days: Iterable[int] | None = None) -> int:
    """Bring ``table`` up to date for ``days`` (all): only those days of the trips
    are scanned, and only their folders are written."""
    if days is not None:
        days = list(days)
        trips = trips.where(F.col(DAY).isin(days))
    return table.replace(state.partial(trips), days)


def of_days(table: DayTable, days: Iterable[int] | None = None) -> DataFrame:
    """The stored states of ``days`` (all): other days' folders are not read."""
    states = table.read()
    return states if days is None else states.where(F.col(DAY).isin(list(days)))


# ------------------------------------------------------------- demand (Q1)

HOURS = ("pickup_date", "pickup_hour")


def _hour_sums(trips: DataFrame) -> DataFrame:
    sums = {"passengers": F.col("passenger_count"), "seconds": stored_seconds(trips.columns),
            "distance": F.col("trip_distance"), "total": F.col("total_amount")}
    return quality_filter(trips).groupBy(DAY, *HOURS).agg(
        F.count(F.lit(1)).alias("trips"),
        *[F.sum(c).alias(f"s_{n}") for n, c in sums.items()],
        *[F.count(c).alias(f"n_{n}") for n, c in sums.items()],
    )


def _hour_zones(trips: DataFrame) -> DataFrame:
    return bitmaps(quality_filter(trips), [DAY, *HOURS], "pu_location_id")


DEMAND = State("demand", HOURS, _hour_sums)
#: Bitmaps are united, not added: ``distinct_zones`` reads them.
ZONES = State("zones", (*HOURS, "bucket"), _hour_zones)


def distinct_zones(zones: DataFrame, keys: Iterable[str] = HOURS) -> DataFrame:
    """keys, unique_pickup_zones: exact, from stored bitmaps."""
    return distinct_of_bitmaps(zones, list(keys), "unique_pickup_zones")


def demand_profile(sums: DataFrame, zones: DataFrame, hours: Iterable[int], k: int | None = 12) -> DataFrame:
    """``demand.demand_profile_by_date`` from the states of its days: the busiest
    (date, hour) groups, shares of the window, top ``k``."""
    window = F.col("pickup_hour").isin(list(hours))
    g = DEMAND.merged(sums.where(window)).join(distinct_zones(zones.where(window)), list(HOURS))
    g = g.select(
        *HOURS, "trips", "unique_pickup_zones",
        ratio(F.col("s_passengers"), F.col("n_passengers")).alias("avg_passenger_count"),
        (ratio(F.col("s_seconds"), F.col("n_seconds")) / F.lit(60.0)).alias("avg_duration_minutes"),
        ratio(F.col("s_distance"), F.col("n_distance")).alias("avg_trip_distance"),
        ratio(F.col("s_total"), F.col("n_total")).alias("avg_total_amount"),
        F.col("s_total").cast("double").alias("total_revenue"),
        (ratio(F.col("trips"), F.sum("trips").over(Window.partitionBy())) * 100).alias("trip_share"),
    )
    g = g.orderBy(F.desc("trips"), F.desc("total_revenue"), *HOURS)
    return g.limit(k) if k else g


# ----------------------------------------------------------- payments (Q4)

PAID = ("pickup_hour", "payment_type")


def _paid_sums(trips: DataFrame) -> DataFrame:
    t = payment_trips(trips)
    sums = {"fare": F.col("fare_amount"), "total": F.col("total_amount"), "tip": F.col("tip_amount"),
            "distance": F.col("trip_distance"), "seconds": stored_seconds(t.columns)}
    return t.groupBy(DAY, *PAID).agg(
        F.count(F.lit(1)).alias("trips"),
        F.count_if(F.col("tip_amount") == 0).alias("no_tip"),
        *[F.sum(c).alias(f"s_{n}") for n, c in sums.items()],
        *[F.count(c).alias(f"n_{n}") for n, c in sums.items()],
        *[a.alias(f"rate_{n}") for n, a in exact.ratio_state("tip_amount", "fare_amount").items()],
    )


PAYMENTS = State("payments", PAID, _paid_sums)


def payment_mix(sums: DataFrame) -> DataFrame:
    """``payments.payment_mix_by_hour`` from states; the mean of the trips' tip
    rates is exact to 2**-80 and not rounded for show."""
    g = PAYMENTS.merged(sums)
    mean = lambda n: ratio(F.col(f"s_{n}"), F.col(f"n_{n}"))
    in_hour = F.sum("trips").over(Window.partitionBy("pickup_hour"))
    return g.select(
        "pickup_hour",
        payment_label(PAYMENT_LABELS).alias("payment_method"),
        "trips",
        ratio(F.col("trips"), in_hour).alias("payment_share_in_hour"),
        mean("fare").alias("avg_fare_amount"),
        mean("total").alias("avg_total_amount"),
        mean("tip").alias("avg_tip_amount"),
        exact.ratio_mean_of({n: F.col(f"rate_{n}") for n in exact.RATIO_STATE}).alias("tip_rate"),
        ratio(F.col("no_tip"), F.col("trips")).alias("zero_tip_share"),
        mean("distance").alias("avg_trip_distance"),
        (mean("seconds") / F.lit(60.0)).alias("avg_duration_minutes"),
    ).orderBy("pickup_hour", "payment_method")


# -------------------------------------------------------------- flows (Q5)

PAIRS = ("pu_location_id", "do_location_id")
FLOWS = State("flows", PAIRS, lambda trips: pair_sums(trips, by=[DAY]))


def region_flows(sums: DataFrame, zones: DataFrame) -> DataFrame:
    """``flows.region_flows`` from the states of the pairs."""
    return region_flows_of(FLOWS.merged(sums), zones)


# --------------------------------------------------------- spread (exact)

def spread(trips: DataFrame, columns: dict[str, int]) -> DataFrame:
    """column_name, n, variance, stddev of each column (name -> its number of
    decimals): the same bits for any partitioning, nothing rounded for show."""
    states = {c: exact.square_state(c, d) for c, d in columns.items()}
    one = trips.agg(*[a.alias(f"{c}.{n}") for c, s in states.items() for n, a in s.items()])
    out: list[Column] = []
    for c, d in columns.items():
        state = {n: F.col(f"`{c}.{n}`") for n in exact.SQUARE_STATE}
        v = exact.variance_of(state, d)
        out.append(F.struct(F.lit(c).alias("column_name"), state["n"].alias("n"), v.alias("variance"), F.sqrt(v).alias("stddev")))
    return one.select(F.explode(F.array(*out)).alias("r")).select("r.*")
