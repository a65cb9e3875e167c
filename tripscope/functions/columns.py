"""Column expressions shared by the operators.

All are built-in Catalyst expressions, so they stay inside whole-stage
codegen; nothing here leaves the JVM.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the reference's formulas.
KM_PER_MILE = 1.60934
EARTH_RADIUS_KM = 6371.0
# Time bands by pick-up hour (inclusive upper hours); later hours are "Late".
TIME_BANDS = (("Night", 5), ("Morning", 11), ("Afternoon", 16), ("Evening", 21))
LATE_BAND = "Late"
# Distance buckets in miles: below 1, [1, 3), [3, 10), 10 and above.
DISTANCE_EDGES = (1, 3, 10)
DISTANCE_LABELS = ("very_short", "short", "medium", "long")
# Surcharge columns that count when the input has them (any letter case).
SURCHARGE_CANDIDATES = (
    "extra",
    "mta_tax",
    "tolls_amount",
    "improvement_surcharge",
    "congestion_surcharge",
    "airport_fee",
)
# A trip is an airport trip if a zone name contains one of these tokens
# (case-sensitive) or a borough equals the region below.
AIRPORT_TOKENS = ("JFK", "LaGuardia", "Newark", "Airport")
AIRPORT_REGION = "EWR"
# Payment codes and their labels.
PAYMENT_LABELS = {1: "Card", 2: "Cash"}


def col_of(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def duration_seconds(pickup: str | Column = "pickup_ts", dropoff: str | Column = "dropoff_ts") -> Column:
    """Whole seconds between the two timestamps (exact, integral)."""
    return F.timestamp_diff("SECOND", col_of(pickup), col_of(dropoff))


def stored_seconds(columns: Iterable[str]) -> Column:
    """Duration in whole seconds: the stored column where preparation left
    one (then a scan needs neither timestamp), else from the timestamps."""
    return F.col("duration_seconds") if "duration_seconds" in columns else duration_seconds()


def zone_role(zones, prefix: str):
    """The zone dimension under one role: {prefix}_id, _borough, _zone."""
    names = {"LocationID": "id", "Borough": "borough", "Zone": "zone"}
    return zones.select(*[F.col(c).alias(f"{prefix}_{n}") for c, n in names.items()])


def time_band(hour: str | Column = "pickup_hour") -> Column:
    h = col_of(hour)
    expr = None
    lower = 0
    for label, upper in TIME_BANDS:
        cond = (h >= lower) & (h <= upper)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
        lower = upper + 1
    return expr.otherwise(LATE_BAND)


def distance_bucket(
    distance: str | Column = "trip_distance",
    edges: Sequence[float] = DISTANCE_EDGES,
    labels: Sequence[str] = DISTANCE_LABELS,
) -> Column:
    """Label of the half-open interval [edge_i, edge_i+1) holding the value."""
    if len(labels) != len(edges) + 1:
        raise ValueError("need one label more than edges")
    d = col_of(distance)
    expr = F.when(d < edges[0], labels[0])
    for lo, hi, label in zip(edges[:-1], edges[1:], labels[1:-1]):
        expr = expr.when((d >= lo) & (d < hi), label)
    return expr.otherwise(labels[-1])


def present_columns(columns: Iterable[str], candidates: Sequence[str]) -> list[str]:
    """The actual names of ``candidates`` found in ``columns``, case-insensitively."""
    by_lower = {c.lower(): c for c in columns}
    return [by_lower[c.lower()] for c in candidates if c.lower() in by_lower]


def total_surcharges(columns: Iterable[str], candidates: Sequence[str] = SURCHARGE_CANDIDATES) -> Column:
    """Sum of the present surcharge columns, NULL counted as 0."""
    amounts = [F.nvl(F.col(c), F.lit(0)) for c in present_columns(columns, candidates)]
    return sum(amounts[1:], amounts[0]) if amounts else F.lit(0)


def airport_flag(
    pu_zone: str | Column = "pu_zone",
    do_zone: str | Column = "do_zone",
    pu_borough: str | Column = "pu_borough",
    do_borough: str | Column = "do_borough",
    tokens: Sequence[str] = AIRPORT_TOKENS,
    region: str = AIRPORT_REGION,
) -> Column:
    """1 if either zone contains a token or either borough is ``region``."""
    cond = F.lit(False)
    for z in (col_of(pu_zone), col_of(do_zone)):
        for t in tokens:
            cond = cond | z.contains(t)
    for b in (col_of(pu_borough), col_of(do_borough)):
        cond = cond | (b == region)
    return F.when(cond, 1).otherwise(0)


def haversine_km(
    lat1: str | Column,
    lon1: str | Column,
    lat2: str | Column,
    lon2: str | Column,
    radius: float = EARTH_RADIUS_KM,
) -> Column:
    """Great-circle distance: 2R * atan2(sqrt(a), sqrt(1 - a))."""
    p1, p2 = F.radians(col_of(lat1)), F.radians(col_of(lat2))
    dlat = p2 - p1
    dlon = F.radians(col_of(lon2)) - F.radians(col_of(lon1))
    a = F.pow(F.sin(dlat / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(dlon / 2), 2)
    return F.lit(radius) * (2 * F.atan2(F.sqrt(a), F.sqrt(1 - a)))


def mean(c: str | Column) -> Column:
    """Mean ignoring NULLs as sum / count: the sum of a DECIMAL or integral
    column is exact, so the single division is the same on every engine."""
    x = col_of(c)
    return F.try_divide(F.sum(x).cast("double"), F.count(x))


def ratio(num: Column, den: Column) -> Column:
    """num / den as double; NULL where den is 0 (no ANSI error)."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def maybe_round(c: Column, digits: int | None) -> Column:
    return c if digits is None else F.round(c, digits)
