"""DuckDB oracle SQL: the fixture spec as CTEs, then one query per key.

``FIXTURE_CTES`` is the text of FIXTURES.md section 3 (zones and trips over
the driver tables), followed by ``prepared`` - the columns preparation
derives (date, day, hour, duration, km, text timestamps).  Durations come
from the spec's ``dur_sec``; the Spark side derives them from the two
timestamps.  Every output column is cast explicitly so both engines
return the same types; means are SUM / COUNT so that exact sums give the
same double on both.  DuckDB's ROUND keeps the sign of a negative value
that rounds to zero (-0.0); ``+ 0.0`` turns it into the 0.0 Spark gives.
"""

from __future__ import annotations

from tripscope.sources.fixtures import (
    BAD_TIME, DAMAGED_DROPOFF, DAMAGED_PASSENGERS, DAMAGED_PICKUP, KEY_COLUMNS, RAW_COLUMNS,
)
from tripscope.sources.tables import DRIVER_TABLES
from tripscope.sources.views import GEO_KEYS

FIXTURE_CTES = """
zones AS (
  SELECT CAST(n_nationkey AS INTEGER) AS LocationID,
         CASE WHEN n_nationkey = 1 THEN 'EWR' ELSE r_name END AS Borough,
         CASE n_nationkey WHEN 1 THEN 'Newark Airport' WHEN 7 THEN 'JFK Airport'
              WHEN 12 THEN 'LaGuardia Airport' WHEN 15 THEN 'NATION_20'
              ELSE n_name END AS Zone
  FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_nationkey <> 24
),
keyed AS (
  SELECT *, (l_orderkey*7919 + l_partkey*104729 + l_linenumber*3571) % 86400 AS sec_of_day,
         (l_partkey*37 + l_suppkey*11) % 5400 - 60 AS dur_sec,
         CAST(CASE WHEN l_linenumber = 7 AND l_returnflag = 'R' THEN -l_extendedprice
                   ELSE l_extendedprice END AS DECIMAL(12,2)) AS fare
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
       JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey
),
m AS (
  SELECT *, fare * CAST(l_discount AS DECIMAL(4,2)) AS tip,
         CASE WHEN l_tax = 0 THEN NULL ELSE fare * CAST(l_tax AS DECIMAL(4,2)) END AS extra0
  FROM keyed
),
trips AS (
  SELECT l_orderkey, l_linenumber, l_partkey, 1 + l_suppkey % 3 AS vendor_id,
    o_orderdate + sec_of_day * INTERVAL '1' SECOND AS pickup_ts,
    o_orderdate + (sec_of_day + dur_sec) * INTERVAL '1' SECOND AS dropoff_ts, dur_sec,
    NULLIF(l_partkey % 7, 0) AS passenger_count, (l_quantity - 1) / 4 AS trip_distance,
    s_nationkey AS pu_location_id, c_nationkey AS do_location_id,
    CASE WHEN l_returnflag='A' THEN 1 WHEN l_returnflag='N' THEN 2
         WHEN l_linestatus='F' THEN 1 ELSE 3 END AS payment_type,
    fare AS fare_amount, tip AS tip_amount, extra0 AS extra,
    CAST(l_linenumber AS DECIMAL(4,2)) AS tolls_amount,
    CASE l_suppkey % 4 WHEN 0 THEN CAST(1.75 AS DECIMAL(4,2)) WHEN 1 THEN NULL
         ELSE CAST(0 AS DECIMAL(4,2)) END AS Airport_fee,
    fare + tip + COALESCE(extra0, 0) AS total_amount,
    40.5 + CAST(l_suppkey % 50 AS DOUBLE)/100 AS pickup_latitude,
    -74.25 + CAST(l_suppkey % 37 AS DOUBLE)/50 AS pickup_longitude,
    40.5 + CAST(o_custkey % 50 AS DOUBLE)/100 AS dropoff_latitude,
    -74.25 + CAST(o_custkey % 37 AS DOUBLE)/50 AS dropoff_longitude
  FROM m
),
prepared AS (
  SELECT *,
    strftime(pickup_ts, '%Y-%m-%dT%H:%M:%S.%g') AS tpep_pickup_datetime,
    strftime(dropoff_ts, '%Y-%m-%dT%H:%M:%S.%g') AS tpep_dropoff_datetime,
    CAST(pickup_ts AS DATE) AS pickup_date,
    CAST(dayofmonth(pickup_ts) AS INTEGER) AS pickup_day,
    CAST(hour(pickup_ts) AS INTEGER) AS pickup_hour,
    CAST(dur_sec AS DOUBLE) / 60.0 AS duration_minutes,
    trip_distance * 1.60934 AS trip_distance_km
  FROM trips
)
"""


def with_fixture(*ctes: str) -> str:
    """``WITH <fixture>, <ctes...>`` - append a final SELECT to it."""
    parts = [FIXTURE_CTES.strip()] + [c.strip() for c in ctes]
    return "WITH " + ",\n".join(parts) + "\n"


QUALITY = "duration_minutes > 0 AND trip_distance > 0 AND total_amount > 0"
FARE_QUALITY = "duration_minutes > 0 AND trip_distance > 0 AND fare_amount > 0 AND total_amount > 0"

AIRPORT_COND = """(
  pu.Zone LIKE '%JFK%' OR pu.Zone LIKE '%LaGuardia%' OR pu.Zone LIKE '%Newark%' OR pu.Zone LIKE '%Airport%' OR
  d.Zone LIKE '%JFK%' OR d.Zone LIKE '%LaGuardia%' OR d.Zone LIKE '%Newark%' OR d.Zone LIKE '%Airport%' OR
  pu.Borough = 'EWR' OR d.Borough = 'EWR')"""

FLOW_JOIN = f"""flow AS (
  SELECT t.*, pu.Borough AS pu_borough, d.Borough AS do_borough, pu.Zone AS pu_zone, d.Zone AS do_zone,
         CASE WHEN {AIRPORT_COND} THEN 1 ELSE 0 END AS is_airport
  FROM prepared t JOIN zones pu ON t.pu_location_id = pu.LocationID
                  JOIN zones d ON t.do_location_id = d.LocationID
  WHERE {QUALITY})"""



def _view(cols, src: str = "t") -> str:
    return ", ".join(f"CAST({src}.{c} AS {d}) AS {c}" for c, _, d in cols)


def _mean(c: str, where: str | None = None) -> str:
    f = f" FILTER (WHERE {where})" if where else ""
    return f"CAST(SUM({c}){f} AS DOUBLE) / NULLIF(COUNT({c}){f}, 0)"


KEYS = list(KEY_COLUMNS)
RAW_SOURCE = {"VendorID": "vendor_id", "PULocationID": "pu_location_id", "DOLocationID": "do_location_id"}
RAW_EXPLICIT = {
    "l_orderkey": "BIGINT", "l_linenumber": "BIGINT", "l_partkey": "BIGINT", "VendorID": "INTEGER",
    "tpep_pickup_datetime": "VARCHAR", "tpep_dropoff_datetime": "VARCHAR", "passenger_count": "INTEGER",
    "PULocationID": "INTEGER", "DOLocationID": "INTEGER", "payment_type": "INTEGER",
}
RAW_INFERRED = {
    "l_orderkey": "INTEGER", "l_linenumber": "INTEGER", "l_partkey": "INTEGER", "VendorID": "INTEGER",
    "tpep_pickup_datetime": "TIMESTAMP", "tpep_dropoff_datetime": "TIMESTAMP", "passenger_count": "INTEGER",
    "PULocationID": "INTEGER", "DOLocationID": "INTEGER", "payment_type": "INTEGER",
}


def _raw_select(types: dict[str, str]) -> str:
    return ", ".join(
        f"CAST({RAW_SOURCE.get(c, c)} AS {types.get(c, 'DOUBLE')}) AS {c}" for c in RAW_COLUMNS
    )


def _trip_view(coords: bool = False, text_ts: bool = False, extra=()):
    from tripscope.sources.views import spec

    return spec(coords=coords, text_ts=text_ts, extra=list(extra))


HAVERSINE = """6371.0 * (2 * atan2(sqrt(hav_a), sqrt(1 - hav_a)))"""
HAV_A = """pow(sin((radians(dropoff_latitude) - radians(pickup_latitude)) / 2), 2)
    + cos(radians(pickup_latitude)) * cos(radians(dropoff_latitude))
    * pow(sin((radians(dropoff_longitude) - radians(pickup_longitude)) / 2), 2)"""

GEO_VALID = """trip_distance > 0 AND dropoff_ts > pickup_ts
  AND pickup_longitude BETWEEN -75 AND -73 AND pickup_latitude BETWEEN 40 AND 42
  AND dropoff_longitude BETWEEN -75 AND -73 AND dropoff_latitude BETWEEN 40 AND 42"""

GEO_CTES = [
    f"""gv AS (SELECT *, CAST(dur_sec AS DOUBLE) / 3600.0 AS duration_hours,
         (trip_distance * 1.60934) / (CAST(dur_sec AS DOUBLE) / 3600.0) AS speed_kmh,
         {HAV_A} AS hav_a
  FROM prepared WHERE {GEO_VALID})""",
    f"""gh AS (SELECT *, {HAVERSINE} AS haversine_km FROM gv)""",
    """gm AS (SELECT *, (trip_distance * 1.60934) / haversine_km AS detour_ratio
  FROM gh WHERE haversine_km > 0 AND speed_kmh > 0 AND speed_kmh < 120)""",
]

BUCKET = """CASE WHEN trip_distance < 1 THEN 'very_short'
  WHEN trip_distance >= 1 AND trip_distance < 3 THEN 'short'
  WHEN trip_distance >= 3 AND trip_distance < 10 THEN 'medium' ELSE 'long' END"""

SURCHARGE = "COALESCE(extra, 0) + COALESCE(tolls_amount, 0) + COALESCE(Airport_fee, 0)"

ZONE_REVENUE = f"""zr AS (
  SELECT z.Borough AS pickup_borough, z.Zone AS pickup_zone, {BUCKET} AS distance_bucket,
    CAST(COUNT(total_amount) AS BIGINT) AS trips,
    CAST(SUM(total_amount) AS DOUBLE) AS total_revenue,
    CAST(SUM(total_amount) AS DOUBLE) / COUNT(total_amount) AS avg_revenue_per_trip,
    CAST(SUM(total_amount) AS DOUBLE) / CAST(SUM(trip_distance) AS DOUBLE) AS revenue_per_mile,
    CAST(SUM(total_amount) AS DOUBLE) / (CAST(SUM(dur_sec) AS DOUBLE) / 60.0) AS revenue_per_minute,
    {_mean('fare_amount')} AS avg_fare_amount,
    {_mean('tip_amount')} AS avg_tip_amount,
    CAST(SUM({SURCHARGE}) AS DOUBLE) / CAST(SUM(total_amount) AS DOUBLE) AS surcharge_share
  FROM prepared t JOIN zones z ON t.pu_location_id = z.LocationID
  WHERE {FARE_QUALITY}
  GROUP BY 1, 2, 3)"""
ZR_GROUP = "pickup_borough, pickup_zone, distance_bucket"

IMB_BASE = [
    """ft AS (SELECT pickup_hour, pu_location_id, do_location_id FROM prepared
  WHERE pickup_ts IS NOT NULL AND duration_minutes > 0 AND total_amount > 0)""",
    """pk AS (SELECT pickup_hour, pu_location_id AS location_id, COUNT(*) AS pickups FROM ft GROUP BY 1, 2)""",
    """dk AS (SELECT pickup_hour, do_location_id AS location_id, COUNT(*) AS dropoffs FROM ft GROUP BY 1, 2)""",
    """mt AS (SELECT COALESCE(p.pickup_hour, d.pickup_hour) AS pickup_hour,
         COALESCE(p.location_id, d.location_id) AS location_id,
         COALESCE(pickups, 0) AS pickups, COALESCE(dropoffs, 0) AS dropoffs
  FROM pk p FULL OUTER JOIN dk d ON p.pickup_hour = d.pickup_hour AND p.location_id = d.location_id)""",
]


def _imbalance(min_activity: int, rounded: bool) -> str:
    net, act = "(m.pickups - m.dropoffs)", "(m.pickups + m.dropoffs)"
    if rounded:
        ratio = (
            f"CASE WHEN {act} > 0 THEN CAST(sign({net}) * ((abs({net}) * 20000 + {act}) // (2 * {act})) AS DOUBLE)"
            " / 10000.0 ELSE 0.0 END"
        )
    else:
        ratio = f"CASE WHEN {act} > 0 THEN CAST({net} AS DOUBLE) / {act} ELSE 0.0 END"
    return f"""zi AS (
  SELECT CAST(m.pickup_hour AS INTEGER) AS pickup_hour, CAST(m.location_id AS INTEGER) AS location_id,
    z.Borough AS borough, z.Zone AS zone, CAST(m.pickups AS BIGINT) AS pickups,
    CAST(m.dropoffs AS BIGINT) AS dropoffs, CAST({act} AS BIGINT) AS activity,
    CAST({net} AS BIGINT) AS net_pickups, {ratio} AS imbalance_ratio, abs({ratio}) AS abs_imbalance_ratio
  FROM mt m JOIN zones z ON m.location_id = z.LocationID
  WHERE {act} >= {min_activity})"""


def _od(split_day: int, min_trips: int) -> str:
    h1, h2 = f"pickup_day <= {split_day}", f"pickup_day > {split_day}"
    return f"""od AS (
  SELECT CAST(pu_location_id AS INTEGER) AS pu_location_id, CAST(do_location_id AS INTEGER) AS do_location_id,
    CAST(pickup_hour AS INTEGER) AS pickup_hour,
    CAST(COUNT(*) FILTER (WHERE {h1}) AS BIGINT) AS trips_h1,
    CAST(COUNT(*) FILTER (WHERE {h2}) AS BIGINT) AS trips_h2,
    {_mean('fare_amount', h1)} AS avg_fare_h1, {_mean('fare_amount', h2)} AS avg_fare_h2,
    {_mean('total_amount', h1)} AS avg_total_h1, {_mean('total_amount', h2)} AS avg_total_h2
  FROM prepared WHERE duration_minutes > 0 AND trip_distance > 0 AND fare_amount > 0
  GROUP BY 1, 2, 3)""", f"""odc AS (
  SELECT *, ROUND((trips_h2 - trips_h1) * 100 / trips_h1, 2) + 0.0 AS trips_change_pct,
    ROUND((avg_fare_h2 - avg_fare_h1) * 100 / avg_fare_h1, 2) + 0.0 AS fare_change_pct
  FROM od WHERE trips_h1 >= {min_trips} AND trips_h2 > 0)"""


def _profile(keys: str, where: str, null_as_zero: bool) -> str:
    if null_as_zero:
        z = lambda c: f"COALESCE({c}, 0)"
        aggs = f"""CAST(COUNT(DISTINCT NULLIF(pu_location_id, 0)) AS BIGINT) AS unique_pickup_zones,
    CAST(SUM({z('passenger_count')}) AS DOUBLE) / COUNT(*) AS avg_passenger_count,
    CAST(SUM(dur_sec) AS DOUBLE) / COUNT(*) / 60.0 AS avg_duration_minutes,
    CAST(SUM({z('trip_distance')}) AS DOUBLE) / COUNT(*) AS avg_trip_distance,
    CAST(SUM({z('total_amount')}) AS DOUBLE) / COUNT(*) AS avg_total_amount,
    CAST(SUM({z('total_amount')}) AS DOUBLE) AS total_revenue"""
    else:
        aggs = f"""CAST(COUNT(DISTINCT pu_location_id) AS BIGINT) AS unique_pickup_zones,
    {_mean('passenger_count')} AS avg_passenger_count,
    CAST(SUM(dur_sec) AS DOUBLE) / NULLIF(COUNT(dur_sec), 0) / 60.0 AS avg_duration_minutes,
    {_mean('trip_distance')} AS avg_trip_distance,
    {_mean('total_amount')} AS avg_total_amount,
    CAST(SUM(total_amount) AS DOUBLE) AS total_revenue"""
    return f"""
SELECT {keys}, CAST(COUNT(*) AS BIGINT) AS trips,
    {aggs},
    CAST(COUNT(*) AS DOUBLE) / SUM(COUNT(*)) OVER () * 100 AS trip_share
FROM prepared WHERE {where}
GROUP BY {keys}
ORDER BY trips DESC, total_revenue DESC, {keys}
LIMIT 12
"""


PAID = "trip_distance > 0 AND fare_amount > 0 AND total_amount > 0 AND payment_type IN (1, 2) AND pickup_hour IS NOT NULL"
TIP_RATE = "CAST(tip_amount AS DOUBLE) / CAST(fare_amount AS DOUBLE)"


def _card_cash(rate_digits: int) -> str:
    card, cash = "payment_type = 1", "payment_type = 2"
    return f"""CAST(COUNT(*) FILTER (WHERE {card}) AS BIGINT) AS card_trips,
    CAST(COUNT(*) FILTER (WHERE {cash}) AS BIGINT) AS cash_trips,
    CAST(COUNT(*) FILTER (WHERE {card}) AS DOUBLE) / COUNT(*) AS card_share,
    {_mean('total_amount', card)} AS avg_total_card, {_mean('total_amount', cash)} AS avg_total_cash,
    {_mean('fare_amount', card)} AS avg_fare_card, {_mean('fare_amount', cash)} AS avg_fare_cash,
    ROUND(SUM({TIP_RATE}) FILTER (WHERE {card}) / NULLIF(COUNT({TIP_RATE}) FILTER (WHERE {card}), 0),
          {rate_digits}) AS avg_tip_rate_card"""


def _hit(rule: tuple[str, int]) -> str:
    return f"{rule[0]} % {rule[1]} = 0"


# The raw rows with their damaged cells; a count that is no number reads as NULL.
DAMAGED = f"""damaged AS (SELECT * REPLACE (
    CASE WHEN {_hit(DAMAGED_PICKUP)} THEN '{BAD_TIME}' ELSE tpep_pickup_datetime END AS tpep_pickup_datetime,
    CASE WHEN {_hit(DAMAGED_DROPOFF)} THEN NULL ELSE tpep_dropoff_datetime END AS tpep_dropoff_datetime,
    CASE WHEN {_hit(DAMAGED_PASSENGERS)} THEN NULL ELSE passenger_count END AS passenger_count),
    NOT ({_hit(DAMAGED_PICKUP)} OR {_hit(DAMAGED_DROPOFF)}) AS readable
  FROM prepared)"""


# Mean of tip / fare per trip: three limbs of each ratio, summed as whole numbers,
# carried and divided by the count; every step is the same on both engines.
RATIO_LIMBS = f"""r0 AS (SELECT *, {TIP_RATE} * 1048576.0::DOUBLE AS x0 FROM prepared WHERE {PAID} AND duration_minutes > 0),
r1 AS (SELECT *, (x0 - floor(x0)) * 1073741824.0::DOUBLE AS x1 FROM r0),
r2 AS (SELECT *, (x1 - floor(x1)) * 1073741824.0::DOUBLE AS x2 FROM r1),
limbs AS (
  SELECT pickup_hour, payment_type, COUNT(x0)::HUGEINT AS n, SUM(floor(x0)::BIGINT) AS l0, SUM(floor(x1)::BIGINT) AS l1,
         SUM(floor(x2)::BIGINT) AS l2 FROM r2 GROUP BY ALL),
carried AS (
  SELECT *, l2 % 1073741824 AS c2, (l1 + l2 // 1073741824) % 1073741824 AS c1,
         l0 + (l1 + l2 // 1073741824) // 1073741824 AS c0 FROM limbs),
tip_means AS (
  SELECT pickup_hour, payment_type,
    (c0 // n)::BIGINT::DOUBLE * pow(2.0, -20) + ((((c0 % n) * 1073741824 + c1) // n)::BIGINT::DOUBLE * pow(2.0, -50)
    + ((((c0 % n) * 1073741824 + c1) % n * 1073741824 + c2) // n)::BIGINT::DOUBLE * pow(2.0, -80)) AS tip_mean
  FROM carried)"""


def _spread(column: str, digits: int) -> str:
    """Sample variance by whole numbers (see ``functions.exact``)."""
    return f"""SELECT '{column}' AS column_name, n::BIGINT AS n, variance, sqrt(variance) AS stddev FROM (
  SELECT n, ((whole // 1000000000000000)::BIGINT::DOUBLE * 1e15::DOUBLE + (whole % 1000000000000000)::BIGINT::DOUBLE
         - r::DOUBLE * r::DOUBLE / n::DOUBLE) / (n - 1)::DOUBLE / 1e{2 * digits}::DOUBLE AS variance FROM (
    SELECT n, r, squares - q * q * n - 2 * q * r AS whole FROM (
      SELECT n, squares, s // n AS q, s % n AS r FROM (
        SELECT COUNT(x)::HUGEINT AS n, SUM(x) AS s, SUM(x::HUGEINT * x::HUGEINT)::HUGEINT AS squares
        FROM (SELECT CAST({column} * {10 ** digits} AS BIGINT) AS x FROM prepared)))))"""


def _sql(p: dict) -> dict[str, str]:
    q: dict[str, str] = {}
    W = with_fixture
    view = _view
    keep = f"readable AND year(pickup_ts) BETWEEN {p['prepare_years'][0]} AND {p['prepare_years'][1]}"

    # A. ingest
    q["csv_explicit_scan"] = W(DAMAGED) + f"SELECT {_raw_select(RAW_EXPLICIT)} FROM damaged"
    q["csv_inferred_scan"] = W() + f"SELECT {_raw_select(RAW_INFERRED)} FROM prepared"
    q["prepare_trips"] = W(DAMAGED) + f"SELECT {view(_trip_view(coords=True, text_ts=True))} FROM damaged t WHERE {keep}"
    days = ", ".join(str(d) for d in p["roundtrip_days"])
    q["partitioned_roundtrip"] = W() + f"SELECT {view(_trip_view())} FROM prepared t WHERE pickup_day IN ({days})"
    q["prepare_metrics"] = W(DAMAGED) + f"""SELECT CAST(COUNT(*) AS BIGINT) AS raw_rows,
  CAST(COUNT(*) FILTER (WHERE {keep}) AS BIGINT) AS processed_rows,
  CAST(COUNT(*) - COUNT(*) FILTER (WHERE {keep}) AS BIGINT) AS dropped_rows
FROM damaged"""
    pickup_bad, dropoff_bad = _hit(DAMAGED_PICKUP), _hit(DAMAGED_DROPOFF)
    q["prepare_accounting"] = W(DAMAGED) + f"""SELECT CAST(COUNT(*) AS BIGINT) AS raw_rows,
  CAST(COUNT(*) FILTER (WHERE {keep}) AS BIGINT) AS kept_rows,
  CAST(COUNT(*) FILTER (WHERE {pickup_bad}) AS BIGINT) AS dropped_pickup_time,
  CAST(COUNT(*) FILTER (WHERE NOT {pickup_bad} AND {dropoff_bad}) AS BIGINT) AS dropped_dropoff_time,
  CAST(COUNT(*) FILTER (WHERE readable AND NOT ({keep})) AS BIGINT) AS dropped_year
FROM damaged"""
    q["rejected_cells"] = W() + "\nUNION ALL\n".join(
        f"""SELECT CAST(year(pickup_ts) AS INTEGER) AS file_year, '{column}' AS "column", CAST(COUNT(*) AS BIGINT) AS bad_cells
FROM prepared WHERE {_hit(rule)} GROUP BY 1"""
        for column, rule in (("tpep_pickup_datetime", DAMAGED_PICKUP), ("passenger_count", DAMAGED_PASSENGERS))
    )
    q["prepare_late_day"] = W() + f"""SELECT pickup_day, CAST(COUNT(*) AS BIGINT) AS trips,
  CAST(SUM(passenger_count) AS BIGINT) AS passengers, CAST(SUM(total_amount) AS DOUBLE) AS total_revenue,
  pickup_day = {p['late_day']} AS rewritten FROM prepared GROUP BY pickup_day"""
    q["source_inventory"] = "\nUNION ALL\n".join(
        f"SELECT '{t}.parquet' AS file_name, CAST(COUNT(*) AS BIGINT) AS rows FROM {t}" for t in DRIVER_TABLES
    )

    # B. exploration
    def describe(c: str) -> str:
        return (f"SELECT '{c}' AS column_name, CAST(COUNT({c}) AS BIGINT) AS n, {_mean(c)} AS mean, "
                f"ROUND(stddev_samp(CAST({c} AS DOUBLE)), {p['stddev_digits']}) AS stddev, CAST(MIN({c}) AS DOUBLE) AS min, "
                f"CAST(MAX({c}) AS DOUBLE) AS max FROM prepared")
    q["eda_describe"] = W() + describe("trip_distance") + "\nUNION ALL\n" + describe("total_amount")
    q["exact_spread"] = W() + "\nUNION ALL\n".join(_spread(c, d) for c, d in p["spread_columns"].items())
    nulls = ", ".join(
        f"CAST(COUNT(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS {c}"
        for c, _, _ in _trip_view(coords=True, text_ts=True)
    )
    q["eda_null_counts"] = W() + f"SELECT {nulls} FROM prepared"
    q["eda_top_zones"] = W() + """SELECT z.Zone AS zone, CAST(COUNT(*) AS BIGINT) AS trips
FROM prepared t JOIN zones z ON t.pu_location_id = z.LocationID
GROUP BY z.Zone ORDER BY trips DESC, zone LIMIT 10"""
    q["eda_extremes"] = W() + """(SELECT 'max_trip_distance' AS kind, CAST(trip_distance AS DOUBLE) AS trip_distance,
        CAST(total_amount AS DOUBLE) AS total_amount
 FROM prepared ORDER BY trip_distance DESC, total_amount DESC LIMIT 1)
UNION ALL
(SELECT 'min_total_amount' AS kind, CAST(trip_distance AS DOUBLE) AS trip_distance,
        CAST(total_amount AS DOUBLE) AS total_amount
 FROM prepared ORDER BY total_amount ASC, trip_distance DESC LIMIT 1)"""

    # C. demand
    quality = f"pickup_ts IS NOT NULL AND dropoff_ts IS NOT NULL AND {QUALITY}"
    q["quality_filter"] = W() + f"SELECT {view(_trip_view())} FROM prepared t WHERE {quality}"
    ddays = ", ".join(str(d) for d in p["demand_days"])
    dhours = ", ".join(str(h) for h in p["demand_hours"])
    window = f"pickup_day IN ({ddays}) AND pickup_hour IN ({dhours})"
    q["demand_window"] = W() + f"SELECT {view(_trip_view())} FROM prepared t WHERE {window}"
    q["time_band_profile"] = W() + f"""SELECT CASE WHEN pickup_hour BETWEEN 0 AND 5 THEN 'Night'
  WHEN pickup_hour BETWEEN 6 AND 11 THEN 'Morning' WHEN pickup_hour BETWEEN 12 AND 16 THEN 'Afternoon'
  WHEN pickup_hour BETWEEN 17 AND 21 THEN 'Evening' ELSE 'Late' END AS time_band,
  CAST(COUNT(*) AS BIGINT) AS trips
FROM prepared WHERE {quality} GROUP BY 1"""
    q["demand_profile_by_date"] = W() + _profile("pickup_date, pickup_hour", f"{quality} AND {window}", False)
    q["demand_from_states"] = q["demand_profile_by_date"]
    some_days = ", ".join(str(d) for d in p["distinct_days"])
    q["distinct_zones_by_hour"] = W() + f"""SELECT pickup_hour, CAST(COUNT(DISTINCT pu_location_id) AS BIGINT) AS unique_pickup_zones
FROM prepared WHERE {quality} AND pickup_day IN ({some_days}) GROUP BY pickup_hour"""
    lo, hi = p["demand_hour_range"]
    q["demand_profile_by_day"] = W() + _profile("pickup_day, pickup_hour", f"pickup_hour BETWEEN {lo} AND {hi}", False)
    q["demand_profile_null_as_zero"] = W() + _profile(
        "pickup_day, pickup_hour",
        f"pickup_hour BETWEEN {lo} AND {hi} AND pickup_ts IS NOT NULL AND dropoff_ts IS NOT NULL",
        True,
    )

    # D. geo
    q["geo_valid_filter"] = W() + f"SELECT {view(_trip_view(coords=True))} FROM prepared t WHERE {GEO_VALID}"
    q["trip_speed"] = W(*GEO_CTES[:1]) + (
        f"SELECT {view(GEO_KEYS)}, duration_hours, speed_kmh FROM gv t"
    )
    q["haversine_builtin"] = W(f"hv AS (SELECT *, {HAV_A} AS hav_a FROM prepared)") + (
        f"SELECT {view(KEYS)}, ROUND({HAVERSINE} * 1000, 0) AS haversine_m FROM hv t"
    )
    q["haversine_udf"] = W(f"hv AS (SELECT *, {HAV_A} AS hav_a FROM prepared)") + (
        f"SELECT {view(KEYS)}, ROUND({HAVERSINE} * 1000, 0) AS haversine_m FROM hv t"
    )
    q["detour_ratio"] = W(*GEO_CTES) + (
        f"SELECT {view(GEO_KEYS)}, speed_kmh, ROUND(haversine_km * 1000, 0) AS haversine_m, "
        f"ROUND(detour_ratio, {p['detour_digits']}) AS detour_ratio FROM gm t"
    )
    q["speed_by_hour"] = W(*GEO_CTES) + """SELECT pickup_hour,
  ROUND(SUM(speed_kmh) / COUNT(speed_kmh), {sd}) AS avg_speed_kmh,
  ROUND(SUM(detour_ratio) / COUNT(detour_ratio), {sd}) AS avg_detour_ratio
FROM gm GROUP BY pickup_hour""".format(sd=p["speed_digits"])
    for key, direction in (("fastest_trips", "DESC"), ("slowest_trips", "ASC")):
        q[key] = W(*GEO_CTES) + f"""SELECT CAST(pickup_ts AS TIMESTAMP) AS pickup_ts, CAST(dropoff_ts AS TIMESTAMP) AS dropoff_ts,
  trip_distance AS dist_miles, speed_kmh
FROM gm ORDER BY speed_kmh {direction}, pickup_ts, dropoff_ts, trip_distance LIMIT 5"""

    # E. revenue
    q["fare_quality_filter"] = W() + f"SELECT {view(_trip_view())} FROM prepared t WHERE {FARE_QUALITY}"
    q["distance_bucket"] = W() + f"""SELECT {BUCKET} AS distance_bucket, CAST(COUNT(*) AS BIGINT) AS trips
FROM prepared WHERE {FARE_QUALITY} GROUP BY 1"""
    enrich_cols = _trip_view(extra=[("pickup_borough", "", "VARCHAR"), ("pickup_zone", "", "VARCHAR")])
    q["zone_enrich"] = W(
        "en AS (SELECT t.*, z.Borough AS pickup_borough, z.Zone AS pickup_zone "
        "FROM prepared t JOIN zones z ON t.pu_location_id = z.LocationID)"
    ) + f"SELECT {view(enrich_cols)} FROM en t"
    q["total_surcharges"] = W() + f"SELECT {view(KEYS)}, CAST({SURCHARGE} AS DOUBLE) AS total_surcharges FROM prepared t"
    q["zone_revenue"] = W(ZONE_REVENUE) + "SELECT * FROM zr"
    q["zone_top_revenue"] = W(ZONE_REVENUE) + f"""SELECT {ZR_GROUP}, trips, total_revenue FROM zr
ORDER BY total_revenue DESC, {ZR_GROUP} LIMIT 5"""
    q["zone_top_per_mile"] = W(ZONE_REVENUE) + f"""SELECT {ZR_GROUP}, trips, revenue_per_mile AS rev_per_mile FROM zr
WHERE trips >= {p['revenue_min_trips']} ORDER BY revenue_per_mile DESC, {ZR_GROUP} LIMIT 5"""
    q["zone_top_per_minute"] = W(ZONE_REVENUE) + f"""SELECT {ZR_GROUP}, trips, revenue_per_minute AS rev_per_min FROM zr
WHERE trips >= {p['revenue_min_trips']} ORDER BY revenue_per_minute DESC, {ZR_GROUP} LIMIT 5"""
    q["zone_low_support"] = W(ZONE_REVENUE) + f"""SELECT {ZR_GROUP}, trips, revenue_per_mile AS rev_per_mile FROM zr
WHERE trips < {p['revenue_low_trips']} ORDER BY revenue_per_mile DESC, {ZR_GROUP} LIMIT 3"""
    key, every = p["sample"]
    q["sampled_source"] = W() + f"SELECT {view(_trip_view())} FROM prepared t WHERE {key} % {every} = 0"
    q["sampled_rows"] = W() + f"""SELECT {view(_trip_view())} FROM prepared t
ORDER BY md5(concat_ws('|', '0', '=' || l_orderkey, '=' || l_linenumber)), l_orderkey, l_linenumber LIMIT {p['sample_rows']}"""

    # F. payments
    q["payment_mix_by_hour"] = W(f"""hs AS (
  SELECT pickup_hour, payment_type, COUNT(*) AS trips,
    {_mean('fare_amount')} AS avg_fare_amount, {_mean('total_amount')} AS avg_total_amount,
    {_mean('tip_amount')} AS avg_tip_amount,
    ROUND(SUM({TIP_RATE}) / COUNT({TIP_RATE}), {p['rate_digits']}) AS tip_rate,
    CAST(COUNT(*) FILTER (WHERE tip_amount = 0) AS DOUBLE) / COUNT(*) AS zero_tip_share,
    {_mean('trip_distance')} AS avg_trip_distance,
    CAST(SUM(dur_sec) AS DOUBLE) / COUNT(dur_sec) / 60.0 AS avg_duration_minutes
  FROM prepared WHERE {PAID} AND duration_minutes > 0 GROUP BY 1, 2)""") + """SELECT pickup_hour,
  CASE WHEN payment_type = 1 THEN 'Card' WHEN payment_type = 2 THEN 'Cash' END AS payment_method,
  CAST(trips AS BIGINT) AS trips,
  CAST(trips AS DOUBLE) / SUM(trips) OVER (PARTITION BY pickup_hour) AS payment_share_in_hour,
  avg_fare_amount, avg_total_amount, avg_tip_amount, tip_rate, zero_tip_share, avg_trip_distance,
  avg_duration_minutes
FROM hs"""
    mix = q["payment_mix_by_hour"]
    q["payment_mix_from_states"] = (
        mix.replace("\nhs AS (", f"\n{RATIO_LIMBS},\nhs AS (").replace("avg_tip_amount, tip_rate,", "avg_tip_amount, tip_mean AS tip_rate,")
        .replace("FROM hs", "FROM hs JOIN tip_means USING (pickup_hour, payment_type)")
    )
    q["card_vs_cash_by_hour"] = W() + f"SELECT pickup_hour, {_card_cash(p['rate_digits'])} FROM prepared WHERE {PAID} GROUP BY pickup_hour"
    q["vendor_card_summary"] = W(
        f"vc AS (SELECT vendor_id, {_card_cash(p['rate_digits'])} FROM prepared WHERE {PAID} GROUP BY vendor_id)"
    ) + "SELECT CAST(vendor_id AS INTEGER) AS vendor_id, card_share, avg_tip_rate_card FROM vc"
    vendor_sql = W() + f"""SELECT CAST(hour(pickup_ts) AS INTEGER) AS pickup_hour, CAST(COUNT(*) AS BIGINT) AS trips
FROM prepared WHERE vendor_id = {p['vendor']} GROUP BY 1"""
    q["vendor_hourly_count"] = vendor_sql
    q["vendor_hourly_count_csv"] = vendor_sql

    # G. flows
    q["region_flows"] = W(FLOW_JOIN) + """
SELECT pu_borough, do_borough, CAST(COUNT(*) AS BIGINT) AS trips,
  CAST(COUNT(*) AS DOUBLE) / SUM(COUNT(*)) OVER () AS trip_share,
  CAST(SUM(total_amount) AS DOUBLE) AS total_revenue,
  CAST(SUM(total_amount) AS DOUBLE) / COUNT(total_amount) AS avg_total_amount,
  CAST(SUM(trip_distance) AS DOUBLE) / COUNT(trip_distance) AS avg_trip_distance,
  CAST(SUM(dur_sec) AS DOUBLE) / COUNT(dur_sec) / 60.0 AS avg_duration_minutes,
  CAST(SUM(is_airport) AS DOUBLE) / COUNT(*) AS airport_trip_share
FROM flow GROUP BY pu_borough, do_borough
"""
    q["flows_from_states"] = q["region_flows"]
    q["region_flow_counts_merge"] = W(FLOW_JOIN) + """
SELECT pu_borough, do_borough, CAST(COUNT(*) AS BIGINT) AS trips
FROM flow GROUP BY pu_borough, do_borough
"""
    q["airport_flag"] = W(FLOW_JOIN) + """
SELECT CAST(is_airport AS INTEGER) AS is_airport, CAST(COUNT(*) AS BIGINT) AS trips
FROM flow GROUP BY is_airport
"""
    q["airport_flows"] = W(FLOW_JOIN) + """
SELECT pu_zone, do_zone, CAST(COUNT(*) AS BIGINT) AS trips,
  CAST(SUM(Airport_fee) AS DOUBLE) / NULLIF(COUNT(Airport_fee), 0) AS avg_airport_fee,
  CAST(SUM(total_amount) AS DOUBLE) / COUNT(total_amount) AS avg_total_amount,
  CAST(SUM(dur_sec) AS DOUBLE) / COUNT(dur_sec) / 60.0 AS avg_duration_minutes,
  CAST(SUM(trip_distance) AS DOUBLE) / COUNT(trip_distance) AS avg_trip_distance
FROM flow WHERE is_airport = 1 GROUP BY pu_zone, do_zone
"""

    # H. imbalance
    ma = p["imbalance_min_activity"]
    imb = W(*IMB_BASE, _imbalance(ma, False))
    q["zone_imbalance"] = imb + "SELECT * FROM zi"
    q["zone_imbalance_sql"] = q["zone_imbalance"]
    q["zone_imbalance_union"] = W(*IMB_BASE, _imbalance(ma, True)) + "SELECT * FROM zi"
    q["imbalance_top_surplus"] = imb + """SELECT pickup_hour, borough, zone, pickups, dropoffs, net_pickups FROM zi
ORDER BY net_pickups DESC, pickup_hour, borough, zone, pickups, dropoffs, location_id LIMIT 5"""
    q["imbalance_top_deficit"] = imb + """SELECT pickup_hour, borough, zone, pickups, dropoffs, net_pickups FROM zi
ORDER BY net_pickups ASC, pickup_hour, borough, zone, pickups, dropoffs, location_id LIMIT 5"""
    q["imbalance_top_ratio"] = imb + """SELECT pickup_hour, borough, zone, activity, net_pickups, abs_imbalance_ratio FROM zi
ORDER BY abs_imbalance_ratio DESC, pickup_hour, borough, zone, activity, net_pickups, location_id LIMIT 5"""
    q["imbalance_by_hour"] = imb + """SELECT pickup_hour, CAST(SUM(abs(net_pickups)) AS BIGINT) AS total_abs_net_pickups,
  ROUND(SUM(abs_imbalance_ratio) / COUNT(abs_imbalance_ratio), {rd}) AS mean_abs_imbalance_ratio
FROM zi GROUP BY pickup_hour""".format(rd=p["rate_digits"])

    # I. OD halves
    odw = W(*_od(p["od_split_day"], p["od_min_trips"]))
    q["od_halves_change"] = odw + "SELECT * FROM odc"
    q["od_halves_from_buckets"] = q["od_halves_change"]
    q["od_top_growth"] = odw + """SELECT pu_location_id, do_location_id, pickup_hour, trips_h1, trips_h2, trips_change_pct
FROM odc ORDER BY trips_change_pct DESC, pu_location_id, do_location_id, pickup_hour LIMIT 5"""
    q["od_top_decline"] = odw + """SELECT pu_location_id, do_location_id, pickup_hour, trips_h1, trips_h2, trips_change_pct
FROM odc ORDER BY trips_change_pct ASC, pu_location_id, do_location_id, pickup_hour LIMIT 5"""
    return q


def oracle_sql(params: dict) -> dict[str, str]:
    """The oracle text of every key, for the given query parameters."""
    return _sql(params)
