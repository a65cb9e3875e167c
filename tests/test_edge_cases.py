"""Edge fixtures of FIXTURES.md section 4, built in memory."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tests.conftest import trip
from tripscope.functions.columns import distance_bucket, time_band
from tripscope.operators import geo, imbalance, od, quality, revenue
from tripscope.operators.prepare import keep_condition, prepare_metrics, prepare_trips
from tripscope.sources import files

T0 = dt.datetime(2024, 1, 3, 8, 0, 0)


def test_full_outer_keeps_null_keys_apart(spark):
    # NULL locations on both sides never match; only the counts are filled.
    t = spark.createDataFrame(
        [(1, None, 7)] * 5 + [(1, 8, None)] * 4, "pickup_hour int, pu_location_id int, do_location_id int"
    )
    rows = sorted(
        imbalance._counts_full_outer(t, "pickup_hour").collect(),
        key=lambda r: (r.pickup_hour, r.location_id or -1, r.pickups),
    )
    nulls = [tuple(r) for r in rows if r.location_id is None]
    assert sorted(nulls) == [(1, None, 0, 4), (1, None, 5, 0)]


def test_distance_bucket_edges(spark):
    df = spark.createDataFrame([(d,) for d in (0.99, 1.0, 2.99, 3.0, 9.99, 10.0)], "trip_distance double")
    got = [r[0] for r in df.select(distance_bucket("trip_distance")).collect()]
    assert got == ["very_short", "short", "short", "medium", "medium", "long"]


def test_time_band_edges(spark):
    hours = (0, 5, 6, 11, 12, 16, 17, 21, 22, 23)
    df = spark.createDataFrame([(h,) for h in hours], "pickup_hour int")
    got = [r[0] for r in df.select(time_band("pickup_hour")).collect()]
    assert got == ["Night", "Night", "Morning", "Morning", "Afternoon", "Afternoon",
                   "Evening", "Evening", "Late", "Late"]


def test_dropoff_only_zone_and_activity_threshold(make_trips, zones_small):
    # zone 4 at 08h: 30 drop-offs, no pick-ups -> ratio -1; zone 3: 29 -> dropped.
    rows = [trip(i, T0, pu=1, do=4) for i in range(30)] + [trip(100 + i, T0, pu=2, do=3) for i in range(29)]
    out = imbalance.zone_imbalance(make_trips(rows), zones_small, min_activity=30)
    by_zone = {r.location_id: r for r in out.collect()}
    assert by_zone[4].pickups == 0 and by_zone[4].dropoffs == 30
    assert by_zone[4].imbalance_ratio == -1.0 and by_zone[4].abs_imbalance_ratio == 1.0
    assert 3 not in by_zone and 2 not in by_zone  # 29 activity each
    assert by_zone[1].imbalance_ratio == 1.0


def test_zero_fare_and_sub_second_trip(make_trips):
    rows = [
        trip(1, T0, fare="0.00", tip="0.0000"),
        trip(2, T0, seconds=0),
        trip(3, T0),
    ]
    kept = quality.fare_quality_filter(make_trips(rows))
    assert [r.l_orderkey for r in kept.collect()] == [3]
    # speed of a zero-length trip is NULL, never an ANSI division error
    sp = geo.trip_speed(make_trips(rows)).where(F.col("l_orderkey") == 2).collect()[0]
    assert sp.speed_kmh is None


def test_od_pair_only_in_first_half_vanishes(make_trips):
    first = dt.datetime(2024, 1, 5, 9, 0, 0)
    second = dt.datetime(2024, 1, 20, 9, 0, 0)
    rows = [trip(i, first, pu=1, do=2) for i in range(3)]  # only first half
    rows += [trip(10 + i, first, pu=3, do=4) for i in range(2)] + [trip(20, second, pu=3, do=4)]
    for method in ("one_pass", "join"):
        out = od.od_halves_change(make_trips(rows), split_day=15, min_trips=2, method=method).collect()
        assert [(r.pu_location_id, r.do_location_id, r.trips_h1, r.trips_h2) for r in out] == [(3, 4, 2, 1)]
        assert out[0].trips_change_pct == -50.0


def test_top_k_orders_by_raw_speed(spark):
    # 100.004 and 100.001 both round to 100.0: the raw value decides.
    df = spark.createDataFrame(
        [(T0, T0, 1.0, 100.001), (T0, T0, 2.0, 100.004), (T0, T0, 3.0, 50.0)],
        "pickup_ts timestamp, dropoff_ts timestamp, trip_distance double, speed_kmh double",
    )
    top = geo.fastest_trips(df, k=1, digits=2).collect()[0]
    assert top.dist_miles == 2.0 and top.speed_kmh == 100.0


def test_csv_explicit_schema_nulls_bad_cells(spark, tmp_path):
    path = tmp_path / "raw.csv"
    path.write_text(
        "VendorID,tpep_pickup_datetime,passenger_count,trip_distance\n"
        "1,bad,1.0,\n"
        "2,2024-01-01T00:57:55.000,3,1.5\n"
    )
    schema = "VendorID int, tpep_pickup_datetime timestamp, passenger_count int, trip_distance double"
    rows = files.csv_explicit_scan(spark, str(path), schema).collect()
    assert rows[0].tpep_pickup_datetime is None and rows[0].passenger_count is None
    assert rows[0].trip_distance is None
    assert rows[1].passenger_count == 3
    inferred = files.csv_inferred_scan(spark, str(path))
    types = dict(inferred.dtypes)
    assert types["tpep_pickup_datetime"] == "string"  # one bad value keeps it text
    assert types["passenger_count"] == "double"


def test_prepare_drops_unparsable_and_counts_in_one_pass(spark):
    raw = spark.createDataFrame(
        [
            (1, "2024-01-01T00:57:55.000", "2024-01-01T01:07:55.000", 2.0),
            (2, "not a time", "2024-01-01T01:07:55.000", 2.0),
            (3, "2023-12-31T23:59:00.000", "2024-01-01T00:09:00.000", 1.0),
        ],
        "VendorID int, tpep_pickup_datetime string, tpep_dropoff_datetime string, trip_distance double",
    )
    kept = prepare_trips(raw, years=2024).collect()
    assert [r.vendor_id for r in kept] == [1]
    assert kept[0].duration_minutes == 10.0 and kept[0].pickup_day == 1 and kept[0].pickup_hour == 0
    m = prepare_metrics(raw, keep_condition(years=2024)).collect()[0]
    assert (m.raw_rows, m.processed_rows, m.dropped_rows) == (3, 1, 2)


def test_zone_enrich_inner_join_drops_unknown(make_trips, zones_small):
    rows = [trip(1, T0, pu=1), trip(2, T0, pu=99)]
    out = revenue.zone_enrich(make_trips(rows), zones_small).collect()
    assert [(r.l_orderkey, r.pickup_zone) for r in out] == [(1, "Midtown")]


def test_rounded_ratio_is_exact_half_away_from_zero(spark):
    df = spark.createDataFrame([(1, 32), (-1, 32), (1, 3), (0, 5), (3, 0)], "n long, d long")
    got = [r[0] for r in df.select(imbalance.rounded_ratio(F.col("n"), F.col("d"), 4)).collect()]
    assert got == [0.0313, -0.0313, 0.3333, 0.0, 0.0]


def test_haversine_null_input_gives_null_in_both_forms(spark):
    df = spark.createDataFrame(
        [(40.7, -74.0, 40.8, -73.9), (None, -74.0, 40.8, -73.9)],
        "pickup_latitude double, pickup_longitude double, dropoff_latitude double, dropoff_longitude double",
    )
    for form in (geo.haversine_builtin, geo.haversine_udf):
        got = [r[0] for r in form(df).select("haversine_km").collect()]
        assert got[1] is None and abs(got[0] - 13.95) < 0.01
