"""Registered queries: key -> (spark, sf_dir) -> DataFrame.

prepared trips and the zone dimension of an sf directory.  Thresholds
are the fixture's (FIXTURES.md section 3, sf0.01 column) and fixed for
every sf.  The matching oracle text is ``tripscope.oracle.ORACLE_SQL[key]``.
Row-returning keys project the typed trip view of ``sources.views``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripscope.operators import (
    accounting, demand, explore, flows, geo, imbalance, od, payments, prepare, quality, revenue, sampling, states,
)
from tripscope.sources import copartitioned, files, rejects
from tripscope.sources.days import DayTable
from tripscope.sources.fixtures import KEY_COLUMNS, KEYS_SCHEMA, RAW_COLUMNS, RAW_TS_FORMAT, damaged, trips_raw, trips_raw_damaged
from tripscope.sources.store import aggregate_version, built_table, fresh_path, prepared_trips, stored_aggregate, trips_and_zones
from tripscope.sources.tables import DRIVER_TABLES, table_path
from tripscope.sources.views import GEO_KEYS, spark_view, spec

Query = Callable[[SparkSession, str], DataFrame]

# Presentation of the measures that are means of per-row floating-point
# values (a ratio, a speed, a great-circle distance): these differ between
# engines in the last ulp (summation order, math library), so they are
# shown at the reference's printed precision - 2 or 4 decimals - or to the
# metre.  Such values are never exact decimal ties, so rounding is
# identical everywhere.  Ratios of exact sums stay unrounded.
RATE_DIGITS = 4
SPEED_DIGITS = 2
DETOUR_DIGITS = 6
STDDEV_DIGITS = 4

# Fixture parameters (FIXTURES.md section 3, sf0.01).
DEMAND_DAYS = (20, 21, 22)
DEMAND_HOURS = (3, 4, 5, 6)
DEMAND_HOUR_RANGE = (3, 6)
REVENUE_MIN_TRIPS = 200
REVENUE_LOW_TRIPS = 100
IMBALANCE_MIN_ACTIVITY = 200
OD_SPLIT_DAY = 15
OD_MIN_TRIPS = 5
SAMPLE_KEY, SAMPLE_EVERY = "l_orderkey", 10
VENDOR = 1
ROUNDTRIP_DAYS = DEMAND_DAYS
# The day whose trips arrive damaged and are prepared anew.
LATE_DAY = 7
# Range of days of the distinct zone counts; rows of the n-row sample.
DISTINCT_DAYS = tuple(range(5, 26))
SAMPLE_ROWS = 1000
# Buckets of the stored half aggregates: a layout, chosen for their size.
HALF_BUCKETS = 16
# Decimals of the columns whose spread is taken.
SPREAD_COLUMNS = {"trip_distance": 2, "total_amount": 4}
# Preparation keeps these years of pick-up and drops the others (the
# reference keeps one; the orders span seven).
PREPARE_YEARS = (1993, 1997)

KEYS = list(KEY_COLUMNS)


def _t(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepared_trips(spark, sf_dir)


def _tz(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return trips_and_zones(spark, sf_dir)


def raw_csv_path(spark: SparkSession, sf_dir: str, with_damage: bool = False) -> str:
    """A CSV copy (with header) of the raw trips, or of the damaged ones."""
    raw = trips_raw_damaged if with_damage else trips_raw
    return built_table(
        spark, sf_dir, "trips_damaged_csv" if with_damage else "trips_raw_csv",
        lambda path: raw(spark, sf_dir).write.csv(path, header=True),
    )


#: Partition column of the damaged CSV copy by year.
CSV_YEAR = "file_year"


def raw_csv_by_year(spark: SparkSession, sf_dir: str) -> str:
    """The damaged raw trips as CSV files in one folder per year of pick-up."""
    year = F.year(F.to_timestamp("tpep_pickup_datetime", RAW_TS_FORMAT))
    return built_table(
        spark, sf_dir, "trips_damaged_csv_by_year",
        lambda path: damaged(trips_raw(spark, sf_dir).withColumn(CSV_YEAR, year)).write.partitionBy(CSV_YEAR).csv(path, header=True),
    )


def state_days(spark: SparkSession, sf_dir: str, state: states.State) -> DayTable:
    """The stored per-day states of the prepared trips."""
    path = built_table(
        spark, sf_dir, f"state-{state.name}-{aggregate_version()}",
        lambda path: states.refresh(DayTable(spark, path), prepared_trips(spark, sf_dir), state),
    )
    return DayTable(spark, path)


def raw_csv_schema():
    """The explicit schema of the raw CSV copies (reference types)."""
    return files.schema_of(RAW_COLUMNS, files.TRIPS_RAW_2024_SCHEMA, files.TRIPS_COORDINATES_SCHEMA, KEYS_SCHEMA)


# ---------------------------------------------------------------- A. ingest

def _ingest() -> dict[str, Query]:
    def csv_explicit(s, d):
        return files.csv_explicit_scan(s, raw_csv_path(s, d, with_damage=True), raw_csv_schema())

    def csv_inferred(s, d):
        return files.csv_inferred_scan(s, raw_csv_path(s, d))

    def prepared(s, d):
        return spark_view(
            prepare.prepare_trips(trips_raw_damaged(s, d), years=PREPARE_YEARS)
            .withColumn("passenger_count", F.expr("try_cast(passenger_count AS int)")),
            spec(coords=True, text_ts=True),
        )

    def roundtrip(s, d):
        back = prepare.partitioned_roundtrip(
            prepare.prepare_trips(trips_raw(s, d)), fresh_path(s, "roundtrip"), days=ROUNDTRIP_DAYS
        )
        return spark_view(back, spec())

    def metrics(s, d):
        return prepare.prepare_metrics(trips_raw_damaged(s, d), prepare.keep_condition(years=PREPARE_YEARS))

    def inventory(s, d):
        return files.source_inventory(s, *[table_path(d, t) for t in DRIVER_TABLES]).select("file_name", "rows")

    def accounted(s, d):
        record = accounting.prepare_accounted(
            trips_raw_damaged(s, d), fresh_path(s, "accounted"), fresh_path(s, "accounted-record"), years=PREPARE_YEARS
        )
        return record.select("raw_rows", "kept_rows", *[f"dropped_{c}" for c in prepare.DROP_CAUSES])

    def rejected(s, d):
        found = rejects.rejected_cells(
            s, raw_csv_by_year(s, d), raw_csv_schema(),
            {"tpep_pickup_datetime": RAW_TS_FORMAT, "tpep_dropoff_datetime": RAW_TS_FORMAT},
        )
        # The copy's file names are random: its folder, the year, stands for them.
        year = F.regexp_extract("file", f"{CSV_YEAR}=([0-9]+)", 1).cast("int")
        return found.groupBy(year.alias("file_year"), "column").agg(F.sum("bad_cells").alias("bad_cells"))

    def late_day(s, d):
        """A day that was delivered without its passenger counts is prepared
        anew; the other days' files stay as they are.  The prepared trips are
        stored by day: their files' rows are written without a shuffle."""
        trips = _t(s, d)
        table = DayTable(s, fresh_path(s, "days"))
        missing = F.when(F.col("pickup_day") == LATE_DAY, F.lit(None)).otherwise(F.col("passenger_count"))
        table.replace(trips.withColumn("passenger_count", missing.cast("int")), dealt=True)
        table.replace(trips.where(F.col("pickup_day") == LATE_DAY), dealt=True)
        late = table.builds()[str(LATE_DAY)]
        return table.read().groupBy("pickup_day").agg(
            F.count(F.lit(1)).alias("trips"), F.sum("passenger_count").alias("passengers"),
            F.sum("total_amount").cast("double").alias("total_revenue"),
            F.bool_and(F.col("_metadata.file_path").contains(late)).alias("rewritten"),
        )

    return {
        "prepare_accounting": accounted,
        "rejected_cells": rejected,
        "prepare_late_day": late_day,
        "csv_explicit_scan": csv_explicit,
        "csv_inferred_scan": csv_inferred,
        "prepare_trips": prepared,
        "partitioned_roundtrip": roundtrip,
        "prepare_metrics": metrics,
        "source_inventory": inventory,
    }


# ----------------------------------------------------------- B. exploration

def _explore() -> dict[str, Query]:
    return {
        "eda_schema": lambda s, d: explore.eda_schema(_t(s, d)),
        "eda_describe": lambda s, d: explore.eda_describe(_t(s, d), ["trip_distance", "total_amount"]).withColumn(
            "stddev", F.round("stddev", STDDEV_DIGITS)
        ),
        "eda_null_counts": lambda s, d: explore.eda_null_counts(
            spark_view(_t(s, d), spec(coords=True, text_ts=True))
        ),
        "eda_top_zones": lambda s, d: explore.eda_top_zones(*_tz(s, d), k=10),
        "exact_spread": lambda s, d: states.spread(_t(s, d), SPREAD_COLUMNS),
        "eda_extremes": lambda s, d: explore.eda_extremes(_t(s, d), "trip_distance", "total_amount"),
    }


# ---------------------------------------------------------------- C. demand

def _demand() -> dict[str, Query]:
    def from_states(s, d):
        sums, zones = (states.of_days(state_days(s, d, x), DEMAND_DAYS) for x in (states.DEMAND, states.ZONES))
        return states.demand_profile(sums, zones, DEMAND_HOURS, k=12)

    def distinct(s, d):
        stored = states.of_days(state_days(s, d, states.ZONES), DISTINCT_DAYS)
        return states.distinct_zones(stored, ["pickup_hour"]).orderBy("pickup_hour")

    return {
        "demand_from_states": from_states,
        "distinct_zones_by_hour": distinct,
        "quality_filter": lambda s, d: spark_view(quality.quality_filter(_t(s, d)), spec()),
        "demand_window": lambda s, d: spark_view(
            quality.demand_window(_t(s, d), DEMAND_DAYS, DEMAND_HOURS), spec()
        ),
        "time_band_profile": lambda s, d: demand.time_band_profile(quality.quality_filter(_t(s, d))),
        "demand_profile_by_date": lambda s, d: demand.demand_profile_by_date(
            _t(s, d), DEMAND_DAYS, DEMAND_HOURS, k=12
        ),
        "demand_profile_by_day": lambda s, d: demand.demand_profile_by_day(_t(s, d), DEMAND_HOUR_RANGE, k=12),
        "demand_profile_null_as_zero": lambda s, d: demand.demand_profile_null_as_zero(
            _t(s, d), DEMAND_HOUR_RANGE, k=12
        ),
    }


# ------------------------------------------------------------------- D. geo

def _geo() -> dict[str, Query]:
    def speed(s, d):
        t = geo.trip_speed(quality.geo_valid_filter(_t(s, d)))
        return spark_view(t, GEO_KEYS + [("duration_hours", "double", ""), ("speed_kmh", "double", "")])

    def metres(df):
        return df.withColumn("haversine_m", F.round(F.col("haversine_km") * 1000, 0))

    def hav(s, d):
        return spark_view(metres(geo.haversine_builtin(_t(s, d))), KEYS + [("haversine_m", "double", "")])

    def hav_udf(s, d):
        return spark_view(metres(geo.haversine_udf(_t(s, d))), KEYS + [("haversine_m", "double", "")])

    def detour(s, d):
        t = metres(geo.speed_metrics(_t(s, d))).withColumn(
            "detour_ratio", F.round("detour_ratio", DETOUR_DIGITS)
        )
        return spark_view(
            t, GEO_KEYS + [("speed_kmh", "double", ""), ("haversine_m", "double", ""), ("detour_ratio", "double", "")]
        )

    return {
        "geo_valid_filter": lambda s, d: spark_view(
            quality.geo_valid_filter(_t(s, d)), spec(coords=True)
        ),
        "trip_speed": speed,
        "haversine_builtin": hav,
        "haversine_udf": hav_udf,
        "detour_ratio": detour,
        "speed_by_hour": lambda s, d: geo.speed_by_hour(geo.speed_metrics(_t(s, d)), digits=SPEED_DIGITS),
        "fastest_trips": lambda s, d: geo.fastest_trips(geo.speed_metrics(_t(s, d)), k=5),
        "slowest_trips": lambda s, d: geo.slowest_trips(geo.speed_metrics(_t(s, d)), k=5),
    }


# --------------------------------------------------------------- E. revenue

def _revenue() -> dict[str, Query]:
    def enrich(s, d):
        t, z = _tz(s, d)
        e = revenue.zone_enrich(t, z, "pu_location_id", "pickup")
        return spark_view(
            e, spec(extra=[("pickup_borough", "string", "VARCHAR"), ("pickup_zone", "string", "VARCHAR")])
        )

    def groups(s, d):
        """One scan of the trips; the other outputs read its rows."""
        return stored_aggregate(s, d, "zone-revenue", lambda: revenue.zone_revenue(*_tz(s, d)))

    def surcharges(s, d):
        t = revenue.total_surcharges(_t(s, d))
        return spark_view(t, KEYS + [("total_surcharges", "double", "DOUBLE")])

    return {
        "fare_quality_filter": lambda s, d: spark_view(quality.fare_quality_filter(_t(s, d)), spec()),
        "distance_bucket": lambda s, d: revenue.distance_bucket(quality.fare_quality_filter(_t(s, d))),
        "zone_enrich": enrich,
        "total_surcharges": surcharges,
        "zone_revenue": groups,
        "zone_top_revenue": lambda s, d: revenue.top_revenue(groups(s, d), k=5),
        "zone_top_per_mile": lambda s, d: revenue.top_per_mile(groups(s, d), min_trips=REVENUE_MIN_TRIPS, k=5),
        "zone_top_per_minute": lambda s, d: revenue.top_per_minute(groups(s, d), min_trips=REVENUE_MIN_TRIPS, k=5),
        "zone_low_support": lambda s, d: revenue.low_support(groups(s, d), max_trips=REVENUE_LOW_TRIPS, k=3),
        "sampled_rows": lambda s, d: spark_view(
            sampling.sample_n(_t(s, d), SAMPLE_ROWS, ["l_orderkey", "l_linenumber"]), spec()
        ),
        "sampled_source": lambda s, d: spark_view(
            revenue.sampled_source(_t(s, d), SAMPLE_KEY, SAMPLE_EVERY), spec()
        ),
    }


# -------------------------------------------------------------- F. payments

def _payments() -> dict[str, Query]:
    def csv_count(s, d):
        raw = files.csv_explicit_scan(s, raw_csv_path(s, d), raw_csv_schema())
        hour = payments.hour_of_text(ts_format=RAW_TS_FORMAT)
        return payments.vendor_hourly_count(raw.withColumnRenamed("VendorID", "vendor_id"), VENDOR, hour)

    return {
        "payment_mix_by_hour": lambda s, d: payments.payment_mix_by_hour(_t(s, d), rate_digits=RATE_DIGITS),
        "payment_mix_from_states": lambda s, d: states.payment_mix(states.of_days(state_days(s, d, states.PAYMENTS))),
        "card_vs_cash_by_hour": lambda s, d: payments.card_vs_cash_by_hour(_t(s, d), rate_digits=RATE_DIGITS),
        "vendor_card_summary": lambda s, d: payments.vendor_card_summary_sql(_t(s, d), rate_digits=RATE_DIGITS),
        "vendor_hourly_count": lambda s, d: payments.vendor_hourly_count(_t(s, d), VENDOR),
        "vendor_hourly_count_csv": csv_count,
    }


# ----------------------------------------------------------------- G. flows

def _flows() -> dict[str, Query]:
    return {
        "region_flows": lambda s, d: flows.region_flows(*_tz(s, d)),
        "flows_from_states": lambda s, d: states.region_flows(states.of_days(state_days(s, d, states.FLOWS)), _tz(s, d)[1]),
        "region_flow_counts_merge": lambda s, d: flows.region_flow_counts_merge(*_tz(s, d)),
        "airport_flag": lambda s, d: flows.airport_flag(*_tz(s, d)),
        "airport_flows": lambda s, d: flows.airport_flows(*_tz(s, d)),
    }


# ------------------------------------------------------------- H. imbalance

def _imbalance() -> dict[str, Query]:
    m = IMBALANCE_MIN_ACTIVITY

    def found(s, d):
        return stored_aggregate(s, d, f"zone-imbalance-{m}", lambda: imbalance.zone_imbalance(*_tz(s, d), min_activity=m))

    return {
        "zone_imbalance": found,
        "zone_imbalance_union": lambda s, d: imbalance.zone_imbalance_union(*_tz(s, d), min_activity=m),
        "zone_imbalance_sql": lambda s, d: imbalance.zone_imbalance_sql(*_tz(s, d), min_activity=m),
        "imbalance_top_surplus": lambda s, d: imbalance.top_surplus(found(s, d), k=5),
        "imbalance_top_deficit": lambda s, d: imbalance.top_deficit(found(s, d), k=5),
        "imbalance_top_ratio": lambda s, d: imbalance.top_ratio(found(s, d), k=5),
        "imbalance_by_hour": lambda s, d: imbalance.by_hour(found(s, d), digits=RATE_DIGITS),
    }


# -------------------------------------------------------------------- I. OD

def _od() -> dict[str, Query]:
    def change(s, d):
        return stored_aggregate(
            s, d, f"od-halves-{OD_SPLIT_DAY}-{OD_MIN_TRIPS}", lambda: od.od_halves_change(_t(s, d), OD_SPLIT_DAY, OD_MIN_TRIPS)
        )

    def from_buckets(s, d):
        halves = (
            copartitioned.bucketed_table(
                lambda half=half: od.half_aggregate(_t(s, d), half, OD_SPLIT_DAY), s, d,
                f"od-half{half}-{OD_SPLIT_DAY}-{aggregate_version()}", od.KEYS, HALF_BUCKETS,
            )
            for half in (1, 2)
        )
        return od.change_of(copartitioned.joined_buckets(*halves, od.KEYS), OD_MIN_TRIPS).select(*od.OUT)

    return {
        "od_halves_change": change,
        "od_halves_from_buckets": from_buckets,
        "od_top_growth": lambda s, d: od.top_change(change(s, d), False, k=5),
        "od_top_decline": lambda s, d: od.top_change(change(s, d), True, k=5),
    }


PARAMS = {
    "demand_days": DEMAND_DAYS,
    "demand_hours": DEMAND_HOURS,
    "demand_hour_range": DEMAND_HOUR_RANGE,
    "revenue_min_trips": REVENUE_MIN_TRIPS,
    "revenue_low_trips": REVENUE_LOW_TRIPS,
    "imbalance_min_activity": IMBALANCE_MIN_ACTIVITY,
    "od_split_day": OD_SPLIT_DAY,
    "od_min_trips": OD_MIN_TRIPS,
    "sample": (SAMPLE_KEY, SAMPLE_EVERY),
    "vendor": VENDOR,
    "rate_digits": RATE_DIGITS,
    "speed_digits": SPEED_DIGITS,
    "detour_digits": DETOUR_DIGITS,
    "stddev_digits": STDDEV_DIGITS,
    "roundtrip_days": ROUNDTRIP_DAYS,
    "prepare_years": PREPARE_YEARS,
    "late_day": LATE_DAY,
    "distinct_days": DISTINCT_DAYS,
    "sample_rows": SAMPLE_ROWS,
    "spread_columns": SPREAD_COLUMNS,
}

# Checked on rows only: type names differ between engines.
ROWS_ONLY = ("eda_schema",)


def oracle_sql() -> dict[str, str]:
    from tripscope.oracle import oracle_sql as build

    return {k: v for k, v in build(PARAMS).items() if k not in ROWS_ONLY}


def queries() -> dict[str, Query]:
    out: dict[str, Query] = {}
    for part in (_ingest, _explore, _demand, _geo, _revenue, _payments, _flows, _imbalance, _od):
        out.update(part())
    return out
