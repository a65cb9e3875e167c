"""Trip and zone shapes laid over the driver's TPC-H-like tables.

The layout is the data spec of FIXTURES.md section 3, built here with
DataFrame calls so that Catalyst prunes columns and plans the joins:

- one trip per line item; the order gives the pick-up date, key
  arithmetic gives the second of day and the duration;
- the supplier's nation is the pick-up zone, the customer's nation the
  drop-off zone;
- zones are the nations (nation 24 left out, so inner joins drop trips),
  boroughs their regions.

Money stays DECIMAL so that sums are exact on every engine; the
timestamps are the only source of durations (no stored seconds).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripscope.sources.tables import read_table

# Bump when the layout below changes: prepared tables are keyed by it.
FIXTURE_VERSION = 2
#: Driver tables the layout reads.
INPUT_TABLES = ("region", "nation", "customer", "supplier", "orders", "lineitem")

# Fixed values of the data spec (FIXTURES.md section 3): key multipliers,
# moduli, offsets and the renamed zones.
SECOND_OF_DAY_WEIGHTS = (7919, 104729, 3571)  # l_orderkey, l_partkey, l_linenumber
SECONDS_PER_DAY = 86400
DURATION_WEIGHTS = (37, 11)  # l_partkey, l_suppkey
DURATION_MODULUS = 5400
DURATION_OFFSET = 60
LEFT_OUT_NATION = 24
EWR_NATION = 1
ZONE_RENAMES = {
    1: "Newark Airport",
    7: "JFK Airport",
    12: "LaGuardia Airport",
    15: "NATION_20",
}


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The zone dimension: LocationID int, Borough, Zone (24 rows)."""
    nation = read_table(spark, sf_dir, "nation", "n_nationkey", "n_name", "n_regionkey")
    region = read_table(spark, sf_dir, "region", "r_regionkey", "r_name")
    zone = F.col("n_name")
    for key, name in ZONE_RENAMES.items():
        zone = F.when(F.col("n_nationkey") == key, F.lit(name)).otherwise(zone)
    return (
        nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .where(F.col("n_nationkey") != LEFT_OUT_NATION)
        .select(
            F.col("n_nationkey").cast("int").alias("LocationID"),
            F.when(F.col("n_nationkey") == EWR_NATION, F.lit("EWR"))
            .otherwise(F.col("r_name"))
            .alias("Borough"),
            zone.alias("Zone"),
        )
    )


def _seconds(ts: Column, seconds: Column) -> Column:
    return F.timestamp_add("SECOND", seconds, ts)


def _dec(c: Column, scale: str = "decimal(4,2)") -> Column:
    return c.cast(scale)


def trip_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per trip with the driver's columns that it is made of.

    Joins: orders with customer first (the smaller pair), then line items,
    then suppliers.  Sizes are left to adaptive execution: at the driver's
    scale the dimensions broadcast, at cluster scale they sort-merge.
    """
    li = read_table(
        spark, sf_dir, "lineitem",
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
    )
    orders = read_table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderdate")
    customer = read_table(spark, sf_dir, "customer", "c_custkey", "c_nationkey")
    supplier = read_table(spark, sf_dir, "supplier", "s_suppkey", "s_nationkey")

    oc = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).drop("c_custkey")
    return (
        li.join(oc, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .drop("o_orderkey", "s_suppkey")
    )


def second_of_day() -> Column:
    w_ok, w_pk, w_ln = SECOND_OF_DAY_WEIGHTS
    return (F.col("l_orderkey") * w_ok + F.col("l_partkey") * w_pk + F.col("l_linenumber") * w_ln) % SECONDS_PER_DAY


def pickup_time() -> Column:
    """The pick-up time of a row of ``trip_rows``."""
    return _seconds(F.col("o_orderdate"), second_of_day())


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One trip per line item, in the reference's enriched column names."""
    return trips_of(trip_rows(spark, sf_dir))


def trips_of(rows: DataFrame, *carried: str) -> DataFrame:
    """The trips of ``trip_rows``; ``carried`` columns stay at the end."""
    d_pk, d_sk = DURATION_WEIGHTS
    dur_sec = (F.col("l_partkey") * d_pk + F.col("l_suppkey") * d_sk) % DURATION_MODULUS - DURATION_OFFSET
    fare = _dec(
        F.when(
            (F.col("l_linenumber") == 7) & (F.col("l_returnflag") == "R"),
            -F.col("l_extendedprice"),
        ).otherwise(F.col("l_extendedprice")),
        "decimal(12,2)",
    )
    tip = fare * _dec(F.col("l_discount"))
    extra = F.when(F.col("l_tax") == 0, F.lit(None)).otherwise(fare * _dec(F.col("l_tax")))
    payment = (
        F.when(F.col("l_returnflag") == "A", 1)
        .when(F.col("l_returnflag") == "N", 2)
        .when(F.col("l_linestatus") == "F", 1)
        .otherwise(3)
    )
    airport_fee = (
        F.when(F.col("l_suppkey") % 4 == 0, _dec(F.lit(1.75)))
        .when(F.col("l_suppkey") % 4 == 1, F.lit(None).cast("decimal(4,2)"))
        .otherwise(_dec(F.lit(0)))
    )

    def coord(base: float, key: str, modulus: int, divisor: int) -> Column:
        return F.lit(base) + (F.col(key) % modulus).cast("double") / divisor

    return rows.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        (1 + F.col("l_suppkey") % 3).cast("int").alias("vendor_id"),
        pickup_time().alias("pickup_ts"),
        _seconds(F.col("o_orderdate"), second_of_day() + dur_sec).alias("dropoff_ts"),
        F.nullif(F.col("l_partkey") % 7, F.lit(0)).cast("int").alias("passenger_count"),
        ((F.col("l_quantity") - 1) / 4).alias("trip_distance"),
        F.col("s_nationkey").cast("int").alias("pu_location_id"),
        F.col("c_nationkey").cast("int").alias("do_location_id"),
        payment.cast("int").alias("payment_type"),
        fare.alias("fare_amount"),
        tip.alias("tip_amount"),
        extra.alias("extra"),
        _dec(F.col("l_linenumber")).alias("tolls_amount"),
        airport_fee.alias("Airport_fee"),
        (fare + tip + F.coalesce(extra, F.lit(0))).alias("total_amount"),
        coord(40.5, "l_suppkey", 50, 100).alias("pickup_latitude"),
        coord(-74.25, "l_suppkey", 37, 50).alias("pickup_longitude"),
        coord(40.5, "o_custkey", 50, 100).alias("dropoff_latitude"),
        coord(-74.25, "o_custkey", 37, 50).alias("dropoff_longitude"),
        *carried,
    )


# The raw trip file's timestamp text (FIXTURES.md 1.1).
RAW_TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSS"

# Raw-file names of the renamed columns (raw -> prepared).
RAW_RENAMES = {
    "VendorID": "vendor_id",
    "PULocationID": "pu_location_id",
    "DOLocationID": "do_location_id",
}


def text_timestamps(df: DataFrame, ts_format: str = RAW_TS_FORMAT) -> DataFrame:
    """Add the raw file's text timestamps, formatted from the typed ones."""
    return df.withColumns(
        {
            "tpep_pickup_datetime": F.date_format("pickup_ts", ts_format),
            "tpep_dropoff_datetime": F.date_format("dropoff_ts", ts_format),
        }
    )


# Names and types of the keys that ride along (column, Spark, DuckDB).
KEY_COLUMNS = (("l_orderkey", "bigint", "BIGINT"), ("l_linenumber", "int", "INTEGER"), ("l_partkey", "bigint", "BIGINT"))

# Damaged cells of a raw file, by key: an unreadable pick-up time, a missing
# drop-off time, a passenger count that is no number.
DAMAGED_PICKUP, DAMAGED_DROPOFF, DAMAGED_PASSENGERS = ("l_orderkey", 97), ("l_partkey", 89), ("l_partkey", 83)
BAD_TIME, BAD_COUNT = "not a time", "two"

# Column order of the raw trips (and of their CSV copy).
RAW_COLUMNS = (
    "l_orderkey", "l_linenumber", "l_partkey", "VendorID", "tpep_pickup_datetime",
    "tpep_dropoff_datetime", "passenger_count", "trip_distance", "PULocationID", "DOLocationID",
    "payment_type", "fare_amount", "tip_amount", "extra", "tolls_amount", "Airport_fee",
    "total_amount", "pickup_latitude", "pickup_longitude", "dropoff_latitude", "dropoff_longitude",
)


def trips_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trips as a raw file holds them: text timestamps, raw id names
    (columns in ``RAW_COLUMNS`` order).

    This is the input of preparation; the coordinates ride along so that
    the geo jobs can run on the prepared table.
    """
    t = trips(spark, sf_dir)
    back = {v: k for k, v in RAW_RENAMES.items()}
    cols = []
    for name in t.columns:
        if name == "pickup_ts":
            cols.append(F.date_format("pickup_ts", RAW_TS_FORMAT).alias("tpep_pickup_datetime"))
        elif name == "dropoff_ts":
            cols.append(F.date_format("dropoff_ts", RAW_TS_FORMAT).alias("tpep_dropoff_datetime"))
        else:
            cols.append(F.col(name).alias(back.get(name, name)))
    raw = t.select(*cols)
    assert tuple(raw.columns) == RAW_COLUMNS
    return raw


# Types of the line-item keys in a raw file (they are no taxi columns).
KEYS_SCHEMA = T.StructType([T.StructField(c, T.LongType()) for c, _, _ in KEY_COLUMNS])


def trips_raw_damaged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return damaged(trips_raw(spark, sf_dir))


def damaged(raw: DataFrame) -> DataFrame:
    """Raw trips with the damaged cells; passenger counts are text, as a file
    holds them."""
    hit = lambda rule: F.col(rule[0]) % rule[1] == 0
    return raw.withColumns(
        {
            "tpep_pickup_datetime": F.when(hit(DAMAGED_PICKUP), F.lit(BAD_TIME)).otherwise(F.col("tpep_pickup_datetime")),
            "tpep_dropoff_datetime": F.when(~hit(DAMAGED_DROPOFF), F.col("tpep_dropoff_datetime")),
            "passenger_count": F.when(hit(DAMAGED_PASSENGERS), F.lit(BAD_COUNT)).otherwise(F.col("passenger_count").cast("string")),
        }
    )
