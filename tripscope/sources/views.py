"""Typed projections of the trip table shared by queries and the oracle.

Row-returning keys (filters, enrichments, scans) return these columns
with these types on both engines, so a comparison sees equal schemas:
money as double (from exact DECIMAL), ids as int, keys as bigint.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripscope.sources.fixtures import KEY_COLUMNS

# (column, Spark type, DuckDB type)
TRIP_VIEW = [
    *KEY_COLUMNS,
    ("vendor_id", "int", "INTEGER"),
    ("pickup_ts", "timestamp", "TIMESTAMP"),
    ("dropoff_ts", "timestamp", "TIMESTAMP"),
    ("passenger_count", "int", "INTEGER"),
    ("trip_distance", "double", "DOUBLE"),
    ("pu_location_id", "int", "INTEGER"),
    ("do_location_id", "int", "INTEGER"),
    ("payment_type", "int", "INTEGER"),
    ("fare_amount", "double", "DOUBLE"),
    ("tip_amount", "double", "DOUBLE"),
    ("extra", "double", "DOUBLE"),
    ("tolls_amount", "double", "DOUBLE"),
    ("Airport_fee", "double", "DOUBLE"),
    ("total_amount", "double", "DOUBLE"),
    ("pickup_date", "date", "DATE"),
    ("pickup_day", "int", "INTEGER"),
    ("pickup_hour", "int", "INTEGER"),
    ("duration_minutes", "double", "DOUBLE"),
    ("trip_distance_km", "double", "DOUBLE"),
]
TEXT_TS = [
    ("tpep_pickup_datetime", "string", "VARCHAR"),
    ("tpep_dropoff_datetime", "string", "VARCHAR"),
]
GEO_KEYS = [
    *KEY_COLUMNS,
    ("pickup_ts", "timestamp", "TIMESTAMP"),
    ("dropoff_ts", "timestamp", "TIMESTAMP"),
    ("trip_distance", "double", "DOUBLE"),
]
COORDS = [
    ("pickup_latitude", "double", "DOUBLE"),
    ("pickup_longitude", "double", "DOUBLE"),
    ("dropoff_latitude", "double", "DOUBLE"),
    ("dropoff_longitude", "double", "DOUBLE"),
]


def spec(coords: bool = False, text_ts: bool = False, extra: list[tuple[str, str, str]] | None = None):
    out = list(TRIP_VIEW)
    if text_ts:
        out += TEXT_TS
    if coords:
        out += COORDS
    return out + list(extra or [])


def spark_view(df: DataFrame, columns) -> DataFrame:
    return df.select(*[F.col(c).cast(t).alias(c) for c, t, _ in columns])
