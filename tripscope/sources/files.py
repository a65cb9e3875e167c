"""CSV scans and the file inventory of a source.

The explicit-schema scan is the one to use at scale: inference costs a
full extra pass over the files before the job starts (``samplingRatio``
bounds it), and a column that does not fully parse is typed as text.
With a schema, a malformed cell becomes NULL (PERMISSIVE mode).
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The raw 2024 trip file's 19-column schema (fixed values of the reference).
TRIPS_RAW_2024_SCHEMA = T.StructType(
    [
        T.StructField("VendorID", T.IntegerType()),
        T.StructField("tpep_pickup_datetime", T.StringType()),
        T.StructField("tpep_dropoff_datetime", T.StringType()),
        T.StructField("passenger_count", T.IntegerType()),
        T.StructField("trip_distance", T.DoubleType()),
        T.StructField("RatecodeID", T.IntegerType()),
        T.StructField("store_and_fwd_flag", T.StringType()),
        T.StructField("PULocationID", T.IntegerType()),
        T.StructField("DOLocationID", T.IntegerType()),
        T.StructField("payment_type", T.IntegerType()),
        T.StructField("fare_amount", T.DoubleType()),
        T.StructField("extra", T.DoubleType()),
        T.StructField("mta_tax", T.DoubleType()),
        T.StructField("tip_amount", T.DoubleType()),
        T.StructField("tolls_amount", T.DoubleType()),
        T.StructField("improvement_surcharge", T.DoubleType()),
        T.StructField("total_amount", T.DoubleType()),
        T.StructField("congestion_surcharge", T.DoubleType()),
        T.StructField("Airport_fee", T.DoubleType()),
    ]
)


# The coordinate file of the speed and detour job: its own declared schema
# (fixed values of the reference's coordinate columns), never inferred.
TRIPS_COORDINATES_SCHEMA = T.StructType(
    [
        T.StructField(f"{side}_{axis}", T.DoubleType())
        for side in ("pickup", "dropoff")
        for axis in ("latitude", "longitude")
    ]
)


def csv_explicit_scan(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """CSV with a header under ``schema`` (columns by position); a cell
    that does not parse under its type becomes NULL."""
    return spark.read.csv(path, header=True, schema=schema, mode="PERMISSIVE")


def csv_inferred_scan(spark: SparkSession, path: str, sampling_ratio: float = 1.0) -> DataFrame:
    """CSV with a header and types inferred by a pass over (a sample of)
    the files."""
    return spark.read.csv(path, header=True, inferSchema=True, samplingRatio=sampling_ratio)


def schema_of(columns: Iterable[str], *declared: T.StructType) -> T.StructType:
    """The fields of ``columns``, in their order, from the first declared
    schema that has them; a column that none declares is an error."""
    known = {f.name: f for schema in reversed(declared) for f in schema.fields}
    return T.StructType([known[c] for c in columns])


def source_inventory(spark: SparkSession, *paths: str, fmt: str = "parquet") -> DataFrame:
    """file_name, file_size, rows of every file under ``paths``.

    The counts come from one distributed scan of the file metadata
    columns; for Parquet only the footers are read.
    """
    files = [
        spark.read.format(fmt).load(p).select(
            F.col("_metadata.file_name").alias("file_name"), F.col("_metadata.file_size").alias("file_size")
        )
        for p in paths
    ]
    return (
        reduce(DataFrame.unionByName, files)
        .groupBy("file_name", "file_size")
        .agg(F.count(F.lit(1)).alias("rows"))
        .orderBy("file_name")
    )
