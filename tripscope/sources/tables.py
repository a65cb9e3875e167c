"""Driver tables: one Parquet file per table under an sf directory."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

DRIVER_TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Scan one driver table; naming ``columns`` keeps the ReadSchema narrow."""
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*columns) if columns else df
