"""Tables stored bucketed and sorted by their join columns.

Two tables with the same number of buckets on the same columns join without moving
a row: the scan of a bucket meets the scan of its counterpart.  The shuffle is paid
once, when they are written.  Their definitions live in the session's catalog, so a
session that finds the files of an earlier one names them again, without rewriting.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from tripscope.sources.store import built_table


def _name(path: str) -> str:
    return f"bucketed_{hashlib.sha1(path.encode()).hexdigest()[:16]}"


def bucketed_table(df_of: Callable[[], DataFrame], spark: SparkSession, sf_dir: str, name: str, by: Sequence[str], buckets: int) -> DataFrame:
    """The table ``name`` of the input's state: ``df_of()`` written in ``buckets``
    buckets of ``by``, each sorted by them.  The number of buckets belongs to the
    stored layout (joined tables must agree on it); choose it for the size."""
    by = list(by)

    def build(path: str) -> None:
        # A bucket's rows in one task each: one file per bucket.
        (
            df_of().repartition(buckets, *by).write.bucketBy(buckets, *by).sortBy(*by)
            .option("path", path).saveAsTable(_name(path))
        )

    path = built_table(spark, sf_dir, f"{name}-b{buckets}", build)
    if not spark.catalog.tableExists(_name(path)):
        columns = spark.read.parquet(path).schema
        ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in columns.fields)
        keys = ", ".join(f"`{c}`" for c in by)
        spark.sql(
            f"CREATE TABLE {_name(path)} ({ddl}) USING parquet CLUSTERED BY ({keys}) SORTED BY ({keys}) "
            f"INTO {buckets} BUCKETS LOCATION '{path}'"
        )
    return spark.table(_name(path))


def joined_buckets(a: DataFrame, b: DataFrame, by: Sequence[str]) -> DataFrame:
    """Sort-merge join of two such tables, bucket by bucket (the hint keeps a
    small table from being broadcast instead)."""
    return a.hint("merge").join(b, list(by), "inner")

