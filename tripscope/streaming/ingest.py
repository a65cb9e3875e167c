"""Incremental preparation: the preparation job as a Structured Streaming
query.

Raw trip files landing in a folder are read with the explicit schema
(a streaming file source cannot infer), prepared by the same lazy
``prepare_trips`` as the batch job, and appended to the day-partitioned
Parquet table.  The checkpoint (in the shared folder) records which files
each micro-batch took, so a restarted or failed run neither loses nor
duplicates a file: the file sink commits each batch atomically through
its ``_spark_metadata`` log.  No state is kept - preparation is row-wise.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tripscope.operators.prepare import Years, prepare_trips
from tripscope.sources.fixtures import RAW_TS_FORMAT


def raw_trip_stream(
    spark: SparkSession, folder: str, schema: StructType | str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """A stream of the raw CSV files (with header) arriving under ``folder``."""
    reader = spark.readStream.schema(schema).option("header", True).option("mode", "PERMISSIVE")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.csv(folder)


def start_prepare_stream(
    spark: SparkSession,
    folder: str,
    schema: StructType | str,
    out_path: str,
    checkpoint: str,
    by: Sequence[str] = ("pickup_day",),
    ts_format: str = RAW_TS_FORMAT,
    years: Years = None,
    available_now: bool = True,
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Start the incremental preparation of ``folder`` into ``out_path``.

    ``available_now`` processes every file present at start, in as many
    micro-batches as ``max_files_per_trigger`` allows, then stops (a
    scheduled catch-up run); otherwise the query keeps running and picks
    up new files as they land.
    """
    prepared = prepare_trips(raw_trip_stream(spark, folder, schema, max_files_per_trigger), ts_format, years)
    writer = (
        prepared.writeStream.format("parquet")
        .option("path", out_path)
        .option("checkpointLocation", checkpoint)
        .partitionBy(*by)
        .outputMode("append")
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
