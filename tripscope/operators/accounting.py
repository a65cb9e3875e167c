"""Preparation that accounts for itself.

``prepare_accounted`` writes the prepared table and learns from the write
itself how many raw rows there were, how many were kept and how many were
dropped for each cause: an ``Observation`` on the way to the writer, so the
raw files are scanned once (the reference scanned them three times).

Observed counts are accumulators: a task that runs again after an executor was
lost can count twice.  The kept rows are therefore compared with the row counts
in the written files' footers; if they differ, one aggregate over the raw rows
counts again, and the record says so.
"""

from __future__ import annotations

from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tripscope.operators.prepare import DROP_CAUSES, Years, drop_cause, enrich_trips, parse_trips, write_partitioned
from tripscope.sources.fixtures import RAW_TS_FORMAT


def _counts(years: Years) -> list[Column]:
    cause = drop_cause(years)
    return [
        F.count(F.lit(1)).alias("raw_rows"),
        F.count_if(cause.isNull()).alias("kept_rows"),
        *[F.count_if(cause == c).alias(f"dropped_{c}") for c in DROP_CAUSES],
    ]


def drop_counts(raw: DataFrame, years: Years = None, ts_format: str = RAW_TS_FORMAT) -> DataFrame:
    """raw_rows, kept_rows and dropped_<cause> in one aggregate, writing nothing."""
    return parse_trips(raw, ts_format).agg(*_counts(years))


def prepare_accounted(
    raw: DataFrame,
    path: str,
    record_path: str,
    years: Years = None,
    by: Sequence[str] = ("pickup_day",),
    ts_format: str = RAW_TS_FORMAT,
    **labels: str,
) -> DataFrame:
    """Write the prepared ``raw`` to ``path`` (partitioned by ``by``) and the
    record of the preparation to ``record_path`` as one line of JSON; returns
    the record: ``labels``, raw_rows, kept_rows, dropped_<cause>, counted_by
    (``write``; ``recount`` after a repeated task, or for a source planned away as
    empty)."""
    spark = raw.sparkSession
    seen = Observation()
    parsed = parse_trips(raw, ts_format).observe(seen, *_counts(years))
    prepared = enrich_trips(parsed.where(drop_cause(years).isNull()))
    write_partitioned(prepared, path, by)
    try:
        counts, counted_by = dict(seen.get), "write"
    except Py4JJavaError:  # a source known to be empty is planned away, and the observation with it
        counts, counted_by = {"kept_rows": None}, "write"
    stored = spark.read.schema(prepared.schema).parquet(path).count()  # footers only
    if counts["kept_rows"] != stored:
        counts, counted_by = drop_counts(raw, years, ts_format).first().asDict(), "recount"
    record = {**labels, **counts, "counted_by": counted_by}
    fields = ", ".join(f"`{k}` {'string' if isinstance(v, str) else 'bigint'}" for k, v in record.items())
    spark.createDataFrame([tuple(record.values())], fields).coalesce(1).write.mode("overwrite").json(record_path)
    return spark.read.schema(fields).json(record_path)
