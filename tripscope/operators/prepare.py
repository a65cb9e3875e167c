"""Ingest and preparation: raw trips -> typed, enriched, day-partitioned.

``prepare_trips`` is lazy; ``write_partitioned`` and
``partitioned_roundtrip`` are the only operators here with an action
(they write).  ``prepare_metrics`` counts raw, kept and dropped rows in
one aggregate over one scan, where the reference scanned three times.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripscope.functions.columns import KM_PER_MILE, duration_seconds
from tripscope.sources.fixtures import RAW_RENAMES, RAW_TS_FORMAT

Years = int | tuple[int, int] | None


def _parsed(col: str, ts_format: str) -> Column:
    # try_ form: an unparsable cell becomes NULL instead of failing the job
    # under ANSI mode; the NULL then drops the row below.
    return F.try_to_timestamp(F.col(col), F.lit(ts_format))


def _year_test(ts: Column, years: Years) -> Column:
    if years is None:
        return F.lit(True)
    if isinstance(years, int):
        return F.year(ts) == years
    lo, hi = years
    return F.year(ts).between(lo, hi)


def keep_condition(
    ts_format: str = RAW_TS_FORMAT,
    years: Years = None,
    pickup_col: str = "tpep_pickup_datetime",
    dropoff_col: str = "tpep_dropoff_datetime",
) -> Column:
    """The rows preparation keeps, stated on the raw columns."""
    pu = _parsed(pickup_col, ts_format)
    do = _parsed(dropoff_col, ts_format)
    return pu.isNotNull() & do.isNotNull() & _year_test(pu, years)


def prepare_trips(
    raw: DataFrame,
    ts_format: str = RAW_TS_FORMAT,
    years: Years = None,
    pickup_col: str = "tpep_pickup_datetime",
    dropoff_col: str = "tpep_dropoff_datetime",
) -> DataFrame:
    """Parse both timestamps, rename the ids, derive date/day/hour,
    duration in minutes and distance in km; drop rows whose timestamps do
    not parse and rows outside ``years``.

    The text timestamps stay as they are (the reference keeps them).
    """
    parsed = parse_trips(raw, ts_format, pickup_col, dropoff_col)
    return enrich_trips(parsed.where(drop_cause(years).isNull()))


def parse_trips(
    raw: DataFrame,
    ts_format: str = RAW_TS_FORMAT,
    pickup_col: str = "tpep_pickup_datetime",
    dropoff_col: str = "tpep_dropoff_datetime",
) -> DataFrame:
    """The first step of preparation: ids renamed, both timestamps typed
    (NULL where they do not parse); no row is dropped."""
    present = {k: v for k, v in RAW_RENAMES.items() if k in raw.columns}
    return raw.withColumnsRenamed(present).withColumns(
        {
            "pickup_ts": _parsed(pickup_col, ts_format),
            "dropoff_ts": _parsed(dropoff_col, ts_format),
        }
    )


# Why preparation drops a row, in the order in which the tests apply.
DROP_CAUSES = ("pickup_time", "dropoff_time", "year")


def drop_cause(years: Years = None) -> Column:
    """The first cause that applies to a parsed row; NULL for a row to keep."""
    tests = (F.col("pickup_ts").isNull(), F.col("dropoff_ts").isNull(), ~_year_test(F.col("pickup_ts"), years))
    cause = F.when(tests[0], DROP_CAUSES[0])
    for test, name in zip(tests[1:], DROP_CAUSES[1:], strict=True):
        cause = cause.when(test, name)
    return cause


def enrich_trips(df: DataFrame) -> DataFrame:
    """The columns preparation derives from typed ``pickup_ts`` and
    ``dropoff_ts``: date, hour, duration in whole seconds and in minutes, km,
    day of month."""
    return df.withColumns(
        {
            "pickup_date": F.to_date("pickup_ts"),
            "pickup_hour": F.hour("pickup_ts"),
            "duration_seconds": duration_seconds(),
            "duration_minutes": duration_seconds() / F.lit(60.0),
            "trip_distance_km": F.col("trip_distance") * F.lit(KM_PER_MILE),
            "pickup_day": F.dayofmonth("pickup_ts"),
        }
    )


def prepare_metrics(raw: DataFrame, keep: Column | None = None, **labels: str) -> DataFrame:
    """raw_rows, processed_rows, dropped_rows in one pass over ``raw``;
    ``labels`` (e.g. dataset, partition_column, output_path) are added as
    literal columns, so the one-row result is the whole metrics record
    (``to_json(struct(*))`` or ``write.json`` to store it)."""
    keep = keep if keep is not None else keep_condition()
    counted = raw.agg(
        F.count(F.lit(1)).alias("raw_rows"),
        F.count_if(keep).alias("processed_rows"),
    )
    return counted.select(
        *[F.lit(v).alias(k) for k, v in labels.items()],
        "raw_rows",
        "processed_rows",
        (F.col("raw_rows") - F.col("processed_rows")).alias("dropped_rows"),
    )


def write_partitioned(
    df: DataFrame,
    path: str,
    by: Sequence[str] = ("pickup_day",),
    files_per_value: int | None = None,
    dealt: bool = False,
) -> None:
    """Overwrite ``path`` with ``df`` partitioned by ``by``.

    Default: a ``rebalance`` on the partition columns - AQE cuts the
    shuffle into advisory-sized partitions, splitting a skewed value (one
    day holding a third of the rows) over several tasks and merging small
    ones, so each value gets files of about the advisory size instead of
    one small file per input task and value.

    ``files_per_value=k`` instead fixes k files per value: rows are hashed
    on the partition columns plus a deterministic row hash (not ``rand``,
    so a stage retried after an executor loss sends rows to the same place).

    ``dealt``: the rows of ``df`` have been dealt out by ``by`` already, before
    its columns were made; they are written where they are.
    """
    by = list(by)
    if dealt:
        pass
    elif files_per_value:
        salt = F.pmod(F.xxhash64(*df.columns), F.lit(files_per_value))
        df = df.repartition(*[F.col(c) for c in by], salt)
    else:
        df = df.hint("rebalance", *by)
    df.write.mode("overwrite").partitionBy(*by).parquet(path)


def read_days(
    df: DataFrame, days: Iterable[int] | None = None, day_col: str = "pickup_day"
) -> DataFrame:
    """Keep the given days; on a table partitioned by ``day_col`` this is
    a partition filter, so only those directories are listed and read."""
    if days is None:
        return df
    return df.where(F.col(day_col).isin(list(days)))


def partitioned_roundtrip(
    df: DataFrame,
    path: str,
    by: Sequence[str] = ("pickup_day",),
    days: Iterable[int] | None = None,
    files_per_value: int | None = None,
) -> DataFrame:
    """Write ``df`` partitioned, read it back, keep ``days``.  ``path`` should
    be the call's own: frames over an overwritten path lose their files."""
    write_partitioned(df, path, by, files_per_value)
    back = df.sparkSession.read.parquet(path)
    return read_days(back, days, by[0])
