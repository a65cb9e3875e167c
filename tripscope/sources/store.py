"""Tables derived from the driver tables: written once per state of the input.

This is the reference's own model (prepare the raw file into Parquet
partitioned by day of month, then query the Parquet), with the tables kept
in the shared folder the session names (``tripscope.session.shared_dir``).

A table belongs to a state of its input: the paths, sizes and modification
times of all input files, the session's time zone (hours are stored) and the
code that lays it out.  Other input, other table: a changed file is never
answered from an old table, not even within a session.  Each build writes to
a folder of its own and is published, by a pointer in a folder of its own,
after its job has committed; of builds made at the same time by several
applications all are whole and alike, and the first by name is read.
"""

from __future__ import annotations

import functools
import hashlib
import importlib.util
import threading
import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripscope.operators.prepare import enrich_trips, prepare_trips, write_partitioned
from tripscope.session import shared_dir
from tripscope.sources.fixtures import (
    FIXTURE_VERSION, INPUT_TABLES, pickup_time, text_timestamps, trip_rows, trips_of, trips_raw, zones,
)
from tripscope.sources.tables import table_path

PARTITION_COLUMN = "pickup_day"
#: The same day, as the rows that become trips carry it.
DEALT_DAY = "dealt_day"
LAYOUT_MODULES = ("tripscope.sources.fixtures", "tripscope.operators.prepare", "tripscope.sources.store")
#: Modules that define what stored aggregates and states hold.
AGGREGATE_MODULES = tuple(
    f"tripscope.{m}" for m in (
        "functions.columns", "functions.distinct", "functions.exact", "operators.flows", "operators.imbalance", "operators.od",
        "operators.payments", "operators.quality", "operators.revenue", "operators.states", "sources.days",
    )
)


def _sources_digest(modules: tuple[str, ...]) -> str:
    """Digest of modules' text (read by their loaders: the package may be a zip)."""
    h = hashlib.sha1(str(FIXTURE_VERSION).encode())
    for name in modules:
        h.update(importlib.util.find_spec(name).loader.get_source(name).encode())
    return h.hexdigest()[:10]


@functools.cache
def _layout_version() -> str:
    """Fixture version plus a digest of the code that lays the stored tables out."""
    return f"v{FIXTURE_VERSION}-{_sources_digest(LAYOUT_MODULES)}"


@functools.cache
def aggregate_version() -> str:
    return _sources_digest(AGGREGATE_MODULES)


def input_digest(spark: SparkSession, sf_dir: str) -> str:
    """Digest of the input files' paths, sizes and modification times, listed by
    the file system that Spark reads them with; no job, contents are not read."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    found = []
    for t in INPUT_TABLES:
        path = jvm.org.apache.hadoop.fs.Path(table_path(sf_dir, t))
        files = path.getFileSystem(conf).listFiles(path, True)
        while files.hasNext():
            f = files.next()
            found.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return hashlib.sha1(repr(sorted(found)).encode()).hexdigest()[:16]


def state_path(spark: SparkSession, sf_dir: str) -> str:
    """Folder of the tables that belong to the input as it is now."""
    zone = spark.conf.get("spark.sql.session.timeZone").replace("/", "-")
    return f"{shared_dir(spark)}/tripscope/{_layout_version()}/{input_digest(spark, sf_dir)}-{zone}"


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path that nothing else writes to."""
    return f"{shared_dir(spark)}/tripscope/results/{name}-{uuid.uuid4().hex}"


def _published(spark: SparkSession, folder: str) -> str | None:
    try:
        found = spark.read.text(f"{folder}/published-*").agg(F.min("value")).first()[0]
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return found


# Paths of tables known to be whole, and frames over them (reusing a frame
# reuses its file index and plan).  Keyed by the state of the input.
_PATHS: dict[tuple[str, str], str] = {}
_FRAMES: dict[tuple[str, str], DataFrame] = {}
# One build at a time in a process.
BUILD_LOCK = threading.RLock()


def built_table(
    spark: SparkSession, sf_dir: str, name: str, build: Callable[[str], None], rebuild: bool = False, state: str | None = None
) -> str:
    """Path of the derived table ``name``; ``build(path)`` writes it if no
    build for the input as it is now has been published (or on ``rebuild``,
    to a new path: frames over the old one stay readable)."""
    folder = f"{state or state_path(spark, sf_dir)}/{name}"
    key = (spark.sparkContext.applicationId, folder)
    with BUILD_LOCK:
        if rebuild or key not in _PATHS:
            path = None if rebuild else _published(spark, folder)
            if path is None:
                one = uuid.uuid4().hex
                path = f"{folder}/build-{one}"
                build(path)
                spark.createDataFrame([(path,)], "value string").coalesce(1).write.text(f"{folder}/published-{one}")
            _PATHS[key] = path
        return _PATHS[key]


def prepared_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The prepared trips, lazily: the typed trips of the fixture with the
    raw file's text timestamps and the derived columns.  Equal, row for
    row, to ``prepare_trips(trips_raw(...))`` (the text round trip is
    lossless for whole-second timestamps), without parsing text.

    The joins may all be broadcast, which leaves the rows in the partitions of
    the line items' files (one for one file).  So they are dealt out anew, once:
    by the day of pick-up, for the write, and as the few columns that the joins
    give; the prepared ones, several times as wide, are made behind that shuffle
    and behind the sort that the write needs."""
    day = F.dayofmonth(pickup_time().cast("timestamp")).alias(DEALT_DAY)
    rows = trip_rows(spark, sf_dir).select("*", day).hint("rebalance", DEALT_DAY).sortWithinPartitions(DEALT_DAY)
    t = text_timestamps(trips_of(rows, DEALT_DAY))
    t = t.withColumns({"pickup_ts": F.col("pickup_ts").cast("timestamp"),
                       "dropoff_ts": F.col("dropoff_ts").cast("timestamp")})
    columns = prepare_trips(trips_raw(spark, sf_dir)).columns
    return enrich_trips(t).select(*[F.col(DEALT_DAY).alias(c) if c == PARTITION_COLUMN else c for c in columns])


def _framed(spark: SparkSession, place: str, make: Callable[[], DataFrame]) -> DataFrame:
    key = (spark.sparkContext.applicationId, place)
    with BUILD_LOCK:
        if key not in _FRAMES:
            _FRAMES[key] = make()
        return _FRAMES[key]


def prepared_trips(spark: SparkSession, sf_dir: str, rebuild: bool = False, state: str | None = None) -> DataFrame:
    """The prepared trips of ``sf_dir`` (26 reference columns + keys,
    coordinates and whole-second durations), partitioned by ``pickup_day``."""
    path = built_table(
        spark, sf_dir, "trips",
        lambda path: write_partitioned(prepared_frame(spark, sf_dir), path, by=[PARTITION_COLUMN], dealt=True), rebuild, state,
    )
    return _framed(spark, path, lambda: spark.read.parquet(path))


def zone_table(spark: SparkSession, sf_dir: str, state: str | None = None) -> DataFrame:
    """The zone dimension (derived from nation/region; 24 rows), cached:
    every query joins it, and re-deriving it costs two scans and a join
    per query.  A lost cached block is recomputed from its lineage."""
    place = f"{state or state_path(spark, sf_dir)}/zones"
    return _framed(spark, place, lambda: zones(spark, sf_dir).cache())


def trips_and_zones(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Both, for one look at the input's state."""
    state = state_path(spark, sf_dir)
    return prepared_trips(spark, sf_dir, state=state), zone_table(spark, sf_dir, state=state)


def stored_aggregate(spark: SparkSession, sf_dir: str, name: str, make: Callable[[], DataFrame]) -> DataFrame:
    """The aggregate ``make()``, written once per state of the input: the several
    outputs that are made of it (tops, filters, summaries) read these few rows
    instead of scanning the trips again.  ``name`` must say the parameters."""
    path = built_table(spark, sf_dir, f"{name}-{aggregate_version()}", lambda path: make().write.parquet(path))
    return _framed(spark, path, lambda: spark.read.parquet(path))


def register_views(spark: SparkSession, sf_dir: str, trips_view: str = "trips", zones_view: str = "zones") -> None:
    """Name the prepared trips and the zones as temporary views, for SQL
    (``spark.sql``) and ``spark.table`` callers.  A view is an unexecuted
    plan: each query over it plans afresh, with pruning and pushdown."""
    t, z = trips_and_zones(spark, sf_dir)
    t.createOrReplaceTempView(trips_view)
    z.createOrReplaceTempView(zones_view)
