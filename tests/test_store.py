"""The stored tables tell the truth: another input, another table."""

from __future__ import annotations

import os
import shutil
import subprocess
import sys
import zipfile

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tripscope import registry
from tripscope.operators import payments, prepare
from tripscope.sources.fixtures import INPUT_TABLES, trips_raw
from tripscope.sources.store import built_table, input_digest, prepared_trips, state_path

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture()
def own_copy(tmp_path):
    d = tmp_path / "sf"
    d.mkdir()
    for t in INPUT_TABLES:
        shutil.copyfile(f"{SF_SMALL}/{t}.parquet", d / f"{t}.parquet")  # not its read-only mode
    return str(d)


def _halve(d):
    rows = pq.read_table(f"{d}/lineitem.parquet")
    pq.write_table(rows.slice(0, rows.num_rows // 2), f"{d}/lineitem.parquet")


def test_changed_input_gives_the_new_answer_in_the_same_session(spark, own_copy):
    before = prepared_trips(spark, own_copy)
    n, csv = before.count(), registry.raw_csv_path(spark, own_copy)
    _halve(own_copy)
    assert 0 < prepared_trips(spark, own_copy).count() < n
    assert registry.raw_csv_path(spark, own_copy) != csv
    assert before.count() == n  # the earlier frame still reads its own table


def test_digest_follows_the_time_zone(spark, own_copy):
    here, zone = state_path(spark, own_copy), spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert state_path(spark, own_copy) != here
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert input_digest(spark, own_copy) == input_digest(spark, own_copy + "/")


def test_rebuild_keeps_frames_of_the_old_table(spark, own_copy):
    before = prepared_trips(spark, own_copy)
    n = before.count()
    assert prepared_trips(spark, own_copy, rebuild=True).count() == n == before.count()


def test_roundtrips_do_not_destroy_each_other(spark):
    first = registry.queries()["partitioned_roundtrip"](spark, SF_SMALL)
    n = first.count()
    assert registry.queries()["partitioned_roundtrip"](spark, SF_SMALL).count() == n == first.count()


CHILD = """
import sys
from tripscope import build_session
from tripscope.sources.store import prepared_trips
spark = build_session("child", master="local[2]", shuffle_partitions=4, conf={"spark.checkpoint.dir": sys.argv[1]})
print("ROWS", prepared_trips(spark, sys.argv[2]).count())
"""


def _children(paths, shared, d, n):
    env = os.environ | {"PYTHONPATH": paths}
    runs = [
        subprocess.Popen([sys.executable, "-c", CHILD, shared, d], env=env, cwd="/", stdout=subprocess.PIPE, stderr=subprocess.PIPE, text=True)
        for _ in range(n)
    ]
    out = [r.communicate(timeout=300) for r in runs]
    assert all(r.returncode == 0 for r in runs), out
    return {line for o, _ in out for line in o.splitlines() if line.startswith("ROWS")}


def test_two_processes_build_at_once_and_a_later_one_sees_new_data(spark, own_copy, tmp_path):
    shared = str(tmp_path / "shared")
    want = trips_raw(spark, own_copy).count()
    assert _children(REPO, shared, own_copy, 2) == {f"ROWS {want}"}
    _halve(own_copy)
    assert _children(REPO, shared, own_copy, 1) == {f"ROWS {trips_raw(spark, own_copy).count()}"}


def test_package_works_from_a_zip(spark, own_copy, tmp_path):
    path = str(tmp_path / "package.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(f"{REPO}/tripscope"):
            for n in names:
                if n.endswith(".py"):
                    z.write(f"{folder}/{n}", os.path.relpath(f"{folder}/{n}", REPO))
    assert len(_children(path, str(tmp_path / "shared"), own_copy, 1)) == 1


def test_failed_build_is_not_published(spark, own_copy):
    def fail(path):
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        built_table(spark, own_copy, "failing", fail)
    path = built_table(spark, own_copy, "failing", lambda p: spark.range(3).write.parquet(p))
    assert spark.read.parquet(path).count() == 3


def test_preparation_drops_rows_for_both_causes(spark):
    raw = registry.trips_raw_damaged(spark, SF_SMALL)
    m = registry.queries()["prepare_metrics"](spark, SF_SMALL).first()
    assert m.dropped_rows == m.raw_rows - m.processed_rows > 0
    by_year = prepare.prepare_metrics(raw, prepare.keep_condition()).first()
    by_cell = prepare.prepare_metrics(trips_raw(spark, SF_SMALL), prepare.keep_condition(years=registry.PREPARE_YEARS)).first()
    assert 0 < by_year.dropped_rows < m.dropped_rows and 0 < by_cell.dropped_rows < m.dropped_rows


def test_bad_cells_do_not_fail_the_vendor_count(spark):
    csv = registry.files.csv_explicit_scan(
        spark, registry.raw_csv_path(spark, SF_SMALL, with_damage=True), registry.raw_csv_schema()
    )
    got = payments.vendor_hourly_count(csv.withColumnRenamed("VendorID", "vendor_id"), 1, payments.hour_of_text())
    assert got.where("pickup_hour is null").isEmpty() and got.agg(F.sum("trips")).first()[0] > 0
    assert csv.where("passenger_count is null").count() > 0


def test_describe_does_not_overflow(spark):
    from tripscope.operators.explore import eda_describe

    big = spark.range(1000).select(F.expr("cast(id % 7 + 100000000000000 as decimal(19,4))").alias("x"))
    r = eda_describe(big, ["x"]).first()
    assert r.n == 1000 and r.mean > 1e14 and r.stddev is not None
    huge = big.select(F.expr("cast(x * 1000000 as decimal(38,4))").alias("x"))
    assert eda_describe(huge, ["x"]).first().mean > 1e20


def test_haversine_forms_agree_on_missing_and_nan(spark):
    from tripscope.operators import geo

    rows = [(40.7, -74.0, 40.8, -73.9), (None, -74.0, 40.8, -73.9), (float("nan"), -74.0, 40.8, -73.9)]
    t = spark.createDataFrame(
        rows, "pickup_latitude double, pickup_longitude double, dropoff_latitude double, dropoff_longitude double"
    )
    kind = F.when(F.col("haversine_km").isNull(), "null").when(F.isnan("haversine_km"), "nan").otherwise("number")
    a = [r[0] for r in geo.haversine_builtin(t).select(kind).collect()]
    b = [r[0] for r in geo.haversine_udf(t).select(kind).collect()]
    assert a == b == ["number", "null", "nan"]
