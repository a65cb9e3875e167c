"""Preparation that accounts for itself, rejected cells, days replaced one by one."""

from __future__ import annotations

import json
import os
from collections import Counter

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tripscope import registry
from tripscope.operators import accounting, prepare
from tripscope.operators.accounting import drop_counts, prepare_accounted
from tripscope.plans.inspect import plan_text
from tripscope.sources.days import DayTable
from tripscope.sources.fixtures import trips_raw_damaged
from tripscope.sources.rejects import WHOLE_LINE, rejected_cells, rejected_rows
from tripscope.sources.store import fresh_path, prepared_trips

YEARS = registry.PREPARE_YEARS


def test_record_equals_a_plain_count_and_is_stored(spark, tmp_path):
    raw = trips_raw_damaged(spark, SF_SMALL)
    place, record = str(tmp_path / "trips"), str(tmp_path / "record")
    got = prepare_accounted(raw, place, record, YEARS, dataset="trips", output_path=place).first()
    plain = prepare.prepare_metrics(raw, prepare.keep_condition(years=YEARS)).first()
    assert (got.raw_rows, got.kept_rows, got.counted_by) == (plain.raw_rows, plain.processed_rows, "write")
    dropped = [got[f"dropped_{c}"] for c in prepare.DROP_CAUSES]
    assert sum(dropped) == plain.dropped_rows and all(dropped)
    assert spark.read.parquet(place).count() == got.kept_rows
    (line,) = [x for f in os.listdir(record) if f.endswith(".json") for x in open(f"{record}/{f}")]
    assert json.loads(line) == got.asDict() and got.dataset == "trips"


def test_prepared_rows_are_those_of_prepare_trips(spark, tmp_path):
    raw = trips_raw_damaged(spark, SF_SMALL)
    prepare_accounted(raw, str(tmp_path / "t"), str(tmp_path / "r"), YEARS)
    got = spark.read.parquet(str(tmp_path / "t"))
    want = prepare.prepare_trips(raw, years=YEARS)
    assert set(got.columns) == set(want.columns)
    columns = sorted(set(want.columns))
    assert got.select(columns).exceptAll(want.select(columns)).isEmpty() and got.count() == want.count()


def test_a_task_counted_twice_is_noticed(spark, tmp_path, monkeypatch):
    class Twice(accounting.Observation):
        @property
        def get(self):
            return {k: 2 * v for k, v in super().get.items()}

    monkeypatch.setattr(accounting, "Observation", Twice)
    raw = trips_raw_damaged(spark, SF_SMALL)
    got = prepare_accounted(raw, str(tmp_path / "t"), str(tmp_path / "r"), YEARS).first().asDict()
    assert got.pop("counted_by") == "recount" and got == drop_counts(raw, YEARS).first().asDict()


def test_nothing_kept_and_nothing_there(spark, tmp_path):
    raw = trips_raw_damaged(spark, SF_SMALL)
    none = prepare_accounted(raw, str(tmp_path / "a"), str(tmp_path / "b"), 1900).first()
    assert none.kept_rows == 0 and none.raw_rows == raw.count()
    empty = prepare_accounted(raw.limit(0), str(tmp_path / "c"), str(tmp_path / "d"), YEARS).first()
    assert (empty.raw_rows, empty.kept_rows, empty.dropped_year) == (0, 0, 0)


def test_write_scans_the_raw_rows_once(spark):
    """The observed counts and the rows to write come out of one plan."""
    parsed = prepare.parse_trips(trips_raw_damaged(spark, SF_SMALL))
    seen = accounting.Observation("plan")
    df = prepare.enrich_trips(parsed.observe(seen, F.count(F.lit(1)).alias("n")).where(prepare.drop_cause(YEARS).isNull()))
    plan = plan_text(df)
    lineitems = [x for x in plan.splitlines() if x.startswith("Location:") and "lineitem" in x]
    assert len(lineitems) == 1 and "CollectMetrics" in plan


CSV = "a,when,b\n1,2024-01-02T03:04:05.000,2.5\nx,never,y\n3,,\n4,2024-13-01T00:00:00.000,z\n5\n6,2024-01-01T00:00:00.000,1,extra\n"


def test_rejected_cells_by_file_and_column(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for name, text in (("one.csv", CSV), ("two.csv", "a,when,b\nbad,,1\n"), ("good.csv", "a,when,b\n1,,1\n")):
        (tmp_path / "in" / name).write_text(text)
    schema = registry.files.T.StructType.fromDDL("a int, when string, b double")
    formats = {"when": "yyyy-MM-dd'T'HH:mm:ss.SSS"}
    got = {(os.path.basename(r.file), r.column): r.bad_cells for r in rejected_cells(spark, str(tmp_path / "in"), schema, formats).collect()}
    assert got == {
        ("one.csv", "a"): 1, ("one.csv", "when"): 2, ("one.csv", "b"): 2, ("one.csv", WHOLE_LINE): 2, ("two.csv", "a"): 1,
    }
    lines = Counter(r.line for r in rejected_rows(spark, str(tmp_path / "in"), schema, formats).collect())
    assert lines == Counter(["x,never,y", "4,2024-13-01T00:00:00.000,z", "5", "6,2024-01-01T00:00:00.000,1,extra", "bad,,1"])
    # what the plain scan reads is untouched
    assert registry.files.csv_explicit_scan(spark, str(tmp_path / "in"), schema).count() == 8


def _days(df):
    return {r.pickup_day: (r.n, r.s) for r in df.groupBy("pickup_day").agg(F.count("*").alias("n"), F.sum("passenger_count").alias("s")).collect()}


@pytest.fixture()
def table(spark):
    return DayTable(spark, fresh_path(spark, "test-days"))


def test_one_day_rewrites_one_folder_and_old_readers_go_on(spark, table):
    trips = prepared_trips(spark, SF_SMALL).where("pickup_day between 1 and 6")
    assert table.replace(trips) == 1
    before, old, want = table.read(), table.builds(), _days(trips)
    changed = trips.where("pickup_day = 3").withColumn("passenger_count", F.lit(9))
    assert table.replace(changed) == 2 and table.versions() == [1, 2]
    assert {d for d, b in table.builds().items() if old[d] != b} == {"3"}
    assert _days(before) == want  # the frame of the first version
    now = _days(table.read())
    assert now[3] == (want[3][0], 9 * want[3][0]) and {d: v for d, v in now.items() if d != 3} == {d: v for d, v in want.items() if d != 3}
    assert _days(table.read(1)) == want


def test_day_filters_prune_and_days_can_end(spark, table):
    trips = prepared_trips(spark, SF_SMALL).where("pickup_day between 1 and 4")
    table.replace(trips)
    plan = plan_text(table.read().where("pickup_day = 2"))
    assert "PartitionFilters: [isnotnull(pickup_day" in plan and "(pickup_day" in plan
    assert table.replace(trips.where("pickup_day in (2, 3)"), days=[1, 2]) == 2  # 3 is not named, 1 has no rows
    builds = table.builds()
    assert set(builds) == {"2", "3", "4"} and builds["3"] == builds["4"] != builds["2"]


@pytest.fixture()
def written(monkeypatch):
    """Path -> plan of each frame as it is written."""
    plans, plain = {}, DataFrameWriter.parquet

    def parquet(self, path, *args, **kwargs):
        plans[path] = plan_text(self._df)
        return plain(self, path, *args, **kwargs)

    monkeypatch.setattr(DataFrameWriter, "parquet", parquet)
    return plans


def test_rows_that_lie_by_day_are_written_without_a_shuffle(spark, table, written):
    place = fresh_path(spark, "test-by-day")
    rows = spark.range(0, 600, 1, 5).selectExpr("id", "cast(id % 4 as int) as passenger_count", "nullif(cast(id % 6 as int), 0) as pickup_day")
    rows = rows.unionAll(rows.where("id % 10 = 1"))  # some rows twice
    prepare.write_partitioned(rows, place)
    written.clear()
    stored = spark.read.parquet(place)
    table.replace(stored.withColumn("passenger_count", F.when(F.col("pickup_day") == 2, None).otherwise(F.col("passenger_count"))), dealt=True)
    first = table.read()
    assert table.replace(stored.where("pickup_day = 2"), dealt=True) == 2
    assert len(written) == 2 and not any("Exchange" in p for p in written.values())
    assert len(set(table.builds().values())) == 2 and set(table.builds()) == {"1", "2", "3", "4", "5", "__HIVE_DEFAULT_PARTITION__"}
    plain = lambda df: Counter(map(tuple, df.select("id", "passenger_count", "pickup_day").collect()))
    assert plain(table.read()) == plain(rows)
    assert plain(first) == Counter((i, None if d == 2 else c, d) for i, c, d in plain(rows).elements())
    table.replace(rows)  # rows that lie anyhow are still dealt out by day
    assert "REBALANCE_PARTITIONS_BY_COL" in list(written.values())[-1]


def test_the_late_day_is_written_without_a_shuffle(spark, written):
    prepared_trips(spark, SF_SMALL)
    written.clear()
    got = {r.pickup_day: r for r in registry.queries()["prepare_late_day"](spark, SF_SMALL).collect()}
    assert len(written) == 2 and not any("Exchange" in p for p in written.values())
    want = _days(prepared_trips(spark, SF_SMALL))
    assert {d: (r.trips, r.passengers) for d, r in got.items()} == want
    assert {d for d, r in got.items() if r.rewritten} == {registry.LATE_DAY}


def test_a_lost_race_publishes_again(spark, table, monkeypatch):
    trips = prepared_trips(spark, SF_SMALL).where("pickup_day in (1, 2)")
    table.replace(trips)
    plain, rivals = DayTable._published, []

    def rival(self):
        # another writer's version 2 appears between our look and our publishing
        if not rivals:
            rivals.append(1)
            found = plain(self)
            other = spark.createDataFrame([("1", self.builds(1)["1"]), ("9", "bother")], "day string, build string")
            other.coalesce(1).write.json(f"{self.folder}/version-00000002-0")
            return found
        return plain(self)

    monkeypatch.setattr(DayTable, "_published", rival)
    assert table.replace(trips.where("pickup_day = 2")) == 3
    assert set(table.builds()) == {"1", "2", "9"}


def test_an_empty_table_says_so(spark, table):
    assert table.versions() == [] and table.builds() == {}
    with pytest.raises(ValueError):
        table.read()
