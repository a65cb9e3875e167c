"""The flow a user of the reference runs, from files: raw trip CSV and a
zone lookup CSV -> preparation to day-partitioned Parquet -> questions.
Checked against the same questions on the prepared store."""

from __future__ import annotations

import math

from tests.conftest import SF_SMALL
from tripscope import registry
from tripscope.operators import demand, flows, imbalance, od, prepare
from tripscope.sources.files import csv_explicit_scan
from tripscope.sources.store import prepared_trips, zone_table


def test_from_raw_files_to_answers(spark, tmp_path):
    raw_csv = registry.raw_csv_path(spark, SF_SMALL)
    zones_csv = str(tmp_path / "zones_csv")
    zone_table(spark, SF_SMALL).write.csv(zones_csv, header=True)

    # --- what a user writes -------------------------------------------
    raw = csv_explicit_scan(spark, raw_csv, registry.raw_csv_schema())
    prepare.write_partitioned(prepare.prepare_trips(raw), str(tmp_path / "trips"))
    trips = spark.read.parquet(str(tmp_path / "trips"))
    zones = csv_explicit_scan(spark, zones_csv, "LocationID int, Borough string, Zone string")
    answers = {
        "demand": demand.demand_profile_by_date(trips, days=range(1, 32), hours=range(24), k=12),
        "flows": flows.region_flows(trips, zones),
        "imbalance": imbalance.zone_imbalance(trips, zones, min_activity=5),
        "od": od.od_halves_change(trips, split_day=15, min_trips=2),
    }
    # -------------------------------------------------------------------
    store, z = prepared_trips(spark, SF_SMALL), zone_table(spark, SF_SMALL)
    expected = {
        "demand": demand.demand_profile_by_date(store, days=range(1, 32), hours=range(24), k=12),
        "flows": flows.region_flows(store, z),
        "imbalance": imbalance.zone_imbalance(store, z, min_activity=5),
        "od": od.od_halves_change(store, split_day=15, min_trips=2),
    }
    for name, got in answers.items():
        want = expected[name]
        g = sorted(map(tuple, got.collect()), key=_key)
        w = sorted(map(tuple, want.collect()), key=_key)
        assert g and len(g) == len(w), name
        # money went through the CSV as double: equal to a relative 1e-9
        for a, b in zip(g, w):
            for x, y in zip(a, b):
                if isinstance(x, float) or isinstance(y, float):
                    assert math.isclose(x, y, rel_tol=1e-9, abs_tol=1e-9), (name, a, b)
                else:
                    assert x == y, (name, a, b)


def _key(row):
    return tuple(str(v) if not isinstance(v, float) else "" for v in row)
