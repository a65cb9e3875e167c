"""Hot keys: one pick-up zone (and one day) holding two thirds of all trips.

The skewed input is derived from the sf0.01 trips; AQE's size thresholds
are lowered to this scale so that the cluster-scale behaviour shows:
the row-level join splits the hot partition (skew join); the sort-merge
variant of the flows needs no split, for it joins counts; the rebalanced write cuts the hot day into several
files; the pre-aggregating operators are unaffected by the hot key.
"""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_MID
from tripscope.operators import flows, imbalance, prepare, revenue
from tripscope.plans.inspect import plan_text
from tripscope.sources.store import prepared_trips, zone_table

HOT_ZONE, HOT_DAY = 7, 9


@pytest.fixture()
def skewed(spark):
    t = prepared_trips(spark, SF_MID)
    hot = F.pmod(F.col("l_orderkey"), F.lit(3)) != 0
    return t.withColumns(
        {
            "pu_location_id": F.when(hot, F.lit(HOT_ZONE)).otherwise(F.col("pu_location_id")),
            "pickup_day": F.when(hot, F.lit(HOT_DAY)).otherwise(F.col("pickup_day")),
        }
    )


@pytest.fixture()
def small_aqe(spark):
    keys = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    old = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def test_merge_join_needs_no_split(spark, skewed, small_aqe):
    z = zone_table(spark, SF_MID)
    merged = flows.region_flow_counts(skewed, z, "merge")
    rows = merged.collect()
    plan = plan_text(merged)
    assert "isFinalPlan=true" in plan
    # pairs of ids are counted first, so the hot zone is a few rows
    assert "isSkewJoin=true" not in plan and "skew=true" not in plan
    pre = flows.region_flows(skewed, z).select("pu_borough", "do_borough", "trips")
    assert sorted(map(tuple, rows)) == sorted(map(tuple, pre.collect()))
    hot_borough = z.where(F.col("LocationID") == HOT_ZONE).collect()[0].Borough
    hot_share = sum(r.trips for r in rows if r.pu_borough == hot_borough) / sum(r.trips for r in rows)
    assert hot_share > 0.6


def test_row_level_join_splits_hot_zone(spark, skewed, small_aqe):
    z = zone_table(spark, SF_MID).hint("merge")
    named = revenue.zone_enrich(skewed.select("l_orderkey", "pu_location_id", "total_amount"), z)
    assert len(named.collect()) == skewed.join(z, F.col("pu_location_id") == F.col("LocationID")).count()
    assert "skew=true" in plan_text(named) or "isSkewJoin=true" in plan_text(named)


def test_rebalanced_write_splits_hot_day(spark, skewed, small_aqe, tmp_path):
    out = str(tmp_path / "skewed")
    prepare.write_partitioned(skewed, out)
    hot_dir = os.path.join(out, f"pickup_day={HOT_DAY}")
    hot_files = [f for f in os.listdir(hot_dir) if f.endswith(".parquet")]
    cold_dir = os.path.join(out, "pickup_day=1")
    cold_files = [f for f in os.listdir(cold_dir) if f.endswith(".parquet")]
    assert len(hot_files) > len(cold_files) >= 1
    assert spark.read.parquet(out).count() == skewed.count()


def test_imbalance_forms_agree_under_skew(spark, skewed):
    z = zone_table(spark, SF_MID)
    a = imbalance.zone_imbalance(skewed, z, 200, "one_pass")
    b = imbalance.zone_imbalance(skewed, z, 200, "full_outer")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    hot = a.where(F.col("location_id") == HOT_ZONE).agg(F.sum("pickups")).collect()[0][0]
    assert hot > 0.6 * skewed.count()
