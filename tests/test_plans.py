"""
strategy, no Python in the built-in paths, top-k without a full sort."""

from __future__ import annotations

from tests.conftest import SF_MID
from tripscope import registry
from tripscope.operators import flows, geo, od, revenue
from tripscope.plans.inspect import plan_text, scan_nodes
from tripscope.sources.store import prepared_frame, prepared_trips, zone_table


def _q(spark, key):
    return registry.queries()[key](spark, SF_MID)


def test_demand_window_prunes_day_partitions(spark):
    plan = plan_text(_q(spark, "demand_window"))
    part = [ln for ln in plan.splitlines() if ln.strip().startswith("PartitionFilters:")]
    assert part and "pickup_day" in part[0] and "IN (20,21,22)" in part[0]
    pushed = [ln for ln in plan.splitlines() if ln.strip().startswith("PushedFilters:")]
    assert "In(pickup_hour, [3,4,5,6])" in pushed[0]


def test_od_split_reads_stored_day(spark):
    # the split reads the stored day column (no dayofmonth recomputation)
    plan = plan_text(od.od_halves_change(prepared_trips(spark, SF_MID), 15, 5))
    scans = scan_nodes(plan)
    assert scans and all("pickup_day" in s for s in scans)
    assert "dayofmonth" not in plan


def test_quality_filter_pushed_to_scan(spark):
    plan = plan_text(_q(spark, "region_flows"))
    assert "PushedFilters: [" in plan
    assert "GreaterThan(duration_minutes,0.0)" in plan
    assert "GreaterThan(trip_distance,0.0)" in plan


def test_narrow_read_schema(spark):
    plan = plan_text(_q(spark, "vendor_hourly_count"))
    read = [ln for ln in plan.splitlines() if ln.strip().startswith("ReadSchema:")]
    assert read and all("fare_amount" not in ln and "tip_amount" not in ln for ln in read)
    assert all("string" not in ln for ln in read)


def test_durations_are_stored(spark):
    t, z = prepared_trips(spark, SF_MID), zone_table(spark, SF_MID)
    made = [_q(spark, "payment_mix_by_hour"), revenue.zone_revenue(t, z), flows.region_flows(t, z)]
    made += [flows.airport_flag(t, z), flows.airport_flows(t, z), flows.region_flow_counts_merge(t, z)]
    for i, df in enumerate(made):
        read = [ln for ln in plan_text(df).splitlines() if ln.strip().startswith("ReadSchema:")]
        assert read and all("pickup_ts" not in ln and "dropoff_ts" not in ln for ln in read), i


def test_extremes_are_one_scan(spark):
    plan = plan_text(_q(spark, "eda_extremes"))
    assert len([ln for ln in plan.splitlines() if ln.startswith("(") and "Scan parquet" in ln]) == 1


def test_no_pinned_partitions(spark):
    for key in registry.queries():
        assert "REPARTITION_BY_NUM" not in plan_text(_q(spark, key)), key


def test_plans_of_operators_start_no_job(spark):
    t, z = prepared_trips(spark, SF_MID), zone_table(spark, SF_MID)
    z.count()
    tracker, group = spark.sparkContext.statusTracker(), "no-job-while-planning"
    spark.sparkContext.setJobGroup(group, group)
    try:
        revenue.zone_enrich(t, z)
        flows.region_flow_counts(t, z, "auto")
        flows.region_flow_counts(t, z, "merge")
        assert list(tracker.getJobIdsForGroup(group)) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_no_python_in_builtin_paths(spark):
    for key in ("speed_by_hour", "region_flows", "zone_revenue", "od_halves_change"):
        plan = plan_text(_q(spark, key))
        assert "EvalPython" not in plan and "PythonUDF" not in plan, key


def test_udf_variant_is_arrow_batched(spark):
    plan = plan_text(geo.haversine_udf(prepared_trips(spark, SF_MID)))
    assert "ArrowEvalPython" in plan


def test_zone_enrich_broadcasts_by_the_estimate(spark):
    t, z = prepared_trips(spark, SF_MID), zone_table(spark, SF_MID)
    plan = plan_text(revenue.zone_enrich(t, z))
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_merge_variant_sort_merges(spark):
    t, z = prepared_trips(spark, SF_MID), zone_table(spark, SF_MID)
    plan = plan_text(flows.region_flow_counts(t, z, "merge"))
    nodes = [ln for ln in plan.splitlines() if ln.startswith("(") and "SortMergeJoin" in ln]
    assert len(nodes) == 2
    # counted per pair of ids below both joins
    tree = plan.split("\n(")[0]
    assert tree.rfind("HashAggregate") > tree.rfind("SortMergeJoin") > 0


def test_flows_aggregate_before_joining(spark):
    # the fact side is reduced per id pair before it meets the zones
    t, z = prepared_trips(spark, SF_MID), zone_table(spark, SF_MID)
    plan = plan_text(flows.region_flows(t, z))
    first_join = plan.find("Join")
    assert plan.find("HashAggregate", first_join) > 0


def test_top_k_is_take_ordered(spark):
    for key in ("demand_profile_by_date", "zone_top_revenue", "imbalance_top_surplus", "od_top_growth"):
        assert "TakeOrderedAndProject" in plan_text(_q(spark, key)), key


def test_trips_are_dealt_out_once_before_their_columns_are_made(spark):
    frame = prepared_frame(spark, SF_MID)
    dealt = [node for node in plan_text(frame).split("\n\n") if "REBALANCE_PARTITIONS" in node]
    assert len(dealt) == 1 and "REBALANCE_PARTITIONS_BY_COL" in dealt[0] and "l_extendedprice" in dealt[0]
    assert all(c not in dealt[0] for c in ("fare_amount", "tpep_pickup_datetime", "pickup_latitude", "duration_minutes"))
    # what the write asks for is there already: it sorts no wide rows
    ordering = frame._jdf.queryExecution().optimizedPlan().outputOrdering()
    assert ordering.size() == 1 and ordering.apply(0).toString().startswith("pickup_day#")


def test_stored_trips_lie_under_their_day(spark):
    t = prepared_trips(spark, SF_MID)
    assert t.where("pickup_day is distinct from dayofmonth(pickup_ts)").isEmpty()
