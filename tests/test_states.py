"""Stored states give what full scans give; exact sums do not depend on order."""

from __future__ import annotations

import math
import random
from decimal import Decimal
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tripscope import registry
from tripscope.functions import exact
from tripscope.functions.distinct import bitmaps, distinct_of_bitmaps, distinct_of_sketches, sketches
from tripscope.operators import demand, flows, od, payments, sampling, states
from tripscope.plans.inspect import plan_text
from tripscope.sources import store
from tripscope.sources.days import DayTable
from tripscope.sources.store import fresh_path, prepared_trips, trips_and_zones


def rows(df):
    return [tuple(r) for r in df.select(sorted(df.columns)).collect()]


def stored(spark, trips, state):
    table = DayTable(spark, fresh_path(spark, f"state-{state.name}"))
    states.refresh(table, trips, state)
    return table


def test_states_equal_full_scans(spark):
    trips, zones = trips_and_zones(spark, SF_SMALL)
    sums, bits = (states.of_days(stored(spark, trips, s), [20, 21, 22]) for s in (states.DEMAND, states.ZONES))
    assert rows(states.demand_profile(sums, bits, [3, 4, 5, 6])) == rows(demand.demand_profile_by_date(trips))
    found = rows(states.region_flows(stored(spark, trips, states.FLOWS).read(), zones))
    assert found == rows(flows.region_flows(trips, zones))
    mix = states.payment_mix(stored(spark, trips, states.PAYMENTS).read()).drop("tip_rate")
    assert rows(mix) == rows(payments.payment_mix_by_hour(trips).drop("tip_rate"))
    rates = {(r.pickup_hour, r.payment_method): r.tip_rate for r in states.payment_mix(stored(spark, trips, states.PAYMENTS).read()).collect()}
    plain = {(r.pickup_hour, r.payment_method): r.tip_rate for r in payments.payment_mix_by_hour(trips).collect()}
    assert rates.keys() == plain.keys() and all(math.isclose(rates[k], plain[k], rel_tol=1e-12) for k in rates)


def test_a_new_day_scans_only_that_day(spark):
    trips = prepared_trips(spark, SF_SMALL)
    table = stored(spark, trips.where("pickup_day < 10"), states.FLOWS)
    before = table.builds()
    states.refresh(table, trips, states.FLOWS, days=[10])
    assert {d for d, b in table.builds().items() if before.get(d) != b} == {"10"}
    plan = plan_text(states.FLOWS.partial(trips.where(F.col("pickup_day").isin([10]))))
    assert "PartitionFilters: [(pickup_day" in plan.replace("isnotnull(pickup_day#", "(pickup_day#") and "= 10)" in plan
    want = flows.pair_sums(trips.where("pickup_day <= 10")).select("pu_location_id", "do_location_id", "n", "s_total", "s_dur")
    got = states.FLOWS.merged(table.read()).select(*want.columns)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_distinct_zones_of_any_days_without_trips(spark):
    trips = prepared_trips(spark, SF_SMALL)
    table = stored(spark, trips, states.ZONES)
    days = [1, 5, 6, 30]
    got = {r.pickup_hour: r.unique_pickup_zones for r in states.distinct_zones(states.of_days(table, days), ["pickup_hour"]).collect()}
    want = states.quality_filter(trips).where(F.col("pickup_day").isin(days)).groupBy("pickup_hour").agg(F.countDistinct("pu_location_id").alias("n"))
    assert got == {r.pickup_hour: r.n for r in want.collect()}


def test_bitmaps_over_buckets_and_sketches_within_their_error(spark):
    values = [v for v in range(-5, 100_000, 7)] * 2 + [None]
    df = spark.createDataFrame([(i % 3, i % 10, v) for i, v in enumerate(values)], "g int, day int, v long")
    want = {r.g: r.n for r in df.groupBy("g").agg(F.countDistinct("v").alias("n")).collect()}
    assert {r.g: r.n for r in distinct_of_bitmaps(bitmaps(df, ["day", "g"], "v"), ["g"], "n").collect()} == want
    near = {r.g: r.n for r in distinct_of_sketches(sketches(df, ["day", "g"], "v"), ["g"], "n").collect()}
    assert all(abs(near[g] - n) <= 4 * 1.04 / 64 * n for g, n in want.items())
    nothing = df.where("v is null")
    assert distinct_of_bitmaps(bitmaps(nothing, ["g"], "v"), ["g"], "n").count() == 0


@pytest.mark.parametrize("values", [
    ["0.00"], ["1.25", "1.25"], ["-3.50", "7.25", "0.00"], ["99999999.99", "99999999.98", "-99999999.99"],
])
def test_variance_is_exact(spark, values):
    values = [Decimal(v) for v in values]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v decimal(12,2)")
    state = {n: F.col(n) for n in exact.SQUARE_STATE}
    one = df.agg(*[a.alias(n) for n, a in exact.square_state("v", 2).items()])
    got = one.select(exact.variance_of(state, 2).alias("v")).first().v
    x = [Fraction(v) for v in values]
    m = sum(x) / len(x)
    want = sum((y - m) ** 2 for y in x) / (len(x) - 1) if len(x) > 1 else None
    assert (got is None) if want is None else math.isclose(got, float(want), rel_tol=1e-14, abs_tol=0)


def test_variance_state_holds_1e13_rows(spark):
    """Merging a state with itself stands for 10**13 rows of one million."""
    df = spark.createDataFrame([(Decimal("1000000.00"),), (Decimal("1000000.02"),)], "v decimal(12,2)")
    one = df.agg(*[a.alias(n) for n, a in exact.square_state("v", 2).items()])
    many = one.select(*[(F.col(n) * (5 * 10**12)).cast(one.schema[n].dataType).alias(n) for n in exact.SQUARE_STATE])
    got = many.select(exact.variance_of({n: F.col(n) for n in exact.SQUARE_STATE}, 2).alias("v")).first().v
    assert math.isclose(got, 1e-4, rel_tol=1e-12)


def test_ratio_mean_has_the_same_bits_in_any_order(spark):
    r = random.Random(4)
    made = [(Decimal(r.randint(0, 10**6)) / 100, Decimal(r.randint(0, 10**5)) / 100) for _ in range(3000)] + [(None, Decimal(1))]
    state = {n: F.col(n) for n in exact.RATIO_STATE}
    found = set()
    for parts in (1, 3, 8):
        r.shuffle(made)
        df = spark.createDataFrame(made, "a decimal(12,2), b decimal(12,2)").repartition(parts)
        partial = df.groupBy(F.pmod(F.hash("a", "b"), F.lit(parts)).alias("day")).agg(*[a.alias(n) for n, a in exact.ratio_state("a", "b").items()])
        one = partial.agg(*[a.alias(n) for n, a in exact.merged(exact.RATIO_STATE).items()])
        found.add(one.select(exact.ratio_mean_of(state).alias("m")).first().m)
    ratios = [Fraction(float(a) / float(b)) for a, b in made if a is not None and b]
    (mean,) = found
    assert math.isclose(mean, float(sum(ratios) / len(ratios)), rel_tol=1e-15)
    empty = spark.createDataFrame([], "a double, b double").agg(*[a.alias(n) for n, a in exact.ratio_state("a", "b").items()])
    assert empty.select(exact.ratio_mean_of(state).alias("m")).first().m is None


@pytest.mark.parametrize("few", [1, 40, 100_000])
def test_exactly_n_rows_whatever_the_partitions(spark, few):
    df = spark.createDataFrame([(i, i % 7) for i in range(2000)], "k long, v int")
    for n in (0, 1, 17, 500, 1999, 2000, 5000):
        got = {r.k for r in sampling.sample_n(df.repartition(3), n, ["k"], few_rows=few, digits=2).collect()}
        assert len(got) == min(n, 2000)
        assert got == {r.k for r in sampling.sample_n(df.orderBy("v"), n, ["k"], few_rows=few).collect()}
    smaller = {r.k for r in sampling.sample_n(df, 17, ["k"]).collect()}
    assert smaller < {r.k for r in sampling.sample_n(df, 18, ["k"]).collect()}
    assert smaller != {r.k for r in sampling.sample_n(df, 17, ["k"], seed=1).collect()}


def test_rows_alike_and_null_keys_are_counted_too(spark):
    df = spark.createDataFrame([(None, "x")] * 50 + [(1, "x")] * 50, "k long, _place string")
    got = sampling.sample_n(df, 70, ["k"], few_rows=5)
    assert got.count() == 70 and got.columns == df.columns
    plan = plan_text(sampling.sample_n(df, 10, ["k"]))
    assert "TakeOrderedAndProject" in plan


def test_bucketed_halves_join_without_an_exchange(spark):
    query = registry.queries()["od_halves_from_buckets"](spark, SF_SMALL)
    plan = plan_text(query)
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    trips = prepared_trips(spark, SF_SMALL)
    want = od.od_halves_change(trips, registry.OD_SPLIT_DAY, registry.OD_MIN_TRIPS)
    assert sorted(rows(query)) == sorted(rows(want)) and query.count() > 0
    # A later session, which has the files but not the table's name
    for t in spark.catalog.listTables():
        if t.name.startswith("bucketed_") and not t.isTemporary:
            spark.sql(f"ALTER TABLE {t.name} RENAME TO gone_{t.name}")
    again = registry.queries()["od_halves_from_buckets"](spark, SF_SMALL)
    assert "Exchange" not in plan_text(again) and sorted(rows(again)) == sorted(rows(want))


@pytest.mark.parametrize("keys", [
    ("zone_revenue", "zone_top_revenue", "zone_top_per_mile", "zone_top_per_minute", "zone_low_support"),
    ("zone_imbalance", "imbalance_top_surplus", "imbalance_top_deficit", "imbalance_top_ratio", "imbalance_by_hour"),
    ("od_halves_change", "od_top_growth", "od_top_decline"),
])
def test_outputs_of_one_aggregate_read_no_trips(spark, keys):
    queries = registry.queries()
    for key in keys:
        plan = plan_text(queries[key](spark, SF_SMALL))
        scans = [x for x in plan.splitlines() if x.startswith("Location:")]
        assert len(scans) == 1 and "/trips/" not in scans[0], key


def test_looking_at_the_input_starts_no_job(spark):
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup
    spark.sparkContext.setJobGroup("digest", "digest")
    try:
        assert len(store.input_digest(spark, SF_SMALL)) == 16
        assert list(jobs("digest")) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
