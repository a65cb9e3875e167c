"""Property tests against brute force in Python on small generated rows."""

from __future__ import annotations

from fractions import Fraction

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tripscope.functions.columns import distance_bucket
from tripscope.operators.imbalance import rounded_ratio
from tripscope.session import scale_conf


def _half_away(fr: Fraction, digits: int) -> float:
    sign = -1 if fr < 0 else 1
    exact = (abs(fr) * 10**digits * 2 + 1) // 2  # floor(|x| * 10^d + 1/2), exact
    return sign * float(Fraction(exact, 10**digits))


@settings(max_examples=25, deadline=None)
@given(st.lists(st.tuples(st.integers(-500, 500), st.integers(1, 700)), min_size=1, max_size=40))
def test_rounded_ratio_matches_exact_rounding(spark, pairs):
    df = spark.createDataFrame(pairs, "n long, d long")
    got = [r[0] for r in df.select(rounded_ratio(F.col("n"), F.col("d"), 4)).collect()]
    want = [_half_away(Fraction(n, d), 4) for n, d in pairs]
    assert got == want


@settings(max_examples=25, deadline=None)
@given(st.lists(st.floats(0, 50, allow_nan=False), min_size=1, max_size=40))
def test_distance_bucket_matches_brute_force(spark, xs):
    df = spark.createDataFrame([(x,) for x in xs], "trip_distance double")
    got = [r[0] for r in df.select(distance_bucket("trip_distance")).collect()]

    def ref(x):
        return "very_short" if x < 1 else "short" if x < 3 else "medium" if x < 10 else "long"

    assert got == [ref(x) for x in xs]


def test_scale_conf_sizes_for_a_large_cluster():
    conf = scale_conf(input_bytes=100 * 2**40, total_cores=4000, executor_memory_gb=16, cores_per_executor=4)
    assert conf["spark.sql.files.maxPartitionBytes"] == "256m"
    assert int(conf["spark.sql.shuffle.partitions"]) == 100 * 2**40 // (256 * 2**20)
    small = scale_conf(input_bytes=10 * 2**20, total_cores=8)
    assert int(small["spark.sql.shuffle.partitions"]) == 16


def test_scale_conf_keys_are_live_settings(spark):
    # every setting applies to a running session and leaves answers unchanged
    from tests.conftest import SF_SMALL
    from tripscope import registry

    before = registry.queries()["zone_imbalance"](spark, SF_SMALL).collect()
    conf = scale_conf(input_bytes=64 * 2**20, total_cores=4)
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        after = registry.queries()["zone_imbalance"](spark, SF_SMALL).collect()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert sorted(map(tuple, before)) == sorted(map(tuple, after))
