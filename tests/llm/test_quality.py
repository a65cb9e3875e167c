"""Quality classifier: held-out accuracy, and the updates on toy data."""

from __future__ import annotations

import math
import zlib

import numpy as np
from pyspark.sql import functions as F

from tests.conftest import SF_MID
from tripscope.llm.common import drawn
from tripscope.llm.quality import QualityModel, features, fit_quality, keep_quality, op8_quality, score_quality, train


def test_held_out_accuracy(spark):
    labels = spark.read.parquet(f"{SF_MID}/labels.parquet")
    rows = op8_quality(spark, SF_MID).join(labels, "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    out = [r for r in rows if r.held_out]
    assert sum(r.predicted == r.quality for r in out) >= 0.93 * len(out)
    good = [r for r in out if r.quality == 1]
    assert sum(r.predicted for r in good) >= 0.97 * len(good)


def test_updates_separate_and_keep_weights_sparse():
    rows = [(np.array([1, 9]), np.array([0.7, 0.7]), 1), (np.array([2, 9]), np.array([0.7, 0.7]), 0)] * 30
    model = train(rows, bits=4)
    assert model.weights[1] > 0 > model.weights[2] and np.count_nonzero(model.weights) <= 3
    assert train([], bits=4).score("anything") == 0.5
    # one feature for every word that comes again
    assert (features("ha ha ha") == 1).sum() == 2 and len(features("")) == 0


def test_updates_equal_a_plain_loop():
    """One coordinate after the other, as the method is written down."""
    rng = np.random.default_rng(5)
    rows = [(np.sort(rng.choice(32, 6, replace=False)), rng.random(6), int(rng.integers(2))) for _ in range(40)]
    alpha, beta, l1, l2 = 0.3, 0.2, 0.02, 0.02
    z, n = [0.0] * 33, [0.0] * 33  # 32: the bias, which has no l1

    def weight(i):
        least = 0.0 if i == 32 else l1
        if abs(z[i]) <= least and i != 32:
            return 0.0
        return -(z[i] - math.copysign(least, z[i])) / ((beta + math.sqrt(n[i])) / alpha + l2)

    for _ in range(4):
        for f, x, y in rows:
            seen = [*zip(f.tolist(), x.tolist()), (32, 1.0)]
            w = {i: weight(i) for i, _ in seen}
            p = 1 / (1 + math.exp(-sum(w[i] * v for i, v in seen)))
            for i, v in seen:
                g = (p - y) * v
                s = (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / alpha
                z[i] += g - s * w[i]
                n[i] += g * g
    model = train(rows, bits=5)
    assert np.allclose(model.weights, [weight(i) for i in range(32)], atol=1e-6) and math.isclose(model.bias, weight(32), rel_tol=1e-9)


def test_share_of_a_large_table_is_never_none(spark):
    ids = spark.range(200_000).withColumn("key", F.col("id"))
    for total in (400_000, 10**6, 4 * 10**8):
        n = ids.where(drawn(F.col("key"), 8, 12_000, total)).count()
        assert abs(n - 200_000 * 12_000 / total) <= 5 * (200_000 * 12_000 / total) ** 0.5 + 1
    # Of so many rows the hash lets some through: the threshold is above 0.
    for total in (10**9, 2 * 10**10, 10**15):
        assert (1 << 63) * 12_000 // total > 0
        per_lang = ids.withColumn("total", F.lit(total)).where(drawn(F.col("key"), 9, 1000, F.col("total"))).count()
        assert per_lang == ids.where(drawn(F.col("key"), 9, 1000, total)).count()
    assert ids.where(drawn(F.col("key"), 8, 10, 10)).count() >= 199_990


def test_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(1, 1), (2, 0), (None, 1), (9, None), (12, 7)], "doc_id bigint, quality int")
    model = fit_quality(odd, labels)
    assert {r.score for r in score_quality(odd, model).where("doc_id in (3, 4)").collect()} == {model.score("")}
    kept = keep_quality(odd, QualityModel(bias=1.0))
    assert kept.schema == odd.schema and kept.count() == odd.count()
    assert keep_quality(odd, QualityModel(bias=-1.0)).count() == 0
    assert score_quality(none, model).count() == 0 and fit_quality(none, labels).score("x") == 0.5
