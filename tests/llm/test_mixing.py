"""Mixing: targets by a loop, flows by enumeration, sums near the targets."""

from __future__ import annotations

import itertools
import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_MID
from tripscope.llm.common import word_count
from tripscope.llm.mixing import mix, op10_mixing, quotas, route


def test_quotas_share_the_excess():
    r = random.Random(1)
    for _ in range(200):
        sizes = {s: r.choice((0, 1, 10, 100, 1000)) for s in "abcdef"}
        weights = {s: r.choice((5, 2, 1)) for s in sizes}
        total = sum(sizes.values())
        q = quotas(sizes, weights, total, 3)
        assert sum(q.values()) == pytest.approx(total)
        assert all(q[s] <= 3 * sizes[s] + 1e-9 for s in sizes)
        free = [q[s] / weights[s] for s in sizes if q[s] < 3 * sizes[s] - 1e-9]
        assert all(x == pytest.approx(free[0]) for x in free)


def test_route_costs_least():
    r = random.Random(2)
    cost = lambda t, w: sum(c * max(0, min(w, t - i * w)) for i, c in enumerate((0, 1, 3)))
    for _ in range(40):
        patterns = [(("a",), r.randint(0, 3)), (("b",), r.randint(0, 3)), (("a", "b"), r.randint(0, 3))]
        a, b, ab = (w for _, w in patterns)
        quota = {"a": r.randint(0, 3 * a + ab), "b": r.randint(0, 3 * b + ab)}
        got = route(patterns, quota)
        best = min(
            cost(x, a) + cost(y, b) + cost(z, ab)
            for x, y, z in itertools.product(range(3 * a + 1), range(3 * b + 1), range(3 * ab + 1))
            if x <= quota["a"] and y <= quota["b"] and x + y + z == sum(quota.values())
        )
        assert sum(got) == sum(quota.values())
        assert sum(cost(t, w) for t, (_, w) in zip(got, patterns, strict=True)) == best


def test_query_sums_near_targets_and_reruns_agree(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    out = op10_mixing(spark, SF_MID)
    rows = out.join(docs.select("doc_id", "source"), "doc_id").collect()
    assert len(rows) == docs.count()
    sums: dict = {}
    for r in rows:
        assert 0 <= r.taken <= 3 * r.size and (r.size == 0 or r.taken % r.size == 0)
        s = sums.setdefault(r.source, [0, 0, r.source_size, r.target])
        s[0], s[1] = s[0] + r.taken, s[1] + r.size
    for taken, size, source_size, target in sums.values():
        assert size == source_size and abs(taken - target) < 0.05 * target
    again = {(r.doc_id, r.taken) for r in op10_mixing(spark, SF_MID).collect()}
    assert again == {(r.doc_id, r.taken) for r in rows}


def test_overlapping_sources(spark):
    rows = [(i, "w " * (1 + i % 9), [["a"], ["b"], ["a", "b"], ["c", None], []][i % 5]) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, belongs array<string>")
    out, quota, sizes = mix(df, size=word_count(F.col("text")), members=F.col("belongs"))
    got = out.collect()
    assert set(quota) == {"a", "b", "c", None} and len(got) == 300
    assert all(r.taken == 0 for r in got if not r.members) and all(r.taken <= 3 * r.size for r in got)
    assert abs(sum(r.taken for r in got) - sum(quota.values())) < 0.05 * sum(quota.values())


def test_repeated_rows_meet_the_target_within_one(spark):
    rows = [(1, "w " * 10, "a")] * 400 + [(i, "w " * 10, "b") for i in range(2, 202)] + [(i, "w " * 10, "c") for i in range(300, 400)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(7)
    out, quota, _ = mix(df, size=word_count(F.col("text")), members=F.array("source"))
    got = out.collect()
    for s, target in quota.items():
        assert abs(sum(r.taken for r in got if r.members == [s]) - target) <= 10, s
    table = lambda o: sorted((r.doc_id, r.size, r.taken) for r in o.collect())
    again, _, _ = mix(df.repartition(3), size=word_count(F.col("text")), members=F.array("source"))
    assert table(again) == table(out)


def test_odd_rows(odd, none):
    out, quota, sizes = mix(odd, size=word_count(F.col("text")), members=F.array("source"))
    assert set(quota) == {"a", "b", "c", None} and out.count() == odd.count()
    assert out.where("size = 0 and taken > 0").count() == 0
    empty, quota, _ = mix(none, size=word_count(F.col("text")), members=F.array("source"))
    assert quota == {} and empty.count() == 0
