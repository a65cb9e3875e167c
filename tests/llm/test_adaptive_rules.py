"""Adaptive rules: counts by loops, quantiles by sorting, limits per group."""

from __future__ import annotations

import re
from collections import Counter

from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tests.llm.conftest import prose, rows
from tripscope.llm.adaptive_rules import (
    RULES, adaptive_limits, judge, measured, merged, op13_adaptive_rules, sketch_bucket, sketch_quantiles, sketched,
)

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def counts(text: str | None) -> tuple:
    text = text or ""
    w = WORDS.findall(text)
    windows = list(zip(w, w[1:], w[2:]))
    often = Counter(windows)
    covered = {i + k for i, x in enumerate(windows) if often[x] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if WORDS.search(x)]
    return (
        len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines), len(lines) - len(set(lines)), len(covered)
    )


def test_counts_equal_loops(spark, odd, none):
    found = measured(odd).collect()
    assert len(found) == odd.count()
    want = Counter((k, g, s, *counts(t)) for k, t, g, s, _ in rows())
    assert Counter(tuple(r) for r in found) == want
    assert measured(none).count() == 0
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    want = {r.doc_id: counts(r.text) for r in docs.collect()}
    assert {r.key: tuple(r)[3:] for r in measured(docs).collect()} == want


def test_repeats_overlap_and_touch(spark):
    texts = ["a b c a b c", "a a a a", "a a a", "a b c d", "x a b c y a b c z", "a b a b a b", " ".join(["q"] * 3000)]
    df = spark.createDataFrame([(i, t, "en", "s") for i, t in enumerate(texts)], "doc_id int, text string, lang string, source string")
    found = {r.key: r.n_repeat_words for r in measured(df).collect()}
    assert found == {i: counts(t)[5] for i, t in enumerate(texts)} and found[0] == 6 and found[4] == 6 and found[6] == 3000


def test_sketch_quantiles_are_near_sorted_ones_and_merge(spark):
    values = [(i * i * 37) % 100_003 for i in range(4000)] + [0] * 300
    df = spark.createDataFrame([("ab"[i % 2], v) for i, v in enumerate(values)], "g string, v long")
    buckets = df.select("v", sketch_bucket(F.col("v")).alias("b")).collect()
    assert all(r.b <= r.v <= r.b + r.b / 64 for r in buckets)
    halves = [sketched(df.where(f"g = '{g}'"), ["g"], {"m": F.col("v")}) for g in "ab"]
    assert Counter(merged(halves, ["g"]).collect()) == Counter(sketched(df, ["g"], {"m": F.col("v")}).select("g", "measure", "bucket", "n").collect())
    (row,) = sketch_quantiles(merged(halves), [], [10, 50, 90, 100]).collect()
    values.sort()
    assert row.total == len(values)
    for p in (10, 50, 90, 100):
        exact = values[-(-len(values) * p // 100) - 1]
        assert row[f"p{p}"] <= exact <= row[f"p{p}"] * 65 / 64 + 1


def test_limits_follow_their_group_and_small_groups_the_coarser_one(spark):
    made = [("en", "a", 1000 + i % 100) for i in range(300)] + [("en", "b", 9000)] * 5 + [(None, None, 5000 + i % 10) for i in range(200)]
    df = spark.createDataFrame(made, "lang string, source string, v long")
    rule = RULES[1]
    sketch = sketched(df, ["lang", "source"], {rule.name: F.col("v")})
    got = {(r.lang, r.source): r for r in adaptive_limits(sketch, ["lang", "source"], [rule], min_rows=100).collect()}
    assert set(got) == {("en", "a"), ("en", "b"), (None, None)}
    assert got["en", "a"].high_word_length == got["en", "b"].high_word_length < 9000
    assert got[None, None].low_word_length > got["en", "a"].high_word_length
    coarse = {r.high_word_length for r in adaptive_limits(sketch, ["lang", "source"], [rule], min_rows=10_000).collect()}
    assert len(coarse) == 1


def test_hot_source_with_bad_documents(spark):
    """A third of a hot source is junk: it goes, the rest stays."""
    made = [(i, prose(i, 60), "en", "hot") for i in range(200)]
    made += [(1000 + i, " ".join(w + "###" for w in prose(i, 60).split()), "en", "hot") for i in range(90)]
    df = spark.createDataFrame(made, "doc_id long, text string, lang string, source string")
    got = judge(df).collect()
    assert {r.doc_id for r in got if r.kept} == set(range(200))
    assert all("symbols" in r.failed for r in got if r.doc_id >= 1000)


def test_odd_rows(spark, odd, none):
    got = judge(odd)
    assert got.count() == odd.count() and judge(none).count() == 0
    assert all(r.base_failed and not r.kept for r in got.where("doc_id in (3, 4, 8)").collect())
    twice = got.where("doc_id = 5").collect()
    assert len(twice) == 2 and twice[0] == twice[1]


def test_query_runs_in_the_jvm(spark):
    plan = op13_adaptive_rules(spark, SF_SMALL)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "InArrow" not in plan
