"""Importance resampling: the whole contract by loops, brackets that widen, ranks."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter
from zlib import crc32

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tests.llm.conftest import prose, rows
from tripscope.llm import importance
from tripscope.llm.importance import bucket_counts, cutoff, draw_order, feature_buckets, numbered, op11_importance, resample

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def features(text: str | None) -> tuple[int, list[int]]:
    w = WORDS.findall((text or "").translate(FOLD))
    return len(w), [crc32(f.encode()) % 10_000 for f in w + [f"{a} {b}" for a, b in zip(w, w[1:])]]


def brute(docs: list[tuple], target: list, seed: int = 7) -> dict:
    """(doc_id, text) rows of distinct doc_id -> n_features, weight, score, rank."""
    s = Counter(b for _, t in docs for b in features(t)[1])
    t = Counter(b for x in target for b in features(x)[1])
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (s_all + 10_000) / ((s[b] + 1) * (t_all + 10_000)))) for b in range(10_000)]
    out, able = {}, []
    for key, text in docs:
        n, found = features(text)
        weight = sum(gain[b] for b in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out[key] = [len(found), weight, score, None]
        if n >= 20:
            able.append((-score, key is None, key))
    able.sort()
    for i, (_, _, key) in enumerate(able[: 25 * len(able) // 100]):
        out[key][3] = i + 1
    return out


def found(df) -> dict:
    return {r.doc_id: [r.n_features, r.weight, r.score, r["rank"]] for r in df.collect()}


def test_query_equals_loops(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    target = [r.text for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    assert found(op11_importance(spark, SF_SMALL)) == brute([tuple(r) for r in docs], target)


def test_pieces_do_not_change_the_features():
    r = random.Random(5)
    text = "".join(r.choice(["Ab", "é9", " ", "-", "\n", "\x00", "中文", "[", "~", "zz"]) for _ in range(3000))
    n, want = features(text)
    for piece in (1, 7, 100, 1 << 20):
        got = list(feature_buckets(text.encode(), piece=piece))
        assert sum(w for w, _ in got) == n and Counter(b for _, x in got for b in x.tolist()) == Counter(want)
    assert list(feature_buckets(b"")) == [] and list(feature_buckets(b" -\x00 ")) == []


@pytest.mark.parametrize("accuracy,margin", [(10_000, 2), (50, 0.001), (100, 0.5)])
def test_cutoff_is_exact_whatever_the_sketch_says(spark, accuracy, margin):
    made = [(int(1000 * random.Random(i).gauss(0, 1)) // 50 if i % 3 else 7, i % 50 if i % 4 else None, i) for i in range(5000)]
    df = spark.createDataFrame(made, "score long, key long, row long").repartition(5)
    order = sorted(made, key=lambda x: (-x[0], x[1] is None, x[1] or 0, x[2]))
    for k in (1, 7, 1250, 2600, 4999, 5000):
        assert tuple(cutoff(df, k, len(made), accuracy=accuracy, margin=margin)) == order[k - 1]


def test_numbered_is_whole_and_in_order_with_a_hot_key(spark):
    made = [(5 if i % 3 else i, None if i % 3 else i, i) for i in range(3000)]
    df = spark.createDataFrame(made, "score long, key long, row long").repartition(7)
    got = [(r.score, r.key, r.row) for r in numbered(df, draw_order(), "n", "test-numbered").orderBy("n").collect()]
    assert got == sorted(made, key=lambda x: (-x[0], x[1] is None, x[1] or 0, x[2]))
    # the rows of the hot key and score are dealt over several partitions (small
    # ones are put together afterwards, which is left out here)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        parts = df.orderBy(*draw_order()).where("score = 5").select(F.spark_partition_id().alias("p")).distinct().count()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert parts > 1


def test_only_the_bracket_is_sorted_for_the_cutoff(spark, monkeypatch):
    sizes = {}
    plain = importance.written

    def watched(df, name):
        out = plain(df, name)
        sizes[name] = out.count()
        return out

    monkeypatch.setattr(importance, "written", watched)
    docs = spark.createDataFrame([(i, prose(i, 25)) for i in range(2000)], "doc_id long, text string")
    got = resample(docs, docs.limit(5))
    assert got.where("rank is not null").count() == 500
    assert sizes["importance-bracket"] < 20 and sizes["importance-drawn"] == 500


def test_odd_rows(spark, odd, none):
    target = spark.createDataFrame([(None,), ("",), (prose(2, 30),)], "text string")
    got = resample(odd, target).collect()
    assert len(got) == odd.count()
    n = sum(features(t)[0] >= 20 for _, t, *_ in rows())
    assert sorted(r["rank"] for r in got if r["rank"]) == list(range(1, n * 25 // 100 + 1))
    assert all((r.n_features, r.weight, r["rank"]) == (0, 0, None) for r in got if r.doc_id in (3, 4, 8))
    twice = [r for r in got if r.doc_id == 5]
    assert len(twice) == 2 and twice[0].score == twice[1].score
    every = resample(odd, target, percent=100, min_words=0).collect()
    assert sorted(r["rank"] for r in every) == list(range(1, len(rows()) + 1))
    assert resample(none, target).count() == 0
    empty = resample(odd, none.select("text", F.lit("x").alias("key")))
    assert empty.count() == odd.count() and bucket_counts(none).sum() == 0
