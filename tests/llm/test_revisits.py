"""Revisit resolution against a loop over records in order of time."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tripscope.llm.revisits import RECORD, canonical_url, op4_revisits, resolve_revisits


def head(**fields):
    return [(k.replace("_", "-"), v) for k, v in fields.items()]


def brute(records):
    out = []
    url = lambda u: u.lower().split("#")[0].removeprefix("http://").removeprefix("www.").rstrip("/")
    for i, u, ts, kind, h in records:
        if kind != "revisit":
            continue
        earlier = [
            r for r in records if r[3] == "response" and None not in (u, ts, r[1], r[2]) and url(r[1]) == url(u) and r[2] < ts
        ]
        best = max(earlier, key=lambda r: (r[2], r[0]), default=None)
        h = dict(h or [])
        if best is None:
            state = "no earlier response"
        else:
            old = dict(best[4] or [])
            if "etag" in h:
                state = "resolved" if (old.get("etag") or "?").removeprefix("W/") == h["etag"].removeprefix("W/") else "validators differ"
            elif "last-modified" in h:
                state = "resolved" if old.get("last-modified") == h["last-modified"] else "validators differ"
            else:
                state = "unvalidated"
        out.append((i, best and best[0], state))
    return sorted(out)


def test_equals_a_loop_and_spreads_a_hot_url(spark):
    r = random.Random(4)
    records = []
    for i in range(300):
        u = "http://hot.org/a" if i % 3 else f"http://www.site{r.randrange(5)}.org/p/"
        h = head(etag=r.choice(('"x"', 'W/"x"', '"y"'))) if r.random() < 0.6 else head(last_modified=r.choice("ab")) if r.random() < 0.8 else None
        records.append((i, u + r.choice(("", "#f")), r.randrange(60), r.choice(("response", "revisit", "other")), h))
    records += [(900, None, 3, "revisit", None), (901, "http://hot.org/a", None, "revisit", None), (902, "http://hot.org/a", None, "response", None)]
    df = spark.createDataFrame(records, RECORD)
    for ranges in (1, 8, 64):
        got = sorted((x.record_id, x.response_id, x.outcome) for x in resolve_revisits(df, ranges=ranges).collect())
        assert got == brute(records)


def test_headers_are_merged_by_rule(spark):
    full = head(Content_Length="9", ETag='"x"', Cache_Control="old", Age="1")
    light = head(etag='W/"x"', Content_Length="0", cache_control="new", Set_Cookie="s", Date="d")
    df = spark.createDataFrame(
        [(1, "http://a/", 1, "response", full), (2, "https://www.a", 2, "revisit", light), (2, "https://www.a", 2, "revisit", light)], RECORD
    )
    got = resolve_revisits(df.selectExpr("*", "1 AS url_key", "2 AS full")).collect()
    assert len(got) == 2 and got[0] == got[1]
    assert sorted(map(tuple, got[0].headers)) == sorted(
        [("Content-Length", "9"), ("Age", "1"), ("etag", 'W/"x"'), ("cache-control", "new"), ("Date", "d")]
    )


def test_canonical_urls(spark):
    same = ["http://www.Example.com:80/a/?b=2&a=1&utm_source=x#t", "HTTPS://m.example.com/a?a=1&b=2", "//", None, ""]
    df = spark.createDataFrame([(s,) for s in same], "u string").select(canonical_url(F.col("u")))
    got = [r[0] for r in df.collect()]
    assert got[0] == got[1] == "example.com/a?a=1&b=2" and got[3] is None and got[4] == ""


def test_empty_and_registered(spark):
    assert resolve_revisits(spark.createDataFrame([], RECORD)).count() == 0
    out = op4_revisits(spark, SF_SMALL)
    assert out.count() == spark.read.parquet(f"{SF_SMALL}/pages.parquet").count()
