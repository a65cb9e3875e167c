"""Fingerprints: entropies by direct counts, the edited text by a loop."""

from __future__ import annotations

import hashlib
import math
import random
from collections import Counter

import numpy as np

from tests.llm.conftest import prose
from tripscope.llm.digests import BINS, WINDOW, Block, Fingerprinter, compare_neighbours, fingerprints, likeness, rarity


def test_entropies_equal_direct_counts():
    r = np.random.default_rng(0)
    texts = [bytes(r.integers(0, k, n, dtype=np.uint8)) for k, n in ((3, 0), (5, 63), (5, 64), (7, 300), (250, 200), (1, 100))]
    block = Block(texts)
    bins = block.bins()
    for t, a in zip(texts, block.starts, strict=True):
        for i in range(len(t) + 1):
            if i + WINDOW > len(t):
                assert bins[a + i] == -1
                continue
            c = Counter(t[i : i + WINDOW])
            h = -sum(n / WINDOW * math.log2(n / WINDOW) for n in c.values())
            assert abs(bins[a + i] - h / 6 * (BINS - 1)) <= 1.001


def test_likeness():
    maker = Fingerprinter(rarity(np.arange(BINS)))
    a, b = prose(1, 900).encode(), prose(2, 900).encode()
    half = a[: len(a) // 2] + b[: len(b) // 2]
    moved = b"some words in front of it " + a
    da, db, dh, dm, empty, short = maker.digests([a, b, half, moved, b"", b"tiny"])
    assert likeness(da, da) == 1.0 == likeness(empty, empty) == likeness(short, short)
    assert likeness(da, db) < 0.1 and 0.3 < likeness(da, dh) < 0.9 and likeness(da, dm) > 0.8
    assert likeness(empty, da) == 0.0 and 0 <= likeness(short, da) <= 1
    assert maker.digests([a])[0][0].tobytes() == da[0].tobytes()  # alone as in company


def brute(docs):
    h = sorted(docs, key=lambda d: (d[0] is None, -(d[0] or 0)))
    out = []
    for i, (k, t) in enumerate(h):
        t, n = t or "", h[(i + 1) % len(h)][1] or ""
        e = t[: len(t) - len(t) // 2] + n[: len(t) // 2]
        out.append((str(k), len(t), hashlib.sha256(e.encode()).hexdigest()))
    return sorted(out)


def test_neighbours_across_partitions(spark):
    r = random.Random(3)
    docs = [(i * 7 + r.randrange(5), prose(i % 20, r.randint(0, 80))) for i in range(120)] + [(None, "no id here")]
    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(5)
    got = compare_neighbours(df).collect()
    assert sorted((str(x.doc_id), x.n_chars, x.edited_sha256) for x in got) == brute(docs)
    text = dict(docs)
    by: dict = {}
    for x in got:
        by.setdefault(text[x.doc_id], set()).add(x.fingerprint)
        assert 0 <= x.near_edited <= 1 and 0 <= x.near_next <= 1
    assert all(len(v) == 1 for v in by.values())


def test_odd_rows(odd, none, spark):
    out = compare_neighbours(odd)
    assert out.count() == odd.count() and compare_neighbours(none).count() == 0
    alone = spark.createDataFrame([(1, "ab cd")], "doc_id bigint, text string")
    assert compare_neighbours(alone).first().edited_sha256 == hashlib.sha256(b"ab ab").hexdigest()
    assert fingerprints(odd, histogram=np.ones(BINS, np.int64)).count() == odd.count()
