"""Block naming against grouping by the whole normalised text."""

from __future__ import annotations

import hashlib
import random
import string

import pytest

from tripscope.llm.block_naming import exact_duplicates

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def expected(pairs):
    groups: dict = {}
    for k, t in pairs:
        groups.setdefault((t or "").translate(LOWER), []).append(k)
    out = []
    for t, keys in groups.items():
        top = max((k for k in keys if k is not None), default=None)
        out += [(k, top, len(keys), hashlib.sha256(t.encode()).hexdigest()) for k in keys]
    return sorted(out, key=str)


def got(df):
    return sorted([(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in df.collect()], key=str)


@pytest.mark.parametrize("block", [16, 8192])
def test_equals_grouping_by_text(spark, block):
    r = random.Random(5)
    texts = ["".join(r.choice("aAbéÉ") for _ in range(r.choice((0, 1, 15, 16, 17, 60, 150)))) for _ in range(60)]
    texts += [texts[i] for i in range(0, 60, 3)] + [texts[5].swapcase(), None, None, "ab" * 40, "ab" * 41]
    pairs = list(enumerate(texts))
    df = exact_duplicates(spark.createDataFrame(pairs, "doc_id bigint, text string"), block_bytes=block)
    assert got(df) == expected(pairs)
    kept = df.where("kept").count()
    assert kept == df.select("text_sha256").distinct().count()


def test_odd_rows(odd):
    df = exact_duplicates(odd)
    pairs = [(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()]
    assert got(df) == expected(pairs)
    # of repeated rows one stays
    assert [r.kept for r in df.where("doc_id = 5").collect()].count(True) == 1


def test_empty_table(none):
    assert exact_duplicates(none).count() == 0
