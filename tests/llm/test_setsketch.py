"""SetSketch near-dedup against exact links and components."""

from __future__ import annotations

import random
import re
import string

import numpy as np

from tests.llm.conftest import prose
from tripscope.llm import setsketch
from tripscope.llm.components import stars
from tripscope.llm.setsketch import bands, merged, near_duplicates, registers, shingles, similarity_estimate, words

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def shingle_set(t):
    w = WORD.findall((t or "").translate(LOWER))
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(docs, threshold=85):
    sets = [(k, shingle_set(t)) for k, t in docs]
    root = list(range(len(sets)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, (_, a) in enumerate(sets):
        for j in range(i):
            b = sets[j][1]
            if a and b and 100 * len(a & b) >= threshold * len(a | b):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    keys: dict = {}
    for i, (k, _) in enumerate(sets):
        keys.setdefault(find(i), []).append(k)
    out = []
    for i, (k, s) in enumerate(sets):
        ids = [x for x in keys[find(i)] if x is not None]
        c = min(ids) if s and ids else (k if not s else None)
        out.append((str(k), len(s), str(c), k is not None and k == c))
    return sorted(out)


def got(df):
    return sorted((str(r.doc_id), r.n_shingles, str(r.component_id), r.kept) for r in df.collect())


def test_sketches_merge_and_estimate():
    r = np.random.default_rng(1)
    for j in (0.3, 0.7, 0.9):
        n = 4000
        shared = int(2 * n * j / (1 + j))
        pool = np.unique(r.integers(0, 1 << 63, 3 * n, dtype=np.uint64))
        a = np.sort(pool[:n])
        b = np.sort(np.concatenate([pool[:shared], pool[n : 2 * n - shared]]))
        x, y = registers(a), registers(b)
        assert (merged(x, y) == registers(np.union1d(a, b))).all()
        true = shared / (2 * n - shared)
        found = similarity_estimate(*[np.array([float(v)]) for v in ((x > y).sum(), (x < y).sum(), (x == y).sum(), n, n)])
        assert abs(found[0] - true) < 0.2
    assert len(bands(x)) == len(set(bands(x).tolist())) == setsketch.REGISTERS // setsketch.ROWS


def test_words_follow_the_rule():
    for t in ("A b\tÉ\xa0x\x1cy", "", "  ", "one\ntwo  three", "ÀB àb"):
        w = WORD.findall(t.translate(LOWER))
        assert len(words(t)[0]) == len(w) and len(shingles(words(t)[0])) == len(shingle_set(t))
    assert words("a  B")[1] == words("A\nb")[1] != words("ab")[1]


def family(seed, n, edits):
    """Copies of one text, each with some words changed."""
    r, base = random.Random(seed), prose(seed, 150).split()
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(r.randint(0, edits)):
            w[r.randrange(len(w))] = f"new{r.randrange(10**6)}"
        out.append(" ".join(w))
    return out


def test_equals_brute_force(spark, monkeypatch):
    texts = family(1, 60, 6) + family(2, 12, 3) + family(3, 3, 1) + [prose(50 + i, 40) for i in range(20)]
    texts += [texts[0].upper(), texts[3].replace(" ", "\n"), "one two three", "One  two three", None, "", " "]
    docs = list(enumerate(texts))
    random.Random(7).shuffle(docs)
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    want = brute(docs)
    assert got(near_duplicates(df)) == want
    assert got(near_duplicates(df, threshold=80)) == brute(docs, 80)
    # the exact join on rare shingles, with hardly any hubs before it
    monkeypatch.setattr(setsketch, "SMALL_BUCKET", 2)
    monkeypatch.setattr(setsketch, "HUBS", 1)
    assert got(near_duplicates(df)) == want


def test_odd_rows(odd, none):
    docs = [(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()]
    assert got(near_duplicates(odd)) == brute(docs)
    assert near_duplicates(none).count() == 0


def test_components_of_a_path_and_a_star(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7)]
    out = {r.id: r.root for r in stars(spark.createDataFrame(links, "a long, b long")).collect()}
    assert out == {i: 0 for i in range(1, 41)} | {100 + i: 100 for i in range(1, 30)}
    assert stars(spark.createDataFrame([], "a long, b long")).count() == 0


def test_repeated_rows_and_rows_without_a_key(spark, monkeypatch):
    monkeypatch.setattr(setsketch, "SMALL_BUCKET", 2)
    monkeypatch.setattr(setsketch, "HUBS", 1)
    docs = list(enumerate(family(11, 60, 12) + family(12, 50, 16))) + [(None, t) for t in family(13, 30, 10)]
    one = spark.createDataFrame(docs, "doc_id bigint, text string")
    want = brute(docs)
    assert 20 < len({c for _, _, c, _ in want}) < len(want) - 20
    df = one.crossJoin(spark.range(20).select("id")).drop("id").repartition(6)
    assert got(df.transform(near_duplicates)) == sorted(want * 20)
    # one row per class, though rows repeat and NULL keys are all alike
    rows = [(1, "a b c"), (1, "a b c"), (1, "A  b c"), (1, "d e f"), (None, "g h"), (None, "g h"), (None, "i j"), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    wanted = [(i, bytearray(words(t)[1]), k, bytearray(b"s")) for i, (k, t) in enumerate([rows[0], rows[3], rows[4], rows[6]])]
    wanted = spark.createDataFrame(wanted, "id long, class binary, rep bigint, sketch binary")
    sets = {0: "a b c", 1: "d e f", 2: "g h", 3: "i j"}
    out = setsketch._sets(docs, wanted, key="doc_id", text="text").collect()
    assert sorted((r.id, bytes(r.set)) for r in out) == [(i, shingles(words(t)[0]).tobytes()) for i, t in sets.items()]
