"""Line dedup against brute force over all pairs of lines."""

from __future__ import annotations

import random
import time
from collections import Counter

import numpy as np

from tests.llm.conftest import prose
from tripscope.llm import line_dedup
from tripscope.llm.line_dedup import Lines, dedup_lines, edit_distances


def distance(a, b):
    p = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        q = [i]
        for j, y in enumerate(b, 1):
            q.append(min(p[j] + 1, q[-1] + 1, p[j - 1] + (x != y)))
        p = q
    return p[-1]


def edited(r, s, n):
    s = list(s)
    for _ in range(n):
        i = r.randrange(len(s) + 1)
        k = r.randrange(3)
        if k == 0:
            s.insert(i, r.choice("abcé"))
        elif i < len(s):
            s[i : i + 1] = [] if k == 1 else [r.choice("abcé")]
    return "".join(s)


def test_banded_distance_and_complete_segments():
    r = random.Random(3)
    for most in (1, 2, 3):
        pairs = []
        for _ in range(400):
            a = "".join(r.choice("abé") for _ in range(r.randint(0, 30)))
            pairs.append((a, edited(r, a, r.randint(0, most + 2))))
        want = np.array([min(distance(a, b), most + 1) for a, b in pairs])
        assert (edit_distances([a for a, _ in pairs], [b for _, b in pairs], most) == want).all()
        for (a, b), d in zip(pairs, want, strict=True):
            if d <= most and min(len(a), len(b)) >= 8:
                short, other = sorted((a, b), key=len)
                lines = Lines([short, other], 8)
                index, _ = lines.index(np.array([0]), most)
                probes, _ = lines.probes(np.array([1]), most, 8)
                assert set(index.tolist()) & set(probes.tolist()), (a, b)


def names(texts, least):
    lines = Lines(["\n".join(texts)], least)
    return dict(zip(texts, zip(lines.name1.view(np.int64).tolist(), lines.name2.tolist(), strict=True), strict=True)) if texts else {}


def brute(docs, most=2, least=line_dedup.MIN_CHARS):
    """Per document: dropped lines, the text without them, and for each dropped
    line the document that stands for it.  Of equal lines (of any length but 0) the
    first stays; of near ones (of ``least`` code points or more) the smaller name,
    decided in the order of names (``greedy``)."""
    lines = [(k, i, x) for k, t in docs for i, x in enumerate((t or "").split("\n")) if x]
    first = {}
    for k, i, x in sorted(lines, key=lambda y: (y[0], y[1])):
        first.setdefault(x, (k, i))
    gone = greedy([x for x in first if len(x) >= least], most, least)
    out = {}
    for k, t in docs:
        drop, twins = [], []
        for i, x in enumerate((t or "").split("\n")):
            if x and (first[x] != (k, i) or x in gone):
                drop.append(i)
                twins.append(first[gone.get(x, x)][0])
        kept = None if t is None else "\n".join(x for i, x in enumerate(t.split("\n")) if i not in set(drop))
        out[k] = (drop, kept, sorted(set(twins)))
    return out


def test_equals_brute_force(spark):
    r = random.Random(8)
    pool = [prose(100 + i, 12) for i in range(12)]
    docs = []
    for k in range(60):
        some = [edited(r, r.choice(pool), r.choice((0, 0, 1, 2, 3))) for _ in range(r.randint(0, 4))]
        docs.append((k, "\n".join(some + ["short", ""][: r.randint(0, 2)])))
    docs += [(70, None), (71, ""), (72, "\n\n")]
    df = dedup_lines(spark.createDataFrame(docs, "doc_id bigint, text string"))
    want = brute(docs)
    assert sum(len(x[0]) for x in want.values()) > 30
    for row in df.collect():
        drop, kept, twins = want[row.doc_id]
        assert (row.dropped_lines, row.text, row.twin_ids) == (drop, kept, twins), row.doc_id


def test_many_repeats_in_one_text_are_cut_in_linear_time(spark):
    n = 80_000
    df = spark.createDataFrame([(1, "\n".join(["the same line", "another line"] * (n // 2))), (2, "another line")], "doc_id bigint, text string")
    started = time.time()
    by = {r.doc_id: r for r in dedup_lines(df).collect()}
    assert by[1].text == "the same line\nanother line" and by[1].dropped_lines == list(range(2, n)) and by[2].text == ""
    assert time.time() - started < 60


def test_odd_rows_and_clashing_columns(odd, none):
    out = dedup_lines(odd, dropped_as="d", twins_as="l")
    assert out.columns == [*odd.columns, "d", "l"] and out.count() == odd.count()
    by = {r.doc_id: r for r in out.collect()}
    # both lines of document 13 are copies of document 1; document 7 is further
    # from it than two edits
    assert by[13].d == [2, 3] and by[13].l == [1] and by[13].text == "\n\nend" and by[3].text is None and by[1].d == []
    assert by[2].text == odd.where("doc_id = 2").first().text  # other case, other line
    assert dedup_lines(none).count() == 0


def family(seed, n):
    """Variants of some lines, each within two edits of its own line."""
    r = random.Random(seed)
    pool = [prose(200 + seed + i, 12) for i in range(3)]
    return [edited(r, r.choice(pool), r.randint(0, 2)) for _ in range(n)]


def links_of(texts, most=2, least=32):
    """Every pair of different texts within ``most`` edits, the smaller name first."""
    texts = sorted({x for x in texts if len(x) >= least})
    name = names(texts, least)
    return {
        tuple(sorted((x, y), key=name.get))
        for i, x in enumerate(texts) for y in texts[:i] if abs(len(x) - len(y)) <= most and distance(x, y) <= most
    }


def test_all_links_are_found_and_counted(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(line_dedup, "HOT_PROBES", 3)
    lines = family(4, 60)
    docs = [(k, "\n".join(lines[k : k + 1 + k % 3] + ["short"])) for k in range(60)]
    docs += [(60, None), (61, docs[0][1]), (62, "\n")]
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    want = links_of([x for _, t in docs for x in (t or "").split("\n")])
    assert len(want) > 100
    by = {v: k for k, v in names(sorted({x for p in want for x in p}), 32).items()}
    found = line_dedup.near_lines(line_dedup._rows(df, "doc_id", "text"), max_edits=2, min_chars=32).collect()
    pair = lambda a, b: by[a, b % (1 << 64)]
    assert len(found) == len(want) and {(pair(r.a1, r.a2), pair(r.b1, r.b2)) for r in found} == want
    degree = Counter(x for p in want for x in p)
    df.write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r.n_links for r in line_dedup.op2_line_dedup(spark, str(tmp_path)).collect()}
    assert got == {k: sum(degree[x] for x in (t or "").split("\n")) for k, t in docs}


def greedy(texts, most=2, least=32):
    """In the order of names: a text stays unless one near it does.  {text that
    goes: the smallest text near it that stays}"""
    name, out, stay = names(sorted(set(texts)), least), {}, {}
    letters = {x: Counter(x) for x in name}
    apart = lambda x, y: max((letters[x] - letters[y]).total(), (letters[y] - letters[x]).total())
    for x in sorted(name, key=name.get):
        others = [y for n in range(len(x) - most, len(x) + most + 1) for y in stay.get(n, ())]
        near = [y for y in others if apart(x, y) <= most and distance(x, y) <= most]
        if near:
            out[x] = min(near, key=name.get)
        else:
            stay.setdefault(len(x), []).append(x)
    return out


def test_each_dropped_line_has_a_kept_one_near_it(spark):
    base, chains = prose(77, 12), []
    for c in "ABCD":  # steps of two edits: neighbours are near, others are not
        line = c + base
        for k in range(12):
            chains.append(line)
            line = line[: 3 * k + 1] + "##" + line[3 * k + 3 :]
    docs = [(k, x) for k, x in enumerate(chains + family(9, 40))]
    docs += [(100 + k, x) for k, x in docs[::5]]  # exact repeats stand behind
    out = line_dedup.dedup_lines(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()
    text, stays = dict(docs), {r.doc_id for r in out if not r.dropped_lines}
    near = lambda a, b: distance(text[a], text[b]) <= 2
    for r in out:
        if r.dropped_lines:
            assert len(r.twin_ids) == 1 and r.twin_ids[0] in stays and near(r.doc_id, r.twin_ids[0])
    assert not any(a != b and near(a, b) for a in stays for b in stays)
    gone = greedy(x for _, x in docs)
    first = {x: k for k, x in reversed(docs)}
    assert stays == {k for x, k in first.items() if x not in gone} and len(gone) > 30
    want = {r.doc_id: [first[gone.get(text[r.doc_id], text[r.doc_id])]] for r in out if r.dropped_lines}
    assert {r.doc_id: r.twin_ids for r in out if r.dropped_lines} == want


def test_equal_lines_of_any_length_and_near_lines_above_the_least(spark):
    docs = [(1, "a\n\nMenu\nNine char"), (2, "Menu\nb\n\na"), (3, "a\nMenus"), (4, "Nine chart"), (5, " \n "), (6, None)]
    out = line_dedup.dedup_lines(spark.createDataFrame(docs, "doc_id bigint, text string"), links_as="n_links")
    by = {r.doc_id: r for r in out.collect()}
    assert [by[k].dropped_lines for k in (2, 3, 5, 6)] == [[0, 3], [0], [1], []]
    assert by[2].text == "b\n" and by[2].twin_ids == [1] and by[3].text == "Menus" and by[1].text.startswith("a\n\nMenu")
    # nine code points have near lines, five have not
    assert line_dedup.MIN_CHARS == 9 and len(by[1].dropped_lines) + len(by[4].dropped_lines) == 1
    assert [by[k].n_links for k in range(1, 7)] == [1, 0, 0, 1, 0, 0]


def test_repeats_meet_once_and_hot_segments_are_dealt(spark, monkeypatch):
    kept = {}

    def spy(df, name, f=line_dedup.written):
        kept[name] = f(df, name)
        return kept[name]

    monkeypatch.setattr(line_dedup, "written", spy)
    monkeypatch.setattr(line_dedup, "HOT_PROBES", 4)
    opening = prose(5, 12)[:40]
    texts = [opening + prose(300 + i, 9)[:40] for i in range(40)]  # one opening, one length, no links
    df = spark.createDataFrame([(k, t) for k in range(20) for t in texts], "doc_id bigint, text string").repartition(8)
    rows = line_dedup._rows(df, "doc_id", "text")
    assert line_dedup.near_lines(rows, max_edits=2, min_chars=32).count() == 0
    meet = kept["lines-meet"]
    assert meet.count() == meet.distinct().count() and meet.groupBy("seg").count().agg({"count": "max"}).first()[0] <= 80
    assert kept["lines-parts"].agg({"parts": "max"}).first()[0] == 10


def test_an_edit_changes_four_grams_at_most(spark):
    r = random.Random(12)
    texts = ["".join(r.choice("abcé z😀") for _ in range(r.randint(9, 40))) for _ in range(300)]
    for most in (1, 2):
        lines = Lines([x for t in texts for x in (t, edited(r, t, most))], 0)
        grams = lines.grams(np.arange(len(lines.start)))
        assert (np.bitwise_count(grams[::2] ^ grams[1::2]) <= 4 * most).all() and len(set(grams.tolist())) > 500
    assert Lines(["", "x"], 0).grams(np.arange(2)).tolist() == [0, 0]


def test_variants_of_one_line_with_a_word_each_do_not_all_meet(spark, monkeypatch):
    kept = {}

    def spy(df, name, f=line_dedup.written):
        kept[name] = f(df, name)
        return kept[name]

    monkeypatch.setattr(line_dedup, "written", spy)
    r, base, texts = random.Random(13), prose(6, 60), set()
    while len(texts) < 200:
        at = r.randrange(len(base))
        texts.add(base[:at] + "".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(4)) + base[at:])
    texts = sorted(texts)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    links = line_dedup.near_lines(line_dedup._rows(df, "doc_id", "text"), max_edits=2, min_chars=9).count()
    both = [(a, b) for i, a in enumerate(texts) for b in texts[:i]]
    assert links == (edit_distances([a for a, _ in both], [b for _, b in both], 2) <= 2).sum()
    assert kept["lines-pairs"].count() < len(texts) * (len(texts) - 1) / 2 / 5


def plain(points, factor):
    """Sum of a line's or substring's points under powers of a factor."""
    return sum((p + 1) * pow(factor, i, 1 << 64) for i, p in enumerate(points)) % (1 << 64)


def test_names_and_keys_equal_plain_sums_whatever_stands_beside(spark):
    r = random.Random(14)
    mixed = lambda x: int(line_dedup._mixed(np.array([x % (1 << 64)], np.uint64))[0])
    for letters in ("ab \n", "aé\nÿ\0", "a\u2013é😀\n", "ab\ud800\n"):
        texts = ["".join(r.choice(letters) for _ in range(r.randint(0, 40))) for _ in range(30)]
        lines = Lines(texts, 0)
        of = [(i, j, x) for i, t in enumerate(texts) for j, x in enumerate(t.split("\n"))]
        assert [(a, b, lines.text_of(k)) for k, (a, b) in enumerate(zip(lines.text, lines.number, strict=True))] == of
        for k, (_, _, x) in enumerate(of):
            one, two = (mixed(plain(map(ord, x), f) + len(x)) for f in line_dedup._FACTORS)
            sign = 0
            for c in x:
                sign ^= 1 << mixed(ord(c) + 1) % line_dedup.SIGNATURE
            assert int(lines.name1[k]) == sign << 40 | one >> 24 and int(lines.name2[k]) == two
        keys, rows = lines.index(np.arange(len(of)), 2)
        for n, (key, k) in enumerate(zip(keys.tolist(), rows.tolist(), strict=True)):
            x, i = of[k][2], n // len(of)
            at, size = (int(v[0]) for v in line_dedup.segment(np.array([len(x)]), i, 3))
            h = plain(map(ord, x[at : at + size]), line_dedup._FACTORS[0])
            assert key == mixed(mixed(h + len(x) * line_dedup._FACTORS[1]) + i + 1)
        # Beside points of any size: the same names, keys and grams.
        beside = Lines([*texts, "\u4e2d😀"], 0)
        n = np.arange(len(of))
        assert (beside.name1[n] == lines.name1).all() and (beside.name2[n] == lines.name2).all()
        assert all((a == b).all() for a, b in zip(beside.probes(n, 2, 0), lines.probes(n, 2, 0), strict=True))
        assert (beside.grams(n) == lines.grams(n)).all()


def test_names_cost_less_than_sums_before_every_point(spark):
    texts = [prose(400 + i, 3000) + "\n" + prose(500 + i, 30) for i in range(30)]
    table, n = np.arange(0x110000, dtype=np.uint32), sum(map(len, texts)) + len(texts)
    weights = np.arange(n, dtype=np.uint64)

    def every_point():
        points = np.frombuffer("\n".join([*texts, ""]).encode("utf-32-le"), np.uint32)
        np.cumsum((points.astype(np.uint64) + np.uint64(1)) * weights)
        np.bitwise_xor.accumulate(table[points])

    def least(f):
        spent = []
        for _ in range(9):
            started = time.process_time()
            f()
            spent.append(time.process_time() - started)
        return min(spent)

    assert least(lambda: Lines(texts, 9)) < 0.8 * least(every_point)
