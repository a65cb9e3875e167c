"""Alignment of two tokenizers: the contract by loops over whole texts, the hash,
and the same result whatever the parts, shards and trees."""

from __future__ import annotations

import random
import re
from collections import Counter
from hashlib import sha256

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer, decoders

from tests.conftest import SF_SMALL
from tests.llm.conftest import rows
from tripscope.llm.alignment import TOTALS, align_tokenizers, distinct_keys, op12_alignment, slice_pairs
from tripscope.llm.perfect_hash import Places, built, shard_hash
from tripscope.llm.token_alignment import BYTE_BPE, PIECE_BPE, Aligner

A = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))

ODD_TEXTS = [
    None, "", " ", "  ", "a ", "a  ", " a", "a  b", "a\n b", "a \n b", "\n", "word", "don't  stop", "tab\tand\r\nline \r", "中文字 日本 語",
    "😀😀 👩‍👩‍👧 é é", "x" * 300, "123456 7 89", "▁already", "<unk> <s> </s> <0x41> <|endoftext|>", "  nb sp ",
    "　全角 空白　", "\x00 nul", "\x1c sep \x1d", "end.\n\n\n  Next   line", "ﬁ ligature Å Å", "--- ### $$$%%% &&&", "a" * 70 + " " + "b" * 70,
    "▁", "ı İ ß", "क्षि हिन्दी", "สวัสดีครับ", "한국어 문장", "﻿bom", "a​b c", " x  y", " \n", "trailing \n ",
]


def letters() -> dict[str, int]:
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    out, n = {chr(b): b for b in shown}, 0
    for b in range(256):
        if b not in shown:
            out[chr(256 + n)] = b
            n += 1
    return out


LETTERS = letters()


def token_ends(pieces: list[bytes]) -> list[int]:
    out, at = [], 0
    for p in pieces:
        at += len(p)
        out.append(at)
    return out


def aligned(text: str | None) -> list[tuple[list[int], list[int]]]:
    """The groups of one whole text, by loops."""
    if not text:
        return []
    a = A.encode(" " + text, add_special_tokens=False)
    ids_a, bytes_a = a.ids, [bytes(LETTERS[c] for c in t) for t in a.tokens]
    b, bytes_b = B.encode(text), []
    for i in b:
        p = B.id_to_piece(i)
        m = re.fullmatch("<0x(..)>", p)
        bytes_b.append(bytes([int(m[1], 16)]) if m and B.is_byte(i) else p.replace("▁", " ").encode())
    if not b"".join(bytes_a) == b"".join(bytes_b) == (" " + text).encode():
        return []
    ends_a, ends_b = token_ends(bytes_a), token_ends(bytes_b)
    groups, i, j = [], 0, 0
    for end in sorted(set(ends_a) & set(ends_b)):
        x, y = [], []
        while i < len(ends_a) and ends_a[i] <= end:
            x.append(ids_a[i])
            i += 1
        while j < len(ends_b) and ends_b[j] <= end:
            y.append(b[j])
            j += 1
        groups.append((x, y))
    return groups


def brute(texts: list) -> list[tuple]:
    found = [aligned(t) for t in texts]
    linked = [Counter((x, y) for g in groups for x in g[0] for y in g[1]) for groups in found]
    count = Counter(p for links in linked for p in links)
    best = {}
    for (x, _), n in count.items():
        best[x] = max(best.get(x, 0), n)
    out = []
    for groups, links in zip(found, linked):
        shown = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((
            sum(len(x) for x, _ in groups), sum(len(y) for _, y in groups), len(groups), sum(links.values()),
            sum(n for p, n in links.items() if count[p] == best[p[0]]), sum(n * count[p] for p, n in links.items()), shown,
        ))
    return out


def test_query_equals_loops(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    want = brute([r.text for r in docs])
    got = {r.doc_id: r for r in op12_alignment(spark, SF_SMALL).collect()}
    assert len(got) == len(docs)
    for r, w in zip(docs, want):
        g = got[r.doc_id]
        assert tuple(g[c] for c in TOTALS) == w[:6], r.doc_id
        assert g.groups_sha256 == (sha256(w[6].encode()).hexdigest() if w[6] else "")


@pytest.mark.parametrize("settings", [{}, {"shard_keys": 40, "fan_in": 2}, {"shard_keys": 16, "part_bytes": 16 * 20 * 3}])
def test_odd_texts_equal_loops_with_any_parts(spark, settings):
    texts = ODD_TEXTS + ODD_TEXTS[5:20] + [t for _, t, *_ in rows()]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    got = {r.doc_id: (*[r[c] for c in TOTALS], r.groups) for r in align_tokenizers(df, **settings).collect()}
    assert [got[i] for i in range(len(texts))] == brute(texts)


def test_large_groups_and_whole_texts_give_the_same(monkeypatch):
    texts = [t for t in ODD_TEXTS if t]
    aligner = Aligner(BYTE_BPE, PIECE_BPE)
    assert aligner.cuts and aligner.chunks("a  b c ") == ["a", " b", "c", ""]
    plain = aligner.align(texts)
    monkeypatch.setattr("tripscope.llm.token_alignment.LARGE_GROUP", 1)
    large = aligner.align(texts)
    for field in ("n_links", "of", "keys", "times", "n_groups"):
        assert getattr(plain, field).tolist() == getattr(large, field).tolist()
    aligner.cuts = False
    assert aligner.chunks("a b") == ["a b"] and aligner.chunks("") == []
    for t, n, g in zip(texts, plain.n_links.tolist(), plain.groups):
        assert (n, g.rstrip(";")) == (brute([t])[0][3], brute([t])[0][6])
    assert plain.spelt.tolist() == [bool(aligned(t)) for t in texts]
    # The decoder of the library spells the tokens alike.
    ids = A.encode(" how are you 中").ids
    assert b"".join(aligner.bytes_a[i] for i in ids).decode() == decoders.ByteLevel().decode([A.id_to_token(i) for i in ids])


def test_rows_of_chunks_give_each_chunks_tokens():
    """Chunks in a row, one that is not spelt among them, against each for itself."""
    r = random.Random(6)
    aligner = Aligner(BYTE_BPE, PIECE_BPE)
    assert aligner.quick is not None
    chunks = ["".join(r.choice("abcXYZ019.,é'ß\n-ÿ\xa0") for _ in range(r.randint(1, 9))) for _ in range(3000)]
    chunks += ["▁x", "中文", "a\n", "\tb", "", "don't", "<0x41>", "word"] * 2
    r.shuffle(chunks)
    plain = aligner.align(chunks)
    for i, c in enumerate(chunks):
        one = aligner._each([c])
        assert (one[1][0], one[3][0], bool(one[4][0])) == (plain.n_a[i], plain.n_b[i], plain.spelt[i]), c
    assert [g.rstrip(";") for g in plain.groups[:400]] == [aligner.align([c]).groups[0].rstrip(";") for c in chunks[:400]]
    assert not all(plain.spelt) and plain.spelt.sum() > 2990


def test_hash_is_minimal_perfect_and_refuses_strangers():
    rng = np.random.default_rng(3)
    for n, shards in ((0, 1), (1, 1), (7, 3), (50_000, 9)):
        keys = np.unique(rng.integers(0, 1 << 40, n).astype(np.uint64))
        shard = shard_hash(keys) % shards
        all_of = Places(shards, 0, [built(keys[shard == s]) for s in range(shards)])
        assert sorted(all_of.find(keys)) == list(range(len(keys))) and len(all_of) == len(keys)
        strangers = np.setdiff1d(rng.integers(0, 1 << 41, 20_000).astype(np.uint64), keys)
        assert (all_of.find(strangers) == -1).all()
        part = Places(shards, 1, [built(keys[shard == s]) for s in range(1, min(3, shards))])
        found = part.find(keys)
        assert ((found >= 0) == ((shard >= 1) & (shard < 3))).all()
    assert 64 * len(all_of.words) < 4.5 * len(all_of)


def test_keys_are_distinct_over_tasks(spark):
    df = spark.createDataFrame([("the same words again",)] * 40, "text string").repartition(8)
    pairs = slice_pairs(df, (BYTE_BPE, PIECE_BPE))
    keys = [r.key for r in distinct_keys(pairs).collect()]
    assert len(keys) == len(set(keys)) == 4
    assert sum(np.frombuffer(r.documents, "<i8").sum() for r in pairs.collect()) == 160


def test_odd_rows(spark, odd, none):
    got = align_tokenizers(odd).collect()
    assert len(got) == odd.count()
    assert all(tuple(r)[1:] == (0, 0, 0, 0, 0, 0, "") for r in got if r.doc_id in (3, 4))
    twice = [tuple(r) for r in got if r.doc_id == 5]
    assert len(twice) == 2 and twice[0] == twice[1]
    assert align_tokenizers(none).count() == 0
