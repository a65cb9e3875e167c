"""Packing: an exact round trip of every token, and the packer's rules."""

from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from tests.conftest import SF_SMALL
from tripscope.llm.packing import LIMIT, Slots, pack, shortest_pack_first
from tripscope.llm.word_tokens import WordTokens

PATH = public_tokenizers.path("word_bpe_49k.json")


def test_remembered_pieces_equal_the_library():
    library, r = Tokenizer.from_file(PATH), random.Random(1)
    own = WordTokens(PATH, limit=50)  # so small that the memory turns over
    signs = list("aZ'stré É!?\t\n\r\x0b\x0c\x1c\x85\xa0 1２½́ė中😀") + ["<|endoftext|>", "'ll", "İ", "ß", "\x00", "ﬁ", "Σ"]
    texts = ["".join(r.choice(signs) for _ in range(r.randint(0, 30))) for _ in range(1500)]
    for t in [*texts, "", "don't we'll", "a<|endoftext|>b"]:
        ids = library.encode(t, add_special_tokens=False).ids
        assert own.packed(t) == np.array(ids, "<u4").tobytes(), repr(t)


def test_shortest_pack_first():
    r = random.Random(2)
    for limit, top in ((16, 16), (4096, 4096), (64, 5)):
        histogram = {r.randint(1, top): r.randint(1, 50) for _ in range(40)}
        packs = shortest_pack_first(histogram, limit)
        assert all(sum(p) <= limit for p, _ in packs)
        back: dict = {}
        for p, n in packs:
            for length in p:
                back[length] = back.get(length, 0) + n
        assert back == histogram
        slots = Slots(packs)
        used = set()
        for length, n in histogram.items():
            sequence, offset = slots.place(np.full(n, length), np.arange(n))
            for s, o in zip(sequence, offset, strict=True):
                cells = {(s, x) for x in range(o, o + length)}
                assert not cells & used
                used |= cells
    assert shortest_pack_first({}, 16) == []


def check(docs, limit, out):
    library = Tokenizer.from_file(PATH)
    want = sorted((str(k), tuple(library.encode(t or "", add_special_tokens=False).ids) + (2,)) for k, t in docs)
    pieces: dict = {}
    for x in out:
        assert x.length == len(x.ids) and x.ids_crc32 == zlib.crc32(np.array(x.ids, "<u4").tobytes())
        pieces.setdefault((str(x.doc_id), x.doc_tokens), []).append(x)
    got = []
    for (k, n), some in pieces.items():
        for copy in range(sum(x.start == 0 for x in some)):
            own = sorted((x for x in some), key=lambda x: x.start)[copy :: sum(x.start == 0 for x in some)]
            got.append((k, tuple(i for x in own for i in x.ids)))
            assert [x.start for x in own] == list(range(0, n, limit))
    assert sorted(got) == want
    sequences: dict = {}
    for x in out:
        sequences.setdefault(x.sequence_id, []).append((x.offset, x.length))
    for s in sequences.values():
        s.sort()
        assert s[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(s, s[1:], strict=False)) and sum(n for _, n in s) <= limit
    return sequences


def test_round_trip_of_odd_rows(odd, none):
    docs = [(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()]
    out = pack(odd, keep_ids=True).collect()
    check(docs, LIMIT, out)
    assert pack(none).count() == 0


def test_little_padding_and_reruns(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    out = pack(docs, keep_ids=True).collect()
    sequences = check([(r.doc_id, r.text) for r in docs.collect()], LIMIT, out)
    assert sum(x.length for x in out) > 0.95 * LIMIT * len(sequences)
    again = {(x.doc_id, x.start): (x.sequence_id, x.offset) for x in pack(docs.repartition(7)).collect()}
    assert again == {(x.doc_id, x.start): (x.sequence_id, x.offset) for x in out}
