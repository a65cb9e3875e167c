"""What two tokenizers make of one text: a byte-level BPE and a piece BPE.

Both cover the same bytes, so the offsets where tokens of both end cut them into
groups (``Aligner``).  A white-space run always starts new tokens in both
vocabularies (checked when they are opened, else texts stay whole), so a text is the
row of its chunks, and a chunk is aligned once and then remembered.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import public_tokenizers
import sentencepiece
import tiktoken
from tokenizers import Tokenizer

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")
_SPACE = "▁"  # the piece vocabulary's sign for a space
_BYTE = re.compile(r"<0x([0-9A-F]{2})>")
#: A space after a sign that is no white space; and after one that is.
_CUT, _RUN = re.compile(r"(?<=\S) "), re.compile(r"\s ")
_BEYOND_LATIN = re.compile("[^\x00-\xff]")
#: Chunks up to this length are remembered, so many at a time (and as many older).
KEPT_CHARS, KEPT = 48, 200_000
#: Chunks that are tokenized in one row.
IN_A_ROW = 4096
#: Groups with more links than this are reduced to their distinct ids first.
LARGE_GROUP = 4096


def _printable_bytes() -> dict[str, int]:
    """The byte-level vocabulary's letters: a printable Latin-1 byte stands for
    itself, the others follow from U+0100 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(rest)}


@dataclass
class Aligned:
    """Chunks aligned: per chunk the numbers of tokens, groups and links (0 if its
    tokens do not spell it), whether they spell it, and its groups as text (each
    closed by ``;``); and the distinct links of each chunk (``of``, ascending) with
    how often they occur."""

    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    spelt: np.ndarray
    groups: list[str]
    of: np.ndarray
    keys: np.ndarray
    times: np.ndarray


class Aligner:
    def __init__(self, byte_path: str = BYTE_BPE, piece_path: str = PIECE_BPE):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # the tasks are the parallelism
        self.a = Tokenizer.from_file(byte_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=piece_path)
        letters = _printable_bytes()
        self.bytes_a: list[bytes] = [b""] * self.a.get_vocab_size()
        for token, i in self.a.get_vocab().items():
            self.bytes_a[i] = bytes(letters[c] for c in token if c in letters)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [
            bytes.fromhex(m[1]) if (m := _BYTE.fullmatch(p)) else p.replace(_SPACE, " ").encode() for p in pieces
        ]
        self.len_a, self.len_b = (np.array([len(x) for x in t], np.int64) for t in (self.bytes_a, self.bytes_b))
        self.size_a, self.size_b = len(self.bytes_a), len(self.bytes_b)
        #: A link is one number: id of A times the size of B plus id of B.
        self.kind = np.dtype("<u4" if self.size_a * self.size_b <= 1 << 32 else "<u8")
        with open(byte_path, encoding="utf-8") as f:
            config = json.load(f)
        before = config["pre_tokenizer"] or {}
        self.cuts = (
            config["normalizer"] is None and before.get("type") == "ByteLevel"
            and before.get("use_regex", True) and not before["add_prefix_space"]
            and _SPACE in pieces and not any(_SPACE in p.lstrip(_SPACE) for p in pieces)
        )
        # Where a token's id is its rank among the merges, the quicker of the two
        # libraries encodes rows of Latin-1 text, in which both split words alike.
        vocabulary, merges = config["model"]["vocab"], config["model"]["merges"]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
        self.quick = None
        if self.cuts and all(vocabulary[a + b] == 256 + i for i, (a, b) in enumerate(pairs)):
            self.quick = tiktoken.Encoding(
                "ranks", pat_str=public_tokenizers.PATTERN, special_tokens={},
                mergeable_ranks={self.bytes_a[i]: i for i in range(256 + len(pairs))},
            )
        # Number texts by id, A's before B's: inside a group and at its end.
        ids = [*range(self.size_a), *range(self.size_b)]
        self._inside = np.array([f"{i}," for i in ids], object)
        self._last = np.array([f"{i}|" for i in range(self.size_a)] + [f"{i};" for i in range(self.size_b)], object)

    def chunks(self, text: str | None) -> list[str]:
        """The parts of a text that are tokenized for themselves.  The space at a
        cut is left out: each part is encoded with one before it, as the text."""
        if not text:
            return []
        if not self.cuts:
            return [text]
        return _CUT.split(text) if text[0] == " " or _RUN.search(text) else text.split(" ")

    def _ids_a(self, text: str) -> list[int]:
        if self.quick and not _BEYOND_LATIN.search(text):
            return self.quick.encode_ordinary(text)
        return self.a.encode(text, add_special_tokens=False).ids

    def _in_a_row(self, chunks: list[str]) -> tuple[np.ndarray, ...] | None:
        """ids and numbers of tokens (A's, B's) of chunks that neither begin nor end
        with white space, from one text of them all; None if its tokens do not
        spell it with a token's end at every chunk's end."""
        joined = " ".join(chunks)
        want = b" " + joined.encode()
        ends = np.cumsum([len(c.encode()) + 1 for c in chunks])
        out = []
        for ids, spelling, size in (
            (self._ids_a(" " + joined), self.bytes_a, self.len_a),
            (self.b.encode(joined), self.bytes_b, self.len_b),
        ):
            if b"".join(map(spelling.__getitem__, ids)) != want:
                return None
            ids = np.array(ids, np.int64)
            token_ends = np.cumsum(size[ids])
            last = np.searchsorted(token_ends, ends)
            if not np.array_equal(token_ends[last], ends):
                return None
            out += [ids, np.diff(last, prepend=-1)]
        return tuple(out)

    def _tokens(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """ids of A and of B, numbers of tokens per chunk, and whether it is spelt."""
        parts, plain = [], [bool(c) and not c[0].isspace() and not c[-1].isspace() for c in chunks]
        start = 0
        while start < len(chunks):
            stop = start + 1
            if self.cuts and plain[start]:
                while stop < len(chunks) and stop - start < IN_A_ROW and plain[stop]:
                    stop += 1
                parts += self._row_or_each(chunks[start:stop])
            else:
                while stop < len(chunks) and not (self.cuts and plain[stop]):
                    stop += 1
                parts.append(self._each(chunks[start:stop]))
            start = stop
        none = np.zeros(0, np.int64)
        a, n_a, b, n_b, spelt = (np.concatenate([none, *(p[i] for p in parts)]) for i in range(5))
        return a, b, n_a, n_b, spelt.astype(bool)

    def _row_or_each(self, chunks: list[str]) -> list[tuple[np.ndarray, ...]]:
        """One row; if a chunk in it is not spelt, halves, down to few chunks."""
        if (row := self._in_a_row(chunks)) is not None:
            return [(*row, np.ones(len(chunks), np.int64))]
        if len(chunks) <= 8:
            return [self._each(chunks)]
        half = len(chunks) // 2
        return self._row_or_each(chunks[:half]) + self._row_or_each(chunks[half:])

    def _each(self, chunks: list[str]) -> tuple[np.ndarray, ...]:
        lists_a, lists_b, spelt = self._ids(chunks)
        flat = lambda lists: np.fromiter(chain.from_iterable(lists), np.int64)
        n = lambda lists: np.array([len(x) for x in lists], np.int64)
        return flat(lists_a), n(lists_a), flat(lists_b), n(lists_b), np.array(spelt, np.int64)

    def _ids(self, chunks: list[str]) -> tuple[list[list[int]], list[list[int]], list[bool]]:
        ids_a = [e.ids for e in self.a.encode_batch_fast([" " + c for c in chunks], add_special_tokens=False)]
        ids_b = self.b.encode(chunks, num_threads=1)
        spelt = []
        for i, c in enumerate(chunks):
            if not c:  # what is left after a space at the end of a text
                ids_b[i] = [self.b.piece_to_id(_SPACE)]
            want = b" " + c.encode()
            fits = (
                b"".join(map(self.bytes_a.__getitem__, ids_a[i])) == want == b"".join(map(self.bytes_b.__getitem__, ids_b[i]))
            )
            if not fits:
                ids_a[i] = ids_b[i] = []
            spelt.append(fits)
        return ids_a, ids_b, spelt

    def align(self, chunks: list[str], texts: bool = True) -> Aligned:
        """Whole arrays at a time.  ``texts``: the groups as text too.

        A group of tokens a and b has len(a) * len(b) links, kept as its distinct
        pairs: one without any common offset over very many tokens is held whole."""
        a, b, n_a, n_b, spelt = self._tokens(chunks)
        ends_a, ends_b = np.cumsum(self.len_a[a]), np.cumsum(self.len_b[b])
        common = np.intersect1d(ends_a, ends_b, assume_unique=True)
        group_a, group_b = np.searchsorted(common, ends_a), np.searchsorted(common, ends_b)
        in_a, in_b = np.bincount(group_a, minlength=len(common)), np.bincount(group_b, minlength=len(common))
        first_a, first_b = np.cumsum(in_a) - in_a, np.cumsum(in_b) - in_b
        of_a = np.repeat(np.arange(len(chunks)), n_a)
        chunk = of_a[first_a] if len(common) else np.zeros(0, np.int64)
        links = in_a * in_b

        small = np.flatnonzero(links <= LARGE_GROUP)
        g = np.repeat(small, links[small])
        k = np.arange(len(g)) - np.repeat(np.cumsum(links[small]) - links[small], links[small])
        of, times = [chunk[g]], [np.ones(len(g), np.int64)]
        keys = [a[first_a[g] + k // in_b[g]] * self.size_b + b[first_b[g] + k % in_b[g]]]
        for g in np.flatnonzero(links > LARGE_GROUP):
            x, m = np.unique(a[first_a[g]:first_a[g] + in_a[g]], return_counts=True)
            y, n = np.unique(b[first_b[g]:first_b[g] + in_b[g]], return_counts=True)
            keys.append((x[:, None] * self.size_b + y).ravel())
            times.append((m[:, None] * n).ravel())
            of.append(np.full(len(keys[-1]), chunk[g]))
        of, keys, times = np.concatenate(of), np.concatenate(keys), np.concatenate(times)
        order = np.lexsort((keys, of))
        of, keys, times = of[order], keys[order], times[order]
        new = np.flatnonzero(np.concatenate([[True], (of[1:] != of[:-1]) | (keys[1:] != keys[:-1])])[: len(of)])
        times = np.add.reduceat(times, new) if len(new) else times

        return Aligned(
            n_a, n_b, np.bincount(chunk, minlength=len(chunks)),
            np.bincount(chunk, links, minlength=len(chunks)).astype(np.int64), spelt,
            self._texts(a, b, group_a, group_b, n_a + n_b) if texts else [""] * len(chunks),
            of[new], keys[new].astype(self.kind), times,
        )

    def _texts(self, a, b, group_a, group_b, tokens) -> list[str]:
        place = np.concatenate([group_a * 2, group_b * 2 + 1])
        order = np.argsort(place, kind="stable")
        place, ids = place[order], np.concatenate([a, b + self.size_a])[order]
        last = np.concatenate([place[1:] != place[:-1], [True]])[: len(place)]
        shown = np.where(last, self._last[ids], self._inside[ids]).tolist()
        ends = np.cumsum(tokens).tolist()
        return ["".join(shown[s:e]) for s, e in zip([0, *ends], ends)]


class Remembered:
    """What ``make`` gives for chunks (one entry per chunk, in order), kept for the
    short ones of late: when there are ``KEPT``, they become the older ones, and the
    older ones that were not asked for since are let go."""

    def __init__(self, aligner: Aligner, make):
        self.aligner, self.make, self.known, self.older = aligner, make, {}, {}

    def of(self, texts: Iterable[str | None]) -> Iterator[list]:
        """The entries of each text's chunks."""
        lists = [self.aligner.chunks(t) for t in texts]
        if len(self.known) > KEPT:
            self.known, self.older = {}, self.known
        known, older = self.known, self.older
        new = set(chain.from_iterable(lists)).difference(known)
        again = new.intersection(older)
        known.update((c, older[c]) for c in again)
        # Plain chunks side by side: they are tokenized in a row.
        new = sorted(new.difference(again))
        known.update(zip(new, self.make(new), strict=True))
        for chunks in lists:
            yield list(map(self.known.__getitem__, chunks))
        for c in new:
            if len(c) > KEPT_CHARS:
                del self.known[c]


_OPEN: dict[tuple, Aligner] = {}


def opened(byte_path: str, piece_path: str) -> Aligner:
    """One per worker process."""
    at = (byte_path, piece_path)
    if at not in _OPEN:
        _OPEN[at] = Aligner(*at)
    return _OPEN[at]
