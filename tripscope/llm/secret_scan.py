"""Secret scan: fixed patterns, and sliding-window entropy per character class.

A candidate is a maximal run of a class's characters, at least a window long,
that mixes letters and digits.  A window slides over it; entering and leaving
characters change two counts and two terms of the entropy sum, so a step costs
the same for any window.  Windows at or above the class's threshold are merged
into spans.  Spans that lie inside a pattern's span are not reported, nor those
whose parts, between / and =, the allow-list knows.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripscope.llm.common import mapped, slices, table

# Fixed values of the pattern rules: kind, pattern, group whose length counts, least length.
PATTERNS = (
    ("assign", re.compile(
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        re.IGNORECASE | re.ASCII), 2, 8),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 16),
    ("hex", re.compile(r"[0-9a-f]{32,}"), 0, 32),  # a run of 32 or more is the run that [0-9a-f]+ finds
)
# Cheap tests in the lower-cased text: without one of these there is no match.
NEEDLES = {"assign": ("passw", "secret", "token", "apikey", "api_key"), "access": ("akia",), "hex": None}
KINDS = [p[0] for p in PATTERNS] + ["entropy"]


@dataclass(frozen=True)
class CharClass:
    """Characters (as a regex class body), window length, bits per character."""

    name: str
    chars: str
    window: int
    bits: float


CLASSES = (
    CharClass("hex", "0-9A-Fa-f", 16, 3.0),
    CharClass("alnum", "0-9A-Za-z", 20, 3.7),
    CharClass("base64", r"0-9A-Za-z+/_=\-", 20, 3.9),
)

#: Texts that look random and are not secrets.
ALLOW = (
    r"[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}",  # UUID
    r"(?i:.*(?:example|sample|dummy|placeholder|x{6}|0123456789|123456789|abcdefgh).*)",
    r"[A-Za-z]+[0-9]{1,4}",  # a word with a number behind it
    r"(?:[A-Za-z]+|[0-9]+)(?:[/_=\-]+(?:[A-Za-z]+|[0-9]+))+",  # words and numbers joined: paths, slugs, dates
    r"[0-9]+(?:[-/_][0-9]+)*",
)


#: What ends a part of a run, for the allow-list.
PART_ENDS = re.compile("[/=]")
#: Parts that say nothing for or against: words, numbers.
PLAIN = re.compile(r"[A-Za-z_\-]*|[0-9_\-]*")


def entropy_spans(run: str, window: int, bits: float) -> list[tuple[int, int]]:
    """Merged spans of the windows of ``run`` whose Shannon entropy is at least
    ``bits``.  Sum of c*log2(c) over the counts is kept by two updates a step:
    entropy = log2(window) - sum / window."""
    if len(run) < window:
        return []
    term = [0.0] + [c * math.log2(c) for c in range(1, window + 1)]
    counts: dict[str, int] = {}
    total = 0.0
    most = (math.log2(window) - bits) * window + 1e-9
    spans: list[tuple[int, int]] = []
    for i, ch in enumerate(run):
        c = counts.get(ch, 0)
        counts[ch] = c + 1
        total += term[c + 1] - term[c]
        if i >= window:
            old = run[i - window]
            c = counts[old]
            counts[old] = c - 1
            total += term[c - 1] - term[c]
        if i >= window - 1 and total <= most:
            start = i - window + 1
            if spans and start <= spans[-1][1]:
                spans[-1] = (spans[-1][0], i + 1)
            else:
                spans.append((start, i + 1))
    return spans


class Scanner:
    """The compiled rules; ``spans(text)`` gives (start, kind number, end)."""

    def __init__(self, classes: Sequence[CharClass] = CLASSES, allow: Sequence[str] = ALLOW):
        self.classes = [(c, re.compile(f"[{c.chars}]{{{c.window},}}")) for c in classes]
        self.shortest = min((c.window for c in classes), default=0)
        everything = "".join(c.chars for c in classes)
        # All runs that any class can have a candidate in.
        self.runs = re.compile(f"[{everything}]{{{self.shortest},}}") if classes else None
        self.allow = re.compile("|".join(f"(?:{a})" for a in allow)) if allow else None
        self.mixed = re.compile(r"[0-9].*[A-Za-z]|[A-Za-z].*[0-9]", re.DOTALL)

    def base(self, text: str) -> list[tuple[int, int, int]]:
        found, low = [], text.lower()
        for number, (kind, pattern, group, least) in enumerate(PATTERNS):
            needles = NEEDLES[kind]
            if needles is None or any(n in low for n in needles):
                found += [
                    (m.start(), number, m.end())
                    for m in pattern.finditer(text)
                    if m.end(group) - m.start(group) >= least
                ]
        return found

    def spans(self, text: str) -> list[tuple[int, int, int]]:
        base = self.base(text)
        added: set[tuple[int, int]] = set()
        for run in self.runs.finditer(text) if self.runs else ():
            word = run.group()
            if word.isalpha() or not self.mixed.search(word):
                continue
            for c, pattern in self.classes:
                for m in pattern.finditer(word):
                    if not self.mixed.search(m.group()) or self._known(m.group()):
                        continue
                    for a, b in entropy_spans(m.group(), c.window, c.bits):
                        a, b = m.start() + a, m.start() + b
                        if not self._known(word[a:b]) and not self._known_around(word, a, b):
                            added.add((run.start() + a, run.start() + b))
        # Spans by start, the longer one and a base span first: an added one lies in
        # another exactly if one before it ends no earlier.
        order = sorted([(a, -b, 0) for a, _, b in base] + [(a, -b, 1) for a, b in added])
        furthest = -1
        for a, b, is_added in order:
            if is_added and -b > furthest:
                base.append((a, len(PATTERNS), -b))
            furthest = max(furthest, -b)
        return sorted(base)

    def _known(self, text: str) -> bool:
        """Of a text in several parts, one known part does not vouch for the others."""
        return self.allow is not None and not PART_ENDS.search(text) and self.allow.fullmatch(text) is not None

    def _known_around(self, run: str, a: int, b: int) -> bool:
        """Every part of the run that the span lies in is known, or is plain
        beside a known one or in a known whole."""
        if self.allow is None:
            return False
        start = max(run.rfind(c, 0, a + 1) for c in "/=") + 1
        stop = PART_ENDS.search(run, b - 1)
        whole = run[start : stop.start() if stop else len(run)]
        parts = [x for x in PART_ENDS.split(whole) if not self._known(x)]
        some = len(parts) < whole.count("/") + whole.count("=") + 1
        return all(PLAIN.fullmatch(x) for x in parts) and (some or self.allow.fullmatch(whole) is not None)


SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))


def find_secrets(
    docs: DataFrame, *, key: str = "doc_id", text: str = "text",
    classes: Sequence[CharClass] = CLASSES, allow: Sequence[str] = ALLOW,
) -> DataFrame:
    """One row per row of ``docs``: key, spans (kind, start, end; code points,
    end exclusive, by start and then kind).  No shuffle; whole texts.  NULL or
    empty text has no spans; extra columns are ignored."""
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(classes, allow)
        for batch in batches:
            for part in slices(batch, "text"):
                spans = [
                    [{"kind": KINDS[k], "start": a, "end": b} for a, k, b in scanner.spans(t)] if t else []
                    for t in part.column("text").to_pylist()
                ]
                yield pa.RecordBatch.from_arrays([part.column("key"), pa.array(spans, SPANS)], ["key", "spans"])

    kind = rows.schema["key"].dataType.simpleString()
    out = rows.transform(mapped, scan, f"key {kind}, spans array<struct<kind:string,start:int,end:int>>")
    return out.withColumnRenamed("key", key)


def op1_secret_scan(spark, sf_dir):
    spans = find_secrets(table(spark, sf_dir, "documents", "doc_id", "text"))
    joined = lambda spans: F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )
    n = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    base = F.filter("spans", lambda s: s["kind"] != "entropy")
    return spans.select(
        "doc_id", n("assign").alias("n_assign"), n("access").alias("n_access"), n("hex").alias("n_hex"),
        F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"),
        n("entropy").alias("n_entropy"),
    )
