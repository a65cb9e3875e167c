"""Near-duplicate lines by a segment-partition edit join.

Two lines within ``max_edits`` edits, one cut into ``max_edits + 1`` segments:
the other holds one of the segments whole, at nearly its place.  So every
distinct line is indexed under its segments (with its length), and probes,
for every length it may be near to, the substrings of itself that can be that
segment.  What meets is tested by two signatures (the parity of the counts of 24
classes of characters, of which an edit changes two bits at most, and of 64
classes of neighbouring characters: four bits at most), then verified by a
banded bit-parallel edit distance over many pairs at once.  The second tells
variants of one text, each with a word of its own changed, from near lines.

Of equal lines the first stays, by (key, line number).  Lines are decided in
the order of their names (hashes of their texts): one stays unless a line near
it already does.  So a line is dropped if and only if a near line is kept, or
an equal one stands before it.  Every link between two different lines is found
and counted.  Lines of fewer than ``min_chars`` code points have no near lines;
equal ones are judged whatever their length, but for empty lines.  Index and
probes are made distinct before they are joined, so a line of a third of all
documents meets others once.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripscope.llm.common import fresh, mapped, of_one_task, slices, table, written

MAX_EDITS = 2
#: Shorter lines are compared with equal ones only: each of the
#: ``MAX_EDITS + 1`` segments of the edit join has three code points or more.
MIN_CHARS = 3 * (MAX_EDITS + 1)
SIGNATURE = 24
BLOOM_BITS = 1 << 23
#: Text that a task holds as arrays at a time (about 70 bytes a byte).
SLICE_BYTES = 1 << 19
#: Probes of one segment that a part of the join takes.
HOT_PROBES = 1024

_U = np.uint64
_FACTORS = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)
_INVERSES = tuple(pow(f, -1, 1 << 64) for f in _FACTORS)
_SQUARES = tuple(f * f % (1 << 64) for f in _FACTORS)
_TABLES: list[np.ndarray] = of_one_task([])


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


@functools.cache
def _classes() -> np.ndarray:
    """The bit of each code point's class (4 MB)."""
    every = _mixed(np.arange(1, 0x110001, dtype=_U)) % _U(SIGNATURE)
    return np.left_shift(np.uint32(1), every.astype(np.uint32))


@functools.cache
def _byte_pairs() -> tuple[np.ndarray, ...]:
    """Of two code points under 256, side by side in 16 bits: their sums under
    both factors, and their classes (1.3 MB)."""
    low, high = (x.astype(_U) for x in np.arange(1 << 16, dtype="<u2").view(np.uint8).reshape(-1, 2).T)
    sums = [(low + _U(1)) + (high + _U(1)) * _U(f) for f in _FACTORS]
    return *sums, _classes()[low.astype(np.intp)] ^ _classes()[high.astype(np.intp)]


def _powers(n: int) -> list[np.ndarray]:
    if not _TABLES or len(_TABLES[0]) < n:
        size = max(1 << 16, n + n // 8)
        _TABLES[:] = []
        for factor in (*_SQUARES, *_INVERSES):
            p = np.full(size, factor, _U)
            p[0] = 1
            _TABLES.append(np.multiply.accumulate(p))
    return _TABLES


class Lines:
    """The lines (between newlines) of some texts, those of ``min_chars`` code
    points or more, as arrays: text number, line number, start, length, and
    the two halves of their 128-bit names.  The upper bits of the first half
    are the signature.

    Code points are taken two by two, those under 256 (if there are no others)
    from tables of all pairs.  Sums over lines go by whole pairs, and by the
    single points at the ends."""

    def __init__(self, texts: list[str], min_chars: int):
        joined = "".join(t + "\n" for t in texts)
        n = len(joined)
        joined += "\0" * (2 - n % 2)
        try:
            self.coding, points = "latin-1", np.uint8
            self.points = np.frombuffer(joined.encode(self.coding), points)
        except UnicodeEncodeError:
            self.coding, points = "utf-32-le", np.uint32
            self.points = np.frombuffer(joined.encode(self.coding, "surrogatepass"), points)
        self.powers = _powers(n + 2)
        ends = np.flatnonzero(self.points[:n] == 10)
        starts = np.concatenate([[0], ends[:-1] + 1]).astype(np.int64) if n else ends
        first = np.cumsum([0] + [len(t) + 1 for t in texts])[:-1]
        text = np.searchsorted(first, starts, side="right") - 1
        number = np.arange(len(starts)) - np.searchsorted(starts, first)[text] if n else starts
        long = ends - starts >= min_chars
        self.text, self.number = text[long], number[long]
        self.start, self.length = starts[long], (ends - starts)[long]
        bits = lambda at: _classes()[self.points[at]]
        if points is np.uint8:
            classes = _byte_pairs()[2].take(self.points.view("<u2"), mode="clip")
        else:
            each = _classes().take(self.points, mode="clip")
            classes = each[::2] ^ each[1::2]
        sign = self._folded(np.bitwise_xor, classes, bits).astype(_U) << _U(64 - SIGNATURE)
        self.name1 = sign | (self._names(0) >> _U(SIGNATURE))

    @functools.cached_property
    def name2(self) -> np.ndarray:
        return self._names(1)

    def text_of(self, row: int) -> str:
        points = self.points[self.start[row] : self.start[row] + self.length[row]]
        return points.tobytes().decode(self.coding, "surrogatepass" if self.coding != "latin-1" else "strict")

    def grams(self, rows: np.ndarray) -> np.ndarray:
        """Of each of ``rows``, the parity of the counts of 64 classes of
        neighbouring code points."""
        n = np.maximum(self.length[rows] - 1, 0)
        out = np.zeros(len(rows), _U)
        first = np.cumsum(n) - n
        at = np.arange(int(n.sum())) + np.repeat(self.start[rows] - first, n)
        some = n > 0
        if some.any():
            classes = (self._wide(at) * _U(_FACTORS[0]) + self._wide(at + 1) * _U(_FACTORS[1])) * _U(0xBF58476D1CE4E5B9) >> _U(58)
            out[some] = np.bitwise_xor.reduceat(_U(1) << classes, first[some])
        return out

    def _wide(self, at: np.ndarray) -> np.ndarray:
        return self.points[at].astype(_U) + _U(1)

    def _weighed(self, which: int) -> np.ndarray:
        """Each pair's part in the sums under a factor."""
        if self.coding == "latin-1":
            pairs = _byte_pairs()[which].take(self.points.view("<u2"), mode="clip")
        else:
            pairs = self.points[1::2] + _U(1)
            pairs *= _U(_FACTORS[which])
            pairs += self.points[::2]
            pairs += _U(1)
        pairs *= self.powers[which][: len(pairs)]
        return pairs

    @functools.cached_property
    def _pairs(self) -> np.ndarray:
        return self._weighed(0)

    def _folded(self, fold: np.ufunc, pairs: np.ndarray, single: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
        """``fold`` over each line."""
        stop = self.start + self.length
        first, last = (self.start + 1) >> 1, stop >> 1
        out = fold.reduceat(pairs, np.stack([first, last], axis=1).ravel())[::2]
        out[first >= last] = 0
        for at, alone in ((self.start, self.start & 1), (stop - 1, stop & 1)):
            some = np.flatnonzero((alone == 1) & (self.length > 0))
            out[some] = fold(out[some], single(at[some]))
        return out

    def _names(self, which: int) -> np.ndarray:
        odd = lambda at: np.where(at & 1, _U(_FACTORS[which]), _U(1))
        single = lambda at: self._wide(at) * self.powers[which][at >> 1] * odd(at)
        sums = self._folded(np.add, self._weighed(which) if which else self._pairs, single)
        return _mixed(sums * self.powers[2 + which][self.start] + self.length.astype(_U))

    @functools.cached_property
    def _sums(self) -> np.ndarray:
        """The sum of all points before each."""
        sums = np.zeros(2 * len(self._pairs) + 1, _U)
        np.cumsum(self._pairs, out=sums[2::2])
        ahead = self.points[::2] + _U(1)
        ahead *= self.powers[0][: len(ahead)]
        np.add(sums[:-1:2], ahead, out=sums[1::2])
        return sums

    def _keys(self, at, size, length, segment) -> np.ndarray:
        """Key of the substring of ``size`` at ``at``, as segment ``segment``
        of a line of ``length``."""
        h = (self._sums[at + size] - self._sums[at]) * self.powers[2][at]
        return _mixed(_mixed(h + length.astype(_U) * _U(_FACTORS[1])) + _U(segment + 1))

    def index(self, rows: np.ndarray, max_edits: int) -> tuple[np.ndarray, np.ndarray]:
        """(keys, row of each) of the segments of ``rows``."""
        keys, of = [], []
        for i in range(max_edits + 1):
            at, size = segment(self.length[rows], i, max_edits + 1)
            keys.append(self._keys(self.start[rows] + at, size, self.length[rows], i))
            of.append(rows)
        return np.concatenate(keys), np.concatenate(of)

    def probes(self, rows: np.ndarray, max_edits: int, min_chars: int, own: bool = True) -> tuple[np.ndarray, np.ndarray]:
        """(keys, row of each) of the substrings that can be a segment of a
        line that is not longer.  With i edits at most before the i-th segment
        and the others behind it, its shift is bounded from both ends.  Without
        ``own``: those that are not a line's own segments."""
        keys, of = [], []
        for less in range(max_edits + 1):
            some = rows[self.length[rows] - less >= min_chars]
            length = self.length[some] - less
            for i in range(max_edits + 1):
                at, size = segment(length, i, max_edits + 1)
                behind = max_edits - i
                for shift in range(max(-i, less - behind), min(i, less + behind) + 1):
                    if less == shift == 0 and not own:
                        continue
                    place = at + shift
                    fits = (place >= 0) & (place + size <= self.length[some])
                    r = some[fits]
                    keys.append(self._keys(self.start[r] + place[fits], size[fits], length[fits], i))
                    of.append(r)
        return np.concatenate(keys), np.concatenate(of)


def segment(length: np.ndarray, i: int, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and size of the i-th of ``parts`` even segments, longer ones last."""
    size, longer = length // parts, length % parts
    start = i * size + np.maximum(0, i - (parts - longer))
    return start, size + (i >= parts - longer)


def edit_distances(a: list[str], b: list[str], most: int) -> np.ndarray:
    """Edit distance of each pair, ``most + 1`` if it is larger.

    Column by column of all pairs at once, ``2 * most + 1`` rows around the
    diagonal kept as bits of a word that moves down one row a column: ``up``
    and ``low`` mark rows whose cell is one more or one less than that above.
    The value on the lowest row of the band is counted along."""
    n = len(a)
    if not n:
        return np.zeros(0, np.int64)
    la, lb = np.array([len(s) for s in a]), np.array([len(s) for s in b])
    width, span = int(lb.max()), 2 * most + 1
    pattern = np.full((n, max(int(la.max()), width) + span + 1), 0xFFFFFFFF, np.uint32)  # row i at i - 1 + most
    other = np.full((n, width), 0xFFFFFFFE, np.uint32)
    for i in range(n):
        pattern[i, most : most + la[i]] = np.frombuffer(a[i].encode("utf-32-le", "surrogatepass"), np.uint32)
        other[i, : lb[i]] = np.frombuffer(b[i].encode("utf-32-le", "surrogatepass"), np.uint32)
    place = _U(1) << np.arange(64 - span, 64, dtype=_U)
    up = np.full(n, sum(1 << (63 - k) for k in range(most + 1)), _U)  # rows 1 to most + 1
    low = np.zeros(n, _U)
    value = np.full(n, most, np.int64)
    out = np.full(n, most + 1, np.int64)
    for j in range(width + 1):
        done = lb == j
        if done.any():
            # From row j + most (the word has moved on, so the top bit is the
            # next one) up to the last row of the pattern.
            beyond = np.clip(j + most - la[done], 0, 63)
            mask = np.where(beyond > 0, ~_U(0) << (_U(64) - np.maximum(beyond, 1).astype(_U)), _U(0)) >> _U(1)
            bits = lambda x: np.bitwise_count(x & mask).astype(np.int64)  # noqa: E731,B023
            got = value[done] - bits(up[done]) + bits(low[done])
            out[done] = np.where(np.abs(la[done] - j) <= most, np.minimum(got, most + 1), most + 1)
        if j == width:
            break
        same = ((pattern[:, j : j + span] == other[:, j, None]) * place).sum(axis=1, dtype=_U)
        zero = (((same & up) + up) ^ up) | same | low
        right = low | ~(zero | up)
        left = zero & up
        value += (zero >> _U(63)) == 0
        moved = zero >> _U(1)
        up, low = left | ~(moved | right), moved & right
    return out


def _long(a: np.ndarray) -> pa.Array:
    return pa.array(a.view(np.int64))


def _rows(docs: DataFrame, key: str, text: str) -> DataFrame:
    t = F.coalesce(F.col(text), F.lit(""))
    return docs.select(F.col(key).alias("key"), F.xxhash64(t).alias("h"), t.alias("text"))


def _first_seen(names: np.ndarray, seen: set, limit: int = 300_000) -> np.ndarray:
    """Rows whose name was not among the latest of this task."""
    if len(seen) > limit:
        seen.clear()
    _, first = np.unique(names, return_index=True)
    new = [i for i, x in zip(first.tolist(), names[first].tolist(), strict=True) if x not in seen]
    seen.update(names[first].tolist())
    return np.array(sorted(new), np.int64)


def _occurrences(rows: DataFrame, min_chars: int) -> DataFrame:
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                lines = Lines(part.column("text").to_pylist(), min_chars)
                of = pa.array(lines.text)
                yield pa.RecordBatch.from_arrays(
                    [part.column("key").take(of), part.column("h").take(of), pa.array(lines.number.astype(np.int32)),
                     _long(lines.name1), _long(lines.name2)],
                    ["key", "h", "line", "name1", "name2"],
                )

    return rows.transform(mapped, find, f"key {dict(rows.dtypes)['key']}, h long, line int, name1 long, name2 long")


def _signed(rows: DataFrame, min_chars: int, max_edits: int, bloom: np.ndarray | None = None) -> DataFrame:
    """(seg, name, probing) of every line: its segments, which it is indexed
    under and probes as well, and what else it probes (``probing``).  With a
    filter, of the segments in it, and with the line's other signature, grams."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set = set()
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                lines = Lines(part.column("text").to_pylist(), min_chars)
                new = _first_seen(lines.name1, seen)
                if len(new):
                    for probing in (False, True):
                        keys, of = lines.probes(new, max_edits, min_chars, own=False) if probing else lines.index(new, max_edits)
                        more = []
                        if bloom is not None:
                            some = _in_bloom(bloom, keys)
                            keys, of = keys[some], of[some]
                            each, at = np.unique(of, return_inverse=True)
                            more = [_long(lines.grams(each)[at])]
                        yield pa.RecordBatch.from_arrays(
                            [_long(keys), _long(lines.name1[of]), pa.array(np.full(len(of), probing)), *more],
                            ["seg", "name", "probing", "grams"][: 3 + len(more)],
                        )

    return rows.select("text").transform(mapped, cut, "seg long, name long, probing boolean" + ", grams long" * (bloom is not None))


def bloom_words(names: DataFrame, column: str) -> np.ndarray:
    """A Bloom filter of fixed size over a column of hashes: two bits each.
    At most ``BLOOM_BITS / 64`` rows reach the driver."""
    at = F.explode(F.array(*[F.pmod(F.shiftright(column, s), F.lit(BLOOM_BITS)) for s in (0, 20)]))
    word = names.select(at.alias("at")).groupBy(F.expr("at div 64").alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(at % 64 as int))")).alias("bits")
    )
    out = np.zeros(BLOOM_BITS // 64, np.int64)
    got = word.toArrow()
    out[got["word"].to_numpy()] = got["bits"].to_numpy()
    return out.view(_U)


def _in_bloom(bloom: np.ndarray, names: np.ndarray) -> np.ndarray:
    inside = np.ones(len(names), bool)
    for shift in (0, 20):
        at = (names.view(np.int64) >> shift) % BLOOM_BITS
        inside &= (bloom[at >> 6] >> (at & 63).astype(_U)) & _U(1) == 1
    return inside


def _texts(rows: DataFrame, bloom: np.ndarray, min_chars: int) -> DataFrame:
    """(name1, name2, line) of the lines in the filter."""

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set = set()
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                texts = part.column("text").to_pylist()
                lines = Lines(texts, min_chars)
                some = np.flatnonzero(_in_bloom(bloom, lines.name1))
                some = some[_first_seen(lines.name1[some], seen)] if len(some) else some
                found = [lines.text_of(row) for row in some]
                yield pa.RecordBatch.from_arrays(
                    [_long(lines.name1[some]), _long(lines.name2[some]), pa.array(found, pa.string())],
                    ["name1", "name2", "line"],
                )

    return rows.select("text").transform(mapped, fetch, "name1 long, name2 long, line string")


def _near(pairs: DataFrame, lines: DataFrame, max_edits: int) -> DataFrame:
    """(a, a2, b, b2) of the pairs (a, b) whose texts are within ``max_edits``."""
    side = lambda x: lines.select(
        F.col("name1").alias(x), F.col("name2").alias(f"{x}2"), F.col("line").alias(f"t{x}")
    )
    both = pairs.join(side("a"), "a").join(side("b"), "b").where(
        F.abs(F.char_length("ta") - F.char_length("tb")) <= max_edits
    )

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # Pairs of about one length together, and so many that the arrays
            # of a step stay small.
            size = pa.compute.utf8_length(batch.column("ta")).to_numpy()
            order = np.argsort(size, kind="stable")
            start = 0
            while start < len(order):
                least = int(size[order[start]])
                stop = start + max(1, min(2048, (1 << 20) // (least + 1)))
                stop = max(start + 1, min(stop, start + int(np.searchsorted(size[order[start:]], 2 * least + 64))))
                part = batch.take(pa.array(order[start:stop]))
                start = stop
                found = edit_distances(part.column("ta").to_pylist(), part.column("tb").to_pylist(), max_edits)
                yield part.select(["a", "a2", "b", "b2"]).filter(pa.array((found >= 1) & (found <= max_edits)))

    return both.select("a", "a2", "b", "b2", "ta", "tb").transform(mapped, verify, "a long, a2 long, b long, b2 long")


def near_lines(rows: DataFrame, *, max_edits: int, min_chars: int) -> DataFrame:
    """(a1, a2, b1, b2): the names of every two different lines within
    ``max_edits`` edits, once each, ``a`` the smaller."""
    # A segment matters if an index and a probe of different lines share it.
    shared = (
        _signed(rows, min_chars, max_edits).groupBy("seg")
        .agg(F.min("name").alias("low"), F.max("name").alias("high"), F.min("probing").alias("all"))
        .where("low < high and not all")
    )
    bloom = bloom_words(shared, "seg")
    meet = written(_signed(rows, min_chars, max_edits, bloom).distinct(), "lines-meet")
    # Probes of a hot segment are dealt over parts, each with the whole index.
    parts = written(
        meet.groupBy("seg").agg(F.count("*").alias("n"), F.min("probing").alias("all"), F.min("name").alias("low"), F.max("name").alias("high"))
        .where("low < high and not all").select("seg", F.expr(f"cast((n - 1) div {HOT_PROBES} + 1 as int)").alias("parts")),
        "lines-parts",
    )
    dealt = written(meet.join(parts, "seg"), "lines-dealt")
    index = dealt.where("not probing").select(
        "seg", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.col("name").alias("x"), F.col("grams").alias("gx")
    )
    probes = dealt.select(
        "seg", F.pmod(F.xxhash64("name"), "parts").cast("int").alias("part"), F.col("name").alias("y"), F.col("grams").alias("gy"), "probing"
    )
    apart = F.bit_count(F.shiftrightunsigned(F.col("x").bitwiseXOR(F.col("y")), 64 - SIGNATURE)) <= 2 * max_edits
    apart &= F.bit_count(F.col("gx").bitwiseXOR(F.col("gy"))) <= 4 * max_edits
    # Of two lines that are both indexed under the segment, one probes.
    once = (F.col("x") < F.col("y")) | (F.col("probing") & (F.col("x") != F.col("y")))
    pairs = written(
        index.join(probes, ["seg", "part"]).where(once & apart).select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(),
        "lines-pairs",
    )
    bloom = bloom_words(pairs.select(F.explode(F.array("a", "b")).alias("name")), "name")
    lines = written(_texts(rows, bloom, min_chars).distinct(), "lines-texts")
    return _near(pairs, lines, max_edits).toDF("a1", "a2", "b1", "b2")


def stand_ins(links: DataFrame) -> DataFrame:
    """(b1, b2, a1, a2): every line (b) that goes, with the smallest line near
    it that stays (a).  In rounds: lines with no smaller undecided neighbour
    stay, their neighbours go.  So no two near lines stay, and whatever goes is
    near one that stays."""
    open_, gone = links, None
    while not open_.isEmpty():
        ends = [open_.select(F.col(f"{x}1").alias("x1"), F.col(f"{x}2").alias("x2"), F.lit(x == "b").alias("larger")) for x in "ab"]
        stay = written(
            ends[0].unionByName(ends[1]).groupBy("x1", "x2").agg(F.max("larger").alias("larger")).where("not larger").select("x1", "x2"),
            "lines-stay",
        )
        as_ = lambda df, x: df.toDF(f"{x}1", f"{x}2")
        go = written(
            open_.join(as_(stay, "a"), ["a1", "a2"], "left_semi").select(F.col("b1").alias("x1"), F.col("b2").alias("x2")).distinct(),
            "lines-go",
        )
        decided = written(stay.unionByName(go), "lines-decided")
        open_ = written(
            open_.join(as_(decided, "a"), ["a1", "a2"], "left_anti").join(as_(go, "b"), ["b1", "b2"], "left_anti").select(*links.columns),
            "lines-open",
        )
        gone = go if gone is None else written(gone.unionByName(go), "lines-gone")
    if gone is None:
        return links.select("b1", "b2", "a1", "a2")
    kept = links.join(gone.toDF("a1", "a2"), ["a1", "a2"], "left_anti").join(gone.toDF("b1", "b2"), ["b1", "b2"], "left_semi")
    return kept.groupBy("b1", "b2").agg(F.min(F.struct("a1", "a2")).alias("near")).select("b1", "b2", "near.*")


def dropped_lines(
    docs: DataFrame, *, key: str = "doc_id", text: str = "text", max_edits: int = MAX_EDITS, min_chars: int = MIN_CHARS
) -> DataFrame:
    """(key, h, dropped, twins, n_links) of the documents that lose lines or
    whose lines have links: the numbers of the dropped lines in order (from 0),
    the keys of the documents that first hold the lines for whose sake they are
    dropped (distinct, in order), and the links (to other texts of lines) of
    the document's lines, summed.  ``h`` is a hash of the text: rows that
    repeat key and text are one document."""
    rows = _rows(docs, key, text)
    places = written(_occurrences(rows, 1).distinct(), "lines-places")
    first = F.struct(F.col("key").isNull().alias("none"), "key", "h", "line")
    firsts = written(
        places.groupBy("name1", "name2").agg(F.min(first).alias("first"), F.count("*").alias("n")), "lines-first"
    )
    links = written(near_lines(rows, max_edits=max_edits, min_chars=min_chars), "lines-links")
    near = written(stand_ins(links), "lines-near")
    held = firsts.select(F.col("name1").alias("a1"), F.col("name2").alias("a2"), F.col("first.key").alias("near_key"))
    late = written(
        near.join(held, ["a1", "a2"]).select(F.col("b1").alias("name1"), F.col("b2").alias("name2"), "near_key", F.lit(True).alias("late")),
        "lines-late",
    )
    ends = lambda x: links.select(F.col(f"{x}1").alias("name1"), F.col(f"{x}2").alias("name2"))
    degrees = written(ends("a").unionByName(ends("b")).groupBy("name1", "name2").agg(F.count("*").alias("links")), "lines-degrees")
    judged = written(
        firsts.join(degrees, ["name1", "name2"], "left").join(late, ["name1", "name2"], "left").where("n > 1 or links > 0").select(
            "name1", "name2", "first", F.coalesce("late", F.lit(False)).alias("late"), F.coalesce("links", F.lit(0)).alias("links"),
            F.when(F.col("late"), F.col("near_key")).otherwise(F.col("first.key")).alias("twin"),
        ),
        "lines-judged",
    )
    here = F.col("key").eqNullSafe(F.col("first.key")) & (F.col("h") == F.col("first.h")) & (F.col("line") == F.col("first.line"))
    goes = lambda c: F.when(F.col("late") | ~here, F.col(c)).alias(c)
    return written(
        places.join(judged, ["name1", "name2"]).select("key", "h", "links", goes("line"), goes("twin")).groupBy("key", "h")
        .agg(F.sort_array(F.collect_list("line")).alias("dropped"), F.sort_array(F.collect_set("twin")).alias("twins"),
             F.sum("links").alias("n_links")),
        "lines-dropped",
    )


def dedup_lines(
    docs: DataFrame, *, key: str = "doc_id", text: str = "text", max_edits: int = MAX_EDITS, min_chars: int = MIN_CHARS,
    dropped_as: str = "dropped_lines", twins_as: str = "twin_ids", links_as: str | None = None,
) -> DataFrame:
    """The rows of ``docs`` without their dropped lines, with two more columns
    at the end: the dropped line numbers and the keys of the documents with the
    lines that stand for them (arrays), named so that they clash with no
    column, and with ``links_as`` one more, the number of links (a line that
    stands twice in a document counts its links twice).  Other columns are as
    they are, whatever their names.  NULL text stays NULL; a text all of whose
    lines are dropped is empty; empty lines always stay."""
    k, th, gone, twins, links = fresh(docs.columns, "key", "h", "dropped", "twins", "links")
    dropped = dropped_lines(docs, key=key, text=text, max_edits=max_edits, min_chars=min_chars).toDF(k, th, gone, twins, links)
    h = F.xxhash64(F.coalesce(F.col(text), F.lit("")))
    both = docs.join(dropped, docs[key].eqNullSafe(F.col(k)) & (h == F.col(th)), "left")
    # The text is split once; of its line numbers the dropped ones are taken away.
    left = lambda lines: F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(gone))
    cut = F.transform(
        F.array(F.split(F.col(text), "\n", -1)), lambda lines: F.array_join(F.transform(left(lines), lambda i: lines[i]), "\n")
    )[0]
    none = lambda c: F.coalesce(c, F.array().cast(dropped.schema[c].dataType))
    return both.select(
        *[F.when(F.size(gone) > 0, cut).otherwise(F.col(text)).alias(text) if c == text else docs[c] for c in docs.columns],
        none(gone).alias(dropped_as),
        none(twins).alias(twins_as),
        *([F.coalesce(links, F.lit(0)).alias(links_as)] if links_as else []),
    )


def op2_line_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    n = docs.withColumn("n_lines", F.size(F.split(F.coalesce("text", F.lit("")), "\n", -1)).cast("long"))
    joined = lambda c: F.array_join(F.col(c).cast("array<string>"), ",").alias(c)
    return dedup_lines(n, links_as="n_links").select(
        "doc_id", "n_lines", F.size("dropped_lines").cast("long").alias("n_dropped"),
        joined("dropped_lines"), joined("twin_ids"), "n_links",
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"),
    )
