"""Document fingerprints: digests of improbable features in chained Bloom filters.

A feature is a window of ``WINDOW`` bytes.  Its entropy puts it in one of 1,001
bins; the rarer the bin is over all windows of all documents, the more a
feature in it tells.  In every run of ``WINDOW`` neighbouring features the
rarest (the first of equals) gets a vote; features with ``VOTES`` votes are
inserted, in order, into a chain of Bloom filters.  Two digests are compared
filter by filter by their common bits, less those expected by chance.

Entropies are kept by counts: sliding one byte on changes the sum of c*log2(c)
by one term for the byte that comes and one for the byte that goes.  The sums
are integers, so equal windows have equal entropies wherever they stand.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripscope.llm.common import mapped, slices, table

WINDOW = 64
VOTES = 16
FILTER_BYTES = 256
FILTER_BITS = 8 * FILTER_BYTES
PROBES = 5
FEATURES_PER_FILTER = 160
BINS = 1001
#: Windows of less entropy than this bin hold next to nothing but one byte.
LOWEST_BIN = 100

_UNIT = 1 << 20
_TERM = np.round(np.arange(WINDOW + 1) * np.log2(np.maximum(np.arange(WINDOW + 1), 1)) * _UNIT).astype(np.int64)
_STEP = np.diff(_TERM)  # of one byte more, by the count before
_MOST = int(np.log2(WINDOW)) * WINDOW * _UNIT
_FACTOR = 0x9E3779B97F4A7C15
_INVERSE = pow(_FACTOR, -1, 1 << 64)
#: Texts are handled in blocks of about this many bytes; a longer text is a block.
BLOCK = 1 << 17


class Block:
    """Texts one behind the other, each followed by ``WINDOW`` numbers that are
    no bytes and all different, so that no window sees two texts."""

    def __init__(self, texts: list[bytes]):
        lengths = np.array([len(t) for t in texts], np.int64)
        self.starts = np.concatenate([[0], np.cumsum(lengths + WINDOW)[:-1]]).astype(np.int64)
        self.lengths = lengths
        data = np.empty(int(lengths.sum()) + WINDOW * len(texts), np.uint16)
        gap = np.arange(256, 256 + WINDOW, dtype=np.uint16)
        for t, a in zip(texts, self.starts, strict=True):
            data[a : a + len(t)] = np.frombuffer(t, np.uint8)
            data[a + len(t) : a + len(t) + WINDOW] = gap
        self.data = data

    def bins(self) -> np.ndarray:
        """Bin (0 to 1,000) of the entropy of the window at each position; -1
        where no window of a text begins."""
        data, n = self.data, len(self.data)
        before, behind = np.zeros(n, np.uint8), np.zeros(n, np.uint8)
        for lag in range(1, min(WINDOW, n)):
            same = (data[lag:] == data[:-lag]).view(np.uint8)
            before[lag:] += same
            behind[:-lag] += same
        total = np.cumsum(_STEP[before])[WINDOW - 1 :]
        total[1:] -= np.cumsum(_STEP[behind])[: n - WINDOW]
        out = np.full(n, -1, np.int16)
        out[: len(total)] = ((_MOST - total) * ((BINS - 1) / _MOST)).astype(np.int16)
        for a, m in zip(self.starts, self.lengths, strict=True):
            out[a + max(m - WINDOW + 1, 0) : a + m + WINDOW] = -1
        return out


def blocks(texts: list[bytes]) -> Iterator[list[bytes]]:
    """``texts`` in order, in lists of about ``BLOCK`` bytes."""
    block, size = [], 0
    for t in texts:
        if block and size + len(t) + WINDOW > BLOCK:
            yield block
            block, size = [], 0
        block.append(t)
        size += len(t) + WINDOW
    if block:
        yield block


def rarity(histogram: np.ndarray) -> np.ndarray:
    """Rank of each bin, the rarest first; bins under ``LOWEST_BIN`` last."""
    order = np.lexsort((np.arange(BINS), histogram, np.arange(BINS) < LOWEST_BIN))
    rank = np.empty(BINS, np.int64)
    rank[order] = np.arange(BINS)
    return rank


def _powers(n: int, factor: int) -> np.ndarray:
    out = np.full(n, factor, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class Fingerprinter:
    """Digest of a text: an array of filters (rows of ``FILTER_BYTES``), and
    the number of features in each."""

    def __init__(self, rank: np.ndarray):
        # Last (as -1): no window.
        self.rank = np.append(rank, BINS)
        self.up, self.down = _powers(2 * BLOCK, _FACTOR), _powers(2 * BLOCK, _INVERSE)

    def _hashes(self, data: np.ndarray, at: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Hash of the windows at ``at``, by prefix sums; equal windows have
        equal hashes wherever they stand."""
        up, down = self.up, self.down
        if len(data) > len(up):
            up, down = _powers(len(data), _FACTOR), _powers(len(data), _INVERSE)
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data + np.uint64(1)) * up[: len(data)], out=sums[1:])
        h = (sums[at + length] - sums[at]) * down[at]
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            h = (h ^ (h >> np.uint64(shift))) * np.uint64(factor)
        return h ^ (h >> np.uint64(31))

    def _chosen(self, block: Block) -> list[np.ndarray]:
        """Positions of the features to insert, text by text."""
        bins = block.bins()
        shift = 21 if len(bins) < 1 << 21 else 40
        least = (self.rank[bins] << shift) | np.arange(len(bins))
        least = least.astype(np.int32) if shift == 21 else least
        size = 1
        while size < WINDOW and len(least) > size:
            least = np.minimum(least[:-size], least[size:])
            size *= 2
        whole = np.zeros(len(least), bool)  # runs of neighbours inside one text
        features = np.maximum(block.lengths - WINDOW + 1, 0)
        for a, m in zip(block.starts, features, strict=True):
            whole[a : a + max(m - WINDOW + 1, 0)] = True
        votes = np.bincount(least[whole] & ((1 << shift) - 1), minlength=len(bins))
        votes[bins < LOWEST_BIN] = 0
        at = np.flatnonzero(votes >= VOTES)
        ends = np.searchsorted(at, block.starts + block.lengths)
        out = []
        for a, n, m, i, j in zip(block.starts, block.lengths, features, np.searchsorted(at, block.starts), ends, strict=True):
            if j > i or not n:
                out.append(at[i:j])
            elif m < 2:
                out.append(np.array([a]))
            else:
                # A text of a few windows, or of nothing but one byte.
                out.append(np.array([a + self.rank[bins[a : a + m]].argmin()]))
        return out

    def digests(self, texts: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
        out = []
        for part in blocks(texts):
            block = Block(part)
            chosen = self._chosen(block)
            lengths = np.repeat(np.minimum(block.lengths, WINDOW), [len(c) for c in chosen])
            hashes = self._hashes(block.data, np.concatenate(chosen), lengths)
            ends = np.cumsum([len(c) for c in chosen])
            for c, end in zip(chosen, ends, strict=True):
                out.append(self._filters(hashes[end - len(c) : end]))
        return out

    @staticmethod
    def _filters(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(h):
            return np.zeros((0, FILTER_BYTES), np.uint8), np.zeros(0, np.int64)
        _, first = np.unique(h, return_index=True)
        h = h[np.sort(first)]
        chain = np.arange(len(h)) // FEATURES_PER_FILTER
        bits = np.zeros((int(chain[-1]) + 1, FILTER_BITS), bool)
        for k in range(PROBES):
            bits[chain, ((h >> np.uint64(11 * k)) & np.uint64(FILTER_BITS - 1)).astype(np.int64)] = True
        return np.packbits(bits, axis=1), np.bincount(chain)


_ONES = np.array([bin(i).count("1") for i in range(256)], np.int64)


def likeness(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """0 to 1.  Each filter of the smaller digest against its best match in
    the other; the mean, weighted by features.  Of two filters: common bits
    above those expected by chance, as a share of what is possible.  Two empty
    digests are alike, an empty one is like no other."""
    if not len(a[0]) or not len(b[0]):
        return float(len(a[0]) == len(b[0]))
    if (len(a[0]), int(a[1].sum())) > (len(b[0]), int(b[1].sum())):
        a, b = b, a
    ones_b = _ONES[b[0]].sum(axis=1)
    best = np.empty(len(a[0]))
    for i, f in enumerate(a[0]):
        ones = _ONES[f].sum()
        chance = ones * ones_b / FILTER_BITS
        possible = np.minimum(ones, ones_b) - chance
        common = _ONES[f & b[0]].sum(axis=1) - chance
        best[i] = (common / np.maximum(possible, 1e-9)).max()
    return float(np.clip(np.average(best, weights=a[1]), 0.0, 1.0))


def packed(digest: tuple[np.ndarray, np.ndarray]) -> str:
    """Text form: number of features of the last filter, filters in base 64."""
    filters, counts = digest
    return f"{int(counts[-1]) if len(counts) else 0}:{base64.b64encode(filters.tobytes()).decode()}"


def _bytes(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "replace")


def entropy_histogram(docs: DataFrame, *, text: str = "text") -> np.ndarray:
    """Windows per entropy bin over all texts: a sum of one small row per bin
    and task; 1,001 numbers reach the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BINS, np.int64)
        for batch in batches:
            for part in slices(batch, "text"):
                for block in blocks([_bytes(t) for t in part.column("text").to_pylist()]):
                    total += np.bincount(Block(block).bins() + 1, minlength=BINS + 1)[1:]
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(BINS)), pa.array(total)], ["bin", "n"])

    counted = docs.select(F.col(text).alias("text")).transform(mapped, count, "bin long, n long")
    out = np.zeros(BINS, np.int64)
    for r in counted.groupBy("bin").agg(F.sum("n").alias("n")).collect():
        out[r["bin"]] = r["n"]
    return out


def in_rings(docs: DataFrame, *, key: str, text: str) -> DataFrame:
    """Rows in descending key order (NULL keys last; ties by a hash of the
    text), cut into runs at quantiles of the key, one run a partition: (run,
    guest, key, text).  Behind each run stands a guest, the first row of the
    next; behind the last, the first of all.  So every row's successor is in
    its partition, and text is shuffled once."""
    spark = docs.sparkSession
    runs = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).withColumn(
        "h", F.xxhash64(F.coalesce("text", F.lit("")))
    )
    at = [i / runs for i in range(1, runs)]
    bounds = rows.agg(F.percentile_approx("key", at, max(10_000, 10 * runs))).first()[0] if at else None
    bounds = sorted(set(bounds or []))
    # Runs count from the largest keys on; NULL keys are in the last.
    run = F.lit(len(bounds)) - F.coalesce(
        F.size(F.filter(F.lit(bounds).cast("array<bigint>"), lambda b: b <= F.col("key"))), F.lit(0)
    ) if bounds else F.lit(0)
    rows = rows.withColumn("run", run.cast("int"))
    firsts = rows.groupBy("run").agg(F.max(F.struct("key", "h")).alias("first")).orderBy("run").collect()
    guests = [(r["first"]["key"], r["first"]["h"], firsts[i - 1]["run"]) for i, r in enumerate(firsts)]
    guests = spark.createDataFrame(guests, f"gkey {dict(rows.dtypes)['key']}, gh long, to int")
    # One guest per run: a broadcast bounded by the number of runs.
    both = rows.join(F.broadcast(guests), rows["key"].eqNullSafe(guests["gkey"]) & (rows["h"] == guests["gh"]), "left")
    place = F.array(
        F.struct(F.col("run").alias("run"), F.lit(False).alias("guest")),
        F.struct(F.col("to").alias("run"), F.lit(True).alias("guest")),
    )
    placed = both.select(F.explode(place).alias("p"), "key", "h", "text").where("p.run is not null")
    return (
        placed.select("p.run", "p.guest", "key", "h", "text")
        .repartitionById(max(len(bounds) + 1, 1), F.col("run"))
        .sortWithinPartitions("run", "guest", F.col("key").desc_nulls_last(), F.col("h").desc())
        .select("run", "guest", "key", "text")
    )


def fingerprints(docs: DataFrame, *, key: str = "doc_id", text: str = "text", histogram: np.ndarray | None = None) -> DataFrame:
    """(key, fingerprint) per row.  ``histogram`` fixes the rarity of entropies,
    so that digests of different tables can be compared; by default it is
    counted over ``docs``.  NULL text is empty: a digest without filters."""
    maker = Fingerprinter(rarity(entropy_histogram(docs, text=text) if histogram is None else histogram))
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                made = [packed(d) for d in maker.digests([_bytes(t) for t in part.column("text").to_pylist()])]
                yield pa.RecordBatch.from_arrays([part.column("key"), pa.array(made, pa.string())], ["key", "fingerprint"])

    return rows.transform(mapped, make, f"key {dict(rows.dtypes)['key']}, fingerprint string").withColumnRenamed("key", key)


def compare_neighbours(docs: DataFrame, *, key: str = "doc_id", text: str = "text", histogram: np.ndarray | None = None) -> DataFrame:
    """Per row: key, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next.

    The next row is the one of the next smaller key, after the last the first
    (of rows that tie on the key, by a hash of the text); the edited text has
    its last floor(n_chars / 2) code points replaced by the first as many of
    the next text, or all of it.  A single row is its own next.  NULL text is
    empty; an empty table gives no rows; extra columns are ignored."""
    maker = Fingerprinter(rarity(entropy_histogram(docs, text=text) if histogram is None else histogram))
    rings = in_rings(docs, key=key, text=text)
    names = ["key", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # key, text, digest of the row whose successor comes next
        for batch in batches:
            for part in slices(batch, "text"):
                guests, keys = part.column("guest").to_pylist(), part.column("key").to_pylist()
                texts = [t or "" for t in part.column("text").to_pylist()]
                rows, edited = [], []  # a row, its digest, its successor's digest
                for guest, k, t, d in zip(guests, keys, texts, maker.digests([_bytes(t) for t in texts]), strict=True):
                    if guest and held is None:
                        continue  # a repeated guest
                    if held is not None:
                        hk, ht, hd = held
                        n = len(ht)
                        rows.append((hk, n, hd, d))
                        edited.append(_bytes(ht[: n - n // 2] + t[: n // 2]))
                    held = None if guest else (k, t, d)
                others = maker.digests(edited)
                columns = [
                    [r[0] for r in rows], [r[1] for r in rows], [hashlib.sha256(e).hexdigest() for e in edited],
                    [packed(r[2]) for r in rows], [packed(o) for o in others],
                    [likeness(r[2], o) for r, o in zip(rows, others, strict=True)], [likeness(r[2], r[3]) for r in rows],
                ]
                kinds = [part.schema.field("key").type, pa.int64(), *[pa.string()] * 3, *[pa.float64()] * 2]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)], names
                )

    kind = dict(rings.dtypes)["key"]
    return rings.transform(
        mapped, compare,
        f"key {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double",
    ).withColumnRenamed("key", key)


def op7_digests(spark, sf_dir):
    return compare_neighbours(table(spark, sf_dir, "documents", "doc_id", "text"))
