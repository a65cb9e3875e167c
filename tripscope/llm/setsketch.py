"""Near duplicates by SetSketch registers, banded, estimated, then verified.

1. A text's words give the set of its five-word shingles (64-bit hashes).  Of
   every one of ``REGISTERS`` hash functions the set's minimum, as an
   exponential variable, is truncated to the exponentially spaced levels
   b**-k; the register holds k.  Registers of a union are the larger ones.
2. Texts of the same words are one class; only classes go on.  Bands of
   registers are hashed; classes that share a band meet in a bucket.
3. Pairs are compared without listing all of a bucket: every member with one
   hub of its bucket; if a bucket still spans several components, with some
   more hubs.  (Buckets of a dozen are compared whole.)  What still spans
   components then is joined exactly, on the rarest shingles of each set.  So
   of every pair of a bucket both are in one component, or it was compared, or
   it cannot reach the threshold.
4. A pair is dropped if the likelihood estimate of its similarity, from the
   registers that are larger, smaller and equal, is five standard deviations
   below the threshold; the others are verified on their full sets.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tripscope.llm.common import mapped, of_one_task, slices, table, written
from tripscope.llm.components import stars

REGISTERS, ROWS = 160, 5  # 32 bands of 5
BASE, RATE, LEVELS = 1.001, 20.0, (1 << 16) - 2
SHINGLE = 5
THRESHOLD = 85  # per cent
#: Further hubs of a large bucket that spans several components.
HUBS = 3
#: A bucket of so many members has few enough pairs to compare them all at once.
SMALL_BUCKET = 12

_GOLDEN = 0x9E3779B97F4A7C15
_INVERSE = pow(_GOLDEN, -1, 1 << 64)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def mixed(h: np.ndarray) -> np.ndarray:
    """A fixed bijection of 64-bit numbers that spreads every bit."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


_ODD = mixed(np.arange(1, REGISTERS + 1, dtype=np.uint64) * np.uint64(_GOLDEN)) | np.uint64(1)
_PLACE = mixed(np.arange(1001, 1001 + SHINGLE, dtype=np.uint64) * np.uint64(_GOLDEN)) | np.uint64(1)
_POWERS: list[np.ndarray] = of_one_task([])


def _powers(n: int) -> list[np.ndarray]:
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(1 << 16, n + n // 8)
        _POWERS[:] = []
        for factor in (_GOLDEN, _INVERSE):
            p = np.full(size, factor, np.uint64)
            p[0] = 1
            _POWERS.append(np.multiply.accumulate(p))
    return _POWERS


def class_of(text: str | None) -> bytes:
    """A 128-bit digest of the words of a text (A-Z in lower case) in a row."""
    found = (text or "").encode("utf-8", "replace").lower().split()
    return hashlib.blake2b(b" ".join(found), digest_size=16).digest() if found else b""


def words(text: str | None) -> tuple[np.ndarray, bytes]:
    """Hashes of the words of a text (A-Z in lower case) and a 128-bit digest
    of the words in a row."""
    raw = (text or "").encode("utf-8", "replace").lower()
    data = np.frombuffer(raw, np.uint8)
    inside = np.concatenate([[False], ~_SPACE[data], [False]])
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    start, end = edge[::2], edge[1::2]
    if not len(start):
        return np.zeros(0, np.uint64), b""
    up, down = _powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=sums[1:])
    digest = hashlib.blake2b(b" ".join(raw.split()), digest_size=16).digest()
    return mixed((sums[end] - sums[start]) * down[start]), digest


def shingles(hashes: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``size`` words; of fewer words,
    the one of all of them."""
    n = len(hashes)
    if not n:
        return hashes
    size = min(size, n)
    total = np.full(n - size + 1, size, np.uint64)
    for k in range(size):
        total += hashes[k : n - size + 1 + k] * _PLACE[k]
    return np.unique(mixed(total))


def registers(shingle_set: np.ndarray) -> np.ndarray:
    """SetSketch of a set of 64-bit hashes that is not empty."""
    least = np.full(REGISTERS, np.iinfo(np.uint64).max, np.uint64)
    for a in range(0, len(shingle_set), 512):
        least = np.minimum(least, (shingle_set[a : a + 512, None] * _ODD[None, :]).min(axis=0))
    share = (least.astype(np.float64) + 0.5) * 2.0**-64
    level = np.floor(1.0 - np.log(-np.log1p(-share) / RATE) / np.log(BASE))
    return np.clip(level, 0, LEVELS + 1).astype("<u2")


def merged(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The sketch of the union."""
    return np.maximum(a, b)


def bands(sketch: np.ndarray) -> np.ndarray:
    """One 64-bit hash per band, of its number and its registers."""
    rows = sketch.reshape(-1, ROWS).astype(np.uint64)
    total = np.arange(1, len(rows) + 1, dtype=np.uint64) * np.uint64(_GOLDEN)
    for k in range(ROWS):
        total = mixed(total + rows[:, k])
    return total


def similarity_estimate(larger, smaller, equal, size_a, size_b) -> np.ndarray:
    """Jaccard similarity of most likelihood, given how many registers of A
    are larger, smaller and equal, and the sizes of both sets."""
    u, v = size_a / (size_a + size_b), size_b / (size_a + size_b)
    p = lambda x: -np.log1p(-x * (BASE - 1) / BASE) / np.log(BASE)

    def fit(j):
        up, down = np.maximum(p(u - v * j), 1e-12), np.maximum(p(v - u * j), 1e-12)
        return larger * np.log(up) + smaller * np.log(down) + equal * np.log(np.maximum(1 - up - down, 1e-12))

    low, high = np.zeros(len(u)), np.minimum(u / v, v / u)
    for _ in range(40):  # the likelihood has one peak
        a, b = low + (high - low) / 3, high - (high - low) / 3
        left = fit(a) < fit(b)
        low, high = np.where(left, a, low), np.where(left, high, b)
    return (low + high) / 2


def sketch_rows(docs: DataFrame, *, key: str, text: str) -> DataFrame:
    """(key, n, class, sketch) per row; of no words: 0, empty, empty."""
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                n, classes, sketches = [], [], []
                for t in part.column("text").to_pylist():
                    h, digest = words(t)
                    s = shingles(h)
                    n.append(len(s))
                    classes.append(digest)
                    sketches.append(registers(s).tobytes() if len(s) else b"")
                yield pa.RecordBatch.from_arrays(
                    [part.column("key"), pa.array(n, pa.int64()), pa.array(classes, pa.binary()), pa.array(sketches, pa.binary())],
                    ["key", "n", "class", "sketch"],
                )

    return rows.transform(mapped, sketch, f"key {dict(rows.dtypes)['key']}, n long, class binary, sketch binary")


def _banded(classes: DataFrame) -> DataFrame:
    """(bucket, id, n): a row per band of every class."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 4096):
                part = batch.slice(a, 4096)
                hashes = [bands(np.frombuffer(s, "<u2")) for s in part.column("sketch").to_pylist()]
                each = REGISTERS // ROWS
                flat = np.concatenate(hashes).view(np.int64) if hashes else np.zeros(0, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(flat)] + [pa.array(np.repeat(part.column(c).to_numpy(), each)) for c in ("id", "n")],
                    ["bucket", "id", "n"],
                )

    return classes.select("id", "n", "sketch").transform(mapped, cut, "bucket long, id long, n long")


def _classed(docs: DataFrame, *, key: str, text: str) -> DataFrame:
    """(key, class, text) of the rows, repeats of a key and class once a task."""
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set = set()
        for batch in batches:
            for part in slices(batch, "text"):
                if len(seen) > 300_000:
                    seen.clear()
                classes, fresh = [class_of(t) for t in part.column("text").to_pylist()], []
                for row in zip(part.column("key").to_pylist(), classes, strict=True):
                    fresh.append(row not in seen)
                    seen.add(row)
                whole = pa.RecordBatch.from_arrays(
                    [part.column("key"), pa.array(classes, pa.binary()), part.column("text")], ["key", "class", "text"]
                )
                yield whole.filter(pa.array(fresh, pa.bool_()))

    return rows.transform(mapped, name, f"key {dict(rows.dtypes)['key']}, class binary, text string")


def _sets(docs: DataFrame, wanted: DataFrame, *, key: str, text: str) -> DataFrame:
    """(id, sketch, set) of the wanted classes (id, class, rep, sketch), one
    row each, from the text of a first document of theirs."""
    rows = _classed(docs, key=key, text=text)
    same = rows["key"].eqNullSafe(wanted["rep"]) & (rows["class"] == wanted["class"])
    joined = rows.join(wanted, same).select("id", "sketch", "text")

    def shingle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                sets = [shingles(words(t)[0]).tobytes() for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), part.column("sketch"), pa.array(sets, pa.binary())], ["id", "sketch", "set"]
                )

    sets = written(joined.transform(mapped, shingle, "id long, sketch binary, set binary"), "near-sets")
    # Rows that repeat key and words have one set: mostly there are none.
    repeated = written(sets.groupBy("id").agg(F.count("*").alias("n")).where("n > 1").select("id"), "near-repeated")
    if repeated.isEmpty():
        return sets
    once = sets.join(repeated, "id", "left_semi").groupBy("id").agg(F.first("sketch").alias("sketch"), F.first("set").alias("set"))
    return written(sets.join(repeated, "id", "left_anti").unionByName(once), "near-sets")


def _linked(pairs: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """Pairs (a, b) with 100 * intersection >= threshold * union.  Pairs that
    the estimate rules out are not looked into; the others are verified."""
    lowest = threshold / 100 - 5 * (threshold / 100 * (1 - threshold / 100) / REGISTERS) ** 0.5
    side = lambda x: sets.select(F.col("id").alias(x), F.col("sketch").alias(f"k{x}"), F.col("set").alias(f"s{x}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "ka", "kb", "sa", "sb")

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (
                np.frombuffer(b"".join(batch.column(c).to_pylist()), "<u2").reshape(-1, REGISTERS) for c in ("ka", "kb")
            )
            sizes = [pa.compute.binary_length(batch.column(c)).to_numpy() / 8.0 for c in ("sa", "sb")]
            likely = similarity_estimate((x > y).sum(axis=1), (x < y).sum(axis=1), (x == y).sum(axis=1), *sizes) >= lowest
            keep = np.zeros(batch.num_rows, bool)
            for i in np.flatnonzero(likely):
                u, v = (np.frombuffer(batch.column(c)[i].as_buffer(), np.uint64) for c in ("sa", "sb"))
                common = len(np.intersect1d(u, v, assume_unique=True))
                keep[i] = 100 * common >= threshold * (len(u) + len(v) - common)
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    return both.transform(mapped, link, "a long, b long")


def _sharing(loose: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """Pairs (a, b) of the ``loose`` classes (id, na, root), across roots,
    that can reach the threshold: put in one order, the rarest first, both
    sets must share a shingle among the first n - ceil(threshold * n) + 1, and
    so early that enough are left behind it.  Copies that differ too much from
    all others have only shingles of their own there, and so meet nobody."""
    rows = sets.join(loose, "id").select("id", "na", "root", "set")

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "set"):
                n = pa.compute.binary_length(part.column("set")).to_numpy() // 8
                flat = np.frombuffer(b"".join(part.column("set").to_pylist()), np.int64)
                of = pa.array(np.repeat(np.arange(part.num_rows), n))
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(c).take(of) for c in ("id", "na", "root")], pa.array(flat)], ["id", "na", "root", "shingle"]
                )

    each = written(rows.transform(mapped, spread, "id long, na long, root long, shingle long"), "near-spread")
    often = written(each.groupBy("shingle").agg(F.count("*").alias("often")), "near-often")
    rank = F.row_number().over(Window.partitionBy("id").orderBy("often", "shingle"))
    first = F.expr(f"na - (na * {threshold} + 99) div 100 + 1")
    prefix = written(
        each.join(often, "shingle").withColumn("rank", rank).where(F.col("rank") <= first).where("often > 1")
        .select("shingle", "id", "na", "root", F.col("rank").alias("ra")),
        "near-prefix",
    )
    other = prefix.select(
        "shingle", F.col("id").alias("hub"), F.col("na").alias("nb"), F.col("root").alias("other"), F.col("ra").alias("rb")
    )
    # Were this the first shingle in common, no more could follow than are left.
    enough = f"(1 + least(na - ra, nb - rb)) * (100 + {threshold}) >= {threshold} * (na + nb)"
    return (
        prefix.join(other, "shingle").where("root != other and id < hub")
        .where(f"100 * least(na, nb) >= {threshold} * greatest(na, nb)").where(enough)
        .select(F.col("id").alias("a"), F.col("hub").alias("b")).distinct()
    )


def near_duplicates(docs: DataFrame, *, key: str = "doc_id", text: str = "text", threshold: int = THRESHOLD) -> DataFrame:
    """One row per row of ``docs``: key, n_shingles, component_id, kept.

    Links join classes with 100 * intersection >= threshold * union of their
    shingle sets; component_id is the smallest key that links reach.  NULL and
    wordless texts have no shingles and no links.  Rows of one key and equal
    words have equal results; NULL keys are never a component_id unless a
    component has no other, and such rows are not kept.  Extra columns are
    ignored."""
    rows = written(sketch_rows(docs, key=key, text=text), "near-rows")
    classes = written(
        rows.where("n > 0").groupBy("class")
        .agg(F.min("key").alias("rep"), F.first("n").alias("n"), F.first("sketch").alias("sketch"))
        .select(F.monotonically_increasing_id().alias("id"), "class", "rep", "n", "sketch"),
        "near-classes",
    )
    in_band = _banded(classes)
    buckets = written(
        in_band.groupBy("bucket").agg(F.min(F.struct("id", "n")).alias("first"), F.max("id").alias("last"), F.count("*").alias("size"))
        .where("first.id < last").select("bucket", F.col("first.id").alias("hub"), F.col("first.n").alias("nb"), "size"),
        "near-buckets",
    )
    members = written(in_band.withColumnRenamed("n", "na").join(buckets, "bucket"), "near-members")
    wanted = classes.join(members.select("id").distinct(), "id", "left_semi").select("id", "class", "rep", "sketch")
    sets = _sets(docs, wanted, key=key, text=text)

    alike = f"100 * least(na, nb) >= {threshold} * greatest(na, nb)"
    ordered = (F.least("id", "hub").alias("a"), F.greatest("id", "hub").alias("b"))

    def links(pairs: DataFrame, label: str) -> DataFrame:
        return written(_linked(pairs, sets, threshold), f"near-links-{label}")

    def placed(open_: DataFrame, roots: DataFrame) -> DataFrame:
        """Members of open buckets that span components, with their root."""
        rooted = written(
            open_.select("bucket", "id", "na", "size").join(roots, "id", "left").withColumn("root", F.coalesce("root", "id")),
            "near-rooted",
        )
        spans = rooted.groupBy("bucket").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high")
        return written(rooted.join(written(spans.select("bucket"), "near-spans"), "bucket"), "near-placed")

    # Every member with the first of its bucket.
    tested = written(members.where("id != hub").where(alike).select(*ordered).distinct(), "near-pairs")
    found = links(tested, "first")
    roots = written(stars(found), "near-roots")
    open_ = placed(members, roots)
    if not open_.isEmpty():
        # Small buckets whole, large ones with a few more hubs of all kinds.
        small = F.col("size") <= SMALL_BUCKET
        hubs = open_.where(~small).groupBy("bucket").agg(
            F.array_distinct(F.array(*[
                F.min(F.struct(F.xxhash64(F.lit(turn), "bucket", "id").alias("h"), "id", "na", "root")) for turn in range(HUBS)
            ])).alias("hubs")
        )
        hubs = written(
            hubs.select("bucket", F.explode("hubs").alias("x"))
            .select("bucket", F.col("x.id").alias("hub"), F.col("x.na").alias("nb"), F.col("x.root").alias("other")),
            "near-hubs",
        )
        by_hub = open_.join(hubs, "bucket").where("root != other").where(alike).select(*ordered)
        few = open_.where(small)
        other = few.select("bucket", F.col("id").alias("hub"), F.col("na").alias("nb"), F.col("root").alias("other"))
        across = few.join(other, "bucket").where("root != other and id < hub").where(alike).select(*ordered)
        pairs = by_hub.unionByName(across).distinct()
        second = written(pairs.join(tested, ["a", "b"], "left_anti"), "near-pairs")
        tested = tested.unionByName(second)
        # The stars of the first links stand for them.
        found = roots.select(F.col("id").alias("a"), F.col("root").alias("b")).unionByName(links(second, "second"))
        roots = written(stars(found), "near-roots")
    component = roots
    open_ = placed(open_.where(F.col("size") > SMALL_BUCKET), component)
    if not open_.isEmpty():
        # What hubs did not settle, by its rare shingles.
        loose = written(open_.select("id", "na", "root").distinct(), "near-loose")
        third = written(_sharing(loose, sets, threshold).join(tested, ["a", "b"], "left_anti"), "near-pairs")
        found = roots.select(F.col("id").alias("a"), F.col("root").alias("b")).unionByName(links(third, "third"))
        component = written(stars(found), "near-roots")

    rooted = classes.select("id", "class", "rep").join(component, "id", "left").select(
        "class", "rep", F.coalesce("root", "id").alias("root")
    )
    rooted = written(rooted, "near-rooted")
    smallest = written(rooted.groupBy("root").agg(F.min("rep").alias("component_id")), "near-smallest")
    named = written(rooted.join(smallest, "root").select("class", "component_id"), "near-named")
    found = rows.select("key", "n", F.when(F.col("n") > 0, F.col("class")).alias("class")).join(named, "class", "left")
    component_id = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("key"))
    return found.select(
        F.col("key").alias(key), F.col("n").alias("n_shingles"), component_id.alias("component_id"),
        F.coalesce(F.col("key") == component_id, F.lit(False)).alias("kept"),
    )


def op6_setsketch(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents", "doc_id", "text"))
