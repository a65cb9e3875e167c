"""Cross-tokenizer alignment: which tokens of two vocabularies meet, how often over
the corpus, and how each document's links stand against those counts.

1. First pass: every whole text is aligned (``token_alignment``); a slice of texts
   becomes its distinct id pairs with the number of documents that hold them.
2. The distinct pairs of the corpus (map-side distinct, one shuffle of 8-byte
   hashes and keys) get a minimal perfect hash, built per shard (``perfect_hash``).
3. Each task adds its slices into dense count vectors indexed by the hash; the
   vectors of a shard are summed over a tree of tasks, ``FAN_IN`` at a time.
4. Second pass: documents are aligned again and look their links up in hash, keys
   (verified) and counts, which are broadcast.

What is broadcast is checked: the shards are dealt into parts of at most
``part_bytes``; with more than one part, counting and look-up go part by part, and
a document's sums are added up.  A count vector is bounded by the same number.
Shards follow a hash of distinct keys, so no group is hot.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripscope.llm.common import mapped, ship_package, slices, table, written
from tripscope.llm.perfect_hash import KEY_BYTES, SHARD_KEYS, Places, built, shard_hash
from tripscope.llm.token_alignment import BYTE_BPE, PIECE_BPE, Remembered, opened

#: Of hash, keys and counts that a task holds at a time.
PART_BYTES = 64 << 20
#: Vectors added in one group.
FAN_IN = 64
#: Keys that a task holds while it makes them distinct.
HELD_KEYS = 1 << 20
TOTALS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")


def slice_pairs(docs: DataFrame, paths: tuple[str, str], *, text: str = "text") -> DataFrame:
    """(keys, documents): the distinct pairs of a slice of texts and in how many
    of its texts they are linked, as packed arrays."""

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = opened(*paths)

        def make(chunks):
            got = aligner.align(chunks, texts=False)
            ends = np.searchsorted(got.of, np.arange(len(chunks) + 1))
            return [
                got.keys[s:e].tobytes() if fits else None
                for s, e, fits in zip(ends.tolist(), ends[1:].tolist(), got.spelt.tolist())
            ]

        seen = Remembered(aligner, make)
        for batch in batches:
            for part in slices(batch, 0):
                found = [
                    np.unique(np.frombuffer(b"".join(entries), aligner.kind))
                    for entries in seen.of(part.column(0).to_pylist()) if entries and None not in entries
                ]
                if found:
                    keys, n = np.unique(np.concatenate(found), return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([keys.astype("<u8").tobytes()]), pa.array([n.astype("<i8").tobytes()])], ["keys", "documents"]
                    )

    return docs.select(F.col(text).alias("text")).transform(mapped, pairs, "keys binary, documents binary")


def distinct_keys(pairs: DataFrame) -> DataFrame:
    """(hash, key) of every pair in the corpus, once."""

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch_of(held):
            k = np.unique(np.concatenate(held))
            return pa.RecordBatch.from_arrays([pa.array(shard_hash(k)), pa.array(k.astype(np.int64))], ["hash", "key"])

        held, n = [], 0
        for batch in batches:
            for packed in batch.column(0).to_pylist():
                held.append(np.frombuffer(packed, "<u8"))
                n += len(held[-1])
                if n > HELD_KEYS:
                    yield batch_of(held)
                    held, n = [], 0
        if held:
            yield batch_of(held)

    return pairs.select("keys").transform(mapped, keys, "hash long, key long").distinct()


def shard_hashes(keys: DataFrame, shards: int) -> DataFrame:
    """(shard, sizes, words, keys): a minimal perfect hash for each shard."""

    def build(group: pa.Table) -> pa.Table:
        sizes, words, placed = built(group["key"].to_numpy().astype(np.uint64))
        return pa.table({
            "shard": group["shard"].slice(0, 1).cast(pa.int64()), "sizes": pa.array([sizes], pa.list_(pa.int64())),
            "words": [words.tobytes()], "keys": [placed.astype("<u8").tobytes()],
        })

    ship_package(keys.sparkSession)
    dealt = keys.select("key", (F.col("hash") % shards).alias("shard"))
    return dealt.groupBy("shard").applyInArrow(build, "shard long, sizes array<long>, words binary, keys binary")


def places(hashes: DataFrame, shards: int, first: int, count: int) -> Places:
    """Shards ``first`` to ``first + count - 1`` on the driver: ``count`` rows."""
    rows = {r["shard"]: r for r in hashes.where(F.col("shard").between(first, first + count - 1)).collect()}
    none = ([], np.zeros(0, "<u8"), np.zeros(0, "<u8"))
    parts = [
        (list(r["sizes"]), np.frombuffer(r["words"], "<u8"), np.frombuffer(r["keys"], "<u8")) if (r := rows.get(s)) else none
        for s in range(first, first + count)
    ]
    return Places(shards, first, parts)


def summed_vectors(pairs: DataFrame, where: Places, fan_in: int = FAN_IN) -> DataFrame:
    """(shard, counts): in how many documents each key of the shard is linked, by
    place.  Every task adds into one dense vector; a shard's vectors are added up
    over a tree with ``fan_in`` branches."""
    spark = pairs.sparkSession
    index = spark.sparkContext.broadcast(where)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = index.value
        vector = np.zeros(len(at), np.int64)
        for batch in batches:
            for keys, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                place = at.find(np.frombuffer(keys, "<u8"))
                vector[place[place >= 0]] += np.frombuffer(n, "<i8")[place >= 0]
        task = TaskContext.get().partitionId()
        for i, (s, e) in enumerate(zip([0, *at.ends.tolist()], at.ends.tolist())):
            if vector[s:e].any():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([at.first + i]), pa.array([task], pa.int64()), pa.array([vector[s:e].astype("<i8").tobytes()])],
                    ["shard", "branch", "counts"],
                )

    def add(group: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(c, "<i8") for c in group["counts"].to_pylist())
        return pa.table({
            "shard": group["shard"].slice(0, 1), "branch": group["branch"].slice(0, 1), "counts": [total.tobytes()],
        })

    vectors = written(pairs.transform(mapped, count, "shard long, branch long, counts binary"), "alignment-vectors")
    branches = (vectors.agg(F.max("branch")).first()[0] or 0) + 1
    while True:
        branches = -(-branches // fan_in)
        up = vectors.withColumn("branch", F.floor(F.col("branch") / fan_in))
        vectors = up.groupBy("shard", "branch").applyInArrow(add, "shard long, branch long, counts binary")
        if branches <= 1:
            return vectors.select("shard", "counts")


def counts_by_place(vectors: DataFrame, where: Places) -> np.ndarray:
    """The summed vectors of ``where``'s shards, end to end."""
    out = np.zeros(len(where), np.int64)
    starts = [0, *where.ends.tolist()]
    for r in vectors.where(F.col("shard").between(where.first, where.first + len(starts) - 2)).collect():
        i = r["shard"] - where.first
        out[starts[i]:starts[i + 1]] = np.frombuffer(r["counts"], "<i8")
    return out


def looked_up(docs: DataFrame, where: Places, counts: np.ndarray, best: np.ndarray, paths: tuple[str, str]) -> DataFrame:
    """``docs`` (text last) with its alignment: ``TOTALS``, of which n_best and
    count_sum only over the pairs that ``where`` holds, and groups."""
    index = docs.sparkSession.sparkContext.broadcast((where, counts, best))
    kept = docs.columns[:-1]

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, (at, counts, best) = opened(*paths), index.value

        def make(chunks):
            got = aligner.align(chunks)
            place = at.find(got.keys)
            n = np.where(place >= 0, counts[place] if len(counts) else 0, 0)
            highest = (place >= 0) & (n == best[got.keys.astype(np.int64) // aligner.size_b])
            heads = np.zeros((len(chunks), len(TOTALS)), np.int64)
            heads[:, :4] = np.stack([got.n_a, got.n_b, got.n_groups, got.n_links], 1)
            np.add.at(heads[:, 4], got.of, np.where(highest, got.times, 0))
            np.add.at(heads[:, 5], got.of, n * got.times)
            return [
                (head.tobytes(), text) if fits else None for head, text, fits in zip(heads, got.groups, got.spelt.tolist())
            ]

        seen = Remembered(aligner, make)
        for batch in batches:
            for part in slices(batch, len(kept)):
                totals, groups = np.zeros((part.num_rows, len(TOTALS)), np.int64), [""] * part.num_rows
                for i, entries in enumerate(seen.of(part.column(len(kept)).to_pylist())):
                    if entries and None not in entries:
                        totals[i] = np.frombuffer(b"".join([e[0] for e in entries]), np.int64).reshape(-1, len(TOTALS)).sum(0)
                        groups[i] = "".join([e[1] for e in entries])[:-1]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], *map(pa.array, totals.T.copy()), pa.array(groups, pa.string())],
                    [*kept, *TOTALS, "groups"],
                )

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields[:-1]]
    return docs.transform(mapped, look_up, ", ".join([*fields, *[f"{c} long" for c in TOTALS], "groups string"]))


def align_tokenizers(
    docs: DataFrame, *, key: str = "doc_id", text: str = "text", byte_path: str = BYTE_BPE, piece_path: str = PIECE_BPE,
    part_bytes: int = PART_BYTES, shard_keys: int = SHARD_KEYS, fan_in: int = FAN_IN,
) -> DataFrame:
    """One row per row of ``docs``: key, n_a, n_b, n_groups, n_links, n_best,
    count_sum, groups (``a1,a2|b1;a3|b2,b3``).

    Tokens a of " " + text and b of text whose byte ranges share a group are
    linked; a pair's count is the number of rows that link it.  n_best counts the
    links whose count is the highest of their a, ties included; count_sum adds the
    counts of all links.  NULL and empty texts, and texts that either vocabulary
    does not spell, have no tokens: zeros and ''.  Repeated rows each count as a
    document.  An empty table gives an empty result; other columns are ignored.
    """
    paths, rows = (byte_path, piece_path), docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    pairs = written(slice_pairs(rows, paths), "alignment-pairs")
    keys = written(distinct_keys(pairs), "alignment-keys")
    shards = max(1, -(-keys.count() // shard_keys))
    hashes = written(shard_hashes(keys, shards), "alignment-hashes")
    # Shards vary a little around their average.
    step = max(1, int(part_bytes * 0.9) // (shard_keys * KEY_BYTES))
    aligner = opened(*paths)
    best, vectors = np.zeros(aligner.size_a, np.int64), []
    for first in range(0, shards, step):
        where = places(hashes, shards, first, min(step, shards - first))
        vectors.append(written(summed_vectors(pairs, where, fan_in), "alignment-counts"))
        counts = counts_by_place(vectors[-1], where)
        np.maximum.at(best, where.keys.astype(np.int64) // aligner.size_b, counts)
    if len(vectors) == 1:
        return looked_up(rows, where, counts, best, paths).withColumnRenamed("key", key)
    # Several parts: the rows get numbers, and each part adds its share of the sums.
    rows = written(rows.select(F.monotonically_increasing_id().alias("row"), "key", "text"), "alignment-rows")
    total = None
    for first, counted in zip(range(0, shards, step), vectors):
        where = places(hashes, shards, first, min(step, shards - first))
        share = looked_up(rows, where, counts_by_place(counted, where), best, paths)
        share = written(share if total is None else share.select("row", "n_best", "count_sum"), "alignment-sums")
        if total is None:
            total = share
        else:
            more = share.select("row", F.col("n_best").alias("more_best"), F.col("count_sum").alias("more_sum"))
            total = total.join(more, "row").select(
                "row", "key", *TOTALS[:4], (F.col("n_best") + F.col("more_best")).alias("n_best"),
                (F.col("count_sum") + F.col("more_sum")).alias("count_sum"), "groups",
            )
    return total.select(F.col("key").alias(key), *TOTALS, "groups")


def op12_alignment(spark, sf_dir):
    aligned = align_tokenizers(table(spark, sf_dir, "documents", "doc_id", "text"))
    digest = F.when(F.col("groups") == "", F.lit("")).otherwise(F.sha2("groups", 256))
    return aligned.select("doc_id", *TOTALS, digest.alias("groups_sha256"))
