"""Packing by shortest pack first over the length histogram.

Documents become pieces: runs of ``limit`` tokens, and what remains.  Only the
histogram of piece lengths (``limit`` numbers at most) decides the packing:
lengths are placed longest first, each into the packs with the most room, and
what is kept is a list of patterns (lengths in a pack) with a count.  Each
pattern then owns a range of ranks per length; a piece finds its sequence and
offset from its rank among the pieces of its length.  Ranks come from counts
per (length, salt), so no task orders all pieces of one length.
"""

from __future__ import annotations

import heapq
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tripscope.llm.common import mapped, slices, table, written
from tripscope.llm.word_tokens import word_tokens

LIMIT = 4096
END_ID = 2
SALTS = 256
VOCABULARY = "word_bpe_49k.json"


def shortest_pack_first(histogram: dict[int, int], limit: int) -> list[tuple[tuple[int, ...], int]]:
    """[(lengths of a pack, longest first), number of such packs].

    The packs with the most room are filled first.  When the longest length
    left fits nowhere, as many packs are opened as it needs if it had them for
    itself.  Steps depend on the number of lengths, not of documents."""
    room: dict[int, list] = defaultdict(list)
    order: list[int] = []

    def put(left: int, pack: tuple, count: int) -> None:
        if not room[left]:
            heapq.heappush(order, -left)
        room[left].append((pack, count))

    for length in sorted(histogram, reverse=True):
        todo = histogram[length]
        while todo:
            while order and not room[-order[0]]:
                heapq.heappop(order)
            most = -order[0] if order else 0
            if most >= length:
                pack, count = room[most].pop()
                used = min(count, todo)
                if used < count:
                    room[most].append((pack, count - used))
                put(most - length, (*pack, length), used)
            else:
                used = -(-todo // (limit // length))
                put(limit - length, (length,), used)
            todo -= used
    return sorted((p for packs in room.values() for p in packs), reverse=True)


class Slots:
    """Where the pieces of each length go, by rank: ranges of ranks, each with
    the first sequence, the pieces of that length in one sequence, and the
    offset of the first of them."""

    def __init__(self, packs: list[tuple[tuple[int, ...], int]]):
        ranges: dict[int, list] = defaultdict(list)
        used: dict[int, int] = defaultdict(int)
        sequence = 0
        for lengths, count in packs:
            offset = i = 0
            while i < len(lengths):
                length, n = lengths[i], 1
                while i + n < len(lengths) and lengths[i + n] == length:
                    n += 1
                ranges[length].append((used[length], sequence, n, offset))
                used[length] += n * count
                offset += n * length
                i += n
            sequence += count
        self.sequences = sequence
        self.ranges = {length: np.array(r, dtype=np.int64).T for length, r in ranges.items()}

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
        order = np.argsort(length, kind="stable")
        for rows in np.split(order, np.flatnonzero(np.diff(length[order])) + 1) if len(order) else ():
            size = int(length[rows[0]])
            first, start, n, at = self.ranges[size]
            i = np.searchsorted(first, rank[rows], side="right") - 1
            within = rank[rows] - first[i]
            sequence[rows] = start[i] + within // n[i]
            offset[rows] = at[i] + within % n[i] * size
        return sequence, offset


def cut_into_pieces(
    docs: DataFrame, *, key: str, text: str, vocabulary: str, limit: int, end_id: int, keep_ids: bool = False
) -> DataFrame:
    """(key, start, length, ids_crc32, doc_tokens[, ids]) per piece."""
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    end = np.array([end_id], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = word_tokens(vocabulary)
        for batch in batches:
            for part in slices(batch, "text"):
                row, start, length, crc, total, ids = [], [], [], [], [], []
                for i, t in enumerate(part.column("text").to_pylist()):
                    packed = tokens.packed(t or "") + end
                    n = len(packed) // 4
                    for a in range(0, n, limit):
                        piece = packed[4 * a : 4 * (a + limit)]
                        row.append(i)
                        start.append(a)
                        length.append(len(piece) // 4)
                        crc.append(zlib.crc32(piece))
                        total.append(n)
                        if keep_ids:
                            ids.append(np.frombuffer(piece, "<u4").astype(np.int32))
                arrays = [part.column("key").take(pa.array(row, pa.int64()))]
                arrays += [pa.array(x, pa.int64()) for x in (start, length, crc, total)]
                names = ["key", "start", "length", "ids_crc32", "doc_tokens"]
                if keep_ids:
                    arrays.append(pa.array(ids, pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(arrays, names)

    kind = rows.schema["key"].dataType.simpleString()
    schema = f"key {kind}, start long, length long, ids_crc32 long, doc_tokens long"
    return rows.transform(mapped, cut, schema + (", ids array<int>" if keep_ids else ""))


def pack(
    docs: DataFrame, *, key: str = "doc_id", text: str = "text", vocabulary: str | None = None,
    limit: int = LIMIT, end_id: int = END_ID, keep_ids: bool = False,
) -> DataFrame:
    """One row per piece: key, start, length, ids_crc32, doc_tokens,
    sequence_id, offset (and ids, if kept).

    NULL text is empty: one token, the end id.  Pieces of one length are
    interchangeable; among them ranks follow a hash of (key, start, crc), then
    these, so reruns agree and repeated rows get different places.  An empty
    table gives no pieces.  Extra columns are ignored."""
    vocabulary = vocabulary or public_tokenizers.path(VOCABULARY)
    pieces = written(
        cut_into_pieces(docs, key=key, text=text, vocabulary=vocabulary, limit=limit, end_id=end_id, keep_ids=keep_ids),
        "packing-pieces",
    )
    salted = pieces.withColumn("salt", F.pmod(F.xxhash64("key", "start", "ids_crc32"), F.lit(SALTS)))
    counts = written(salted.groupBy("length", "salt").count(), "packing-counts")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("count").alias("n")).collect()}
    slots = Slots(shortest_pack_first(histogram, limit))

    below = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select("length", "salt", F.coalesce(F.sum("count").over(below), F.lit(0)).alias("first"))
    inside = Window.partitionBy("length", "salt").orderBy("key", "start", "ids_crc32")
    ranked = (
        salted.join(first, ["length", "salt"])
        .withColumn("rank", F.col("first") + F.row_number().over(inside) - 1)
        .select(*pieces.columns, "rank")
    )

    names = pieces.columns

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sequence, offset = slots.place(batch.column("length").to_numpy(), batch.column("rank").to_numpy())
            yield pa.RecordBatch.from_arrays(
                [batch.column(n) for n in names] + [pa.array(sequence), pa.array(offset)],
                [*names, "sequence_id", "offset"],
            )

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    return ranked.transform(mapped, place, f"{schema}, sequence_id long, offset long").withColumnRenamed("key", key)


def op5_packing(spark, sf_dir):
    return pack(table(spark, sf_dir, "documents", "doc_id", "text")).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"
    )
