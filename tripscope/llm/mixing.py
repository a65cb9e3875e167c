"""Mixing overlapping sources to target weights by min-cost flow.

Documents are aggregated by membership pattern (the set of sources a document
belongs to).  Word capacity flows pattern -> source -> quota; the first use of
a pattern's words is free and each repetition costs more than the last, so a
source draws on fresh words first and repeats the least contested ones.  The
solved words of a pattern are turned into documents: all of its documents so
many whole times, and for the rest documents in seeded order.

Only the pattern table (its size follows the number of sources, not of
documents) reaches the driver.  The seeded cut of a pattern is found by sums
per hash bucket first, so that no task sorts a source's documents: only the
documents of one bucket per pattern are put in order.
"""

from __future__ import annotations

from collections import deque

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tripscope.llm.common import table, word_count, written

REPEAT_COSTS = (0, 1, 3)  # of the first, second and third use
WEIGHTS = (5.0, 2.0, 1.0)
BUCKETS = 4096


def quotas(sizes: dict, weights: dict, total: float, most: float) -> dict:
    """Share ``total`` by weight; no share is above ``most`` times its source's
    size, the excess is shared again among the others until none is above."""
    free, out, left = list(sizes), {}, float(total)
    while free:
        weight = sum(weights[s] for s in free)
        over = [s for s in free if left * weights[s] / weight > most * sizes[s]]
        if not over:
            out.update({s: left * weights[s] / weight for s in free})
            break
        for s in over:
            out[s] = float(most * sizes[s])
            free.remove(s)
        left = float(total) - sum(out.values())
    return out


class _Network:
    """Integer min-cost max-flow: shortest path costs from the source give
    the zero-reduced-cost arcs; a maximal flow over those ends a phase.  Costs
    are small integers, so there are few phases."""

    def __init__(self, n: int):
        self.out: list[list[int]] = [[] for _ in range(n)]
        self.to: list[int] = []
        self.left: list[int] = []
        self.cost: list[int] = []

    def arc(self, a: int, b: int, capacity: int, cost: int = 0) -> int:
        for x, y, c, w in ((a, b, capacity, cost), (b, a, 0, -cost)):
            self.out[x].append(len(self.to))
            self.to.append(y)
            self.left.append(c)
            self.cost.append(w)
        return len(self.to) - 2

    def _distances(self, s: int) -> list[float]:
        far = [float("inf")] * len(self.out)
        far[s], queue, queued = 0, deque([s]), {s}
        while queue:
            a = queue.popleft()
            queued.discard(a)
            for e in self.out[a]:
                b = self.to[e]
                if self.left[e] and far[a] + self.cost[e] < far[b]:
                    far[b] = far[a] + self.cost[e]
                    if b not in queued:
                        queued.add(b)
                        queue.append(b)
        return far

    def solve(self, s: int, t: int) -> None:
        while (far := self._distances(s))[t] < float("inf"):
            tight = lambda e, a: self.left[e] and far[a] + self.cost[e] == far[self.to[e]]  # noqa: E731,B023
            while True:
                depth, queue = {s: 0}, deque([s])
                while queue:
                    a = queue.popleft()
                    for e in self.out[a]:
                        if self.to[e] not in depth and tight(e, a):
                            depth[self.to[e]] = depth[a] + 1
                            queue.append(self.to[e])
                if t not in depth:
                    break
                nxt, path, a = [0] * len(self.out), [], s
                while True:
                    if a == t:
                        flow = min(self.left[e] for e in path)
                        for e in path:
                            self.left[e] -= flow
                            self.left[e ^ 1] += flow
                        path, a = [], s
                        continue
                    while nxt[a] < len(self.out[a]):
                        e = self.out[a][nxt[a]]
                        if tight(e, a) and depth.get(self.to[e]) == depth[a] + 1:
                            break
                        nxt[a] += 1
                    if nxt[a] < len(self.out[a]):
                        path.append(e)
                        a = self.to[e]
                    elif not path:
                        break
                    else:
                        a = self.to[path.pop() ^ 1]
                        nxt[a] += 1


def route(patterns: list[tuple[tuple, int]], quota: dict, costs=REPEAT_COSTS) -> list[int]:
    """Words to take from each pattern ``(sources, words)``, summed over the
    sources they go to; ``len(costs)`` uses of a word at most."""
    sources = {s: i for i, s in enumerate(quota)}
    base, end = len(patterns) + 2, 1
    net = _Network(base + len(sources))
    uses = []
    for i, (members, words) in enumerate(patterns):
        uses.append([net.arc(0, i + 2, words, c) for c in costs])
        for s in members:
            net.arc(i + 2, base + sources[s], words * len(costs))
    for s, i in sources.items():
        net.arc(base + i, end, round(quota[s]))
    net.solve(0, end)
    return [sum(net.left[e ^ 1] for e in arcs) for arcs in uses]


def mix(
    docs: DataFrame, *, key: str = "doc_id", size: Column, members: Column, weights=WEIGHTS,
    share: float = 1.0, seed: int = 17, max_patterns: int = 100_000,
) -> DataFrame:
    """One row per row of ``docs``: key, members, size, taken.

    ``members`` is an array of source names (a NULL element is a source of its
    own, last in order; a NULL or empty array belongs to no source and is not
    taken).  Sources in code point order weigh ``weights``, repeating; they
    share ``share`` times all words.  ``taken`` is size times the number of
    uses, 0 to 3.  Rows with the same key, size and members are alike: how many
    of them are taken is defined, which ones is not; they stand in one hash bucket,
    which one task puts in order if the cut falls into it.  ``max_patterns`` is an
    error bound on what the driver gets, never a cut.
    """
    spark = docs.sparkSession
    rows = written(
        docs.select(
            F.col(key).alias("key"),
            F.array_sort(F.array_distinct(F.coalesce(members, F.array().cast("array<string>")))).alias("members"),
            size.cast("long").alias("size"),
        ).select("*", F.xxhash64(F.lit(seed), "key", "size").alias("h"), F.monotonically_increasing_id().alias("row")),
        "mixing-rows",
    )
    found = rows.groupBy("members").agg(F.sum("size").alias("words")).limit(max_patterns + 1).collect()
    if len(found) > max_patterns:
        raise ValueError(f"more than {max_patterns} membership patterns")
    order = lambda s: (s is None, (s or "").encode())
    found = sorted(((tuple(r["members"]), int(r["words"])) for r in found), key=lambda p: [order(s) for s in p[0]])
    sources = sorted({s for m, _ in found for s in m}, key=order)
    sizes = {s: sum(w for m, w in found if s in m) for s in sources}
    total = share * sum(w for m, w in found if m)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(sources)}
    quota = quotas(sizes, weight, total, len(REPEAT_COSTS))
    taken = route(found, quota)

    plan = spark.createDataFrame(
        [
            (list(m), i, t // w if w else 0, t % w if w else 0)
            for i, ((m, w), t) in enumerate(zip(found, taken, strict=True))
        ],
        "members array<string>, pattern long, uses long, rest long",
    )
    bucket = F.pmod(F.col("h"), F.lit(BUCKETS))
    # A NULL element equals itself here: arrays compare as values.
    planned = rows.join(plan, rows["members"].eqNullSafe(plan["members"])).select(
        "key", rows["members"], "size", "h", "row", "pattern", "uses", "rest", bucket.alias("bucket")
    )
    partial = planned.where("rest > 0")
    sums = partial.groupBy("pattern", "rest", "bucket").agg(F.sum("size").alias("words"))
    before = F.coalesce(
        F.sum("words").over(Window.partitionBy("pattern").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0),
    )
    edges = written(
        sums.select("*", before.alias("before")).where("before <= rest and before + words > rest")
        .select("pattern", F.col("bucket").alias("edge"), "before"),
        "mixing-edges",
    )
    # The edge bucket of each pattern, document by document.
    # The row's number comes last: only rows alike in all else depend on it.
    inside = Window.partitionBy("pattern").orderBy("h", "key", "size", "row").rowsBetween(Window.unboundedPreceding, 0)
    place = F.struct("h", "key", "size", "row")
    at_edge = planned.join(edges, "pattern").where("bucket = edge")
    cut = written(
        at_edge.select("pattern", "rest", place.alias("place"), (F.col("before") + F.sum("size").over(inside)).alias("upto"))
        .where("upto <= rest").groupBy("pattern").agg(F.max("place").alias("edge_place"), F.max("upto").alias("filled")),
        "mixing-cut",
    )
    picked = planned.join(edges, "pattern", "left").join(cut, "pattern", "left").select(
        "*", F.coalesce("filled", "before", F.lit(0)).alias("have"),
        F.coalesce(
            (F.col("bucket") < F.col("edge")) | ((F.col("bucket") == F.col("edge")) & (place <= F.col("edge_place"))),
            F.lit(False),
        ).alias("more"),
    )
    # One further document comes closest to what is still missing.
    gap = F.col("rest") - F.col("have")
    closest = (
        picked.where(~F.col("more") & (gap > 0) & (F.abs(gap - F.col("size")) < gap))
        .groupBy("pattern").agg(F.min(F.struct(F.abs(gap - F.col("size")).alias("off"), "h", "key", "size", "row")).alias("last"))
        .select("pattern", F.col("last.row").alias("last_row"))
    )
    last = written(closest, "mixing-last")
    is_last = F.coalesce(F.col("row") == F.col("last_row"), F.lit(False))
    return picked.join(last, "pattern", "left").select(
        F.col("key").alias(key), "members", "size",
        ((F.col("uses") + (F.col("more") | is_last).cast("long")) * F.col("size")).alias("taken"),
    ), quota, sizes


def op10_mixing(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "source")
    mixed, quota, sizes = mix(docs, size=word_count(F.col("text")), members=F.array("source"))
    shares = spark.createDataFrame(
        [(s, int(sizes[s]), float(quota[s])) for s in quota], "source string, source_size long, target double"
    )
    return mixed.join(shares, F.element_at("members", 1).eqNullSafe(F.col("source"))).select(
        "doc_id", "size", "source_size", "target", "taken"
    )
