"""Exact duplicates by deterministic block naming, in DataFrame operations only.

1. A document's normalised bytes are cut into blocks of ``block_bytes``.  The
   distinct blocks are sorted inside the partitions that hold them and get an
   integer name each (partition number and rank), written as a table.
2. Adjacent names are paired (the last of an odd number with -1); the distinct
   pairs are sorted and named the same way.  This repeats until a document has
   one name.  (level, name) is its identity: two documents share it only if
   every block below is the same, whatever any hash says.

Text moves once, when the distinct blocks are grouped, after a map-side
distinct, so a block of a third of all rows arrives as one row per task.  The
way back to the documents joins on a 128-bit address of the block instead of
its bytes; after the blocks are grouped *by their bytes* the addresses are
proven to be different for different blocks, and if two ever met, the naming
starts over with another salt.  Everything after level 0 is integers.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripscope.llm.common import ascii_lower, table, written

BLOCK_BYTES = 8192


def _blocks(block_bytes: int) -> str:
    # ``b`` is bound once per document, so the normalised bytes are computed
    # once and not once per block.
    return (
        f"transform(array(bytes), b -> transform(sequence(0, greatest(0, (octet_length(b) - 1) div {block_bytes})), "
        f"i -> substring(b, cast(i * {block_bytes} + 1 as int), {block_bytes})))[0]"
    )


def _named(distinct: DataFrame, by: list[str], keep: list[str], label: str) -> DataFrame:
    """Sort the distinct rows of each partition and number them; written, so
    that a name never changes after it has been given."""
    return written(
        distinct.sortWithinPartitions(*by).select(*keep, F.monotonically_increasing_id().alias("name")), label
    )


def _regrouped(placed: DataFrame) -> DataFrame:
    """(row, pos, name) back to one array of names per row, in order."""
    return placed.groupBy("row").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("pos", "name"))), lambda x: x["name"]).alias("names")
    )


def identities(rows: DataFrame, *, block_bytes: int = BLOCK_BYTES) -> tuple[DataFrame, DataFrame]:
    """``rows``: (key, bytes).  Returns ``(rows, ids)``: the rows with a number
    each (row, key, sha256) and (row, level, name), one per row.

    Empty bytes are one empty block; an empty table gives empty results;
    repeated rows get the same identity and different row numbers.
    """
    cut = F.expr(_blocks(block_bytes))
    salt = 0
    while True:
        address = lambda b: F.struct(
            F.xxhash64(F.lit(2 * salt), b).alias("h1"), F.xxhash64(F.lit(2 * salt + 1), b).alias("h2")
        )
        placed = written(
            rows.select(
                F.monotonically_increasing_id().alias("row"), "key", F.sha2("bytes", 256).alias("sha256"),
                F.transform(cut, address).alias("at"),
            ),
            "naming-rows",
        )
        blocks = (
            rows.select(F.explode(cut).alias("block"))
            .select(address(F.col("block")).alias("a"), "block")
            .select("a.h1", "a.h2", "block")
            .distinct()
        )
        names = _named(blocks, ["block"], ["h1", "h2"], "naming-blocks")
        if names.groupBy("h1", "h2").count().where("count > 1").isEmpty():
            break
        salt += 1

    single = F.size("at") == 1
    first = placed.where(single).select("row", F.col("at")[0]["h1"].alias("h1"), F.col("at")[0]["h2"].alias("h2"))
    found = [first.join(names, ["h1", "h2"]).select("row", F.lit(0).alias("level"), "name")]
    spread = placed.where(~single).select("row", F.posexplode("at").alias("pos", "a")).select("row", "pos", "a.*")
    current = written(_regrouped(spread.join(names, ["h1", "h2"])), "naming-level-0")
    level = 0
    while not current.isEmpty():
        level += 1
        pairs = current.select(
            "row",
            F.expr(
                "transform(sequence(0, (size(names) - 1) div 2), "
                "i -> struct(names[2 * i] as a, coalesce(get(names, 2 * i + 1), -1L) as b))"
            ).alias("pairs"),
        )
        distinct = pairs.select(F.explode("pairs").alias("p")).select("p.*").distinct()
        names = _named(distinct, ["a", "b"], ["a", "b"], f"naming-pairs-{level}")
        done = F.size("pairs") == 1
        last = pairs.where(done).select("row", F.col("pairs")[0].alias("p")).select("row", "p.*")
        found.append(last.join(names, ["a", "b"]).select("row", F.lit(level).alias("level"), "name"))
        spread = pairs.where(~done).select("row", F.posexplode("pairs").alias("pos", "p")).select("row", "pos", "p.*")
        current = written(_regrouped(spread.join(names, ["a", "b"])), f"naming-level-{level}")
    return placed.drop("at"), reduce(DataFrame.unionByName, found)


def exact_duplicates(
    docs: DataFrame, *, key: str = "doc_id", text: str = "text", block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """One row per row of ``docs``: key, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A-Z; NULL is empty.  Of
    equal texts the row with the largest key stays (NULL keys are smallest; of
    rows that tie on the key, one stays).  Extra columns are ignored.
    """
    rows = docs.select(F.col(key).alias("key"), ascii_lower(F.col(text)).cast("binary").alias("bytes"))
    numbered, ids = identities(rows, block_bytes=block_bytes)
    members = numbered.join(ids, "row")
    # Written, so that the join below has plain rows on both sides and a group
    # of a third of all rows can be split over tasks.
    groups = written(
        members.groupBy("level", "name").agg(
            F.count("*").alias("group_size"), F.max(F.struct(F.col("key"), F.col("row"))).alias("top")
        ),
        "naming-groups",
    )
    return members.join(groups, ["level", "name"]).select(
        F.col("key").alias(key),
        F.col("top.key").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("top.row")).alias("kept"),
        F.col("sha256").alias("text_sha256"),
    )


def op3_block_naming(spark, sf_dir):
    return exact_duplicates(table(spark, sf_dir, "documents", "doc_id", "text"))


OP3_SQL = """
WITH d AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(t) AS text_sha256
FROM d WINDOW w AS (PARTITION BY t)
"""
