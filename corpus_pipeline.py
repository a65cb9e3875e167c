"""The corpus pipeline: raw documents to packed training sequences.

Every stage reads all that the one before kept and is written as Parquet.  All
but the last return the columns of ``documents``; their order is kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tripscope.llm import line_dedup, mixing, packing, quality, setsketch
from tripscope.llm.common import fresh, table, word_count, written

#: Near duplicates: five-word shingles, this similarity in per cent or more.
NEAR_THRESHOLD = 80


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores under 0.5 go.  It learns from the
    labels of the stage's own documents that are not held out."""
    model = quality.fit_quality(docs, table(spark, sf_dir, "labels", "doc_id", "quality"))
    return quality.keep_quality(docs, model)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that repeat an earlier line, or are within two edits of one that
    stands for them, are cut out of the text.  A document that had words and
    has none left goes."""
    words = F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    had, lines, twins = fresh(docs.columns, "had", "lines", "twins")
    cut = line_dedup.dedup_lines(docs.withColumn(had, words), dropped_as=lines, twins_as=twins)
    return (
        cut.where(~F.col(had) | words)
        .withColumn("n_chars", F.when(F.size(lines) > 0, F.char_length("text").cast("long")).otherwise(F.col("n_chars")))
        .select(*docs.columns)
    )


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, that of the
    smallest id.  Rows of one id stay or go together; without an id they stay.
    Column names may clash with any of ours."""
    found = setsketch.near_duplicates(docs, threshold=NEAR_THRESHOLD)
    gone = found.where("doc_id is not null").groupBy("doc_id").agg(F.bool_or("kept").alias("kept")).where("not kept")
    return docs.join(written(gone.select("doc_id"), "pipeline-gone"), "doc_id", "left_anti").select(*docs.columns)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources are brought to their target weights: a document stands in the
    result as often as the mix uses it, 0 to 3 times.  Of rows that repeat id, size
    and source it is defined how many stand, not which ones.  Column names may
    clash with any of ours."""
    size, members = word_count(F.col("text")), F.array("source")
    mixed, _, _ = mixing.mix(docs, size=size, members=members)
    i, n, m, least, more, use = fresh(docs.columns, "id", "size", "members", "least", "more", "use")
    uses = written(
        mixed.where("size > 0").groupBy(F.col("doc_id").alias(i), F.col("size").alias(n), F.col("members").alias(m))
        .agg(F.expr("min(taken div size)").alias(least), F.expr("sum(taken div size) - count(*) * min(taken div size)").alias(more)),
        "pipeline-uses",
    ).where(F.col(least) + F.col(more) > 0)
    same = docs["doc_id"].eqNullSafe(F.col(i)) & (size == F.col(n)) & (members == F.col(m))
    times = lambda df, uses: df.withColumn(use, F.explode(F.sequence(F.lit(1), uses))).select(*docs.columns)
    out = times(docs.join(uses.where(F.col(least) > 0), same), F.col(least))
    # Repeated rows that the cut goes through: so many of them stand once more.
    cut = uses.where(F.col(more) > 0)
    if cut.isEmpty():
        return out
    rank = F.row_number().over(Window.partitionBy(i, n, m).orderBy(F.xxhash64("text")))
    return out.unionByName(docs.join(cut, same).withColumn(use, rank).where(F.col(use) <= F.col(more)).select(*docs.columns))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their place in sequences of 4096 tokens."""
    return packing.pack(docs)


STAGES = [
    ("quality classifier", quality_stage),
    ("line dedup", line_stage),
    ("near dedup", near_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]
#: Learnt scores, sketches and tokens have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
