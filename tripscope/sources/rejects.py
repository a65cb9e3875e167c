"""What an explicit-schema CSV scan could not read.

A scan under a schema turns a cell that does not parse into NULL and a line of
the wrong length into a short row, without a trace.  Here the same scan keeps
such lines in a corrupt-record column; each is split once more, as text, and
compared with what was read: text where the typed cell is NULL is a rejected
cell.  Text columns can have a timestamp format of their own (the raw trip file
holds its times as text).  One scan; only rejected lines are split again.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Column name of a rejected line none of whose cells is to blame (its length is).
WHOLE_LINE = "*"


def _fresh(name: str, taken: list[str]) -> str:
    lower = {c.lower() for c in taken}
    while name.lower() in lower:
        name = f"_{name}"
    return name


def rejected_rows(
    spark: SparkSession, path: str, schema: T.StructType, formats: Mapping[str, str] | None = None
) -> DataFrame:
    """file, line (the text of it; NULL if only a time of a text column is
    unreadable), columns (names of the rejected cells) of every line that does
    not fit ``schema`` or ``formats`` (text column -> timestamp format)."""
    line = _fresh("_line", schema.names)
    declared = T.StructType([*schema.fields, T.StructField(line, T.StringType())])
    read = spark.read.csv(path, header=True, schema=declared, mode="PERMISSIVE", columnNameOfCorruptRecord=line)
    text_schema = ", ".join(f"`{c}` string" for c in schema.names)
    again = _fresh("_cells", [*schema.names, line])
    df = read.select("*", F.from_csv(F.col(line), text_schema).alias(again), F.col("_metadata.file_path").alias("file"))

    def unread(f: T.StructField) -> Column:
        text = F.col(f"{again}.`{f.name}`")
        return F.col(line).isNotNull() & F.col(f"`{f.name}`").isNull() & (F.trim(text) != "")

    def no_time(column: str, ts_format: str) -> Column:
        c = F.col(f"`{column}`")
        return c.isNotNull() & F.try_to_timestamp(c, F.lit(ts_format)).isNull()

    bad = [F.when(unread(f), F.lit(f.name)) for f in schema.fields if not isinstance(f.dataType, T.StringType)]
    bad += [F.when(no_time(c, fmt), F.lit(c)) for c, fmt in (formats or {}).items()]
    found = F.array_compact(F.array(*bad)) if bad else F.array().cast("array<string>")
    return (
        df.select("file", F.col(line).alias("line"), found.alias("columns"))
        .where(F.col("line").isNotNull() | (F.size("columns") > 0))
        .select("file", "line", F.when(F.size("columns") > 0, F.col("columns")).otherwise(F.array(F.lit(WHOLE_LINE))).alias("columns"))
    )


def rejected_cells(
    spark: SparkSession, path: str, schema: T.StructType, formats: Mapping[str, str] | None = None
) -> DataFrame:
    """file, column, bad_cells: how many cells of each file's column were not
    read (column ``*``: lines of another length)."""
    return (
        rejected_rows(spark, path, schema, formats)
        .select("file", F.explode("columns").alias("column"))
        .groupBy("file", "column")
        .agg(F.count(F.lit(1)).alias("bad_cells"))
    )
