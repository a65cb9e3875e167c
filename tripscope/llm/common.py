"""Helpers shared by the operators: table scans, tables written to the shared
folder, the byte-wise lower case and the word rule, and Arrow row builders."""

from __future__ import annotations

import string
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterable
from pathlib import Path

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripscope.session import shared_dir

#: A word: a run of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Scan of one input table, pruned to ``columns`` (all if none named)."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: the lineage ends there, and a
    lost executor costs a re-read, not a recomputation.  Each call writes a
    path of its own, so no earlier frame loses its files."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only, NULL as empty.  Pure ASCII text takes the fast
    path; in other text only the 26 letters may change."""
    t = F.coalesce(text, F.lit(""))
    ascii_only = F.octet_length(t) == F.char_length(t)
    return F.when(ascii_only, F.lower(t)).otherwise(
        F.translate(t, string.ascii_uppercase, string.ascii_lowercase)
    )


def word_count(text: Column) -> Column:
    """Number of words (``WORD``); NULL as 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def held_out(doc_id: Column) -> Column:
    """crc32(doc_id as text) mod 3 is 1; a NULL id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def drawn(key: Column, seed: int, wanted: int, total: Column | int) -> Column:
    """Is the row one of about ``wanted`` of ``total``, by a hash of its key?  The
    hash has 63 bits, so the share is above 0 for any table that can be stored."""
    h = F.xxhash64(F.lit(seed), key)
    # Its lowest 20 bits lead, the others follow.
    place = F.shiftleft(h.bitwiseAND(F.lit((1 << 20) - 1)), 43).bitwiseOR(F.shiftrightunsigned(h, 21))
    if isinstance(total, int):
        return place < F.lit(min((1 << 63) - 1, (1 << 63) * wanted // max(total, 1)))
    share = F.lit(float(1 << 63) * wanted) / total.cast("double")
    return (total <= wanted) | (place.cast("double") < share)


def fresh(taken: Iterable[str], *names: str) -> list[str]:
    """Column names like ``names`` that are not among ``taken`` (whatever the
    case), nor among each other."""
    used, out = {c.lower() for c in taken}, []
    for name in names:
        while name.lower() in used:
            name = f"_{name}"
        used.add(name.lower())
        out.append(name)
    return out


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the executors this package, once per application, as
    ``spark-submit --py-files`` would: functions that run in tasks refer to
    modules of it.  A package that came as a zip is there already."""
    sc = spark.sparkContext
    root = Path(__file__).resolve().parent.parent
    if sc.applicationId in _SHIPPED or not root.is_dir():
        return
    path = Path(tempfile.mkdtemp()) / f"{root.name}.zip"
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    sc.addPyFile(str(path))
    _SHIPPED.add(sc.applicationId)


_OF_ONE_TASK: list = []


def of_one_task(container):
    """A list or dict that serves a task and is emptied after it: worker processes
    live on, and what each operator leaves in them would add up over a job."""
    _OF_ONE_TASK.append(container)
    return container


def task_done() -> None:
    for container in _OF_ONE_TASK:
        container.clear()
    pa.default_memory_pool().release_unused()


def mapped(df: DataFrame, function: Callable, schema) -> DataFrame:
    """``df.mapInArrow`` with the package at hand in the tasks."""
    ship_package(df.sparkSession)

    def run(batches):
        try:
            yield from function(batches)
        finally:
            task_done()

    return df.mapInArrow(run, schema)


def slices(batch: pa.RecordBatch, text: str | int, limit_bytes: int = 4 << 20):
    """Rows of a batch in runs of about ``limit_bytes`` of text, so that what a
    task holds as Python objects does not follow the batch's row count."""
    column = batch.column(text)
    sizes = pa.compute.fill_null(pa.compute.binary_length(column), 0).to_numpy(zero_copy_only=False)
    start = total = 0
    for i, n in enumerate(sizes):
        if i > start and total + n > limit_bytes:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += int(n)
    if start < batch.num_rows:
        yield batch.slice(start)
