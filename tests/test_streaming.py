"""Incremental preparation equals the batch preparation, and a second
run over the same files adds nothing (exactly-once via the checkpoint)."""

from __future__ import annotations

from tests.conftest import SF_SMALL
from tripscope import registry
from tripscope.operators.prepare import prepare_trips
from tripscope.sources import files
from tripscope.streaming import start_prepare_stream


def test_stream_prepare_equals_batch(spark, tmp_path):
    src = registry.raw_csv_path(spark, SF_SMALL)
    schema = registry.raw_csv_schema()
    out, ckpt = str(tmp_path / "out"), str(tmp_path / "ckpt")
    q = start_prepare_stream(spark, src, schema, out, ckpt, max_files_per_trigger=2)
    q.awaitTermination(300)
    streamed = spark.read.parquet(out)
    batch = prepare_trips(files.csv_explicit_scan(spark, src, schema))
    streamed = streamed.select(*batch.columns)
    assert streamed.count() == batch.count() > 0
    assert streamed.exceptAll(batch).count() == 0
    # re-running finds no new files: the checkpoint already holds them all
    q2 = start_prepare_stream(spark, src, schema, out, ckpt)
    q2.awaitTermination(300)
    assert spark.read.parquet(out).count() == batch.count()
