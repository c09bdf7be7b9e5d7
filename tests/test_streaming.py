"""Streaming ingest gives the same rows as the batch ingest and resumes from its checkpoint."""

from mooclens.sources.logs import ingest_lines, split_tracking_logs
from mooclens.streaming.log_stream import run_log_ingest_once


def test_stream_matches_batch(spark, tables, tmp_path):
    import uuid
    name = "t" + uuid.uuid4().hex[:10]   # checkpoints live in the shared folder: one per run
    raw = tables.raw_log_lines
    landing = tmp_path / "landing"
    raw.select("value").coalesce(2).write.text(str(landing / "day1"))
    out = tmp_path / "out"
    run_log_ingest_once(spark, str(landing / "*"), str(out), name=name)
    got = spark.read.parquet(str(out / "tracking_log"))
    rows, dead = ingest_lines(raw)
    assert got.count() == rows.count()
    assert spark.read.parquet(str(out / "dead_letters")).count() == dead.count()
    # a second run with no new files adds nothing
    run_log_ingest_once(spark, str(landing / "*"), str(out), name=name)
    assert spark.read.parquet(str(out / "tracking_log")).count() == rows.count()
    # the batch job fills the same table: the same files again replace their rows
    split_tracking_logs(spark, str(landing / "*"), str(out), dynamic_date=True)
    again = spark.read.parquet(str(out / "tracking_log"))
    assert again.count() == rows.count() and set(again.columns) == set(got.columns)
