"""Incremental tracking-log ingest (the "append today's files" workflow).

New log files dropped into a landing folder go, a micro-batch of whole files at a
time, through the batch split job (``sources.logs.split_lines``): each file is parsed once, and rows and dead
letters stand in the same tables, partitioned by course, day and source file. A batch that is run again after a
restart replaces the rows of its own files, so every file counts exactly once. There is
no streaming state: every line is processed on its own.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from mooclens.session import checkpoint_dir
from mooclens.sources.logs import split_lines


def start_log_ingest(spark: SparkSession, landing: str, out_dir: str, name: str = "tracking_log",
                     courses: list[str] | None = None, dynamic_date: bool = True, available_now: bool = True,
                     max_files_per_trigger: int = 100) -> StreamingQuery:
    """Start the streaming split job into ``out_dir/tracking_log`` and ``out_dir/dead_letters``.

    ``available_now`` processes what has landed and stops (scheduled runs);
    otherwise it keeps polling every minute. ``name`` names the checkpoint.
    """
    lines = (spark.readStream.option("maxFilesPerTrigger", max_files_per_trigger).text(landing)
             .withColumn("_file", F.input_file_name()))
    # a stable per-line tie-break for equal timestamps (line text + file)
    lines = lines.withColumn("seq", F.xxhash64("value", "_file"))

    def batch(df, _):
        split_lines(df, out_dir, courses, dynamic_date)

    w = lines.writeStream.foreachBatch(batch).option("checkpointLocation", f"{checkpoint_dir(spark)}/mooclens-stream/{name}")
    return (w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")).start()


def run_log_ingest_once(spark: SparkSession, landing: str, out_dir: str, **kw) -> None:
    """Process everything that has landed, then return."""
    start_log_ingest(spark, landing, out_dir, available_now=True, **kw).awaitTermination()
