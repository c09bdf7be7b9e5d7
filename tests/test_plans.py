"""Scale properties of the physical plans (checked on explain output)."""

import io
from contextlib import redirect_stdout

from mooclens.operators import logs, timing


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _formatted(df):
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_date_window_prunes_partitions_and_pushes_filters(tables):
    df = logs.show_answer(tables.tracking_log, start="2024-01-10", end="2024-01-12")
    text = _formatted(df)
    assert "PartitionFilters: [isnotnull(log_date" in text and "2024-01-10" in text
    assert "PushedFilters: [In(event_type" in text
    # only the columns the report reads are scanned
    assert "ReadSchema: struct<time:timestamp,username:string,event_type:string,module_id:string>" in text


def test_gap_window_is_split_below_the_learner(tables):
    text = _plan(timing.time_on_task(tables.tracking_log))
    # the window's shuffle is keyed by course, learner and the hour bucket
    assert "hashpartitioning(course_id" in text and "_pv_bucket" in text
    assert "Window [" in text


def test_modal_ip_is_an_aggregate_not_a_sort(tables):
    text = _plan(logs.course_modal_ip(logs.pc_day_ip_counts(tables.tracking_log)))
    assert "row_number" not in text and "Window" not in text


def test_gap_window_scans_the_log_once(spark, tables):
    """The log is read by the one job that stores the window's rows; the report's own plan reads those."""
    log_files = {f.rsplit("/", 1)[0].split("/tracking_log")[0] for f in tables.tracking_log.inputFiles()}
    report = timing.time_on_task(tables.tracking_log)
    assert all("/window-" in f for f in report.inputFiles()) and log_files
