"""Driver contract and whole-report invariants on the smallest data set."""

import re

import __spark_entry__ as E
from pyspark.sql import functions as F


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "total_time_5" in df.columns


def test_every_query_has_an_oracle():
    without = set(E.queries()) - set(E.oracle_sql())
    assert not [q for q in without if not re.match(r"op\d+_|pipeline$", q)]


def test_person_course_one_row_per_enrolled_user(spark, tables):
    pc = E.queries()["person_course"](spark, "/root/testdata/sf0.001")
    assert pc.select("course_id", "user_id").distinct().count() == tables.user_info_combo.count()


def test_ingest_conserves_lines(spark, tables):
    from mooclens.sources.logs import ingest_lines
    raw = tables.raw_log_lines
    rows, dead = ingest_lines(raw)
    assert rows.count() + dead.count() == raw.count()
