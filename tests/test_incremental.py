"""Days built one by one, also late and again, equal one build of all days, and read their own log partitions only."""

import pytest
from pyspark.sql import functions as F

from mooclens.operators import timing
from mooclens.plans import incremental
from mooclens.plans.incremental import REPORT_STATE, build_days, state_before
from mooclens.plans.reports import resolve
from mooclens.session import list_folder


class Some:
    """The bridged tables with another log."""

    def __init__(self, tables, log):
        self._tables, self.tracking_log = tables, log

    def __getattr__(self, name):
        return getattr(self._tables, name)


@pytest.fixture(scope="module")
def days(tables):
    return sorted(str(r[0]) for r in tables.tracking_log.select("log_date").distinct().collect())[:4]


def full(tables, days, name):
    log = tables.tracking_log.where(F.col("log_date").isin(days))
    out = resolve(name, Some(tables, log))
    return out.where(F.col("date").isin(days))


def rows(df, like):
    cols = [F.col(c).cast(like.schema[c].dataType) for c in sorted(like.columns)]
    cols = [F.round(c, 6) if like.schema[n].dataType.simpleString() == "double" else c for n, c in zip(sorted(like.columns), cols)]
    return sorted(map(str, df.select(*cols).toDF(*sorted(like.columns)).collect()))


def test_days_one_by_one(spark, tables, days, tmp_path):
    a, b, c, d = days
    out = str(tmp_path / "out")
    assert build_days(spark, tables, out, [a]) == [a]
    assert build_days(spark, tables, out, [c]) == [c]
    assert build_days(spark, tables, out, [b]) == [b, c]  # late: what c looked up has changed
    assert build_days(spark, tables, out, [d]) == [d]
    for name, state in REPORT_STATE.items():
        want = full(tables, days, name)
        assert rows(spark.read.parquet(f"{out}/{name}"), want) == rows(want, want), name
        assert list_folder(spark, f"{out}/_carry/{state}") == [f"day={x}" for x in days]
        assert list_folder(spark, f"{out}/_snapshot/{state}")[-1] == d


def test_reads_only_its_days(spark, tables, days, tmp_path):
    out = str(tmp_path / "out")
    build_days(spark, tables, out, days[:2], ["time_on_asset_daily"])
    before = state_before(spark, out, "asset", days[2])
    assert "tracking_log" not in before._jdf.queryExecution().executedPlan().toString()
    log = tables.tracking_log.where(F.col("log_date").isin([incremental._date(days[2])]))
    plan = timing.activity_rows(log)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(log_date" in plan or f"(log_date" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_failed_build_leaves_the_days(spark, tables, days, tmp_path, monkeypatch):
    out = str(tmp_path / "out")
    build_days(spark, tables, out, days[:1], ["time_on_task"])
    old = rows(spark.read.parquet(f"{out}/time_on_task"), spark.read.parquet(f"{out}/time_on_task"))
    monkeypatch.setattr(incremental, "_report", lambda *a: tables.tracking_log.select(F.raise_error(F.lit("lost")).alias("x"), F.col("log_date").alias("date")))
    with pytest.raises(Exception, match="lost"):
        build_days(spark, tables, out, days[:2], ["time_on_task"])
    again = spark.read.parquet(f"{out}/time_on_task")
    assert rows(again, again) == old and list_folder(spark, f"{out}/_carry/activity") == [f"day={days[0]}"]
