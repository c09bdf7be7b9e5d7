"""The hour-split previous-value operator equals the plain window, also for a hot key."""

import datetime as dt

from pyspark.sql import functions as F

import pytest
from mooclens.functions import windows
from mooclens.functions.windows import lag_values, previous_parts, previous_values
from mooclens.operators import timing


def _events(spark):
    t0 = dt.datetime(2024, 1, 1, 23, 0, 0)
    rows = []
    seq = 0
    # one hot user with events every 7 minutes over two days, a few quiet users
    for i in range(400):
        rows.append(("c", "hot", t0 + dt.timedelta(minutes=7 * i), seq, "v" if i % 3 else None))
        seq += 1
    for u in range(5):
        for i in range(3):
            rows.append(("c", f"u{u}", t0 + dt.timedelta(hours=5 * i, minutes=u), seq, None if i == 1 else "x"))
            seq += 1
    return spark.createDataFrame(rows, "course_id string, username string, time timestamp, seq long, tag string")


def test_bucketed_equals_plain(spark):
    df = _events(spark)
    vals = {"prev": F.col("time"), "prev_tag_time": F.when(F.col("tag").isNotNull(), F.col("time"))}
    keys, order = ["course_id", "username"], ["time", "seq"]
    plain = previous_values(df, keys, order, vals, None).orderBy("seq").collect()
    split = previous_values(df, keys, order, vals, F.date_trunc("hour", "time")).orderBy("seq").collect()
    mono = previous_values(df, keys, order, vals, F.date_trunc("hour", "time"), monotone=True).orderBy("seq").collect()
    assert plain == split == mono


def test_lag_values_carries_nulls(spark):
    df = _events(spark)
    keys, order = ["course_id", "username"], ["time", "seq"]
    a = lag_values(df, keys, order, {"prev_tag": "tag"}, None).orderBy("seq").collect()
    b = lag_values(df, keys, order, {"prev_tag": "tag"}, F.date_trunc("hour", "time")).orderBy("seq").collect()
    assert a == b
    hot = [r for r in a if r.username == "hot"]
    assert hot[0].prev_tag is None and hot[1].prev_tag is None and hot[2].prev_tag == "v"


@pytest.mark.parametrize("heavy", [0, 100, 10_000])
def test_parts_equal_the_split_window(spark, monkeypatch, heavy):
    """Whole keys, split keys and both, with earlier values, rows without a time and rows without a key."""
    odd = [("c", "u1", None, 901, "y"), (None, "u2", dt.datetime(2024, 1, 1, 5), 902, "y"), (None, "u2", dt.datetime(2024, 1, 2, 5), 903, "y"),
           ("c", "hot", None, 904, None), ("d", "u9", dt.datetime(2024, 1, 1, 5), 905, None)]
    df = _events(spark)
    df = df.unionByName(spark.createDataFrame(odd, df.schema))
    t = dt.datetime(2023, 12, 31)
    before = spark.createDataFrame([("c", "hot", t, None), ("c", "u1", t, t), (None, "u2", t, t), ("c", "gone", t, t)],
                                   "course_id string, username string, prev timestamp, prev_tag_time timestamp")
    keys, order, bucket = ["course_id", "username"], ["time", "seq"], F.date_trunc("hour", "time")
    vals = {"prev": F.col("time"), "prev_tag_time": F.when(F.col("tag").isNotNull(), F.col("time"))}
    needed = {"prev_tag_time": F.col("tag").isNotNull()}
    monkeypatch.setattr(windows, "HEAVY", heavy)
    for early in (None, before):
        want = previous_values(df, keys, order, vals, bucket, monotone=True, needed=needed, before=early).orderBy("seq").collect()
        parts = previous_parts(df, keys, order, vals, bucket, monotone=True, needed=needed, before=early)
        assert len(parts) == 2
        assert parts[0].unionByName(parts[1]).orderBy("seq").collect() == want


def test_days_of_quiet_keys_need_one_shuffle(spark):
    rows = [("c", f"u{i % 3}", dt.datetime(2024, 1, 1 + i % 2, i % 24), i, "problem_check", f"m{i % 2}") for i in range(60)]
    log = spark.createDataFrame(rows, "course_id string, username string, time timestamp, seq bigint, event_type string, module_id string")
    t = dt.datetime(2023, 12, 31)
    asset = spark.createDataFrame([("c", "u1", "m1", t)], "course_id string, username string, module_id string, last_time_umid timestamp")
    learner = asset.select("course_id", "username", *[F.col("last_time_umid").alias(v) for v in timing.ACTIVITY_VALUES])
    for out in (timing.time_on_asset_daily(log, before=asset, by_size=True), timing.time_on_task(log, before=learner, by_size=True)):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange") == 1 and "Join" not in plan


def test_module_tails(spark):
    texts = ["c/problem/p1", 'c/p")}', 'c/p"}', 'c/p"]}}', 'a\nb"}', 'b"}\n', 'x"y', 'x"}y"]}}', "", None]
    got = [r[0] for r in spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "i int, m string").orderBy("i").select(timing._strip_module_tail(F.col("m"))).collect()]
    assert got == ["c/problem/p1", 'c/p")}', "c/p", "c/p", "b", "b", 'x"y', 'x"}y', "", None]
