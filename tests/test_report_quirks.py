"""Report semantics that must hold, on small hand-made logs."""

import datetime as dt

from pyspark.sql import functions as F

from mooclens.operators import activity, logs, timing

T0 = dt.datetime(2024, 3, 1, 10, 0, 0)


def _log(spark, events):
    rows = []
    for i, (user, secs, et) in enumerate(events):
        t = T0 + dt.timedelta(seconds=secs)
        rows.append((i, "A/B/C", t, t.date(), user, "1.2.3.4", "agent", "browser", et, None, None, "{}",
                     (None, None, "A/B/C"), (None, None, None, None, None, None, None, None, None)))
    schema = ("seq long, course_id string, time timestamp, log_date date, username string, ip string, agent string,"
              " event_source string, event_type string, module_id string, page string, event string,"
              " context struct<user_id:bigint,path:string,course_id:string>,"
              " event_struct struct<user_id:bigint,mode:string,query:string,GET:string,POST:string,"
              "answers:string,attempts:bigint,success:string,grade:double>")
    return spark.createDataFrame(rows, schema)


def test_time_on_task_strict_whole_second_cutoffs(spark):
    # gaps: 299.x (kept under 5 min), 300 (not < 300), 1799 (kept under 30 min)
    log = _log(spark, [("u", 0, "play_video"), ("u", 299.9, "play_video"), ("u", 599.9, "play_video"),
                       ("u", 2398.9, "play_video")])
    r = timing.time_on_task(log).first()
    assert r.total_time_5 == 299.0
    assert r.total_time_30 == 299.0 + 300.0 + 1799.0
    assert r.total_video_time_5 == 299.0 and r.serial_video_time_30 == 299.0 + 300.0 + 1799.0


def test_time_on_task_totals_sum_days(spark):
    log = _log(spark, [("u", 0, "play_video"), ("u", 60, "problem_check"), ("u", 86400, "play_video"),
                       ("u", 86460, "textbook.x")])
    daily = timing.time_on_task(log)
    tot = timing.time_on_task_totals(daily).first()
    s = daily.agg(F.sum("total_time_30").alias("s")).first().s
    assert tot.total_time_30 == s


def test_time_on_task_params_name_columns(spark):
    log = _log(spark, [("u", 0, "play_video"), ("u", 100, "play_video")])
    cols = timing.time_on_task(log, timeout_short=2, timeout_long=10).columns
    assert "total_time_2" in cols and "serial_text_time_10" in cols


def test_enrollday_filter_is_parenthesised(spark):
    log = _log(spark, [("u", 0, "edx.course.enrollment.activated"), ("u", 86400 * 3, "edx.course.enrollment.deactivated")])
    out = logs.enrollday_all(log, start="2024-03-02", end="2024-03-10").collect()
    assert len(out) == 1 and out[0].time.day == 4


def test_modal_ip_tie_breaks_on_address(spark):
    rows = [("u", "9.9.9.9"), ("u", "1.1.1.1"), ("u", "1.1.1.1"), ("u", "9.9.9.9")]
    df = spark.createDataFrame([(u, ip, dt.date(2024, 1, 1), 1, "A/B/C") for u, ip in rows],
                               "username string, ip string, date date, ipcount long, course_id string")
    r = logs.course_modal_ip(df).first()
    assert r.modal_ip == "1.1.1.1" and r.ip_count == 2 and r.n_different_ip == 2


def test_person_course_day_gap_cap_is_inclusive(spark):
    log = _log(spark, [("u", 0, "seq_goto"), ("u", 300, "seq_goto"), ("u", 600.5, "seq_goto")])
    empty = spark.createDataFrame([], "date date, username string, video_id string, position double, course_id string")
    fe = spark.createDataFrame([], "time timestamp, username string, course_id string, forum_action string, thread_id string")
    pp = spark.createDataFrame([], "user_id long, course_id string, problem_nid long, n_attempts long, date timestamp")
    cp = spark.createDataFrame([], "course_id string, problem_nid long, problem_id string")
    ax = spark.createDataFrame([], "course_id string, url_name string, data struct<itype:string>")
    uic = spark.createDataFrame([], "course_id string, user_id long, username string")
    r = activity.person_course_day(log, empty, fe, pp, cp, ax, uic).first()
    assert r.n_dt == 1 and r.sum_dt == 300.0 and r.nevents == 3 and r.nvideos_viewed == 1  # '' counts once
