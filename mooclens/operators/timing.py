"""Time-on-task reports: gaps between a learner's consecutive events.

A gap counts towards a total when it is shorter than a cutoff (idle time beyond
the cutoff is not time on task).  The previous-event lookups run through
``previous_values`` so one very active account is spread over many tasks;
with ``by_size``, as in builds of new days, only accounts (and modules) with many rows are.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mooclens.functions.columns import growing
from mooclens.functions.windows import DEFAULT_BUCKET, last_values, previous_parts, previous_values, time_bucket
from mooclens.operators.logs import log_window

KEYS = ["course_id", "username"]
ORDER = ["time", "seq"]

# Event classes of the time-on-task report (fixed values).
CLASSES = ["video", "problem", "forum", "text"]


def _class_flags(et):
    return {
        # a plain search first: the patterns are tried on few texts
        "video": (et.contains("_video") | et.contains("_transcript")) & et.rlike(r"\w_video|\w_transcript"),
        "problem": et.contains("problem_") & et.rlike(r"problem_\w"),
        "forum": (et.startswith("edx.forum.") | et.contains("/discussion/forum")
                  | et.contains("/discussion/threads") | et.contains("/discussion/comments")),
        "text": et.startswith("textbook.") | et.contains("/wiki/"),
    }


def _secs(later: str, earlier: str):
    """Whole seconds between two timestamps, truncated, as double."""
    return F.expr(f"timestampdiff(SECOND, {earlier}, {later})").cast("double")


def _sum_below(x, limit):
    return F.sum(F.when(x < limit, x))


def activity_rows(log: DataFrame, start=None, end=None) -> DataFrame:
    """Learner events with their class flags."""
    et = F.col("event_type")
    flags = _class_flags(et)
    x = (log_window(log, start, end)
         .where(~et.contains("/xblock/") & F.col("username").isNotNull() & (F.col("username") != ""))
         .select("course_id", "username", "time", "seq", "event_type",
                 *[flags[n].alias(f"is_{n}") for n in CLASSES]))
    is_x = F.col("is_video") | F.col("is_problem") | F.col("is_forum") | F.col("is_text")
    return x.withColumn("is_xevent", is_x)


#: Values whose last occurrence a learner's next event looks up, and the rows that look them up.
ACTIVITY_VALUES = ["last_time", *[f"last_{n}" for n in CLASSES], "last_xevent"]


def _activity_values():
    return {"last_time": F.col("time"), **{f"last_{n}": F.when(F.col(f"is_{n}"), F.col("time")) for n in CLASSES},
            "last_xevent": F.when(F.col("is_xevent"), F.col("time"))}


def learner_activity(log: DataFrame, start=None, end=None, bucket_unit: str | None = DEFAULT_BUCKET, before: DataFrame | None = None,
                     by_size: bool = False) -> DataFrame:
    """Learner events with their previous-event times (shared by R13 and R31).

    Rows: the log without ``/xblock/`` events and without an empty username;
    columns: ``course_id, username, time, seq, event_type``, the four class
    flags, ``is_xevent``, and the time of the previous event overall
    (``last_time``); on rows of a class also that of the previous event of the same class
    (``last_<class>``) and of any class
    (``last_xevent``).  One skew-safe window pass; a build stores it once and
    both reports read it.  ``before``: the last times of each learner before these rows.
    """
    return reduce(DataFrame.unionByName, _activity_parts(log, start, end, bucket_unit, before, by_size))


def _parts(by_size: bool, *args, **kwargs) -> list[DataFrame]:
    return previous_parts(*args, **kwargs) if by_size else [previous_values(*args, **kwargs)]


def _activity_parts(log: DataFrame, start=None, end=None, bucket_unit: str | None = DEFAULT_BUCKET, before: DataFrame | None = None,
                    by_size: bool = False) -> list[DataFrame]:
    """``learner_activity`` in parts without a common learner."""
    needed = {**{f"last_{n}": F.col(f"is_{n}") for n in CLASSES}, "last_xevent": F.col("is_xevent")}
    return _parts(by_size, activity_rows(log, start, end), KEYS, ORDER, _activity_values(), time_bucket("time", bucket_unit), monotone=True, needed=needed, before=before)


def activity_state(log: DataFrame) -> DataFrame:
    """Per (day, learner) the last times that ``learner_activity`` of later days looks up."""
    return last_values(activity_rows(log).withColumn("day", F.to_date("time")), ["day", *KEYS], ORDER, _activity_values(), monotone=True)


def time_on_task_from_activity(act: DataFrame, timeout_short: int = 5, timeout_long: int = 30) -> DataFrame:
    """R31 over ``learner_activity`` rows (see ``time_on_task``)."""
    x = act.where(F.col("last_time").isNotNull())
    dts = [_secs("time", "last_time").alias("dt")]
    for n in CLASSES:
        dts.append(F.when(F.col(f"is_{n}"), _secs("time", f"last_{n}")).alias(f"dt_{n}"))
        dts.append(F.when(F.col(f"is_{n}"), _secs("time", "last_xevent")).alias(f"serial_dt_{n}"))
    x = x.select("course_id", "username", F.to_date("time").alias("date"), *dts)
    s, lg = timeout_short * 60.0, timeout_long * 60.0
    aggs = [_sum_below(F.col("dt"), s).alias(f"total_time_{timeout_short}"),
            _sum_below(F.col("dt"), lg).alias(f"total_time_{timeout_long}")]
    for n in CLASSES:
        aggs += [_sum_below(F.col(f"dt_{n}"), s).alias(f"total_{n}_time_{timeout_short}"),
                 _sum_below(F.col(f"dt_{n}"), lg).alias(f"total_{n}_time_{timeout_long}"),
                 _sum_below(F.col(f"serial_dt_{n}"), lg).alias(f"serial_{n}_time_{timeout_long}")]
    return x.groupBy("course_id", "date", "username").agg(*aggs)


def time_on_task(log: DataFrame, timeout_short: int = 5, timeout_long: int = 30, start=None, end=None,
                 bucket_unit: str | None = DEFAULT_BUCKET, before: DataFrame | None = None, by_size: bool = False) -> DataFrame:
    """Per (user, day) time on the platform and per activity class.

    ``total_*`` use the gap to the previous event of the same class,
    ``serial_*`` the gap to the previous event of any class.  Cutoffs are in
    minutes and compared strictly on whole seconds.
    """
    return reduce(DataFrame.unionByName, [time_on_task_from_activity(act, timeout_short, timeout_long) for act in _activity_parts(log, start, end, bucket_unit, before, by_size)])


def time_on_task_totals(tot: DataFrame) -> DataFrame:
    """Time on task summed over days."""
    vals = [c for c in tot.columns if c not in ("course_id", "date", "username")]
    return tot.groupBy("course_id", "username").agg(*[F.sum(c).alias(c) for c in vals])


def _strip_module_tail(m):
    # module ids logged with a JSON tail: ...")} or ..."]}}
    tail = (F.when(m.rlike('"}$'), F.regexp_extract(m, '(.*)"}$', 1))
             .when(m.rlike('"]}}$'), F.regexp_extract(m, '(.*)"]}}$', 1))
             .otherwise(m))
    return F.when(m.contains('"'), tail).otherwise(m)  # most have none and meet no pattern


ASSET_KEYS = [*KEYS, "module_id"]
ASSET_VALUES = ["last_time_umid"]


def _asset_rows(log: DataFrame, start=None, end=None) -> DataFrame:
    return (log_window(log, start, end)
            .select("course_id", "username", "time", "seq", _strip_module_tail(F.col("module_id")).alias("module_id"))
            .where(F.col("module_id").isNotNull() & F.col("username").isNotNull() & (F.col("username") != "")
                   & ~F.col("module_id").contains('"')))


def asset_state(log: DataFrame) -> DataFrame:
    """Per (day, learner, module) the last time that ``time_on_asset_daily`` of later days looks up."""
    return last_values(_asset_rows(log).withColumn("day", F.to_date("time")), ["day", *ASSET_KEYS], ORDER, {"last_time_umid": F.col("time")}, monotone=True)


def time_on_asset_daily(log: DataFrame, start=None, end=None, bucket_unit: str | None = DEFAULT_BUCKET, before: DataFrame | None = None,
                        by_size: bool = False) -> DataFrame:
    """Per (day, module, user) seconds between consecutive events on the same module."""
    parts = _parts(by_size, _asset_rows(log, start, end), ASSET_KEYS, ORDER, {"last_time_umid": F.col("time")},
                   time_bucket("time", bucket_unit), monotone=True, before=before)
    return reduce(DataFrame.unionByName, [_asset_days(x) for x in parts])


def _asset_days(x: DataFrame) -> DataFrame:
    dt = F.expr("timestampdiff(SECOND, last_time_umid, time)")
    return (x.select("course_id", F.to_date("time").alias("date"), "username", "module_id", dt.alias("dt_umid"))
            .groupBy("course_id", "date", "username", "module_id")
            .agg(_sum_below(F.col("dt_umid"), 5 * 60).cast("double").alias("time_umid5"),
                 _sum_below(F.col("dt_umid"), 30 * 60).cast("double").alias("time_umid30")))


def time_on_asset_totals(daily: DataFrame, person_course: DataFrame) -> DataFrame:
    """Per module users, mean per-user time, median daily time, totals; all and certified only.

    Medians are exact (``percentile_cont`` as a grouped aggregate, which keeps
    a value->count map per group and merges it map-side) and are computed over
    the daily rows; means over per-user sums.
    """
    pc = person_course.where(F.col("nproblem_check") > 0).select("course_id", "username", "certified")
    d = daily.where(F.col("time_umid5").isNotNull()).join(growing(pc), ["course_id", "username"])
    cert = F.col("certified")
    keys = ["course_id", "module_id"]

    def med(c):
        return F.percentile(c, 0.5)

    medians = d.groupBy(*keys).agg(
        med("time_umid5").alias("median_tmid5"), med("time_umid30").alias("median_tmid30"),
        med(F.when(cert, F.col("time_umid5"))).alias("cert_median_tmid5"),
        med(F.when(cert, F.col("time_umid30"))).alias("cert_median_tmid30"))
    per_user = d.groupBy(*keys, "username").agg(
        F.max(F.coalesce(cert, F.lit(False)).cast("int")).alias("is_certified"),
        F.sum("time_umid5").alias("t5"), F.sum("time_umid30").alias("t30"),
        F.sum(F.when(cert, F.col("time_umid5"))).alias("c5"), F.sum(F.when(cert, F.col("time_umid30"))).alias("c30"))
    totals = per_user.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_unique_users"),
        F.sum("is_certified").cast("bigint").alias("n_unique_certified"),
        F.avg("t5").alias("mean_tmid5"), F.avg("c5").alias("cert_mean_tmid5"),
        F.avg("t30").alias("mean_tmid30"), F.avg("c30").alias("cert_mean_tmid30"),
        F.sum("t5").alias("total_tmid5"), F.sum("c5").alias("cert_total_tmid5"),
        F.sum("t30").alias("total_tmid30"), F.sum("c30").alias("cert_total_tmid30"))
    return totals.join(medians, keys).select(
        "course_id", "module_id", "n_unique_users", "n_unique_certified", "mean_tmid5", "cert_mean_tmid5",
        "mean_tmid30", "cert_mean_tmid30", "median_tmid5", "cert_median_tmid5", "median_tmid30",
        "cert_median_tmid30", "total_tmid5", "cert_total_tmid5", "total_tmid30", "cert_total_tmid30")
