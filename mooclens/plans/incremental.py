"""Builds of new days only (M3 append): the gap reports without their history.

The reports that look back (R13, R16, R31, R33) need, of all earlier days, just the last event
of each learner, by class or module. Every built day stores these last values
(``_carry/<state>/day=...``), and every build the state as of its last day
(``_snapshot/<state>/<day>``); a day is then computed from its own log
partition and the latest snapshot before it. A day that comes late, or again, changes what later days
looked up, so all built days after it are built again in the same pass.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mooclens.operators import activity, language, timing
from mooclens.operators.logs import forum_events, video_stats_day
from mooclens.plans.reports import resolve_all
from mooclens.session import delete_path, list_folder, path_exists, scratch_path, scratch_scope, shuffles_end, stored_scratch, swap_folder


@dataclass
class State:
    """Last values that later days look up."""
    of_day: Callable[[DataFrame], DataFrame]  # log -> day, keys, values that ``max`` merges
    keys: list[str]
    values: list[str]
    wrapped: bool = False  # values are (order, value)


STATES = {
    "activity": State(timing.activity_state, timing.KEYS, timing.ACTIVITY_VALUES),
    "asset": State(timing.asset_state, timing.ASSET_KEYS, timing.ASSET_VALUES),
    "trlang": State(language.trlang_state, language.KEYS, [f"_lag_{n}" for n in language.LAGGED], True),
}
REPORT_STATE = {"time_on_task": "activity", "person_course_day": "activity", "time_on_asset_daily": "asset", "pc_day_trlang": "trlang"}


def _merged(df: DataFrame, state: State) -> DataFrame:
    return df.groupBy(*state.keys).agg(*[F.max(v).alias(v) for v in state.values])


def state_before(spark: SparkSession, out_dir: str, name: str, day: str) -> DataFrame | None:
    """Last values before a day: the latest snapshot before it and the days since."""
    state = STATES[name]
    snapshots = [d for d in list_folder(spark, f"{out_dir}/_snapshot/{name}") if d < day]
    days = [d for d in _built(spark, out_dir, name) if d < day]
    parts = []
    if snapshots:
        days = [d for d in days if d > snapshots[-1]]
        parts.append(spark.read.parquet(f"{out_dir}/_snapshot/{name}/{snapshots[-1]}"))
    parts += [spark.read.parquet(f"{out_dir}/_carry/{name}/day={d}") for d in days]
    if not parts:
        return None
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    return _merged(every, state) if len(parts) > 1 else every


def _built(spark: SparkSession, out_dir: str, name: str) -> list[str]:
    return [n.removeprefix("day=") for n in list_folder(spark, f"{out_dir}/_carry/{name}")]


def _report(name: str, tables, log: DataFrame, days: list[str], before: DataFrame | None, memo: dict, names: list[str]) -> DataFrame:
    if name == "time_on_task" and "person_course_day" not in names:  # no second reader: the learners' events are not stored
        return timing.time_on_task(log, before=before, by_size=True)
    if name in ("time_on_task", "person_course_day"):
        if "activity" not in memo:
            memo["activity"] = stored_scratch(log.sparkSession, timing.learner_activity(log, before=before, by_size=True), "activity")
        act = memo["activity"]
        if name == "time_on_task":
            return timing.time_on_task_from_activity(act)
        others = resolve_all(["person_problem", "course_problem", "course_axis", "user_info_combo"], tables)
        problems = others["person_problem"].where(F.to_date("date").isin(days))
        return activity.person_course_day_from_activity(act, video_stats_day(log), forum_events(log), problems, others["course_problem"], others["course_axis"],
                                                        others["user_info_combo"]).where(F.col("date").isin(days))
    if name == "time_on_asset_daily":
        return timing.time_on_asset_daily(log, before=before, by_size=True)
    return language.pc_day_trlang(log, before=before)


def build_days(spark: SparkSession, tables, out_dir: str, days: list[str], names: list[str] | None = None) -> list[str]:
    """Build reports of ``REPORT_STATE`` for days (``YYYY-MM-DD``) of the log, and again for all built
    days after the first of them; returns the days that were built.

    Each report is stored under ``out_dir/<name>``, partitioned by ``date``. Only the log partitions of
    those days are read, so ``log_date`` must be the day of ``time``. A whole build is written aside first and swapped in day by
    day, states last: a job that fails leaves the tables as they were, and one that dies during the swaps
    is mended by building the same days again.
    """
    with scratch_scope(spark):
        return _build(spark, tables, out_dir, days, names or list(REPORT_STATE))


def _build(spark, tables, out_dir, days, names) -> list[str]:
    states = sorted({REPORT_STATE[n] for n in names})
    later = {d for s in states for d in _built(spark, out_dir, s) if d >= min(days)}
    todo = sorted(set(days) | later)
    log = tables.tracking_log.where(F.col("log_date").isin([_date(d) for d in todo]))
    aside = scratch_path(spark, "days")
    before: dict[str, DataFrame | None] = {}
    for s in states:
        state = STATES[s]
        before[s] = state_before(spark, out_dir, s, todo[0])
        of_day = state.of_day(log)
        with shuffles_end(spark):
            of_day.write.partitionBy("day").parquet(f"{aside}/_carry/{s}")
        fresh = spark.read.schema(of_day.schema).parquet(f"{aside}/_carry/{s}").drop("day")  # what is stored, not the log again
        whole = fresh if before[s] is None else fresh.unionByName(before[s])
        with shuffles_end(spark):
            _merged(whole, state).write.parquet(f"{aside}/_snapshot/{s}")
    memo: dict = {}
    for name in names:
        state = STATES[REPORT_STATE[name]]
        early = before[REPORT_STATE[name]]
        if early is not None and state.wrapped:
            early = early.select(*state.keys, *[F.col(f"{v}.v").alias(v) for v in state.values])
        df = _report(name, tables, log, todo, early, memo, names)
        with shuffles_end(spark):
            df.hint("rebalance", "date").write.partitionBy("date").parquet(f"{aside}/{name}")
    for name in names:
        for d in todo:
            new = f"{aside}/{name}/date={d}"
            swap_folder(spark, new if path_exists(spark, new) else None, f"{out_dir}/{name}/date={d}")
    for s in states:
        for old in [d for d in list_folder(spark, f"{out_dir}/_snapshot/{s}") if d >= todo[0]]:
            delete_path(spark, f"{out_dir}/_snapshot/{s}/{old}")
        for old in list_folder(spark, f"{out_dir}/_snapshot/{s}")[:-2]:  # with the new one, three stay
            delete_path(spark, f"{out_dir}/_snapshot/{s}/{old}")
        empty = None
        for d in todo:
            new = f"{aside}/_carry/{s}/day={d}"
            if not path_exists(spark, new):  # a day without events is built, too
                empty = STATES[s].of_day(log.limit(0)).drop("day") if empty is None else empty
                empty.write.parquet(new := f"{aside}/_empty/{uuid.uuid4().hex}")
            swap_folder(spark, new, f"{out_dir}/_carry/{s}/day={d}")
        swap_folder(spark, f"{aside}/_snapshot/{s}", f"{out_dir}/_snapshot/{s}/{todo[-1]}")
    return todo


def _date(day: str):
    import datetime as dt
    return dt.date.fromisoformat(day)
