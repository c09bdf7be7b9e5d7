"""Report catalogue and dependency-ordered builds (M3).

``CATALOG`` maps each report to its operator and the tables it reads.  Inputs
are either base tables (ingest outputs) or other reports; ``resolve`` builds
what a report needs, memoising shared intermediates so a plan that reads, say,
``person_course_day`` twice, reuses one DataFrame (Catalyst then shares the
scan and exchange where it can).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from functools import partial

from pyspark.sql import DataFrame

from mooclens.session import stored_scratch
from mooclens.operators import activity, forum, grades, items, language, learner, logs, timing, video

BASE_TABLES = ("tracking_log", "course_axis", "forum", "user_info_combo", "problem_analysis", "studentmodule",
               "grading_policy", "grades_persistent", "roles", "geoip", "youtube")


@dataclass
class Report:
    fn: Callable[..., DataFrame]
    inputs: list[str]
    optional: list[str] = field(default_factory=list)
    params: list[str] = field(default_factory=list)   # parameter names the operator accepts
    multi_use: bool = False   # the operator reads its inputs in more than one branch
    internal: bool = False    # a shared intermediate, built and stored but not a report of its own
    stored: bool = False      # as an input it is stored even for one reader: it is smaller than the shuffles that make it


CATALOG: dict[str, Report] = {
    "show_answer": Report(logs.show_answer, ["tracking_log"], params=["start", "end"]),
    "problem_check": Report(logs.problem_check, ["tracking_log"], params=["start", "end"]),
    "enrollment_events": Report(logs.enrollment_events, ["tracking_log"], params=["start", "end"]),
    "enrollday_all": Report(logs.enrollday_all, ["tracking_log"], params=["start", "end"]),
    "person_enrollment_verified": Report(logs.person_enrollment_verified, ["enrollment_events"]),
    "pc_day_ip_counts": Report(logs.pc_day_ip_counts, ["tracking_log"], params=["start", "end"]),
    "course_modal_ip": Report(logs.course_modal_ip, ["pc_day_ip_counts"]),
    "pc_day_agent_counts": Report(logs.pc_day_agent_counts, ["tracking_log"], params=["start", "end"]),
    "course_modal_agent": Report(logs.course_modal_agent, ["pc_day_agent_counts"]),
    "video_stats_day": Report(logs.video_stats_day, ["tracking_log"], params=["start", "end"]),
    "forum_events": Report(logs.forum_events, ["tracking_log"], params=["start", "end"]),
    "ora_events": Report(logs.ora_events, ["tracking_log"], params=["start", "end"]),
    # one skew-safe previous-event pass over the log, read by time_on_task and person_course_day; learners with few rows are not split
    "learner_activity": Report(partial(timing.learner_activity, by_size=True), ["tracking_log"], params=["start", "end"], internal=True),
    "time_on_task": Report(timing.time_on_task_from_activity, ["learner_activity"],
                           params=["timeout_short", "timeout_long"]),
    "time_on_task_totals": Report(timing.time_on_task_totals, ["time_on_task"]),
    "time_on_asset_daily": Report(timing.time_on_asset_daily, ["tracking_log"], params=["start", "end"]),
    "pc_day_trlang": Report(language.pc_day_trlang, ["tracking_log"], params=["start", "end"]),
    "language_multi_transcripts": Report(language.language_multi_transcripts, ["pc_day_trlang"]),
    "course_modal_language": Report(language.course_modal_language, ["language_multi_transcripts"]),
    "problem_grades": Report(grades.problem_grades, ["studentmodule"]),
    "chapter_grades": Report(grades.chapter_grades, ["problem_grades", "course_axis"]),
    "pc_nchapters": Report(grades.pc_nchapters, ["studentmodule", "course_axis"]),
    "show_answer_stats_by_user": Report(grades.show_answer_stats_by_user,
                                        ["problem_grades", "show_answer", "user_info_combo"]),
    "show_answer_stats_by_course": Report(grades.show_answer_stats_by_course, ["show_answer_stats_by_user"]),
    "course_item": Report(items.course_item, ["problem_analysis", "course_axis", "grading_policy"],
                          params=["min_responses"]),
    "person_item": Report(items.person_item, ["problem_analysis", "course_item"], stored=True),
    "person_problem": Report(items.person_problem, ["person_item", "course_item"], stored=True),
    "course_problem": Report(items.course_problem, ["person_item", "course_item"], stored=True),
    "pc_forum": Report(forum.pc_forum, ["forum"]),
    "forum_posts": Report(forum.forum_posts, ["forum"], params=["dedupe"]),
    "forum_person": Report(forum.forum_person, ["forum_posts", "forum_events"]),
    "video_axis": Report(video.video_axis, ["course_axis"], optional=["youtube"]),
    "pc_video_watched": Report(video.pc_video_watched,
                               ["video_stats_day", "user_info_combo", "roles", "video_axis"]),
    "person_course_day": Report(activity.person_course_day_from_activity,
                                ["learner_activity", "video_stats_day", "forum_events", "person_problem",
                                 "course_problem", "course_axis", "user_info_combo"]),
    "pc_day_totals": Report(activity.pc_day_totals, ["person_course_day"]),
    "person_course": Report(learner.person_course,
                            ["user_info_combo", "course_axis", "grading_policy", "course_modal_ip", "pc_day_totals",
                             "pc_nchapters", "course_modal_language", "person_enrollment_verified",
                             "course_modal_agent"],
                            optional=["grades_persistent", "pc_forum", "roles", "pc_video_watched", "geoip"]),
    "time_on_asset_totals": Report(timing.time_on_asset_totals, ["time_on_asset_daily", "person_course"],
                                   multi_use=True),
}


def register(name: str, report: Report) -> None:
    CATALOG[name] = report


def shared_reports(*names: str) -> set[str]:
    """Reports read by two or more reports in one build of ``names``."""
    uses: dict[str, int] = {}
    for r in build_order(list(names)):
        for d in CATALOG[r].inputs + CATALOG[r].optional:
            if d in CATALOG:
                uses[d] = uses.get(d, 0) + (2 if CATALOG[r].multi_use else 1)
    return {d for d, n in uses.items() if n >= 2}


def resolve(name: str, tables: Mapping | object, params: Mapping | None = None,
            memo: dict | None = None, share: bool = True, inner: bool = False) -> DataFrame:
    """Build report ``name`` (and, recursively, the reports it reads).

    ``tables`` gives the base tables, by key or attribute; a missing optional
    input is passed as ``None``, and the operator degrades those columns to
    NULL (M6).  With ``share``, an intermediate report that several reports of
    this build read is computed once and checkpointed (to the shared folder of
    ``spark.checkpoint.dir``) instead of being recomputed inside every
    consumer's plan; so is a ``stored`` report that another one reads (``inner``).
    """
    params = dict(params or {})
    memo = {} if memo is None else memo
    if share and "__shared__" not in memo:
        memo["__shared__"] = shared_reports(name) if name in CATALOG else set()
    if name in memo:
        return memo[name]
    if name not in CATALOG:
        df = _base(tables, name)
        if df is None:
            raise KeyError(f"no table or report named {name!r}")
        memo[name] = df
        return df
    rep = CATALOG[name]
    args = [resolve(dep, tables, params, memo, share, True) for dep in rep.inputs]
    kwargs = {}
    for opt in rep.optional:
        kwargs[opt] = _maybe(opt, tables, params, memo, share)
    for p in rep.params:
        if p in params:
            kwargs[p] = params[p]
    df = rep.fn(*args, **kwargs)
    if name in memo.get("__shared__", ()) or (share and inner and rep.stored):
        df = _stash(df, name)
    memo[name] = df
    return df


def resolve_all(names: list[str], tables: Mapping | object, params: Mapping | None = None) -> dict[str, DataFrame]:
    """Several reports or base tables as one build: what two of them read, directly or not, is computed once."""
    memo: dict = {"__shared__": shared_reports(*names)}
    return {n: resolve(n, tables, params, memo, inner=True) for n in names}


def _stash(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate report once to the shared checkpoint folder and
    read it back: computed a single time, lineage cut, survives executor loss."""
    return stored_scratch(df.sparkSession, df, name)


def _base(tables, name):
    if isinstance(tables, Mapping):
        return tables.get(name)
    try:
        return getattr(tables, name)
    except AttributeError:
        return None


def _maybe(name, tables, params, memo, share=True):
    if name in CATALOG:
        return resolve(name, tables, params, memo, share, True)
    return _base(tables, name)


def build_order(names: list[str]) -> list[str]:
    """Reports of ``names`` plus their report dependencies, dependencies first."""
    out: list[str] = []

    def visit(n):
        if n in out or n not in CATALOG:
            return
        for d in CATALOG[n].inputs + CATALOG[n].optional:
            visit(d)
        out.append(n)

    for n in names:
        visit(n)
    return out
