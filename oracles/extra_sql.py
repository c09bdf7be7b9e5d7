"""DuckDB oracles for the ingest and table-upkeep queries (``mooclens.plans.extra_queries``)."""

from oracles import oracle, with_deps
from oracles.ingest_sql import INGEST
from oracles.reports_sql import PERSON_COURSE_DEPS, forum_posts_sql, person_course_sql, time_on_task_sql

_KNOWN = ("'play_video', 'seq_goto', 'seq_next', 'seq_prev', 'seek_video', 'load_video', 'save_problem_success', "
          "'save_problem_fail', 'reset_problem_success', 'reset_problem_fail', 'show_answer', "
          "'edx.course.enrollment.activated', 'edx.course.enrollment.deactivated', "
          "'edx.course.enrollment.mode_changed', 'edx.course.enrollment.upgrade.succeeded', 'speed_change_video', "
          "'problem_check', 'problem_save', 'problem_reset'")
_IS_KNOWN = (f"((contains(event_type, 'problem_') or event_type in ({_KNOWN})) and not contains(event_type, "
             "'video_embedded') and not contains(event_type, 'harvardx.button') and not contains(event_type, 'harvardx.'))")
_KEPT = "not (seq % 50 = 0 and (seq // 50) % 4 in (0, 1, 2))"


_with = with_deps


EXTRA = {
    "ingest_tracking_log": _with(["tracking_log"], f"""
select seq, course_id, time, username, ip, event_source, event_type,
  case when module_id is not null then module_id
       when seq % 2 = 0 then course_id || '/courseware'
       when regexp_matches(event_type, '[/+@-]')
         then array_to_string(list_slice(list_filter(string_split(string_split(event_type, 'courses/')[-1], '/'),
                                                     lambda x: x <> ''), 1, 5), '/')
  end as module_id,
  case when seq % 3 = 0 then cast(json(event) as varchar) else event end as event,
  case when {_IS_KNOWN} then json_extract_string(event, '$.mode') end as mode,
  case when {_IS_KNOWN} then null else coalesce(cast(json_extract(event, '$.GET') as varchar), 'null') end as get
from tracking_log where {_KEPT}
"""),
    "ingest_dead_letters": _with(["tracking_log"], """
select case when (seq // 50) % 4 = 2 then 'The line is not a record' else 'Not valid JSON' end as reason,
  count(*) as n
from tracking_log where seq % 50 = 0 and (seq // 50) % 4 in (0, 1, 2) group by 1
"""),
    "load_json_table": _with(["forum"], """
select course_id, mongoid, _type, author_id, author_username, title, body, comment_thread_id, parent_id,
  created_at, pinned, endorsed, votes_count
from forum
where not (_type = 'CommentThread' and try_cast(substr(mongoid, 2) as bigint) % 29 = 7)
"""),
    "merge_into_users": _with(["user_info_combo"], """
with u as (select course_id, user_id, username, email, enrollment_mode from user_info_combo)
select course_id, user_id, username, case when user_id % 7 = 1 then email || '*' else email end as email,
  case when user_id % 7 = 1 and email is not null then 'changed' else enrollment_mode end as enrollment_mode from u
union all
select course_id, user_id + 1000000000, username, 'new', enrollment_mode from u where user_id % 7 = 3
"""),
    "append_evolving_grades": _with(["grades_persistent"], """
with g as (select *, user_id % 3 as k, percent_grade * 100 as s, date '2024-01-01' + cast(user_id % 50 as int) as d from grades_persistent)
select course_id, user_id, case when k = 1 then s else floor(s) end as score, d::timestamp + case when k = 2 then interval 10 hour else interval 0 hour end as day,
  case when k < 2 then user_id end as a, case when k = 1 then 'b' end as b, case when k = 1 then letter_grade end as letter
from g
"""),
    "load_csv_quoted": _with(["user_info_combo"], """
select course_id, user_id, username || ',' || chr(10) || '"x"' as note from user_info_combo
"""),
    "log_window_show_answer": oracle("show_answer").replace(
        "select * from show_answer",
        "select * from show_answer where cast(time as date) between date '2024-01-10' and date '2024-01-20'"),
    "user_query": _with(["tracking_log"], """
select course_id, username, count(*) as n_events, count(distinct event_type) as n_types
from tracking_log
where list_contains(['play_video', 'pause_video', 'problem_check'], event_type) and username <> ''
group by course_id, username
having count(*) >= 3
"""),
    "user_query_dir": _with(["show_answer", "enrollday_all"], """
select course_id, username, count(*) as n from show_answer
where course_id in (select course_id from enrollday_all where diff_enrollment_honor <> 0) group by course_id, username having count(*) >= 2
"""),
    "person_course_minimal": _with(PERSON_COURSE_DEPS, person_course_sql(False)),
}

EXTRA["time_on_task_2_10"] = _with(["tracking_log"], time_on_task_sql(2, 10))
EXTRA["forum_posts_dedupe"] = _with(["forum"], forum_posts_sql(dedupe=True))

_PC_FILL = """
with pcv as (select distinct course_id, user_id, explored, certified, mode = 'verified' as verified from person_course),
by_user as (
  select s.course_id, s.user_id, pcv.explored, pcv.certified, pcv.verified, """ + ", ".join(
    f"s.pct_show_answer_{g}" for g in ("problem_seen", "not_attempted", "attempted", "perfect", "partial")) + ", " + \
    ", ".join(f"s.n_show_answer_{g}, s.{d}" for g, d in (
        ("problem_seen", "n_problems_seen"), ("not_attempted", "n_not_attempted"), ("attempted", "n_attempted"),
        ("perfect", "n_perfect"), ("partial", "n_partial"))) + """
  from show_answer_stats_by_user s left join pcv on pcv.course_id = s.course_id and pcv.user_id = s.user_id)
"""
EXTRA["show_answer_stats_by_user_pc"] = _with(["show_answer_stats_by_user", "person_course"],
                                               _PC_FILL + "select * from by_user")
_G = ("problem_seen", "not_attempted", "attempted", "perfect", "partial")
EXTRA["show_answer_stats_by_course_pc"] = _with(["show_answer_stats_by_user", "person_course"], _PC_FILL + \
    "select course_id,\n  " + ",\n  ".join(
        [f"avg(pct_show_answer_{g}) as avg_pct_show_answer_{g}" for g in _G]
        + [f"avg(case when {s} then pct_show_answer_{g} end) as avg_pct_show_answer_{g}_{s}"
           for s in ("certified", "explored", "verified") for g in _G]
        + [f"cast(quantile_disc(pct_show_answer_{g}, 0.5) as double) as median_pct_show_answer_{g}" for g in _G]
        + [f"cast(quantile_disc(pct_show_answer_{g}, 0.5) filter (where {s}) as double) as median_pct_show_answer_{g}_{s}"
           for s in ("explored", "certified", "verified") for g in _G])
    + "\nfrom by_user group by course_id")

EXTRA.update(INGEST)
EXTRA["split_tracking_log"] = f"select * exclude (seq) from ({EXTRA['ingest_tracking_log']})"
EXTRA["merge_table_written"] = EXTRA["merge_bucketed_users"] = EXTRA["merge_into_users"]
EXTRA["build_reports_subset"] = f"select * from ({oracle('enrollday_all')}) where course_id in ('DemoX/C0/T1', 'DemoX/C2/T1')"

for _name in ("time_on_task", "time_on_asset_daily", "pc_day_trlang", "person_course_day"):
    # the log's days; the full daily report also has days on which only problem results are dated
    EXTRA[f"incremental_{_name}"] = f"select * from ({oracle(_name)}) where date in (select distinct cast(time as date) from ({oracle('tracking_log')}))"
