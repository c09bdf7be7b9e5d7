"""Bridge views as DuckDB SQL text: the oracle side of ``mooclens.sources.bridge``.

Each text produces the same rows as the Spark function of the same name, but
with nested structs flattened (``es_*`` for the log's event struct, ``ytid``,
``weight``, ``itype``, ``duration`` for the axis data struct, ``votes_count``).
They are used as CTEs in front of the report oracles.
"""

TRACKING_LOG = """
with j as (select * from (values (0),(1),(2),(3),(4),(5),(6),(7)) t(j)),
b as (select event_id, case when event_id // 3 % 3 = 0 then 7 else user_id end as user_id, ts, j, event_id % 3 as c, (event_id + 5*j) % 27 as e,
        (event_id*7 + j) % 16 as q, event_id % 18 as k, event_id*8 + j as seq,
        'DemoX/C' || cast(event_id % 3 as string) || '/T1' as course_id
      from events cross join j),
m as (select *,
        12*q + 4*c as vid, 12*q + (9 + 4*c) % 12 as pid,
        '/courses/' || course_id as base,
        case j when 0 then ts when 1 then ts + interval '20' second when 2 then ts + interval '90' second
         when 3 then ts + interval '389' second when 4 then ts + interval '689' second
         when 5 then ts + interval '990' second when 6 then ts + interval '2790' second
         else ts + interval '2800' second end as time
      from b)
select seq, course_id, time, cast(time as date) as log_date,
  case when event_id % 41 = 0 then '' else 'u' || cast(user_id as string) end as username,
  user_id,
  case when event_id % 37 = 0 then null
       else '10.' || cast(user_id % 7 as string) || '.0.' || cast((event_id*3 + j) % 4 as string) end as ip,
  case (event_id + user_id) % 8 when 0 then 'Mozilla/5.0 (iPhone)' when 1 then 'Mozilla/5.0 (Linux; Android 9)'
       when 2 then 'Mozilla/5.0 (Windows NT 10.0)' when 3 then 'Mozilla/5.0 (Macintosh)'
       when 4 then 'Mozilla/5.0 (X11; Linux)' when 5 then 'edX.mobile/2' when 6 then 'curl/8' else '' end as agent,
  case when e = 5 then 'server' else 'browser' end as event_source,
  case e when 0 then 'play_video' when 1 then 'pause_video' when 2 then 'stop_video' when 3 then 'seek_video'
    when 4 then 'load_video' when 5 then 'problem_check' when 6 then 'save_problem_check' when 7 then 'show_answer'
    when 8 then 'seq_goto' when 9 then 'edx.course.enrollment.activated' when 10 then 'edx.course.enrollment.deactivated'
    when 11 then 'edx.course.enrollment.mode_changed' when 12 then 'edx.course.enrollment.upgrade.succeeded'
    when 13 then base || '/discussion/forum/general/threads/t' || cast(k as string)
    when 14 then base || '/discussion/threads/t' || cast(k as string) || '/reply'
    when 15 then base || '/discussion/threads/t' || cast(k as string) || '/upvote'
    when 16 then 'edx.forum.thread.created' when 17 then base || '/progress' when 18 then base || '/wiki/page'
    when 19 then 'edx.ui.lms.link_clicked'
    when 20 then base || '/xblock/v;_video;_' || cast(vid as string) || '/handler/transcript/translation/' || case when event_id % 2 = 0 then 'fr' else 'de' end
    when 21 then 'openassessmentblock.create_submission' when 22 then 'openassessmentblock.peer_assess'
    when 23 then 'show_transcript' when 24 then 'textbook.pdf.page.navigated'
    when 25 then base || '/discussion/threads/t' || cast(k as string) || '/pin'
    else base || '/discussion/threads/t' || cast(k as string) || '/follow' end as event_type,
  case when e in (0,1,2,3,4,20,23) then course_id || '/video/v' || cast(vid as string)
       when e in (5,6,7,21,22) then course_id || '/problem/p' || cast(pid as string)
       when e = 8 then course_id || '/sequential/s' || cast(event_id % 25 as string)
       else null end as module_id,
  case when e in (0,1,2) then '{"id": "i4x-DemoX-C-video-v' || cast(vid as string) || '", "currentTime": ' || cast(10 + j*15 as string)
              || case when event_id % 2 = 0 then ', "speed": "1.5"' else '' end || '}'
       when e in (9,10,11,12) then '{"mode": "' || case event_id % 4 when 0 then 'honor' when 3 then 'audit' else 'verified' end || '"}'
       when e = 19 then '{"target_url": "https://x.org/handler/transcript/download"}'
       when e = 21 then '{"submission_uuid": "sub' || cast(k as string) || '", "attempt_number": 1, "answer": {"text": "ok", "file_key": "a/i4x://DemoX/C/ora/o' || cast(k as string) || '"}}'
       when e = 22 and event_id % 11 = 5 then case when event_id % 2 = 0 then '{"POST":{},"GET":{}}' else '{"GET": {}, "POST": { }}' end
       when e = 22 then '{"submission_uuid": "sub' || cast(k as string) || '", "parts": [{"option": {"points": ' || cast(j as string) || '}, "feedback": "f' || cast(j as string) || '"}]}'
       else '{}' end as event,
  case when e in (9,10,11,12) then case event_id % 4 when 0 then 'honor' when 3 then 'audit' when 1 then 'verified' else null end end as es_mode,
  case when e in (9,10,11,12) and event_id % 5 <> 0 then user_id end as es_user_id,
  case when e in (5,6) then (event_id % 3) + 1 end as es_attempts,
  case when e in (5,6) then case when event_id % 2 = 0 then 'correct' else 'incorrect' end end as es_success,
  case when e in (5,6) then cast(event_id % 2 as double) end as es_grade,
  cast(null as varchar) as es_answers, cast(null as varchar) as es_query, cast(null as varchar) as es_get
from m
"""

COURSE_AXIS = """
with cs as (select * from (values (0),(1),(2)) t(c)),
nodes as (
  select c, 'course' as category, -1 as r, -1 as n, -1 as s, -1 as p, 'course' as url_name, cast(null as string) as parent from cs
  union all select c, 'chapter', r_regionkey, -1, -1, -1, 'ch' || cast(r_regionkey as string), 'course' from region cross join cs
  union all select c, 'sequential', n_regionkey, n_nationkey, -1, -1, 's' || cast(n_nationkey as string), 'ch' || cast(n_regionkey as string) from nation cross join cs
  union all select c, 'vertical', n_regionkey, n_nationkey, cast(s_suppkey as int), -1, 'x' || cast(s_suppkey as string), 's' || cast(n_nationkey as string)
    from supplier join nation on s_nationkey = n_nationkey cross join cs
  union all select cast(p_partkey % 3 as int), case p_partkey % 4 when 0 then 'video' when 3 then 'html' else 'problem' end,
      n_regionkey, n_nationkey, cast(s_suppkey as int), cast(p_partkey as int),
      case p_partkey % 4 when 0 then 'v' when 3 then 'h' else 'p' end || cast(p_partkey as string), 'x' || cast(s_suppkey as string)
    from part join supplier on p_partkey % (select count(*) from supplier) = s_suppkey join nation on s_nationkey = n_nationkey)
select 'DemoX/C' || cast(c as string) || '/T1' as course_id,
  cast(row_number() over (partition by c order by r, n, s, p) as bigint) as idx,
  category, url_name, parent,
  'DemoX/C' || cast(c as string) || '/T1/' || category || '/' || url_name as module_id,
  category || ' ' || url_name as name,
  case when r >= 0 then 'DemoX/C' || cast(c as string) || '/T1/chapter/ch' || cast(r as string) end as chapter_mid,
  case when r < 0 then '/' else '/ch' || cast(r as string) || case when n < 0 then '' else '/s' || cast(n as string) end
     || case when s < 0 then '' else '/x' || cast(s as string) end || case when p < 0 then '' else '/' || url_name end end as path,
  case when n >= 0 then case r % 3 when 0 then 'Homework' when 1 then 'Lab' else 'Exam' end end as gformat,
  case when p >= 0 and p % 29 = 0 then true else false end as visible_to_staff_only,
  case when category = 'video' and p % 8 = 0 then '1:yt' || cast(p as string) end as ytid,
  case when category = 'problem' then cast(1 + p % 3 as double) end as weight,
  case when category = 'problem' then case p % 5 when 0 then 'multiplechoiceresponse' when 1 then 'numericalresponse' when 2 then 'choiceresponse' when 3 then 'formularesponse' end end as itype,
  case when category = 'video' then cast(60 + p % 300 as double) end as duration,
  cast(null as timestamp) as start,
  case when n >= 0 then case n % 3 when 0 then timestamp '2024-01-10 00:00:00' when 1 then timestamp '2024-01-20 00:00:00' end end as due,
  n >= 0 as graded, false as is_split, cast(null as varchar) as split_url_name
from nodes
"""

FORUM = """
select 'DemoX/C' || cast(conv_id % 3 as string) || '/T1' as course_id,
  case when turn = 0 then 't' || cast(conv_id as string) else 't' || cast(conv_id as string) || 'c' || cast(turn as string) end as mongoid,
  case when turn = 0 then 'CommentThread' else 'Comment' end as _type,
  (conv_id*7 + turn) % 15 as author_id, 'u' || cast((conv_id*7 + turn) % 15 as string) as author_username,
  case when turn = 0 then 'title ' || cast(conv_id as string) end as title, text as body,
  case when turn > 0 then 't' || cast(conv_id as string) end as comment_thread_id,
  case when turn >= 2 and turn % 2 = 0 then 't' || cast(conv_id as string) || 'c' || cast(turn - 1 as string) end as parent_id,
  timestamp '2024-01-01 00:00:00' + to_seconds(conv_id*3600 + turn*60) as created_at,
  conv_id % 5 = 0 and turn = 0 as pinned, turn % 3 = 1 as endorsed, conv_id % 4 as votes_count
from conversations
"""

USER_INFO_COMBO = """
with cs as (select * from (values (0),(1),(2)) t(c))
select 'DemoX/C' || cast(c as string) || '/T1' as course_id, c_custkey as user_id, 'u' || cast(c_custkey as string) as username,
  'u' || cast(c_custkey as string) || '@' || lower(c_mktsegment) || '.org' as email,
  case (c_custkey + c) % 3 when 0 then 'verified' when 1 then 'audit' else 'honor' end as enrollment_mode,
  case when (c_custkey + c) % 5 = 0 then 'downloadable' when (c_custkey + c) % 5 = 1 then 'notpassing' end as certificate_status,
  1950 + c_custkey % 55 as profile_year_of_birth,
  case c_custkey % 3 when 0 then 'm' when 1 then 'f' else 'o' end as profile_gender,
  case c_custkey % 4 when 0 then 'b' when 1 then 'm' when 2 then 'hs' end as profile_level_of_education,
  'N' || cast(c_nationkey as string) as profile_country,
  case c_custkey % 3 when 0 then timestamp '2023-12-01 00:00:00' when 1 then timestamp '2023-12-15 12:00:00'
       else timestamp '2024-01-02 08:30:00' end as enrollment_created,
  cast(case when c_custkey % 9 = 0 then 0 else 1 end as bigint) as enrollment_is_active,
  case when (c_custkey + c) % 5 in (0, 1) then timestamp '2024-02-01 00:00:00' end as certificate_created_date,
  case when (c_custkey + c) % 5 in (0, 1) then timestamp '2024-02-02 00:00:00' end as certificate_modified_date,
  cast(case when c_custkey % 50 = 0 then 1 end as bigint) as y1_anomalous
from customer cross join cs where (c_custkey + c) % 4 <> 0
"""

GRADE_ROWS = """
select l_orderkey % 3 as c, o_custkey as user_id,
        12*greatest(l_partkey // 12 - 1, 0) + (9 + 4*(l_orderkey % 3)) % 12 as pid,
        max(l_quantity) as grade, max(l_linenumber) as attempts, max(l_shipdate) as created
      from lineitem join orders on l_orderkey = o_orderkey group by 1, 2, 3
"""

# exploded: one row per (course, user, problem, item)
PROBLEM_ANALYSIS = """
with i as (select * from (values (1),(2),(3)) t(i))
select 'DemoX/C' || cast(c as string) || '/T1' as course_id, user_id, 'p' || cast(pid as string) as problem_url_name,
  'p' || cast(pid as string) || '_' || cast(i + 1 as string) || '_1' as answer_id,
  (user_id + pid + i) % 3 <> 0 as correct_bool, cast(attempts as bigint) as attempts, grade,
  cast(50 as double) as max_grade, created
from grade_rows cross join i where i <= 1 + pid % 3
"""

STUDENTMODULE = """
select 'DemoX/C' || cast(c as string) || '/T1' as course_id, 'problem' as module_type,
  'DemoX/C' || cast(c as string) || '/T1' || '/problem/p' || cast(pid as string) as module_id,
  user_id as student_id,
  case when (user_id + pid) % 17 = 0 then '' when (user_id + pid) % 17 = 1 then 'NULL'
       when (user_id + pid) % 17 = 2 then null else cast(grade as string) end as grade,
  '50' as max_grade, created
from grade_rows
"""

GRADING_POLICY = """
select a.course_id, g.assignment_type, g.short_label, g.fraction_of_overall_grade,
  cast(g.min_count as bigint) as min_count, cast(g.drop_count as bigint) as drop_count,
  'Pass' as overall_cutoff_lower_label, 0.5::double as overall_lower_cutoff,
  'A' as overall_cutoff_upper_label, 0.8::double as overall_upper_cutoff
from (select course_id from course_axis where category = 'course') a
cross join (values ('Homework', 'HW', 0.4::double, 4, 1), ('Lab', 'LB', 0.2::double, 2, 0), ('Exam', 'EX', 0.4::double, 1, 0))
  g(assignment_type, short_label, fraction_of_overall_grade, min_count, drop_count)
"""

GRADES_PERSISTENT = """
select course_id, user_id,
  cast((user_id*13 + cast(substr(course_id, 8, 1) as bigint)) % 101 as double) / 100.0 as percent_grade,
  case when cast((user_id*13 + cast(substr(course_id, 8, 1) as bigint)) % 101 as double) / 100.0 >= 0.8 then 'A'
       when cast((user_id*13 + cast(substr(course_id, 8, 1) as bigint)) % 101 as double) / 100.0 >= 0.5 then 'Pass'
       else '' end as letter_grade
from user_info_combo where user_id % 6 <> 0
"""

ROLES = """
select course_id, user_id,
  case when user_id % 20 = 0 then 'Staff' when user_id % 20 = 1 then null else 'Student' end as roles,
  cast(user_id % 40 = 0 as bigint) as roles_isBetaTester, cast(user_id % 40 = 2 as bigint) as roles_isInstructor,
  cast(user_id % 40 = 4 as bigint) as roles_isStaff, cast(user_id % 40 = 6 as bigint) as roles_isCCX,
  cast(user_id % 40 = 8 as bigint) as roles_isFinance, cast(user_id % 40 = 10 as bigint) as roles_isLibrary,
  cast(user_id % 40 = 12 as bigint) as roles_isSales, cast(user_id % 40 = 14 as bigint) as forumRoles_isAdmin,
  cast(user_id % 40 = 16 as bigint) as forumRoles_isCommunityTA, cast(user_id % 40 = 18 as bigint) as forumRoles_isModerator,
  cast(user_id % 20 <> 0 as bigint) as forumRoles_isStudent
from user_info_combo
"""

GEOIP = """
select '10.' || cast(n_nationkey as string) || '.0.' || cast(b as string) as ip,
  'C' || cast(n_nationkey as string) as cc_by_ip, n_name as countryLabel,
  case n_nationkey % 3 when 0 then 'Europe' when 1 then 'Asia' else 'Americas' end as continent,
  'city' || cast(n_nationkey as string) || '_' || cast(b as string) as city,
  'r' || cast(n_nationkey as string) as region, cast(null as varchar) as subdivision,
  'P' || cast(n_nationkey * 10 + b as string) as postalCode,
  case n_nationkey % 2 when 0 then 'North' else 'South' end as un_major_region,
  case n_nationkey % 3 when 0 then 'High' else 'Middle' end as un_economic_group,
  case n_nationkey % 2 when 0 then 'No' else 'Yes' end as un_developing_nation,
  cast(null as varchar) as un_special_region,
  n_nationkey * 10.0::double + b as latitude, b * 10.0::double - n_nationkey as longitude
from nation cross join (values (0),(1),(2),(3)) t(b) where n_nationkey < 6
"""

YOUTUBE = """
select 'yt' || cast(try_cast(substr(url_name, 2) as bigint) as string) as id,
  'video ' || cast(try_cast(substr(url_name, 2) as bigint) as string) as title,
  cast(30 + try_cast(substr(url_name, 2) as bigint) % 200 as bigint) as duration
from course_axis where category = 'video' and ytid is not null and try_cast(substr(url_name, 2) as bigint) % 16 = 0
"""

# name -> (sql, dependencies)
BRIDGE = {
    "tracking_log": (TRACKING_LOG, []),
    "course_axis": (COURSE_AXIS, []),
    "forum": (FORUM, []),
    "user_info_combo": (USER_INFO_COMBO, []),
    "grade_rows": (GRADE_ROWS, []),
    "problem_analysis": (PROBLEM_ANALYSIS, ["grade_rows"]),
    "studentmodule": (STUDENTMODULE, ["grade_rows"]),
    "grading_policy": (GRADING_POLICY, ["course_axis"]),
    "grades_persistent": (GRADES_PERSISTENT, ["user_info_combo"]),
    "roles": (ROLES, ["user_info_combo"]),
    "geoip": (GEOIP, []),
    "youtube": (YOUTUBE, ["course_axis"]),
}
