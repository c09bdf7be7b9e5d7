"""DuckDB oracles of the ingest round trips (``mooclens.sources.ingest.QUERIES``):
each gives back the bridged table the export-shaped input was written from."""

from oracles import with_deps as _w

INGEST = {
    "conform_user_info": _w(["user_info_combo"], """
select course_id, user_id, username, email, enrollment_mode, certificate_status,
  case when user_id % 13 = 0 then null else profile_year_of_birth end as profile_year_of_birth,
  profile_gender, enrollment_created, enrollment_is_active, y1_anomalous, cast(null as double) as certificate_grade
from user_info_combo
"""),
    "ingest_user_info_combo": _w(["user_info_combo"], """
select course_id, user_id,
  case when user_id % 11 <> 5 then nullif(username, '') end as username,
  case when user_id % 11 <> 5 then email end as email, case when user_id % 11 <> 5 then '0' end as is_staff,
  case when user_id % 7 <> 3 then profile_gender end as profile_gender,
  case when user_id % 7 <> 3 then profile_year_of_birth end as profile_year_of_birth,
  case when user_id % 7 <> 3 then profile_level_of_education end as profile_level_of_education,
  case when user_id % 7 <> 3 then profile_country end as profile_country,
  case when user_id % 7 <> 3 and user_id % 2 = 0 then 'it''s "all' end as profile_goals,
  enrollment_created, enrollment_is_active, enrollment_mode, certificate_status,
  case when certificate_status is not null and user_id % 3 <> 0 then 0.8::double end as certificate_grade, certificate_created_date,
  case when user_id % 5 <> 0 then 'h' || cast(user_id as varchar) end as id_map_hash_id
from user_info_combo
"""),
    "ingest_grades_persistent": _w(["grades_persistent"], """
with g as (select *, timestamp '2024-01-01 00:00:00' + to_minutes(cast(user_id % 1000 as int)) as t from grades_persistent)
select course_id, user_id, md5(course_id) as grading_policy_hash, percent_grade, nullif(letter_grade, '') as letter_grade,
  case when letter_grade <> '' then t end as passed_timestamp, t as created, t as modified
from g
"""),
    "ingest_grades_subsection": _w(["grades_persistent"], """
select course_id, user_id, 'block-v1:x+type@sequential+block@s' || cast(user_id % 7 as varchar) as usage_key,
  percent_grade * 10 as earned_all, 10.0::double as possible_all, cast(null as double) as earned_graded, cast(null as double) as possible_graded,
  case when user_id % 4 = 0 then timestamp '2024-02-01 10:00:00' end as first_attempted, timestamp '2024-02-01 10:00:00' as created,
  cast(null as timestamp) as modified
from grades_persistent
"""),
    "ingest_studentmodule": _w(["studentmodule"], """
select student_id + 7 as id, module_type, module_id, student_id,
  case when student_id % 9 <> 0 and student_id % 4 = 1 then '{"note":' || chr(9) || '"it''s",' || chr(10) || '''attempts'': 1}' else '{"attempts": 1}' end as state,
  case when student_id % 5 <> 0 and upper(grade) <> 'NULL' then grade end as grade, created, created as modified, max_grade, 'na' as done, course_id
from studentmodule
"""),
    "ingest_problem_analysis": _w(["problem_analysis"], """
select course_id, user_id, problem_url_name, attempts, grade, 50.0::double as max_grade, answer_id,
  case when user_id % 10 = 0 then 'null' when user_id % 4 = 3 then '["choice_0","choice_2"]' when user_id % 4 = 2 then '"say \\"hi\\""'
    else '"choice_' || cast(user_id % 4 as varchar) || '"' end as response,
  case when correct_bool then 'correct' else 'incorrect' end as correctness, correct_bool
from problem_analysis where user_id % 13 <> 0
"""),
    "ingest_roles": _w(["roles"], """
select course_id, user_id,
  case when roles_isBetaTester + roles_isInstructor + roles_isStaff + roles_isCCX + roles_isFinance
            + roles_isLibrary + roles_isSales + forumRoles_isAdmin + forumRoles_isCommunityTA
            + forumRoles_isModerator > 0 then 'Staff' else 'Student' end as roles,
  roles_isBetaTester, roles_isInstructor, roles_isStaff, roles_isCCX, roles_isFinance, roles_isLibrary,
  roles_isSales, forumRoles_isAdmin, forumRoles_isCommunityTA, forumRoles_isModerator, forumRoles_isStudent
from roles
where roles_isBetaTester + roles_isInstructor + roles_isStaff + roles_isCCX + roles_isFinance + roles_isLibrary
      + roles_isSales + forumRoles_isAdmin + forumRoles_isCommunityTA + forumRoles_isModerator
      + forumRoles_isStudent > 0
"""),
    "ingest_email_opt_in": _w(["user_info_combo"], """
select user_id, username, email, cast(null as varchar) as full_name, course_id, user_id % 3 = 0 as is_opted_in_for_email,
  date_trunc('second', enrollment_created) as preference_set_datetime
from user_info_combo
"""),
    "geolocate_ips": _w(["tracking_log"], """
with ips as (
  select distinct ip, 4 as fam, ((cast(split_part(ip, '.', 1) as bigint) * 256 + cast(split_part(ip, '.', 2) as bigint)) * 256
                  + cast(split_part(ip, '.', 3) as bigint)) * 256 + cast(split_part(ip, '.', 4) as bigint) as num
  from (select ip from tracking_log where ip is not null and ip <> ''
        union all
        select '10.' || (n // 65536) || '.' || (n // 256 % 256) || '.' || (n % 256) from (select o_orderkey * 48271 % 16777216 as n from orders))
  union all
  select distinct '2001:db8:' || printf('%x', c_custkey * 7 % 65536) || ':' || printf('%x', c_custkey % 65536) || '::1', 6,
    (c_custkey * 7 % 65536) * 65536 + c_custkey % 65536 from customer),
cust as (
  select c_custkey as k, case when c_custkey % 2 = 0 then b - b % s else b end as lo, s, case when c_custkey % 13 <> 0 then 'C' || (c_custkey % 25) end as iso
  from (select c_custkey, c_custkey * 7919 % 16777216 as b, (1 << cast((c_custkey % 5 + 1) * 4 as int))::bigint as s from customer)),
rng as (
  select 4 as fam, ((10 * 256 + n_nationkey) * 256 + 0) * 256 + h.lo as lo, ((10 * 256 + n_nationkey) * 256 + 0) * 256 + h.hi as hi, 'C' || n_nationkey as iso, n_name as name,
    case n_nationkey % 3 when 0 then 'Europe' when 1 then 'Asia' else 'Americas' end as continent, 'city' || n_nationkey || '_' || h.part as city,
    'r' || n_nationkey as region, 'P' || n_nationkey as postal, n_nationkey * 10.0::double as lat, -cast(n_nationkey as double) as lon
  from nation, (values (0, 1, 'low'), (2, 3, 'high')) h(lo, hi, part) where n_nationkey < 6
  union all
  select fam, lo, hi, iso, 'name ' || iso, 'Earth', city, null, null, 1.0, 2.0 from (
    select 4 as fam, 167772160 + lo as lo, 167772160 + least(lo + s - 1, 16777215) as hi, iso, 'cust' || k as city from cust
    union all select 4, 167772160 + lo, 167772160 + least(lo + s - 1, 16777215), 'A', 'equal cust' || k from cust where k % 10 = 0
    union all select 4, 167772160, 167772160 + 16777215, 'C1', 'anywhere'
    union all select 6, (k * 7 % 65536) * 65536, (k * 7 % 65536) * 65536 + 65535, iso, 'wide ' || k from cust where k % 3 = 0
    union all select 6, (k * 7 % 65536) * 65536 + k % 65536, (k * 7 % 65536) * 65536 + k % 65536, iso, 'narrow ' || k from cust where k % 6 = 0)),
un as (select 'C' || n_nationkey as iso, r_name as un_major_region, case when n_nationkey % 3 = 0 then 'High' else 'Middle' end as un_economic_group
       from nation join region on n_regionkey = r_regionkey),
best as (
  select ips.ip, rng.* from ips join rng on rng.fam = ips.fam and ips.num between rng.lo and rng.hi
  qualify row_number() over (partition by ips.ip order by rng.hi - rng.lo, rng.lo desc, rng.iso nulls first, rng.name nulls first, rng.continent, rng.city) = 1)
select ip, best.iso as cc_by_ip, best.iso as country, name as countryLabel, continent, city, region, cast(null as varchar) as subdivision, postal as postalCode,
  lat as latitude, lon as longitude, timestamp '2024-05-06 07:08:09' as "timestamp", un_major_region, un_economic_group
from best left join un on un.iso = best.iso where best.iso is not null
"""),
    "distinct_youtube_ids": _w(["course_axis"], """
select distinct trim(string_split(ytid, ':')[-1]) as id from course_axis
where category is not null and ytid is not null and ytid <> ''
"""),
    "youtube_metadata": _w(["youtube"], """
select id, title, 'UC' || cast(try_cast(substr(id, 3) as bigint) % 7 as varchar) as channel_id,
  timestamp '2023-05-01 00:00:00' as published_at,
  duration + case when try_cast(substr(id, 3) as bigint) % 5 = 0 then 86400 else 0 end as duration
from youtube
"""),
    "course_axis_walk": _w(["course_axis"], """
select course_id, idx as "index", module_id, url_name, category, name, gformat,
  case when gformat is not null then coalesce(due, timestamp '2024-03-01 00:00:00') end as due,
  timestamp '2024-01-01 00:00:00' as start, graded,
  case when visible_to_staff_only then true end as visible_to_staff_only, path, parent, chapter_mid,
  case when ytid <> '' then '1:0:' || string_split(ytid, ':')[-1] end as ytid, case when category = 'problem' then 1 end as num_items, false as has_solution, weight, itype, duration
from course_axis
"""),
    "bundle_problem_types": _w(["course_axis"], """
select course_id, url_name, itype from course_axis where category = 'problem'
"""),
    "bundle_video_durations": _w(["course_axis"], """
select course_id, url_name, duration from course_axis where category = 'video'
"""),
    "ingest_forum_mongo": _w(["forum"], """
select course_id, mongoid, _type, author_id, author_username, title, body, comment_thread_id, parent_id, created_at,
  pinned, endorsed, votes_count, date_trunc('second', created_at) as updated_at,
  case when parent_id is not null then '["' || parent_id || '"]' end as parent_ids,
  '["' || cast(author_id as varchar) || '"]' as abuse_flaggers, cast(null as varchar) as sk, cast(author_id as varchar) as endorser,
  timestamp '2024-03-04 05:06:07' as endorsed_at
from forum
"""),
    "ingest_grading_policy": _w(["grading_policy"], """
select course_id, assignment_type, assignment_type as name, fraction_of_overall_grade, min_count, drop_count,
  short_label, overall_lower_cutoff, overall_cutoff_lower_label as overall_lower_cutoff_label, overall_upper_cutoff,
  overall_cutoff_upper_label as overall_upper_cutoff_label
from grading_policy
"""),
}
