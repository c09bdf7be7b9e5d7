"""Reports that read the tracking log directly (projections and aggregates).

All take the ``tracking_log`` table (partitioned by ``course_id, log_date`` in
storage) and an optional inclusive date window, which becomes a partition
filter.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mooclens.functions.columns import json_str, rx_extract, to_double
from mooclens.functions.windows import top1


def log_window(log: DataFrame, start=None, end=None) -> DataFrame:
    """Inclusive ``log_date`` range; either bound may be omitted (M4)."""
    if start is not None:
        log = log.where(F.col("log_date") >= F.lit(start).cast("date"))
    if end is not None:
        log = log.where(F.col("log_date") <= F.lit(end).cast("date"))
    return log


def show_answer(log: DataFrame, start=None, end=None) -> DataFrame:
    """Show-answer events."""
    return (log_window(log, start, end)
            .where(F.col("event_type").isin("show_answer", "showanswer"))
            .select("time", "username", "course_id", "module_id"))


def problem_check(log: DataFrame, start=None, end=None) -> DataFrame:
    """Server-side problem checks with the graded answer."""
    return (log_window(log, start, end)
            .where(F.col("event_type").isin("problem_check", "save_problem_check")
                   & (F.col("event_source") == "server"))
            .select("time", "username", "course_id", "module_id",
                    F.col("event_struct.answers").alias("student_answers"),
                    F.col("event_struct.attempts").alias("attempts"),
                    F.col("event_struct.success").alias("success"),
                    F.col("event_struct.grade").alias("grade")))


ENROLL = "edx.course.enrollment."


def enrollment_events(log: DataFrame, start=None, end=None) -> DataFrame:
    """Enrolment events with mode and four event flags."""
    et = F.col("event_type")
    return (log_window(log, start, end)
            .where(et.like("%edx.course.enrollment%"))
            .select("course_id", "time",
                    F.coalesce("event_struct.user_id", "context.user_id").alias("user_id"),
                    F.coalesce(F.col("event_struct.mode"), json_str("event", "$.mode")).alias("mode"),
                    (et == ENROLL + "activated").alias("activated"),
                    (et == ENROLL + "deactivated").alias("deactivated"),
                    (et == ENROLL + "mode_changed").alias("mode_changed"),
                    (et == ENROLL + "upgrade.succeeded").alias("upgraded"),
                    "event_type"))


def enrollday_all(log: DataFrame, start=None, end=None) -> DataFrame:
    """+1/-1 enrolment deltas per mode.

    The date window applies to all three event types (the source query binds
    it to the first one only, by operator precedence).
    """
    et, mode = F.col("event_type"), F.col("event_struct.mode")
    act, deact, chg = (et == ENROLL + "activated"), (et == ENROLL + "deactivated"), (et == ENROLL + "mode_changed")

    def delta(plus, minus):
        return F.when(plus, 1).when(minus, -1).otherwise(0).cast("bigint")

    return (log_window(log, start, end)
            .where(act | deact | chg)
            .select("course_id", "time", F.col("event_struct.user_id").alias("user_id"),
                    delta(act & (mode == "honor"), deact & (mode == "honor")).alias("diff_enrollment_honor"),
                    F.when(act & (mode == "verified"), 1).when(deact & (mode == "verified"), -1)
                     .when(chg & (mode == "verified"), 1).when(chg & (mode == "honor"), -1)
                     .otherwise(0).cast("bigint").alias("diff_enrollment_verified"),
                    delta(act & (mode == "audit"), deact & (mode == "audit")).alias("diff_enrollment_audit")))


def person_enrollment_verified(enrollment_events_df: DataFrame) -> DataFrame:
    """First verified enrolment and last verified unenrolment per user."""
    e = enrollment_events_df
    verified = F.col("mode") == "verified"
    keep = (verified & F.col("deactivated")) | (verified & ~F.col("activated") & F.col("mode_changed"))
    return (e.where(keep).groupBy("course_id", "user_id")
            .agg(F.min("time").alias("verified_enroll_time"), F.max("time").alias("_mx"))
            .select("course_id", "user_id", "verified_enroll_time",
                    F.when(F.col("_mx") != F.col("verified_enroll_time"), F.col("_mx")).alias("verified_unenroll_time")))


def pc_day_ip_counts(log: DataFrame, start=None, end=None) -> DataFrame:
    """Events per (user, ip, day)."""
    return (log_window(log, start, end)
            .where(F.col("username") != "")
            .groupBy("course_id", "username", "ip", F.to_date("time").alias("date"))
            .agg(F.count(F.lit(1)).alias("ipcount"))
            .select("username", "ip", "date", "ipcount", "course_id"))


def course_modal_ip(ip_counts: DataFrame) -> DataFrame:
    """Most used IP per user (ties: smallest address) and the number of IPs."""
    per_ip = (ip_counts.where(F.col("ip").isNotNull() & (F.col("ip") != ""))
              .groupBy("course_id", "username", "ip").agg(F.sum("ipcount").alias("ip_count")))
    best = top1(per_ip, ["course_id", "username"], "ip_count", ["ip"], [], count_as="n_different_ip")
    return best.select("username", F.col("ip").alias("modal_ip"), "ip_count", "n_different_ip", "course_id")


# User-agent classes, first match wins (fixed values): substring of the
# upper-cased agent -> (agent type, mobile, desktop)
AGENT_RULES = [
    ("IPHONE", "Mobile", 1, 0), ("ANDROID", "Mobile", 1, 0), ("WINDOWS", "Desktop", 0, 1),
    ("MACINTOSH", "Desktop", 0, 1), ("EDX.MOBILE", "Mobile", 1, 0), ("IPAD", "Mobile", 1, 0),
    ("LINUX", "Desktop", 0, 1), ("BSD", "Desktop", 0, 1), ("CROS", "Desktop", 0, 1), ("DARWIN", "Mobile", 1, 0),
]


def _agent_class(agent):
    up = F.upper(agent)
    kind = mob = desk = None
    for pat, k, m, d in AGENT_RULES:
        hit = up.contains(pat)
        kind = F.when(hit, k) if kind is None else kind.when(hit, k)
    # mobile / desktop flags are tested independently of the type (any mobile or desktop marker)
    for pat, k, m, d in AGENT_RULES:
        hit = up.contains(pat)
        if m:
            mob = F.when(hit, 1) if mob is None else mob.when(hit, 1)
        if d:
            desk = F.when(hit, 1) if desk is None else desk.when(hit, 1)
    return (kind.otherwise("Unknown"), mob.otherwise(0).cast("bigint"), desk.otherwise(0).cast("bigint"))


def pc_day_agent_counts(log: DataFrame, start=None, end=None) -> DataFrame:
    """Events per (user, agent class, day)."""
    kind, mob, desk = _agent_class(F.col("agent"))
    return (log_window(log, start, end)
            .where((F.col("username") != "") & (F.col("agent") != ""))
            .groupBy("course_id", "username", kind.alias("agent_type"), mob.alias("mobile"),
                     desk.alias("desktop"), F.to_date("time").alias("date"))
            .agg(F.count(F.lit(1)).alias("agent_count"))
            .select("username", "agent_type", "mobile", "desktop", "date", "agent_count", "course_id"))


def course_modal_agent(agent_counts: DataFrame) -> DataFrame:
    """Most used agent class per user (ties: alphabetical class)."""
    per = (agent_counts.where(F.col("agent_type").isNotNull() & (F.col("agent_type") != ""))
           .groupBy("course_id", "username", "agent_type")
           .agg(F.sum("agent_count").alias("agent_count"), F.max("mobile").alias("mobile"),
                F.max("desktop").alias("desktop")))
    best = top1(per, ["course_id", "username"], "agent_count", ["agent_type"], ["mobile", "desktop"])
    return best.select("username", F.col("agent_type").alias("modal_agent"), "agent_count", "mobile", "desktop",
                       "course_id")


def video_stats_day(log: DataFrame, start=None, end=None) -> DataFrame:
    """Furthest video position per (day, user, video), scaled by playback speed."""
    vid_raw = json_str("event", "$.id")
    cleaned = F.regexp_replace(F.regexp_replace(F.regexp_replace(vid_raw, "-", "/"), '"', ""), "i4x/", "")
    video_id = F.when(vid_raw.contains("-"), rx_extract(cleaned, "(?:.*/)(.*)")).otherwise(cleaned)
    cur = to_double(json_str("event", "$.currentTime"))
    speed = json_str("event", "$.speed")
    pos = F.when(speed.isNotNull(), to_double(speed) * cur).otherwise(cur)
    return (log_window(log, start, end)
            .where(F.col("event_type").isin("play_video", "pause_video", "stop_video") & F.col("event").isNotNull())
            .groupBy("course_id", F.to_date("time").alias("date"), "username", video_id.alias("video_id"))
            .agg(F.max(pos).alias("position"))
            .select("date", "username", "video_id", "position", "course_id"))


# Forum URL classes, first match wins (fixed values): pattern -> action.
FORUM_URL_ACTIONS = [
    ("/courses/(.*)/discussion/threads/[^/]+/reply", "reply"),
    ("/courses/(.*)/discussion/threads/[^/]+/upvote", "upvote"),
    ("/courses/(.*)/discussion/threads/[^/]+/unvote", "unvote"),
    ("/courses/(.*)/discussion/threads/[^/]+/update", "update"),
    ("/courses/(.*)/discussion/threads/[^/]+/delete", "delete"),
    ("/courses/(.*)/discussion/threads/[^/]+/close", "close"),
    ("/courses/(.*)/discussion/threads/[^/]+/follow", "follow_thread"),
    ("/courses/(.*)/discussion/threads/[^/]+/unfollow", "unfollow_thread"),
    ("/courses/(.*)/discussion/threads/[^/]+/pin", "pin"),
    ("/courses/(.*)/discussion/threads/[^/]+/unpin", "unpin"),
    ("/courses/(.*)/discussion/threads/[^/]+/downvote", "downvote"),
    ("/courses/(.*)/discussion/comments/[^/]+/reply", "comment_reply"),
    ("/courses/(.*)/discussion/comments/[^/]+/upvote", "comment_upvote"),
    ("/courses/(.*)/discussion/comments/[^/]+/update", "comment_update"),
    ("/courses/(.*)/discussion/comments/[^/]+/unvote", "comment_unvote"),
    ("/courses/(.*)/discussion/comments/[^/]+/delete", "comment_delete"),
    ("/courses/(.*)/discussion/forum/users/[^/]+/followed", "follow_user"),
    ("/courses/(.*)/discussion/forum/users/[^/]+$", "target_user"),
    ("/courses/(.*)/discussion/forum/[^/]+/threads/[^/]+", "read"),
    ("/courses/(.*)/discussion/forum/[^/]+/inline", "read_inline"),
    ("/courses/(.*)/discussion/forum/search", "search"),
    ("/courses/(.*)/discussion/forum$", "enter_forum"),
    ("/courses/(.*)/discussion/forum/$", "enter_forum"),
]
FORUM_NAMED_EVENTS = {"edx.forum.thread.created": "created_thread", "edx.forum.response.created": "created_response",
                      "edx.forum.comment.created": "created_comment", "edx.forum.searched": "searched"}
FORUM_LIKE = ["%/discussion/forum%", "%/discussion/threads%", "%/discussion/comments%", "%list-forum-%",
              "%list_forum_%", "%add-forum-%", "%add_forum_%", "%remove-forum-%", "%remove_forum_%",
              "%update_forum_%"]


def forum_events(log: DataFrame, start=None, end=None) -> DataFrame:
    """R2: forum interactions classified from the URL or event name."""
    et, mid = F.col("event_type"), F.col("module_id")
    action = None
    for pat, name in FORUM_URL_ACTIONS:
        action = F.when(et.rlike(pat), name) if action is None else action.when(et.rlike(pat), name)
    api = "/courses/(.*)/instructor/api/(.*)"
    action = action.when(et.rlike(api), F.regexp_extract(et, "/courses/.*/instructor/api/(.*)", 1))
    for name, act in FORUM_NAMED_EVENTS.items():
        action = action.when(et == name, act)
    action = action.otherwise(et)

    thread = F.when(mid.isNotNull(), rx_extract(mid, "[^/]+/[^/]+/forum/([^/]+)")).otherwise(
        F.when(et.rlike("/courses/(.*)/discussion/forum/[^/]+/threads/[^/]+"),
               rx_extract(et, "/courses/.*/discussion/forum/[^/]+/threads/([^/]+)"))
         .when(et.rlike("/courses/(.*)/discussion/threads/[^/]+/"),
               rx_extract(et, "/courses/.*/discussion/threads/([^/]+)"))
         .otherwise(rx_extract(et, "/courses/.*/discussion/comments/([^/]+)/")))
    keep = et.rlike("^edx[.]forum[.].*")
    for p in FORUM_LIKE:
        keep = keep | et.like(p)
    return (log_window(log, start, end)
            .where(keep & F.col("username").isNotNull() & F.col("event").isNotNull())
            .select("time", "username", "course_id", action.alias("forum_action"), thread.alias("thread_id"),
                    rx_extract(et, "/courses/.*/forum/([^/]+)/").alias("subject"),
                    rx_extract(et, "/courses/.*/forum/users/([^/]+)").alias("target_user_id"),
                    F.col("event_struct.query").alias("search_query"),
                    F.col("event_struct.GET").alias("event_GET")))


#: An object of an empty POST and an empty GET, however it is spelled.
EMPTY_PAYLOAD = r'^\s*\{\s*"(POST|GET)"\s*:\s*\{\s*\}\s*,\s*"(?!\1")(?:POST|GET)"\s*:\s*\{\s*\}\s*\}\s*$'


def ora_events(log: DataFrame, start=None, end=None) -> DataFrame:
    """Open-response assessment events, module id back-filled by submission.

    ``last_module_id`` is the largest module id seen for the same submission;
    rows without a submission get NULL there (the source shares one arbitrary
    value across all of them).  Only rows with a submission take part in the
    back-fill join, so the (large) no-submission group never meets a shuffle
    key.
    """
    et, ev = F.col("event_type"), F.col("event")
    oa = "openassessmentblock."
    action = (F.when(et.rlike("openassessmentblock..*"), rx_extract(et, "openassessmentblock.(.*)"))
              .when(et.rlike("/courses/.*"), rx_extract(et, "/courses/.*/(handler/.*)")))
    uuid = (F.when(et.isin(oa + "peer_assess", oa + "self_assess", oa + "create_submission"),
                   json_str(ev, "$.submission_uuid"))
            .when(et == oa + "get_peer_submission", json_str(ev, "$.submission_returned_uuid")))
    assess = et.isin(oa + "peer_assess", oa + "self_assess")
    create = et == oa + "create_submission"
    xblock = rx_extract(et, "/courses/.*/xblock/(i4x:;_[^/]+)/handler.*")
    msome = (F.when(et == oa + "get_peer_submission", json_str(ev, "$.item_id"))
             .when(create, rx_extract(json_str(ev, "$.answer.file_key"), ".*(i4x://.*)"))
             .when(et.rlike("/courses/.*/xblock/i4x:.*"), F.regexp_replace(xblock, ";_", "/")))
    base = (log_window(log, start, end)
            .where(et.like("%openassessment%") & ev.isNotNull() & ~ev.rlike(EMPTY_PAYLOAD))
            .select("time", "username", "course_id", action.alias("action"), uuid.alias("submission_uuid"),
                    F.when(assess, json_str(ev, "$.parts[0].option.points")).alias("part1_points"),
                    F.when(assess, json_str(ev, "$.parts[0].feedback")).alias("part1_feedback"),
                    F.when(create, json_str(ev, "$.attempt_number")).alias("attempt_num"),
                    msome.alias("module_id_sometimes"), "event_type", "event", "event_source",
                    F.when(create, json_str(ev, "$.answer.text")).alias("answer_text")))
    with_uuid = base.where(F.col("submission_uuid").isNotNull())
    last = with_uuid.groupBy("course_id", "submission_uuid").agg(F.max("module_id_sometimes").alias("last_module_id"))
    joined = with_uuid.join(last, ["course_id", "submission_uuid"], "left").unionByName(
        base.where(F.col("submission_uuid").isNull()).withColumn("last_module_id", F.lit(None).cast("string")))
    ms, lm = F.col("module_id_sometimes"), F.col("last_module_id")
    has_uuid = F.col("submission_uuid").isNotNull()
    tail = ".*/([^/]+)"
    return joined.select(
        F.when(ms.isNotNull(), rx_extract(ms, tail)).when(has_uuid, rx_extract(lm, tail)).alias("problem_id"),
        "time", "username", "course_id", "action", "submission_uuid", "part1_points", "part1_feedback",
        "attempt_num", "module_id_sometimes", "event_type", "event", "event_source", "answer_text",
        "last_module_id",
        F.when(ms.isNotNull(), ms).when(has_uuid, lm).alias("module_id"))
