"""Deterministic bridge from the driver's tables to the course-data tables.

The driver ships TPC-H-like tables plus ``events`` and ``conversations``; the
reports need tracking logs, a course structure, forum posts, enrolments and
grades.  Each function below derives one domain table from the driver tables
with integer arithmetic only, so the same rows can be produced by the SQL text
in ``oracles/bridge_sql.py``.  Every row scales with the driver tables: the log
with ``events``, the course structure with ``part``/``supplier``/``nation``,
grades with ``lineitem``/``orders``, users with ``customer``, forum with
``conversations``.

Only constant fan-outs (8 log rows per event, 3 courses) are written as
``explode`` of a literal array; nothing is cross-joined.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mooclens.functions.columns import growing
from mooclens.sources.ingest import ROLE_FLAGS

NCOURSES = 3
HOT_LEARNER = 7
EVENTS_PER_TASK = 25_000  # 8 log rows each


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _s(c) -> Column:
    return (c if isinstance(c, Column) else F.col(c)).cast("string")


def course_name(c) -> Column:
    return F.concat(F.lit("DemoX/C"), _s(c), F.lit("/T1"))


def _plus_seconds(ts: Column, secs: Column) -> Column:
    return F.timestamp_micros(F.unix_micros(ts) + secs.cast("bigint") * F.lit(1_000_000))


def _case(key: Column, mapping: dict, default=None) -> Column:
    out = None
    for k, v in mapping.items():
        v = v if isinstance(v, Column) else F.lit(v)
        out = F.when(key == k, v) if out is None else out.when(key == k, v)
    if default is not None:
        out = out.otherwise(default if isinstance(default, Column) else F.lit(default))
    return out


# ---- fixed values of the log bridge (offsets of the 8 events of a burst, in s)
BURST_OFFSETS = [0, 20, 90, 389, 689, 990, 2790, 2800]
AGENTS = ["Mozilla/5.0 (iPhone)", "Mozilla/5.0 (Linux; Android 9)",
          "Mozilla/5.0 (Windows NT 10.0)", "Mozilla/5.0 (Macintosh)",
          "Mozilla/5.0 (X11; Linux)", "edX.mobile/2", "curl/8", ""]
PLAIN_EVENT_TYPES = {
    0: "play_video", 1: "pause_video", 2: "stop_video", 3: "seek_video", 4: "load_video",
    5: "problem_check", 6: "save_problem_check", 7: "show_answer", 8: "seq_goto",
    9: "edx.course.enrollment.activated", 10: "edx.course.enrollment.deactivated",
    11: "edx.course.enrollment.mode_changed", 12: "edx.course.enrollment.upgrade.succeeded",
    16: "edx.forum.thread.created", 19: "edx.ui.lms.link_clicked",
    21: "openassessmentblock.create_submission", 22: "openassessmentblock.peer_assess",
    23: "show_transcript", 24: "textbook.pdf.page.navigated",
}


def tracking_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One burst of 8 log rows per driver event (80,000 rows at sf0.01)."""
    # a third of every course's events belong to one learner
    hot = F.floor(F.col("event_id") / 3) % 3 == 0
    ev = read(spark, sf_dir, "events").select("event_id", F.when(hot, F.lit(HOT_LEARNER)).otherwise(F.col("user_id")).cast("bigint").alias("user_id"), "ts")
    # the narrow events move before the 8x fan-out, by course and time: a task gets a stretch of one course that its
    # memory holds and writes few of the log's partitions, and a busy course-day is spread over tasks
    tasks = max(spark.sparkContext.defaultParallelism, 1 + ev.count() // EVENTS_PER_TASK)
    ev = ev.repartitionByRange(tasks, F.col("event_id") % NCOURSES, "ts", "event_id")
    # what the rows of a burst share is worked out once, before the fan-out, and fixed texts are looked up in a list: the
    # JVM never compiles a method of more than 8,000 bytes, and the one that makes the rows stays below
    eid, user = F.col("event_id"), F.col("user_id")
    b = ev.select(
        "event_id", "user_id", F.col("ts").cast("timestamp").alias("ts"),
        (eid % 3).alias("c"), _s(eid % 18).alias("k"), (eid % 2 == 0).alias("even"), course_name(eid % 3).alias("course_id"),
        F.concat(F.lit("/courses/"), course_name(eid % 3)).alias("base"),
        F.when(eid % 41 == 0, F.lit("")).otherwise(F.concat(F.lit("u"), _s("user_id"))).alias("username"),
        F.concat(F.lit("10."), _s(user % 7), F.lit(".0.")).alias("net"),
        F.element_at(F.array(*[F.lit(a) for a in AGENTS]), ((eid + user) % 8 + 1).cast("int")).alias("agent"),
        _case(eid % 4, {0: "honor", 3: "audit"}, default="verified").alias("mode_txt"),
        _case(eid % 4, {0: "honor", 3: "audit", 1: "verified"}).alias("mode"),
        F.explode(F.sequence(F.lit(0), F.lit(7))).alias("j"))
    j, k, c, even, base, mode_txt = (F.col(x) for x in ["j", "k", "c", "even", "base", "mode_txt"])
    q = (eid * 7 + j) % 16
    b = b.select("*", ((eid + 5 * j) % 27).alias("e"), (eid * 8 + j).alias("seq"),
                 _s(12 * q + 4 * c).alias("vid"), _s(12 * q + (9 + 4 * c) % 12).alias("pid"))
    e, vid, pid = F.col("e"), F.col("vid"), F.col("pid")
    offset = F.element_at(F.array(*[F.lit(o) for o in BURST_OFFSETS]), (j + 1).cast("int"))

    plain = F.array(*[F.lit(PLAIN_EVENT_TYPES.get(i)).cast("string") for i in range(27)])
    ev_type = F.coalesce(F.get(plain, e.cast("int")), _case(e, {
        13: F.concat(base, F.lit("/discussion/forum/general/threads/t"), k),
        14: F.concat(base, F.lit("/discussion/threads/t"), k, F.lit("/reply")),
        15: F.concat(base, F.lit("/discussion/threads/t"), k, F.lit("/upvote")),
        17: F.concat(base, F.lit("/progress")),
        18: F.concat(base, F.lit("/wiki/page")),
        20: F.concat(base, F.lit("/xblock/v;_video;_"), vid, F.lit("/handler/transcript/translation/"),
                     F.when(even, "fr").otherwise("de")),
        25: F.concat(base, F.lit("/discussion/threads/t"), k, F.lit("/pin")),
    }, default=F.concat(base, F.lit("/discussion/threads/t"), k, F.lit("/follow"))))

    module_id = (F.when(e.isin(0, 1, 2, 3, 4, 20, 23), F.concat(F.col("course_id"), F.lit("/video/v"), vid))
                 .when(e.isin(5, 6, 7, 21, 22), F.concat(F.col("course_id"), F.lit("/problem/p"), pid))
                 .when(e == 8, F.concat(F.col("course_id"), F.lit("/sequential/s"), _s(eid % 25))))
    event = (F.when(e.isin(0, 1, 2), F.concat(
                F.lit('{"id": "i4x-DemoX-C-video-v'), vid, F.lit('", "currentTime": '), _s(10 + j * 15),
                F.when(even, F.lit(', "speed": "1.5"')).otherwise(F.lit("")), F.lit("}")))
             .when(e.isin(9, 10, 11, 12), F.concat(F.lit('{"mode": "'), mode_txt, F.lit('"}')))
             .when(e == 19, F.lit('{"target_url": "https://x.org/handler/transcript/download"}'))
             .when(e == 21, F.concat(F.lit('{"submission_uuid": "sub'), k,
                                     F.lit('", "attempt_number": 1, "answer": {"text": "ok", "file_key": "a/i4x://DemoX/C/ora/o'),
                                     k, F.lit('"}}')))
             .when((e == 22) & (eid % 11 == 5), F.when(even, F.lit('{"POST":{},"GET":{}}')).otherwise(F.lit('{"GET": {}, "POST": { }}')))
             .when(e == 22, F.concat(F.lit('{"submission_uuid": "sub'), k, F.lit('", "parts": [{"option": {"points": '),
                                     _s(j), F.lit('}, "feedback": "f'), _s(j), F.lit('"}]}')))
             .otherwise(F.lit("{}")))
    enroll = e.isin(9, 10, 11, 12)
    checks = e.isin(5, 6)
    event_struct = F.struct(
        F.when(enroll & (eid % 5 != 0), F.col("user_id")).alias("user_id"),
        F.when(enroll, F.col("mode")).alias("mode"),
        F.lit(None).cast("string").alias("query"),
        F.lit(None).cast("string").alias("GET"),
        F.lit(None).cast("string").alias("POST"),
        F.lit(None).cast("string").alias("answers"),
        F.when(checks, eid % 3 + 1).alias("attempts"),
        F.when(checks, F.when(even, "correct").otherwise("incorrect")).alias("success"),
        F.when(checks, (eid % 2).cast("double")).alias("grade"),
    )
    time = _plus_seconds(F.col("ts"), offset)
    return b.select(
        "seq", "course_id",
        time.alias("time"),
        F.to_date(time).alias("log_date"),
        "username",
        F.when(eid % 37 == 0, F.lit(None).cast("string")).otherwise(F.concat(F.col("net"), _s((eid * 3 + j) % 4))).alias("ip"),
        "agent",
        F.when(e == 5, "server").otherwise("browser").alias("event_source"),
        ev_type.alias("event_type"),
        module_id.alias("module_id"),
        F.lit(None).cast("string").alias("page"),
        event.alias("event"),
        F.struct(F.col("user_id").alias("user_id"), F.lit(None).cast("string").alias("path"),
                 F.col("course_id").alias("course_id")).alias("context"),
        event_struct.alias("event_struct"),
    )


def course_axis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Course tree: course > chapter(region) > sequential(nation) > vertical(supplier) > leaf(part)."""
    region = read(spark, sf_dir, "region")
    nation = read(spark, sf_dir, "nation")
    supplier = read(spark, sf_dir, "supplier")
    part = read(spark, sf_dir, "part")
    courses = F.explode(F.array(*[F.lit(i) for i in range(NCOURSES)])).alias("c")
    m1 = F.lit(-1)
    cols = ["c", "category", "r", "n", "s", "p", "url_name", "parent"]

    top = region.limit(1).select(courses).select(
        "c", F.lit("course").alias("category"), m1.alias("r"), m1.alias("n"), m1.alias("s"), m1.alias("p"),
        F.lit("course").alias("url_name"), F.lit(None).cast("string").alias("parent"))
    chapters = region.select(courses, "r_regionkey").select(
        "c", F.lit("chapter").alias("category"), F.col("r_regionkey").alias("r"), m1.alias("n"), m1.alias("s"),
        m1.alias("p"), F.concat(F.lit("ch"), _s("r_regionkey")).alias("url_name"), F.lit("course").alias("parent"))
    seqs = nation.select(courses, "n_regionkey", "n_nationkey").select(
        "c", F.lit("sequential").alias("category"), F.col("n_regionkey").alias("r"), F.col("n_nationkey").alias("n"),
        m1.alias("s"), m1.alias("p"), F.concat(F.lit("s"), _s("n_nationkey")).alias("url_name"),
        F.concat(F.lit("ch"), _s("n_regionkey")).alias("parent"))
    sn = supplier.join(nation, supplier.s_nationkey == nation.n_nationkey)
    verts = sn.select(courses, "n_regionkey", "n_nationkey", "s_suppkey").select(
        "c", F.lit("vertical").alias("category"), F.col("n_regionkey").alias("r"), F.col("n_nationkey").alias("n"),
        F.col("s_suppkey").cast("int").alias("s"), m1.alias("p"), F.concat(F.lit("x"), _s("s_suppkey")).alias("url_name"),
        F.concat(F.lit("s"), _s("n_nationkey")).alias("parent"))
    nsupp = supplier.select(F.count("*")).scalar()
    leaf_kind = _case(F.col("p_partkey") % 4, {0: "video", 3: "html"}, default="problem")
    leaf_pre = _case(F.col("p_partkey") % 4, {0: "v", 3: "h"}, default="p")
    leaves = (part.join(supplier, (part.p_partkey % nsupp) == supplier.s_suppkey)
              .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
              .select((F.col("p_partkey") % 3).cast("int").alias("c"), leaf_kind.alias("category"),
                      F.col("n_regionkey").alias("r"), F.col("n_nationkey").alias("n"),
                      F.col("s_suppkey").cast("int").alias("s"), F.col("p_partkey").cast("int").alias("p"),
                      F.concat(leaf_pre, _s("p_partkey")).alias("url_name"),
                      F.concat(F.lit("x"), _s("s_suppkey")).alias("parent")))
    nodes = top.select(cols).unionByName(chapters.select(cols)).unionByName(seqs.select(cols)) \
        .unionByName(verts.select(cols)).unionByName(leaves.select(cols))

    from pyspark.sql import Window
    c, r, n, s, p, cat = (F.col(x) for x in ["c", "r", "n", "s", "p", "category"])
    cid = course_name(c)
    path = F.when(r < 0, F.lit("/")).otherwise(F.concat(
        F.lit("/ch"), _s(r),
        F.when(n < 0, F.lit("")).otherwise(F.concat(F.lit("/s"), _s(n))),
        F.when(s < 0, F.lit("")).otherwise(F.concat(F.lit("/x"), _s(s))),
        F.when(p < 0, F.lit("")).otherwise(F.concat(F.lit("/"), F.col("url_name")))))
    gformat = F.when(n >= 0, _case(r % 3, {0: "Homework", 1: "Lab"}, default="Exam"))
    due = F.when(n >= 0, _case(n % 3, {0: F.lit("2024-01-10 00:00:00").cast("timestamp"),
                                        1: F.lit("2024-01-20 00:00:00").cast("timestamp")}))
    is_problem = cat == "problem"
    data = F.struct(
        F.when((cat == "video") & (p % 8 == 0), F.concat(F.lit("1:yt"), _s(p))).alias("ytid"),
        F.when(is_problem, (1 + p % 3).cast("double")).alias("weight"),
        F.when(is_problem, _case(p % 5, {0: "multiplechoiceresponse", 1: "numericalresponse",
                                          2: "choiceresponse", 3: "formularesponse"})).alias("itype"),
        F.lit(None).cast("bigint").alias("num_items"),
        F.lit(None).cast("boolean").alias("has_solution"),
        F.when(cat == "video", (60 + p % 300).cast("double")).alias("duration"),
    )
    # numbered section by section, after the entries of the sections before: no task sorts a whole course
    earlier = Window.partitionBy("c").orderBy("r", "n").rowsBetween(Window.unboundedPreceding, -1)
    sizes = nodes.groupBy("c", "r", "n").agg(F.count("*").alias("size"))
    sizes = sizes.select(F.col("c").alias("sc"), F.col("r").alias("sr"), F.col("n").alias("sn"), F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("before"))
    w = Window.partitionBy("c", "r", "n").orderBy("s", "p")
    nodes = nodes.withColumn("place", F.row_number().over(w))
    nodes = nodes.join(sizes, c.eqNullSafe(F.col("sc")) & r.eqNullSafe(F.col("sr")) & n.eqNullSafe(F.col("sn")))
    return nodes.select(
        cid.alias("course_id"),
        (F.col("place") + F.col("before")).cast("bigint").alias("index"),
        F.concat(cid, F.lit("/"), cat, F.lit("/"), F.col("url_name")).alias("module_id"),
        "url_name", "category",
        F.concat(cat, F.lit(" "), F.col("url_name")).alias("name"),
        gformat.alias("gformat"),
        path.alias("path"),
        "parent",
        F.when(r >= 0, F.concat(cid, F.lit("/chapter/ch"), _s(r))).alias("chapter_mid"),
        F.lit(None).cast("timestamp").alias("start"),
        due.alias("due"),
        gformat.isNotNull().alias("graded"),
        ((p >= 0) & (p % 29 == 0)).alias("visible_to_staff_only"),
        F.lit(False).alias("is_split"),
        F.lit(None).cast("string").alias("split_url_name"),
        data.alias("data"),
    )


def forum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forum posts: turn 0 of a conversation opens a thread, later turns comment on it."""
    cv = read(spark, sf_dir, "conversations")
    conv, turn = F.col("conv_id"), F.col("turn")
    t = F.concat(F.lit("t"), _s(conv))
    author = (conv * 7 + turn) % 15
    return cv.select(
        course_name(conv % 3).alias("course_id"),
        F.when(turn == 0, t).otherwise(F.concat(t, F.lit("c"), _s(turn))).alias("mongoid"),
        F.when(turn == 0, "CommentThread").otherwise("Comment").alias("_type"),
        author.alias("author_id"),
        F.concat(F.lit("u"), _s(author)).alias("author_username"),
        F.when(turn == 0, F.concat(F.lit("title "), _s(conv))).alias("title"),
        F.col("text").alias("body"),
        F.when(turn > 0, t).alias("comment_thread_id"),
        F.when((turn >= 2) & (turn % 2 == 0), F.concat(t, F.lit("c"), _s(turn - 1))).alias("parent_id"),
        _plus_seconds(F.lit("2024-01-01 00:00:00").cast("timestamp"), conv * 3600 + turn * 60).alias("created_at"),
        ((conv % 5 == 0) & (turn == 0)).alias("pinned"),
        (turn % 3 == 1).alias("endorsed"),
        F.struct((conv % 4).alias("count")).alias("votes"),
    )


def user_info_combo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users enrolled in courses: each customer in 3/4 of the (user, course) slots."""
    cu = read(spark, sf_dir, "customer")
    x = cu.select("c_custkey", "c_mktsegment", "c_nationkey",
                  F.explode(F.array(*[F.lit(i) for i in range(NCOURSES)])).alias("c"))
    x = x.where((F.col("c_custkey") + F.col("c")) % 4 != 0)
    key, c = F.col("c_custkey"), F.col("c")
    kc = key + c
    cert = F.when(kc % 5 == 0, "downloadable").when(kc % 5 == 1, "notpassing")
    return x.select(
        course_name(c).alias("course_id"),
        key.alias("user_id"),
        F.concat(F.lit("u"), _s(key)).alias("username"),
        F.concat(F.lit("u"), _s(key), F.lit("@"), F.lower("c_mktsegment"), F.lit(".org")).alias("email"),
        _case(kc % 3, {0: "verified", 1: "audit"}, default="honor").alias("enrollment_mode"),
        cert.alias("certificate_status"),
        (1950 + key % 55).alias("profile_year_of_birth"),
        _case(key % 3, {0: "m", 1: "f"}, default="o").alias("profile_gender"),
        _case(key % 4, {0: "b", 1: "m", 2: "hs"}).alias("profile_level_of_education"),
        F.concat(F.lit("N"), _s("c_nationkey")).alias("profile_country"),
        _case(key % 3, {0: F.lit("2023-12-01 00:00:00").cast("timestamp"),
                        1: F.lit("2023-12-15 12:00:00").cast("timestamp")},
              default=F.lit("2024-01-02 08:30:00").cast("timestamp")).alias("enrollment_created"),
        F.when(key % 9 == 0, 0).otherwise(1).cast("bigint").alias("enrollment_is_active"),
        F.when(cert.isNotNull(), F.lit("2024-02-01 00:00:00").cast("timestamp")).alias("certificate_created_date"),
        F.when(cert.isNotNull(), F.lit("2024-02-02 00:00:00").cast("timestamp")).alias("certificate_modified_date"),
        F.when(key % 50 == 0, 1).cast("bigint").alias("y1_anomalous"),
    )


def _grade_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(course, user, problem) grade rows from lineitem x orders; pid lands on a problem leaf."""
    li = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity", "l_linenumber", "l_shipdate")
    od = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    c = F.col("l_orderkey") % 3
    r = (li.join(growing(od), li.l_orderkey == od.o_orderkey)
         .groupBy(c.alias("c"), F.col("o_custkey").alias("user_id"),
                  (12 * F.greatest(F.floor(F.col("l_partkey") / 12) - 1, F.lit(0)) + (9 + 4 * c) % 12).alias("pid"))
         .agg(F.max("l_quantity").alias("grade"), F.max("l_linenumber").alias("attempts"),
              F.max("l_shipdate").cast("timestamp").alias("created")))
    return r


def problem_analysis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested problem answers: one row per (course, user, problem) with 1-3 item structs."""
    r = _grade_rows(spark, sf_dir)
    pid = F.col("pid")
    url = F.concat(F.lit("p"), _s(pid))
    items = F.transform(
        F.sequence(F.lit(1).cast("bigint"), 1 + pid % 3),
        lambda i: F.struct(
            F.concat(url, F.lit("_"), _s(i + 1), F.lit("_1")).alias("answer_id"),
            F.lit(None).cast("string").alias("response"),
            F.lit(None).cast("string").alias("correctness"),
            ((F.col("user_id") + pid + i) % 3 != 0).alias("correct_bool"),
            F.lit(None).cast("double").alias("npoints"),
            F.lit(None).cast("string").alias("msg"),
            F.lit(None).cast("string").alias("hint")))
    return r.select(
        course_name("c").alias("course_id"), "user_id", url.alias("problem_url_name"),
        items.alias("item"), F.col("attempts").cast("bigint").alias("attempts"),
        F.lit(True).alias("done"), "grade", F.lit(50.0).alias("max_grade"), "created")


def studentmodule(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = _grade_rows(spark, sf_dir)
    up = F.col("user_id") + F.col("pid")
    grade = (F.when(up % 17 == 0, F.lit("")).when(up % 17 == 1, F.lit("NULL"))
             .when(up % 17 == 2, F.lit(None).cast("string")).otherwise(_s("grade")))
    cid = course_name("c")
    return r.select(
        cid.alias("course_id"), F.lit("problem").alias("module_type"),
        F.concat(cid, F.lit("/problem/p"), _s("pid")).alias("module_id"),
        F.col("user_id").alias("student_id"), grade.alias("grade"), F.lit("50").alias("max_grade"),
        F.col("created").alias("created"))


# Grading policy of every bridged course (fixed values):
# assignment type, short label, fraction of the overall grade, min count, drop count.
GRADERS = [("Homework", "HW", 0.4, 4, 1), ("Lab", "LB", 0.2, 2, 0), ("Exam", "EX", 0.4, 1, 0)]
CUTOFFS = {"lower": ("Pass", 0.5), "upper": ("A", 0.8)}


def grading_policy(spark: SparkSession, sf_dir: str) -> DataFrame:
    axis_courses = course_axis(spark, sf_dir).where(F.col("category") == "course").select("course_id")
    g = F.explode(F.array(*[F.struct(F.lit(a).alias("assignment_type"), F.lit(s).alias("short_label"),
                                     F.lit(f).alias("fraction_of_overall_grade"),
                                     F.lit(mn).cast("bigint").alias("min_count"),
                                     F.lit(d).cast("bigint").alias("drop_count"))
                            for a, s, f, mn, d in GRADERS])).alias("g")
    return axis_courses.select("course_id", g).select(
        "course_id", "g.*",
        F.lit(CUTOFFS["lower"][0]).alias("overall_cutoff_lower_label"),
        F.lit(CUTOFFS["lower"][1]).alias("overall_lower_cutoff"),
        F.lit(CUTOFFS["upper"][0]).alias("overall_cutoff_upper_label"),
        F.lit(CUTOFFS["upper"][1]).alias("overall_upper_cutoff"))


def grades_persistent(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = user_info_combo(spark, sf_dir)
    cnum = F.substring("course_id", 8, 1).cast("bigint")
    pg = ((F.col("user_id") * 13 + cnum) % 101).cast("double") / 100.0
    return u.where(F.col("user_id") % 6 != 0).select(
        "course_id", "user_id", pg.alias("percent_grade"),
        F.when(pg >= 0.8, "A").when(pg >= 0.5, "Pass").otherwise("").alias("letter_grade"))


def roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = user_info_combo(spark, sf_dir)
    uid = F.col("user_id")
    flags = [F.when(uid % 40 == 2 * i, 1).otherwise(0).cast("bigint").alias(f) for i, f in enumerate(ROLE_FLAGS[:-1])]
    flags.append(F.when(uid % 20 == 0, 0).otherwise(1).cast("bigint").alias(ROLE_FLAGS[-1]))
    return u.select("course_id", "user_id",
                    F.when(uid % 20 == 0, "Staff").when(uid % 20 == 1, F.lit(None).cast("string"))
                     .otherwise("Student").alias("roles"), *flags)


def geoip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Location of the log's addresses ``10.a.0.b``; ``a = 6`` is left out on purpose."""
    nation = read(spark, sf_dir, "nation").where(F.col("n_nationkey") < 6)
    a = F.col("n_nationkey")
    x = nation.select("n_nationkey", "n_name", F.explode(F.sequence(F.lit(0), F.lit(3))).alias("b"))
    return x.select(
        F.concat(F.lit("10."), _s(a), F.lit(".0."), _s("b")).alias("ip"),
        F.concat(F.lit("C"), _s(a)).alias("cc_by_ip"),
        F.col("n_name").alias("countryLabel"),
        _case(a % 3, {0: "Europe", 1: "Asia"}, default="Americas").alias("continent"),
        F.concat(F.lit("city"), _s(a), F.lit("_"), _s("b")).alias("city"),
        F.concat(F.lit("r"), _s(a)).alias("region"),
        F.lit(None).cast("string").alias("subdivision"),
        F.concat(F.lit("P"), _s(a * 10 + F.col("b"))).alias("postalCode"),
        _case(a % 2, {0: "North"}, default="South").alias("un_major_region"),
        _case(a % 3, {0: "High"}, default="Middle").alias("un_economic_group"),
        _case(a % 2, {0: "No"}, default="Yes").alias("un_developing_nation"),
        F.lit(None).cast("string").alias("un_special_region"),
        (a * 10.0 + F.col("b")).alias("latitude"),
        (F.col("b") * 10.0 - a).alias("longitude"),
    )


def youtube(spark: SparkSession, sf_dir: str) -> DataFrame:
    ax = course_axis(spark, sf_dir).where((F.col("category") == "video") & F.col("data.ytid").isNotNull())
    p = F.substring("url_name", 2, 10).try_cast("bigint")
    return ax.where(p % 16 == 0).select(
        F.concat(F.lit("yt"), _s(p)).alias("id"),
        F.concat(F.lit("video "), _s(p)).alias("title"),
        (30 + p % 200).cast("bigint").alias("duration"))


def _raw_log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_log_lines(tracking_log(spark, sf_dir))


TABLES = {
    "raw_log_lines": _raw_log_lines,
    "tracking_log": tracking_log, "course_axis": course_axis, "forum": forum,
    "user_info_combo": user_info_combo, "problem_analysis": problem_analysis,
    "studentmodule": studentmodule, "grading_policy": grading_policy,
    "grades_persistent": grades_persistent, "roles": roles, "geoip": geoip, "youtube": youtube,
}


# storage layout of the materialised tables: partition columns per table
LAYOUT = {"tracking_log": ["course_id", "log_date"]}


def _fingerprint(spark: SparkSession, sf_dir: str) -> str:
    """Names a data set by path, file sizes and times, through the Hadoop file system of its path."""
    import hashlib
    h = hashlib.sha1(sf_dir.encode())
    with open(__file__, "rb") as fh:   # a change to the bridge code invalidates stored tables
        h.update(fh.read())
    jvm = spark.sparkContext._jvm
    for name in ("events", "customer", "part", "supplier", "nation", "region", "lineitem", "orders", "conversations"):
        p = jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/{name}.parquet")
        fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        if fs.exists(p):
            for st in fs.listStatus(p):
                h.update(f"{name}:{st.getPath().getName()}:{st.getLen()}:{st.getModificationTime()}".encode())
    return h.hexdigest()[:16]


def stored(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Write a bridged table once into the shared checkpoint folder and read it back.

    This mirrors production, where reports read ingest tables stored as
    parquet (the log partitioned by course and day, so a date window prunes
    partitions and scans run file-parallel) instead of recomputing them.
    """
    import uuid

    from mooclens.session import checkpoint_dir, path_exists, shuffles_end
    path = f"{checkpoint_dir(spark)}/mooclens-bridge/{_fingerprint(spark, sf_dir)}/{name}"
    if not path_exists(spark, f"{path}/_SUCCESS"):
        df = TABLES[name](spark, sf_dir)
        parts = LAYOUT.get(name)
        # written under a private name, then renamed into place: a concurrent
        # first use never reads a half-written table
        tmp = f"{path}.tmp-{uuid.uuid4().hex[:12]}"
        w = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
        if parts:
            w = w.partitionBy(*parts)
        with shuffles_end(spark):
            w.parquet(tmp)
        jvm = spark.sparkContext._jvm
        fs_path = jvm.org.apache.hadoop.fs.Path(path)
        fs = fs_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        src = jvm.org.apache.hadoop.fs.Path(tmp)
        if fs.exists(fs_path) or not fs.rename(src, fs_path):
            fs.delete(src, True)   # another run got there first; its copy is identical
    return spark.read.parquet(path)


class Tables:
    """Lazy, memoised access to the bridged tables of one scale directory.

    With ``materialize`` (the default) each table is computed once per data
    set and stored (see ``stored``); without it the bridge is recomputed
    inside every query plan.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, materialize: bool = True):
        self.spark, self.sf_dir, self.materialize, self._memo = spark, sf_dir, materialize, {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in TABLES:
            raise AttributeError(name)
        if name not in self._memo:
            if self.materialize:
                df = stored(self.spark, self.sf_dir, name)
            else:
                df = TABLES[name](self.spark, self.sf_dir)
            self._memo[name] = df
        return self._memo[name]


# ---------------------------------------------------------------- raw inputs
# Every 50th log line is damaged, in one of four ways chosen by (seq / 50) % 4:
# 0 cut in half, 1 wrapped in a JSON array, 2 plain text, 3 text before the '{'.
BROKEN_EVERY = 50


def raw_log_lines(log: DataFrame) -> DataFrame:
    """Platform-style JSON lines for the bridged log (input of the log ingest).

    The course id is given by ``context.course_id`` on odd lines and only by
    the page URL (``course-v1:`` spelling) on even lines; the module id only as
    an ``i4x://`` usage key; ``event`` is an object on every third line and a
    JSON-encoded string otherwise.
    """
    seq = F.col("seq")
    even = seq % 2 == 0
    page = F.when(even, F.concat(F.lit("https://x.org/courses/course-v1:"),
                                 F.replace("course_id", F.lit("/"), F.lit("+")), F.lit("/courseware")))
    ctx = F.struct(F.when(~even, F.col("course_id")).alias("course_id"),
                   F.col("context.user_id").cast("string").alias("user_id"),
                   F.struct(F.when(F.col("module_id").isNotNull(), F.concat(F.lit("i4x://"), F.col("module_id")))
                            .alias("usage_key")).alias("module"))
    head = F.to_json(F.struct(
        F.date_format("time", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("time"), "username", "ip",
        "event_source", "event_type", "agent", page.alias("page"), ctx.alias("context")))
    listed = F.to_json(F.array("event"))
    quoted = F.substr(listed, F.lit(2), F.length(listed) - 2)
    ev = F.when(seq % 3 == 0, F.col("event")).otherwise(quoted)
    line = F.concat(F.substr(head, F.lit(1), F.length(head) - 1), F.lit(', "event": '), ev, F.lit("}"))
    kind = (seq / BROKEN_EVERY).cast("bigint") % 4
    broken = seq % BROKEN_EVERY == 0
    value = (F.when(broken & (kind == 0), F.expr("substring(_line, 1, cast(length(_line) / 2 as int))"))
             .when(broken & (kind == 1), F.concat(F.lit("["), F.col("_line"), F.lit("]")))
             .when(broken & (kind == 2), F.concat(F.lit("garbage line "), seq.cast("string")))
             .when(broken & (kind == 3), F.concat(F.lit("LOG: "), F.col("_line")))
             .otherwise(F.col("_line")))
    return log.select("seq", line.alias("_line")).select("seq", value.alias("value"))
