"""Registered queries for the ingest and table-upkeep operators.

Each takes ``(spark, sf_dir)``, derives its input from the bridged tables of
that data set, and returns the operator's output; ``oracles/extra_sql.py``
holds the matching DuckDB text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mooclens.operators import learner, logs
from mooclens.plans import ingest_queries, reports
from mooclens.plans.build import build_reports, run_query, run_query_dir
from mooclens.plans.incremental import REPORT_STATE, build_days
from mooclens.session import list_folder, scratch_path
from mooclens.sources.bridge import Tables
from mooclens.sources.logs import ingest_lines, split_tracking_logs
from mooclens.sources.tables import append_evolving, json_rows, load_table, merge_bucketed, merge_into, merge_table, read_evolving, read_table


def _t(spark, sf_dir) -> Tables:
    return Tables(spark, sf_dir)


def ingest_tracking_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I1-I4 (+ I6 record filters): platform JSON lines -> tracking_log rows."""
    rows, _ = ingest_lines(_t(spark, sf_dir).raw_log_lines)
    return rows.select("seq", "course_id", "time", "username", "ip", "event_source", "event_type", "module_id",
                       "event", F.col("event_struct.mode").alias("mode"), F.col("event_struct.GET").alias("get"))


def ingest_dead_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dead-letter lines counted by reason."""
    _, dead = ingest_lines(_t(spark, sf_dir).raw_log_lines)
    return dead.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def _scratch(spark: SparkSession, what: str) -> str:
    return f"{scratch_path(spark, 'queries')}/{what}"


def split_tracking_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gzip files of platform lines through the split job, one file loaded twice, and read back."""
    path = _scratch(spark, "split")
    lines = _t(spark, sf_dir).raw_log_lines
    files = 2 + lines.count() // 50_000  # about 50,000 lines each, in the order of the log
    lines.repartitionByRange(files, "seq").select("value").write.option("compression", "gzip").text(f"{path}/logs")
    for files in (f"{path}/logs/*.gz", f"{path}/logs/{list_folder(spark, f'{path}/logs')[-1]}"):
        out = split_tracking_logs(spark, files, f"{path}/out", dynamic_date=True)
    rows = spark.read.parquet(out["tracking_log"])
    return rows.select("course_id", "time", "username", "ip", "event_source", "event_type", "module_id", "event",
                       F.col("event_struct.mode").alias("mode"), F.col("event_struct.GET").alias("get"))


USERS = ["course_id", "user_id", "username", "email", "enrollment_mode"]


def _user_changes(users: DataFrame) -> DataFrame:
    """Changed e-mails, changed names under an unchanged e-mail, and new users."""
    k = F.col("user_id") % 7
    changed = users.where(k == 1).withColumn("email", F.concat("email", F.lit("*"))).withColumn("enrollment_mode", F.lit("changed"))
    same = users.where(k == 2).withColumn("username", F.concat("username", F.lit("!")))
    new = users.where(k == 3).withColumn("user_id", F.col("user_id") + 1_000_000_000).withColumn("email", F.lit("new"))
    return changed.unionByName(same).unionByName(new)


def merge_into_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M2: upsert of the user table; only rows whose e-mail differs are updated."""
    users = _t(spark, sf_dir).user_info_combo.select(*USERS)
    return merge_into(users, _user_changes(users), USERS[:2], match_unequal=["email"])


def merge_table_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M2 end to end: the user table is stored, merged twice with the same changes, and read back."""
    users, path = _t(spark, sf_dir).user_info_combo.select(*USERS), f"{_scratch(spark, 'users')}/table"
    for change in (users, _user_changes(users)):
        merge_table(spark, path, change, USERS[:2], match_unequal=["email"])
    return merge_table(spark, path, _user_changes(users), USERS[:2], match_unequal=["email"])


def merge_bucketed_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M2 by hash bucket: only buckets with a changed key are read and rewritten."""
    users, path = _t(spark, sf_dir).user_info_combo.select(*USERS), f"{_scratch(spark, 'users')}/table"
    merge_bucketed(spark, path, users, USERS[:2], buckets=16)
    return merge_bucketed(spark, path, _user_changes(users), USERS[:2], match_unequal=["email"])


def _days_in_three_builds(name: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        t, path = _t(spark, sf_dir), _scratch(spark, "days")
        days = sorted(str(r[0]) for r in t.tracking_log.select("log_date").distinct().collect())
        k = -(-len(days) // 3)
        for part in (days[:k], days[2 * k:], days[k:2 * k]):
            if part:
                build_days(spark, t, path, part, [name])
        return spark.read.parquet(f"{path}/{name}")
    run.__name__ = f"incremental_{name}"
    run.__doc__ = f"M3: {name} built for a first, a last and a late middle third of the log's days, without their history."
    return run


def append_evolving_grades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M1: three loads of JSON files, each wider than the one before: a score becomes a double, a day a time, a struct grows, a column is new."""
    g, path = _t(spark, sf_dir).grades_persistent, _scratch(spark, "grades")
    who, score = ["course_id", "user_id"], F.col("percent_grade") * 100
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("user_id") % 50).cast("int"))
    loads = [
        (0, "course_id string, user_id bigint, score bigint, day date, info struct<a:bigint>",
         [*who, F.floor(score).alias("score"), day.alias("day"), F.struct(F.col("user_id").alias("a")).alias("info")]),
        (1, "user_id bigint, course_id string, score double, day date, info struct<b:string,a:bigint>, letter string",
         [*who, score.alias("score"), day.alias("day"), F.struct(F.lit("b").alias("b"), F.col("user_id").alias("a")).alias("info"), F.col("letter_grade").alias("letter")]),
        (2, "course_id string, user_id bigint, score bigint, day timestamp",
         [*who, F.floor(score).alias("score"), F.concat(day.cast("string"), F.lit("T10:00:00")).alias("day")])]
    for k, schema, cols in loads:
        files = f"{path}/files{k}"
        g.where(F.col("user_id") % 3 == k).select(F.to_json(F.struct(*cols)).alias("value")).write.option("compression", "gzip").text(files)
        append_evolving(spark, f"{path}/table", json_rows(spark.read.text(files), T._parse_datatype_string(schema)))
    x = read_evolving(spark, f"{path}/table")
    return x.select("course_id", "user_id", "score", "day", F.col("info.a").alias("a"), F.col("info.b").alias("b"), "letter")


def load_csv_quoted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M1: CSV files whose quoted fields hold commas, quotes and line breaks."""
    u, path = _t(spark, sf_dir).user_info_combo, _scratch(spark, "csv")
    rows = u.select("course_id", "user_id", F.concat(F.col("username"), F.lit(',\n"x"')).alias("note"))
    rows.write.option("header", "true").option("quoteAll", "true").option("escape", '"').csv(f"{path}/files")
    load_table(spark, f"{path}/files", T._parse_datatype_string("course_id string, user_id bigint, note string"), f"{path}/table", fmt="csv")
    return read_table(spark, f"{path}/table")


def build_reports_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M3 with a course filter: two courses are built into a stored report, one of them again."""
    path = _scratch(spark, "build")
    for courses in (["DemoX/C0/T1", "DemoX/C2/T1"], ["DemoX/C2/T1"]):
        build_reports(spark, _t(spark, sf_dir), path, ["enrollday_all"], courses=courses, fail_fast=True)
    return spark.read.parquet(f"{path}/enrollday_all")


FORUM_SCHEMA = T.StructType([
    T.StructField("course_id", T.StringType()), T.StructField("mongoid", T.StringType()),
    T.StructField("_type", T.StringType()), T.StructField("author_id", T.LongType()),
    T.StructField("author_username", T.StringType()), T.StructField("title", T.StringType()),
    T.StructField("body", T.StringType()), T.StructField("comment_thread_id", T.StringType()),
    T.StructField("parent_id", T.StringType()), T.StructField("created_at", T.TimestampType()),
    T.StructField("pinned", T.BooleanType()), T.StructField("endorsed", T.BooleanType()),
    T.StructField("votes", T.StructType([T.StructField("count", T.LongType())])),
])


def load_json_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M1: files of forum posts as JSON lines (some broken) loaded against a declared schema."""
    f = _t(spark, sf_dir).forum
    broken = (F.col("_type") == "CommentThread") & (F.substring("mongoid", 2, 20).try_cast("bigint") % 29 == 7)
    lines = f.select(F.when(broken, F.concat(F.lit("not json "), F.col("mongoid")))
                     .otherwise(F.to_json(F.struct(*[F.col(c) for c in f.columns]))).alias("value"))
    path = _scratch(spark, "json")
    lines.write.option("compression", "gzip").text(f"{path}/files")
    load_table(spark, f"{path}/files", FORUM_SCHEMA, f"{path}/table", max_bad_rows=lines.count())
    rows = read_table(spark, f"{path}/table")
    return rows.select(*[c for c in FORUM_SCHEMA.fieldNames() if c != "votes"], F.col("votes.count").alias("votes_count"))


WINDOW = ("2024-01-10", "2024-01-20")


def log_window_show_answer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M4: a report over an inclusive date window (partition-pruned on ``log_date``)."""
    return logs.show_answer(_t(spark, sf_dir).tracking_log, start=WINDOW[0], end=WINDOW[1])


USER_SQL = """
select course_id, username, count(*) as n_events, count(distinct event_type) as n_types
from tracking_log
where array_contains(:types, event_type) and username <> ''
group by course_id, username
having count(*) >= :min_events
"""
USER_PARAMS = {"types": ["play_video", "pause_video", "problem_check"], "min_events": 3}


def user_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M5: a user's SQL file with typed named parameters over the tables."""
    return run_query(spark, USER_SQL, {"tracking_log": _t(spark, sf_dir).tracking_log}, USER_PARAMS)


USER_FILES = {
    # reads the other file, a common table and a report
    "a_busy_days": "with busy as (select distinct course_id from enrollday_all where diff_enrollment_honor <> 0) "
                   "select a.course_id, a.username, a.n from b_askers a where a.course_id in (select course_id from busy) and a.n >= :least",
    "b_askers": "-- learners who asked for answers\nselect course_id, username, count(*) as n from show_answer group by course_id, username",
}


def user_query_dir(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M5: a folder of two SQL files, one reading the other and a report; the last one's rows."""
    import os
    import tempfile
    with tempfile.TemporaryDirectory() as folder:  # read by the driver alone
        for name, sql in USER_FILES.items():
            with open(os.path.join(folder, f"{name}.sql"), "w", encoding="utf8") as fh:
                fh.write(sql)
        return run_query_dir(spark, folder, _t(spark, sf_dir), {"least": 2})["a_busy_days"]


def person_course_minimal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M6: the learner table when the optional inputs are absent (their columns are NULL)."""
    names = reports.CATALOG["person_course"].inputs
    return learner.person_course(*reports.resolve_all(names, _t(spark, sf_dir)).values())


def show_answer_stats_by_user_pc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R7 with the learner table given: explored / certified / verified filled in."""
    from mooclens.operators import grades
    r = reports.resolve_all(["problem_grades", "show_answer", "user_info_combo", "person_course"], _t(spark, sf_dir))
    return grades.show_answer_stats_by_user(*r.values())


def show_answer_stats_by_course_pc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R8 over the filled R7: the explored / certified / verified means and medians are live."""
    from mooclens.operators import grades
    return grades.show_answer_stats_by_course(show_answer_stats_by_user_pc(spark, sf_dir))


def time_on_task_2_10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R31 with non-default cutoffs (2 and 10 minutes): columns are named after them."""
    from mooclens.operators import timing
    return timing.time_on_task(_t(spark, sf_dir).tracking_log, timeout_short=2, timeout_long=10)


def forum_posts_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R23 with ``dedupe=True``: responses appear once, with their responder."""
    from mooclens.operators import forum
    return forum.forum_posts(_t(spark, sf_dir).forum, dedupe=True)


QUERIES = {
    "time_on_task_2_10": time_on_task_2_10,
    "forum_posts_dedupe": forum_posts_dedupe,
    "show_answer_stats_by_user_pc": show_answer_stats_by_user_pc,
    "show_answer_stats_by_course_pc": show_answer_stats_by_course_pc,
    "ingest_tracking_log": ingest_tracking_log,
    "ingest_dead_letters": ingest_dead_letters,
    "split_tracking_log": split_tracking_log,
    "merge_table_written": merge_table_written,
    "build_reports_subset": build_reports_subset,
    "load_json_table": load_json_table,
    "merge_into_users": merge_into_users,
    "merge_bucketed_users": merge_bucketed_users,
    "append_evolving_grades": append_evolving_grades,
    "load_csv_quoted": load_csv_quoted,
    **{f"incremental_{n}": _days_in_three_builds(n) for n in REPORT_STATE},
    "log_window_show_answer": log_window_show_answer,
    "user_query": user_query,
    "user_query_dir": user_query_dir,
    "person_course_minimal": person_course_minimal,
}
QUERIES.update(ingest_queries.QUERIES)
