"""Tracking-log ingest: raw JSON lines -> typed ``tracking_log`` rows.

The source processes each gzip file line by line in a process pool and keeps
one open output file per (course, day).  Here the whole job is one DataFrame
plan: ``spark.read.text`` (a gzip file is one task, so lines are spread with a
round-robin repartition right after the read), JSON parsing with a fixed
schema, column expressions for ids and the event struct, and one write
partitioned by course, day and source file; Spark sorts by the partition
columns before writing, which replaces the open-file juggling.
"""

from __future__ import annotations


from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mooclens.functions.ids import (course_id_candidate, course_id_from_text, module_id_candidate,
                                    module_id_from_text)
from mooclens.session import delete_path, scratch_path, shuffles_end

S, L, D = T.StringType(), T.LongType(), T.DoubleType()


def _st(*fields):
    return T.StructType([T.StructField(n, t) for n, t in fields])


# Raw record as written by the platform (only the fields we keep or read).
RAW_LOG_SCHEMA = _st(
    ("time", S), ("username", S), ("ip", S), ("event_source", S), ("event_type", S), ("agent", S),
    ("page", S), ("host", S), ("name", S), ("session", S), ("course_id", S), ("module_id", S),
    ("event", S), ("vname", S), ("datafn", S), ("_id", _st(("$oid", S))),
    ("context", _st(("course_id", S), ("user_id", S), ("org_id", S), ("path", S), ("agent", S),
                    ("username", S), ("ip", S), ("host", S), ("session", S),
                    ("module", _st(("display_name", S), ("usage_key", S), ("original_usage_key", S),
                                   ("original_usage_version", S))),
                    ("application", S), ("client", S), ("received_at", S), ("component", S),
                    ("open_in_browser_url", S), ("asides", S), ("course_user_tags", S))),
)

# Declared leaves of the event payload by type (fixed values). They are read as
# JSON text and cast, so a number written as a text counts, and nested values
# of text leaves stay JSON text.
EVENT_LEAVES = {
    "string": ("POST GET course_id mode data code id problem type problem_id answers submission success correct_map failure course query corrected_text "
               "child_id partition_name group_name old_state new_state status is_user_staff chapter direction name chapter_title caseSensitive findPrevious "
               "highlightAll item_id submission_returned_uuid requesting_student_id saved_response created_at submission_uuid submitted_at corrections "
               "options_selected scorer_id feedback score_type parts scored_at feedback_text options thumbnail_title location permutation url "
               "descriptionText description title aws_secret_key uploadedFileDir aws_access_key bucketName uploadedFileName error old_description "
               "old_title old_url old_descriptionText toggle reason isProblematic oldReason selection element "
               "state speed new_speed old_speed event_type answer rubric").split(),
    "bigint": "user_id new old attempts total_results page group_id partition_id attempt_number downvotes upvotes newVotes oldVotes category".split(),
    "double": "currentTime new_time old_time grade max_grade current_time amount".split(),
}
EVENT_SCHEMA = T.StructType([T.StructField(n, {"string": S, "bigint": L, "double": D}[k]) for k, names in EVENT_LEAVES.items() for n in names])


# Event types whose payload is kept as a typed struct, and markers that
# exclude an event type from it (fixed values).
KNOWN_EVENT_TYPES = [
    "play_video", "seq_goto", "seq_next", "seq_prev", "seek_video", "load_video", "save_problem_success",
    "save_problem_fail", "reset_problem_success", "reset_problem_fail", "show_answer",
    "edx.course.enrollment.activated", "edx.course.enrollment.deactivated", "edx.course.enrollment.mode_changed",
    "edx.course.enrollment.upgrade.succeeded", "speed_change_video", "problem_check", "problem_save",
    "problem_reset",
]
EXCLUDED_EVENT_MARKERS = ["video_embedded", "harvardx.button", "harvardx."]
MOBILE_CONTEXT_FIELDS = ["application", "client", "received_at", "component", "open_in_browser_url", "asides"]

DEAD_NOT_JSON = "Not valid JSON"
DEAD_NOT_RECORD = "The line is not a record"
DEAD_NO_SOURCE = "Record does not have the key 'event_source'"
DEAD_BAD_TIME = "Record time could not be parsed"
SKIPPED = "names no user"
PROBLEM_EVENTS = ["problem_check", "problem_save", "problem_reset"]


def _parsed(lines: DataFrame, text_col: str = "value") -> DataFrame:
    """Every line with its parsed ``raw`` struct and a ``reason`` where it is no record.

    A record is the JSON text from the first ``{``; lines without one are
    "not a record", lines whose JSON does not parse are "not valid JSON".
    """
    line = F.trim(F.col(text_col))
    pos = F.instr(line, "{")
    body = F.when(pos > 0, F.expr(f"substring(trim({text_col}), instr(trim({text_col}), '{{'))"))
    x = lines.select("*", body.alias("_body"))
    # the parser stops after the first complete value, so text after the
    # object ('{...}]') is caught by requiring the object to end the line
    reason = (F.when(F.col("_body").isNull(), F.lit(DEAD_NOT_RECORD))
              .when(F.try_parse_json("_body").isNull() | ~F.col("_body").endswith("}"), F.lit(DEAD_NOT_JSON)))
    x = x.withColumn("reason", reason)
    return x.withColumn("raw", F.when(F.col("reason").isNull() & _once(), F.from_json("_body", RAW_LOG_SCHEMA))).drop("_body")


def _once() -> Column:
    """True, in a form that the optimiser does not move: filters on what is parsed stay above the parsing instead of parsing again."""
    return F.spark_partition_id() >= 0


def _event_text(ev: Column) -> Column:
    """Event payload as JSON text; a payload that is not JSON is wrapped as ``{"event": ...}``."""
    valid = F.try_parse_json(ev).isNotNull() & _once()
    return F.when(ev.isNull(), F.lit("{}")).when(valid, ev).otherwise(F.to_json(F.struct(ev.alias("event"))))


def _event_leaves(event: Column) -> Column:
    """The payload's top-level values as texts by name.

    A map has only the names that are there, where a struct of all leaves is set up anew for every line. No name comes
    twice: a payload with one that does is no JSON for ``_event_text``.
    """
    return F.when(_once(), F.from_json(event, "map<string,string>"))


def normalize_log(records: DataFrame, seq_col: str = "seq", keep: list[str] | None = None) -> DataFrame:
    """I4: parsed raw records -> the ``tracking_log`` table layout.

    Course and module ids are derived (I2, I3); known event types keep their
    payload as a typed ``event_struct``, others keep only GET / POST / query;
    mobile-app context fields are packed into ``context.agent``; a NaN
    ``new_speed`` is dropped.  Unknown fields fall away with the fixed schema.
    """
    r = F.col("raw")
    # staged projections: each derived value becomes a column before it is
    # reused, so generated code stays small (no copies of big expressions)
    x = records.select("*", _event_text(r["event"]).alias("_event"))
    et = F.coalesce(r["event_type"], F.lit(""))
    known = (et.contains("problem_") | et.isin(*KNOWN_EVENT_TYPES))
    for m in EXCLUDED_EVENT_MARKERS:
        known = known & ~et.contains(m)
    rec = F.struct(r["course_id"].alias("course_id"), r["context"].alias("context"), r["page"].alias("page"),
                   r["event_type"].alias("event_type"), r["name"].alias("name"))
    x = x.select("*", _event_leaves(F.col("_event")).alias("_leaves"), known.alias("_known"), course_id_candidate(rec).alias("_cid"))
    leaf = F.col("_leaves")

    def text(n):
        return F.coalesce(leaf[n], leaf["child-id"]) if n == "child_id" else leaf[n]

    def typed(f):
        value = text(f.name) if f.dataType == S else text(f.name).try_cast(f.dataType)
        if f.name == "new_speed":
            value = F.when((et == "speed_change_video") & F.isnan(value.try_cast("double")), F.lit(None).cast("string")).otherwise(value)
        return value

    def kept(f):
        value = F.when(F.col("_known"), typed(f))
        if f.name in ("GET", "POST"):
            return value.otherwise(F.coalesce(F.get_json_object(F.col("_event"), f"$.{f.name}"), F.lit("null")))
        return typed(f) if f.name == "query" else value

    named = F.struct(*[text(n).alias(n) for n in ("event_type", "id", "problem_id")])
    rec = F.struct(r["context"].alias("context"), r["page"].alias("page"), r["event_type"].alias("event_type"), r["name"].alias("name"), named.alias("event_obj"))
    # a column per leaf first, so that readers of some leaves make only those
    leaves = {f.name: f"_leaf_{f.name}" for f in EVENT_SCHEMA}
    x = x.select("*", module_id_candidate(rec).alias("_mid"), *[kept(f).alias(leaves[f.name]) for f in EVENT_SCHEMA])
    event_struct = F.struct(*[F.col(c).alias(n) for n, c in leaves.items()])
    ctx = r["context"]
    agent_json = F.to_json(F.struct(F.coalesce(ctx["agent"], F.lit("")).alias("oldagent"),
                                    *[ctx[f].alias(f) for f in MOBILE_CONTEXT_FIELDS],
                                    ctx["module"]["usage_key"].alias("module.usage_key"),
                                    ctx["module"]["original_usage_version"].alias("module.original_usage_version"),
                                    ctx["module"]["original_usage_key"].alias("module.original_usage_key")))
    ctx_user = F.nullif(ctx["user_id"], F.lit("")).try_cast("bigint")
    time = F.coalesce(F.try_to_timestamp(r["time"]), r["time"].try_cast("timestamp"))
    return x.select(
        F.col(seq_col).alias("seq"),
        time.alias("time"),
        r["username"].alias("username"), r["ip"].alias("ip"), r["event_source"].alias("event_source"),
        r["event_type"].alias("event_type"), r["agent"].alias("agent"),
        course_id_from_text("_cid").alias("course_id"),
        module_id_from_text("_mid").alias("module_id"),
        r["page"].alias("page"),
        F.col("_event").alias("event"),
        F.struct(ctx_user.alias("user_id"), ctx["path"].alias("path"), ctx["course_id"].alias("course_id"),
                 ctx["org_id"].alias("org_id"), ctx["module"].alias("module"), agent_json.alias("agent"),
                 ctx["course_user_tags"].alias("course_user_tags"),
                 *[ctx[n].alias(n) for n in ("username", "ip", "host", "session")]).alias("context"),
        event_struct.alias("event_struct"),
        *[r[n].alias(n) for n in ("host", "name", "session", "vname", "datafn")], r["_id"]["$oid"].alias("mongoid"),
        *(keep or []),
    )


def file_date(path_col: Column) -> Column:
    """Day encoded in a log file's base name (``...-YYYY-MM-DD...``), NULL when absent."""
    base = F.element_at(F.split(path_col, "/"), -1)
    d = F.regexp_extract(base, r"(\d{4}-\d{2}-\d{2})", 1)
    return F.when(d != "", F.try_to_date(d))


def classified_lines(lines: DataFrame, dynamic_date: bool = True, file_col: str | None = None) -> DataFrame:
    """I1 + I4 in one projection: the normalised columns of every line, its text
    ``value``, ``log_date`` and ``reason`` (NULL: a record; ``SKIPPED``: names no
    user; else why it is a dead letter).

    ``log_date`` is the day in the file name unless ``dynamic_date``; a file
    without a day in its name takes the record's own.
    """
    if "seq" not in lines.columns:
        lines = lines.withColumn("seq", F.monotonically_increasing_id())
    keep = ["value"] + ([file_col] if file_col else [])
    x = _parsed(lines)
    # a problem event must name its source (the source platform fails on it)
    no_source = F.coalesce(F.col("raw.event_type").isin(*PROBLEM_EVENTS) & F.col("raw.event_source").isNull(), F.lit(False))
    x = x.withColumn("reason", F.coalesce("reason", F.when(no_source, F.lit(DEAD_NO_SOURCE))))
    x = normalize_log(x, keep=[*keep, "reason"])
    # records that name no user are skipped (not dead letters)
    has_user = (F.coalesce(F.col("username"), F.lit("")) != "") | F.col("context.user_id").isNotNull()
    day = F.to_date("time")
    x = x.withColumn("log_date", F.coalesce(file_date(F.col(file_col)), day) if file_col and not dynamic_date else day)
    return x.withColumn("reason", F.coalesce("reason", F.when(~has_user, F.lit(SKIPPED)), F.when(F.col("log_date").isNull(), F.lit(DEAD_BAD_TIME))))


def ingest_lines(lines: DataFrame, courses: list[str] | None = None, dynamic_date: bool = True,
                 file_col: str | None = None) -> tuple[DataFrame, DataFrame]:
    """I1 + I4 + the record filters of I6 on a DataFrame of lines.

    Keeps records that name a user (username or context user id) and, when
    ``courses`` is given, belong to one of them.
    Returns ``(tracking_log rows, dead letters)``.
    """
    x = classified_lines(lines, dynamic_date, file_col)
    dead = x.where(F.col("reason") != SKIPPED).select(F.col("value").alias("data"), "reason")
    rows = x.where(F.col("reason").isNull()).drop("value", "reason", *([file_col] if file_col else []))
    if courses:
        rows = rows.where(F.col("course_id").isin(list(courses)))
    return rows, dead


def split_tracking_logs(spark: SparkSession, paths: list[str] | str, out_dir: str, courses: list[str] | None = None,
                        dynamic_date: bool = False, partitions: int | None = None, max_file_rows: int = 2_000_000) -> dict:
    """The whole job: read (gzip) log files, parse, normalise, write the
    table and the dead letters.

    Lines are read and parsed once; the classified rows are stored in the
    shared folder and both outputs are written from there.  Every row is
    filed under its source file, so files of one day stand side by side, and
    a file that is loaded again replaces just its own rows and dead letters.
    Rows are partitioned by ``course`` (the course id, or ``UNKNOWN`` where
    that has fewer than three parts; ``course_id`` itself is kept),
    ``log_date`` and ``source_file``.  The write is rebalanced: AQE splits a
    large course-day over tasks and joins small ones.
    """
    lines = spark.read.text(paths).withColumn("_file", F.input_file_name()).withColumn("seq", F.monotonically_increasing_id())
    if partitions or _spread(spark, paths):
        lines = lines.repartition(partitions or spark.sparkContext.defaultParallelism, "seq")
    return split_lines(lines, out_dir, courses, dynamic_date, max_file_rows)


def _spread(spark: SparkSession, paths: list[str] | str) -> bool:
    """Whether lines must move before the heavy parsing: a gzip file is a single task, and one of these would keep a core longer than the others."""
    n = F.col("length")
    largest, total = spark.read.format("binaryFile").load(paths).agg(F.max(n), F.sum(n)).first()
    return (largest or 0) * 2 * spark.sparkContext.defaultParallelism > (total or 0)


def split_lines(lines: DataFrame, out_dir: str, courses: list[str] | None = None, dynamic_date: bool = False, max_file_rows: int = 2_000_000) -> dict:
    """The split job for lines (``value, _file, seq``) of whole files, shared by the batch and the streaming ingest."""
    spark = lines.sparkSession
    x = classified_lines(lines, dynamic_date, file_col="_file")
    name = F.regexp_replace(F.element_at(F.split("_file", "/"), -1), "[^A-Za-z0-9._-]", "_")
    x = x.withColumn("source_file", F.concat(name, F.lit("-"), F.substring(F.md5("_file"), 1, 12))).drop("_file")
    # the text of a row that is kept is not needed any more
    x = x.withColumn("value", F.when(F.col("reason") != SKIPPED, F.col("value")))
    stage = scratch_path(spark, "split")
    with shuffles_end(spark):
        x.write.parquet(stage)
    x = spark.read.parquet(stage)
    counts = {r["what"]: r["n"] for r in x.groupBy(F.when(F.col("reason").isNull(), "rows").when(F.col("reason") == SKIPPED, "skipped")
                                                   .otherwise("dead").alias("what")).agg(F.count(F.lit(1)).alias("n")).collect()}
    rows = x.where(F.col("reason").isNull()).drop("value", "reason")
    if courses:
        rows = rows.where(F.col("course_id").isin(list(courses)))
    rows = rows.withColumn("course", F.when(F.size(F.split("course_id", "/")) >= 3, F.col("course_id")).otherwise(F.lit("UNKNOWN")))
    dead = x.where(F.col("reason") != SKIPPED).select("source_file", F.col("value").alias("data"), "reason")
    out = {"tracking_log": (rows, ["course", "log_date", "source_file"]), "dead_letters": (dead, ["source_file"])}
    for table, (df, keys) in out.items():
        with shuffles_end(spark):
            (df.hint("rebalance", *keys).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .option("maxRecordsPerFile", max_file_rows).partitionBy(*keys).parquet(f"{out_dir}/{table}"))
    delete_path(spark, stage)
    return {**{t: f"{out_dir}/{t}" for t in out}, "counts": {k: counts.get(k, 0) for k in ("rows", "dead", "skipped")}}
