"""Database-dump and side-table ingest.

Each builder is a DataFrame function over rows read from the export files
(text lines, TSV, JSON); the file readers are thin (``spark.read.text``).  In
the source each builder walks one course's files in memory; here every builder
handles all courses in one job, keyed by ``(course_id, ...)``.

Dump files are read by ``sources.dumps``, addresses located by ``sources.geo``.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mooclens.functions.ids import clean_course_id, course_from_block, module_from_block
from mooclens.session import paths_exist, stored_scratch
from mooclens.sources.dumps import dump_records

C = "course_id"


# ------------------------------------------------------------------ I5 conform
def _coerce(c: Column, src: T.DataType, tgt: T.DataType) -> Column:
    if isinstance(tgt, T.StructType):
        if isinstance(src, T.StructType):
            have = {f.name: f.dataType for f in src.fields}
            return F.struct(*[(_coerce(c.getField(f.name), have[f.name], f.dataType) if f.name in have
                               else F.lit(None).cast(f.dataType)).alias(f.name) for f in tgt.fields])
        if isinstance(src, T.StringType):
            return F.from_json(c, tgt)
        return F.lit(None).cast(tgt)
    if isinstance(tgt, T.ArrayType):
        if isinstance(src, T.ArrayType):
            return F.transform(c, lambda x: _coerce(x, src.elementType, tgt.elementType))
        if isinstance(src, T.StringType):
            return F.from_json(c, tgt)
        return F.lit(None).cast(tgt)
    if isinstance(tgt, T.StringType):
        if isinstance(src, T.StringType):
            return F.trim(c)
        if isinstance(src, (T.StructType, T.ArrayType, T.MapType)):
            return F.trim(F.to_json(c))
        return F.trim(c.cast("string"))
    if isinstance(tgt, T.BooleanType):
        # truthiness: any non-empty text is true (also "false"), numbers are true unless 0
        if isinstance(src, T.StringType):
            return F.when(c.isNotNull(), F.length(c) > 0)
        if isinstance(src, T.BooleanType):
            return c
        return F.when(c.isNotNull(), c != 0)
    if isinstance(tgt, (T.DoubleType, T.FloatType)):
        x = c.try_cast("double")
        return F.when(~(F.isnan(x) | (F.abs(x) == float("inf"))), x)
    if isinstance(tgt, T.TimestampType):
        if isinstance(src, T.StringType):
            return F.coalesce(F.try_to_timestamp(c), c.try_cast("timestamp"))
        return c.try_cast("timestamp")
    if isinstance(tgt, T.DateType):
        return F.coalesce(F.try_to_date(c) if isinstance(src, T.StringType) else F.lit(None), c.try_cast("date"))
    return c.try_cast(tgt)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Coerce ``df`` to a declared schema.

    Missing fields become NULL, extra fields are dropped (recursively), values
    that do not convert become NULL, NaN/Inf become NULL, non-text values
    going into text become JSON text, and booleans follow truthiness.
    """
    have = {f.name: f.dataType for f in df.schema.fields}
    return df.select(*[(_coerce(F.col(f"`{f.name}`"), have[f.name], f.dataType) if f.name in have
                        else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema.fields])


# --------------------------------------------------------------- TSV readers
def read_tsv(lines: DataFrame, schema: T.StructType, text_col: str = "value", quote: str = "'",
             null_value: str | None = "NULL") -> DataFrame:
    """Tab-separated dump lines -> typed columns (NUL bytes removed first)."""
    opts = {"sep": "\t", "quote": quote}
    if null_value is not None:
        opts["nullValue"] = null_value
    clean = F.regexp_replace(F.col(text_col), "\u0000", "")
    return lines.select(F.from_csv(clean, schema.simpleString(), opts).alias("_r")).select("_r.*")


def _typed(records: DataFrame, columns: dict[str, str], null_texts: tuple[str, ...] = ("NULL",), any_case: bool = False) -> DataFrame:
    """Declared columns of dump records; ``null_texts`` become NULL, absent columns too."""
    out = []
    for name, kind in columns.items():
        text = F.col("r")[name]
        seen = F.upper(text) if any_case else text
        text = F.when(~seen.isin(*null_texts), text)
        out.append((F.coalesce(F.try_to_timestamp(text), text.try_cast("timestamp")) if kind == "timestamp" else
                    text if kind == "string" else text.try_cast(kind)).alias(name))
    return records.select(*out)


# declared columns of the dump tables (fixed values)
GRADES_PERSISTENT = {"course_id": "string", "user_id": "bigint", "grading_policy_hash": "string", "percent_grade": "double", "letter_grade": "string",
                     "passed_timestamp": "timestamp", "created": "timestamp", "modified": "timestamp"}
GRADES_SUBSECTION = {"course_id": "string", "user_id": "bigint", "usage_key": "string", "earned_all": "double", "possible_all": "double",
                     "earned_graded": "double", "possible_graded": "double", "first_attempted": "timestamp", "created": "timestamp",
                     "modified": "timestamp"}
STUDENTMODULE = {"id": "bigint", "module_type": "string", "module_id": "string", "student_id": "bigint", "state": "string", "grade": "string",
                 "created": "timestamp", "modified": "timestamp", "max_grade": "string", "done": "string", "course_id": "string"}


def grades_persistent(records: DataFrame, columns: dict[str, str] | None = None) -> DataFrame:
    """Persistent course grades (``GRADES_SUBSECTION`` for subsection grades)
    from dump records; course ids cleaned, "NULL" -> NULL."""
    return _typed(records, columns or GRADES_PERSISTENT).withColumn(C, clean_course_id(C))


def grades_persistent_subsection(records: DataFrame) -> DataFrame:
    """Persistent subsection grades from dump records."""
    return grades_persistent(records, GRADES_SUBSECTION)


def studentmodule(records: DataFrame) -> DataFrame:
    """Courseware state from dump records: block ids become
    ``ORG/NUM/TERM/type/id`` module ids, course ids are cleaned, and "null" in
    any case is NULL.  A dump without a course column takes it from the block id."""
    x = _typed(records, STUDENTMODULE, ("NULL",), any_case=True)
    return x.withColumn(C, F.coalesce(clean_course_id(C), course_from_block("module_id"))).withColumn("module_id", module_from_block("module_id"))


# ----------------------------------------------------- I7 user_info_combo merge
# the user dumps: file name, quote character, id column, columns (fixed values)
USER_DUMPS = {
    "auth_user": ("auth_user-analytics.sql", '"', "id", "username email is_staff last_login date_joined"),
    "profile": ("auth_userprofile-analytics.sql", None, "user_id", "username name language location meta courseware gender mailing_address year_of_birth level_of_education goals "
                "allow_certificate country city"),
    "enrollment": ("student_courseenrollment-analytics.sql", None, "user_id", "username created is_active mode"),
    "certificate": ("certificates_generatedcertificate-analytics.sql", None, "user_id", "username id download_url grade key distinction status verify_uuid download_uuid name "
                    "created_date modified_date error_reason mode"),
    "id_map": ("user_id_map-analytics.sql", None, "user_id", "username hash_id"),
}


def user_dumps(spark: SparkSession, base: str) -> dict[str, DataFrame]:
    """The five user dumps below ``base/<course>/``, as ``user_info_combo`` takes them.

    The course is the name of the folder above the dump (``ORG__NUM__TERM``; ``course=`` before it is dropped) unless a row names its own; ``seq`` is the row's place in its file. A dump
    may be one file or a folder of files. A row without ``user_id`` takes its ``id``.
    """
    out = {}
    for part, (name, quote, uid, columns) in USER_DUMPS.items():
        paths = [f"{base}/*/{spelt}" for spelt in (name, f"dump={name}/*") if paths_exist(spark, f"{base}/*/{spelt}")]
        if not paths:
            raise FileNotFoundError(f"no {name} below {base}")
        r = dump_records(spark, paths, quote)
        folder = F.regexp_extract("file", rf"/(?:course=)?([^/]+)/(?:dump=)?{re.escape(name)}", 1)
        course = F.coalesce(F.when(F.col("r")[C] != "", F.col("r")[C]), F.regexp_replace(folder, "__", "/"))
        who = F.coalesce(F.col("r")[uid], F.col("r")["id"]).try_cast("bigint")
        out[part] = r.select(course.alias(C), who.alias(uid if part == "auth_user" else "user_id"), *[F.col("r")[c].alias(c) for c in columns.split()], F.col("at").alias("seq"))
    return out


def _last_per_user(df: DataFrame, order_col: str | None) -> DataFrame:
    if order_col is None or order_col not in df.columns:
        return df.dropDuplicates([C, "user_id"])
    others = [c for c in df.columns if c not in (C, "user_id")]
    return (df.groupBy(C, "user_id").agg(F.max_by(F.struct(*others), F.col(order_col)).alias("_r"))
            .select(C, "user_id", "_r.*").drop(order_col))


def _nullify(df: DataFrame) -> DataFrame:
    return df.select(*[F.when(~F.trim(F.col(c)).isin("NULL", "null"), F.trim(F.col(c))).alias(c) if t == "string" else F.col(c)
                       for c, t in df.dtypes])


def user_info_combo(auth_user: DataFrame, profile: DataFrame, enrollment: DataFrame, certificate: DataFrame,
                    id_map: DataFrame, order_col: str | None = "seq") -> DataFrame:
    """Merge the five user dumps into one row per (course, user).

    Each source keeps its last row per user (``order_col``), columns get their
    source prefix, texts are stripped, "NULL" and "null" become NULL, and the
    sources are full-outer joined on ``(course_id, user_id)``; rows without a
    user id are dropped.  A user that the account dump does not name takes the
    ``username`` of the first other dump that has one.
    """
    def prep(df, prefix, rename_id=None):
        df = _nullify(df)
        if rename_id:
            df = df.withColumnRenamed(rename_id, "user_id")
        df = df.withColumn(C, clean_course_id(C)).where(F.col("user_id").isNotNull())
        df = _last_per_user(df, order_col)
        if prefix:
            df = df.select(C, "user_id", *[F.col(c).alias(f"{prefix}_{c}") for c in df.columns
                                           if c not in (C, "user_id")])
        return df

    parts = [prep(auth_user, None, "id"), prep(profile, "profile"), prep(enrollment, "enrollment"),
             prep(certificate, "certificate"), prep(id_map, "id_map")]
    out = reduce(lambda a, b: a.join(b, [C, "user_id"], "full"), parts)
    others = [c for c in ("profile_username", "enrollment_username", "certificate_username", "id_map_username") if c in out.columns]
    if others and "username" in out.columns:
        out = out.withColumn("username", F.coalesce("username", *others))
    if "certificate_grade" in out.columns:
        out = out.withColumn("certificate_grade", F.col("certificate_grade").try_cast("double"))
    return out


# ---------------------------------------------------------- I11 grading policy
POLICY_SCHEMA = T.StructType([
    T.StructField("GRADER", T.ArrayType(T.StructType([
        T.StructField("type", T.StringType()), T.StructField("short_label", T.StringType()),
        T.StructField("weight", T.DoubleType()), T.StructField("min_count", T.LongType()),
        T.StructField("drop_count", T.LongType())]))),
    T.StructField("GRADE_CUTOFFS", T.MapType(T.StringType(), T.DoubleType())),
])


def grading_policy(policies: DataFrame, text_col: str = "policy") -> DataFrame:
    """One row per grader of each course's policy document, with the
    lowest and highest grade cutoffs and their labels."""
    p = policies.select(C, F.from_json(text_col, POLICY_SCHEMA).alias("p"))
    cut = F.array_sort(F.map_entries("p.GRADE_CUTOFFS"),
                       lambda a, b: F.when(a["value"] < b["value"], -1).when(a["value"] > b["value"], 1).otherwise(0))
    p = p.select(C, F.explode("p.GRADER").alias("g"), cut.alias("cut"))
    lo, hi = F.element_at("cut", 1), F.element_at("cut", -1)
    return p.select(C, F.col("g.type").alias("assignment_type"), F.col("g.type").alias("name"),
                    F.col("g.weight").alias("fraction_of_overall_grade"), F.col("g.min_count").alias("min_count"),
                    F.col("g.drop_count").alias("drop_count"), F.col("g.short_label").alias("short_label"),
                    lo["value"].alias("overall_lower_cutoff"), lo["key"].alias("overall_lower_cutoff_label"),
                    hi["value"].alias("overall_upper_cutoff"), hi["key"].alias("overall_upper_cutoff_label"))


# ---------------------------------------------------------- I12 forum (mongo)
_OID = T.StructType([T.StructField("$oid", T.StringType())])
_DATE = T.StructType([T.StructField("$date", T.StringType())])
# declared columns by kind (fixed values)
FORUM_TEXTS = ("_type author_username title body thread_type commentable_id sk abuse_flaggers historical_abuse_flaggers at_position_list "
               "tags_array").split()
FORUM_FLAGS = "pinned endorsed anonymous anonymous_to_peers visible closed".split()
FORUM_COUNTS = "author_id child_count comment_count group_id".split()
FORUM_IDS = "comment_thread_id parent_id".split()
FORUM_DATES = "created_at updated_at last_activity_at".split()
FORUM_VOTES = {"count": "bigint", "point": "bigint", "up_count": "bigint", "down_count": "bigint", "up": "string", "down": "string"}
MONGO_FORUM_SCHEMA = T.StructType([
    T.StructField("_id", _OID), T.StructField("course_id", T.StringType()), T.StructField("parent_ids", T.ArrayType(_OID)),
    *[T.StructField(n, T.StringType()) for n in (*FORUM_TEXTS, *FORUM_FLAGS, *FORUM_COUNTS)],
    *[T.StructField(n, _OID) for n in FORUM_IDS], *[T.StructField(n, _DATE) for n in FORUM_DATES],
    T.StructField("votes", T.StructType([T.StructField(n, T.StringType()) for n in FORUM_VOTES])),
    T.StructField("endorsement", T.StructType([T.StructField("user_id", T.StringType()), T.StructField("time", _DATE)])),
])


def forum_from_mongo(lines: DataFrame, text_col: str = "value") -> DataFrame:
    """Extended-JSON forum documents -> flat forum rows (``$oid`` and
    ``$date`` unwrapped, course id cleaned, list values kept as JSON text,
    "NULL" texts NULL)."""
    d = lines.select(F.from_json(text_col, MONGO_FORUM_SCHEMA).alias("d")).select("d.*")
    text = lambda c: F.when(c != "NULL", c)
    return d.select(
        clean_course_id(C).alias(C), F.col("_id.$oid").alias("mongoid"), *[text(F.col(n)).alias(n) for n in FORUM_TEXTS],
        *[F.col(n).try_cast("boolean").alias(n) for n in FORUM_FLAGS], *[F.col(n).try_cast("bigint").alias(n) for n in FORUM_COUNTS],
        *[F.col(f"{n}.$oid").alias(n) for n in FORUM_IDS], *[F.try_to_timestamp(F.col(f"{n}.$date")).alias(n) for n in FORUM_DATES],
        F.to_json(F.transform("parent_ids", lambda p: p["$oid"])).alias("parent_ids"),
        F.when(F.col("votes").isNotNull(), F.struct(*[F.col(f"votes.{n}").try_cast(t).alias(n) for n, t in FORUM_VOTES.items()])).alias("votes"),
        F.when(F.col("endorsement").isNotNull(), F.struct(F.col("endorsement.user_id").alias("user_id"),
                                                          F.try_to_timestamp(F.col("endorsement.time.$date")).alias("time"))).alias("endorsement"))


# ----------------------------------------------------- I14 problem_analysis
STATE_SCHEMA = T.StructType([
    T.StructField("correct_map", T.MapType(T.StringType(), T.StructType([
        T.StructField("correctness", T.StringType()), T.StructField("npoints", T.DoubleType()),
        T.StructField("msg", T.StringType()), T.StructField("hint", T.StringType())]))),
    T.StructField("attempts", T.LongType()), T.StructField("done", T.BooleanType()),
])


def problem_analysis(studentmodule: DataFrame) -> DataFrame:
    """One row per (course, user, problem) with an item struct per answered
    input, from the state JSON of any module whose state names both a
    correctness map and answers (they may be empty).

    Answers keep their JSON: a text comes out quoted, a list as a list, a
    missing answer as ``null``.  Doubled backslashes of the dump are undone first.
    """
    state = F.replace(F.coalesce("state", F.lit("{}")), F.lit("\\\\"), F.lit("\\"))
    s = studentmodule.select(
        C, F.col("student_id").alias("user_id"), F.element_at(F.split("module_id", "/"), -1).alias("problem_url_name"),
        state.alias("state"), F.col("grade").try_cast("double").alias("grade"), F.col("max_grade").try_cast("double").alias("max_grade"), "created")
    # a filter would move below the selection and take its own copy of the text and of every parse with it: rows go
    # by an explode of nothing instead, so each state is made once and parsed once as a variant, once to the schema
    s = s.withColumn("doc", F.try_parse_json("state"))
    part = lambda name: F.try_variant_get("doc", f"$.{name}", "variant")
    answers = F.expr("cast(try_variant_get(doc, '$.student_answers', 'variant') as map<string, variant>)")
    no_map = F.create_map().cast(STATE_SCHEMA["correct_map"].dataType)
    item = lambda f: F.transform(F.map_entries(F.coalesce(f["st"]["correct_map"], no_map)), lambda e: F.struct(
        e["key"].alias("answer_id"), F.coalesce(F.to_json(f["answers"][e["key"]]), F.lit("null")).alias("response"),
        e["value"]["correctness"].alias("correctness"),
        (F.coalesce(e["value"]["correctness"], F.lit("")) == "correct").alias("correct_bool"),
        e["value"]["npoints"].alias("npoints"), e["value"]["msg"].alias("msg"), e["value"]["hint"].alias("hint")))
    parsed = F.array(F.struct(F.from_json("state", STATE_SCHEMA).alias("st"), answers.alias("answers")))
    found = F.transform(parsed, lambda f: F.struct(item(f).alias("item"), F.coalesce(f["st"]["attempts"], F.lit(0)).alias("attempts"), f["st"]["done"].alias("done")))
    s = s.withColumn("found", F.explode(F.when(part("correct_map").isNotNull() & part("student_answers").isNotNull(), found)))
    return s.select(C, "user_id", "problem_url_name", "found.item", "found.attempts", "found.done", "grade", "max_grade", "created")


# --------------------------------------------------------------- I15 roles
# flag columns (fixed values)
ROLE_FLAGS = ["roles_isBetaTester", "roles_isInstructor", "roles_isStaff", "roles_isCCX", "roles_isFinance", "roles_isLibrary", "roles_isSales",
              "forumRoles_isAdmin", "forumRoles_isCommunityTA", "forumRoles_isModerator", "forumRoles_isStudent"]
# role name in the dumps -> flag column (fixed values)
ROLE_NAMES = {
    "beta_testers": "roles_isBetaTester", "ccx_coach": "roles_isCCX", "finance_admin": "roles_isFinance",
    "instructor": "roles_isInstructor", "library_user": "roles_isLibrary", "sales_admin": "roles_isSales",
    "staff": "roles_isStaff", "Administrator": "forumRoles_isAdmin", "Community": "forumRoles_isCommunityTA",
    "Community TA": "forumRoles_isCommunityTA", "Moderator": "forumRoles_isModerator",
    "Student": "forumRoles_isStudent",
}


def roles(access_roles: DataFrame, forum_roles: DataFrame) -> DataFrame:
    """One row per (course, user) with eleven role flags and a label.

    Label: Staff when any course-staff flag is set or any role is not a
    student role, else Student (the source's result depended on file order).
    """
    rows = access_roles.select(C, "user_id", "role").unionByName(forum_roles.select(C, "user_id", "role"))
    rows = rows.withColumn(C, clean_course_id(C))
    aggs = []
    for flag_col in ROLE_FLAGS:
        names = [n for n, f in ROLE_NAMES.items() if f == flag_col]
        aggs.append(F.max(F.when(F.col("role").isin(*names), 1).otherwise(0)).cast("bigint").alias(flag_col))
    aggs.append(F.max(F.when(~F.coalesce(F.col("role"), F.lit("")).contains("Student"), 1).otherwise(0)).alias("_staffy"))
    x = rows.groupBy(C, "user_id").agg(*aggs)
    staff = reduce(lambda a, b: a | b, [F.col(f) == 1 for f in ROLE_FLAGS if f.startswith("roles_")])
    return x.select(C, "user_id", F.when(staff | (F.col("_staffy") == 1), "Staff").otherwise("Student").alias("roles"),
                    *ROLE_FLAGS)


# -------------------------------------------------------- I16 email opt-in
def email_opt_in(rows: DataFrame) -> DataFrame:
    """I16: opt-in CSV rows -> typed rows; ``course-v1:ORG+NUM+TERM`` becomes
    ``ORG/NUM/TERM`` (first two ``+`` to ``/``, others to ``_``)."""
    cid = F.element_at(F.split(F.coalesce(F.col(C), F.lit("")), ":"), -1)
    parts = F.split(cid, r"\+")
    cleaned = F.when(F.size(parts) <= 3, F.array_join(parts, "/")).otherwise(
        F.concat(F.array_join(F.slice(parts, 1, 3), "/"), F.lit("_"),
                 F.array_join(F.slice(parts, F.lit(4), F.size(parts)), "_")))
    ts = F.split(F.col("preference_set_datetime"), r"\+").getItem(0)
    side = [(F.col(n) if n in rows.columns else F.lit(None).cast("string")).alias(n) for n in ("username", "email", "full_name")]
    return rows.where(F.col("user_id").isNotNull()).select(
        F.col("user_id").try_cast("bigint").alias("user_id"), *side, cleaned.alias(C),
        (F.lower(F.trim(F.coalesce(F.col("is_opted_in_for_email"), F.lit("")))) == "true").alias("is_opted_in_for_email"),
        F.try_to_timestamp(ts, F.lit("yyyy-MM-dd HH:mm:ss")).alias("preference_set_datetime"))


# --------------------------------------------------------- I18 / I19 youtube
def distinct_youtube_ids(course_axis: DataFrame) -> DataFrame:
    """Distinct YouTube ids of the course videos (text after at most two ``:``)."""
    yt = F.trim(F.element_at(F.split("data.ytid", ":", 3), -1))
    return course_axis.where(F.col("data.ytid").isNotNull() & (F.col("data.ytid") != "")) \
        .select(yt.alias("id")).where(F.col("id") != "").distinct()


# seconds per ISO-8601 duration unit (fixed values); months and years as averages
TIME_SECS = {"S": 1, "M": 60, "H": 3600}
DATE_SECS = {"D": 86400, "M": 2629800, "Y": 31557600}


def iso_duration_seconds(c) -> Column:
    """``P[n]Y[n]M[n]DT[n]H[n]M[n]S`` -> seconds (NULL without a ``T`` part)."""
    d = c if isinstance(c, Column) else F.col(c)
    m = r"^P(\w*)T(\w*)"
    ok = d.rlike(m)
    date, time = F.regexp_extract(d, m, 1), F.regexp_extract(d, m, 2)
    total = F.lit(0).cast("bigint")
    for part, table in ((time, TIME_SECS), (date, DATE_SECS)):
        for unit, secs in table.items():
            num = F.regexp_extract(part, rf"(\d+){unit}", 1)
            total = total + F.coalesce(F.nullif(num, F.lit("")).try_cast("bigint"), F.lit(0)) * secs
    return F.when(ok, total)


YOUTUBE_ITEM_SCHEMA = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("snippet", T.StructType([T.StructField(n, T.StringType()) for n in
                                           ("title", "description", "channelId", "channelTitle", "publishedAt")])),
    T.StructField("contentDetails", T.StructType([T.StructField("duration", T.StringType())])),
])


def youtube_metadata(items: DataFrame, text_col: str = "value") -> DataFrame:
    """YouTube API items -> flat rows with the duration in seconds."""
    i = items.select(F.from_json(text_col, YOUTUBE_ITEM_SCHEMA).alias("i"))
    return i.select(F.col("i.id").alias("id"), F.col("i.snippet.title").alias("title"),
                    F.col("i.snippet.description").alias("description"),
                    F.col("i.snippet.channelId").alias("channel_id"),
                    F.col("i.snippet.channelTitle").alias("channel_title"),
                    F.try_to_timestamp(F.col("i.snippet.publishedAt")).alias("published_at"),
                    iso_duration_seconds(F.col("i.contentDetails.duration")).alias("duration"))


# --------------------------------------------------- I8 / I9 course structure
# block metadata inherited from the nearest ancestor with a truthy value (self first):
# output column -> metadata key (fixed values)
INHERITED_META = {"name": "display_name", "gformat": "format", "due": "due", "start": "start", "graded": "graded",
                  "visible_to_staff_only": "visible_to_staff_only"}


def _youtube_id(meta: Column, mtype: T.StructType) -> Column:
    """``youtube_id_1_0: abc`` -> ``1:0:abc``, of the first such field with a value."""
    found = [F.when(meta[n] != "", F.concat(F.lit(":".join([*re.findall(r"\d+", n), ""])), meta[n])) for n in mtype.fieldNames() if "youtube_id" in n]
    return F.coalesce(*found) if found else F.lit(None).cast("string")


def _truthy(c: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.BooleanType):
        return F.coalesce(c, F.lit(False))
    if isinstance(dtype, T.StringType):
        return F.coalesce(c != "", F.lit(False))
    return c.isNotNull()


def course_axis_from_blocks(blocks: DataFrame, itypes: DataFrame | None = None, durations: DataFrame | None = None) -> DataFrame:
    """I8: walk each course's block tree in pre-order.

    ``blocks``: ``course_id, block_id, url_name, category, children`` (ordered
    child block ids) and ``meta`` (struct with ``display_name, format, due,
    start, end, graded, visible_to_staff_only, weight, showanswer`` and any
    ``youtube_id*`` fields, of which the first one set gives ``data.ytid``: the digits
    of the field's name and the id, joined by ``:``).
    The walk doubles pointers: a row per block starts with a pointer to its parent and what it
    inherits on the way, and every round joins the rows at their pointers, so that paths of 1, 2, 4, 8 ... steps
    are combined and a tree of any depth takes its logarithm in rounds, each one join, stored in the
    shared folder.  A row carries the child ordinals of its path and its inherited metadata;
    sorting by the path within a course gives the pre-order ``index``.  A block
    that is its own ancestor is an error, and so is a course without a root
    block.  ``path`` is the chain of ``url_name``s below the root;
    ``chapter_mid`` is the last chapter met in pre-order; inherited fields take
    the nearest truthy value up the tree; a block with a grading format and no
    due / start date gets the course's end / start.  ``module_id`` and
    ``chapter_mid`` are block ids in their ``ORG/NUM/TERM/type/id`` form.
    ``itypes`` / ``durations`` (I9 outputs, keyed by ``course_id, url_name``)
    fill ``data.itype`` and ``data.duration``.
    """
    spark = blocks.sparkSession
    mtype = blocks.schema["meta"].dataType
    inh_fields = [(out, key, mtype[key].dataType) for out, key in INHERITED_META.items()
                  if key in mtype.fieldNames()]
    b = blocks.select(C, "block_id", "url_name", "category", "children", "meta")

    def inherit(mine, above) -> Column:
        """The nearer one's truthy values, else the farther one's."""
        return F.struct(*[F.when(_truthy(mine[out], dt), mine[out]).otherwise(above[out]).alias(out) for out, _, dt in inh_fields])

    rootless = b.groupBy(C).agg(F.max(F.col("category") == "course").alias("has")).where("not has").limit(5).collect()
    if rootless:
        raise ValueError(f"no root course block in {[r[0] for r in rootless]}")
    own = b.withColumn("inh", F.struct(*[F.col("meta")[key].alias(out) for out, key, _ in inh_fields]))
    edges = b.select(C, F.col("block_id").alias("up"), F.col("url_name").alias("parent"), F.col("category").alias("parent_cat"), F.posexplode("children").alias("pos", "block_id"))
    rows = own.join(edges, [C, "block_id"], "left")  # a block in two places has two rows
    is_root = F.col("category") == "course"
    rows = rows.select(*b.columns, "inh", "parent", "parent_cat", F.when(~is_root, F.col("up")).alias("up"), is_root.alias("rooted"),
                       F.when(is_root, F.array().cast("array<int>")).otherwise(F.array("pos")).alias("ord"),
                       F.when(is_root, F.array().cast("array<string>")).otherwise(F.array("url_name")).alias("names"), F.array("block_id").alias("chain"))
    rows = stored_scratch(spark, rows, "axis")
    loops = rows.where("false").select(C, "block_id")
    while not (open_ := rows.where(F.col("up").isNotNull())).isEmpty():
        above = rows.select(C, F.col("block_id").alias("up"), F.col("inh").alias("a_inh"), F.col("rooted").alias("a_rooted"), F.col("ord").alias("a_ord"),
                            F.col("names").alias("a_names"), F.col("chain").alias("a_chain"), F.col("up").alias("a_up"))
        joined = open_.drop("rooted").join(above, [C, "up"]).select(
            *b.columns, inherit(F.col("inh"), F.col("a_inh")).alias("inh"), "parent", "parent_cat", F.col("a_up").alias("up"), F.col("a_rooted").alias("rooted"),
            F.concat("a_ord", "ord").alias("ord"), F.concat("a_names", "names").alias("names"), F.concat("a_chain", "chain").alias("chain"))
        rows = stored_scratch(spark, rows.where(F.col("up").isNull()).unionByName(joined), "axis")
        repeats = (F.size(F.array_distinct("chain")) < F.size("chain")) | F.array_contains("chain", F.col("up"))
        loops = loops.unionByName(rows.where(repeats).select(C, "block_id"))
        rows = rows.where(~F.coalesce(repeats, F.lit(False)))
    done = rows.where("rooted")
    loop = loops.join(done.select(C, "block_id"), [C, "block_id"], "left_semi").first()  # blocks that no root reaches do not matter
    if loop:
        raise ValueError(f"block {loop['block_id']} of {loop[C]} is its own ancestor")
    done = done.withColumn("path", F.concat(F.lit("/"), F.array_join("names", "/"))).drop("chain", "names", "rooted", "up")
    root = b.where(F.col("category") == "course").select(
        C, F.col("meta.start").alias("_root_start"), F.col("meta.end").alias("_root_end"))
    w = Window.partitionBy(C).orderBy("ord")
    x = done.join(root, C, "left")  # one row per course
    x = x.join(itypes.select(C, "url_name", "itype"), [C, "url_name"], "left") if itypes is not None \
        else x.withColumn("itype", F.lit(None).cast("string"))
    x = x.join(durations.select(C, "url_name", "duration"), [C, "url_name"], "left") if durations is not None \
        else x.withColumn("duration", F.lit(None).cast("double"))
    cat = F.col("category")
    has_format = F.coalesce(F.col("inh.gformat") != "", F.lit(False))
    is_split = cat.contains("split_test") | F.coalesce(F.col("parent_cat"), F.lit("")).contains("split_test")
    meta = F.col("meta")
    return x.select(
        C, F.row_number().over(w).cast("bigint").alias("index"), module_from_block("block_id").alias("module_id"),
        "url_name", "category", F.col("inh.name").alias("name"), F.col("inh.gformat").alias("gformat"),
        F.when(has_format, F.coalesce("inh.due", "_root_end")).otherwise(F.col("inh.due")).try_cast("timestamp")
        .alias("due"),
        F.when(has_format, F.coalesce("inh.start", "_root_start")).otherwise(F.col("inh.start"))
        .try_cast("timestamp").alias("start"),
        F.coalesce(F.col("inh.graded"), F.lit(False)).alias("graded"),
        F.col("inh.visible_to_staff_only").alias("visible_to_staff_only"),
        "path", "parent",
        F.last(F.when(cat == "chapter", module_from_block("block_id")), ignorenulls=True).over(
            w.rowsBetween(Window.unboundedPreceding, 0)).alias("chapter_mid"),
        is_split.alias("is_split"),
        F.when(is_split, F.when(cat.contains("split_test"), F.col("url_name")).otherwise(F.col("parent")))
        .alias("split_url_name"),
        F.struct(_youtube_id(meta, mtype).alias("ytid"), meta["weight"].alias("weight"), F.col("itype").alias("itype"),
                 F.when(cat.contains("problem"), F.size("children") + 1).alias("num_items"),
                 F.coalesce(meta["showanswer"] != "never", F.lit(False)).alias("has_solution"),
                 F.col("duration").alias("duration")).alias("data"))


# known response tags of a problem (fixed values, as spelled by the platform export)
PROBLEM_TYPES = ["choiceresponse", "coderespons", "customresponse", "fieldset", "formularesponse", "imageresponse",
                 "multiplechoiceresponse", "numericalresponse", "optionresponse", "stringresponse",
                 "schematicresponse"]


@F.pandas_udf(T.BooleanType())
def xml_well_formed(docs):
    """Arrow-batched per-row check that a document parses as XML (a small
    helper: Spark's XPath functions raise on malformed input)."""
    from xml.etree import ElementTree

    def ok(d):
        if d is None:
            return None
        try:
            ElementTree.fromstring(d)
            return True
        except ElementTree.ParseError:
            return False

    return docs.map(ok)


def _guarded(xml_rows: DataFrame) -> DataFrame:
    # the check becomes its own column first, so XPath only runs on parseable rows
    return xml_rows.withColumn("_xml_ok", xml_well_formed(F.col("xml")))


def bundle_problem_types(xml_rows: DataFrame) -> DataFrame:
    """First known response tag among the direct children of each problem's XML root.

    One XPath per row (``name(/*/*[self::a or self::b ...][1])``), evaluated in
    the JVM; a document that does not parse gets a NULL type instead of
    failing the job.
    """
    test = " or ".join(f"self::{t}" for t in PROBLEM_TYPES)
    itype = F.nullif(F.expr(f"xpath_string(xml, 'name(/*/*[{test}][1])')"), F.lit(""))
    return _guarded(xml_rows).select(C, "url_name", F.when(F.col("_xml_ok"), itype).alias("itype"))


def bundle_video_durations(xml_rows: DataFrame) -> DataFrame:
    """``duration`` attribute of the first ``video_asset`` child (NULL when
    missing, not a number, or the document does not parse -- such videos are
    skipped, as in the source)."""
    dur = F.expr("xpath_string(xml, '/*/video_asset[1]/@duration')").try_cast("double")
    return _guarded(xml_rows).select(C, "url_name", F.when(F.col("_xml_ok"), dur).alias("duration"))
