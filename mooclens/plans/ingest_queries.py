"""Round-trip queries of the ingest builders: input is written from the bridged tables in
the export's shape, and the builder must give the bridged table back (``oracles/ingest_sql.py``)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mooclens.session import scratch_path
from mooclens.sources.bridge import Tables
from mooclens.sources.dumps import dump_records
from mooclens.sources.geo import distinct_ips, geolocate_ips
from mooclens.sources.ingest import (ROLE_FLAGS, ROLE_NAMES, bundle_problem_types, bundle_video_durations, conform, course_axis_from_blocks, distinct_youtube_ids,
                                     email_opt_in, forum_from_mongo, grades_persistent, grades_persistent_subsection, grading_policy, problem_analysis, roles,
                                     studentmodule, user_dumps, user_info_combo, youtube_metadata)

C = "course_id"


def _course_v1(c="course_id") -> Column:
    return F.concat(F.lit("course-v1:"), F.regexp_replace(c, "/", "+"))


UIC_CONFORM_SCHEMA = T.StructType([
    T.StructField("course_id", T.StringType()), T.StructField("user_id", T.LongType()),
    T.StructField("username", T.StringType()), T.StructField("email", T.StringType()),
    T.StructField("enrollment_mode", T.StringType()), T.StructField("certificate_status", T.StringType()),
    T.StructField("profile_year_of_birth", T.LongType()), T.StructField("profile_gender", T.StringType()),
    T.StructField("enrollment_created", T.TimestampType()), T.StructField("enrollment_is_active", T.LongType()),
    T.StructField("y1_anomalous", T.LongType()), T.StructField("certificate_grade", T.DoubleType()),
])


def q_conform(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = Tables(spark, sf_dir).user_info_combo
    x = u.select("course_id", F.col("user_id").cast("string").alias("user_id"), "username", "email",
                 "enrollment_mode", "certificate_status",
                 F.when(F.col("user_id") % 13 == 0, F.lit("unknown"))
                  .otherwise(F.col("profile_year_of_birth").cast("string")).alias("profile_year_of_birth"),
                 F.concat(F.lit(" "), F.col("profile_gender")).alias("profile_gender"),
                 F.date_format("enrollment_created", "yyyy-MM-dd HH:mm:ss").alias("enrollment_created"),
                 F.col("enrollment_is_active").cast("string").alias("enrollment_is_active"), "y1_anomalous",
                 F.lit("dropped").alias("extra_field"))
    return conform(x, UIC_CONFORM_SCHEMA)


def q_user_info_combo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five user dumps are written as files, with older rows of some users before their last, and read back."""
    u = Tables(spark, sf_dir).user_info_combo
    uid, base = F.col("user_id"), scratch_path(spark, "user-dumps")
    stamp = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    new = F.lit(1)

    def write(name, df, columns, order=new):
        _write_dump(spark, df, columns, name, base, "none", order)

    write("auth_user-analytics.sql", u.where(uid % 11 != 5), {"id": uid, "username": F.col("username"), "email": F.col("email"), "is_staff": F.lit(0)})
    write("auth_userprofile-analytics.sql", u.where(uid % 7 != 3), {
        "user_id": uid, "gender": F.col("profile_gender"), "year_of_birth": F.col("profile_year_of_birth"), "level_of_education": F.col("profile_level_of_education"),
        "country": F.col("profile_country"), "goals": F.when(uid % 2 == 0, F.lit("it's \"all")).otherwise(F.lit(" null "))})
    stale = u.where(uid % 17 == 0).withColumn("enrollment_mode", F.lit("stale")).withColumn("old", F.lit(0))
    write("student_courseenrollment-analytics.sql", u.withColumn("old", new).unionByName(stale), {
        "course_id": _course_v1(), "user_id": uid, "created": stamp("enrollment_created"), "is_active": F.col("enrollment_is_active"), "mode": F.col("enrollment_mode")}, F.col("old"))
    write("certificates_generatedcertificate-analytics.sql", u.where(F.col("certificate_status").isNotNull()), {
        "user_id": uid, "course_id": _course_v1(), "grade": F.when(uid % 3 == 0, F.lit("n/a")).otherwise(F.lit("0.8")), "status": F.col("certificate_status"),
        "created_date": stamp("certificate_created_date")})
    write("user_id_map-analytics.sql", u.where(uid % 5 != 0), {"hash_id": F.concat(F.lit("h"), uid.cast("string")), "id": uid})
    out = user_info_combo(**user_dumps(spark, base))
    return out.select("course_id", "user_id", "username", "email", "is_staff", "profile_gender", F.col("profile_year_of_birth").try_cast("bigint").alias("profile_year_of_birth"),
                      "profile_level_of_education", "profile_country", "profile_goals", F.col("enrollment_created").try_cast("timestamp").alias("enrollment_created"),
                      F.col("enrollment_is_active").try_cast("bigint").alias("enrollment_is_active"), "enrollment_mode", "certificate_status", "certificate_grade",
                      F.col("certificate_created_date").try_cast("timestamp").alias("certificate_created_date"), "id_map_hash_id")


DUMP_ROWS = 20_000  # rows of a dump file


def _quoted(text: Column, quote: str = "'") -> Column:
    """A field as a dump writes it: in quotes if it begins with one or holds a tab or a line break."""
    return F.when(text.rlike(f"^{quote}|[\\t\\n]"), F.concat(F.lit(quote), F.replace(text, F.lit(quote), F.lit(quote * 2)), F.lit(quote))).otherwise(text)


def _write_dump(spark: SparkSession, df: DataFrame, columns: dict[str, Column], name: str, base: str, compression: str = "gzip", order: Column | None = None) -> str:
    """Write a table as header-led dump files below a folder per course, a file for about ``DUMP_ROWS`` rows of
    a course; rows of one user stand in one file, by ``order``."""
    slices = 1 + df.count() // (3 * DUMP_ROWS)
    place = [F.regexp_replace(C, "/", "__").alias("course"), F.lit(name).alias("dump"), F.pmod(F.xxhash64("user_id"), F.lit(slices)).alias("slice")]
    data = df.select(*place, (order if order is not None else F.lit(0)).cast("long").alias("o"), F.concat_ws("\t", *[
        _quoted(F.coalesce(c.cast("string"), F.lit("NULL"))) for c in columns.values()]).alias("value"))
    head = data.select("course", "dump", "slice").distinct().withColumn("o", F.lit(-1).cast("long")).withColumn("value", F.lit("\t".join(columns)))
    (data.unionByName(head).repartition("course", "slice").sortWithinPartitions("course", "dump", "slice", "o").drop("o")
     .write.mode("append").partitionBy("course", "dump", "slice").option("compression", compression).text(base))
    return f"{base}/*/dump={name}/*/*"


def _dump(spark: SparkSession, df: DataFrame, columns: dict[str, Column], **options) -> DataFrame:
    """Records of a table that was written as dump files."""
    path = _write_dump(spark, df, columns, "table.sql", scratch_path(spark, "dump-files"), **options)
    return dump_records(spark, path + (".gz" if options.get("compression", "gzip") == "gzip" else ".txt"), split_bytes=64 << 10)


_SECOND = "yyyy-MM-dd HH:mm:ss"


def q_grades_dump(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = Tables(spark, sf_dir).grades_persistent
    day = F.date_format(F.timestamp_seconds(F.lit(1704067200) + F.col("user_id") % 1000 * 60), _SECOND)
    records = _dump(spark, g, {
        "course_id": _course_v1(), "user_id": F.col("user_id"), "grading_policy_hash": F.md5(F.col("course_id")), "percent_grade": F.col("percent_grade"),
        "letter_grade": F.when(F.col("letter_grade") != "", F.col("letter_grade")), "passed_timestamp": F.when(F.col("letter_grade") != "", day),
        "created": day, "modified": day})
    return grades_persistent(records)


def q_grades_subsection(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = Tables(spark, sf_dir).grades_persistent
    records = _dump(spark, g, {
        "user_id": F.col("user_id"), "course_id": _course_v1(), "usage_key": F.concat(F.lit("block-v1:x+type@sequential+block@s"), F.col("user_id") % 7),
        "possible_all": F.lit("10.0"), "earned_all": F.col("percent_grade") * 10, "first_attempted": F.when(F.col("user_id") % 4 == 0, "2024-02-01 10:00:00"),
        "created": F.lit("2024-02-01 10:00:00")})
    return grades_persistent_subsection(records)


def q_studentmodule_dump(spark: SparkSession, sf_dir: str) -> DataFrame:
    sm = Tables(spark, sf_dir).studentmodule
    parts = F.split("module_id", "/")
    block = F.concat(F.lit("block-v1:"), parts.getItem(0), F.lit("+"), parts.getItem(1), F.lit("+"), parts.getItem(2),
                     F.lit("+type@"), parts.getItem(3), F.lit("+block@"), parts.getItem(4))
    # a NUL byte, a state of several lines with tabs and quotes, a plain one
    state = (F.when(F.col("student_id") % 9 == 0, F.lit('{"attempts": \u00001}')).when(F.col("student_id") % 4 == 1, F.lit('{"note":\t"it\'s",\n\'attempts\': 1}'))
             .otherwise(F.lit('{"attempts": 1}')))
    stamp = F.date_format("created", _SECOND)
    records = _dump(spark, sm.withColumn("user_id", F.col("student_id")), {
        "id": F.col("student_id") + 7, "module_type": F.col("module_type"), "module_id": block, "student_id": F.col("student_id"), "state": state,
        "grade": F.when(F.col("student_id") % 5 == 0, F.lit("null")).otherwise(F.col("grade")), "created": stamp, "modified": stamp,
        "max_grade": F.col("max_grade"), "done": F.lit("na"), "course_id": _course_v1()}, compression="none")
    return studentmodule(records)


def q_problem_analysis(spark: SparkSession, sf_dir: str) -> DataFrame:
    pa = Tables(spark, sf_dir).problem_analysis
    cmap = F.map_from_entries(F.transform("item", lambda i: F.struct(
        i["answer_id"], F.struct(F.when(i["correct_bool"], "correct").otherwise("incorrect").alias("correctness"),
                                 F.lit(None).cast("double").alias("npoints"), F.lit("").alias("msg"),
                                 F.lit("").alias("hint")))))
    # learners by id: no answers at all, a list, a text with an escaped quote (doubled in dumps), a text
    u = F.col("user_id")
    answer = (F.when(u % 4 == 3, F.lit('["choice_0","choice_2"]')).when(u % 4 == 2, F.lit('"say \\\\"hi\\\\""'))
              .otherwise(F.concat(F.lit('"choice_'), (u % 4).cast("string"), F.lit('"'))))
    answers = F.when(u % 10 == 0, F.lit("{}")).otherwise(F.concat(F.lit("{"), F.array_join(F.transform(
        "item", lambda i: F.concat(F.lit('"'), i["answer_id"], F.lit('":'), answer)), ","), F.lit("}")))
    state = F.concat(F.lit('{"correct_map":'), F.to_json(cmap), F.lit(',"student_answers":'), answers, F.lit(',"attempts":'),
                     F.col("attempts").cast("string"), F.lit(',"done":'), F.coalesce(F.col("done").cast("string"), F.lit("null")), F.lit("}"))
    sm = pa.select("course_id", F.concat("course_id", F.lit("/problem/"), "problem_url_name").alias("module_id"), u.alias("student_id"),
                   F.when(u % 13 == 0, F.lit('{"correct_map":{},"attempts":1}')).otherwise(state).alias("state"),
                   F.col("grade").cast("string").alias("grade"), F.lit("50").alias("max_grade"), "created")
    out = problem_analysis(sm)
    return out.select("course_id", "user_id", "problem_url_name", "attempts", "grade", "max_grade",
                      F.explode("item").alias("i")).select(
        "course_id", "user_id", "problem_url_name", "attempts", "grade", "max_grade",
        F.col("i.answer_id").alias("answer_id"), F.col("i.response").alias("response"),
        F.col("i.correctness").alias("correctness"), F.col("i.correct_bool").alias("correct_bool"))


def q_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = Tables(spark, sf_dir).roles
    first_name = {}
    for n, f in ROLE_NAMES.items():
        first_name.setdefault(f, n)
    access = [F.when(F.col(f) == 1, F.lit(first_name[f])) for f in ROLE_FLAGS if f.startswith("roles_")]
    forum = [F.when(F.col(f) == 1, F.lit(first_name[f])) for f in ROLE_FLAGS if f.startswith("forumRoles_")]

    def rows(names):
        return (r.select(_course_v1().alias("course_id"), "user_id", F.explode(F.array(*names)).alias("role"))
                .where(F.col("role").isNotNull()))

    return roles(rows(access), rows(forum))


def q_email_opt_in(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = Tables(spark, sf_dir).user_info_combo
    rows = u.select(F.col("user_id").cast("string").alias("user_id"), "username", "email",
                    _course_v1().alias("course_id"),
                    F.when(F.col("user_id") % 3 == 0, "True").otherwise("False").alias("is_opted_in_for_email"),
                    F.concat(F.date_format("enrollment_created", "yyyy-MM-dd HH:mm:ss"), F.lit("+00:00"))
                    .alias("preference_set_datetime"))
    return email_opt_in(rows)


def _ip_ranges(spark, sf_dir) -> DataFrame:
    t = Tables(spark, sf_dir)
    nation = t.spark.read.parquet(f"{sf_dir}/nation.parquet").where(F.col("n_nationkey") < 6)
    a = F.col("n_nationkey").cast("string")
    half = F.explode(F.array(F.struct(F.lit(0).alias("lo"), F.lit(1).alias("hi"), F.lit("low").alias("part")),
                             F.struct(F.lit(2).alias("lo"), F.lit(3).alias("hi"), F.lit("high").alias("part"))))
    x = nation.select("n_nationkey", "n_name", half.alias("h"))
    return x.select(
        F.concat(F.lit("10."), a, F.lit(".0."), F.col("h.lo").cast("string")).alias("start_ip"),
        F.concat(F.lit("10."), a, F.lit(".0."), F.col("h.hi").cast("string")).alias("end_ip"),
        F.concat(F.lit("C"), a).alias("country_iso"), F.col("n_name").alias("country_name"),
        F.when(F.col("n_nationkey") % 3 == 0, "Europe").when(F.col("n_nationkey") % 3 == 1, "Asia")
         .otherwise("Americas").alias("continent"),
        F.concat(F.lit("city"), a, F.lit("_"), F.col("h.part")).alias("city"),
        F.concat(F.lit("r"), a).alias("subdivision_iso"), F.lit(None).cast("string").alias("subdivision"),
        F.concat(F.lit("P"), a).alias("postal_code"),
        (F.col("n_nationkey") * 10.0).alias("latitude"), (-F.col("n_nationkey").cast("double")).alias("longitude"))


def _more_ranges(spark, sf_dir) -> DataFrame:
    """Ranges that grow with the customers: nested, overlapping, touching and equal ones of both families, some without a country."""
    key = F.col("c_custkey")
    c = spark.read.parquet(f"{sf_dir}/customer.parquet").select("c_custkey")
    base, size = (key * 7919) % 16777216, F.expr("shiftleft(1L, cast((c_custkey % 5 + 1) * 4 as int))")
    lo = F.when(key % 2 == 0, base - base % size).otherwise(base)
    dotted = lambda n: F.concat_ws(".", F.lit("10"), F.shiftright(n, 16), F.shiftright(n, 8) % 256, n % 256)
    iso = F.when(key % 13 != 0, F.concat(F.lit("C"), key % 25))
    city = F.concat(F.lit("cust"), key)
    v4 = c.select(dotted(lo).alias("start_ip"), dotted(F.least(lo + size - 1, F.lit(16777215).cast("bigint"))).alias("end_ip"), iso.alias("iso"), city.alias("city"),
                  (key % 10 == 0).alias("again"))
    equal = v4.where("again").withColumn("iso", F.lit("A")).withColumn("city", F.concat(F.lit("equal "), "city"))
    h3, h4 = (F.lower(F.hex(n)) for n in (key * 7 % 65536, key % 65536))
    net = F.concat(F.lit("2001:db8:"), h3, F.lit(":"))
    wide = c.where(key % 3 == 0).select(F.concat(net, F.lit(":")).alias("start_ip"), F.concat(net, F.lit("ffff:ffff:ffff:ffff:ffff")).alias("end_ip"), iso.alias("iso"),
                                        F.concat(F.lit("wide "), key).alias("city"), F.lit(False).alias("again"))
    narrow = c.where(key % 6 == 0).select(F.concat(net, h4, F.lit("::")).alias("start_ip"), F.concat(net, h4, F.lit(":ffff:ffff:ffff:ffff")).alias("end_ip"), iso.alias("iso"),
                                          F.concat(F.lit("narrow "), key).alias("city"), F.lit(False).alias("again"))
    root = spark.createDataFrame([("10.0.0.0", "10.255.255.255", "C1", "anywhere", False)], v4.schema)
    x = v4.unionByName(equal).unionByName(wide).unionByName(narrow).unionByName(root)
    null = F.lit(None).cast("string")
    return x.select("start_ip", "end_ip", F.col("iso").alias("country_iso"), F.concat(F.lit("name "), "iso").alias("country_name"), F.lit("Earth").alias("continent"), "city",
                    null.alias("subdivision_iso"), null.alias("subdivision"), null.alias("postal_code"), F.lit(1.0).alias("latitude"), F.lit(2.0).alias("longitude"))


def _more_ips(spark, sf_dir) -> DataFrame:
    """Addresses that grow with the orders (IPv4) and customers (IPv6), some of them twice."""
    n = (F.col("o_orderkey") * 48271) % 16777216
    v4 = spark.read.parquet(f"{sf_dir}/orders.parquet").select(F.concat_ws(".", F.lit("10"), F.shiftright(n, 16), F.shiftright(n, 8) % 256, n % 256).alias("ip"))
    key = F.col("c_custkey")
    v6 = spark.read.parquet(f"{sf_dir}/customer.parquet").select(
        F.concat(F.lit("2001:db8:"), F.lower(F.hex(key * 7 % 65536)), F.lit(":"), F.lower(F.hex(key % 65536)), F.lit("::1")).alias("ip"))
    return v4.unionByName(v6).unionByName(v6)


def _un_regions(spark, sf_dir) -> DataFrame:
    nation = spark.read.parquet(f"{sf_dir}/nation.parquet")
    region = spark.read.parquet(f"{sf_dir}/region.parquet")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.concat(F.lit("C"), F.col("n_nationkey").cast("string")).alias("iso"),
        F.col("r_name").alias("un_major_region"),
        F.when(F.col("n_nationkey") % 3 == 0, "High").otherwise("Middle").alias("un_economic_group"))


def q_geolocate(spark: SparkSession, sf_dir: str) -> DataFrame:
    ips = distinct_ips(Tables(spark, sf_dir).tracking_log).unionByName(_more_ips(spark, sf_dir))
    ranges = _ip_ranges(spark, sf_dir).unionByName(_more_ranges(spark, sf_dir))
    return geolocate_ips(ips, ranges, _un_regions(spark, sf_dir), at=dt.datetime(2024, 5, 6, 7, 8, 9, tzinfo=dt.timezone.utc))


def q_youtube_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distinct_youtube_ids(Tables(spark, sf_dir).course_axis)


def q_youtube_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    y = Tables(spark, sf_dir).youtube
    n = F.substring("id", 3, 20).try_cast("bigint")
    d = F.col("duration")
    iso = F.concat(F.when(n % 5 == 0, F.lit("P1D")).otherwise(F.lit("P")), F.lit("T"),
                   (d / 60).cast("bigint").cast("string"), F.lit("M"), (d % 60).cast("string"), F.lit("S"))
    item = F.to_json(F.struct(
        "id", F.struct(F.col("title").alias("title"), F.lit("").alias("description"),
                       F.concat(F.lit("UC"), (n % 7).cast("string")).alias("channelId"),
                       F.lit("channel").alias("channelTitle"), F.lit("2023-05-01T00:00:00Z").alias("publishedAt"))
        .alias("snippet"), F.struct(iso.alias("duration")).alias("contentDetails")))
    return youtube_metadata(y.select(item.alias("value"))).select("id", "title", "channel_id", "published_at",
                                                                  "duration")


def course_blocks(course_axis: DataFrame) -> DataFrame:
    """Export-shaped blocks of the bridged course structure (children in order)."""
    kids = (course_axis.where(F.col("parent").isNotNull())
            .groupBy("course_id", F.col("parent").alias("url_name"))
            .agg(F.array_sort(F.collect_list(F.struct("index", "module_id"))).alias("_k"))
            .select("course_id", "url_name", F.transform("_k", lambda k: k["module_id"]).alias("children")))
    cat = F.col("category")
    seq = cat == "sequential"
    ts = "yyyy-MM-dd'T'HH:mm:ss"
    # metadata only where an author would set it: format / due / graded on the
    # sequential (its blocks inherit them), dates of the course on the root
    meta = F.struct(
        F.col("name").alias("display_name"),
        F.when(seq, F.col("gformat")).alias("format"),
        F.when(seq, F.date_format("due", ts)).alias("due"),
        F.when(cat == "course", F.lit("2024-01-01T00:00:00")).alias("start"),
        F.when(cat == "course", F.lit("2024-03-01T00:00:00")).alias("end"),
        F.when(seq, F.col("gformat").isNotNull()).alias("graded"),
        F.when(F.col("visible_to_staff_only"), F.lit(True)).alias("visible_to_staff_only"),
        F.col("data.weight").alias("weight"), F.lit(None).cast("string").alias("showanswer"),
        F.when(F.col("data.ytid") == "", "").alias("youtube_id_0_75"), F.element_at(F.split("data.ytid", ":"), -1).alias("youtube_id_1_0"))
    return (course_axis.join(kids, ["course_id", "url_name"], "left")
            .select("course_id", F.col("module_id").alias("block_id"), "url_name", "category",
                    F.coalesce("children", F.array().cast("array<string>")).alias("children"), meta.alias("meta")))


def q_course_axis(spark: SparkSession, sf_dir: str) -> DataFrame:
    blocks = course_blocks(Tables(spark, sf_dir).course_axis)
    walked = course_axis_from_blocks(blocks, itypes=q_problem_types(spark, sf_dir),
                                     durations=q_video_durations(spark, sf_dir))
    return walked.select(
        "course_id", "index", "module_id", "url_name", "category", "name", "gformat", "due", "start", "graded",
        "visible_to_staff_only", "path", "parent", "chapter_mid", F.col("data.ytid").alias("ytid"), F.col("data.num_items").alias("num_items"),
        F.col("data.has_solution").alias("has_solution"), F.col("data.weight").alias("weight"),
        F.col("data.itype").alias("itype"), F.col("data.duration").alias("duration"))


def q_problem_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    ax = Tables(spark, sf_dir).course_axis.where(F.col("category") == "problem")
    it = F.col("data.itype")
    xml = F.concat(F.lit('<problem display_name="'), F.col("name"), F.lit('"><p>Question</p>'),
                   F.when(it.isNotNull(), F.concat(F.lit("<"), it, F.lit("><choicegroup/></"), it, F.lit(">")))
                    .otherwise(F.lit("<solution><p>none</p></solution>")), F.lit("</problem>"))
    return bundle_problem_types(ax.select("course_id", "url_name", xml.alias("xml")))


def q_video_durations(spark: SparkSession, sf_dir: str) -> DataFrame:
    ax = Tables(spark, sf_dir).course_axis.where(F.col("category") == "video")
    xml = F.concat(F.lit('<video url_name="'), F.col("url_name"), F.lit('"><source src="x"/><video_asset duration="'),
                   F.col("data.duration").cast("string"), F.lit('"/></video>'))
    return bundle_video_durations(ax.select("course_id", "url_name", xml.alias("xml")))


def q_forum_mongo(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = Tables(spark, sf_dir).forum
    _author = F.col("author_id").cast("string")

    def oid(c):
        return F.when(F.col(c).isNotNull(), F.struct(F.col(c).alias("$oid")))

    doc = F.to_json(F.struct(F.struct(F.col("mongoid").alias("$oid")).alias("_id"), "_type",
                             _course_v1().alias("course_id"), F.col("author_id").cast("string").alias("author_id"),
                             "author_username", "title", "body", oid("comment_thread_id").alias("comment_thread_id"),
                             oid("parent_id").alias("parent_id"),
                             F.struct(F.date_format("created_at", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("$date"))
                             .alias("created_at"), "pinned", "endorsed", "votes",
                             F.struct(F.date_format("created_at", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("$date")).alias("updated_at"),
                             F.when(F.col("parent_id").isNotNull(), F.array(F.struct(F.col("parent_id").alias("$oid")))).alias("parent_ids"),
                             F.array(_author).alias("abuse_flaggers"), F.lit("NULL").alias("sk"),
                             F.struct(_author.alias("user_id"), F.struct(F.lit("2024-03-04T05:06:07Z").alias("$date")).alias("time"))
                             .alias("endorsement")))
    out = forum_from_mongo(f.select(doc.alias("value")))
    return out.select("course_id", "mongoid", "_type", "author_id", "author_username", "title", "body",
                      "comment_thread_id", "parent_id", "created_at", "pinned", "endorsed",
                      F.col("votes.count").alias("votes_count"), "updated_at", "parent_ids", "abuse_flaggers", "sk",
                      F.col("endorsement.user_id").alias("endorser"), F.col("endorsement.time").alias("endorsed_at"))


QUERIES = {
    "conform_user_info": q_conform,
    "ingest_user_info_combo": q_user_info_combo,
    "ingest_grades_persistent": q_grades_dump,
    "ingest_grades_subsection": q_grades_subsection,
    "ingest_studentmodule": q_studentmodule_dump,
    "ingest_problem_analysis": q_problem_analysis,
    "ingest_roles": q_roles,
    "ingest_email_opt_in": q_email_opt_in,
    "geolocate_ips": q_geolocate,
    "distinct_youtube_ids": q_youtube_ids,
    "youtube_metadata": q_youtube_metadata,
    "course_axis_walk": q_course_axis,
    "bundle_problem_types": q_problem_types,
    "bundle_video_durations": q_video_durations,
    "ingest_forum_mongo": q_forum_mongo,
}


def q_grading_policy(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = Tables(spark, sf_dir).grading_policy
    docs = g.groupBy("course_id").agg(
        F.to_json(F.struct(
            F.collect_list(F.struct(F.col("assignment_type").alias("type"), "short_label",
                                    F.col("fraction_of_overall_grade").alias("weight"), "min_count", "drop_count"))
            .alias("GRADER"),
            F.map_from_arrays(F.array(F.first("overall_cutoff_lower_label"), F.first("overall_cutoff_upper_label")),
                              F.array(F.first("overall_lower_cutoff"), F.first("overall_upper_cutoff")))
            .alias("GRADE_CUTOFFS"))).alias("policy"))
    return grading_policy(docs)


QUERIES["ingest_grading_policy"] = q_grading_policy
