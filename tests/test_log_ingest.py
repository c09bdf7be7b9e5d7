"""Raw log lines -> records and dead letters."""

from mooclens.sources.logs import DEAD_NOT_JSON, DEAD_NOT_RECORD, ingest_lines


def test_dead_letters_and_records(spark):
    good = ('{"time": "2024-01-02T03:04:05+00:00", "username": "u1", "event_type": "problem_check", '
            '"event_source": "server", "event": {"attempts": 2, "success": "correct", "grade": 1}, '
            '"context": {"course_id": "course-v1:A+B+C", "user_id": "7"}}')
    lines = [good, "{'single': 'quoted'}", "plain text", "{}", '[{"a": 1}]', "prefix " + good,
             good[: len(good) // 2]]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(lines)], "seq long, value string")
    rows, dead = ingest_lines(df)
    reasons = sorted(r.reason for r in dead.collect())
    assert reasons == sorted([DEAD_NOT_JSON, DEAD_NOT_RECORD, DEAD_NOT_JSON, DEAD_NOT_JSON])
    out = rows.orderBy("seq").collect()
    # '{}' names no user, so it is dropped, not dead-lettered
    assert [r.seq for r in out] == [0, 5]
    r = out[0]
    assert r.course_id == "A/B/C" and r.context.user_id == 7
    assert r.event_struct.attempts == 2 and r.event_struct.grade == 1.0
    assert str(r.time) == "2024-01-02 03:04:05"


def test_unknown_event_keeps_get_post_only(spark):
    line = ('{"time": "2024-01-02T03:04:05Z", "username": "u", "event_type": "/courses/A/B/C/info", '
            '"event": {"GET": {"a": ["1"]}, "mode": "x"}}')
    rows, _ = ingest_lines(spark.createDataFrame([(1, line)], "seq long, value string"))
    r = rows.first()
    assert r.event_struct.GET == '{"a":["1"]}' and r.event_struct.POST == "null" and r.event_struct.mode is None


def test_file_dates(spark):
    from pyspark.sql import functions as F

    from mooclens.sources.logs import file_date
    names = ["prod-edx-2020-01-02.log.gz", "tracking.log-2024-12-31.gz", "x/2019-07-04/a.gz",
             "nodate.gz", "bad-2020-13-45.gz", "short-2020-1-2.gz", ""]
    df = spark.createDataFrame([(n,) for n in names], "f string")
    got = [r.d for r in df.select(file_date(F.col("f")).alias("d")).collect()]
    # only the base name counts (a dated folder does not date its files)
    assert [str(d) if d else None for d in got] == ["2020-01-02", "2024-12-31", None, None, None, None, None]


def _ingest_one(spark, rec):
    import json
    rec = {"time": "2024-05-01T00:00:00Z", "username": "someone", **rec}
    rows, dead = ingest_lines(spark.createDataFrame([(0, json.dumps(rec))], "seq long, value string"))
    return rows.first()


def test_module_ids_of_generated_spellings(spark):
    """Every spelling of a block id, in every field that may name it, gives exactly its id."""
    import json
    import random
    rng = random.Random(2)
    part = lambda: "".join(rng.choice("abcxyz059") for _ in range(rng.randint(2, 6)))
    spelt = [lambda o, n, r, k, b: (f"block-v1:{o}+{n}+{r}+type@{k}+block@{b}", f"{o}/{n}/{r}/{k}/{b}"),
             lambda o, n, r, k, b: (f"i4x://{o}/{n}/{k}/{b}", f"{o}/{n}/{k}/{b}")]
    placed = [lambda t: {"event": {"id": t}}, lambda t: {"event": {"problem_id": t}}, lambda t: {"event": json.dumps({"id": t})},
              lambda t: {"context": {"module": {"usage_key": t}}}]
    recs, want = [], []
    for spell in spelt:
        for place in placed:
            for kind in ("problem", "video", "sequential"):
                text, clean = spell(part(), part(), part(), kind, part())
                recs.append({"time": "2024-05-01T00:00:00Z", "username": "someone", "event": {}, "event_type": "", **place(text)})
                want.append(clean)
    rows, _ = ingest_lines(spark.createDataFrame([(i, json.dumps(r)) for i, r in enumerate(recs)], "seq long, value string"))
    got = {r.seq: r.module_id for r in rows.collect()}
    assert [got[i] for i in range(len(recs))] == want


def test_records_that_name_no_block_have_no_module_id(spark):
    for rec in ({"event": {"id": "plainword"}, "event_type": "page_close"}, {"event": {"currentTime": 3}, "event_type": "play_video"},
                {"event": "", "event_type": "hint"}, {"event": {"problem_id": None}, "event_type": ""}):
        assert _ingest_one(spark, rec).module_id is None, rec


def test_block_module_id_value(spark):
    r = _ingest_one(spark, {"event": {"id": "block-v1:Uni+Bio1+2025+type@video+block@v3"}, "event_type": ""})
    assert r.module_id == "Uni/Bio1/2025/video/v3"
    r = _ingest_one(spark, {"event": {}, "event_type": "/courses/Uni/Bio1/2025/courseware/ch1/seq2/",
                            "context": {"course_id": "course-v1:Uni+Bio1+2025"}})
    assert r.course_id == "Uni/Bio1/2025" and r.module_id == "Uni/Bio1/2025/courseware/ch1"


def test_dead_letters_for_missing_source_and_bad_time(spark):
    import json

    from mooclens.sources.logs import DEAD_BAD_TIME, DEAD_NO_SOURCE
    recs = [{"time": "2024-05-01T00:00:00Z", "username": "a", "event_type": "problem_check", "event": {}},
            {"time": "yesterday-ish", "username": "b", "event_type": "play_video", "event": {}},
            {"time": "2024-05-01T00:00:00Z", "username": "c", "event_type": "problem_check",
             "event_source": "server", "event": {}}]
    df = spark.createDataFrame([(i, json.dumps(r)) for i, r in enumerate(recs)], "seq long, value string")
    rows, dead = ingest_lines(df, dynamic_date=True)
    assert sorted(r.reason for r in dead.collect()) == sorted([DEAD_NO_SOURCE, DEAD_BAD_TIME])
    assert [r.username for r in rows.collect()] == ["c"]


def test_course_filter(spark, tables):
    raw = tables.raw_log_lines
    rows, _ = ingest_lines(raw, courses=["DemoX/C1/T1"])
    got = {r.course_id for r in rows.select("course_id").distinct().collect()}
    assert got == {"DemoX/C1/T1"}


def test_each_line_is_parsed_once(spark):
    """Filters on what was parsed do not parse again, and generated methods are small enough to be compiled."""
    import re

    from pyspark.sql import functions as F
    lines = spark.range(3).select(F.col("id").alias("seq"), F.concat(F.lit('{"time": "'), F.col("id").cast("string"), F.lit('"}')).alias("value"))
    rows, dead = ingest_lines(lines)
    rows = rows.select("seq", "course_id", "time", "module_id", "event", "event_struct.mode", "event_struct.GET")
    texts = [df._jdf.queryExecution().optimizedPlan().toString() for df in (rows, dead.groupBy("reason").count())]
    assert [t.count("parseJson(") for t in texts] == [2, 1]  # the line and its payload; the line
    assert texts[1].count("from_json(") == 1
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = rows.select("*")._jdf.queryExecution().executedPlan()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    code = spark._jvm.org.apache.spark.sql.execution.debug.package.codegenString(plan)
    # the JVM leaves larger methods to its interpreter
    assert 0 < max(map(int, re.findall(r"maxMethodCodeSize:(\d+)", code))) < 8000


def test_payloads_of_any_shape(spark):
    """An object's top-level values as texts; a name given twice makes the payload a plain text."""
    got = []
    for event in ('{"mode": {"a": [1, 2]}, "attempts": "3", "child-id": "k"}', ' [{"mode": "x"}]', '[{"mode": "x"}, 5]', "[]", "5", "null", '{"mode": "x", "mode": "y"}', "no json"):
        r = _ingest_one(spark, {"event": event, "event_type": "problem_graded", "event_source": "server"})
        got.append((r.event_struct.mode, r.event_struct.attempts, r.event_struct.child_id, r.event))
    assert [g[:3] for g in got] == [('{"a":[1,2]}', 3, "k"), *[(None, None, None)] * 7]
    assert got[6][3] == '{"event":"{\\"mode\\": \\"x\\", \\"mode\\": \\"y\\"}"}' and got[7][3] == '{"event":"no json"}'
