"""Course / module id extraction (behaviours of the source's id tests, re-expressed)."""

from pyspark.sql import functions as F

from mooclens.functions import ids


def _one(spark, expr, value):
    return spark.range(1).select(expr(F.lit(value)).alias("x")).first().x


def test_block_to_course_and_module(spark):
    block = "block-v1:Uni+Phys1+2T2024+type@problem+block@abc123"
    assert _one(spark, ids.course_from_block, block) == "Uni/Phys1/2T2024"
    assert _one(spark, ids.module_from_block, block) == "Uni/Phys1/2T2024/problem/abc123"
    assert _one(spark, ids.course_from_block, "i4x://Uni/Phys1/course/2T2024") == "Uni/Phys1/2T2024"


def test_clean_course_id(spark):
    assert _one(spark, ids.clean_course_id, "course-v1:Org+Cs1+X") == "Org/Cs1/X"


def test_course_id_from_text(spark):
    cases = {
        "/courses/course-v1:ORG+NUM+TERM/courseware/abc": "ORG/NUM/TERM",
        "/courses/ORG/NUM/TERM/discussion/threads/t1": "ORG/NUM/TERM",
        "ORG/NUM/TERM": "ORG/NUM/TERM",
    }
    for text, want in cases.items():
        assert _one(spark, ids.course_id_from_text, text) == want


def test_module_id_from_text(spark):
    cases = {
        "i4x://ORG/NUM/problem/p1": "ORG/NUM/problem/p1",
        "block-v1:ORG+NUM+TERM+type@video+block@v9": "ORG/NUM/TERM/video/v9",
        "https://x.org/courses/course-v1:ORG+NUM+TERM/xblock/block-v1:ORG+NUM+TERM+type@html+block@h1/handler":
            "ORG/NUM/TERM/html/h1",
    }
    for text, want in cases.items():
        assert _one(spark, ids.module_id_from_text, text) == want


def test_record_ids(spark):
    rows = [
        ("/courses/course-v1:A+B+C/courseware", "play_video", None, None),
        (None, "/courses/A/B/C/discussion/threads/t1/reply", None, None),
        (None, "problem_check", "A/B/C", "i4x://A/B/C/problem/p1"),
        (None, "seq_goto", None, None),
    ]
    df = spark.createDataFrame(rows, "page string, event_type string, ctx_course string, usage string")
    rec = F.struct(F.lit(None).cast("string").alias("course_id"),
                   F.struct(F.col("ctx_course").alias("course_id"), F.lit(None).cast("string").alias("path"),
                            F.struct(F.col("usage").alias("usage_key")).alias("module")).alias("context"),
                   F.col("page"), F.col("event_type"), F.lit(None).cast("string").alias("name"),
                   F.struct(F.lit(None).cast("string").alias("event_type"), F.lit(None).cast("string").alias("id"),
                            F.lit(None).cast("string").alias("problem_id")).alias("event_obj"))
    out = df.select(ids.log_course_id(rec).alias("c"), ids.log_module_id(rec).alias("m")).collect()
    assert [r.c for r in out] == ["A/B/C", "A/B/C", "A/B/C", None]
    assert out[2].m == "A/B/C/problem/p1"
    assert out[3].m is None
