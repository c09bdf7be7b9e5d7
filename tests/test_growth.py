"""Work that must grow with the input: tasks, splits, shared intermediates, joins."""

import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from mooclens.operators import grades, items
from mooclens.plans import reports
from mooclens.sources import bridge, dumps, ingest


def test_log_tasks_grow_with_events(spark, tmp_path, monkeypatch):
    t0 = dt.datetime(2024, 1, 1, 23, 0)
    rows = [(i, i % 5, t0 + dt.timedelta(seconds=i)) for i in range(2000)]
    spark.createDataFrame(rows, "event_id bigint, user_id bigint, ts timestamp").coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    monkeypatch.setattr(bridge, "EVENTS_PER_TASK", 50)
    log = bridge.tracking_log(spark, str(tmp_path))
    sizes = log.groupBy(F.spark_partition_id().alias("task"), "course_id").count().collect()
    assert sum(r["count"] for r in sizes) == 8 * 2000
    # one course in one hour is spread over tasks
    assert max(r["count"] for r in sizes) < 8 * 2000 / 3 / 4


def test_log_rows_are_made_by_compiled_code(spark, tmp_path):
    import re
    rows = [(i, i % 5, dt.datetime(2024, 1, 1, 23, 0)) for i in range(9)]
    spark.createDataFrame(rows, "event_id bigint, user_id bigint, ts timestamp").write.parquet(f"{tmp_path}/events.parquet")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = bridge.tracking_log(spark, str(tmp_path))._jdf.queryExecution().executedPlan()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    code = spark._jvm.org.apache.spark.sql.execution.debug.package.codegenString(plan)
    # the JVM leaves larger methods to its interpreter
    assert 0 < max(map(int, re.findall(r"maxMethodCodeSize:(\d+)", code))) < 8000


def test_shared_reports_of_several_targets():
    assert reports.shared_reports("person_problem", "course_problem") == {"course_item", "person_item"}
    assert reports.shared_reports("person_problem") == {"course_item"}
    minimal = reports.shared_reports(*reports.CATALOG["person_course"].inputs)
    assert {"person_item", "course_item"} <= minimal


def test_number_of_splits_is_bounded(spark, tmp_path, monkeypatch):
    folder = tmp_path / "dump"
    folder.mkdir()
    lines = ["id\tstate", *[f"{i}\t'a\n\tb{i}'" for i in range(500)]]
    (folder / "one.txt").write_text("\n".join(lines) + "\n")
    monkeypatch.setattr(dumps, "MAX_SPLITS", 4)
    got = dumps.dump_records(spark, f"{folder}/*.txt", split_bytes=64).select("at.block", F.col("r")["id"].alias("id"), F.col("r")["state"].alias("state")).collect()
    assert sorted((int(r["id"]), r["state"]) for r in got) == [(i, f"a\n\tb{i}") for i in range(500)]
    assert 1 < len({r["block"] for r in got}) <= 5


def test_learner_inputs_are_not_broadcast(spark):
    uic = spark.createDataFrame([("c", "u1", 1)], "course_id string, username string, user_id bigint")
    shown = spark.createDataFrame([("c", "u1", "m")], "course_id string, username string, module_id string")
    pg = spark.createDataFrame([("c", 1, "m", 1.0, True, True)], "course_id string, user_id bigint, module_id string, grade double, attempted boolean, perfect boolean")
    out = grades.show_answer_stats_by_user(pg, shown, uic)
    assert out.collect()[0]["n_show_answer_attempted"] == 1
    assert "Broadcast" not in out._jdf.queryExecution().executedPlan().toString()


def test_state_texts_are_built_and_parsed_once(spark):
    rows = [("c", 1, "c/problem/p", '"correct_map":{"a":{"correctness":"correct"},"b":null},"student_answers":{"a":["x"]},"attempts":2', "1"),
            ("c", 2, "c/problem/p", '"correct_map":null,"student_answers":null', "1"), ("c", 3, "c/problem/p", '"correct_map":{}', "1"),
            ("c", 4, "c/problem/p", '"student_answers":{}', "1"), ("c", 5, "c/problem/p", '"correct_map":{},"student_answers":{},', "1"), ("c", 6, "c/problem/p", None, "1")]
    sm = spark.createDataFrame(rows, "course_id string, student_id bigint, module_id string, state string, grade string")
    sm = sm.withColumn("state", F.concat(F.lit("{"), F.col("state"), F.lit("}"))).withColumns({"max_grade": F.lit("2"), "created": F.lit(None).cast("timestamp")})
    out = ingest.problem_analysis(sm)
    got = {r["user_id"]: r for r in out.collect()}
    assert sorted(got) == [1, 2]
    assert [(i["answer_id"], i["response"], i["correct_bool"]) for i in got[1]["item"]] == [("a", '["x"]', True), ("b", "null", False)]
    assert (got[1]["attempts"], got[2]["attempts"], got[2]["item"]) == (2, 0, [])
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert (plan.count("parseJson"), plan.count("jsonObjectKeys"), plan.count("from_json")) == (1, 0, 1)


def test_items_are_numbered_by_stretches(spark):
    rows = [("c" + str(i % 2), None if i < 2 else i // 4, i % 4, None if i < 12 else float(i % 5)) for i in range(60)]
    df = spark.createDataFrame(rows, "course_id string, content_index bigint, item_number bigint, item_weight double")
    w = Window.partitionBy("course_id").orderBy("content_index", "item_number")
    want = df.select("*", F.row_number().over(w).cast("bigint").alias("item_nid"), F.sum("item_weight").over(w).alias("cumulative_item_weight"))
    got = items.numbered_in_course(df, 3)
    assert got.dtypes == want.dtypes
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_course_problem_groups_by_numbers(spark):
    ci = spark.createDataFrame([("c", 1, "p1", "s1", "n", False, None, 1, 1.0), ("c", 1, "p1", "s1", "n", False, None, 2, 1.0), ("c", None, "p2", None, "m", False, None, 3, 1.0),
                                ("c", None, "p3", None, "m", False, None, 4, 1.0)],
                               "course_id string, problem_nid bigint, problem_id string, problem_short_id string, problem_name string, is_split boolean, split_name string, "
                               "item_nid bigint, item_points_possible double")
    pi = spark.createDataFrame([(u, "c", i, i % 2) for u in (7, 8) for i in (1, 2, 3, 4)], "user_id bigint, course_id string, item_nid bigint, item_grade bigint")
    out = items.course_problem(pi, ci)
    assert sorted((r["problem_id"], r["avg_problem_raw_score"], r["max_possible_raw_score"], r["n_unique_users_attempted"]) for r in out.collect()) == [
        ("p1", 1.0, 2.0, 2), ("p2", 1.0, 1.0, 2), ("p3", 0.0, 1.0, 2)]
    # no aggregate has both a learner and a problem's names as keys; the learners' rows are not sorted for the join
    import re
    groups = re.findall(r"Aggregate \[(.*?)\]", out._jdf.queryExecution().optimizedPlan().toString())
    assert not any("user_id" in g and "problem_name" in g for g in groups)
    assert "ShuffledHashJoin" in out._jdf.queryExecution().executedPlan().toString()


def test_shuffles_of_stored_tables_go(spark, tmp_path):
    import pathlib
    import time

    from mooclens.session import SHUFFLE_CLEANUP, stored_scratch
    folders = [pathlib.Path(d.getPath()) for d in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]
    files = lambda: {f for d in folders for f in d.rglob("shuffle_*.data")}
    old, kept = files(), spark.conf.get(SHUFFLE_CLEANUP)
    stored = stored_scratch(spark, spark.range(10_000).repartition(3, "id"), "rows")
    for _ in range(50):
        if not files() - old:
            break
        time.sleep(0.2)
    assert not files() - old and stored.count() == 10_000 and spark.conf.get(SHUFFLE_CLEANUP) == kept


def test_learners_answers_are_dealt_by_item_once(spark):
    pa = spark.createDataFrame([("c", 1, 2.0, 1, dt.datetime(2024, 1, d), [("i1", True), ("i2", None)]) for d in (1, 2)] + [("c", 2, None, 1, None, [("i1", False)])],
                               "course_id string, user_id bigint, grade double, attempts bigint, created timestamp, item array<struct<answer_id string, correct_bool boolean>>")
    ci = spark.createDataFrame([("c", "i1", "s1", 1), ("c", "i2", "s2", 2)], "course_id string, item_id string, item_short_id string, item_nid bigint")
    out = items.person_item(pa, ci)
    assert sorted((r["user_id"], r["item_nid"], r["item_grade"], r["date"] and r["date"].day) for r in out.collect()) == [(1, 1, 1, 2), (1, 2, 0, 2), (2, 1, 0, None)]
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = out.select("*")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert plan.count("Exchange hashpartitioning") == 2  # the answers and the items


def test_tables_smaller_than_their_shuffles_are_stored(spark, tables):
    out = reports.resolve("person_course_day", tables)
    read = " ".join(out.inputFiles())
    assert "/person_problem-" in read and "/course_problem-" in read and "/events-of-day-" in read
    assert "/person_problem-" not in " ".join(reports.resolve("person_problem", tables).inputFiles())


def test_activity_of_quiet_learners_is_not_stored(spark, tables):
    out = reports.resolve("learner_activity", tables)
    assert "/window-" not in " ".join(out.inputFiles()) and out.count() > 0
