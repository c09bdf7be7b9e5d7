"""Table upkeep: merge, JSON load with a bad-row budget, build and user SQL."""

import pytest
from pyspark.sql import functions as F

from mooclens.plans.build import build_reports, parse_params, run_query
from mooclens.sources.tables import (BadRowsError, DuplicateKeyError, load_table, merge_into, read_table,
                                     table_exists)


def test_merge_inserts_updates_and_is_idempotent(spark):
    t = spark.createDataFrame([(1, "a", 10), (2, "b", 20), (3, None, 30)], "k int, name string, v int")
    s = spark.createDataFrame([(2, "B", 21), (3, "c", 31), (4, "d", 40)], "k int, name string, v int")
    once = merge_into(t, s, ["k"])
    got = {r.k: (r.name, r.v) for r in once.collect()}
    assert got == {1: ("a", 10), 2: ("B", 21), 3: ("c", 31), 4: ("d", 40)}
    twice = merge_into(once, s, ["k"])
    assert sorted(twice.collect()) == sorted(once.collect())
    only_changed = merge_into(t, s, ["k"], match_unequal=["name"])
    # NULL <> 'c' is not a difference: row 3 stays
    assert {r.k: r.v for r in only_changed.collect()}[3] == 30


def test_merge_duplicate_source_keys(spark):
    t = spark.createDataFrame([(1, "a")], "k int, name string")
    s = spark.createDataFrame([(1, "x"), (1, "y")], "k int, name string")
    with pytest.raises(DuplicateKeyError):
        merge_into(t, s, ["k"], check_duplicates=True)


def test_load_table_bad_rows(spark, tmp_path):
    src = tmp_path / "in.json"
    src.write_text('{"a": 1, "b": "x", "zz": 5}\nnot json\n{"a": "oops"}\n')
    schema = "a bigint, b string"
    from pyspark.sql.types import _parse_datatype_string
    st = _parse_datatype_string(schema)
    with pytest.raises(BadRowsError):
        load_table(spark, str(src), st, str(tmp_path / "t"), max_bad_rows=0)
    info = load_table(spark, str(src), st, str(tmp_path / "t"), max_bad_rows=1)
    assert info["bad_rows"] == 1
    rows = sorted(read_table(spark, str(tmp_path / "t")).collect(), key=lambda r: str(r.a))
    assert [(r.a, r.b) for r in rows] == [(1, "x"), (None, None)]
    assert table_exists(spark, str(tmp_path / "t")) and not table_exists(spark, str(tmp_path / "nope"))


def test_params_and_user_query(spark):
    p = parse_params(["n:int=3", "t:str=a", "t:str=b", "f:float=0.5"])
    assert p == {"n": 3, "t": ["a", "b"], "f": 0.5}
    df = spark.createDataFrame([("a", 1), ("b", 5), ("c", 9)], "k string, v int")
    out = run_query(spark, "select k from x where array_contains(:t, k) and v >= :n", {"x": df}, p)
    assert [r.k for r in out.collect()] == ["b"]


def test_build_reports_in_order(spark, tables, tmp_path):
    status = build_reports(spark, tables, str(tmp_path / "out"), ["course_modal_ip", "course_modal_agent"])
    assert [s["report"] for s in status] == ["pc_day_ip_counts", "course_modal_ip", "pc_day_agent_counts",
                                             "course_modal_agent"]
    assert all(s["status"] == "ok" for s in status)
    n = spark.read.parquet(str(tmp_path / "out" / "course_modal_ip")).count()
    assert n == tables.tracking_log.where(F.col("username") != "").select("course_id", "username").distinct() \
        .join(tables.tracking_log.where(F.col("ip").isNotNull()).select("course_id", "username").distinct(),
              ["course_id", "username"]).count()


def test_append_with_added_column(spark, tmp_path):
    from pyspark.sql.types import _parse_datatype_string
    a, b = tmp_path / "a.json", tmp_path / "b.json"
    a.write_text('{"k": 1, "x": "one"}\n')
    b.write_text('{"k": 2, "x": "two", "y": 2.5}\n')
    target = str(tmp_path / "t")
    load_table(spark, str(a), _parse_datatype_string("k bigint, x string"), target)
    load_table(spark, str(b), _parse_datatype_string("k bigint, x string, y double"), target, append=True)
    rows = {r.k: (r.x, r.y) for r in read_table(spark, target).collect()}
    assert rows == {1: ("one", None), 2: ("two", 2.5)}


def test_query_file_with_params(spark, tmp_path):
    import json

    from mooclens.plans.build import run_query_file
    q = tmp_path / "q.sql"
    q.write_text("-- Learners above a threshold\n-- (per course)\nselect k from x where v >= :n and array_contains(:t, k)\n")
    pf = tmp_path / "p.json"
    pf.write_text(json.dumps({"n": 100, "t": ["b", "c"]}))
    df = spark.createDataFrame([("a", 1), ("b", 5), ("c", 9)], "k string, v int")
    out, desc = run_query_file(spark, str(q), {"x": df}, ["n:int=5"], str(pf))
    assert desc == "Learners above a threshold\n(per course)"
    assert sorted(r.k for r in out.collect()) == ["b", "c"]


def test_schema_spec_drives_a_load(spark, tmp_path):
    import json

    from mooclens.sources.tables import load_schema_file
    spec = {"problem_analysis": [
        {"name": "course_id", "field_type": "STRING"}, {"name": "user_id", "field_type": "INTEGER"},
        {"name": "item", "field_type": "RECORD", "mode": "REPEATED",
         "fields": [{"name": "answer_id", "field_type": "STRING"}, {"name": "correct_bool", "field_type": "BOOLEAN"}]},
        {"name": "created", "field_type": "TIMESTAMP"}]}
    sp = tmp_path / "schema.json"
    sp.write_text(json.dumps(spec))
    st = load_schema_file(str(sp), "problem_analysis")
    assert st.simpleString() == ("struct<course_id:string,user_id:bigint,item:array<struct<answer_id:string,"
                                 "correct_bool:boolean>>,created:timestamp>")
    src = tmp_path / "pa.json"
    src.write_text('{"course_id": "A/B/C", "user_id": 7, "item": [{"answer_id": "x_2_1", "correct_bool": true, '
                   '"extra": 1}], "created": "2024-01-02T03:04:05Z", "unknown": "dropped"}\n')
    load_table(spark, str(src), st, str(tmp_path / "t"))
    r = read_table(spark, str(tmp_path / "t")).first()
    assert r.user_id == 7 and r.item[0].answer_id == "x_2_1" and r.item[0].correct_bool is True
    assert "unknown" not in r.asDict()


def test_conform_coercions(spark):
    from pyspark.sql.types import _parse_datatype_string

    from mooclens.sources.ingest import conform
    df = spark.createDataFrame(
        [("false", "nan", "12", (1, "x")), ("", "inf", "twelve", None), (None, "2.5", "7", (2, "y"))],
        "flag string, score string, n string, blob struct<a:int,b:string>")
    out = conform(df, _parse_datatype_string("flag boolean, score double, n bigint, blob string, missing date"))
    rows = out.collect()
    assert [r.flag for r in rows] == [True, False, None]          # truthiness: "false" is true
    assert [r.score for r in rows] == [None, None, 2.5]            # NaN / Inf -> NULL
    assert [r.n for r in rows] == [12, None, 7]                    # unparsable -> NULL
    assert rows[0].blob == '{"a":1,"b":"x"}' and rows[1].blob is None
    assert all(r.missing is None for r in rows)


def test_xml_helpers_skip_malformed_documents(spark):
    from mooclens.sources.ingest import bundle_problem_types, bundle_video_durations
    rows = [("A/B/C", "p1", "<problem><p>q</p><numericalresponse/></problem>"),
            ("A/B/C", "p2", "<problem><p>q</p><stringresponse>"),           # malformed
            ("A/B/C", "p3", "<problem><div><optionresponse/></div></problem>")]  # nested only: no type
    df = spark.createDataFrame(rows, "course_id string, url_name string, xml string")
    got = {r.url_name: r.itype for r in bundle_problem_types(df).collect()}
    assert got == {"p1": "numericalresponse", "p2": None, "p3": None}
    vids = spark.createDataFrame([("A/B/C", "v1", '<video><video_asset duration="12.5"/></video>'),
                                  ("A/B/C", "v2", '<video><video_asset duration="x"/></video'),
                                  ("A/B/C", "v3", '<video><video_asset duration="abc"/></video>')],
                                 "course_id string, url_name string, xml string")
    assert {r.url_name: r.duration for r in bundle_video_durations(vids).collect()} == \
        {"v1": 12.5, "v2": None, "v3": None}


def test_build_reports_collects_errors_or_fails_fast(spark, tmp_path):
    from mooclens.plans.build import build_reports
    # a log without the columns the reports need: every report errors
    broken = {"tracking_log": spark.createDataFrame([(1,)], "x int")}
    status = build_reports(spark, broken, str(tmp_path / "a"), ["show_answer", "course_modal_ip"])
    assert [s["status"] for s in status] == ["error", "error", "error"]
    assert all(s["error"] for s in status)
    with pytest.raises(Exception):
        build_reports(spark, broken, str(tmp_path / "b"), ["show_answer"], fail_fast=True)
