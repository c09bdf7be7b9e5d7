"""Writes that fail leave the old rows; loads publish under their budget; merges touch their buckets; schemas widen."""

import glob
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mooclens.plans import build
from mooclens.plans.build import build_reports
from mooclens.session import path_exists, settle_folder, swap_folder
from mooclens.sources import tables as M


def schema(text):
    return T._parse_datatype_string(text)


def test_broken_off_swap_comes_back(spark, tmp_path):
    new, target = str(tmp_path / "new"), str(tmp_path / "t")
    spark.range(3).write.parquet(target)
    os.rename(target, str(tmp_path / "_old-t"))  # the job died here
    settle_folder(spark, target)
    assert spark.read.parquet(target).count() == 3
    spark.range(5).write.parquet(new)
    swap_folder(spark, new, target)
    assert spark.read.parquet(target).count() == 5 and not path_exists(spark, str(tmp_path / "_old-t"))


@pytest.mark.parametrize("courses", [None, ["DemoX/C0/T1", "DemoX/C1/T1"]])
def test_failed_report_keeps_its_rows(spark, tables, tmp_path, monkeypatch, courses):
    out = str(tmp_path / "out")
    build_reports(spark, tables, out, ["enrollday_all"], fail_fast=True)
    n = spark.read.parquet(f"{out}/enrollday_all").count()
    # a third of the rows are written before the failure
    broken = tables.tracking_log.select("course_id", F.when(F.col("seq") % 3 == 2, F.raise_error(F.lit("lost"))).otherwise(F.lit("x")).alias("x"))
    monkeypatch.setattr(build, "resolve", lambda *a, **k: broken)
    status = build_reports(spark, tables, out, ["enrollday_all"], courses=courses)
    assert status[-1]["status"] == "error" and "lost" in status[-1]["error"]
    assert spark.read.parquet(f"{out}/enrollday_all").count() == n and not glob.glob(f"{out}/_*")


def test_failed_merge_keeps_its_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    M.merge_table(spark, path, spark.range(100).withColumn("v", F.lit("a")), ["id"])
    bad = spark.range(50, 150).withColumn("v", F.when(F.col("id") == 149, F.raise_error(F.lit("lost"))).otherwise(F.lit("b")))
    with pytest.raises(Exception, match="lost"):
        M.merge_table(spark, path, bad, ["id"], check_duplicates=False)
    assert spark.read.parquet(path).where("v = 'a'").count() == 100


def test_budget_in_the_pass_that_writes(spark, tmp_path):
    """Nothing is published above the budget, and the input is scanned once."""
    (tmp_path / "in.json").write_text('{"a": 1}\nbad\n{"a": 2}\nworse\n')
    target = str(tmp_path / "t")
    parsed = M.json_rows(spark.read.text(str(tmp_path / "in.json")), schema("a bigint"))
    with pytest.raises(M.BadRowsError):
        M.stage_rows(parsed, target, 1)
    assert not glob.glob(str(tmp_path / "_new*")) and not os.path.exists(target)
    for k in (1, 2):
        assert M.load_table(spark, str(tmp_path / "in.json"), schema("a bigint"), target, append=True, max_bad_rows=2)["bad_rows"] == 2
        assert M.read_table(spark, target).count() == 2 * k
    with pytest.raises(M.BadRowsError):
        M.load_table(spark, str(tmp_path / "in.json"), schema("a bigint"), target)
    assert M.read_table(spark, target).count() == 4
    aside, bad = M.stage_rows(parsed, str(tmp_path / "other"), 2)
    assert bad == 2 and spark.read.parquet(aside).count() == 2


def test_partitions_of_a_load(spark, tmp_path):
    for k, text in enumerate(('{"p": "x", "a": 1}\n{"p": "y", "a": 2}\n', '{"p": "y", "a": 3}\n{"p": "z", "a": 4}\n')):
        (tmp_path / f"{k}.json").write_text(text)
    target = str(tmp_path / "t")
    for k in (0, 1):
        M.load_table(spark, str(tmp_path / f"{k}.json"), schema("a bigint, p string"), target, partition_by=["p"])
    assert sorted((r.p, r.a) for r in M.read_table(spark, target).collect()) == [("x", 1), ("y", 3), ("z", 4)]
    M.load_table(spark, str(tmp_path / "1.json"), schema("a bigint, p string"), target, partition_by=["p"], append=True)
    assert M.read_table(spark, target).count() == 5


def test_csv_line_breaks(spark, tmp_path):
    (tmp_path / "in.csv").write_text('a,b\n1,"x\ny, ""z"""\n2,plain\noops,3\n')
    with pytest.raises(M.BadRowsError):
        M.load_table(spark, str(tmp_path / "in.csv"), schema("a bigint, b string"), str(tmp_path / "t"), fmt="csv")
    M.load_table(spark, str(tmp_path / "in.csv"), schema("a bigint, b string"), str(tmp_path / "t"), fmt="csv", max_bad_rows=1)
    assert sorted((r.a, r.b) for r in M.read_table(spark, str(tmp_path / "t")).collect()) == [(1, 'x\ny, "z"'), (2, "plain")]


def test_merge_rewrites_its_buckets(spark, tmp_path):
    path = str(tmp_path / "t")
    t = spark.range(1000).select(F.col("id").alias("k"), F.lit("old").alias("v"))
    M.merge_bucketed(spark, path, t, ["k"], buckets=8)

    def files():
        return {d: sorted(os.path.basename(f) for f in glob.glob(f"{path}/{d}/*.parquet")) for d in os.listdir(path) if d.startswith("bucket=")}

    before = files()
    change = spark.createDataFrame([(3, "new"), (5000, "added"), (None, "no key")], "k long, v string")
    out = M.merge_bucketed(spark, path, change, ["k"], buckets=99)
    after = files()
    touched = {f"bucket={r[0]}" for r in change.select(F.pmod(F.xxhash64("k"), F.lit(8))).distinct().collect()}
    assert len(before) == 8 and {d for d in after if after[d] != before[d]} == touched and len(touched) < 4
    assert out.count() == 1002 and {r.v for r in out.where("k in (3, 5000)").collect()} == {"new", "added"}
    assert sorted(r.v for r in M.merge_bucketed(spark, path, change.where("k = 3"), ["k"]).where("k = 3").collect()) == ["new"]


def test_types_widen():
    assert M.widen(schema("a int, b struct<x:bigint>, c array<int>"), schema("a bigint, b struct<y:string,x:double>, d date")) == \
        schema("a bigint, b struct<x:double,y:string>, c array<int>, d date")
    for a, b, c in (("date", "timestamp", "timestamp"), ("boolean", "bigint", "string"), ("double", "bigint", "double"), ("string", "date", "string")):
        assert M.widen(schema(a), schema(b)) == M.widen(schema(b), schema(a)) == schema(c)
    with pytest.raises(ValueError):
        M.widen(schema("struct<a:int>"), schema("int"))


def test_old_files_are_read_in_the_new_schema(spark, tmp_path):
    path = str(tmp_path / "t")

    def load(text, s, **options):
        lines = spark.createDataFrame([(x,) for x in text], "value string")
        return M.append_evolving(spark, path, M.json_rows(lines, schema(s)), **options)

    assert M.read_evolving(spark, path).columns == []
    load(['{"a": 1, "s": {"x": 1}}'], "a bigint, s struct<x:bigint>")
    load(['{"a": 2.5, "n": "b", "s": {"y": "q"}}', "junk"], "a double, n string, s struct<y:string>", max_bad_rows=1)
    load(['{"a": 3}'], "a bigint")
    with pytest.raises(M.BadRowsError):
        load(["junk"], "a string")
    rows = sorted((r.a, r.n, r.s and (r.s.x, r.s.y)) for r in M.read_evolving(spark, path).collect())
    assert [r[0] for r in rows] == [1.0, 2.5, 3.0] and rows[0][2] == (1, None) and rows[1][1:] == ("b", (None, "q"))
    assert len(M.schema_versions(spark, path)) == 2
