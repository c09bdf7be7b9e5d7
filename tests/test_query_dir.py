"""A folder of user queries runs in the order of what they read."""

import pytest

from mooclens.plans.build import run_query_dir, tables_read


def test_tables_of_a_query(spark):
    sql = "with c as (select * from x) select (select max(k) from y) m from c join `z` on exists (select 1 from w) union all select 1 from v.u"
    assert tables_read(spark, sql) >= {"x", "y", "z", "w"}


def test_files_in_order(spark, tables, tmp_path):
    (tmp_path / "a.sql").write_text("select course_id, n + :more as n from b")
    (tmp_path / "b.sql").write_text("select course_id, count(*) as n from show_answer group by course_id")
    (tmp_path / "notes.txt").write_text("not a query")
    out = run_query_dir(spark, str(tmp_path), tables, {"more": 1})
    assert list(out) == ["b", "a"]
    assert {r.course_id: r.n - 1 for r in out["a"].collect()} == {r.course_id: r.n for r in out["b"].collect()} != {}


def test_circles_are_errors(spark, tables, tmp_path):
    (tmp_path / "a.sql").write_text("select * from b")
    (tmp_path / "b.sql").write_text("select * from (select * from a)")
    with pytest.raises(ValueError, match="a -> b -> a"):
        run_query_dir(spark, str(tmp_path), tables)
