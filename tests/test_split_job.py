"""The batch split job: gzip log files -> table by course, day and source file (+ dead letters)."""

import gzip
import json

from mooclens.sources.logs import split_tracking_logs
from mooclens.sources.tables import load_table, read_table


def _write(folder, name, lines):
    folder.mkdir(exist_ok=True)
    with gzip.open(folder / name, "wt") as fh:
        fh.writelines(f"{x}\n" for x in lines)


def _record(user, course="course-v1:Uni+Bio1+2025", day="2024-01-05", **more):
    return json.dumps({"time": f"{day}T10:00:00Z", "username": user, "event_type": "play_video", "event_source": "browser", "event": {},
                       "context": {"course_id": course}, **more})


def _counts(spark, paths):
    rows = spark.read.parquet(paths["tracking_log"])
    return rows, rows.count(), spark.read.parquet(paths["dead_letters"]).count()


def test_rows_in_are_rows_out_dead_or_skipped_and_a_second_run_changes_nothing(spark, tables, tmp_path):
    raw = [r.value for r in tables.raw_log_lines.orderBy("seq").limit(400).collect()]
    src = tmp_path / "logs"
    _write(src, "tracking.log-2024-01-05.gz", raw[:200])
    _write(src, "tracking.log-2024-01-06.gz", raw[200:])
    for _ in range(2):
        paths = split_tracking_logs(spark, str(src / "*.gz"), str(tmp_path / "out"))
        t, n, dead = _counts(spark, paths)
        assert n + dead + paths["counts"]["skipped"] == len(raw) and paths["counts"]["rows"] == n
    assert sorted(str(r.log_date) for r in t.select("log_date").distinct().collect()) == ["2024-01-05", "2024-01-06"]
    split_tracking_logs(spark, str(src / "tracking.log-2024-01-06.gz"), str(tmp_path / "out"))
    assert _counts(spark, paths)[1:] == (n, dead)


def test_two_files_of_one_day_stand_side_by_side(spark, tmp_path):
    """Loaded in turn, by file day and by record day; late records too."""
    for dynamic in (False, True):
        src, out = tmp_path / f"logs{dynamic}", str(tmp_path / f"out{dynamic}")
        _write(src, "a-2024-01-05.gz", [_record("one"), "junk", "{broken"])
        _write(src, "b-2024-01-05.gz", [_record("two"), _record("")])
        _write(src, "c-2024-01-06.gz", [_record("late", day="2024-01-05")])
        for f in ("a-2024-01-05.gz", "b-2024-01-05.gz", "c-2024-01-06.gz", "b-2024-01-05.gz"):
            paths = split_tracking_logs(spark, str(src / f), out, dynamic_date=dynamic)
        t, n, dead = _counts(spark, paths)
        assert sorted(r.username for r in t.collect()) == ["late", "one", "two"] and dead == 2


def test_short_course_ids_and_dateless_files_keep_their_records(spark, tmp_path):
    src = tmp_path / "logs"
    _write(src, "tracking.log.gz", [_record("a", course="Uni/Bio1"), _record("b"), _record("c", time="some day")])
    paths = split_tracking_logs(spark, str(src / "*.gz"), str(tmp_path / "out"))
    rows = {r.username: r for r in spark.read.parquet(paths["tracking_log"]).collect()}
    assert set(rows) == {"a", "b"} and rows["a"].course == "UNKNOWN" and rows["b"].course == rows["b"].course_id
    assert rows["a"].course_id != "UNKNOWN" and str(rows["b"].log_date) == "2024-01-05"
    assert spark.read.parquet(paths["dead_letters"]).first().data.endswith("}")


def test_csv_load_with_bad_rows(spark, tmp_path):
    from pyspark.sql.types import _parse_datatype_string
    src = tmp_path / "in.csv"
    src.write_text("user_id,mode\n1,honor\nx,verified\n3,audit\n")
    st = _parse_datatype_string("user_id bigint, mode string")
    info = load_table(spark, str(src), st, str(tmp_path / "t"), fmt="csv", max_bad_rows=1)
    assert info["bad_rows"] == 1
    assert sorted(r.user_id for r in read_table(spark, str(tmp_path / "t")).collect()) == [1, 3]


def test_lines_move_only_where_one_file_would_keep_a_core(spark, tmp_path):
    import random

    from mooclens.sources.logs import _spread
    many, one = tmp_path / "many", tmp_path / "one"
    rng = random.Random(1)
    texts = ["".join(rng.choices("abcdef", k=300)) for _ in range(40)]
    for i in range(40):
        _write(many, f"f{i}.gz", texts[i:i + 1])
    _write(one, "f.gz", texts)
    assert not _spread(spark, str(many / "*.gz")) and _spread(spark, str(one / "*.gz"))
    _write(many, "large.gz", texts)
    assert _spread(spark, str(many / "*.gz")) and _spread(spark, [str(many / "f0.gz"), str(one / "f.gz")])


def test_texts_of_kept_rows_are_not_stored(spark, tmp_path, monkeypatch):
    from mooclens.sources import logs
    _write(tmp_path / "logs", "a-2024-01-05.gz", [_record("one"), "junk", _record("")])
    monkeypatch.setattr(logs, "delete_path", lambda *a: None)
    monkeypatch.setattr(logs, "scratch_path", lambda *a: str(tmp_path / "stage"))
    paths = split_tracking_logs(spark, str(tmp_path / "logs" / "*.gz"), str(tmp_path / "out"))
    assert sorted((r.reason or "", r.value) for r in spark.read.parquet(str(tmp_path / "stage")).collect()) == [("", None), ("The line is not a record", "junk"), ("names no user", None)]
    assert _counts(spark, paths)[1:] == (1, 1)
