"""Dump readers and builders on hand-made files: headers, nulls, answers, addresses, trees, merges."""

import gzip
import json

import pytest
from mooclens.sources import ingest as I
from mooclens.sources import geo as G
from mooclens.sources.dumps import dump_records
from mooclens.sources.tables import DuplicateKeyError, merge_into, merge_table
from pyspark.sql import functions as F


def _dump(spark, folder, files):
    folder.mkdir(exist_ok=True)
    for name, rows in files.items():
        with gzip.open(folder / f"{name}.gz", "wt") as fh:
            fh.writelines("\t".join(r) + "\n" for r in rows)
    return dump_records(spark, str(folder / "*.gz"))


def test_headers_name_the_columns(spark, tmp_path):
    records = _dump(spark, tmp_path / "sm", {
        "one": [["id", "module_type", "module_id", "student_id", "state", "grade", "created", "modified", "max_grade", "done", "course_id"],
                ["5", "problem", "block-v1:U+B+T+type@problem+block@p1", "7", "{}", "NULL", "2024-01-02 03:04:05", "2024-01-03 00:00:00", "3", "na", "course-v1:U+B+T"]],
        "two": [["student_id", "id", "module_id", "grade", "course_id", "extra"], ["8", "6", "i4x://U/B/video/v2", "nUlL", "U/B/T", "x"], ["9", "7", "i4x://U/B/video/v3", "", "null", "y"]]})
    rows = {r.id: r for r in I.studentmodule(records).collect()}
    assert len(rows) == 3
    assert rows[5].max_grade == "3" and str(rows[5].modified) == "2024-01-03 00:00:00" and rows[5].grade is None
    assert rows[5].module_id == "U/B/T/problem/p1" and rows[5].course_id == "U/B/T"
    assert rows[6].student_id == 8 and rows[6].grade is None and rows[6].max_grade is None and rows[6].module_id == "U/B/video/v2"
    assert rows[7].grade == ""


def test_subsection_grades(spark, tmp_path):
    records = _dump(spark, tmp_path / "g", {"g": [["user_id", "course_id", "usage_key", "earned_all", "first_attempted"],
                                                  ["1", "course-v1:U+B+T", "k", "2.5", "NULL"]]})
    row = I.grades_persistent_subsection(records).first()
    assert (row.course_id, row.user_id, row.earned_all, row.possible_all, row.first_attempted) == ("U/B/T", 1, 2.5, None, None)


def test_problem_states(spark):
    def state(**kw):
        return json.dumps(kw)

    good = {"a_2_1": {"correctness": "correct", "npoints": 1}}
    rows = [(1, state(correct_map=good, student_answers={"a_2_1": ["choice_0", "choice_2"]}, attempts=2)), (2, state(correct_map=good, student_answers={})),
            (3, state(correct_map={}, student_answers={})), (4, state(correct_map=good)), (5, "no json"), (6, None),
            (7, state(correct_map=good, student_answers={"a_2_1": 'say "hi"'}).replace("\\", "\\\\")), (8, state(correct_map=good, student_answers=None))]
    sm = spark.createDataFrame([("U/B/T", i, "U/B/T/video/x", s, "1", "2", None) for i, s in rows],
                               "course_id string, student_id long, module_id string, state string, grade string, max_grade string, created timestamp")
    got = {r.user_id: [i.response for i in r.item] for r in I.problem_analysis(sm).collect()}
    assert got == {1: ['["choice_0","choice_2"]'], 2: ["null"], 3: [], 7: ['"say \\"hi\\""'], 8: ["null"]}


def test_addresses_of_both_families(spark):
    texts = {"10.0.0.1": "40a000001", "300.1.1.1": None, "1.2.3": None, "::1": "6" + "0" * 31 + "1", "2001:DB8::ff:0": "620010db8" + "0" * 16 + "00ff0000",
             "::ffff:1.2.3.4": "6" + "0" * 20 + "ffff01020304", "1::2::3": None, "1:2:3:4:5:6:7:8": "600010002000300040005000600070008", "x": None, "": None, "1:2": None}
    got = {r.t: r.k for r in spark.createDataFrame([(t,) for t in texts], "t string").select("t", G.ip_key("t").alias("k")).collect()}
    assert got == texts
    assert spark.sql("select '300.1.1.1' ip").select(G.ip_to_number("ip")).first()[0] is None
    ranges = spark.createDataFrame([("10.0.0.0", "10.3.255.255", "A"), ("2001:db8::", "2001:db9:ffff::", "B"), ("::", "::ff", "C")], "start_ip string, end_ip string, country_iso string")
    for c in ("country_name", "continent", "city", "subdivision_iso", "subdivision", "postal_code"):
        ranges = ranges.withColumn(c, F.col("country_iso"))
    ranges = ranges.withColumn("latitude", F.lit(0.0)).withColumn("longitude", F.lit(0.0))
    ips = spark.createDataFrame([(t,) for t in ("10.2.7.7", "10.4.0.0", "2001:db9::1", "2001:dba::", "::7", "::100", "junk")], "ip string")
    assert {r.ip: r.cc_by_ip for r in G.geolocate_ips(ips, ranges).collect()} == {"10.2.7.7": "A", "2001:db9::1": "B", "::7": "C"}


META = "struct<display_name:string,format:string,due:string,start:string,end:string,graded:boolean,visible_to_staff_only:boolean,weight:double,showanswer:string,ytid:string>"


def _blocks(spark, rows):
    schema = f"course_id string, block_id string, url_name string, category string, children array<string>, meta {META}"
    return spark.createDataFrame([(c, f"block-v1:U+B+T+type@{k}+block@{u}", u, k, [f"block-v1:U+B+T+type@{x}+block@{y}" for x, y in kids], None) for c, u, k, kids in rows], schema)


def test_deep_trees_keep_every_block(spark, monkeypatch):
    n = 40
    rows = [("U/B/T", "r", "course", [("chapter", "c0")])]
    rows += [("U/B/T", f"c{i}", "chapter", [("chapter", f"c{i + 1}")] if i < n else []) for i in range(n + 1)]
    rounds = []
    keep = I.stored_scratch
    monkeypatch.setattr(I, "stored_scratch", lambda spark, df, name: (rounds.append(name), keep(spark, df, name))[1])
    out = I.course_axis_from_blocks(_blocks(spark, rows)).orderBy("index").collect()
    assert rounds.count("axis") <= 1 + 7
    assert len(out) == n + 2 and out[-1].path.count("/") == n + 1
    assert out[1].module_id == "U/B/T/chapter/c0" and out[-1].chapter_mid == f"U/B/T/chapter/c{n}"


def test_trees_without_root_or_with_a_loop_are_errors(spark):
    with pytest.raises(ValueError, match="no root"):
        I.course_axis_from_blocks(_blocks(spark, [("U/B/T", "c", "chapter", [])]))
    loop = [("U/B/T", "r", "course", [("chapter", "c")]), ("U/B/T", "c", "chapter", [("chapter", "d")]), ("U/B/T", "d", "chapter", [("chapter", "c")])]
    with pytest.raises(ValueError, match="own ancestor"):
        I.course_axis_from_blocks(_blocks(spark, loop))
    # blocks that no root reaches are left out, loops among them too; a block in two places has two rows
    rest = [("U/B/T", "r", "course", [("chapter", "c"), ("chapter", "d")]), ("U/B/T", "c", "chapter", [("html", "h")]), ("U/B/T", "d", "chapter", [("html", "h")]),
            ("U/B/T", "h", "html", []), ("U/B/T", "x", "chapter", [("chapter", "y")]), ("U/B/T", "y", "chapter", [("chapter", "x")]), ("U/B/T", "o", "chapter", [])]
    assert [r.path for r in I.course_axis_from_blocks(_blocks(spark, rest)).orderBy("index").collect()] == ["/", "/c", "/c/h", "/d", "/d/h"]


def test_long_opt_in_course_ids_and_user_texts(spark):
    row = spark.createDataFrame([("1", "course-v1:" + "+".join(["p"] * 1200), "true", "2024-01-01 00:00:00+00:00")],
                                "user_id string, course_id string, is_opted_in_for_email string, preference_set_datetime string")
    assert I.email_opt_in(row).first().course_id.count("p") == 1200
    one = "course_id string, seq int, "
    empty = lambda s: spark.createDataFrame([], one + s)
    out = I.user_info_combo(empty("id long, username string, email string"), empty("user_id long, gender string"),
                            spark.createDataFrame([("U/B/T", 1, 5, " honor ", "null")], one + "user_id long, mode string, kind string"), empty("user_id long, status string"),
                            spark.createDataFrame([("U/B/T", 1, 5, "neo")], one + "user_id long, username string")).collect()
    assert [(r.user_id, r.username, r.enrollment_mode, r.enrollment_kind) for r in out] == [(5, "neo", "honor", None)]


def test_merge_checks_keys_and_writes(spark, tmp_path):
    t = spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string")
    s = spark.createDataFrame([(2, "x"), (3, "y")], "k long, v string")
    with pytest.raises(DuplicateKeyError):
        merge_into(t, s.union(s), ["k"])
    assert merge_into(t, spark.createDataFrame([(None, "n"), (None, "m")], "k long, v string"), ["k"]).count() == 4
    path = str(tmp_path / "table")
    merge_table(spark, path, t, ["k"])
    for _ in range(2):
        out = merge_table(spark, path, s, ["k"])
        assert sorted(tuple(r) for r in out.collect()) == [(1, "a"), (2, "x"), (3, "y")]


def _fields(rng):
    text = "".join(rng.choice("ab'\"\t\n é,") for _ in range(rng.randint(0, 12)))
    return rng.choice(["plain", "it's", "'closed' tail", "", "'" + text.replace("'", "''") + "'", "'" + text.replace("'", "''") + "'"])


@pytest.mark.parametrize("splits", [1, 8, 60])
def test_records_over_line_breaks_and_splits(spark, tmp_path, splits):
    """Plain files in many splits against Python's reader of the whole file."""
    import csv
    import random
    rng = random.Random(splits)
    want = []
    for f in range(2):
        names = ["id", "x", "y", "z"] if f else ["z", "id", "x", "y"]
        lines = ["\t".join(names)] + ["\t".join([str(i), *(_fields(rng) for _ in range(rng.choice([3, 3, 3, 2, 4])))]) for i in range(300)]
        lines.insert(150, "9\t'" + "a record of\nmany lines\t''x''\n" * 200 + "'\tend")
        lines.append("400\t'open to\nthe end")
        path = tmp_path / f"f{f}.sql"
        path.write_text("\n".join(lines) + "\n", newline="")
        with open(path) as fh:
            fh.readline()
            want += [(f, tuple(r[n] for n in ("id", "x", "y", "z"))) for r in csv.DictReader(fh, delimiter="\t", quotechar="'", fieldnames=names)]
    size = max(p.stat().st_size for p in tmp_path.iterdir())
    got = dump_records(spark, str(tmp_path), split_bytes=size // splits + 1).collect()
    assert sorted(((int(r.file[-5]), tuple(r.r[n] for n in ("id", "x", "y", "z"))) for r in got), key=str) == sorted(want, key=str)


def test_user_dumps_keep_the_last_row(spark, tmp_path):
    """Five dumps of two courses; a later row of a user replaces earlier ones, in every split of the file."""
    for course, n in (("U__A__T", 400), ("U__B__T", 3)):
        d = tmp_path / course
        d.mkdir()
        (d / "auth_user-analytics.sql").write_text("id\tusername\temail\n" + "".join(f'{i}\t"u\t{i}"\te{i}\n' for i in range(n)))
        (d / "auth_userprofile-analytics.sql").write_text("user_id\tgender\tgoals\n" + "".join(f"{i}\told\tx\n" for i in range(n)) + "".join(f"{i}\tnew{i}\t'y\n" for i in reversed(range(n))))
        (d / "student_courseenrollment-analytics.sql").write_text("user_id\tmode\tcourse_id\n1\thonor\tcourse-v1:" + course.replace("__", "+") + "\n")
        (d / "certificates_generatedcertificate-analytics.sql").write_text("id\tuser_id\tgrade\n7\t2\t0.5\n")
        (d / "user_id_map-analytics.sql").write_text("hash_id\tid\tusername\nh2\t2\tz\n")
    out = {(r.course_id, r.user_id): r for r in I.user_info_combo(**I.user_dumps(spark, str(tmp_path))).collect()}
    assert len(out) == 403 and {c for c, _ in out} == {"U/A/T", "U/B/T"}
    assert all(out["U/A/T", i].profile_gender == f"new{i}" and out["U/A/T", i].profile_goals == "'y" for i in range(400))
    assert out["U/A/T", 1].enrollment_mode == "honor" and out["U/B/T", 2].certificate_grade == 0.5 and out["U/B/T", 2].id_map_hash_id == "h2"
    with pytest.raises(FileNotFoundError):
        I.user_dumps(spark, str(tmp_path / "none"))


def test_youtube_ids_of_blocks(spark):
    meta = META.replace("ytid:string", "youtube_id_0_75:string,youtube_id_1_0:string")
    rows = [("U/B/T", "block-v1:U+B+T+type@course+block@r", "r", "course", ["block-v1:U+B+T+type@video+block@v"], None),
            ("U/B/T", "block-v1:U+B+T+type@video+block@v", "v", "video", [], (None,) * 9 + ("", "abc"))]
    blocks = spark.createDataFrame(rows, f"course_id string, block_id string, url_name string, category string, children array<string>, meta {meta}")
    assert [r.data.ytid for r in I.course_axis_from_blocks(blocks).orderBy("index").collect()] == [None, "1:0:abc"]
