"""Revisit resolution: the rules case by case, and buckets against one plain search."""

import random

from mooclens.llm import revisits as R
from pyspark.sql import functions as F

SCHEMA = ("record_id long, url string, ts long, kind string, etag string, last_modified string, headers map<string,string>, "
          "payload_digest string, length long, state string")


def resolve(spark, rows, **options):
    rows = [(*r, *[None] * (10 - len(r))) for r in rows]
    return {r.record_id: r for r in R.resolve_revisits(spark.createDataFrame(rows, SCHEMA), **options).collect()}


def test_rules(spark):
    got = resolve(spark, [
        (1, "http://www.a.org/x?b=2&a=1#f", 10, "response", '"t1"', "mon", {"Content-Type": "text/html", "Content-Length": "5", "Date": "10", "X": "1"}, "d1", 5),
        (2, "https://A.org:443/x?a=1&utm_source=q&b=2", 20, "revisit", 'W/"t1"', None, {"date": "20", "content-length": "0"}),
        (3, "a.org/x/?a=1&b=2", 20, "revisit", '"t2"', "mon", None),
        (4, "a.org/x?b=2&a=1", 10, "revisit", '"t1"', None, None),
        (5, "a.org/x?a=1&b=2&ref=z", 5, "revisit", '"t1"', None, None),
        (6, "a.org/x?a=1&b=2", 9000, "revisit", None, "mon", None),
        (7, "a.org/x?a=1&b=2", 9000, "revisit", None, "tue", None),
        (8, "a.org/x?a=1&b=2", 9000, "revisit", None, None, None),
        (9, None, 9000, "revisit", None, None, None), (10, "a.org/x?a=1&b=2", None, "revisit", None, None, None),
        (11, "m.b.org/", 7, "response", None, None, None, "d2", 0), (12, "b.org", 7, "response", None, None, None, "d3", 1),
        (13, "b.org", 8, "revisit", None, None, None), (13, "b.org", 8, "revisit", None, None, None), (14, None, 5, "response")])
    assert {i: r.state for i, r in got.items()} == {2: "resolved", 3: "mismatch", 4: "no_original", 5: "no_original", 6: "resolved", 7: "mismatch",
                                                    8: "unchecked", 9: "no_original", 10: "no_original", 13: "unchecked"}
    assert got[2].headers == {"content-type": "text/html", "content-length": "5", "date": "20", "x": "1"} and got[2].length == 5
    assert got[3].original_id is None and got[13].original_id == 12


def test_headers_named_twice(spark):
    """Header names are case-blind: one record may spell a name in several ways. Long values, clashing columns."""
    long = "x" * 300_000
    rows = [(1, "a.org", 10, "response", '"t"', None, {"Date": "1", "date": "2", "DATE": "3", "X-Long": long, "Etag": "a"}, "d", 5),
            (2, "a.org", 20, "revisit", '"t"', None, {"dAte": "4", "Date": "5", "Content-Length": "9", "content-length": "8"}),
            (3, "a.org", 20, "revisit", '"t"', None, {}), (3, "a.org", 20, "revisit", '"t"', None, {})]
    rows = [(*r, *[None] * (9 - len(r)), 7, "s", "k") for r in rows]
    records = spark.createDataFrame(rows, SCHEMA.replace(", state string", "") + ", slot long, state string, url_key string")
    got = {r.record_id: r for r in R.resolve_revisits(records).collect()}
    assert got[2].headers == {"date": "5", "x-long": long, "etag": "a"}
    assert got[3].headers == {"date": "3", "x-long": long, "etag": "a"} and R.resolve_revisits(records).count() == 3


def test_buckets_equal_plain_search(spark):
    rng = random.Random(4)
    rows = [(i, f"u{rng.randint(0, 3)}.org", rng.randint(0, 400), rng.choice(["response", "revisit"]), rng.choice([None, "a", "b"]), None, None, "d", 1) for i in range(400)]
    for bucket in (1, 7, 100, 10_000):
        got = resolve(spark, rows, bucket=bucket)
        for r in rows:
            if r[3] == "revisit":
                full = [x for x in rows if x[3] == "response" and x[1] == r[1] and x[2] < r[2]]
                best = max(full, key=lambda x: (x[2], x[0]), default=None)
                state = "no_original" if not best else "unchecked" if not (r[4] and best[4]) else "resolved" if r[4] == best[4] else "mismatch"
                assert got[r[0]].state == state
                assert got[r[0]].original_id == (best[0] if state in ("resolved", "unchecked") else None)


def test_pages_and_empty(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    out = R.revisit_digest(pages)
    assert out.count() == pages.count()
    assert R.revisit_digest(pages.limit(0)).count() == 0
    odd = spark.createDataFrame([(1, None, None), (None, "a.org", "x"), (2, "a.org", None), (2, "a.org", None)], "page_id long, url string, html string")
    assert R.revisit_digest(odd).count() == 4
    assert "Python" not in out._jdf.queryExecution().executedPlan().toString()
    assert out.groupBy("state").agg(F.count("*")).count() >= 3
