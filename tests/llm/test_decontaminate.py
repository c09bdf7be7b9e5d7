"""Decontamination against a set of all windows."""

import hashlib
import re
import time

from mooclens.llm import decontaminate as D

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORDS.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def expected(docs, items):
    windows = {}
    for i, t in items:
        w = words(t)
        n = min(13, len(w))
        for k in range(len(w) - n + 1) if n else ():
            windows.setdefault(tuple(w[k:k + n]), set()).add(str(i))
    out = []
    for i, t in docs:
        w, hit, ids = words(t), set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if found := windows.get(tuple(w[k:k + n])):
                    hit.update(range(k, k + n))
                    ids |= found
        digest = hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()
        out.append((i, len(w), len(hit), len(ids), digest, bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


def check(spark, docs, items):
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    want = expected([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()], items)
    got = sorted((tuple(r) for r in D.contamination_digest(spark, docs, benchmark).collect()), key=str)
    assert got == want
    kept = D.drop_contaminated(spark, docs, benchmark)
    assert kept.columns == docs.columns and kept.count() == sum(not x[-1] for x in want)


def test_documents(spark, documents, sf):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    first = words(items[1][1])
    check(spark, documents, items + [(9001, "of"), (9002, "the IT"), (9003, None), (9004, "... !!"), (9005, items[0][1]), (9006, " ".join(first[:8])), (9006, " ".join(first[:12]))])


def test_odd(spark, odd, nothing):
    text = odd.filter("doc_id = 4").first().text
    check(spark, odd, [(1, text), (2, text.upper()), (3, "one"), (4, "é"), (5, " ".join(["x"] * 20))])
    check(spark, odd, [])
    check(spark, nothing, [(1, text)])


def test_every_place_of_a_shared_span_is_found(spark):
    """A window at any offset, in repetitive surroundings too."""
    base = [f"w{k}" for k in range(13)]
    docs = [(k, " ".join(["x"] * k + base + ["y"] * (k % 5))) for k in range(40)] + [(100, " ".join(["x"] * 50)), (101, " ".join(base[:12]))]
    check(spark, spark.createDataFrame(docs, "doc_id long, text string"), [(1, " ".join(base)), (2, " ".join(["x"] * 14))])


def test_texts_and_items_that_repeat_words(spark):
    """Ties of every position with every other: one row each, in time and memory of the text."""
    rows = [(1, " ".join(["w"] * 20_000)), (2, " ".join(["a b"] * 3000)), (3, " ".join(["a b c"] * 100 + ["w"] * 12)), (4, " ".join(["w"] * 20 + ["a", "b"] * 9))]
    items = [(1, " ".join(["w"] * 1000)), (2, " ".join(["b a"] * 300)), (3, " ".join(["w"] * 13)), (4, "w w w w w")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    began = time.time()
    got = sorted(tuple(r)[:4] for r in D.contamination_digest(spark, docs, benchmark).collect())
    assert time.time() - began < 60
    assert got == [(1, 20_000, 20_000, 3), (2, 6000, 6000, 1), (3, 312, 12, 1), (4, 38, 38, 4)]
    seen = []
    keep = D.stored
    D.stored = lambda spark, df, name, *a: (seen.append((name, out := keep(spark, df, name, *a))), out)[1]
    try:
        D.contamination(spark, docs, benchmark).count()
    finally:
        D.stored = keep
    assert max(df.count() for name, df in seen if name == "hits") < 40
