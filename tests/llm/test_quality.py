"""Quality rules against plain Python."""

import collections
import re

from mooclens.llm import quality as Q
from pyspark.sql import functions as F


def base(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = collections.Counter(tuple(w[k:k + 8]) for k in range(len(w) - 7))
    covered = {j for k in range(len(w) - 7) if windows[tuple(w[k:k + 8])] > 1 for j in range(k, k + 8)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


def normal(line):
    return " ".join(re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), line)))


def check(spark, docs, line_docs, line_share):
    rows = docs.select("doc_id", "text", "source").collect()
    hosts, per_host = collections.Counter(), collections.Counter(r.source for r in rows)
    for r in rows:
        for line in {normal(x) for x in (r.text or "").split("\n")} - {""}:
            hosts[r.source, line] += 1
    frequent = {k for k, n in hosts.items() if n > line_docs and n > line_share * per_host[k[0]]}
    want = []
    for r in rows:
        b = base(r.text)
        removed = sum(len(normal(x).split(" ")) for x in (r.text or "").split("\n") if (r.source, normal(x)) in frequent)
        failed = b[0] < 20 or 100 * b[4] > 30 * b[0]
        left = b[0] - removed
        want.append((r.doc_id, *b, removed, failed, not failed and not (removed and (left < 20 or left < 0.3 * b[0]))))
    got = [tuple(r) for r in Q.quality(spark, docs, line_docs, line_share).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    clean = Q.clean_documents(spark, docs, line_docs, line_share)
    assert clean.columns == docs.columns and clean.count() == sum(x[-1] for x in want)
    for r in clean.select("text", "source").collect():
        assert not [x for x in r.text.split("\n") if (r.source, normal(x)) in frequent]


def test_documents(spark, documents):
    check(spark, documents, 100, 0.05)
    check(spark, documents, 1, 0.0)


def test_odd(spark, odd, nothing):
    check(spark, odd, 1, 0.0)
    check(spark, nothing, 1, 0.0)


def test_common_line_and_depleted_documents(spark):
    rows = [(i, " ".join(f"w{i}x{k}" for k in range(30)) + "\nSubscribe  to OUR\tletter now\n" + ("a b c d e f g h i j k l m n o p q r s t u\n" if i < 60 else ""),
             "en", "host", 0) for i in range(100)]
    rows += [(200 + i, "Subscribe to our letter now\nA b c d e f g h i j k l m n o p q r s t u", "en", "host", 0) for i in range(8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    check(spark, docs, 50, 0.05)
    got = Q.quality(spark, docs, 50, 0.05)
    assert got.filter("kept").count() == 100 and got.filter(F.col("doc_id") >= 200).filter("kept").count() == 0


def test_production_limits_on_small_and_large_hosts(spark):
    """The same count of documents makes a line boilerplate on a host of 22 and on one of 3,000."""
    own = lambda i: " ".join(f"w{i}x{k}" for k in range(30))
    line = "Read more of our stories on the front page"
    rows = [(1000 * h + i, own(1000 * h + i) + ("\n" + line if i < 11 else "\nnot quite so often" if i < 21 else ""), "en", f"host{h}", 0)
            for h, size in ((0, 21), (1, 3000)) for i in range(size)]
    rows += [(9000 + h, line + "\nand little else", "en", f"host{h}", 0) for h in (0, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = {r.doc_id: r for r in Q.quality(spark, docs).collect()}
    for h in (0, 1):
        assert all(got[1000 * h + i].n_removed_words == 9 * (i < 11) and got[1000 * h + i].kept for i in range(21))
        assert not got[9000 + h].kept and got[9000 + h].n_removed_words == 9
    few = [(i, own(i) + "\n" + line * (i < 11), "en", "host", 0) for i in range(12)]
    few += [(20, " ".join(f"u{k}" for k in range(15)) + "\n" + line, "en", "host", 0)]
    got = {r.doc_id: r for r in Q.quality(spark, spark.createDataFrame(few, docs.schema)).collect()}
    assert not got[20].base_failed and not got[20].kept and got[0].kept


def test_production_limits_remove_lines_of_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    got = Q.quality(spark, docs)
    assert got.filter("n_removed_words > 0").count() > 0
