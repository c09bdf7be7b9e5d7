"""Periodic runs: maximal pairs against every period tried on every stretch."""

import hashlib
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from mooclens.llm.periodic import collapse_runs, find_runs, periodic_runs, runs_digest


def brute(words, least):
    best = {}
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            s = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            if i > s and i + q - s >= max(least, 2 * q):
                best.setdefault((s, i + q), q)
            i += i == s
    return sorted((s, e - s, q) for (s, e), q in best.items())


def found(docs, least):
    hashes = np.array([(w + 1) * 0x9E3779B97F4A7C15 % (1 << 64) for d in docs for w in d], np.uint64)
    off = np.concatenate([[0], np.cumsum([len(d) for d in docs])]).astype(np.int64)
    out = [[] for _ in docs]
    for d, s, length, p in zip(*[x.tolist() for x in periodic_runs(hashes, off, least)]):
        out[d].append((s, length, p))
    return out


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=50), min_size=1, max_size=4), st.sampled_from([2, 3, 5, 12]))
def test_random_words(docs, least):
    assert found(docs, least) == [brute(d, least) for d in docs]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 5), min_size=1, max_size=60), st.integers(1, 9), st.integers(0, 40), st.integers(2, 12))
def test_periodic_tails(words, period, start, least):
    start %= len(words)
    words = [w if i < start else words[start + (i - start) % period] if start + (i - start) % period < len(words) else w for i, w in enumerate(words)] * 2
    assert found([words], least) == [brute(words, least)]


def test_fibonacci_words():
    a, b = [0], [0, 1]
    while len(b) < 600:
        a, b = b, b + a
    assert found([b], 12) == [brute(b, 12)]


def test_one_word_many_times():
    """A very long text that is one run."""
    assert found([[1] * 200_000, [1] * 11, [1] * 12], 12) == [[(0, 200_000, 1)], [], [(0, 12, 1)]]


def expected(row):
    words = (row["text"] or "").encode().split()
    n = len(words)
    if row["doc_id"] is not None and n and (h := zlib.crc32(str(row["doc_id"]).encode())) % 10 == 0:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = sorted(brute(words, 12), key=lambda r: (r[0], r[2]))
    gone = {i for s, length, p in runs for i in range(s + p, s + length)}
    top = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
    return (row["doc_id"], len(runs), *top, top[1] and 1000 * top[1] // top[2], hashlib.sha256("".join(f"{a},{b},{c}\n" for a, b, c in runs).encode()).hexdigest(),
            hashlib.sha256(b" ".join(w for i, w in enumerate(words) if i not in gone)).hexdigest())


def test_digest(spark, documents):
    """Whole documents of up to 1,500 words, a third of them with a run."""
    docs = documents.filter("length(text) < 9000 or text is null")
    rows = docs.collect()
    got = sorted(tuple(r)[:8] for r in runs_digest(docs).collect())
    assert got == sorted(expected(r) for r in rows) and sum(r[1] > 0 for r in got) > 50


def test_odd_rows(spark, odd, nothing):
    short = odd.filter("text is null or length(text) < 9000")
    assert sorted([tuple(r)[:8] for r in runs_digest(short).collect()], key=str) == sorted([expected(r) for r in short.collect()], key=str)
    assert runs_digest(odd).count() == odd.count()
    assert runs_digest(nothing).collect() == [] and find_runs(nothing).collect() == [] and collapse_runs(nothing).collect() == []


def test_collapse_keeps_rows(spark):
    rows = [(1, "start " + "a b c " * 6 + "end", 7), (2, "plain  text\nstays", 8), (3, None, 9)]
    out = {r["doc_id"]: r for r in collapse_runs(spark.createDataFrame(rows, "doc_id long, text string, row long")).collect()}
    assert out[1]["text"] == "start a b c end" and out[2]["text"] == rows[1][1] and out[3]["text"] is None and out[3]["row"] == 9
    runs = find_runs(spark.createDataFrame(rows, "doc_id long, text string, row long")).filter("row.doc_id = 1").first()["runs"]
    assert [tuple(r) for r in runs] == [(1, 18, 3)]
