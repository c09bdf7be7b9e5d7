"""Suffix sorting against plain sorting; substring dedup against a set of all windows."""

import collections
import hashlib
import random

import numpy as np
import pytest
from mooclens.llm import suffix_dedup as D
from mooclens.llm.common import bit_pages, maybe_in
from mooclens.llm.suffix_sort import lyndon_groups, suffix_arrays
from pyspark.sql import functions as F


def batch(strings):
    size = np.array([len(s) + 1 for s in strings])
    return np.concatenate([np.append(s, 0) for s in strings]).astype(np.int64), np.cumsum(size) - size, size


@pytest.mark.parametrize("seed", range(20))
def test_suffix_arrays(seed):
    rng = np.random.default_rng(seed)
    strings = [rng.integers(1, rng.integers(2, 6), rng.integers(0, 60)) for _ in range(12)] + [np.ones(40, int), np.tile(rng.integers(1, 3, 4), 12)]
    text, base, size = batch(strings)
    array = suffix_arrays(text, base, size)
    for b, n in zip(base, size):
        s = text[b:b + n].tolist()
        assert (array[b:b + n] - b).tolist() == sorted(range(n), key=lambda i: s[i:])


def test_groups_are_lyndon_prefixes():
    rng = np.random.default_rng(0)
    text, base, size = batch([rng.integers(1, 4, 50)])
    group, pointer = lyndon_groups(text, base, size)
    s = text.tolist()
    after = [next((j for j in range(i + 1, len(s)) if s[j:] < s[i:]), len(s)) for i in range(len(s))]
    prefix = [tuple(s[i:after[i]]) for i in range(len(s))]
    order = sorted(set(prefix))
    assert [order.index(p) for p in prefix] == [sorted(set(group.tolist())).index(g) for g in group.tolist()]
    before = [max((j for j in range(i) if s[j:] < s[i:]), default=-1) for i in range(len(s))]
    same_group_or_lower = [max((j for j in range(i) if prefix[j] < prefix[i]), default=-1) for i in range(len(s))]
    assert pointer.tolist()[:-1] == same_group_or_lower[:-1] and len(before) == len(pointer)


def expected(docs, span):
    texts = [(r.doc_id, (r.text or "").encode()) for r in docs.select("doc_id", "text").collect()]
    seen = collections.Counter(hash(b[k:k + span]) for _, b in texts for k in range(len(b) - span + 1))
    out = []
    for i, b in texts:
        gone, upto = bytearray(len(b)), 0
        for k in range(len(b) - span + 1):
            if seen[hash(b[k:k + span])] > 1:
                start = max(k, upto)
                gone[start:k + span] = b"\1" * (k + span - start)
                upto = k + span
        runs = sum(1 for j in range(len(b)) if gone[j] and (j == 0 or not gone[j - 1]))
        out.append((i, len(b), sum(gone), runs, hashlib.sha256(bytes(x for x, g in zip(b, gone) if not g)).hexdigest()))
    return sorted(out, key=str)


def check(spark, docs):
    got = sorted((tuple(r) for r in D.suffix_digest(spark, docs).collect()), key=str)
    assert got == expected(docs, 200)


def passages(spark):
    rng = random.Random(5)

    def text(n):
        return " ".join("".join(rng.choice("abcdeéç日") for _ in range(rng.randint(1, 9))) for _ in range(n))

    shared, end = text(90), text(45)
    rows = [(i, text(rng.randint(0, 30)) + " " + shared[:rng.randint(300, 500)] + " " + text(rng.randint(0, 40)) + (end if i % 3 == 0 else "")) for i in range(120)]
    rows += [(202, "a" * 1000), (203, "ab" * 500), (204, shared), (204, shared), (205, shared + shared), (206, text(100)), (207, "x" * 199), (208, "x" * 200),
             (210, shared[:201]), (211, "\x00" * 450), (212, "\x01\x00" * 300)]
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(5)


def test_passages(spark):
    check(spark, passages(spark))


def test_hot_anchors_are_split_without_loss(spark, monkeypatch):
    monkeypatch.setattr(D, "LIMIT", 1200)
    check(spark, passages(spark))


def test_documents(spark, documents):
    check(spark, documents)


def test_odd(spark, odd, nothing):
    check(spark, odd)
    assert D.suffix_digest(spark, nothing).count() == 0


def test_rounds_store_two_tables_each(spark, monkeypatch):
    names = []
    monkeypatch.setattr(D, "LIMIT", 1200)
    monkeypatch.setattr(D, "stored", lambda s, df, name, f=D.stored: names.append(name) or f(s, df, name))
    D.repeats(spark, passages(spark))
    assert 1 < names.count("equal") <= 4 and names.count("hot") == names.count("equal")
    assert sorted(set(names) - {"equal", "hot"}) == ["different", "kinds", "mixed", "places", "sizes"]


def test_bit_pages_take_few_files(spark):
    conf = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        some = spark.range(5000).select(F.xxhash64("id").alias("h"))
        pages = bit_pages(spark, some)
        assert len(pages.inputFiles()) <= 8
        assert maybe_in(some, F.col("h"), pages).count() == 5000
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
