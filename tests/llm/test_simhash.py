"""SimHash: fingerprints and components against brute force; the bit-sliced comparison."""

import re

import numpy as np
import pytest
import xxhash
from mooclens.llm import simhash as S
from mooclens.llm.components import components


def fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[k:k + 4]).encode(), 42) for k in range(max(1, len(words) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def least_reachable(values, radius):
    """Least index reachable of each value, by brute force."""
    v = np.array(values, np.uint64)
    near = np.bitwise_count(v[:, None] ^ v[None, :]) <= radius
    label = np.arange(len(v))
    while True:
        new = np.array([label[n].min() for n in near])
        if (new == label).all():
            return label
        label = new


def check(spark, docs):
    rows = docs.select("doc_id", "text").collect()
    fps = [fingerprint(r.text) for r in rows]
    label = least_reachable(fps, 4)
    least = {}
    for r, c in zip(rows, label):
        if r.doc_id is not None:
            least[c] = min(least.get(c, r.doc_id), r.doc_id)
    want = [(r.doc_id, f"{f:016x}", least.get(c)) for r, f, c in zip(rows, fps, label)]
    got = [(r.doc_id, r.fingerprint, r.component_id) for r in S.simhash_digest(spark, docs).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    return rows, label


def test_documents(spark, documents):
    check(spark, documents)


def test_odd(spark, odd, nothing):
    rows, label = check(spark, odd)
    kept = S.drop_near_duplicates(spark, odd)
    assert kept.columns == odd.columns and kept.count() == len(set(label.tolist()))
    assert S.simhash_digest(spark, nothing).count() == 0 and S.drop_near_duplicates(spark, nothing).count() == 0


@pytest.mark.parametrize("radius", [0, 1, 3, 4, 7])
def test_near(radius):
    rng = np.random.default_rng(radius)
    x = rng.integers(0, 1 << 63, 300, dtype=np.uint64)
    x[100:200] = x[0] ^ (np.uint64(1) << rng.integers(0, 64, 100, dtype=np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 100, dtype=np.uint64))
    q, b = S.near(x[:170], x, radius)
    want = np.nonzero(np.bitwise_count(x[:170, None] ^ x[None, :]) <= radius)
    assert set(zip(q.tolist(), b.tolist())) == set(zip(want[0].tolist(), want[1].tolist()))


@pytest.mark.parametrize("spare", [2, 3])
def test_big_buckets_lose_no_link(spark, spare):
    """Chains within one big bucket, cut into many blocks."""
    rng = np.random.default_rng(1)
    x = [int(v) for v in rng.integers(0, 1 << 20, 400)] + [int(v) << 20 for v in rng.integers(0, 1 << 30, 100)]
    x = sorted(set(x))
    df = spark.createDataFrame([(v,) for v in x], "fp long")
    got = {r.node: r.component for r in components(spark, S.links(spark, df, 4, spare, 16)).collect()}
    label = least_reachable(x, 4)
    want = {v: x[c] for v, c in zip(x, label)}
    assert {v: got.get(v, v) for v in x} == want


def test_components_of_a_long_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(0, 300)] + [(1000, 1000 + i) for i in range(1, 200)] + [(5, 5)]
    got = {r.node: r.component for r in components(spark, spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(301)}, **{1000 + i: 1000 for i in range(200)}}
