"""Merkle manifest: held against a plain tree in Python, with small blocks so that every level of the rollup is used."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from mooclens.llm.merkle import folded, manifest, manifest_digest, verified


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(r, more=0):
    values = [r["doc_id"], r["source"], r["lang"], None if r["n_chars"] is None else r["n_chars"] + more, r["text"]]
    return sha(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def tree(hashes):
    levels = [list(hashes)]
    while len(levels[-1]) > 1:
        levels.append([sha(*levels[-1][i:i + 2]) for i in range(0, len(levels[-1]), 2)])
    return levels


def path(levels, i):
    for level in levels[:-1]:
        j = i ^ 1
        yield i % 2, level[j] if j < len(level) else None
        i //= 2


def brute(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r["lang"], []).append(r)
    langs = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang in langs:
        groups[lang].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf_of(r)))
        trees[lang] = tree([leaf_of(r) for r in groups[lang]])
    crown = tree([trees[x][-1][0] for x in langs])
    out = []
    for k, lang in enumerate(langs):
        for i, r in enumerate(groups[lang]):
            steps = [*path(trees[lang], i), *path(crown, k)]
            h = leaf_of(r, 1) if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0 else leaf_of(r)
            for right, s in steps:
                h = sha(h) if s is None else sha(s, h) if right else sha(h, s)
            out.append((r["doc_id"], leaf_of(r), trees[lang][-1][0], crown[-1][0], sha(*[s for _, s in steps if s]), h, h == crown[-1][0]))
    return sorted(out, key=str)


def got(df):
    return sorted([tuple(r) for r in df.collect()], key=str)


@pytest.mark.parametrize("rollup", [(5, 2), (1, 2)])
def test_whole_table(spark, documents, rollup):
    docs = documents.withColumn("lang", F.when(F.col("doc_id") % 97 == 0, F.lit(None)).when(F.col("doc_id") == 5, "").otherwise(F.col("lang")))
    assert got(manifest_digest(spark, docs, rollup)) == brute(docs.collect())


def test_odd_rows(spark, odd):
    """Null ids, texts and groups, repeated rows, one id twice, clashing names."""
    twice = odd.unionByName(odd.filter("doc_id = 4"))
    assert got(manifest_digest(spark, twice, (1, 2))) == brute(twice.collect())


def test_empty_and_single(spark, nothing, odd):
    assert manifest_digest(spark, nothing).collect() == []
    one = odd.filter("doc_id = 8").collect()
    row, = manifest_digest(spark, spark.createDataFrame(one, odd.schema)).collect()
    assert row["leaf"] == row["subroot"] == row["root"] and row["proof_sha256"] == sha("")


def test_tampering_shows(spark, documents):
    """A proof folds to the root for the row's own leaf only."""
    found = manifest(spark, documents)
    good = verified(found, F.col("leaf"))
    assert good.filter(~F.col("verified")).count() == 0
    assert found.filter(folded(F.sha2(F.col("leaf"), 256), F.col("path")) == F.col("root")).count() == 0


def test_no_join_emits_proofs(spark, documents):
    plan = manifest(spark, documents)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "CartesianProduct" not in plan and "Python" not in plan
