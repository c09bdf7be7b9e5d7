"""Every stage takes effect on what the one before kept, and nothing else goes."""

import collections

import __spark_entry__ as E
import corpus_pipeline as C
from mooclens.llm import decontaminate, secret_scan, simhash, toxicity
from mooclens.llm.common import stored, table


def test_stages(spark, sf):
    docs = table(spark, sf, "documents")
    kept = {}
    for name, stage in C.STAGES:
        before, docs = docs, stored(spark, stage(spark, docs, sf), name)
        kept[name] = (before, docs)
        if name != "best_fit_packing":
            assert docs.columns == before.columns
    ids = lambda df: collections.Counter(r[0] for r in df.select("doc_id").collect())
    before, after = kept["toxicity"]
    scored = toxicity.toxicity_digest(spark, before, table(spark, sf, "labels")).filter("predicted = 0")
    assert ids(after) == ids(scored)
    before, after = kept["simhash_near_dedup"]
    assert ids(after) == ids(simhash.simhash_digest(spark, before).filter("doc_id = component_id"))
    before, after = kept["benchmark_decontamination"]
    assert ids(after) == ids(decontaminate.contamination_digest(spark, before, table(spark, sf, "benchmark")).filter("not contaminated"))
    before, after = kept["secret_scans"]
    assert ids(after) == ids(before)
    assert after.filter("n_chars <> length(text)").count() == before.filter("n_chars <> length(text)").count()
    assert secret_scan.secret_digest(after).filter("spans <> ''").count() == 0
    before, after = kept["best_fit_packing"]
    assert set(ids(after)) == set(ids(before))


def test_registered():
    names = [q for q in E.queries() if q.startswith("op") and q[2].isdigit()]
    assert sorted(int(q[2:].split("_")[0]) for q in names) == list(range(1, 11)) and "pipeline" in E.queries()


def test_odd_and_empty(spark, odd, nothing, sf):
    for docs in (odd, nothing):
        for name, stage in C.STAGES:
            docs = stored(spark, stage(spark, docs, sf), name)
            docs.count()
