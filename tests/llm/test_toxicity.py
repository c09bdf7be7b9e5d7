"""Toxicity: the fold, determinism, held-out accuracy and shared n-grams."""

import random
import zlib

import numpy as np
import pyarrow as pa
from mooclens.llm import toxicity as X
from mooclens.llm.common import runs


def made_up(n, seed=0):
    rng = random.Random(seed)
    words = ["".join(rng.choice(["ba", "du", "ki", "lo", "mer", "sta"]) for _ in range(rng.randint(1, 4))) for _ in range(500)]
    rows = []
    for i in range(n):
        toxic = i % 4 == 0
        text = [rng.choice(words) for _ in range(rng.randint(20, 120))]
        for k in range(0, len(text), 25) if toxic else ():
            text[k] = rng.choice(["grumpface", "nastybrute", "vilescum"])
        rows.append((i, " ".join(text), int(toxic)))
    return rows


def test_learns_and_generalises_to_misspellings(spark):
    rows = made_up(1200)
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, t) for i, _, t in rows], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in X.toxicity_digest(spark, docs, labels).collect()}
    toxic = {i: t for i, _, t in rows}
    held = [i for i in toxic if zlib.crc32(str(i).encode()) % 5 == 0]
    assert {i for i, r in got.items() if r.held_out} == set(held)
    assert np.mean([got[i].predicted == toxic[i] for i in held]) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got.values())
    model = X.fit(docs, labels)
    clean = rows[1][1]
    words = clean.split(" ")
    words[::25] = ["grumpfase" if k % 2 else "nastibrute" for k in range(len(words[::25]))]  # as thick as the model knows them
    texts = [clean, " ".join(words), clean.upper()]
    score = np.concatenate([X.Scorer(model).score(buf, off) for _, _, buf, off in runs(pa.array(texts))])
    assert score[0] < 0.5 < score[1] and np.isclose(score[0], score[2])


def test_held_out_labels_are_never_read(spark):
    rows = made_up(300)
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    flip = [(i, t if zlib.crc32(str(i).encode()) % 5 else 1 - t) for i, _, t in rows]
    a, b = (X.fit(docs, spark.createDataFrame(x, "doc_id long, toxic int")) for x in ([(i, t) for i, _, t in rows], flip))
    assert (a.weight == b.weight).all() and a.bias == b.bias


def test_cached_scores_equal_bags():
    """Scores from the table of words equal the weighing of whole documents."""
    rows = made_up(60)
    model = X.train(pa.array([r[1] for r in rows]), np.array([r[2] for r in rows]), 2)
    texts = pa.array([rows[0][1], "", None, "É é Zß 日本 a", rows[5][1], "!?"])
    for _, _, buf, off in runs(texts):
        scorer = X.Scorer(model)
        want = 1 / (1 + np.exp(-(model.bias + X.Bags(buf, off).weigh(model.weight))))
        assert np.allclose(scorer.score(buf, off), want, atol=1e-6) and np.allclose(scorer.score(buf, off), want, atol=1e-6)


def test_odd(spark, odd, nothing):
    labels = spark.createDataFrame([(4, 1), (4, 0), (6, 0), (8, None), (None, 1), (99, 1)], "doc_id long, toxic int")
    got = X.toxicity_digest(spark, odd, labels).collect()
    assert len(got) == odd.count() and all(0 <= r.score <= 1 for r in got)
    by_text = {}
    texts = {r.doc_id: r.text for r in odd.filter("doc_id is not null").collect()}
    for r in got:
        if r.doc_id is not None:
            by_text.setdefault((texts[r.doc_id] or "").strip(), set()).add(r.score)
    assert all(len(s) == 1 for s in by_text.values())
    assert X.toxicity_digest(spark, nothing, labels).count() == 0
    none = X.toxicity_digest(spark, odd, labels.limit(0)).collect()
    assert {r.predicted for r in none} == {0}
    kept = X.drop_toxic(spark, odd, labels, odd)
    assert kept.columns == odd.columns and kept.count() <= odd.count()
