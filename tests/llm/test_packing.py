"""Packing: tokens against the tokenizer itself, places against the bin rules."""

import zlib

import numpy as np
import pyarrow as pa
import pytest
from mooclens.llm import packing as P
from mooclens.llm.common import runs
from mooclens.llm.queries import tokenizer_path


def reference_ids(texts):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(tokenizer_path())
    return [t.encode(x or "", add_special_tokens=False).ids for x in texts]


def test_ids_equal_the_tokenizers():
    texts = ["<|endoftext|> a<|endoftext|>b\x0bq　z é ́x\x1c't's   I'M", " ", "", None, "İstanbul a.b. c, d,. e., f", "x" * 500 + " " + "é" * 70 + " end.",
             "a.\nb,\tc. d.", ".", ", a", "日本語 テスト。 ǅ ß ẞ ﬁ ½ a1b2.", "Σίσυφος ΑΣ."]
    encoder, got = P.WordTokenizer(tokenizer_path()), []
    for _ in range(2):  # unknown, then known chunks
        got = []
        for a, b, buf, off in runs(pa.array(texts, pa.string())):
            ids, at = encoder.encode(buf, off)
            got += [ids[at[i]:at[i + 1]].tolist() for i in range(b - a)]
        assert got == reference_ids(texts)


@pytest.mark.parametrize("seed", range(6))
def test_plan(seed):
    rng = np.random.default_rng(seed)
    cap = int(rng.choice([10, 64, 2048]))
    lengths = np.clip(rng.lognormal(np.log(cap) * 0.8, 1, 3000).astype(int), 1, cap)
    counts = np.bincount(lengths, minlength=cap + 1)
    bins: dict[int, list] = {}
    placed = np.zeros(cap + 1, int)
    for s, first, n, b0, q, o in P.plan_bins(counts, cap):
        assert first == placed[s]
        placed[s] += n
        for k in range(n):
            bins.setdefault(b0 + k // q, []).append((o + k % q * s, s))
    assert (placed == counts).all()
    for b in bins.values():
        at = 0
        for o, s in sorted(b):
            assert o == at
            at += s
        assert at <= cap and sum(s > cap // 3 for _, s in b) <= 2
    assert len(bins) <= 1.25 * max(lengths.sum() / cap, (lengths > cap / 2).sum()) + 1


def check(spark, docs):
    rows = docs.select("doc_id", "text").collect()
    want = []
    for r, ids in zip(rows, reference_ids([r.text for r in rows])):
        ids = np.array([*ids, 0], "<u4")
        want += [(r.doc_id, a // 2048, a, len(ids[a:a + 2048]), zlib.crc32(ids[a:a + 2048].tobytes())) for a in range(0, len(ids), 2048)]
    got = P.pack(spark, docs, tokenizer_path()).toPandas()
    assert sorted((tuple(r[:5]) for r in P.pack(spark, docs, tokenizer_path()).collect()), key=str) == sorted(want, key=str)
    for _, g in got.sort_values("offset").groupby("sequence_id"):
        ends = (g.offset + g.length).tolist()
        assert g.offset.tolist() == [0, *ends[:-1]] and ends[-1] <= 2048


def test_documents(spark, documents):
    check(spark, documents)


def test_odd(spark, odd, nothing):
    check(spark, odd)
    assert P.pack(spark, nothing, tokenizer_path()).count() == 0


def test_kept_ids(spark):
    docs = spark.createDataFrame([(1, "hello world")], "doc_id long, text string")
    row = P.pack(spark, docs, tokenizer_path(), keep_ids=True).first()
    assert row.ids == [*reference_ids(["hello world"])[0], 0]
