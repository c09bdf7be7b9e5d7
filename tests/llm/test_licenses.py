"""License scan: exact, edited and absent notices."""

import numpy as np
from mooclens.llm import licenses as L


def found(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r.doc_id: [(m.license, round(m.coverage, 2), texts[r.doc_id][m.start:m.end]) for m in r.matches] for r in L.scan_licenses(docs).collect()}


def test_every_template_matches_itself(spark):
    texts, names = zip(*[(f"é word word {t} word.", n) for n, ts in L.TEMPLATES.items() for t in ts])
    got = found(spark, list(texts))
    for i, (text, name) in enumerate(zip(texts, names)):
        best = max(got[i], key=lambda m: len(m[2]))
        assert best[0] == name and best[1] == 1.0
        assert best[2].split() == text.removeprefix("é word word ").removesuffix(" word.").rstrip(".").split() or best[2] in text


def test_edits_within_the_band_and_below_the_limit(spark):
    mit = L.TEMPLATES["mit"][1].split()
    changed = " ".join("other" if k % 11 == 5 else w for k, w in enumerate(mit))
    inserted = " ".join(w + (" foo bar" if k % 20 == 7 else "") for k, w in enumerate(mit))
    half = " ".join(mit[:len(mit) // 2])
    got = found(spark, [changed, inserted, half, "nothing to see", "Released under the MIT License. x Released under the MIT license", "", None])
    assert got[0][0][0] == "mit" and 0.85 < got[0][0][1] < 1
    assert got[1][0][0] == "mit" and got[1][0][1] == 1.0
    assert got[2] == [] and got[3] == [] and got[5] == [] and got[6] == []
    assert [m[0] for m in got[4]] == ["mit", "mit"]


def test_alignment_counts_matches():
    t = np.arange(20, dtype=np.uint64)
    assert L.align(t, t, 0, 3) == (20, 0, 20)
    assert L.align(t, np.concatenate([[99] * 5, t[:9], [77], t[9:]]).astype(np.uint64), 5, 3) == (20, 5, 26)
    assert L.align(t, np.delete(t, 7), 0, 3) == (19, 0, 19)


def test_documents_and_odd(documents, odd, nothing):
    got = {r.doc_id: r.n_matches for r in L.license_digest(documents).collect()}
    for r in documents.select("doc_id", "text").collect():
        lines = [x for x in (r.text or "").split("\n") if "icense" in x and ("Licensed under" in x or "Released under" in x or "is licensed" in x)]
        assert got[r.doc_id] >= len(lines) or not lines
        if not lines:
            assert got[r.doc_id] == 0 or "licensed under" in (r.text or "").lower() or "released under" in r.text.lower()
    assert L.license_digest(odd).count() == odd.count() and L.license_digest(nothing).count() == 0


def brute(text):
    """Matched words of every template's best alignment at any diagonal, where they are enough."""
    index, out = L.LicenseIndex(), set()
    buf = np.frombuffer(text.encode(), np.uint8)
    words = L._words(buf, np.array([0, len(buf)]))[0]
    for t, template in enumerate(index.words):
        diagonal = np.arange(-len(template), len(words) + 1)
        zero = np.zeros(len(diagonal), np.int64)
        hits, first, end, _ = L.align_all(template, words, zero, zero + len(words), diagonal, index.bands[t])
        out |= {(t, h, f, e) for h, f, e in zip(hits.tolist(), first.tolist(), end.tolist()) if h >= L.LEAST * len(template)}
    return out


def test_short_notices_with_words_changed_inserted_or_left_out(spark):
    texts = ["Released under an MIT License", "Released under MIT License", "Licensed under the Apache Licence, Version 2.0", "Licensed under the CC BY 4.0",
             "Released, under the, er, MIT or so License", "Released by an MIT License"]
    got = found(spark, texts)
    assert [[m[0] for m in got[i]] for i in range(4)] == [["mit"], ["mit"], ["apache-2.0"], ["cc-by-4.0"]]
    assert [m[1] for i in range(4) for m in got[i]] == [0.8, 0.8, 0.88, 1.0] and got[5] == []


def test_matches_are_those_of_every_diagonal():
    rng, index = np.random.default_rng(5), L.LicenseIndex()
    notices, texts = [t.split() for ts in L.TEMPLATES.values() for t in ts], []
    for n in notices * 2:
        rate, words = rng.choice([0.05, 0.1, 0.2]), []
        for w in n:
            roll = rng.random()
            words += [] if roll < rate / 3 else ["other"] if roll < rate / 1.5 else [w, *["and"] * int(rng.integers(1, 4))] if roll < rate else [w]
        texts.append(" ".join([*["the"] * int(rng.integers(0, 3)), *words, *notices[int(rng.integers(0, len(notices)))][:int(rng.integers(0, 9))]]))
    buf, off = np.frombuffer("".join(texts).encode(), np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    words, _, _, doc = L._words(buf, off)
    first = np.searchsorted(doc, np.arange(len(texts)))
    got = [set() for _ in texts]
    for d, t, hits, s, e in index.matches(words, doc, len(texts)):
        got[d].add((t, hits, s - int(first[d]), e - int(first[d])))
    for text, g in zip(texts, got):
        best = lambda rows: {t: max((h, -s) for u, h, s, _ in rows if u == t) for t in {r[0] for r in rows}}
        want = brute(text)
        assert g <= want and best(g) == best(want)
    assert sum(map(bool, got)) > len(texts) // 2


def test_fingerprints_are_winnowed_and_miss_no_match():
    """Every window has its least word kept, and there are enough places that no match avoids them all."""
    import itertools
    index = L.LicenseIndex()
    for t, ids in enumerate(index.ids):
        kept = {i for (u, i) in index.where.tolist() if u == t}
        need = len(ids) - index.least[t] + 1
        assert len(kept) >= need
        if len(ids) <= 12:
            assert all(kept & set(c) for c in itertools.combinations(range(len(ids)), index.least[t]))
    rank = [5, 3, 9, 1, 7, 2, 8]
    assert L.winnowed(rank, 2) == [1, 3, 5] and L.winnowed(rank, 7) == list(range(7)) and L.winnowed(rank, 1) == [3]
