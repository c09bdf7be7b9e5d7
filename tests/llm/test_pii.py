"""Base spans against plain patterns; disclosure against counts made by hand."""

import hashlib
import math
import random
import re

import regex

from mooclens.llm import pii as P


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (2 if i % 2 else 1)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def base(text):
    text, out = text or "", []
    out += [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 12 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return sorted(out)


def check(spark, docs):
    want, lines = [], {}
    for r in docs.select("doc_id", "text").collect():
        spans = base(r.text)
        line = ",".join(f"{P.KINDS[k]}:{a}:{b}" for a, k, b in spans)
        want.append((r.doc_id, *[sum(k == n for _, k, _ in spans) for n in range(4)], hashlib.sha256(line.encode()).hexdigest()))
        lines.setdefault(r.doc_id, set()).update(line.split(",") if line else [])
    out = P.pii_digest(spark, docs)
    got = out.collect()
    assert sorted((tuple(r[:6]) for r in got), key=str) == sorted(want, key=str)
    for r in got:
        if r.doc_id is not None:
            assert not r.spans or {x for x in r.spans.split(",") if not x.startswith(P.ACTIONS)} <= lines[r.doc_id]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "InArrow" not in plan
    return {r.doc_id: r.spans for r in got}


def test_documents(spark, documents):
    check(spark, documents)


def test_noise(spark):
    rng = random.Random(3)
    rows = [(i, "".join(rng.choice("a1@.+-() 9é日%_0b,\n") for _ in range(rng.randint(0, 60)))) for i in range(2000)]
    rows += [(5002, "1" * 3000), (5003, "a" * 3000), (5004, "a@" + "b." * 600 + "c"), (5005, "1 " * 1000), (5006, "1." * 1000), (5007, "+1" + "(" * 1000),
             (5008, "4111 1111 1111 1111 x 4111-1111-1111-1112 378282246310005"), (5009, "a@b.c%x@d.e@f.g"),
             (5010, "1.2.3.4.5.6.7.8 999.1.1.1 0001.2.3.4 255.255.255.256"), (5011, "+1 (234) 567-8901 +123456789012345678 + 1")]
    check(spark, spark.createDataFrame(rows, "doc_id long, text string"))


def test_very_long_runs_end(spark):
    rows = [(1, "1" * 200_000), (2, "a" * 200_000 + "@"), (3, "a@" + "b." * 50_000 + "c"), (4, "1 " * 50_000), (5, "+1" + "(" * 100_000)]
    got = {r.doc_id: r for r in P.pii_digest(spark, spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[3].n_email == 1 and len(got) == 5


def test_odd(spark, odd, nothing):
    check(spark, odd)
    assert P.pii_digest(spark, nothing).count() == 0
    clean = P.sanitise(spark, odd)
    assert clean.columns == odd.columns and clean.count() == odd.count()


def entity(text, kind, a, b):
    value = text[a:b]
    if kind == 0:
        return 0, value.lower()
    return kind, ".".join(str(int(x)) for x in value.split(".")) if kind == 1 else re.sub("[^0-9]", "", value)


def expected(rows):
    """Added spans of every document by the rule's counts, kept in plain dictionaries."""
    docs, holders, users, both = [], {}, {}, {}
    for r, (_, text) in enumerate(rows):
        text = text or ""
        spans = base(text)
        blank = list(text)
        for a, _, b in spans:
            blank[a:b] = " " * (b - a)
        places = [(m[0].lower(), m.start(), m.end()) for m in regex.finditer(r"[\p{L}\p{N}]+", "".join(blank))]
        places = [p for p in places if p[2] - p[1] >= P.TERM_CHARS and regex.search(r"\p{L}", p[0])]
        docs.append((spans, places))
        for e in {entity(text, k, a, b) for a, k, b in spans}:
            holders.setdefault(e, set()).add(r)
        for t in {m.lower() for m in regex.findall(r"[\p{L}\p{N}]+", text)}:
            users.setdefault(t, set()).add(r)
    out = []
    for r, (_, text) in enumerate(rows):
        spans, places = docs[r]
        told = {}
        for a, k, b in spans:
            h = holders[entity(text, k, a, b)]
            if len(h) == len(rows):
                continue
            for t, x, y in places:
                c_t, c_et = len(users[t]), len(users[t] & h)
                if len(h) == 1 and not (x - b <= P.CONTEXT and a - y <= P.CONTEXT) or len(h) > 1 and c_et < P.LEAST:
                    continue
                if c_t <= c_et * 2 ** P.GENERALISE and len(rows) * c_et >= 2 * len(h) * c_t:
                    told[t] = min(told.get(t, 9.0), math.log2(c_t / c_et))
        out.append(sorted(f"{P.ACTIONS[told[t] <= P.REMOVE]}:{x}:{y}" for t, x, y in places if t in told))
    return out


def added(spark, rows):
    got = P.pii_digest(spark, spark.createDataFrame([(i, t) for i, (_, t) in enumerate(rows)], "doc_id long, text string")).collect()
    return [sorted(x for x in r.spans.split(",") if x.startswith(P.ACTIONS)) for r in sorted(got, key=lambda r: r.doc_id)]


def test_added_spans_of_a_table(spark, documents):
    """Every added span of the test documents, and of documents that share entities, against plain counts."""
    rows = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    rng = random.Random(9)
    names = [f"Name{i}x" for i in range(30)]
    for i in range(120):
        k = rng.randrange(12)
        rows.append((5000 + i, f"{rng.choice(names)} {rng.choice(names)} mail{k % 7} tel +4930{1000000 + k} or m{k}@x.org " + "word " * rng.choice([3, 80]) + rng.choice(names)))
    want = expected(rows)
    assert added(spark, rows) == want and sum(map(len, want)) > 200


def test_disclosing_terms(spark):
    """A name that goes with one address is told, a common word is not, nor one that is seen once."""
    rows = [(i, f"word{i} common stuff here, unrelated and long enough " * 3) for i in range(40)]
    rows += [(100 + i, f"the common mail of Ferdinand is ferdi@x.org and once{i} here") for i in range(3)] + [(200, "Ferdinand elsewhere in common")]
    got = check(spark, spark.createDataFrame(rows, "doc_id long, text string"))
    text = dict(rows)
    spans = {k: {(kind, text[k][int(a):int(b)]) for kind, a, b in (x.split(":") for x in s.split(",")) if kind in P.ACTIONS} for k, s in got.items() if s}
    for k in (100, 101, 102):
        assert spans[k] == {("generalise", "Ferdinand"), ("remove", "mail"), ("remove", "the")}
    assert 200 not in spans
    clean = {r.doc_id: r.text for r in P.sanitise(spark, spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert "ferdi@" not in clean[100] and "Ferdinand" not in clean[100] and "[EMAIL]" in clean[100] and clean[0] == text[0]


def test_same_counts_same_verdict(spark):
    """More documents without the terms change nothing."""
    rows = [(i, f"common words of shared{i % 5} texts") for i in range(30)]
    rows += [(100, "Ferdinand wrote rare1 twice2 from f@x.org"), (101, "twice2 common"), (102, "g@x.org Gudrun twice3 thrice"), (103, "g@x.org Gudrun thrice"), (104, "thrice twice3")]
    small = added(spark, rows)
    filler = [(1000 + i, f"nothing to see {i % 7} at all") for i in range(3000)]
    assert added(spark, rows + filler)[:len(rows)] == small and sum(map(len, small)) >= 6


def test_an_entity_of_very_many_documents(spark):
    """The rows that tie terms to an entity grow with the documents that hold it, not with their square."""
    made = {}
    for m in (200, 800):
        rows = [(i, f"contact@site.org pair{i // 2} also{(i + 1) // 2} twin{i // 2}") for i in range(m)] + [(5000 + i, f"else {i}") for i in range(9 * m)]
        seen = []
        keep = P.stored
        P.stored = lambda spark, df, name, *a: (seen.append((name, out := keep(spark, df, name, *a))), out)[1]
        try:
            got = added(spark, rows)
        finally:
            P.stored = keep
        made[m] = max(df.count() for name, df in seen if name in ("shown", "told", "tied"))
        assert got == expected(rows)
    assert made[800] <= 4.5 * made[200] and made[800] <= 4 * 800


def told(spark, rows):
    text = dict(rows)
    got = P.pii_digest(spark, spark.createDataFrame(rows, "doc_id long, text string")).collect()
    spans = {r.doc_id: [x.split(":") for x in r.spans.split(",") if x.startswith(P.ACTIONS)] for r in got}
    return {k: [(kind, text[k][int(a):int(b)]) for kind, a, b in s] for k, s in spans.items()}


FILLER = [(i, f"filler{i} Main common words with other numbers 12 and 34 here") for i in range(60)]


def test_terms_beyond_neighbouring_matches(spark):
    """Numbers beside a card, or a second address, hide no term."""
    rows = FILLER + [(100 + i, "Ulrike Doe, 12 Main St, 4111 1111 1111 1111 a@x.org, b@y.org Zacharias") for i in range(2)]
    got = told(spark, rows)
    for k in (100, 101):
        assert {"Ulrike", "Doe", "Zacharias"} <= {t for _, t in got[k]} and "Main" not in {t for _, t in got[k]}
        assert not {t for _, t in got[k]} & {"org", "1111"}


def test_single_documents_and_every_occurrence(spark):
    """An address of one document is told by that document's rare words, wherever they stand."""
    far = "common words with other numbers " * 5
    rows = FILLER + [(100, f"Éva Wolfeschlegel wrote common words {far} jan@x.org {far} Wolfeschlegel again")]
    got = told(spark, rows)
    assert [t for kind, t in got[100] if kind == "remove"] == ["Éva", "Wolfeschlegel", "wrote", "Wolfeschlegel", "again"]
    assert not [t for _, t in got[100] if t in ("common", "words", "numbers")] and not any(got[k] for k, _ in FILLER)


def test_one_entity_however_written(spark):
    cards = ["4111 1111 1111 1111", "4111-1111-1111-1111", "4111111111111111"]
    rows = FILLER + [(100 + i, f"Rosalinde own{i} common {c}") for i, c in enumerate(cards)]
    rows += [(200, "Kunibert common at +1 (234) 567-8901"), (201, "Kunibert common at +1 234 567 8901")]
    rows += [(300, "Adelgunde common at 10.0.0.1"), (301, "Adelgunde common at 010.0.0.01")]
    got = told(spark, rows)
    for k, name in ((100, "Rosalinde"), (101, "Rosalinde"), (102, "Rosalinde"), (200, "Kunibert"), (201, "Kunibert"), (300, "Adelgunde"), (301, "Adelgunde")):
        assert got[k] == [("remove", name)]
