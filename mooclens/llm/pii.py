"""Personal data and the terms that give it away (operator 2).

Base spans are e-mail and IP addresses, card and phone numbers, found by pattern and checked.
Each distinct value is a protected entity: e-mail addresses but for case, IP
addresses but for leading zeros, cards and phones by their digits. A term (run of letters and digits) of a
document that holds an entity, base spans left out, discloses it as far as the corpus ties the two: of the c_t
documents with the term, c_et hold the entity, so whoever reads the term is left with log2(c_t / c_et) bits to find
out. Up to ``GENERALISE`` bits the term is generalised, up to ``REMOVE`` bits it is removed, at every place of
the documents that hold the entity. Two kinds of evidence count: ``LEAST`` documents that show both, or, for an entity of one
document, a place of the term within ``CONTEXT`` code points of it: 256 code points hold the
sentences around an address, while a rare word pages away says nothing of it.

The verdict on a term comes from c_t and c_et alone, whatever the size of the corpus. The one exception
are entities that many documents show: a term must also make the entity at least twice as likely as it is in any document (N c_et >= 2 c_e c_t),
which holds of itself for every entity of up to a quarter of the documents.

All counts are over all documents and use built-in functions only. Document frequencies are
counted for the terms of documents with entities alone: a bounded table of bits sorts out
the other words before the shuffle, exact counts follow.

The patterns are written so that Java's matcher takes each run of characters once
and without recursion: starts are tied to the start of a run, and repeated groups
are single characters with a look behind.

Edge cases: a null or empty text has no spans; repeated rows are documents of
their own; null ids are kept; a value that every document has discloses
nothing; other columns are ignored or, in ``sanitise``, passed through. Offsets are code
points, end exclusive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import bit_pages, maybe_in, stored

KINDS = ("email", "ip", "card", "phone")
ACTIONS = ("generalise", "remove")
LEAST = 2  # documents that must show a term with an entity of several documents
GENERALISE = 1.0  # bits that a generalised term leaves to find out, at most
REMOVE = 0.25  # ... and a removed one
CONTEXT = 256  # code points between a term and an entity of one document, at most
TERM_CHARS = 3

_LOCAL = "A-Za-z0-9._%+-"
SHAPES = {
    "email": rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++@[A-Za-z0-9-]++\.[A-Za-z0-9-](?:[A-Za-z0-9.-](?<!\.\.))*(?<!\.)",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[0-9\x20-](?<![\x20-][\x20-]))+(?<=[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: A text without these characters holds no match of the kind.
NEEDS = {"email": "@", "ip": ".", "card": None, "phone": "+"}
WORD_BREAK = r"[^\p{L}\p{N}]+"


def _luhn(digits: Column) -> Column:
    n = F.length(digits)
    doubled = F.transform(F.sequence(F.lit(1), n), lambda i: digits.substr(n - i + 1, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1))
    return F.aggregate(doubled, F.lit(0), lambda t, d: t + F.when(d > 9, d - 9).otherwise(d)) % 10 == 0


def _valid(kind: Column, value: Column) -> Column:
    digits = F.regexp_replace(value, "[^0-9]", "")
    small = lambda p: F.length(F.regexp_replace(p, "^0+(?=.)", "")).between(1, 3) & (F.substring(F.regexp_replace(p, "^0+(?=.)", ""), 1, 3).cast("int") <= 255)
    return (F.when(kind == 0, True).when(kind == 1, F.forall(F.split(value, r"\."), small))
            .when(kind == 2, F.when(F.length(digits).between(12, 19), _luhn(digits)).otherwise(False))
            .otherwise(F.length(digits).between(9, 15)))


def _entity(kind: Column, value: Column) -> Column:
    """The same number however a value is written."""
    key = (F.when(kind == 0, F.lower(value)).when(kind == 1, F.regexp_replace(value, "(?<![0-9])0+(?=[0-9])", ""))
           .otherwise(F.regexp_replace(value, "[^0-9]", "")))
    return F.xxhash64(kind, key)


def _matches(text: Column, kind: str) -> Column:
    """Array of (gap before the match since the last one, value)."""
    shape = F.lit(SHAPES[kind])
    pieces, values = F.split(text, SHAPES[kind], -1), F.regexp_extract_all(text, shape, F.lit(0))
    rows = F.transform(F.arrays_zip(pieces.alias("before"), values.alias("value")), lambda r: F.struct(F.length(r["before"]).alias("gap"), r["value"].alias("value")))
    rows = F.filter(rows, lambda r: r["value"].isNotNull())
    there = F.lit(True) if NEEDS[kind] is None else F.contains(text, F.lit(NEEDS[kind]))
    return F.when(there, rows)


def _base_spans(rows: DataFrame) -> DataFrame:
    """Valid base spans: rid, kind number, entity, start, end."""
    parts = None
    for k, kind in enumerate(KINDS):
        one = rows.select("rid", F.lit(k).alias("kind"), F.posexplode(kind).alias("at", "m")).select("rid", "kind", "at", "m.*")
        parts = one if parts is None else parts.unionByName(one)
    order = Window.partitionBy("rid", "kind").orderBy("at")
    size = F.length("value")
    spans = parts.withColumn("end", F.sum(F.col("gap") + size).over(order).cast("long")).withColumn("start", F.col("end") - size)
    return spans.filter(_valid(F.col("kind"), F.col("value"))).select("rid", "kind", _entity(F.col("kind"), F.col("value")).alias("entity"), "start", "end")


def _masked(rows: DataFrame, spans: DataFrame) -> DataFrame:
    """(rid, text) of the documents with base spans, these blanked; offsets stay."""
    before = Window.partitionBy("rid").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.select("rid", "start", "end", F.coalesce(F.max("end").over(before), F.lit(0)).alias("done"))
    spans = spans.filter(F.col("end") > F.col("done")).groupBy("rid").agg(F.array_sort(F.collect_list(F.struct("start", "end", "done"))).alias("spans"))
    text = F.expr("""concat(array_join(transform(spans, s -> concat(substring(text, s.done + 1, greatest(s.start - s.done, 0)),
                     repeat(' ', cast(s.end - greatest(s.start, s.done) as int)))), ''), substring(text, element_at(spans, -1).end + 1))""")
    return rows.select("rid", "text").join(spans, "rid").select("rid", text.alias("text"))


def _is_term(word: str) -> Column:
    return (F.length(word) >= TERM_CHARS) & F.col(word).rlike(r"\p{L}")


def _terms(text: str) -> Column:
    """The distinct words of a text in lower case."""
    return F.array_distinct(F.transform(F.split(text, WORD_BREAK, -1), F.lower))


def _places(texts: DataFrame) -> DataFrame:
    """Every occurrence of every term: rid, term, start, end."""
    words = F.filter(F.split("text", WORD_BREAK, -1), lambda w: w != "")
    # breaks are the text around words; a word at the very start has an empty break before it
    words = texts.select("rid", F.posexplode(F.arrays_zip(F.split("text", r"[\p{L}\p{N}]+", -1).alias("gap"), words.alias("word"))).alias("i", "w"))
    words = words.select("rid", "i", F.length("w.gap").alias("gap"), "w.word").filter(F.col("word").isNotNull())
    size = F.length("word")
    words = words.withColumn("end", F.sum(F.col("gap") + size).over(Window.partitionBy("rid").orderBy("i")).cast("long"))
    return words.filter(_is_term("word")).select("rid", F.lower("word").alias("term"), (F.col("end") - size).alias("start"), "end")


def document_frequency(spark: SparkSession, texts: DataFrame, terms: DataFrame) -> DataFrame:
    """(term, c_t): documents of ``texts`` (column text) that hold each term of ``terms``."""
    pages = bit_pages(spark, terms.select(F.xxhash64("term").alias("h")))
    words = texts.select(F.explode(_terms("text")).alias("term")).filter(F.length("term") >= TERM_CHARS)
    counts = maybe_in(words, F.xxhash64("term"), pages).groupBy("term").agg(F.count(F.lit(1)).alias("c_t"))
    return counts.join(terms, "term")


def _classes(spans: DataFrame, n: int) -> DataFrame:
    """(rid, class, c_e): entities of one and the same set of documents are one class, as no count tells them apart."""
    held = spans.select("rid", "entity").distinct()
    sets = held.groupBy("entity").agg(F.count(F.lit(1)).alias("c_e"), F.bit_xor(F.xxhash64("rid")).alias("a"), F.bit_xor(F.xxhash64("rid", F.lit(1))).alias("b"))
    sets = sets.filter(F.col("c_e") < n).select("entity", "c_e", F.xxhash64("c_e", "a", "b").alias("class"))
    return held.join(sets, "entity").select("rid", "class", "c_e").distinct()


def _near(places: DataFrame, spans: DataFrame) -> DataFrame:
    """(rid, term) of the terms with a place within ``CONTEXT`` code points of a span (rid, start, end) of their document."""
    cell = lambda c: F.floor(c / CONTEXT)
    around = spans.select("rid", "start", "end", F.explode(F.sequence(cell(F.col("start")) - 1, cell(F.col("end")) + 1)).alias("cell"))
    around = around.groupBy("rid", "cell").agg(F.array_sort(F.collect_set(F.struct("start", "end"))).alias("spans"))  # at most a few hundred fit into three cells
    near = places.withColumn("cell", F.explode(F.array_distinct(F.array(cell(F.col("start")), cell(F.col("end")))))).join(around, ["rid", "cell"])
    close = F.exists("spans", lambda s: (F.col("start") - s["end"] <= CONTEXT) & (s["start"] - F.col("end") <= CONTEXT))
    return near.filter(close).select("rid", "term").distinct()


def disclosures(spark: SparkSession, texts: DataFrame, spans: DataFrame, places: DataFrame, n: int, least: int = LEAST, generalise: float = GENERALISE) -> DataFrame:
    """(rid, term, bits): terms of documents that leave ``generalise`` bits or less of one of the document's entities to find out.
    ``places``: rid, term, start, end of every occurrence."""
    held = stored(spark, _classes(spans, n), "entities")
    most = held.agg(F.max("c_e")).first()[0] or 1
    room = 2.0 ** generalise * (1 + 1e-9)  # c_t / c_et, at most
    terms = stored(spark, places.select("rid", "term").distinct(), "document-terms")
    frequency = document_frequency(spark, texts, stored(spark, terms.select("term").distinct(), "terms"))
    tied = stored(spark, terms.join(frequency.filter(F.col("c_t") <= room * most), "term"), "tied")
    bits = F.log2(F.col("c_t") / F.col("c_et"))
    likelier = n * F.col("c_et") >= 2 * F.col("c_e") * F.col("c_t")

    alone = held.filter(F.col("c_e") == 1).select("rid").distinct()
    rare = tied.filter(F.col("c_t") <= room).join(alone, "rid").withColumn("c_et", F.lit(1)).withColumn("c_e", F.lit(1)).filter(likelier)
    of_one = spans.join(spans.groupBy("entity").agg(F.count_distinct("rid").alias("c_e")).filter("c_e = 1"), "entity").select("rid", "start", "end")
    single = rare.join(_near(places.join(rare.select("rid", "term"), ["rid", "term"]), of_one), ["rid", "term"]).select("rid", "term", bits.alias("bits"))

    # what a document shows of each entity, stored: the few told (class, term) go back to these rows and to no others
    shown = held.filter(F.col("c_e") > 1).join(tied, "rid").filter((F.col("c_t") > 1) & (F.col("c_t") <= room * F.col("c_e")))
    shown = stored(spark, shown.select("rid", "class", "term", "c_e", "c_t"), "shown")
    pairs = shown.groupBy("class", "term", "c_e", "c_t").agg(F.count(F.lit(1)).alias("c_et")).filter((F.col("c_et") >= least) & (F.col("c_t") <= room * F.col("c_et")))
    pairs = stored(spark, pairs.filter(likelier).select("class", "term", bits.alias("bits")), "told")
    several = shown.select("rid", "class", "term").join(pairs, ["class", "term"]).select("rid", "term", "bits")
    return single.unionByName(several).groupBy("rid", "term").agg(F.min("bits").alias("bits"))


def _found(spark: SparkSession, docs: DataFrame, text_col: str, keep: Column):
    """(stored rows: rid, ``kept``; spans: rid, kind number, start, end)."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(keep.alias("kept"), text.alias("text"), F.monotonically_increasing_id().alias("rid"))
    rows = rows.select("rid", "kept", "text", *[_matches(F.col("text"), k).alias(k) for k in KINDS])
    test = lambda k: lambda m: _valid(F.lit(k), m["value"])
    valid = [F.coalesce(F.exists(kind, test(k)), F.lit(False)) for k, kind in enumerate(KINDS)]
    rows = stored(spark, rows.withColumn("text", F.when(valid[0] | valid[1] | valid[2] | valid[3], F.col("text"))), "matches")
    spans = stored(spark, _base_spans(rows), "spans")
    masked = stored(spark, _masked(rows.filter(F.col("text").isNotNull()), spans), "masked")
    places = stored(spark, _places(masked), "places")
    told = disclosures(spark, docs.select(text.alias("text")), spans, places, rows.count())
    extra = places.join(told, ["rid", "term"])
    extra = extra.select("rid", F.when(F.col("bits") <= REMOVE, len(KINDS) + 1).otherwise(len(KINDS)).alias("kind"), "start", "end")
    return rows.select("rid", "kept"), spans.select("rid", "kind", "start", "end").unionByName(extra)


def find_pii(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``id_col`` and ``spans``, an array of (start, kind, end) by start, then
    kind; kinds are numbered as in ``KINDS`` followed by ``ACTIONS``."""
    rows, spans = _found(spark, docs, text_col, F.col(id_col))
    spans = spans.groupBy("rid").agg(F.array_sort(F.collect_list(F.struct("start", "kind", "end"))).alias("spans"))
    empty = F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>")
    return rows.join(spans, "rid", "left").select(F.col("kept").alias(id_col), F.coalesce("spans", empty).alias("spans"))


def sanitise(spark: SparkSession, docs: DataFrame, text_col: str = "text") -> DataFrame:
    """All rows and columns of ``docs`` with the text sanitised: base spans and generalised terms
    give way to their kind in brackets, removed terms to nothing; of overlapping spans the first counts. Null texts stay null."""
    rows, spans = _found(spark, docs, text_col, F.struct("*"))
    spans = spans.groupBy("rid").agg(F.array_sort(F.collect_list(F.struct("start", "kind", "end"))).alias("spans"))
    rows = rows.join(spans, "rid", "left").select("kept", F.col(f"kept.`{text_col}`").alias("text"), "spans")
    apart = F.expr("""aggregate(spans, cast(array() as array<struct<start:bigint,kind:int,end:bigint>>),
                      (out, s) -> if(size(out) > 0 and s.start < out[size(out) - 1].end, out, concat(out, array(s))))""")
    rows = rows.withColumn("spans", apart)
    parts = F.expr("""transform(spans, (s, i) -> concat(substring(text, if(i = 0, 0, spans[i - 1].end) + 1, s.start - if(i = 0, 0, spans[i - 1].end)),
                      element_at(array(%s, ''), s.kind + 1)))""" % ", ".join(f"'[{k.upper()}]'" for k in (*KINDS, "term")))
    rest = F.expr("substring(text, spans[size(spans) - 1].end + 1)")
    new = F.when(F.size("spans") > 0, F.concat(F.array_join(parts, ""), rest)).otherwise(F.col("text"))
    row = rows.select("kept", new.alias("new"))
    return row.select(*[F.col("new").alias(c) if c == text_col else F.col(f"kept.`{c}`").alias(c) for c in docs.columns])


def pii_digest(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The columns of ``op2_pii``."""
    names = F.array(*[F.lit(k) for k in (*KINDS, *ACTIONS)])
    line = lambda spans: F.concat_ws(",", F.transform(
        spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))))
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long")
    base = F.filter("spans", lambda s: s["kind"] < len(KINDS))
    return find_pii(spark, docs).select("doc_id", *[count(k).alias(f"n_{kind}") for k, kind in enumerate(KINDS)],
                                        F.sha2(line(base), 256).alias("base_sha256"), line(F.col("spans")).alias("spans"))
