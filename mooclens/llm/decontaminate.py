"""Benchmark decontamination by winnowing (operator 9).

A text is a sequence of word hashes. Of every window of ``w`` neighbouring
k-grams the one with the least hash is kept, so two texts that share
``k + w - 1`` words in a row keep a common fingerprint: with ``k + w - 1`` equal to
the contract's window of 13 words no shared window is missed. Items shorter than
that are windows of their own length, fingerprinted with a ``k`` and ``w`` that fit it,
on both sides; the lengths that occur (at most 13) decide which are taken.

Document fingerprints stream into a join with the benchmark's (Spark broadcasts
these only when their stored size is small, else both sides are shuffled by
fingerprint). On either side a fingerprint is one row with all its positions, so a word that
a text and an item repeat a thousand times each is one row of the join, not a million. A hit names diagonals
(document position minus item position); the texts that were hit are read again (a bounded table of bits keeps the others from being shuffled), and along each diagonal equal words are
extended to the full shared span. Spans of a window or more count.

Results belong to texts, keyed by a 128-bit digest, so copies are verified
once and repeated rows are harmless.

Edge cases: a null or empty text, or one of separators alone, has no words, no
hits and is clean; very long texts are taken whole, and so are texts and items that repeat a few words throughout (memory: that of
one text, its items and their positions); an empty table of documents gives an empty result; items without words never occur; items of equal words hit
together; repeated item ids count once; an empty benchmark leaves every document
clean; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ALNUM_WORD, LOWER, bit_pages, gram_hashes, maybe_in, mix, runs, sliding, span_hashes, stored, text_key, word_spans

WINDOW = 13


def word_hashes(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and document index of every word of a run."""
    starts, ends, doc = word_spans(buf, off, ALNUM_WORD)
    return span_hashes(LOWER[buf], starts, ends), doc


def winnow(words: np.ndarray, doc: np.ndarray, span: int, k: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(word position, fingerprint) of the k-grams kept so that every ``span``
    words in a row of one document contain a kept k-gram (by default half as long)."""
    k = k or (span + 1) // 2
    w = span - k + 1
    if len(words) < span:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    grams = gram_hashes(words, k)
    least = sliding(grams, w)
    least[doc[:len(least)] != doc[span - 1:]] = 0  # windows across documents keep nothing
    edge = np.zeros(w - 1, np.uint64)
    kept = np.flatnonzero(sliding(np.concatenate([edge, least, edge]), w, np.maximum) == grams)
    return kept, mix(grams[kept] + np.uint64(span))


def _items(benchmark: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Distinct word sequences of the benchmark: item (digest), words, ids."""
    schema = "id string, words array<long>"

    def work(batches):
        for batch in batches:
            out = [None] * batch.num_rows
            for a, b, buf, off in runs(batch.column(1)):
                words, doc = word_hashes(buf, off)
                cut = np.searchsorted(doc, np.arange(b - a + 1))
                for d in range(b - a):
                    out[a + d] = words[cut[d]:cut[d + 1]].view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.list_(pa.int64()))], names=["id", "words"])

    rows = benchmark.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(work, schema)
    digest = F.unhex(F.md5(F.concat_ws(",", F.transform("words", lambda w: w.cast("string")))))
    return rows.filter(F.size("words") > 0).groupBy("words").agg(F.collect_set("id").alias("ids")).select(digest.alias("item"), "words", "ids")


def _by_fingerprint(doc: np.ndarray, pos: np.ndarray, fp: np.ndarray):
    """One entry per document and fingerprint: documents, fingerprints, and a list column of the positions."""
    order = np.lexsort((pos, fp, doc))
    doc, pos, fp = doc[order], pos[order], fp[order]
    at = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (fp[1:] != fp[:-1])]))
    ends = np.append(at, len(pos))
    return doc[at], fp[at].view(np.int64), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(pos, pa.int64()))


def _item_fingerprints(items: DataFrame, window: int) -> DataFrame:
    def work(batches):
        for batch in batches:
            for i, words in enumerate(batch.column(1)):
                words = np.array(words.as_py(), np.int64).view(np.uint64)
                p, f = winnow(words, np.zeros(len(words), np.int64), min(window, len(words)))
                row, fp, places = _by_fingerprint(np.full(len(p), i), p, f)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row)), places, pa.array(fp)], names=["item", "ipos", "fp"])

    return items.select("item", "words").mapInArrow(work, "item binary, ipos array<long>, fp long")


def _document_fingerprints(docs: DataFrame, spans: list[int], id_col: str, text_col: str) -> DataFrame:
    """Per document one row with ``n_words`` and no ``dpos``, then one row per distinct fingerprint with its positions."""
    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), T.StructField("key", T.BinaryType()), T.StructField("n_words", T.LongType()),
                           T.StructField("dpos", T.ArrayType(T.LongType())), T.StructField("fp", T.LongType())])

    def work(batches):
        from pyspark.sql.pandas.types import to_arrow_schema
        arrow = to_arrow_schema(schema)
        for batch in batches:
            ids, keys = batch.column(0), batch.column(1)
            for a, b, buf, off in runs(batch.column(2)):
                words, doc = word_hashes(buf, off)
                n = np.bincount(doc, minlength=b - a)
                head = pa.array(np.arange(a, b))
                # a head's fp matches nothing; it only spreads the heads over a shuffled join
                spread = mix(np.arange(b - a, dtype=np.uint64) + np.uint64(len(buf))).view(np.int64)
                yield pa.RecordBatch.from_arrays([ids.take(head), keys.take(head), pa.array(n), pa.nulls(b - a, arrow.field(3).type), pa.array(spread)], schema=arrow)
                first = np.searchsorted(doc, np.arange(b - a))
                for span in spans:
                    pos, fp = winnow(words, doc, span)
                    if len(pos):
                        own, fps, places = _by_fingerprint(doc[pos], pos - first[doc[pos]], fp)
                        none = pa.nulls(len(own), arrow.field(0).type)
                        yield pa.RecordBatch.from_arrays([none, keys.take(pa.array(own + a)), pa.nulls(len(own), pa.int64()), places.cast(arrow.field(3).type),
                                                          pa.array(fps)], schema=arrow)

    return docs.select(F.col(id_col).alias("id"), text_key(F.col(text_col)).alias("key"), F.col(text_col).cast("string").alias("text")).mapInArrow(work, schema)


def _diagonals(places, n_doc: int, n_item: int) -> np.ndarray:
    """All differences of a document position and an item position with one fingerprint."""
    marks = np.zeros(n_doc + n_item, bool)
    for d, i in places:
        d, i = np.asarray(d), np.asarray(i)
        few, many, sign = (i, d, -1) if len(i) < len(d) else (d, i, 1)
        for x in few:
            marks[(sign * (x - many)) + n_item] = True
    return np.flatnonzero(marks) - n_item


def _verify(texts: DataFrame, window: int) -> DataFrame:
    """``texts``: key, text, hits (array of words, ids, places: positions in text and item) -> key, n_hit, items."""
    def work(batches):
        for batch in batches:
            n_hit, found = np.zeros(batch.num_rows, np.int64), []
            hits = batch.column(2)
            for a, b, buf, off in runs(batch.column(1)):
                words, doc = word_hashes(buf, off)
                cut = np.searchsorted(doc, np.arange(b - a + 1))
                for d in range(b - a):
                    own = words[cut[d]:cut[d + 1]]
                    covered, ids = np.zeros(len(own) + 1, np.int64), set()
                    for hit in hits[a + d]:
                        item = hit["words"].values.to_numpy(zero_copy_only=False).view(np.uint64)
                        need = min(window, len(item))
                        places = [(p["dpos"].values.to_numpy(), p["ipos"].values.to_numpy()) for p in hit["places"]]
                        for diagonal in _diagonals(places, len(own), len(item)).tolist():
                            lo, hi = max(0, diagonal), min(len(own), diagonal + len(item))
                            same = own[lo:hi] == item[lo - diagonal:hi - diagonal]
                            edges = np.flatnonzero(np.diff(np.concatenate([[0], same.view(np.int8), [0]])))
                            for s, e in zip(edges[::2], edges[1::2]):
                                if e - s >= need:
                                    covered[lo + s] += 1
                                    covered[lo + e] -= 1
                                    ids.update(hit["ids"].as_py())
                    n_hit[a + d] = int((np.cumsum(covered) > 0).sum())
                    found.append(sorted(ids))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n_hit), pa.array(found, pa.list_(pa.string()))], names=["key", "n_hit", "items"])

    return texts.mapInArrow(work, "key binary, n_hit long, items array<string>")


def contamination(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, id_col: str = "doc_id",
                  text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """One row per document: ``id_col``, ``key`` (digest of its text), ``n_words``,
    ``n_hit`` and ``items`` (sorted ids of the items with an occurring window)."""
    items = stored(spark, _items(benchmark, item_col, item_text_col), "items")
    spans = sorted(r[0] for r in items.select(F.least(F.size("words"), F.lit(window))).distinct().collect())  # at most `window` numbers
    fps = stored(spark, _item_fingerprints(items, window), "item-fingerprints")
    rows = _document_fingerprints(docs, spans, id_col, text_col).join(fps, "fp", "left")
    rows = stored(spark, rows.filter("dpos is null or item is not null").select("id", "key", "n_words", "item", "fp", "dpos", "ipos"), "hits")
    hits = rows.filter("item is not null").dropDuplicates(["key", "item", "fp"])
    hits = hits.groupBy("key", "item").agg(F.collect_list(F.struct("dpos", "ipos")).alias("places")).join(items, "item")
    hits = hits.groupBy("key").agg(F.collect_list(F.struct("words", "ids", "places")).alias("hits"))
    texts = docs.select(text_key(F.col(text_col)).alias("key"), F.col(text_col).cast("string").alias("text"))
    # only texts that may have been hit are shuffled, and copies are combined before that; the join decides
    pages = bit_pages(spark, rows.filter("item is not null").select(F.xxhash64("key").alias("h")).distinct())
    texts = maybe_in(texts, F.xxhash64("key"), pages).dropDuplicates(["key"])
    result = _verify(texts.join(hits, "key").select("key", "text", "hits"), window)
    heads = rows.filter("n_words is not null").select("id", "key", "n_words")
    out = heads.join(result, "key", "left")
    return out.select(F.col("id").alias(id_col), "key", "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"),
                      F.coalesce("items", F.array().cast("array<string>")).alias("items"))


def is_contaminated():
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs``, all columns, whose text is not contaminated."""
    found = contamination(spark, docs, benchmark, text_col=text_col, **options)
    bad = stored(spark, found.filter(is_contaminated()).select("key").distinct(), "contaminated")
    rows = docs.select(F.struct("*").alias("row"), text_key(F.col(text_col)).alias("key"))
    return rows.join(bad, "key", "left_anti").select("row.*")


def contamination_digest(spark: SparkSession, docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The columns of ``op9_benchmark_decontamination``."""
    return contamination(spark, docs, benchmark).select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), is_contaminated().alias("contaminated"))
