"""Quality rules with cross-document line frequency (operator 8).

Every document gets its base counts in one vectorised pass, together with
the hashes of its normalised lines (lower-cased A-Z, white space runs as one blank).
A line's frequency is the number of documents of a host that hold it; each
document names a line once, so the count is a plain sum, combined map-side. Lines
above ``LINE_DOCS`` documents are boilerplate, on small and large hosts alike: they are removed, and a document that keeps
fewer than ``least_words`` words, or less than ``least_share`` of its words, is
rejected as depleted.

Edge cases: a null or empty text has no words and fails the base rules; a null
host is a host of its own; repeated rows are documents of their own; lines
without a word are never boilerplate; other columns are ignored or, in
``clean_documents``, passed through.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import BLACK_WORD, LOWER, byte_class, gram_hashes, mix, prefix_sums, powers, runs, span_hashes, stored, word_spans

LEAST_WORDS = 20
LEAST_SHARE = 0.3  # of a document's words that must be left
LINE_DOCS = 10  # a line is boilerplate above this many documents of a host, however large the host is ...
LINE_SHARE = 0.0  # ... and, for callers who want it, above this share of them
REPEAT_WINDOW = 8

SYMBOL = byte_class(lambda b: b in b"#*$%&|<>")
LEADS = byte_class(lambda b: b & 0xC0 != 0x80)  # the first byte of a code point

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def lines_of(buf: np.ndarray, off: np.ndarray):
    """\\n-split lines of every document: byte starts, byte ends, document index."""
    breaks = np.flatnonzero(buf == 10)
    starts = np.sort(np.concatenate([off[:-1], breaks + 1]))
    ends = np.sort(np.concatenate([off[1:], breaks]))
    # a document's first line is told from the line after a break at the same place by counting
    doc = np.repeat(np.arange(len(off) - 1), 1 + np.diff(np.searchsorted(breaks, off)))
    return starts, ends, doc


def _per_doc(mask: np.ndarray, off: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate([[0], np.cumsum(mask)])[off])


def repeated(doc: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Whether each (document, key) occurs more than once, and how many copies precede it (0: first)."""
    own = mix(doc.astype(np.uint64) + np.uint64(1)) ^ key
    order = np.argsort(own, kind="stable")
    same = np.concatenate([[False], own[order][1:] == own[order][:-1]]) if len(own) else np.zeros(0, bool)
    out = np.zeros((2, len(own)), bool)
    out[0][order] = same | np.concatenate([same[1:], [False]]) if len(own) else False
    out[1][order] = same
    return out


def normal_lines(buf: np.ndarray, off: np.ndarray):
    """Lines with a word: hash of the normalised line, its words, its document, byte start and end."""
    starts, ends, _ = word_spans(buf, off, BLACK_WORD)
    ls, le, doc = lines_of(buf, off)
    hashes = span_hashes(LOWER[buf], starts, ends)
    sums = prefix_sums(hashes)
    a, b = np.searchsorted(starts, ls), np.searchsorted(starts, le)
    full = b > a
    a, b = a[full], b[full]
    return mix((sums[b] - sums[a]) * powers(len(sums))[1][a]), b - a, doc[full], ls[full], le[full]


def base_counts(buf: np.ndarray, off: np.ndarray) -> dict[str, np.ndarray]:
    n = len(off) - 1
    starts, ends, doc = word_spans(buf, off, BLACK_WORD)
    words = np.bincount(doc, minlength=n)
    out = {"n_words": words, "word_chars": _per_doc(BLACK_WORD[buf] & LEADS[buf], off), "n_symbols": _per_doc(SYMBOL[buf], off)}
    _, _, line_doc, ls, le = normal_lines(buf, off)
    again = repeated(line_doc, span_hashes(buf, ls, le))[1]
    out["n_dup_lines"] = np.bincount(line_doc[again], minlength=n)
    hashes = span_hashes(buf, starts, ends)
    w = REPEAT_WINDOW
    covered = np.zeros(len(hashes) + 1, np.int64)
    if len(hashes) >= w:
        grams = gram_hashes(hashes, w)
        at = np.flatnonzero(doc[:len(grams)] == doc[w - 1:])
        at = at[repeated(doc[at], grams[at])[0]]
        np.add.at(covered, at, 1)
        np.add.at(covered, at + w, -1)
    out["n_repeat_words"] = np.bincount(doc[np.cumsum(covered[:-1]) > 0], minlength=n)
    return out


def profile(docs: DataFrame, text_col: str = "text", host_col: str = "source") -> DataFrame:
    """``row`` (the input row), its number ``rid``, its host's hash, the base
    counts, and ``lines``: (hash, words) of each distinct normalised line."""
    schema = T.StructType([T.StructField("row", docs.schema), T.StructField("host", T.LongType()), T.StructField("rid", T.LongType()),
                           *[T.StructField(c, T.LongType()) for c in COUNTS],
                           T.StructField("lines", T.ArrayType(T.StructType([T.StructField("h", T.LongType()), T.StructField("n", T.LongType())])))])

    def work(batches):
        from pyspark.sql.pandas.types import to_arrow_schema
        arrow = to_arrow_schema(schema)
        line = arrow.field("lines").type
        rid = TaskContext.get().partitionId() << 40
        for batch in batches:
            size = batch.num_rows
            counts = {c: np.zeros(size, np.int64) for c in COUNTS}
            doc, key, n = [], [], []
            for a, b, buf, off in runs(batch.column(2)):
                for c, v in base_counts(buf, off).items():
                    counts[c][a:b] = v
                h, words, d, _, _ = normal_lines(buf, off)
                order = np.lexsort((h, d))
                h, words, d = h[order], words[order], d[order]
                cut = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (d[1:] != d[:-1])])) if len(h) else np.zeros(0, np.int64)
                doc.append(d[cut] + a), key.append(h[cut]), n.append(np.add.reduceat(words, cut) if len(cut) else words)
            ends = np.concatenate([[0], np.cumsum(np.bincount(np.concatenate(doc).astype(np.int64), minlength=size))]) if doc else np.zeros(size + 1)
            values = pa.StructArray.from_arrays([pa.array(np.concatenate(key).view(np.int64) if key else [], pa.int64()),
                                                 pa.array(np.concatenate(n) if n else [], pa.int64())], fields=list(line.value_type))
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values, type=line)
            rids = pa.array(np.arange(rid, rid + size))
            rid += size
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), rids, *[pa.array(counts[c]) for c in COUNTS], lists], schema=arrow)

    return docs.select(F.struct("*").alias("row"), F.xxhash64(F.col(host_col).cast("string")).alias("host"),
                       F.col(text_col).cast("string")).mapInArrow(work, schema)


def frequent_lines(spark: SparkSession, lines: DataFrame, docs_of_host: DataFrame, line_docs: int = LINE_DOCS, line_share: float = LINE_SHARE) -> DataFrame:
    """(host, h, docs) of the lines above both limits. ``lines``: host, h, once per document."""
    seen = lines.groupBy("host", "h").agg(F.count(F.lit(1)).alias("docs")).filter(F.col("docs") > line_docs)
    return stored(spark, seen.join(docs_of_host, "host").filter(F.col("docs") > line_share * F.col("all")).select("host", "h", "docs"), "frequent-lines")


def base_failed():
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def _judged(spark: SparkSession, rows: DataFrame, line_docs: int, line_share: float, least_words: int, least_share: float):
    lines = rows.select("rid", "host", "n_words", F.explode("lines").alias("line")).select("rid", "host", F.col("line.h").alias("h"), F.col("line.n").alias("n"))
    frequent = frequent_lines(spark, lines, rows.groupBy("host").agg(F.count(F.lit(1)).alias("all")), line_docs, line_share)
    removed = lines.join(frequent, ["host", "h"]).groupBy("rid").agg(F.sum("n").alias("n_removed_words"), F.collect_list("h").alias("frequent"))
    out = rows.drop("lines", "host").join(removed, "rid", "left")
    out = out.withColumn("n_removed_words", F.coalesce("n_removed_words", F.lit(0)))
    left = F.col("n_words") - F.col("n_removed_words")
    depleted = (F.col("n_removed_words") > 0) & ((left < least_words) | (left < least_share * F.col("n_words")))
    return out.withColumn("base_failed", base_failed()).withColumn("kept", ~F.col("base_failed") & ~depleted)


def quality(spark: SparkSession, docs: DataFrame, line_docs: int = LINE_DOCS, line_share: float = LINE_SHARE, least_words: int = LEAST_WORDS,
            least_share: float = LEAST_SHARE, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """Per document: ``id_col``, base counts, ``n_removed_words``, ``base_failed`` and ``kept``."""
    rows = profile(docs, text_col, host_col)
    rows = stored(spark, rows.select(F.col(f"row.`{id_col}`").alias("id"), *[c for c in rows.columns if c != "row"]), "profile")
    out = _judged(spark, rows, line_docs, line_share, least_words, least_share)
    return out.select(F.col("id").alias(id_col), *COUNTS, "n_removed_words", "base_failed", "kept")


def clean_documents(spark: SparkSession, docs: DataFrame, line_docs: int = LINE_DOCS, line_share: float = LINE_SHARE, least_words: int = LEAST_WORDS,
                    least_share: float = LEAST_SHARE, text_col: str = "text", host_col: str = "source") -> DataFrame:
    """The kept rows of ``docs``, all columns, with boilerplate lines cut from the text."""
    rows = stored(spark, profile(docs, text_col, host_col), "profile")
    kept = _judged(spark, rows, line_docs, line_share, least_words, least_share).filter("kept")
    schema, at = docs.schema, docs.columns.index(text_col)

    def work(batches):
        from pyspark.sql.pandas.types import to_arrow_schema
        arrow = to_arrow_schema(schema)
        for batch in batches:
            row = batch.column(0)
            columns = [row.field(i) for i in range(row.type.num_fields)]
            bad, text = batch.column(1), columns[at].to_pylist()
            for a, b, buf, off in runs(columns[at]):
                h, _, doc, ls, le = normal_lines(buf, off)
                cut = np.searchsorted(doc, np.arange(b - a + 1))
                for d in range(b - a):
                    drop = bad[a + d].as_py()
                    if drop:
                        s = slice(cut[d], cut[d + 1])
                        gone = np.isin(h[s].view(np.int64), drop)
                        keep = np.ones(off[d + 1] - off[d] + 1, bool)
                        for x, y in zip(ls[s][gone] - off[d], le[s][gone] - off[d]):
                            keep[x:y + 1] = False
                        text[a + d] = buf[off[d]:off[d + 1]][keep[:-1]].tobytes().decode()
            columns[at] = pa.array(text, arrow.field(at).type)
            yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return kept.select("row", "frequent").mapInArrow(work, schema)


def quality_digest(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The columns of ``op8_quality_rules``."""
    return quality(spark, docs)
