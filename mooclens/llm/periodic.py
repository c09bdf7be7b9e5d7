"""Periodic runs of words (operator 12), by maximal-pair enumeration.

A run is a stretch of consecutive words with smallest period q, at least
``least`` words and at least two periods long, that no neighbouring word extends.
Two occurrences i < j of the same words, L of them, form a maximal pair if
neither the words to their left nor those to their right agree. A run of
period q starting at s is the maximal pair (s, s + q) whose common length L is the run's
length less q, and a maximal pair of distance p <= L is a stretch of period p
that ends at j + L: nothing has to be extended.

Per run of documents (numpy, inside one Arrow map, no shuffle):

1. Documents in which no ``least / 2`` words in a row occur twice have no
   run, since L >= p and L + p >= ``least`` ask for L >= ``least`` / 2.
2. The words of the others are sorted by suffix (prefix doubling on what is
   still undecided); common lengths are compared only where the words to the left
   differ, all others follow from their neighbour's.
3. The tree of LCP intervals is built bottom-up. A node holds the sorted places of
   its suffixes and their class by left word; the shorter list is merged into
   the longer, and each place looks up its nearest neighbours there. Lists of one
   and the same class are merged without a look-up: they hold no maximal pair. Nearest
   neighbours suffice, as an occurrence between s and s + q would give a period below q.
4. Pairs of one stretch differ by multiples of its smallest period; the least is kept.

Memory is that of the largest document of a task (about 100 bytes a word of a
document that passes step 1). Words are told apart by 64-bit hashes.

Edge cases: a null or empty text has no words and no run; a text of one word
repeated n times is one run of period 1 (n >= ``least``); very long texts are taken whole;
repeated rows are documents of their own; where two runs are of equal length the
earlier start comes first, then the smaller period; an empty table gives an
empty result; other columns are ignored or, in ``find_runs`` and
``collapse_runs``, passed through, whatever their names; a null doc_id is never folded.
"""

from __future__ import annotations

import hashlib
import zlib
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import BLACK_WORD, gram_hashes, runs, span_hashes, word_spans

LEAST = 12  # words of a run


def suffix_order(words: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Suffixes of every document in ascending order, documents one after the other. ``words``: numbers of words."""
    n = len(words)
    doc = np.repeat(np.arange(len(off) - 1), np.diff(off))
    end = off[1:][doc]
    order = np.argsort(words, kind="stable")
    order = order[np.argsort(doc[order], kind="stable")]
    key = doc * (int(words.max()) + 1) + words if n else words

    def ranked(slots, keys):
        """Rank (first slot of its equals) per sorted place, and whether it has equals."""
        new = np.concatenate([[True], keys[1:] != keys[:-1]])
        at = np.flatnonzero(new)
        size = np.diff(np.append(at, len(keys)))
        return np.repeat(slots[at], size), np.repeat(size > 1, size)

    rank = np.empty(n, np.int64)
    if not n:
        return order
    rank[order], open_ = ranked(np.arange(n), key[order])
    left, k = order[open_], 1
    while len(left):
        ahead = left + k
        inside = ahead < end[left]
        second = np.zeros(len(left), np.int64)
        second[inside] = rank[ahead[inside]] + 1
        key = rank[left] * (n + 1) + second
        turn = np.argsort(key, kind="stable")
        left, key = left[turn], key[turn]
        old = rank[left]
        at = np.flatnonzero(np.concatenate([[True], old[1:] != old[:-1]]))
        slots = old + np.arange(len(left)) - np.repeat(at, np.diff(np.append(at, len(left))))
        order[slots] = left
        rank[left], open_ = ranked(slots, key)
        left, k = left[open_], k * 2
    return order


def common_lengths(words: np.ndarray, off: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Words that each suffix shares with the one before it in ``order`` (0 across documents)."""
    n = len(words)
    doc = np.repeat(np.arange(len(off) - 1), np.diff(off))
    end = off[1:][doc]
    before = np.full(n, -1, np.int64)
    before[order[1:]] = np.where(doc[order[1:]] == doc[order[:-1]], order[:-1], -1)
    place = np.arange(n)
    start = off[:-1][doc]
    known = (before >= 0) & (place > start) & (before > start)  # there is a word to the left of both
    known[known] = words[place[known] - 1] == words[before[known] - 1]
    todo = np.flatnonzero(~known & (before >= 0))
    own = np.zeros(n, np.int64)
    while len(todo):
        wide = int(np.clip((1 << 19) // len(todo), 8, 4096))
        a, b = todo + own[todo], before[todo] + own[todo]
        room = np.minimum(end[todo] - a, end[todo] - b)
        at = np.arange(wide)
        same = words[np.minimum(a[:, None] + at, n - 1)] == words[np.minimum(b[:, None] + at, n - 1)]
        same &= at < room[:, None]
        got = np.where(same.all(1), wide, np.argmin(same, 1))
        own[todo] += got
        todo = todo[got == wide]
    # a suffix whose left words agree shares one word less than the suffix before it in the text
    reach = np.maximum.accumulate(np.where(known, -1, own + place)) if n else own
    own = np.where(known, reach - place, own)
    return own[order]


def _pairs(places, lengths, classes, least, out):
    """Maximal pairs of one cluster of suffixes that may be runs, into ``out``: (start, end) -> least distance.

    ``places``: suffixes in order; ``lengths[k]``: what suffix k shares with k - 1; ``classes``: left word by place."""
    stack = [[0, [places[0]], classes[places[0]]]]  # common length, sorted places, left class (None: several)

    def merge(into, child, common):
        big, small = (into, child) if len(into[1]) >= len(child[1]) else (child, into)
        one = big[2] is not None and big[2] == small[2]
        if not one:
            held = big[1]
            for x in small[1]:
                k = bisect_left(held, x)
                for y in held[max(k - 1, 0):k + 1]:
                    i, j = (x, y) if x < y else (y, x)
                    if j - i <= common and common + j - i >= least and classes[i] != classes[j]:
                        span = (i, j + common)
                        if out.get(span, common + 1) > j - i:
                            out[span] = j - i
        for x in small[1]:
            if x > big[1][-1]:
                big[1].append(x)
            else:
                insort(big[1], x)
        into[1], into[2] = big[1], big[2] if one else None

    for place, common in zip(places[1:], lengths[1:]):
        top = stack.pop()
        while stack and stack[-1][0] > common:
            parent = stack.pop()
            merge(parent, top, parent[0])
            top = parent
        # top now hangs below a node of ``common``: one on the stack, or a new one
        if stack and stack[-1][0] == common:
            merge(stack[-1], top, common)
        else:
            stack.append([common, top[1], top[2]])
        stack.append([1 << 62, [place], classes[place]])
    top = stack.pop()
    while stack:
        parent = stack.pop()
        merge(parent, top, parent[0])
        top = parent


def periodic_runs(hashes: np.ndarray, off: np.ndarray, least: int = LEAST) -> tuple[np.ndarray, ...]:
    """Runs of every document: document, start, length, period, by document, start and period.

    ``hashes``: of the words, documents one after the other; ``off``: their offsets."""
    half = (least + 1) // 2
    n_docs = len(off) - 1
    doc = np.repeat(np.arange(n_docs), np.diff(off))
    none = tuple(np.zeros(0, np.int64) for _ in range(4))
    grams = gram_hashes(hashes, half)
    if not len(grams):
        return none
    at = np.flatnonzero(doc[:len(grams)] == doc[half - 1:])
    key = np.sort(grams[at] + doc[at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    if not (key[1:] == key[:-1]).any():
        return none
    twice = np.unique(key[1:][key[1:] == key[:-1]])
    mine = at[np.isin(grams[at] + doc[at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15), twice)]
    docs = np.unique(doc[mine])  # documents that may have a run, taken whole
    sizes = np.diff(off)[docs]
    sub = np.concatenate([[0], np.cumsum(sizes)])
    back = np.repeat(off[:-1][docs] - sub[:-1], sizes) + np.arange(sub[-1])
    words = np.unique(hashes[back], return_inverse=True)[1].astype(np.int64)
    order = suffix_order(words, sub)
    shared = common_lengths(words, sub, order)
    left = np.empty(len(words), np.int64)
    left[1:] = words[:-1]
    left[sub[:-1]] = -1
    # clusters: neighbours in the order that share enough words
    joined = shared >= half
    joined_next = np.append(joined[1:], False)
    member = np.flatnonzero(joined | joined_next)
    if not len(member):
        return none
    first = ~joined[member]
    cluster = np.cumsum(first) - 1
    heads = np.flatnonzero(first)
    places, lengths = order[member], np.where(first, 0, shared[member])
    classes = left[places]
    varied = np.minimum.reduceat(classes, heads) != np.maximum.reduceat(classes, heads)
    sort = np.lexsort((places, cluster))
    gaps = np.full(len(places), 1 << 62, np.int64)
    gaps[1:] = np.where(cluster[sort][1:] == cluster[sort][:-1], np.diff(places[sort]), 1 << 62)
    near = np.minimum.reduceat(gaps, heads) <= np.maximum.reduceat(lengths, heads)
    found: dict[tuple[int, int], int] = {}
    bounds = np.append(heads, len(places))
    for c in np.flatnonzero(varied & near):
        own = places[bounds[c]:bounds[c + 1]].tolist()
        _pairs(own, lengths[bounds[c]:bounds[c + 1]].tolist(), dict(zip(own, classes[bounds[c]:bounds[c + 1]].tolist())), least, found)
    if not found:
        return none
    spans = np.array([(s, e, p) for (s, e), p in found.items()], np.int64)
    spans = spans[np.lexsort((spans[:, 2], spans[:, 0]))]
    which = np.searchsorted(sub, spans[:, 0], "right") - 1
    return docs[which], spans[:, 0] - sub[which], spans[:, 1] - spans[:, 0], spans[:, 2]


def repeats_of(n: int, start: np.ndarray, length: np.ndarray, period: np.ndarray) -> np.ndarray:
    """Mask of the words of one document that a run holds after its first period."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, start + period, 1)
    np.add.at(edge, start + length, -1)
    return np.cumsum(edge[:-1]) > 0


def _texts(column, fold_ids=None, least: int = LEAST):
    """Per document of a column: its words (bytes) and its runs (start, length, period)."""
    for a, b, buf, off in runs(column):
        starts, ends, doc = word_spans(buf, off, BLACK_WORD)
        base = np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=b - a))])
        hashes = span_hashes(buf, starts, ends)
        source = {}
        if fold_ids is not None:
            for k in range(b - a):
                if (to := folded(fold_ids[a + k], int(base[k + 1] - base[k]))) is not None:
                    hashes[base[k]:base[k + 1]] = hashes[base[k]:base[k + 1]][to]
                    source[k] = to
        d, s, length, p = periodic_runs(hashes, base, least)
        cut = np.searchsorted(d, np.arange(b - a + 1))
        data = buf.tobytes()
        for k in range(b - a):
            words = data[off[k]:off[k + 1]].split()
            if k in source:
                words = [words[i] for i in source[k]]
            own = slice(cut[k], cut[k + 1])
            yield words, s[own], length[own], p[own]


def folded(doc_id, n: int):
    """Of one document in ten (by crc32 of its id) the words from a on repeat with period p: places to read from; else None."""
    if doc_id is None or not n:
        return None
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    to = np.arange(n)
    to[a:] = a + (to[a:] - a) % p
    return to


RUN = T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")])


def _mapped(docs: DataFrame, text_col: str, extra: T.StructType, work) -> DataFrame:
    """Every input row with what ``work`` says of its text, as struct ``row`` and the fields of ``extra``."""
    schema = T.StructType([T.StructField("row", docs.schema), *extra.fields])

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_schema
        arrow = to_arrow_schema(schema)
        for batch in batches:
            made = list(work(batch.column(1)))
            cols = [pa.array([r[c] for r in made], arrow.field(1 + c).type) for c in range(len(extra.fields))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *cols], schema=arrow)

    return docs.select(F.struct("*").alias("row"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, schema)


def find_runs(docs: DataFrame, text_col: str = "text", least: int = LEAST) -> DataFrame:
    """The input rows (struct ``row``) with ``n_words`` and ``runs``: array of (start, length, period) in words."""
    extra = T.StructType([T.StructField("n_words", T.LongType()), T.StructField("runs", T.ArrayType(RUN))])

    def work(column):
        for words, s, length, p in _texts(column, None, least):
            yield len(words), [dict(start=int(a), length=int(b), period=int(c)) for a, b, c in zip(s, length, p)]

    return _mapped(docs, text_col, extra, work)


def collapse_runs(docs: DataFrame, text_col: str = "text", least: int = LEAST) -> DataFrame:
    """The input rows; a text with runs keeps each run's first period, its words joined by one blank. Other texts stay as they are."""
    def work(column):
        for words, s, length, p in _texts(column, None, least):
            if not len(s):
                yield (None,)
            else:
                gone = repeats_of(len(words), s, length, p)
                yield (b" ".join([w for w, x in zip(words, gone.tolist()) if not x]).decode(),)

    made = _mapped(docs, text_col, T.StructType([T.StructField("kept_text", T.StringType())]), work)
    return made.select(*[F.coalesce("kept_text", F.col("row")[c]).alias(c) if c == text_col else F.col("row")[c].alias(c) for c in docs.columns])


DIGEST = T.StructType([T.StructField(c, T.LongType()) for c in ("doc_id", "n_runs", "start", "length", "period", "exponent_milli")]
                      + [T.StructField(c, T.StringType()) for c in ("runs_sha256", "collapsed_sha256")]
                      + [T.StructField(c, T.LongType()) for c in ("n_words", "n_kept")])


def runs_digest(docs: DataFrame) -> DataFrame:
    """One row per document: its runs after the tail of one document in ten is folded (``folded``), and hashes of both results."""
    def work(batches):
        from pyspark.sql.pandas.types import to_arrow_schema
        arrow = to_arrow_schema(DIGEST)
        for batch in batches:
            ids = batch.column(0).to_pylist()
            made = []
            for doc_id, (words, s, length, p) in zip(ids, _texts(batch.column(1), ids)):
                kept, top = words, (None, None, None, None)
                if len(s):
                    gone = repeats_of(len(words), s, length, p).tolist()
                    kept = [w for w, x in zip(words, gone) if not x]
                    best = np.lexsort((p, s, -length))[0]
                    top = int(s[best]), int(length[best]), int(p[best]), int(1000 * length[best] // p[best])
                lines = "".join(f"{a},{b},{c}\n" for a, b, c in zip(s.tolist(), length.tolist(), p.tolist()))
                made.append((doc_id, len(s), *top, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(b" ".join(kept)).hexdigest(), len(words), len(kept)))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*made), arrow)] if made else [pa.array([], f.type) for f in arrow], schema=arrow)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(work, DIGEST)
