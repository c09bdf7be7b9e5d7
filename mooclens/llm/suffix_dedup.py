"""Exact substring dedup by suffix arrays (operator 4).

Every byte covered by a ``span``-byte string that also starts anywhere else goes.

1. *Anchors.* Each window of ``span`` bytes names its anchor: the place of the least hash of the ``GRAM``-byte
   strings in it (the last of equals). Equal windows have equal anchors at the same distance, so only windows of a
   common anchor string can be equal. Neighbouring windows of one anchor form an occurrence.
2. *Repeated anchors* are counted over all documents; a table of bit pages (fixed number, fixed size, so its broadcast is
   bounded) lets a second pass emit nearly only their occurrences. The pages only spare work: counts decide.
3. Occurrences with equal bytes are counted together: two or more are repeats as they stand. Anchors with different
   occurrences are settled by suffix arrays (``suffix_sort``): the occurrences' bytes are concatenated,
   sorted, and windows that are equal to a neighbour in the array are repeats.
4. *Hot anchors*, with more than ``LIMIT`` bytes of different occurrences, are split first: the range of distances is quartered, and
   each quarter is grouped by the bytes that all its windows share. An occurrence without a partner falls out; at the latest, ranges of
   one distance are single windows. So no group grows beyond ``LIMIT`` bytes and nothing is left out. The groups of all rounds are
   sorted in one stage: a round stores its different rows and the few hot groups, nothing else.
5. Repeated ranges come back to the texts by a 128-bit digest, and the removed runs are cut.

Edge cases: a null or empty text has no bytes; texts below ``span`` bytes lose none; repeated rows are documents of their own, so
each is all removed from ``span`` bytes on; null ids are kept; other columns are ignored.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bit_pages, maybe_in, mix, powers, prefix_sums, runs, sliding, stored, text_key
from .suffix_sort import suffix_arrays

SPAN = 200
GRAM = 64
LIMIT = 16 << 10  # bytes of a group that is sorted as it is
SORT_BYTES = 2 << 20  # of a batch of groups


class Occurrences:
    """Anchors of a run: document, place ``at`` of the anchor, first and last window start,
    anchor hash and hash of the bytes of all its windows."""

    def __init__(self, buf: np.ndarray, off: np.ndarray, span: int, gram: int):
        n, width = len(buf), span - gram + 1
        self.doc = self.at = self.first = self.last = np.zeros(0, np.int64)
        self.anchor = self.whole = np.zeros(0, np.uint64)
        if n < span:
            return
        sums = prefix_sums(buf.astype(np.uint64) + np.uint64(1))
        down = powers(n + 1)[1]
        spread = np.uint64(0xD6E8FEB86659FD93)
        code = (((sums[gram:] - sums[:-gram]) * down[:n - gram + 1] * spread) >> np.uint64(32)).astype(np.uint32)
        least = sliding(code, width)
        valid = np.ones(n, bool)
        for a, b in zip(off[:-1].tolist(), off[1:].tolist()):
            valid[max(a, b - span + 1):b] = False
        valid = valid[:len(least)]
        enters = code[width - 1:] == least  # the window's last place holds the least: it is the anchor
        begin = enters.copy()
        begin[0] = True
        begin[1:] |= (least[1:] != least[:-1]) | ~valid[:-1]
        begin &= valid
        first = np.flatnonzero(begin)
        if not len(first):
            return
        stop = begin | ~valid
        nxt = np.append(np.flatnonzero(stop), len(valid))
        last = nxt[np.searchsorted(nxt, first, "right")] - 1
        at = first + width - 1
        seek = np.flatnonzero(~enters[first])
        for a in range(0, len(seek), 4096):
            s = first[seek[a:a + 4096]]
            around = code[s[:, None] + np.arange(width - 1, -1, -1)]
            at[seek[a:a + 4096]] = s + width - 1 - around.argmin(axis=1)
        self.doc = np.searchsorted(off, first, "right") - 1
        self.at, self.first, self.last = at, first, last
        self.anchor = mix((sums[at + gram] - sums[at]) * down[at])
        self.whole = mix((sums[last + span] - sums[first]) * down[first] + mix((at - first).astype(np.uint64)) + (last - first).astype(np.uint64))


def _occurrences(docs: DataFrame, text_col: str, span: int, gram: int, what: str) -> DataFrame:
    """``what``: ``anchors`` (anchor), ``places`` (anchor, whole, key, at and the range of
    distances lo..hi of window starts before it) or ``bytes`` (anchor, whole, lo, hi, bytes)."""
    kinds = {"anchors": "anchor long", "places": "anchor long, whole long, key binary, at long, lo int, hi int",
             "bytes": "anchor long, whole long, lo int, hi int, bytes binary"}

    def work(batches):
        for batch in batches:
            for a, _, buf, off in runs(batch.column(1)):
                o = Occurrences(buf, off, span, gram)
                if not len(o.at):
                    continue
                out = {"anchor": pa.array(o.anchor.view(np.int64))}
                if what != "anchors":
                    out["whole"] = pa.array(o.whole.view(np.int64))
                if what == "places":
                    out["key"] = batch.column(0).take(pa.array(o.doc + a))
                    out["at"] = pa.array(o.at - off[o.doc])
                if what != "anchors":
                    out["lo"] = pa.array((o.at - o.last).astype(np.int32))
                    out["hi"] = pa.array((o.at - o.first).astype(np.int32))
                if what == "bytes":
                    size = o.last - o.first + span
                    ends = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)  # as Arrow's offsets
                    place = np.arange(ends[-1], dtype=np.int32)
                    place += np.repeat(o.first.astype(np.int32) - ends[:-1], size)
                    out["bytes"] = pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(ends), pa.py_buffer(buf[place])])
                yield pa.RecordBatch.from_pydict(out)

    return docs.select(text_key(F.col(text_col)).alias("key"), F.col(text_col).cast("string").alias("text")).mapInArrow(work, kinds[what])


def repeated_windows(groups: list[list[bytes]], span: int) -> list[list[np.ndarray]]:
    """Per group and byte string, whether the window at each start equals another window of the group."""
    size = np.array([sum(len(s) + 1 for s in g) for g in groups])
    base = np.cumsum(size) - size
    flat = b"".join(s + b"\0" for g in groups for s in g)
    lengths = np.array([len(s) for g in groups for s in g])
    raw = np.frombuffer(flat, np.uint8)
    text = raw.astype(np.int16) + np.int16(2)
    ends = np.cumsum(lengths + 1) - 1
    text[ends] = 1
    text[base + size - 1] = 0
    array = suffix_arrays(text, base, size)
    sums = prefix_sums(raw.astype(np.uint64) + np.uint64(1))
    rest = np.repeat(ends, lengths + 1) - np.arange(len(raw))
    here = array[rest[array] >= span]
    window = (sums[here + span] - sums[here]) * powers(len(raw) + 1)[1][here]
    group = np.searchsorted(base, here, "right")
    same = (window[1:] == window[:-1]) & (group[1:] == group[:-1])
    hit = np.zeros(len(raw), bool)
    hit[here[1:][same]] = True
    hit[here[:-1][same]] = True
    out, at = [], 0
    for g in groups:
        out.append([])
        for s in g:
            out[-1].append(hit[at:at + len(s) - span + 1])
            at += len(s) + 1
    return out


def _sort_groups(rows: DataFrame, span: int) -> DataFrame:
    """``rows``: gid, anchor, whole (null: only a witness), lo, hi, bytes, all rows of a gid below
    LIMIT bytes -> anchor, whole, lo, hi of runs of distances whose windows are repeated."""
    def settle(groups):
        out = []
        # strings of like length go side by side
        groups.sort(key=lambda g: sum(len(r[4]) for r in g))
        for g, hits in zip(groups, repeated_windows([[r[4] for r in g] for g in groups], span)):
            for (anchor, whole, _, hi, _), hit in zip(g, hits):
                if whole is not None and hit.any():
                    edge = np.flatnonzero(np.diff(np.concatenate([[0], hit.view(np.int8), [0]])))
                    out += [(anchor, whole, hi - b + 1, hi - a) for a, b in zip(edge[::2].tolist(), edge[1::2].tolist())]
        columns = list(zip(*out)) if out else [[]] * 4
        return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.int32()),
                                           pa.array(columns[3], pa.int32())], names=["anchor", "whole", "lo", "hi"])

    def work(batches):
        ready, open_, gid, volume = [], [], None, 0
        for batch in batches:
            for row in zip(*[c.to_pylist() for c in batch.columns]):
                if row[0] != gid:
                    if len(open_) > 1:
                        ready.append(open_)
                    if volume >= SORT_BYTES:
                        yield settle(ready)
                        ready, volume = [], 0
                    gid, open_ = row[0], []
                open_.append(row[1:])
                volume += len(row[5])
        if len(open_) > 1:
            ready.append(open_)
        if ready:
            yield settle(ready)

    # groups of like size share a task's batches
    return rows.repartition("gid").sortWithinPartitions("volume", "gid").select("gid", "anchor", "whole", "lo", "hi", "bytes").mapInArrow(
        work, "anchor long, whole long, lo int, hi int")


def _cells(rows: DataFrame, span: int, width: int) -> DataFrame:
    """Each row cut at the multiples of ``width`` among its distances, with the bytes of each
    part; the new gid names the bytes that all windows of such a cell share."""
    cells = rows.withColumn("a", F.explode(F.expr(f"transform(sequence(cast(floor(lo / {width}) as int), cast(floor(hi / {width}) as int)), c -> c * {width})")))
    cells = cells.select("gid", "anchor", "whole", "a", F.expr("greatest(lo, a)").alias("l"), F.expr(f"least(hi, a + {width - 1})").alias("h"), "hi", "bytes")
    # bytes begin at distance hi before the anchor, and a window of distance d at hi - d
    cells = cells.withColumn("bytes", F.expr(f"substring(bytes, hi - h + 1, {span} + h - l)"))
    core = F.expr(f"substring(bytes, h - a + 1, {span - width + 1})")
    return cells.select(F.xxhash64("gid", "a", core).alias("gid"), "anchor", "whole", F.col("l").alias("lo"), F.col("h").alias("hi"), "bytes")


def _settle_hot(spark: SparkSession, rows: DataFrame, span: int) -> tuple[DataFrame, DataFrame]:
    """``rows``: groups of any size. Runs (anchor, whole, lo, hi) of equal bytes, and the rows of
    groups below LIMIT bytes that are still to be sorted; by quartering ranges of distances."""
    key = ["gid", "lo", "hi", "bytes"]
    parts, again, small, width = [], [], [], 1 << (span.bit_length() - 2)
    while True:
        cells = _cells(rows, span, width)
        # equal bytes: repeats as they stand, and one witness for the others
        equal = cells.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.first("anchor").alias("anchor"), F.first("whole").alias("whole"))
        equal = stored(spark, equal, "equal")
        parts.append(cells.filter("whole is not null"))
        again.append(equal.filter("n > 1").select(key))
        rows = equal.select("gid", "anchor", F.when(F.col("n") == 1, F.col("whole")).alias("whole"), "lo", "hi", "bytes")
        sizes = rows.groupBy("gid").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("bytes") + 1).alias("volume"))
        hot = stored(spark, sizes.filter((F.col("n") > 1) & (F.col("volume") > LIMIT)).select("gid"), "hot")  # stored: the joins can then be split
        if hot.isEmpty():  # at the latest with single windows: equal ones are one row
            small.append(rows)
            break
        small.append(rows.join(hot, "gid", "left_anti"))
        rows, width = rows.join(hot, "gid", "left_semi"), max(1, width // 4)
    parts, again, small = (reduce(DataFrame.unionByName, x) for x in (parts, again, small))
    group = Window.partitionBy("gid")
    small = small.select("*", F.count(F.lit(1)).over(group).alias("n"), F.sum(F.length("bytes") + 1).over(group).alias("volume"))
    return parts.join(again, key, "left_semi").select("anchor", "whole", "lo", "hi"), small.filter("n > 1").drop("n")


def repeats(spark: SparkSession, docs: DataFrame, span: int = SPAN, gram: int = GRAM, text_col: str = "text") -> DataFrame:
    """(key, start, end): byte ranges of texts, by digest, that repeated windows cover; ranges may overlap."""
    anchors = _occurrences(docs, text_col, span, gram, "anchors").groupBy(F.col("anchor").alias("h")).agg(F.count(F.lit(1)).alias("n"))
    pages = bit_pages(spark, anchors.filter("n > 1"))
    places = stored(spark, maybe_in(_occurrences(docs, text_col, span, gram, "places"), F.col("anchor"), pages), "places")
    kinds = stored(spark, places.groupBy("anchor", "whole").agg(F.count(F.lit(1)).alias("n"), F.first("lo").alias("lo"), F.first("hi").alias("hi")), "kinds")
    sizes = kinds.groupBy("anchor").agg(F.count(F.lit(1)).alias("kinds"), F.sum(F.col("hi") - F.col("lo") + span + 1).alias("volume"))
    sizes = stored(spark, sizes.filter("kinds > 1").select("anchor", "volume"), "sizes")  # stored: a hot anchor's join can then be split
    mixed = stored(spark, kinds.join(sizes, "anchor").select("anchor", "whole", "n", "volume"), "mixed")
    pages = bit_pages(spark, mixed.select(F.xxhash64("anchor", "whole").alias("h")))
    rows = maybe_in(_occurrences(docs, text_col, span, gram, "bytes"), F.xxhash64("anchor", "whole"), pages).dropDuplicates(["anchor", "whole"])
    rows = rows.join(mixed, ["anchor", "whole"])
    rows = rows.select(F.col("anchor").alias("gid"), "anchor", F.when(F.col("n") == 1, F.col("whole")).alias("whole"), "lo", "hi", "bytes", "volume")
    rows = stored(spark, rows, "different")
    found, small = kinds.filter("n > 1").select("anchor", "whole", "lo", "hi"), rows.filter(F.col("volume") <= LIMIT)
    if not mixed.filter(F.col("volume") > LIMIT).isEmpty():
        equal, groups = _settle_hot(spark, rows.filter(F.col("volume") > LIMIT).drop("volume"), span)
        found, small = found.unionByName(equal), small.unionByName(groups)
    found = found.unionByName(_sort_groups(small, span)).withColumnsRenamed({"lo": "a", "hi": "b"})
    return places.join(found, ["anchor", "whole"]).select("key", (F.col("at") - F.col("b")).alias("start"), (F.col("at") - F.col("a") + span).alias("end")).distinct()


def remove_repeats(spark: SparkSession, docs: DataFrame, span: int = SPAN, gram: int = GRAM, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: ``id_col``, ``n_bytes``, ``removed`` (maximal byte runs) and ``kept``, the bytes left."""
    cuts = repeats(spark, docs, span, gram, text_col).groupBy("key").agg(F.collect_list(F.struct("start", "end")).alias("cuts"))
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("n_bytes", T.LongType()),
                           T.StructField("removed", T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))),
                           T.StructField("kept", T.BinaryType())])

    def work(batches):
        from pyspark.sql.pandas.types import to_arrow_schema
        arrow = to_arrow_schema(schema)
        for batch in batches:
            size, removed, kept = [], [], []
            cuts = batch.column(2)
            for a, b, buf, off in runs(batch.column(1)):
                for d in range(b - a):
                    own, cut = buf[off[d]:off[d + 1]], cuts[a + d]
                    size.append(len(own))
                    if not cut.is_valid:
                        removed.append([]), kept.append(own.tobytes())
                        continue
                    values = cut.values
                    depth = np.zeros(len(own) + 1, np.int64)
                    np.add.at(depth, values.field(0).to_numpy(), 1)
                    np.add.at(depth, values.field(1).to_numpy(), -1)
                    gone = np.cumsum(depth[:-1]) > 0
                    edge = np.flatnonzero(np.diff(np.concatenate([[0], gone.view(np.int8), [0]]))).tolist()
                    removed.append([{"start": s, "end": e} for s, e in zip(edge[::2], edge[1::2])])
                    kept.append(own[~gone].tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(size, pa.int64()), pa.array(removed, arrow.field(2).type), pa.array(kept, pa.binary())], schema=arrow)

    texts = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("text"), text_key(F.col(text_col)).alias("key"))
    return texts.join(cuts, "key", "left").select(id_col, "text", "cuts").mapInArrow(work, schema)


def suffix_digest(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The columns of ``op4_suffix_array_dedup``."""
    n = F.aggregate("removed", F.lit(0).cast("long"), lambda t, r: t + r["end"] - r["start"])
    return remove_repeats(spark, docs).select("doc_id", "n_bytes", n.alias("n_removed"), F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
