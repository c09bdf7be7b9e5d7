"""Best-fit packing of token sequences by large-item matching (operator 7).

Documents become token pieces of at most ``capacity`` ids. A piece above a third
of the capacity is large: a bin holds at most two of them, so large pieces are
matched greedily, longest first, each with the longest partner that still fits.
The smaller pieces, longest first, then best-fit the gaps that remain; a new bin
opens only when no gap is wide enough.

All pieces of one length are interchangeable, so the plan is made on the
histogram of lengths (``capacity`` numbers, whatever the corpus): it moves whole
ranges of equal bins at once and yields placement rules "items i0.. of length s
go to bins b0.., q to a bin, from offset o". A step either uses up a length or
fills a range of bins below the length at hand; a gap at least halves whenever
its range is filled and a length splits at most one range, so the rules number at most
about (2 + log2 capacity) * 2 * capacity, which bounds what is broadcast.
Every piece finds its place from its rank among the pieces of its length:
the rank in its task plus the count in earlier tasks, so no task ever sees all
pieces of a length.

Edge cases: a null or empty text is one piece that holds just the end id; equal
rows are packed each on its own; null ids are kept; an empty table gives no rows.
"""

from __future__ import annotations

import os
import zlib
from bisect import bisect_left, insort
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import LOWER, Numbers, byte_class, rows_of, runs, span_hashes, stored

CAPACITY = 2048
END_ID = 0
CACHE_WORDS = 800_000

SOLID = byte_class(lambda b: b not in b" \n\t\r")
CLOSING = byte_class(lambda b: b in b".,")
ENDS_WORD = byte_class(lambda b: 97 <= b <= 122 or 48 <= b <= 57)


class WordTokenizer:
    """Ids of texts by a public tokenizer whose words never span white space.

    The tokenizer lower-cases, drops white space and keeps letters apart from
    punctuation before it merges, so a text's ids are the ids of its
    blank-separated chunks in turn, and a closing ``.`` or ``,`` after an ASCII letter
    or digit is a chunk of its own. A run of documents is cut into chunks at once;
    each distinct chunk is looked up by a 64-bit hash in a bounded table of
    ids, which the tasks of one worker process share. Chunks over ``LONG`` bytes
    stay out of the table.
    """

    LONG = 64
    _shared: dict[str, "WordTokenizer"] = {}

    @classmethod
    def of(cls, path: str) -> "WordTokenizer":
        if path not in cls._shared:
            cls._shared[path] = cls(path)
        return cls._shared[path]

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs the tasks side by side already
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.closes_word = np.zeros(max(vocabulary.values()) + 1, bool)
        self.closes_word[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.clear()

    def clear(self) -> None:
        self.number = Numbers()
        self.learnt = 0
        self.flat = np.zeros(1 << 16, np.uint32)
        self.start = np.zeros(1 << 16, np.int64)  # chunk k has ids flat[start[k]:start[k + 1]]

    def _encode_chunks(self, chunks: list[str]) -> list[list[int]]:
        one_by_one = lambda part: [e.ids for e in self.tokenizer.encode_batch_fast(part, add_special_tokens=False)]
        if not all(c.isalpha() for c in chunks):
            return one_by_one(chunks)
        # all letters: one word each, whose last id tells where it ends
        ids = self.tokenizer.encode_batch_fast([" ".join(chunks)], add_special_tokens=False)[0].ids
        ends = (np.flatnonzero(self.closes_word[ids]) + 1).tolist()
        if len(ends) != len(chunks):
            return one_by_one(chunks)
        return [ids[a:b] for a, b in zip([0, *ends], ends)]

    def learn(self, chunks: list[str]) -> None:
        """Append the ids of these chunks, numbered from ``learnt`` on."""
        ids: list[list[int]] = [[]] * len(chunks)
        for plain in (True, False):
            some = [i for i, c in enumerate(chunks) if c.isalpha() == plain]
            for a in range(0, len(some), 256):
                for i, x in zip(some[a:a + 256], self._encode_chunks([chunks[i] for i in some[a:a + 256]])):
                    ids[i] = x
        n, self.learnt = self.learnt, self.learnt + len(chunks)
        ends = self.start[n] + np.cumsum([len(x) for x in ids])
        while len(self.start) <= self.learnt:
            self.start = np.concatenate([self.start, np.zeros_like(self.start)])
        while len(self.flat) < ends[-1]:
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        self.flat[self.start[n]:ends[-1]] = np.fromiter(chain.from_iterable(ids), np.uint32)
        self.start[n + 1:self.learnt + 1] = ends

    def encode(self, buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all documents of a run, and where each document's begin and end."""
        docs = len(off) - 1
        if len(self.number) > CACHE_WORDS:
            self.clear()
        solid = SOLID[buf]
        cut = np.zeros(len(buf) + 1, bool)  # a chunk cannot go on over these places
        cut[off[:-1]] = True
        if b"<|" not in buf.tobytes():  # the strings of special tokens are told by case
            buf = LOWER[buf]
            closing = CLOSING[buf[1:]] & ENDS_WORD[buf[:-1]]
            closing[:-1] &= ~solid[2:]
            cut[1:-1] |= closing
        joins = solid[1:] & solid[:-1] & ~cut[1:-1] if len(buf) else solid
        starts = np.flatnonzero(solid & ~np.concatenate([[False], joins])) if len(buf) else np.zeros(0, np.int64)
        ends = np.flatnonzero(solid & ~np.concatenate([joins, [False]])) + 1 if len(buf) else starts
        keys = span_hashes(buf, starts, ends)
        raw = buf.tobytes()
        text_of = lambda i: raw[starts[i]:ends[i]].decode()
        uniq, first, place = np.unique(keys, return_index=True, return_inverse=True)
        far = ends[first] - starts[first] > self.LONG
        known = np.zeros(len(uniq), np.int64)
        known[~far] = np.fromiter(map(self.number.__getitem__, uniq[~far].tolist()), np.int64)
        if self.number.new:
            new, self.number.new = np.array(self.number.new, np.uint64), []
            self.learn([text_of(i) for i in first[np.searchsorted(uniq, new)]])
        k = known[place]
        s = self.start[k]
        n = self.start[k + 1] - s
        if far.any():  # their ids follow the table's
            long = np.flatnonzero(ends - starts > self.LONG)
            ids = [self._encode_chunks([text_of(i)])[0] for i in long]
            n[long] = [len(x) for x in ids]
            s[long] = len(self.flat) + np.cumsum(n[long]) - n[long]
            table = np.concatenate([self.flat, np.fromiter(chain.from_iterable(ids), np.uint32)])
        else:
            table = self.flat
        after = np.cumsum(n)
        total = int(after[-1]) if len(after) else 0
        ids = table[np.repeat(s - (after - n), n) + np.arange(total)]
        of_doc = np.searchsorted(starts, off)
        return ids, np.concatenate([[0], after])[of_doc[:docs + 1]]


PIECES = [("piece", T.IntegerType()), ("start", T.LongType()), ("length", T.LongType()), ("ids_crc32", T.LongType())]


def token_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID,
                 id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False) -> DataFrame:
    """Pieces of each document, with ``block`` (the task) and ``rank`` (number
    among the pieces of this length in the block). ``keep_ids`` adds the ids."""
    fields = [T.StructField(id_col, docs.schema[id_col].dataType), *[T.StructField(n, t) for n, t in PIECES]]
    fields += [T.StructField("ids", T.ArrayType(T.IntegerType()))] if keep_ids else []
    schema = T.StructType([*fields, T.StructField("block", T.IntegerType()), T.StructField("rank", T.LongType())])

    def work(batches):
        from pyspark.sql.pandas.types import to_arrow_schema
        arrow = to_arrow_schema(schema)
        encoder = WordTokenizer.of(tokenizer_path)
        block, used = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for batch in batches:
            row, piece, start, length, crc, ids, rank = [], [], [], [], [], [], []
            for a, b, buf, off in runs(batch.column(1)):
                tokens, at = encoder.encode(buf, off)
                for d in range(b - a):
                    own = np.append(tokens[at[d]:at[d + 1]], np.uint32(end_id)).astype("<u4")
                    for p, x in enumerate(range(0, len(own), capacity)):
                        cut = own[x:x + capacity]
                        row.append(a + d), piece.append(p), start.append(x), length.append(len(cut))
                        crc.append(zlib.crc32(cut.tobytes()))
                        rank.append(int(used[len(cut)]))
                        used[len(cut)] += 1
                        if keep_ids:
                            ids.append(cut.astype(np.int32))
            data = [rows_of(batch.column(0)).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                    pa.array(length, pa.int64()), pa.array(crc, pa.int64()), *([pa.array(ids, pa.list_(pa.int32()))] if keep_ids else []),
                    pa.array([block] * len(row), pa.int32()), pa.array(rank, pa.int64())]
            yield pa.RecordBatch.from_arrays([d.cast(f.type) for d, f in zip(data, arrow)], schema=arrow)

    return docs.select(id_col, F.col(text_col).cast("string")).mapInArrow(work, schema)


def plan_bins(counts: np.ndarray, capacity: int = CAPACITY) -> np.ndarray:
    """Placement rules (length, first item, items, first bin, items to a bin,
    offset in the bin) for ``counts[s]`` pieces of each length s."""
    rules: list[tuple[int, int, int, int, int, int]] = []
    left = counts.astype(np.int64).copy()
    taken = np.zeros(capacity + 1, np.int64)
    bins = 0
    gaps: dict[int, list[tuple[int, int]]] = {}  # gap -> ranges (first bin, bins)

    def place(s: int, items: int, first_bin: int, per_bin: int, offset: int) -> None:
        rules.append((s, int(taken[s]), items, first_bin, per_bin, offset))
        taken[s] += items
        left[s] -= items

    # large pieces: the longest with the longest partner that fits
    third = capacity // 3
    for s in range(capacity, third, -1):
        while left[s]:
            top = min(capacity - s, s)
            while top > third and not (left[top] >= (2 if top == s else 1)):
                top -= 1
            if top <= third:
                n = int(left[s])
                place(s, n, bins, 1, 0)
                gaps.setdefault(capacity - s, []).append((bins, n))
            else:
                n = int(left[s] // 2 if top == s else min(left[s], left[top]))
                place(s, n, bins, 1, 0)
                place(top, n, bins, 1, s)
                gaps.setdefault(capacity - s - top, []).append((bins, n))
            bins += n

    # small pieces: the narrowest gap that fits, a range of equal bins at a time
    open_gaps = sorted(gaps)
    for s in range(third, 0, -1):
        while left[s]:
            at = bisect_left(open_gaps, s)
            if at == len(open_gaps):
                per = capacity // s
                n = int(-(-left[s] // per))
                gaps.setdefault(capacity, []).append((bins, n))
                bins += n
                open_gaps.append(capacity)
            else:
                gap = open_gaps[at]
                first, n = gaps[gap].pop()
                if not gaps[gap]:
                    del gaps[gap], open_gaps[at]
                per = gap // s
                full = int(min(n, left[s] // per))
                back = []
                if full:
                    place(s, full * per, first, per, capacity - gap)
                    back.append((gap - per * s, first, full))
                rest = n - full
                if rest and left[s]:  # fewer than fill one bin
                    few = int(left[s])
                    place(s, few, first + full, few, capacity - gap)
                    back.append((gap - few * s, first + full, 1))
                    full += 1
                    rest -= 1
                if rest:
                    back.append((gap, first + full, rest))
                for g, f, k in back:
                    if g:
                        if g not in gaps:
                            insort(open_gaps, g)
                        gaps.setdefault(g, []).append((f, k))
    return np.array(rules, np.int64).reshape(-1, 6)


def pack(spark: SparkSession, docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY,
         end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False) -> DataFrame:
    """Every piece with ``sequence_id`` and ``offset``; sequences are gapless from offset 0."""
    pieces = stored(spark, token_pieces(docs, tokenizer_path, capacity, end_id, id_col, text_col, keep_ids), "pieces")
    per_block = pieces.groupBy("length", "block").agg((F.max("rank") + 1).alias("n"))
    # at most `capacity` rows reach the driver
    counts = np.zeros(capacity + 1, np.int64)
    for r in per_block.groupBy("length").agg(F.sum("n").alias("n")).collect():
        counts[r["length"]] = r["n"]
    rules = plan_bins(counts, capacity)
    rules = rules[np.lexsort((rules[:, 1], rules[:, 0]))]
    order = Window.partitionBy("length").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    before = per_block.select("length", "block", F.coalesce(F.sum("n").over(order), F.lit(0)).alias("before"))
    ranked = pieces.join(before, ["length", "block"]).withColumn("rank", F.col("rank") + F.col("before"))
    shown = [c for c in pieces.columns if c not in ("block", "rank")]
    ranked = ranked.select(*shown, "rank")
    schema = T.StructType([*ranked.schema.fields[:-1], T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    shared = spark.sparkContext.broadcast(rules)

    def work(batches):
        rules = shared.value
        from pyspark.sql.pandas.types import to_arrow_schema
        arrow = to_arrow_schema(schema)
        wide = int(rules[:, 1].max(initial=0)) + int(rules[:, 2].max(initial=0)) + 1
        keys = rules[:, 0] * wide + rules[:, 1]
        for batch in batches:
            s = batch.column("length").to_numpy(zero_copy_only=False)
            i = batch.column("rank").to_numpy(zero_copy_only=False)
            r = rules[np.searchsorted(keys, s * wide + i, "right") - 1]
            k = i - r[:, 1]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(r[:, 3] + k // r[:, 4]), pa.array(r[:, 5] + k % r[:, 4] * s)], schema=arrow)

    return ranked.mapInArrow(work, schema)
