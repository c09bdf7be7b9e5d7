"""SimHash near-duplicates by bit-sliced comparison (operator 6).

Fingerprints: a bit is set if it is set in over half of the XXH64 hashes (seed
42) of a text's word shingles. Equal fingerprints collapse to one row first.

Links at most ``radius`` bits apart are found without comparing all pairs: the 64 bits
are cut into ``radius + spare`` fields (``spare`` grows with the corpus); two linked
fingerprints agree in at least ``spare`` whole fields, so each choice of ``spare``
fields is a table whose equal-keyed fingerprints form a bucket. A bucket is cut into blocks of ``BLOCK``
fingerprints by a hash of the fingerprint, and each pair of blocks is a task unit of
its own, so a bucket that holds a third of all rows spreads out. In a unit one
block is stored as 64 vertical bit planes: a query is compared with 64
candidates per machine word, plane by plane, adding the differing bits into a
carry-save counter; once every candidate has passed the radius the rest of the
planes is abandoned. A unit returns a spanning forest of its links, at most one
link per fingerprint and not all pairs.

Edge cases: a null or empty text has fingerprint zero and links like any other;
a null id belongs to its component but cannot name it; components of null ids
alone get null; equal rows stay equal rows.
"""

from __future__ import annotations

from itertools import chain, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import BLACK_WORD, LOWER, runs, stored, word_spans
from .components import components

SHINGLE = 4
RADIUS = 4
SEED = 42
BLOCK = 1024

U1 = np.uint64(1)


def fingerprint(words: bytes, starts, ends, shingle: int = SHINGLE) -> int:
    """SimHash of the words at these places of a space-joined text."""
    n = len(starts)
    if not n:
        return 0
    k = min(shingle, n)
    view = memoryview(words)
    h64 = xxhash.xxh64_intdigest
    hashes = np.array([h64(view[a:b], SEED) for a, b in zip(starts[:n - k + 1], ends[k - 1:])], "<u8")
    ones = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, text_col: str = "text") -> DataFrame:
    """``row`` (the input row, untouched), its number ``rid`` and its 64-bit ``fp`` (as a signed long)."""
    schema = T.StructType([T.StructField("row", docs.schema), T.StructField("rid", T.LongType()), T.StructField("fp", T.LongType())])

    def work(batches):
        from pyspark.sql.pandas.types import to_arrow_schema
        arrow = to_arrow_schema(schema)
        rid = TaskContext.get().partitionId() << 40
        for batch in batches:
            fps = np.zeros(batch.num_rows, np.uint64)
            for a, b, buf, off in runs(batch.column(1)):
                starts, ends, doc = word_spans(buf, off, BLACK_WORD)
                # the words, lower-cased, with one blank after each
                keep = BLACK_WORD[buf]
                width = keep.astype(np.int64)
                width[ends - 1] = 2
                at = np.cumsum(width) - width
                joined = np.full(int(width.sum()), 32, np.uint8)
                joined[at[keep]] = LOWER[buf[keep]]
                text, s, e = joined.tobytes(), at[starts].tolist(), (at[ends - 1] + 1).tolist()
                cut = np.searchsorted(doc, np.arange(b - a + 1))
                for d in range(b - a):
                    fps[a + d] = fingerprint(text, s[cut[d]:cut[d + 1]], e[cut[d]:cut[d + 1]], shingle)
            rids = pa.array(np.arange(rid, rid + batch.num_rows))
            rid += batch.num_rows
            yield pa.RecordBatch.from_arrays([batch.column(0), rids, pa.array(fps.view(np.int64))], schema=arrow)

    return docs.select(F.struct("*").alias("row"), F.col(text_col).cast("string")).mapInArrow(work, schema)


def bit_planes(fps: np.ndarray) -> np.ndarray:
    """64 rows, one per bit; bit j of word i of a row belongs to fingerprint 64 i + j."""
    bits = np.unpackbits(fps.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    pad = -len(fps) % 64
    if pad:
        bits = np.vstack([bits, np.zeros((pad, 64), np.uint8)])
    return np.packbits(bits.T.copy(), axis=1, bitorder="little").view("<u8")


def near(queries: np.ndarray, block: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs (query, block) at most ``radius`` differing bits apart."""
    planes, n = bit_planes(block), len(block)
    digits = max(1, int(radius + 1).bit_length())
    limit = radius + 1  # a counter that reached this many is out for good
    out_q, out_b = [], []
    width = planes.shape[1]
    full = np.full(width, np.uint64(0xFFFFFFFFFFFFFFFF))
    if n % 64:
        full[-1] = np.uint64((1 << (n % 64)) - 1)
    flip = np.where((queries[:, None] >> np.arange(64, dtype=np.uint64)) & U1, np.uint64(0xFFFFFFFFFFFFFFFF), np.uint64(0))
    step = max(1, (1 << 18) // max(width, 1))
    for q0 in range(0, len(queries), step):
        live = np.arange(q0, min(q0 + step, len(queries)))
        over = np.broadcast_to(~full, (len(live), width)).copy()
        count = [np.zeros((len(live), width), np.uint64) for _ in range(digits)]
        for p in range(64):
            carry = planes[p] ^ flip[live, p][:, None]
            for d in range(digits):
                carry, count[d] = carry & count[d], carry ^ count[d]
            reached = None  # counters equal to the limit
            for d in range(digits):
                bit = count[d] if limit >> d & 1 else ~count[d]
                reached = bit if reached is None else reached & bit
            over |= reached
            if p % 4 == 3:
                stay = (~over).any(axis=1)
                if not stay.all():
                    live, over = live[stay], over[stay]
                    count = [c[stay] for c in count]
                    if not len(live):
                        break
        if len(live):
            bits = np.unpackbits((~over).view(np.uint8), axis=1, bitorder="little")
            q, b = np.nonzero(bits[:, :n])
            out_q.append(live[q])
            out_b.append(b)
    if not out_q:
        z = np.zeros(0, np.int64)
        return z, z
    return np.concatenate(out_q), np.concatenate(out_b)


def forest(a: np.ndarray, b: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(node, least node of its component) for the nodes 0..n-1 that the pairs touch."""
    label = np.arange(n)
    while len(a):
        m = np.minimum(label[a], label[b])
        np.minimum.at(label, label[a], m)
        np.minimum.at(label, label[b], m)
        while True:
            nxt = label[label]
            if (nxt == label).all():
                break
            label = nxt
        if (label[a] == label[b]).all():
            break
    node = np.flatnonzero(label != np.arange(n))
    return node, label[node]


def field_masks(radius: int, spare: int) -> list[int]:
    """One mask per choice of ``spare`` of the ``radius + spare`` fields of 64 bits."""
    cuts = np.linspace(0, 64, radius + spare + 1).round().astype(int)
    fields = [((1 << int(b)) - (1 << int(a))) for a, b in zip(cuts, cuts[1:])]
    return [sum(c) for c in combinations(fields, spare)]


def spare_fields(n: int, radius: int, block: int) -> int:
    """Fewest fields to agree on that leave a block or less of ``n`` scattered fingerprints to a bucket."""
    spare = 2
    while n >> (64 * spare // (radius + spare)) > block and spare < radius + 4:
        spare += 1
    return spare


def links(spark: SparkSession, fps: DataFrame, radius: int = RADIUS, spare: int | None = None, block: int = BLOCK) -> DataFrame:
    """Links (a, b) whose closure joins exactly the distinct fingerprints ``fp``
    that are reachable by steps of at most ``radius`` bits."""
    spare = spare or spare_fields(fps.count(), radius, block)
    signed = lambda m: m - (1 << 64) if m >> 63 else m
    keyed = fps.select("fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(signed(m)).cast("long"))
                                                    for m in field_masks(radius, spare)])).alias("t", "key"))
    big = keyed.groupBy("t", "key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > block)
    big = stored(spark, big.withColumn("parts", F.ceil(F.col("n") / block)), "buckets")
    # a big bucket: parts by hash and a unit per pair of parts; a row joins one unit per part, on its own side of each
    keyed = keyed.join(big.select("t", "key", "parts"), ["t", "key"], "left")
    part, other = F.pmod(F.xxhash64("fp"), F.col("parts")), F.col("other")
    rows = keyed.select("fp", "t", "key", part.alias("part"), F.explode(
        F.when(F.col("parts").isNull(), F.array(F.lit(None).cast("long"))).otherwise(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))).alias("other"))
    side = F.when(other.isNull() | (F.col("part") == other), 0).when(F.col("part") < other, 1).otherwise(2)
    rows = rows.select("fp", F.xxhash64("t", "key", F.least("part", "other"), F.greatest("part", "other")).alias("unit"), side.alias("side"))

    def work(batches):
        for fp, unit, side in unit_runs(batches, block):
            whole = np.flatnonzero(side == 0)
            found = [np.zeros((2, 0), np.int64)]
            if len(whole) > 1:
                found.append(whole[np.stack(near(fp[whole], fp[whole], radius))])
            for u in np.unique(unit[side > 0]):
                one, two = (np.flatnonzero((unit == u) & (side == k)) for k in (1, 2))
                if len(one) and len(two):
                    q, b = near(fp[one], fp[two], radius)
                    found.append(np.stack([one[q], two[b]]))
            node, root = forest(*np.concatenate(found, axis=1), len(fp))
            yield pa.RecordBatch.from_arrays([pa.array(fp[node].view(np.int64)), pa.array(fp[root].view(np.int64))], names=["a", "b"])

    return rows.repartition("unit").sortWithinPartitions("unit").mapInArrow(work, "a long, b long")


def unit_runs(batches, block: int):
    """Whole units of a task's sorted rows, neighbours together up to about a
    block: (fp, unit, side). Pairs across the units of a run are real links too."""
    rest = [np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int32)]
    for batch in chain(batches, [None]):
        if batch is not None:
            new = [batch.column(k).to_numpy(zero_copy_only=False) for k in ("fp", "unit", "side")]
            rest = [np.concatenate([r, x.view(np.uint64) if i == 0 else x]) for i, (r, x) in enumerate(zip(rest, new))]
        unit = rest[1]
        ends = np.append(np.flatnonzero(np.diff(unit)) + 1, len(unit)) if len(unit) else np.zeros(0, np.int64)
        if batch is not None:
            ends = ends[:-1]  # the last unit may go on in the next batch
        at = 0
        while len(ends) and at < ends[-1]:
            k = int(np.searchsorted(ends, at + block, "right")) - 1
            end = int(ends[k]) if k >= 0 and ends[k] > at else int(ends[np.searchsorted(ends, at, "right")])
            yield tuple(r[at:end] for r in rest)
            at = end
        rest = [r[at:] for r in rest]


def _grouped(spark: SparkSession, docs: DataFrame, shingle: int, radius: int, id_col: str, text_col: str, whole_rows: bool):
    """(stored rows with fp, table of fp -> component fp and id)."""
    rows = fingerprints(docs, shingle, text_col)
    if not whole_rows:
        rows = rows.select(F.col(f"row.`{id_col}`").alias("id"), "rid", "fp")
    rows = stored(spark, rows, "fingerprints")
    ident = F.col(f"row.`{id_col}`") if whole_rows else F.col("id")
    distinct = stored(spark, rows.groupBy("fp").agg(F.min(ident).alias("id"), F.count(F.lit(1)).alias("n")), "distinct")
    comp = components(spark, links(spark, distinct.select("fp"), radius))
    each = distinct.join(comp.withColumnRenamed("node", "fp"), "fp", "left")
    each = each.select("fp", "id", F.coalesce("component", "fp").alias("component"))
    least = each.groupBy("component").agg(F.min("id").alias("component_id"))
    return rows, stored(spark, each.select("fp", "component").join(least, "component"), "groups")


def near_duplicates(spark: SparkSession, docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row's id with ``fp``, the component's fingerprint and ``component_id``, its least id."""
    rows, groups = _grouped(spark, docs, shingle, radius, id_col, text_col, False)
    return rows.join(groups, "fp", "left").select(F.col("id").alias(id_col), "fp", "component", "component_id")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS,
                         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each component, with all columns of ``docs``: the row of the
    least id (nulls last), the first in the input's order among equal ids."""
    rows, groups = _grouped(spark, docs, shingle, radius, id_col, text_col, True)
    ident = F.col(f"row.`{id_col}`")
    narrow = rows.select(ident.alias("id"), "rid", "fp").join(groups, "fp")
    keep = narrow.groupBy("component").agg(F.min(F.struct(F.col("id").isNull(), "id", "rid"))["rid"].alias("rid"))
    return rows.join(keep.select("rid"), "rid", "left_semi").select("row.*")


def simhash_digest(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The columns of ``op6_simhash_near_dedup``."""
    return near_duplicates(spark, docs).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
