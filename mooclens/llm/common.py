"""Shared helpers of the training-data operators.

Python stages run as Arrow maps: Spark partitions the rows, and inside a task a
batch is cut into runs of whole documents of about ``RUN_BYTES`` of text, so the
numpy temporaries of a task stay bounded whatever the batch size is. Texts are
handled as the UTF-8 bytes that Arrow already holds; word classes are byte
classes, since every class used here either holds all bytes above 0x7F or none.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mooclens.session import checkpoint_dir

RUN_BYTES = 1 << 20
PAGE_BITS = 16  # pages of a table of bits: 2^16 of 2^11 bits each, 16 MB at most
PAGE_FILES = 8  # that they are stored in, whatever the number of shuffle partitions

_ODD = 0x9E3779B97F4A7C15  # base of the polynomial hash; odd, so it has an inverse mod 2^64
_ODD_INV = pow(_ODD, -1, 1 << 64)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def byte_class(inside) -> np.ndarray:
    return np.array([bool(inside(b)) for b in range(256)])


ALNUM_WORD = byte_class(lambda b: b >= 0x80 or 48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122)
BLACK_WORD = byte_class(lambda b: b != 0x20 and not 9 <= b <= 13)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(spark: SparkSession, df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends there,
    and a lost executor costs a re-read, not a recomputation."""
    path = f"{checkpoint_dir(spark)}/llm/{name}-{uuid.uuid4().hex}"
    w = df.write.option("compression", "zstd")
    (w.partitionBy(partition_by) if partition_by else w).parquet(path)
    return spark.read.schema(df.schema).parquet(path) if not partition_by else spark.read.parquet(path)


def text_key(text: Column) -> Column:
    """128-bit key of a text (null counts as empty); equal texts share it."""
    return F.unhex(F.md5(F.coalesce(text, F.lit(""))))


def rows_of(arr) -> pa.Array:
    return arr.combine_chunks() if isinstance(arr, pa.ChunkedArray) else arr


def runs(text: pa.Array, limit: int = RUN_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut a text column into runs of whole documents: (first row, end row,
    bytes of the run, document offsets in them). Null texts are empty."""
    text = rows_of(text)
    if text.null_count:
        text = text.fill_null("")
    n = len(text)
    if not n:
        return
    wide = pa.types.is_large_string(text.type) or pa.types.is_large_binary(text.type)
    bufs = text.buffers()
    off = np.frombuffer(bufs[1], np.int64 if wide else np.int32)[text.offset:text.offset + n + 1].astype(np.int64)
    data = np.frombuffer(bufs[2], np.uint8) if bufs[2] is not None else np.zeros(0, np.uint8)
    a = 0
    while a < n:
        b = max(a + 1, int(np.searchsorted(off, off[a] + limit, "right")) - 1)
        yield a, b, data[off[a]:off[b]], off[a:b + 1] - off[a]
        a = b


def word_spans(buf: np.ndarray, off: np.ndarray, inside: np.ndarray):
    """Words of every document of a run: byte starts, byte ends, document index."""
    m = inside[buf]
    if not m.any():
        z = np.zeros(0, np.int64)
        return z, z, z
    edge = off[:-1][off[:-1] < off[1:]]
    before = np.empty_like(m)
    before[1:] = m[:-1]
    before[edge] = False
    after = np.empty_like(m)
    after[:-1] = m[1:]
    after[np.append(edge[1:], len(m)) - 1] = False
    starts = np.flatnonzero(m & ~before)
    ends = np.flatnonzero(m & ~after) + 1
    return starts, ends, np.searchsorted(off, starts, "right") - 1


_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse, mod 2^64, at least ``n``."""
    if len(_powers[0]) < n:
        n = max(n, RUN_BYTES)
        for k, base in enumerate((_ODD, _ODD_INV)):
            p = np.full(n, base, np.uint64)
            p[0] = 1
            _powers[k] = np.multiply.accumulate(p)
    return _powers[0], _powers[1]


def mix(h: np.ndarray) -> np.ndarray:
    """Finalizer that spreads a polynomial hash over all 64 bits (in place)."""
    h ^= h >> np.uint64(30)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def prefix_sums(values: np.ndarray) -> np.ndarray:
    up, _ = powers(len(values) + 1)
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[:len(values)], out=out[1:])
    return out


def span_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span of ``buf``."""
    sums = prefix_sums(buf.astype(np.uint64) + np.uint64(1))
    _, down = powers(len(buf) + 1)
    return mix((sums[ends] - sums[starts]) * down[starts])


def gram_hashes(items: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of ``k`` neighbours of a sequence of 64-bit hashes."""
    if len(items) < k:
        return np.zeros(0, np.uint64)
    sums = prefix_sums(items)
    _, down = powers(len(items) + 1)
    n = len(items) - k + 1
    return mix((sums[k:] - sums[:n]) * down[:n])


def sliding(h: np.ndarray, w: int, fold=np.minimum) -> np.ndarray:
    """Minimum (or other idempotent fold) of each window of ``w`` neighbours, by doubling."""
    if len(h) < w:
        return h[:0]
    m, width = h, 1
    while width * 2 <= w:
        m = fold(m[:-width], m[width:])
        width *= 2
    rest = w - width
    return fold(m[:len(m) - rest], m[rest:]) if rest else m


class Numbers(dict):
    """Numbers of keys in order of appearance; ``new`` gathers those not seen before."""

    def __init__(self):
        super().__init__()
        self.new: list[int] = []

    def __missing__(self, key: int) -> int:
        self.new.append(key)
        number = self[key] = len(self)
        return number


def bit_pages(spark: SparkSession, hashes: DataFrame) -> DataFrame:
    """A table of bits over the column ``h``: at most 2^PAGE_BITS rows (page, bits as 32 longs)."""
    h = F.col("h")
    bits = hashes.select(F.shiftrightunsigned(h, 64 - PAGE_BITS).alias("page"), F.shiftrightunsigned(h, 58 - PAGE_BITS).bitwiseAND(31).cast("int").alias("word"),
                         F.expr(f"shiftleft(1L, cast(shiftrightunsigned(h, {52 - PAGE_BITS}) & 63 as int))").alias("bit"))
    words = bits.groupBy("page", "word").agg(F.bit_or("bit").alias("bit"))
    row = [F.coalesce(F.bit_or(F.when(F.col("word") == w, F.col("bit"))), F.lit(0).cast("long")) for w in range(32)]
    return stored(spark, words.groupBy("page").agg(F.array(*row).alias("bits")).coalesce(PAGE_FILES), "bits")


def maybe_in(rows: DataFrame, h, pages: DataFrame) -> DataFrame:
    """The rows whose hash has its bit set; the pages' number and size bound the broadcast."""
    rows = rows.select("*", h.alias("_h")).select("*", F.shiftrightunsigned("_h", 64 - PAGE_BITS).alias("page"))
    word = F.expr(f"bits[cast(shiftrightunsigned(_h, {58 - PAGE_BITS}) & 31 as int)]")
    set_ = word.bitwiseAND(F.expr(f"shiftleft(1L, cast(shiftrightunsigned(_h, {52 - PAGE_BITS}) & 63 as int))")) != 0
    return rows.join(F.broadcast(pages), "page").filter(set_).drop("page", "bits", "_h")
