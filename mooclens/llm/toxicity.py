"""Toxicity scores from subword-bag embeddings (operator 1).

A word is the bag of its character n-grams (with its boundaries marked) and
itself, hashed into a fixed number of embedding rows; a document is the average of
its words' averages, and a linear softmax on that average gives the score.
Embeddings and softmax are trained jointly in numpy, on the driver, on at most
``sample`` labelled documents; an unseen misspelling shares most n-grams with its
model and scores alike. A trained model is one number per embedding row, so tasks score
whole texts in one vectorised pass; nothing is shuffled.

Edge cases: a null or empty text, or one without words, gets the model's prior;
a null label is no label, of repeated labels the highest counts; without any
labelled document every score is 0; equal texts get equal scores; other columns
are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ALNUM_WORD, LOWER, RUN_BYTES, Numbers, mix, runs, span_hashes, word_spans

SAMPLE = 8000  # labelled documents that reach the driver, at most
GRAMS = (3, 4, 5)
BUCKETS = 1 << 17
DIM = 4
EPOCHS = 14
BATCH = 64
RATE = 0.01
GAIN = 60.0  # of the average: a telling word is one in fifty or so
DECAY = 1e-5
CACHE_WORDS = 250_000


@dataclass(frozen=True)
class Model:
    weight: np.ndarray  # one float32 per bucket: its embedding times the softmax's difference, times the gain
    bias: float


class Scorer:
    """Scores runs of documents; keeps the weight of words met before, by a 64-bit hash."""

    def __init__(self, model: Model):
        self.model = model
        self.clear()

    def clear(self) -> None:
        self.number, self.known = Numbers(), np.zeros(0)

    def score(self, buf: np.ndarray, off: np.ndarray) -> np.ndarray:
        if len(self.number) > CACHE_WORDS:
            self.clear()
        starts, ends, doc = word_spans(buf, off, ALNUM_WORD)
        low = LOWER[buf]
        uniq, first, place = np.unique(span_hashes(low, starts, ends), return_index=True, return_inverse=True)
        number = np.fromiter(map(self.number.__getitem__, uniq.tolist()), np.int64, len(uniq))
        if self.number.new:
            new, self.number.new = np.array(self.number.new, np.uint64), []
            at = first[np.searchsorted(uniq, new)]
            size = ends[at] - starts[at]
            own = np.concatenate([[0], np.cumsum(size)])
            words = low[np.repeat(starts[at] - own[:-1], size) + np.arange(own[-1])]
            self.known = np.concatenate([self.known, Bags(words, own).weigh(self.model.weight)])
        n = len(off) - 1
        mean = np.bincount(doc, self.known[number][place], n) / np.maximum(np.bincount(doc, minlength=n), 1)
        return 1.0 / (1.0 + np.exp(-np.clip(self.model.bias + mean, -60, 60)))


class Bags:
    """The subword bags of a run of documents."""

    def __init__(self, buf: np.ndarray, off: np.ndarray):
        starts, ends, self.doc = word_spans(buf, off, ALNUM_WORD)
        self.docs = len(off) - 1
        keep = ALNUM_WORD[buf]
        # every word as <word>: two marks around its lower-cased bytes
        width = keep.astype(np.int64)
        width[starts] += 1
        width[ends - 1] += 1
        after = np.cumsum(width)
        self.first = after[starts] - width[starts]
        self.end = after[ends - 1]
        pad = np.full(int(after[-1]) if len(after) else 0, 62, np.uint8)
        pad[self.first] = 60
        place = after - width
        place[starts] += 1
        pad[place[keep]] = LOWER[buf[keep]]
        self.pad = pad.astype(np.uint64)
        self.grams = sum(np.maximum(self.end - self.first - n + 1, 0) for n in GRAMS) + 1
        self.words = np.bincount(self.doc, minlength=self.docs)

    def buckets(self):
        """Per n-gram size: (place in the padded words, bucket) of the grams that lie in one word."""
        size = len(self.pad)
        last = np.repeat(self.end, self.end - self.first)  # end of the word at each place
        base = np.uint64(0x100000001B3)
        code = np.zeros(size, np.uint64)
        done = 0
        for n in GRAMS:
            for j in range(done, n):
                code[:size - j] = code[:size - j] * base + self.pad[j:] + np.uint64(1)
            done = n
            at = np.flatnonzero(np.arange(n, size + n) <= last)
            yield at, (mix(code[at] + np.uint64(n)) & np.uint64(BUCKETS - 1)).astype(np.int64)
        powers = np.multiply.accumulate(np.full(size + 1, 0x9E3779B97F4A7C15, np.uint64))
        sums = np.concatenate([[np.uint64(0)], np.cumsum((self.pad + np.uint64(1)) * powers[:size])])
        # the word itself: position-free, so its sum is brought back to the first power
        inverse = np.multiply.accumulate(np.full(size + 1, pow(0x9E3779B97F4A7C15, -1, 1 << 64), np.uint64))
        word = (sums[self.end] - sums[self.first]) * inverse[self.first]
        yield self.first, (mix(word) & np.uint64(BUCKETS - 1)).astype(np.int64)

    def weigh(self, weight: np.ndarray) -> np.ndarray:
        """Per document, the mean over its words of the mean weight of their grams."""
        total = np.zeros(len(self.pad) + 1)
        for at, bucket in self.buckets():
            total[at] += weight[bucket]
        sums = np.concatenate([[0.0], np.cumsum(total[:-1])])
        per_word = (sums[self.end] - sums[self.first]) / self.grams
        return np.bincount(self.doc, per_word, self.docs) / np.maximum(self.words, 1)

    def rows(self):
        """Sparse rows: (document, bucket, weight), one entry per document and bucket."""
        word = np.repeat(np.arange(len(self.first)), self.end - self.first)
        key, val = [], []
        for at, bucket in self.buckets():
            w = word[at]
            key.append(self.doc[w] * BUCKETS + bucket)
            val.append(1.0 / (self.grams[w] * self.words[self.doc[w]]))
        key, val = np.concatenate(key), np.concatenate(val)
        order = np.argsort(key, kind="stable")
        key, val = key[order], val[order]
        cut = np.flatnonzero(np.diff(key, prepend=-1))
        return key[cut] // BUCKETS, key[cut] % BUCKETS, np.add.reduceat(val, cut).astype(np.float32) if len(cut) else val


def train(texts: pa.Array, toxic: np.ndarray, epochs: int = EPOCHS) -> Model:
    """Joint fit of embeddings and softmax by Adam on the log loss; deterministic."""
    if not len(toxic):
        return Model(np.zeros(BUCKETS, np.float32), -60.0)
    bucket, value = [], []  # per document
    for a, b, buf, off in runs(texts, RUN_BYTES // 2):
        d, k, v = Bags(buf, off).rows()
        cut = np.searchsorted(d, np.arange(1, b - a))
        bucket += np.split(k.astype(np.int32), cut)
        value += np.split(v.astype(np.float32), cut)
    rng = np.random.default_rng(7)
    share = np.clip(toxic.mean(), 1e-3, 1 - 1e-3)
    embed = rng.normal(0, 0.1, (DIM, BUCKETS)).astype(np.float32)
    soft = rng.normal(0, 0.5, (2, DIM)).astype(np.float32)
    bias = np.array([np.log(1 - share), np.log(share)], np.float32)
    params = [embed, soft, bias]
    m1, m2, step = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    for epoch in range(epochs):
        order = rng.permutation(len(toxic))
        rate = RATE * (1 - epoch / epochs)
        for a in range(0, len(order), BATCH):
            pick = order[a:a + BATCH]
            row = np.repeat(np.arange(len(pick)), [len(bucket[i]) for i in pick])
            b = np.concatenate([bucket[i] for i in pick])
            v = np.concatenate([value[i] for i in pick]) * np.float32(GAIN)
            mean = np.stack([np.bincount(row, embed[k][b] * v, len(pick)) for k in range(DIM)], 1).astype(np.float32)
            z = mean @ soft.T + bias
            z -= z.max(1, keepdims=True)
            p = np.exp(z)
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(pick)), toxic[pick]] -= 1
            p /= len(pick)
            back = p @ soft
            grads = [np.stack([np.bincount(b, back[row, k] * v, BUCKETS) for k in range(DIM)]).astype(np.float32) + DECAY * embed,
                     p.T @ mean, p.sum(0)]
            step += 1
            for w, g, x, y in zip(params, grads, m1, m2):
                x += 0.1 * (g - x)
                y += 0.001 * (g * g - y)
                w -= rate * (x / (1 - 0.9 ** step)) / (np.sqrt(y / (1 - 0.999 ** step)) + 1e-8)
    diff = soft[1] - soft[0]
    return Model((GAIN * (diff @ embed)).astype(np.float32), float(bias[1] - bias[0]))


def held_out(id_col: Column) -> Column:
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit(""))) % 5 == 0


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic") -> Model:
    """Train on at most ``sample`` labelled documents outside the held-out fold, picked by a hash of the id."""
    known = labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(F.col(id_col)))
    known = known.groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).cast("int").alias("toxic"))
    known = known.orderBy(F.xxhash64("id"), "id").limit(sample)
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    got = texts.join(known, "id").groupBy("id", "toxic").agg(F.min("text").alias("text")).sort("id").toArrow()
    return train(got.column("text").combine_chunks() if got.num_rows else pa.array([], pa.string()),
                 np.clip(np.array(got.column("toxic"), np.int64), 0, 1))


def toxicity(spark: SparkSession, docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``row`` (the input row, untouched) and its ``score``."""
    schema = T.StructType([T.StructField("row", docs.schema), T.StructField("score", T.DoubleType())])
    shared = spark.sparkContext.broadcast((model.weight, model.bias))  # BUCKETS numbers

    def work(batches):
        scorer = Scorer(Model(*shared.value))
        for batch in batches:
            score = np.zeros(batch.num_rows)
            for a, b, buf, off in runs(batch.column(1)):
                score[a:b] = scorer.score(buf, off)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score)], names=["row", "score"])

    return docs.select(F.struct("*").alias("row"), F.col(text_col).cast("string")).mapInArrow(work, schema)


def drop_toxic(spark: SparkSession, docs: DataFrame, labels: DataFrame, training: DataFrame, threshold: float = 0.5, **columns) -> DataFrame:
    """The rows of ``docs``, all columns, that score below ``threshold``; the model learns from ``training``."""
    model = fit(training, labels, **columns)
    return toxicity(spark, docs, model, columns.get("text_col", "text")).filter(F.col("score") < threshold).select("row.*")


def toxicity_digest(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The columns of ``op1_toxicity``."""
    scored = toxicity(spark, docs.select("doc_id", "text"), fit(docs, labels))
    ident = F.col("row.doc_id")
    return scored.select(ident.alias("doc_id"), held_out(ident).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
