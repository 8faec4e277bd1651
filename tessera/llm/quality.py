"""Operator 9: a document quality classifier by attention-based multiple-instance learning.

A document is a bag of passages. Each passage is described by its words, whole and by their first and last three
bytes, and by shares of characters and words. One layer encodes it: the mean of learned embeddings of its hashed words
and edges, added to the layer over the shares. Gated attention weights the passages, and the weighted sum of a bag's
encodings gives the document's score. Only document labels are used to learn the weights. Scoring is one narrow pass
with a model of about a hundred kilobytes.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from tessera.llm.common import Words, batches, bounded_batches, byte_texts, crc_mod, documents, mix64

PASSAGE_WORDS = 64
SAMPLE = 2000
THRESHOLD = 0.3
_CLASSES = (b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b"!?", b"#*$%&", b"|", b"<>{}[]/\\@^_~+=`", b".,;:", b"'\"()-", b"\n")
_CLASS_OF = np.full(256, len(_CLASSES), np.uint8)
for _i, _chars in enumerate(_CLASSES):
    _CLASS_OF[np.frombuffer(_chars, np.uint8)] = _i
N_FEATURES = len(_CLASSES) + 10
#: Embeddings are kept for 2 ** BUCKET_BITS hashed words and edges of words; EDGES is what a word gives.
BUCKET_BITS, EDGES = 10, 3
#: Passages whose words are counted in one matrix (4 KB a passage) when texts are scored.
BLOCK = 2048


@dataclass
class Passages:
    """Passages of many texts: shares of each, number of passages of each text, hashed words and number of them in each passage."""

    shares: np.ndarray
    parts: np.ndarray
    buckets: np.ndarray
    sizes: np.ndarray

    def bags(self, dtype: type = np.float32) -> Iterator[np.ndarray]:
        """Shares of the buckets in each passage, ``BLOCK`` passages at a time."""
        width, past = 1 << BUCKET_BITS, np.concatenate(([0], np.cumsum(self.sizes)))
        for at in range(0, len(self.sizes), BLOCK):
            sizes = self.sizes[at : at + BLOCK]
            key = np.repeat(np.arange(len(sizes)) * width, sizes) + self.buckets[past[at] : past[at + len(sizes)]]
            counts = np.bincount(key, minlength=len(sizes) * width).reshape(-1, width)
            yield (counts / np.maximum(sizes, 1)[:, None]).astype(dtype)


def _hashed(words: Words) -> np.ndarray:
    """Buckets of every word, its first and its last three bytes, word by word."""
    back = lambda k: words.data[np.maximum(words.end - k, words.start)].astype(np.uint64)
    last = back(1) | back(2) << np.uint64(8) | back(3) << np.uint64(16)
    keys = np.stack([words.hash, (words.low & np.uint64(0xFFFFFF)) | np.uint64(1 << 24), last | np.uint64(1 << 25)], axis=1)
    return (mix64(keys.reshape(-1)) >> np.uint64(64 - BUCKET_BITS)).astype(np.uint16)


def passages(texts: list[bytes]) -> Passages:
    """All passages of the texts. A text without words is one passage of zeros."""
    words = Words(texts, lower=False)
    n = len(words.start)
    parts = np.maximum(1, -(-words.count // PASSAGE_WORDS))
    first_part = np.cumsum(parts) - parts
    out = np.zeros((int(parts.sum()), N_FEATURES), np.float32)
    sizes, buckets = np.zeros(len(out), np.int64), np.empty(0, np.uint16)
    if n:
        first_word = np.cumsum(words.count) - words.count
        within = np.arange(n) - first_word[words.doc]
        part = first_part[words.doc] + within // PASSAGE_WORDS
        head = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1])))
        rows = part[head]
        per = np.diff(np.append(head, n))
        start, end = words.start[head], words.end[np.append(head[1:], n) - 1]
        sizes[rows], buckets = per * EDGES, _hashed(words)
        size = (end - start).astype(np.float64)
        kinds = _CLASS_OF[words.data]
        for k in range(len(_CLASSES)):
            past = np.concatenate(([0], np.cumsum(kinds == k, dtype=np.int32)))
            out[rows, k] = (past[end] - past[start]) / size
        length = words.end - words.start
        f = len(_CLASSES)
        mean = np.add.reduceat(length, head) / per
        out[rows, f] = np.log(mean)
        out[rows, f + 1] = np.add.reduceat(length <= 3, head, dtype=np.int64) / per
        out[rows, f + 2] = np.add.reduceat(length > 14, head, dtype=np.int64) / per
        tail = _CLASS_OF[words.data[words.end - 1]]
        out[rows, f + 3] = np.add.reduceat((tail == 2) | (tail == 3) | (tail == 4), head, dtype=np.int64) / per
        key = mix64(words.hash + part.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        _, once = np.unique(key, return_index=True)
        out[rows, f + 4] = np.bincount(part[once], minlength=len(out))[rows] / per
        same = np.concatenate(([False], (words.hash[1:] == words.hash[:-1]) & (words.doc[1:] == words.doc[:-1])))
        out[rows, f + 5] = np.add.reduceat(same, head, dtype=np.int64) / per
        again = np.zeros(n, bool)
        if n > 2:
            h = words.hash
            run = mix64(h[:-2] * np.uint64(3) + h[1:-1] * np.uint64(5) + h[2:] * np.uint64(7) + words.doc[:-2].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
            inside = words.doc[:-2] == words.doc[2:]
            order = np.argsort(run, kind="stable")
            equal = run[order][1:] == run[order][:-1]
            again[order[1:][equal]] = True
            again[:-2] &= inside
        out[rows, f + 6] = np.add.reduceat(again, head, dtype=np.int64) / per
        out[rows, f + 7] = per / PASSAGE_WORDS
        out[rows, f + 8] = np.log1p(words.count[words.doc[head]]) / 8
        out[rows, f + 9] = 1
    return Passages(out, parts, buckets, sizes)


@dataclass
class Attention:
    """tanh encoder of shares and embedded words, gated attention (tanh branch times sigmoid branch), logistic output."""

    mean: np.ndarray
    scale: np.ndarray
    w: list[np.ndarray]

    def _forward(self, x: np.ndarray, said: np.ndarray, parts: np.ndarray) -> tuple[np.ndarray, ...]:
        """``said``: the summed embeddings of each passage."""
        w1, b1, v, u, g, c, c0, _ = self.w
        at = np.cumsum(parts) - parts
        bag = np.repeat(np.arange(len(parts)), parts)
        h = np.tanh((x - self.mean) / self.scale @ w1 + said + b1)
        t, s = np.tanh(h @ v), 1 / (1 + np.exp(-h @ u))
        e = (t * s) @ g
        e = np.exp(e - np.maximum.reduceat(e, at)[bag])
        a = e / np.add.reduceat(e, at)[bag]
        z = np.add.reduceat(a[:, None] * h, at)
        return h, t, s, a, z, 1 / (1 + np.exp(-(z @ c + c0))), at, bag

    def _said(self, bags: Iterable[np.ndarray]) -> np.ndarray:
        return np.concatenate([b @ self.w[7].astype(b.dtype) for b in bags])

    def score(self, found: Passages, dtype: type = np.float32) -> np.ndarray:
        return self._forward(found.shares.astype(np.float64), self._said(found.bags(dtype)), found.parts)[5]

    def gradient(self, x: np.ndarray, bags: list[np.ndarray], parts: np.ndarray, y: np.ndarray, decay: float) -> list[np.ndarray]:
        w1, b1, v, u, g, c, c0, _ = self.w
        h, t, s, a, z, p, at, bag = self._forward(x, self._said(bags), parts)
        d = (p - y) / len(y)
        dz = d[:, None] * c
        da = (dz[bag] * h).sum(1)
        de = a * (da - np.add.reduceat(a * da, at)[bag])
        dt, ds = de[:, None] * g * s * (1 - t * t), de[:, None] * g * t * s * (1 - s)
        dh = a[:, None] * dz[bag] + dt @ v.T + ds @ u.T
        dh *= 1 - h * h
        embedded = sum(b.T @ dh[i * BLOCK : (i + 1) * BLOCK].astype(b.dtype) for i, b in enumerate(bags))
        grads = [((x - self.mean) / self.scale).T @ dh, dh.sum(0), h.T @ dt, h.T @ ds, (t * s).T @ de, z.T @ d, np.array(d.sum()), embedded]
        return [x + decay * w for x, w in zip(grads, self.w)]


def fit(found: Passages, y: np.ndarray, width: int = 16, rounds: int = 200, rate: float = 0.03, decay: float = 1e-4, seed: int = 7, dtype: type = np.float32) -> Attention:
    """Full-batch Adam from a seeded start, embeddings from zero; the same sample gives the same model.

    The words of the sample are held as one matrix row of 4 KB a passage.
    """
    rng = np.random.default_rng(seed)
    x, bags = found.shares.astype(np.float64), list(found.bags(dtype))
    mean, scale = x.mean(0), x.std(0) + 1e-3
    start = lambda *shape: rng.normal(0, 1 / np.sqrt(shape[0]), shape)
    model = Attention(mean, scale, [start(x.shape[1], width), np.zeros(width), start(width, width), start(width, width), start(width), start(width), np.array(0.0), np.zeros((1 << BUCKET_BITS, width))])
    first, second = ([np.zeros_like(w) for w in model.w] for _ in range(2))
    for step in range(1, rounds + 1):
        for i, grad in enumerate(model.gradient(x, bags, found.parts, y, decay)):
            first[i] = 0.9 * first[i] + 0.1 * grad
            second[i] = 0.999 * second[i] + 0.001 * grad * grad
            model.w[i] = model.w[i] - rate * (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8)
    return model


def training_sample(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[Passages, np.ndarray]:
    """Passages and labels of at most ``sample`` labelled documents outside the held-out fifth.

    The sample is chosen by a digest of the id, so it is the same at every run; ``sample`` bounds what is
    broadcast (ids) and what reaches the driver (about 500 bytes a passage). An id labelled more than once
    counts once, as good if any of its labels says so.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & (crc_mod("doc_id", 5) != 0))
    known = known.groupBy("doc_id").agg(F.max("quality").alias("quality"))
    known = known.orderBy(F.md5(F.col("doc_id").cast("string")), "doc_id").limit(sample)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in batches(it):
            found = passages(byte_texts(table["text"]))
            ends = np.cumsum(found.parts)
            past = np.concatenate(([0], np.cumsum(found.sizes)))
            rows = list(zip((ends - found.parts).tolist(), ends.tolist()))
            blobs = [[found.shares[a:b].tobytes() for a, b in rows], [found.buckets[past[a] : past[b]].tobytes() for a, b in rows], [found.sizes[a:b].tobytes() for a, b in rows]]
            yield pa.RecordBatch.from_arrays([table["doc_id"].combine_chunks(), table["quality"].combine_chunks().cast(pa.int32()), *[pa.array(b, pa.binary()) for b in blobs]], names=["doc_id", "quality", "x", "buckets", "sizes"])

    rows = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id").mapInArrow(run, "doc_id long, quality int, x binary, buckets binary, sizes binary").collect()
    rows.sort(key=lambda r: (r.doc_id, r.x, r.buckets))
    whole = lambda name, of: np.frombuffer(b"".join(getattr(r, name) for r in rows), of)
    parts = np.array([len(r.sizes) // 8 for r in rows], np.int64)
    return Passages(whole("x", np.float32).reshape(-1, N_FEATURES), parts, whole("buckets", np.uint16), whole("sizes", np.int64)), np.array([r.quality for r in rows], np.float64)


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Attention | float:
    """The model, or a constant score where the sample has fewer than two kinds of label."""
    found, y = training_sample(docs, labels, sample)
    if len(set(y.tolist())) < 2:
        return float(y.mean()) if len(y) else 0.5
    return fit(found, y)


def _scored(model: Attention | float, table: pa.Table, text: str) -> np.ndarray:
    return np.full(table.num_rows, model) if isinstance(model, float) else model.score(passages(byte_texts(table[text])))


def scores(docs: DataFrame, model: Attention | float, text: str = "text", name: str = "score") -> DataFrame:
    """``docs`` without its text, with a score from 0 to 1; every passage of every text counts.

    Null and empty texts are one passage of zeros and get its score; very long texts have more passages, nothing is
    cut; an empty table gives no row. A column of the score's name is replaced.
    """
    bounded_batches(docs.sparkSession)
    docs = docs.drop(name)
    rest = [c for c in docs.columns if c != text]
    schema = StructType([*docs.drop(text).schema.fields, StructField(name, DoubleType())])

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in batches(it):
            yield from table.select(rest).append_column(name, pa.array(_scored(model, table, text))).to_batches()

    return docs.mapInArrow(run, schema)


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` (doc_id, text) that score at least ``threshold``, with their columns as they were.

    Null and empty texts are judged like any other; rows are judged each, repeated ones alike; without labels of
    both kinds all rows have one score; an empty table gives no row.
    """
    model = learn(docs, labels)
    bounded_batches(docs.sparkSession)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            yield batch.filter(pa.array(_scored(model, pa.Table.from_batches([batch]), "text") >= threshold))

    return docs.mapInArrow(run, docs.schema)


def op9_attention_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    bounded_batches(spark)
    model = learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    held_out = (crc_mod("doc_id", 5) == 0).alias("held_out")
    rows = scores(docs.select("doc_id", held_out, "text"), model)
    return rows.select("doc_id", "held_out", "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
