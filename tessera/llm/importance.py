"""Operator 13: importance resampling of documents towards a target distribution of hashed word runs.

Texts are cut and counted by Arrow kernels over whole batches: lower-casing, splitting by a pattern, flattening,
a dictionary of the batch's words; runs of words are rows of shifted dictionary indices, so only distinct runs are
hashed. Gains are taken by bucket and summed over each text's segment.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.common import Scratch, batches, bounded_batches, documents, partitions

#: What stands between words: every ASCII character but digits and letters, once letters are lower-cased.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BUCKETS = 10_000
SEED = 2024
LEAST_WORDS, PERCENT = 20, 10


def word_indices(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(distinct words, index of every word in them, words of each text), all texts' words one after another."""
    parts = pc.split_pattern_regex(pc.ascii_lower(pc.fill_null(texts, "")), BETWEEN)
    flat, of = pc.list_flatten(parts), pc.list_parent_indices(parts)
    some = pc.not_equal(pc.binary_length(flat), 0)  # a text that opens or ends with a separator has empty parts there
    flat, of = pc.filter(flat, some), pc.filter(of, some).to_numpy()
    coded = pc.dictionary_encode(flat)
    return coded.dictionary, coded.indices.to_numpy(), np.bincount(of, minlength=len(texts)).astype(np.int64)


def features(texts: pa.Array, most: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket of every run of 1 to ``most`` words, grouped by text; runs of each text; words of each text)."""
    dictionary, index, words = word_indices(texts)
    text_of = np.repeat(np.arange(len(words)), words)
    raw = dictionary.cast(pa.binary()).to_pylist()
    found: list[np.ndarray] = []
    owner: list[np.ndarray] = []
    for n in range(1, most + 1):
        stop = max(0, len(index) - n + 1)
        inside = np.flatnonzero(text_of[:stop] == text_of[n - 1 :]) if stop else np.empty(0, np.int64)
        rows = np.stack([index[inside + k] for k in range(n)], 1) if len(inside) else np.empty((0, n), index.dtype)
        distinct, back = (np.arange(len(raw))[:, None], rows[:, 0]) if n == 1 else np.unique(rows, axis=0, return_inverse=True)
        crc = np.fromiter((zlib.crc32(b" ".join([raw[i] for i in row])) % buckets for row in distinct.tolist()), np.int64, len(distinct))
        found.append(crc[back.reshape(-1)])
        owner.append(text_of[inside])
    bucket, by = np.concatenate(found), np.concatenate(owner)
    if most > 1:
        bucket = bucket[np.argsort(by, kind="stable")]
    return bucket, np.bincount(by, minlength=len(words)).astype(np.int64), words


def bucket_counts(texts: DataFrame, most: int = 1, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n) of all runs in ``text``; each task sends a row a bucket at most."""
    bounded_batches(texts.sparkSession)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for table in batches(it):
            total += np.bincount(features(table["text"].combine_chunks(), most, buckets)[0], minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["bucket", "n"])

    return texts.select("text").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


@dataclass(frozen=True)
class Gains:
    """The gain of every bucket; as many numbers as buckets, whatever the corpus."""

    values: np.ndarray
    most: int

    @classmethod
    def fit(cls, corpus: DataFrame, target: DataFrame, most: int = 1, buckets: int = BUCKETS) -> "Gains":
        """floor(1000 ln of the smoothed share in the target over that in the corpus); a missing bucket counts 0."""

        def counts(df: DataFrame) -> list[int]:
            got = bucket_counts(df, most, buckets).toArrow()
            out = np.zeros(buckets, np.int64)
            out[got["bucket"].to_numpy()] = got["n"].to_numpy()
            return out.tolist()

        s, t = counts(corpus), counts(target)
        up, down = float(sum(s) + buckets), float(sum(t) + buckets)
        return cls(np.array([math.floor(1000 * math.log((b + 1) * up / ((a + 1) * down))) for a, b in zip(s, t)], np.int64), most)


def weigh(docs: DataFrame, gains: Gains) -> DataFrame:
    """(doc_id, n_words, n_features, weight) of every row of ``docs`` (doc_id, text): the sum of gains of its runs."""
    bounded_batches(docs.sparkSession)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.array(gains.values)
        for batch in batches(it):
            bucket, runs, words = features(batch["text"].combine_chunks(), gains.most, len(gains.values))
            taken = np.append(pc.take(table, pa.array(bucket)).to_numpy(), 0)
            start = np.cumsum(runs) - runs
            weight = np.where(runs > 0, np.add.reduceat(taken, start), 0)
            yield pa.RecordBatch.from_arrays([batch["doc_id"].combine_chunks(), pa.array(words), pa.array(runs), pa.array(weight)], names=names)

    names = ["doc_id", "n_words", "n_features", "weight"]
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_words long, n_features long, weight long")


def ranked(rows: DataFrame, order: list, draw: int, scratch: Scratch, tag: str) -> DataFrame:
    """``rows`` with ``rank`` (1, 2, ... by ``order``, null beyond ``draw``).

    Rows are dealt by ranges of ``order`` and sorted within each; a row's place is its place in its range and the
    rows of the ranges before, so no task sees more than a range.
    """
    width = 33  # bits of a row's place within its partition, as monotonically_increasing_id has it
    dealt = rows.repartitionByRange(partitions(rows.sparkSession), *order).sortWithinPartitions(*order)
    placed = scratch.keep(dealt.withColumn("__at", F.monotonically_increasing_id()), tag)
    placed = placed.withColumn("__range", F.shiftright("__at", width)).withColumn("__at", F.col("__at").bitwiseAND((1 << width) - 1))
    sizes = placed.groupBy("__range").agg(F.count("*").alias("__n"))
    before = F.coalesce(F.sum("__n").over(Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = sizes.select("__range", before.alias("__before"))  # a row a partition
    rank = F.col("__before") + F.col("__at") + 1
    return placed.join(F.broadcast(starts), "__range").withColumn("rank", F.when(rank <= draw, rank)).drop("__at", "__range", "__before")


def resample(
    docs: DataFrame, target: DataFrame, most: int = 1, buckets: int = BUCKETS, seed: int = SEED, least_words: int = LEAST_WORDS, percent: int = PERCENT
) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of every row of ``docs`` (doc_id, text), ``target`` has ``text``.

    The score is the weight and Gumbel noise drawn from the id, so the rows with the highest scores are a sample
    without replacement by importance; ``percent`` of the rows with ``least_words`` get a rank. Null texts are
    empty: weight 0, never drawn. A null id draws the noise of the empty id and comes last among equal scores;
    rows that share an id and a score are ranked one after another, by their number of features and words. Empty
    tables give no rows, an empty target leaves all gains to smoothing. Other columns are not read. A very long
    text is held whole by one worker.
    """
    scratch = Scratch(docs.sparkSession, "importance")
    weighed = weigh(docs, Gains.fit(docs, target, most, buckets))
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))
    scored = scratch.keep(weighed.withColumn("score", F.col("weight") + noise), "scored")
    able = F.col("n_words") >= least_words
    drawn = scored.where(able).count() * percent // 100
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.desc("n_features"), F.desc("n_words")]
    rest = scored.where(~able).withColumn("rank", F.lit(None).cast("long"))
    out = ranked(scored.where(able), order, drawn, scratch, "ranked").unionByName(rest)
    return out.select("doc_id", "n_features", "weight", "score", "rank")


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
