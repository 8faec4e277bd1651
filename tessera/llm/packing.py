"""Operator 5: harmonic packing of documents into sequences of a fixed capacity.

A class is a number k of equal places in a sequence; a piece of a length in (capacity/(k+1), capacity/k] belongs
to class k and a sequence of that class takes exactly k pieces. Documents may be cut, so a length far below its
class's place is cut to the next class's place and the rest is classed again. Workers class their own documents;
only counts by worker and class are exchanged to number the sequences.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.common import Scratch, batches, bounded_batches, byte_texts, documents
from tessera.llm.tokens import TOKENIZER, Encoder

CAPACITY = 4096
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, places int, worker int, seq long"


def places(length: int, capacity: int = CAPACITY) -> int:
    """The class of a length: capacity // length, cut to its six leading bits so that classes stay few."""
    k = capacity // length
    drop = max(0, k.bit_length() - 6)
    return k >> drop << drop


def cut(length: int, capacity: int = CAPACITY, waste: float = 1 / 64) -> list[tuple[int, int]]:
    """(length, class) of the pieces of a document. Only lengths that would leave over ``waste`` of a sequence are cut."""
    out = [(capacity, 1)] * (length // capacity)
    length %= capacity
    while length:
        k = places(length, capacity)
        if k > 64 or capacity - k * length <= waste * capacity:
            out.append((length, k))
            break
        part = capacity // (k + 1)
        out.append((part, places(part, capacity)))
        length -= part
    return out


def piece_table(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, waste: float = 1 / 64, with_ids: bool = False) -> DataFrame:
    """Pieces of ``docs`` (doc_id, text): each id of a document, end id included, lies in exactly one piece.

    A null text is empty and still has its end id; rows that share an id are packed separately; a null id stays
    null; an empty table gives no piece; other columns are not read.
    """
    bounded_batches(docs.sparkSession)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, worker, seq = Encoder.of(tokenizer_path), TaskContext.get().partitionId(), 0
        for table in batches(it, 1 << 20):
            ids, lengths = encoder.encode(byte_texts(table["text"]))
            raw, at, rows = memoryview(ids.astype("<u4").tobytes()), 0, []
            for doc, n in zip(table["doc_id"].to_pylist(), lengths.tolist()):
                start = 0
                for length, k in cut(n, capacity, waste):
                    a = at + start
                    rows.append((doc, start, length, zlib.crc32(raw[4 * a : 4 * (a + length)]), n, k, worker, seq, *([ids[a : a + length].tolist()] if with_ids else ())))
                    start += length
                    seq += 1
                at += n
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "places", "worker", "seq"] + ["ids"] * with_ids
    types = [pa.int64()] * 5 + [pa.int32(), pa.int32(), pa.int64()] + [pa.list_(pa.int32())] * with_ids
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, PIECES + ", ids array<int>" * with_ids)


def fill(partial: pd.DataFrame, capacity: int = CAPACITY) -> pd.DataFrame:
    """First fit, longest first, of the last unfilled sequence of each class: at most one row a class."""
    rest: list[int] = []
    out = []
    for k, used in sorted(zip(partial["places"], partial["used"]), key=lambda x: (-x[1], x[0])):
        i = next((i for i, free in enumerate(rest) if free >= used), len(rest))
        if i == len(rest):
            rest.append(capacity)
        out.append((k, i, capacity - rest[i]))
        rest[i] -= used
    return pd.DataFrame(out, columns=["places", "extra", "ahead"])


def pack_pieces(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds sequence_id and offset. ``pieces`` must be a written table: its worker and seq number the rows.

    Windows are cut by (worker, class) and by sequence, so no class, however common, meets in one task.
    """
    counts = pieces.groupBy("places", "worker").agg(F.count(F.lit(1)).alias("n"))
    ahead = Window.partitionBy("places").orderBy("worker").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("ahead", F.coalesce(F.sum("n").over(ahead), F.lit(0))).withColumn("total", F.sum("n").over(Window.partitionBy("places")))
    classes = counts.select("places", F.floor(F.col("total") / F.col("places")).alias("full")).distinct()
    classes = classes.withColumn("first", F.coalesce(F.sum("full").over(Window.orderBy("places").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    classes = classes.withColumn("all_full", F.sum("full").over(Window.partitionBy()))
    local = F.row_number().over(Window.partitionBy("worker", "places").orderBy("seq")) - 1
    rows = pieces.withColumn("local", local).join(counts.select("places", "worker", "ahead"), ["places", "worker"])
    rows = rows.withColumn("ordinal", F.col("ahead") + F.col("local")).drop("ahead", "local")
    rows = rows.join(F.broadcast(classes), "places")  # a row a class: under 300 for 4096 places
    rows = rows.withColumn("bin", F.floor(F.col("ordinal") / F.col("places")))
    last = rows.where(F.col("bin") >= F.col("full")).groupBy("places").agg(F.sum("length").alias("used"))
    merged = last.withColumn("one", F.lit(0)).groupBy("one").applyInPandas(lambda x: fill(x, capacity), "places int, extra long, ahead long")
    rows = rows.join(F.broadcast(merged), "places", "left")
    whole = F.col("bin") < F.col("full")
    before = Window.partitionBy("places", "bin").orderBy("ordinal").rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum("length").over(before), F.lit(0))
    return rows.withColumn("sequence_id", F.when(whole, F.col("first") + F.col("bin")).otherwise(F.col("all_full") + F.col("extra"))).withColumn(
        "offset", inside + F.when(whole, 0).otherwise(F.col("ahead"))
    )


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, waste: float = 1 / 64) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset of every piece of ``docs``."""
    scratch = Scratch(docs.sparkSession, "packing")
    pieces = scratch.keep(piece_table(docs, tokenizer_path, capacity, waste), "pieces")
    return pack_pieces(pieces, capacity).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", F.col("sequence_id").cast("long"), F.col("offset").cast("long"))


def op5_harmonic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack_documents(documents(spark, sf_dir), public_tokenizers.path(TOKENIZER))
