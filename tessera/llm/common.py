"""What the operators share: the shared scratch folder, bounded Arrow batches, column guards."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from tessera.session import bounded_batches  # noqa: F401  the operators take it from here

#: Words of a text: runs of anything but space, tab, newline, vertical tab, form feed, return.
WORD = r"[^\x20\x09-\x0D]+"

_own: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: ``spark.checkpoint.dir``. Only a local session may go without it."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not _own:
        _own.append(tempfile.mkdtemp(prefix="tessera-"))
        atexit.register(shutil.rmtree, _own[0], ignore_errors=True)
    return f"file://{_own[0]}"


class Scratch:
    """Written tables that cut lineage. A lost executor costs a rerun of one step, not of the whole plan.

    ``keep`` writes and rereads; ``drop`` removes a table that no later step reads.
    """

    def __init__(self, spark: SparkSession, tag: str) -> None:
        self.spark, self.root = spark, f"{shared_dir(spark)}/tessera/{tag}-{uuid.uuid4().hex}"

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        # shuffle files of a finished write serve nothing any more
        cleanup = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
        before = self.spark.conf.get(cleanup, None)
        self.spark.conf.set(cleanup, "true")
        try:
            df.write.option("compression", "zstd").parquet(self.path(name))
        finally:
            self.spark.conf.unset(cleanup) if before is None else self.spark.conf.set(cleanup, before)
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def drop(self, *names: str) -> None:
        for name in names:
            target = self.spark._jvm.org.apache.hadoop.fs.Path(self.path(name))
            target.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(target, True)


def by_shuffle(side: DataFrame) -> DataFrame:
    """A side of a join that is shuffled and sorted whatever its size.

    A table that grows with the input and is still below the broadcast threshold would be collected by the driver,
    with all others of its plan at once: rounds of joins fill the driver's heap that way.
    """
    return side.hint("merge")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def byte_texts(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """UTF-8 bytes of each text; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def batches(it: Iterator[pa.RecordBatch], most: int = 1 << 20) -> Iterator[pa.Table]:
    """Joins small Arrow batches until they hold about ``most`` bytes, so that numpy work is amortised."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in it:
        if batch.num_rows:
            held.append(batch)
            size += batch.nbytes
        if size >= most:
            yield pa.Table.from_batches(held)
            held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)


def crc_mod(doc_id: str, mod: int) -> Column:
    """crc32 of the id as text, modulo ``mod``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % mod


_MIX = np.uint64(0x9E3779B97F4A7C15)


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, so that sums and products with structure become spread keys."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(29))
    x = x * _MIX
    return x ^ (x >> np.uint64(32))


def _powers(n: int, base: int) -> np.ndarray:
    out = np.empty(n, np.uint64)
    out[:1] = 1
    done = 1
    while done < n:  # doubling: powers[done + i] = powers[i] * base ** done
        m = min(done, n - done)
        out[done : done + m] = out[:m] * np.uint64(pow(base, done, 1 << 64))
        done += m
    return out


_tables: dict[int, np.ndarray] = {}


def powers(n: int, base: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1) modulo 2 ** 64, kept between calls."""
    held = _tables.get(base)
    if held is None or len(held) < n:
        held = _tables[base] = _powers(max(n, 1 << 16), base)
    return held[:n]


def bitmap(names: DataFrame, column: str, bits: int, scratch: Scratch | None = None) -> np.ndarray:
    """A bitmap of 2**bits bits that marks the low bits of every value; its size does not grow with the rows.

    With ``scratch`` it is written first, so that its shuffle files go.
    """
    low = names.select(F.col(column).bitwiseAND((1 << bits) - 1).alias("low"))
    words = low.groupBy(F.expr("cast(shiftright(low, 6) as int)").alias("word")).agg(F.expr("bit_or(shiftleft(1L, cast(low & 63 as int)))").alias("mask"))
    found = (scratch.keep(words, f"bits-{uuid.uuid4().hex}") if scratch else words).toArrow()
    out = np.zeros(1 << (bits - 6), np.uint64)
    out[found["word"].to_numpy()] = found["mask"].to_numpy().view(np.uint64)
    return out


def marked(bits: np.ndarray, values: np.ndarray) -> np.ndarray:
    low = values & np.uint64(len(bits) * 64 - 1)
    return (bits[(low >> np.uint64(6)).astype(np.int64)] >> (low & np.uint64(63))) & np.uint64(1) > 0


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Masks of the low 0 to 8 bytes.
_LOW = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


class Words:
    """The words of many texts at once: ``doc`` (index of the text), ``start`` and ``end`` (bytes in ``data``).

    ``low``, ``high`` and ``size`` are a word of at most ``EXACT`` bytes itself, so words compare as numbers.
    ``ahead`` (of bytes) marks further places where a word begins.
    """

    EXACT = 16

    def __init__(self, texts: list[bytes], lower: bool = True, ahead: Callable[[np.ndarray], np.ndarray] | None = None) -> None:
        joined = b" ".join([*texts, bytes(16)])
        self.raw = joined.lower() if lower else joined  # bytes.lower() changes A-Z only
        padded = np.frombuffer(self.raw, np.uint8)
        self.data = padded[: max(0, len(padded) - 17)]
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        self.doc_start = np.concatenate(([0], np.cumsum(sizes + 1)))[: len(texts)]
        word = ~_SPACE[padded[: len(self.data) + 1]]
        word[len(self.data) :] = False
        begins, ends = word.copy(), word.copy()
        cut = np.zeros(len(word), bool) if ahead is None else ahead(padded[: len(word)])
        begins[1:] &= ~word[:-1] | cut[1:]
        ends[:-1] &= ~word[1:] | cut[1:]
        self.start, self.end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        self.doc = np.searchsorted(self.doc_start, self.start, "right") - 1
        self.count = np.bincount(self.doc, minlength=len(texts)).astype(np.int64)
        self.size = self.end - self.start
        eight = np.ndarray((len(padded) - 8,), "<u8", padded, strides=(1,))
        self.low = eight[self.start] & _LOW[np.minimum(self.size, 8)]
        self.high = eight[self.start + 8] & _LOW[np.clip(self.size - 8, 0, 8)]

    @cached_property
    def hash(self) -> np.ndarray:
        """64-bit names of the words: equal words have equal ones, wherever they stand. Long words by XXH64."""
        out = mix64(self.low + mix64(self.high + self.size.astype(np.uint64) * _MIX))
        long_ = np.flatnonzero(self.size > self.EXACT)
        out[long_] = np.fromiter((xxh64_intdigest(self.raw[a:b]) for a, b in zip(self.start[long_].tolist(), self.end[long_].tolist())), np.uint64, len(long_))
        return out
