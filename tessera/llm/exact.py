"""Operator 10: exact deduplication over cuckoo filters of live digests.

A filter holds 16-bit tags in buckets of four, each tag in one of two buckets. A hit may be a false one, so it is
verified against the bucket's content: the digests stored under the two buckets. An insert that finds no place
after a bounded number of moves doubles the table, filled again from the stored digests. Deletes remove a tag of
a verified digest only, so they never remove another key's.
"""

from __future__ import annotations

import hashlib
import string
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import Scratch, batches, bounded_batches, byte_texts, documents, partitions, text_or_empty

_SLOTS, _MOVES = 4, 64


class CuckooIndex:
    """Live digests (bytes of 20 or more) with a value each; ``get``, ``put`` and ``remove`` are exact."""

    def __init__(self, buckets: int = 256) -> None:
        self._clear(buckets)
        self.live = self.resizes = 0

    def _clear(self, buckets: int) -> None:
        self.mask = buckets - 1
        self.tags: list[list[int]] = [[] for _ in range(buckets)]
        self.content: list[dict[bytes, list]] = [{} for _ in range(buckets)]  # a digest lies under its first bucket

    def _places(self, digest: bytes) -> tuple[int, int, int]:
        tag = int.from_bytes(digest[8:10], "little") or 1
        first = int.from_bytes(digest[10:18], "little") & self.mask
        return tag, first, (first ^ (tag * 0x5BD1E995)) & self.mask

    def maybe(self, digest: bytes) -> bool:
        """What the filter alone says: False is certain."""
        tag, first, second = self._places(digest)
        return tag in self.tags[first] or tag in self.tags[second]

    def get(self, digest: bytes) -> list | None:
        tag, first, second = self._places(digest)
        if tag in self.tags[first] or tag in self.tags[second]:
            return self.content[first].get(digest)
        return None

    def put(self, digest: bytes, value: list) -> None:
        if self.get(digest) is None:
            self.live += 1
            tag, first, second = self._places(digest)
            self.content[first][digest] = value
            if not self._place(tag, first, second):
                self._grow()
        else:
            self.content[self._places(digest)[1]][digest] = value

    def remove(self, digest: bytes) -> bool:
        if self.get(digest) is None:
            return False
        tag, first, second = self._places(digest)
        self.tags[first if tag in self.tags[first] else second].remove(tag)
        del self.content[first][digest]
        self.live -= 1
        return True

    def _place(self, tag: int, first: int, second: int) -> bool:
        for at in (first, second):
            if len(self.tags[at]) < _SLOTS:
                self.tags[at].append(tag)
                return True
        at = second
        for move in range(_MOVES):  # the victim's slot goes round, so that reruns agree
            slot = move % _SLOTS
            tag, self.tags[at][slot] = self.tags[at][slot], tag
            at = (at ^ (tag * 0x5BD1E995)) & self.mask
            if len(self.tags[at]) < _SLOTS:
                self.tags[at].append(tag)
                return True
        return False

    def _grow(self) -> None:
        held = self.items()
        buckets = len(self.tags)
        while True:
            buckets *= 2
            self.resizes += 1
            self._clear(buckets)
            for digest, value in held:
                tag, first, second = self._places(digest)
                self.content[first][digest] = value
                if not self._place(tag, first, second):
                    break
            else:
                return

    def items(self) -> list[tuple[bytes, list]]:
        return [x for bucket in self.content for x in bucket.items()]


def digests(docs: DataFrame) -> DataFrame:
    """(doc_id, digest): SHA-256 of each text with A-Z lower-cased; a null text is empty. Other columns are not read."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in batches(it, 1 << 20):
            found = [hashlib.sha256(x.lower()).digest() for x in byte_texts(table["text"])]
            yield pa.RecordBatch.from_arrays([table["doc_id"].combine_chunks(), pa.array(found, pa.binary())], names=["doc_id", "digest"])

    bounded_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, digest binary")


def _fold(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One cuckoo index a task: a digest's row is replaced by that of a larger keep_id, its size adds up."""
    index = CuckooIndex()
    for batch in it:
        for keep, digest, size in zip(*(batch[c].to_pylist() for c in ("keep_id", "digest", "size"))):
            held = index.get(digest)
            if held is None:
                index.put(digest, [keep, size])
            else:
                held[1] += size
                if held[0] is None or keep is not None and keep > held[0]:
                    held[0] = keep
    rows = index.items()
    for at in range(0, len(rows), 1 << 14):
        part = rows[at : at + (1 << 14)]
        cols = [pa.array([v[0] for _, v in part], pa.int64()), pa.array([d for d, _ in part], pa.binary()), pa.array([v[1] for _, v in part], pa.int64())]
        yield pa.RecordBatch.from_arrays(cols, names=["keep_id", "digest", "size"])


GROUPS = "keep_id long, digest binary, size long"


def live_digests(rows: DataFrame, shards: int) -> DataFrame:
    """(keep_id, digest, size) of each distinct digest of ``rows`` (doc_id, digest).

    Each task folds its own rows through an index first, so a digest of very many copies reaches its shard as one
    row a task. A shard's index holds its share of the distinct digests: choose ``shards`` by their number.
    """
    local = rows.select(F.col("doc_id").alias("keep_id"), "digest", F.lit(1).cast("long").alias("size")).mapInArrow(_fold, GROUPS)
    return local.repartition(shards, "digest").mapInArrow(_fold, GROUPS)


def exact_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 of every row of ``docs`` (doc_id, text).

    Of equal texts the row with the largest doc_id stays. Rows that share text and id are copies of one row: all
    are marked kept if their id is the largest (``drop_exact`` leaves one). A null id is smaller than any other.
    An empty table gives no row.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "exact")
    rows = scratch.keep(digests(docs), "rows")
    groups = scratch.keep(live_digests(rows, partitions(spark)), "groups")
    return rows.join(groups, "digest").select(
        "doc_id",
        "keep_id",
        F.col("size").alias("group_size"),
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def drop_exact(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, one of each text, with their columns as they were.

    A null text is empty, a null id smaller than any other; of rows that share text and id one stays. Columns that
    start with ``__exact`` are not allowed; an empty table gives no row.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "exact")
    rows = scratch.keep(digests(docs), "rows")
    last = scratch.keep(live_digests(rows, partitions(spark)), "groups").select(F.col("keep_id").alias("__exact_keep"), F.col("digest").alias("__exact_digest"))
    upper, lower = string.ascii_uppercase, string.ascii_lowercase
    digest = F.unhex(F.sha2(F.translate(text_or_empty(), upper, lower), 256))
    kept = docs.withColumn("__exact", digest).join(last, F.col("__exact") == F.col("__exact_digest")).where(F.col("doc_id").eqNullSafe(F.col("__exact_keep")))
    twice = rows.groupBy("doc_id", "digest").count().where("count > 1")
    if not twice.isEmpty():  # rows that share text and id
        kept = kept.dropDuplicates(["__exact"])
    return kept.drop("__exact", "__exact_keep", "__exact_digest")


def update_live(live: DataFrame, inserts: DataFrame, removes: DataFrame) -> DataFrame:
    """The live rows (doc_id, digest) after ``inserts`` and then ``removes``; a removed row that is not live changes nothing."""
    rows = live.select("doc_id", "digest", F.lit(1).alias("n")).union(inserts.select("doc_id", "digest", F.lit(1)))
    rows = rows.union(removes.select("doc_id", "digest", F.lit(-1))).groupBy("doc_id", "digest").agg(F.sum("n").alias("n"))
    return rows.where("n > 0").select("doc_id", "digest", F.explode(F.sequence(F.lit(1).cast("long"), "n")).alias("__i")).drop("__i")


def update_index(index: DataFrame, inserts: DataFrame, removes: DataFrame, shards: int, live: DataFrame | None = None) -> DataFrame:
    """A written index (keep_id, digest, size) after ``inserts`` and ``removes`` (doc_id, digest) of live digests.

    Each shard's cuckoo index is filled from its stored digests, takes the inserts, then drops the removed
    digests that it verifies; a digest leaves once as many rows were removed as it had. ``live``: the rows
    (doc_id, digest) of the index before, from which keep_id and size of digests with removed rows are told
    anew (``update_live`` gives the rows after). Without it, removing a row that may be the kept one of a group
    that stays is an error.
    """
    fields = ("keep_id", "digest", "size")
    added, gone = live_digests(inserts, shards), live_digests(removes, shards)
    both = index.select(*fields, F.lit(0).alias("kind")).unionByName(added.withColumn("kind", F.lit(0))).unionByName(gone.withColumn("kind", F.lit(1)))
    if live is not None:
        rest = update_live(live, inserts, removes).join(gone.select("digest"), "digest", "left_semi")
        both = both.unionByName(live_digests(rest, shards).withColumn("kind", F.lit(2)))
    told = live is not None

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, late, anew = CuckooIndex(), [], {}
        for batch in it:
            for keep, digest, size, kind in zip(*(batch[c].to_pylist() for c in (*fields, "kind"))):
                if kind == 1:
                    late.append((digest, keep, size))
                    continue
                if kind == 2:
                    anew[digest] = [keep, size]
                    continue
                old = held.get(digest)
                if old is None:
                    held.put(digest, [keep, size])
                else:
                    old[0] = keep if old[0] is None else old[0] if keep is None else max(old[0], keep)
                    old[1] += size
        for digest, most, size in late:
            old = held.get(digest)
            if old is None:
                continue
            if told:
                old[:] = anew.get(digest, [None, 0])
            else:
                old[1] -= size
            if old[1] <= 0:
                held.remove(digest)
            elif not told and old[0] is not None and most is not None and most >= old[0]:
                raise ValueError("a kept row is removed: the live rows are needed to tell the next one")
        rows = held.items()
        yield pa.RecordBatch.from_arrays(
            [pa.array([v[0] for _, v in rows], pa.int64()), pa.array([d for d, _ in rows], pa.binary()), pa.array([v[1] for _, v in rows], pa.int64())], names=list(fields)
        )

    return both.repartition(shards, "digest").mapInArrow(run, GROUPS)


def op10_exact_cuckoo(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(documents(spark, sf_dir))
