"""Near copies: documents whose sets of five-word shingles have a Jaccard similarity of 0.8 or more.

Candidates are the pairs of fingerprints that operator 3 links over Golay codewords and, as fingerprints of texts of
similarity 0.8 differ in more bits than those keys cover, rows that share a prefix key: sets are put in one order,
common shingles last; two sets of similarity t share one of the first n - ceil(t n) + 1 shingles of both, whatever the
order. Every candidate is verified on the whole sets, so no pair is missed and none is made up.

Rows of equal sets stand as one row. Rows of a key first meet the key's hub, the row with most company under its own
keys. What is verified joins rows to groups; then pairs of a key whose rows are still in different groups are
compared, but for those that their sizes, the places of the first shared key or the number of shared keys rule out.
No pair in one group need be looked at, as groups are connected components.

A row is named by a 64-bit hash of its id and text, a shingle by one of its words: among 10^10 rows about three pairs
of rows are expected to share a name by chance.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import Scratch, Words, batches, bitmap, bounded_batches, by_shuffle, byte_texts, marked, mix64
from tessera.llm.graph import components
from tessera.llm.simhash import fingerprint, links

WORDS, SIMILARITY = 5, 0.8
#: Bits of the bitmaps that sift rows before a join. When they fill up, more rows are joined; results stay the same.
_BITS = 25
#: One row in so many is read to tell common shingles: those in as many of them. They settle the order of keys only.
_SHARE, _OFTEN = 4, (3, 48)
_TURN = [np.uint64(pow(0x9E3779B97F4A7C15, i + 1, 1 << 64) | 1) for i in range(64)]


def shingle_sets(texts: list[bytes], words: int = WORDS, repeats: bool = False) -> list[np.ndarray]:
    """The sorted distinct names of each text's shingles (``repeats``: all of them, in their order).

    A text with fewer words is one shingle, a text without words none.
    """
    found = Words(texts)
    n = len(found.doc)
    names, last = np.zeros(n, np.uint64), np.full(n, -1)
    for i in range(min(words, n)):
        inside = found.doc[i:] == found.doc[: n - i]
        names[: n - i] += np.where(inside, found.hash[i:] * _TURN[i], np.uint64(0))
        last[: n - i] = np.where(inside, i, last[: n - i])
    first = np.cumsum(found.count) - found.count
    whole = (last == words - 1) | ((found.count[found.doc] < words) & (np.arange(n) == first[found.doc]))
    names, doc = mix64(names[whole]), found.doc[whole]
    parts = np.split(names, np.searchsorted(doc, np.arange(1, len(texts))))
    return parts if repeats else [np.unique(x) for x in parts]


def alike(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of two sorted sets."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both) if len(a) or len(b) else 1.0


def _common(docs: DataFrame, words: int, scratch: Scratch) -> list[np.ndarray]:
    """Bitmaps of the shingles that stand in several and in many of a fixed share of the rows."""

    def sample(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in batches(it):
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(shingle_sets(byte_texts(table["text"]), words)).view(np.int64))], names=["key"])

    found = docs.where(F.pmod("row", F.lit(_SHARE)) == 0).select("text").mapInArrow(sample, "key long")
    found = scratch.keep(found.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= _OFTEN[0]), "common")
    return [bitmap(found.where(F.col("n") >= n), "key", _BITS) for n in _OFTEN]


def prefix_keys(docs: DataFrame, words: int, similarity: float, scratch: Scratch) -> DataFrame:
    """(row, size, key, at, n) of the prefix keys that n rows, two or more, share. Two passes over the texts:

    one that counts keys, one that emits with their rows those that a bitmap of the shared ones marks.
    """
    spark = docs.sparkSession
    order = spark.sparkContext.broadcast(_common(docs, words, scratch))

    def prefixes(table: pa.Table) -> tuple[list[np.ndarray], list[int]]:
        sets = shingle_sets(byte_texts(table["text"]), words)
        flat = np.concatenate(sets)
        rank = sum(marked(x, flat).astype(np.int8) for x in order.value)
        out, past = [], 0
        for h in sets:
            r = rank[past : past + len(h)]
            past += len(h)
            out.append((h[np.argsort(r, kind="stable")] if r.any() else h)[: len(h) - math.ceil(similarity * len(h) - 1e-9) + 1])
        return out, [len(h) for h in sets]

    def only_keys(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in batches(it):
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(prefixes(table)[0]).view(np.int64))], names=["key"])

    counts = docs.select("text").mapInArrow(only_keys, "key long").groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    shared = scratch.keep(counts.where("n > 1"), "shared")
    bits = spark.sparkContext.broadcast(bitmap(shared, "key", _BITS))

    def with_rows(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in batches(it):
            found, sizes = prefixes(table)
            n = np.array([len(x) for x in found])
            flat = np.concatenate(found)
            use = marked(bits.value, flat)
            at = np.arange(len(flat)) - np.repeat(np.cumsum(n) - n, n)
            cols = [np.repeat(table["row"].to_numpy(), n)[use], np.repeat(np.array(sizes, np.int32), n)[use], flat[use].view(np.int64), at[use].astype(np.int32)]
            yield from pa.Table.from_arrays([pa.array(x) for x in cols], names=["row", "size", "key", "at"]).to_batches(1 << 15)

    keys = docs.select("row", "text").mapInArrow(with_rows, "row long, size int, key long, at int")
    return keys.join(by_shuffle(shared), "key")


def _verified(docs: DataFrame, pairs: DataFrame, words: int, similarity: float, scratch: Scratch, tag: str) -> DataFrame:
    """The rows of ``pairs`` (a, b), written, that are as similar as that by their whole sets."""
    # each side's rows are made distinct before they meet: a row may stand in very many pairs
    rows = pairs.select(F.col("a").alias("row")).distinct().union(pairs.select(F.col("b").alias("row")).distinct()).distinct()
    rows = scratch.keep(rows, f"{tag}-wanted")
    wanted = docs.sparkSession.sparkContext.broadcast(bitmap(rows, "row", _BITS))

    def sets(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in batches(it):
            table = table.filter(pa.array(marked(wanted.value, table["row"].to_numpy().view(np.uint64))))
            if table.num_rows:
                found = [x.tobytes() for x in shingle_sets(byte_texts(table["text"]), words)]
                yield from pa.Table.from_arrays([table["row"], pa.array(found, pa.binary())], names=["row", "set"]).to_batches(256)

    whole = docs.select("row", "text").mapInArrow(sets, "row long, set binary")
    whole = scratch.keep(whole.join(by_shuffle(rows), "row", "left_semi").dropDuplicates(["row"]), f"{tag}-sets")

    def verify(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            good = [alike(np.frombuffer(p, np.uint64), np.frombuffer(q, np.uint64)) >= similarity for p, q in zip(batch["p"].to_pylist(), batch["q"].to_pylist())]
            yield pa.RecordBatch.from_arrays([batch["a"], batch["b"]], names=["a", "b"]).filter(pa.array(good, pa.bool_()))

    p, q = whole.select(F.col("row").alias("a"), F.col("set").alias("p")), whole.select(F.col("row").alias("b"), F.col("set").alias("q"))
    sure = pairs.join(by_shuffle(p), "a").join(by_shuffle(q), "b")
    sure = scratch.keep(sure.select("a", "b", "p", "q").mapInArrow(verify, "a long, b long"), f"{tag}-sure")
    scratch.drop(f"{tag}-sets", f"{tag}-wanted")
    return sure


def near_groups(docs: DataFrame, words: int = WORDS, similarity: float = SIMILARITY) -> DataFrame:
    """(doc_id, row, keep) of every row of ``docs`` (doc_id, text): its group's row that stays, the smallest doc_id.

    Rows that share id and text are one. A null id is larger than any other. A text of fewer than ``words`` words
    is one shingle; texts without words, null ones too, are near copies of each other only. Very long texts are
    compared whole; an empty table gives no row.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    scratch = Scratch(spark, "near")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", row_name().alias("row"))

    def sketch(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in batches(it):
            fps, sizes, wholes = [], [], []
            for h in shingle_sets(byte_texts(table["text"]), words, repeats=True):
                fps.append(fingerprint(h))
                kept = np.unique(h)
                sizes.append(len(kept))
                wholes.append(hashlib.blake2b(kept.tobytes(), digest_size=16).digest())
            cols = [table["doc_id"].combine_chunks(), table["row"].combine_chunks(), pa.array(np.array(fps, np.uint64).view(np.int64)), pa.array(sizes, pa.int32()), pa.array(wholes, pa.binary())]
            yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "row", "fp", "size", "whole"])

    rows = scratch.keep(docs.mapInArrow(sketch, "doc_id long, row long, fp long, size int, whole binary"), "rows")
    same = rows.groupBy("whole").agg(F.min("row").alias("a"))
    same = scratch.keep(rows.join(by_shuffle(same), "whole").where("row <> a").select("a", F.col("row").alias("b")).distinct(), "same")
    # operator 3: fingerprints within three bits; equal fingerprints stand as one node
    nodes = scratch.keep(rows.groupBy("fp").agg(F.min("row").alias("node"), F.count(F.lit(1)).alias("n")), "nodes")
    x, y = nodes.select(F.col("fp").alias("x"), F.col("node").alias("a")), nodes.select(F.col("fp").alias("y"), F.col("node").alias("b"))
    linked = links(nodes.select("fp")).join(by_shuffle(x), "x").join(by_shuffle(y), "y").select("a", "b")
    equal = rows.join(by_shuffle(nodes.where("n > 1")), "fp").where("row <> node").select(F.col("node").alias("a"), F.col("row").alias("b"))
    def may(n: Column, i: Column, m: Column, j: Column) -> Column:
        """Whether sets of n and m shingles whose first shared key stands at i and j can be near."""
        return F.least(n - i, m - j) * (1 + similarity) >= similarity * (n + m) - 1e-6

    # prefix keys; from here one row stands for each whole set
    keys = prefix_keys(docs, words, similarity, scratch).join(by_shuffle(same.select(F.col("b").alias("row"))), "row", "left_anti")
    keys = scratch.keep(keys, "keys")
    company = keys.groupBy("row").agg(F.sum("n").alias("company"))
    best = F.struct("company", "row", "size", "at")
    met = keys.drop("n").join(by_shuffle(company), "row")
    hubs = met.groupBy("key").agg(F.max(best).alias("hub"))
    near_hub = keys.join(by_shuffle(hubs), "key").where((F.col("row") != F.col("hub.row")) & may(F.col("size"), F.col("at"), F.col("hub.size"), F.col("hub.at"))).select(F.col("row").alias("a"), F.col("hub.row").alias("b"))
    pairs = near_hub.union(linked).union(equal).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    pairs = scratch.keep(pairs, "pairs")
    sure = same.union(_verified(docs, pairs, words, similarity, scratch, "first"))
    groups = components(sure, scratch, "first-cc")
    keys = keys.drop("n").join(by_shuffle(groups), F.col("row") == F.col("node"), "left").select("key", "row", "size", "at", F.coalesce("component", "row").alias("group"))
    open_ = keys.groupBy("key").agg(F.min("group").alias("low"), F.max("group").alias("high")).where("low <> high").select("key")
    keys = scratch.keep(keys.join(by_shuffle(open_), "key"), "open")
    x, y = (keys.select("key", *[F.col(c).alias(f"{c}{i}") for c in ("row", "size", "at", "group")]) for i in (1, 2))
    rest = x.join(by_shuffle(y), "key").where((F.col("row1") < F.col("row2")) & (F.col("group1") != F.col("group2")) & may(F.col("size1"), F.col("at1"), F.col("size2"), F.col("at2")))
    rest = rest.select(F.col("row1").alias("a"), F.col("row2").alias("b")).distinct().join(by_shuffle(pairs), ["a", "b"], "left_anti")
    sure = sure.union(_verified(docs, scratch.keep(rest, "rest"), words, similarity, scratch, "rest"))
    found = rows.select("doc_id", "row").distinct().join(by_shuffle(components(sure, scratch)), F.col("row") == F.col("node"), "left")
    found = scratch.keep(found.select("doc_id", "row", F.coalesce("component", "row").alias("group")), "found")
    scratch.drop("pairs", "rest", "rows", "nodes", "same", "keys", "shared", "common", "open")
    firsts = found.groupBy("group").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row"))["row"].alias("keep"))
    return found.join(by_shuffle(firsts), "group").select("doc_id", "row", "keep")


def row_name() -> Column:
    return F.xxhash64(F.col("doc_id").cast("long"), F.col("text"))


def drop_near(docs: DataFrame, words: int = WORDS, similarity: float = SIMILARITY) -> DataFrame:
    """The rows of ``docs`` that stay, one of each group of near copies, with their columns as they were.

    Of a group the smallest doc_id stays; rows that share id and text stay or go together.
    """
    scratch = Scratch(docs.sparkSession, "drop-near")
    gone = scratch.keep(near_groups(docs, words, similarity).where("row <> keep").select(F.col("row").alias("__gone")), "gone")
    return docs.join(gone, row_name() == F.col("__gone"), "left_anti")
