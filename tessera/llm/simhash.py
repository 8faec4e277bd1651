"""Operator 3: SimHash fingerprints linked over Golay codewords.

A 64-bit fingerprint is cut into segments of 21, 21 and 22 bits, each decoded as a (zero-padded) word of the
perfect binary Golay code: every 23-bit word is within three bits of exactly one of 4096 codewords. A word and
its one-bit neighbours decode to one or six codewords, so a segment gives several keys. Of two fingerprints
with at most three differing bits, either the first two segments differ in at most one bit each, or one of them
differs in two or more and the other two segments in at most one bit together. Keys of segment pairs cover
these cases; candidates are compared bit by bit.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import Scratch, batches, bounded_batches, by_shuffle, byte_texts, documents
from tessera.llm.graph import components

#: Fixed value: a generator polynomial of the (23, 12) Golay code, x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1.
GENERATOR = 0b110001110101
SEGMENTS = ((0, 21), (21, 21), (42, 22))
_SHINGLES_AT_ONCE = 1 << 15


def _remainder(x: int) -> int:
    for shift in range(11, -1, -1):
        if x >> (shift + 11) & 1:
            x ^= GENERATOR << shift
    return x


_UNIT = np.array([_remainder(1 << i) for i in range(23)], np.uint32)


def _error_patterns() -> np.ndarray:
    """The one pattern of at most three bits for each of the 2048 syndromes."""
    out = np.zeros(2048, np.uint32)
    for i in range(23):
        out[_UNIT[i]] = 1 << i
        for j in range(i):
            out[_UNIT[i] ^ _UNIT[j]] = 1 << i | 1 << j
            for k in range(j):
                out[_UNIT[i] ^ _UNIT[j] ^ _UNIT[k]] = 1 << i | 1 << j | 1 << k
    return out


_ERRORS = _error_patterns()


def decode(words: np.ndarray) -> np.ndarray:
    """The index (0 to 4095) of the codeword within three bits of each 23-bit word."""
    syndrome = np.zeros(words.shape, np.uint32)
    for i in range(23):
        syndrome ^= np.where(words >> np.uint32(i) & np.uint32(1), _UNIT[i], np.uint32(0))
    return (words ^ _ERRORS[syndrome]) >> np.uint32(11)


def _near(words: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Codeword indices of each word and its one-bit neighbours, as (n, 6) values and which of them count."""
    flips = np.concatenate(([0], 1 << np.arange(bits))).astype(np.uint32)
    got = np.sort(decode(words[:, None] ^ flips), axis=1)
    new = np.concatenate((np.ones((len(got), 1), bool), got[:, 1:] != got[:, :-1]), axis=1)
    order = np.argsort(~new, axis=1, kind="stable")[:, :6]
    return np.take_along_axis(got, order, 1).astype(np.int64), np.take_along_axis(new, order, 1)


def _segments(fingerprints: np.ndarray) -> list[np.ndarray]:
    return [((fingerprints >> np.uint64(at)) & np.uint64((1 << bits) - 1)).astype(np.uint32) for at, bits in SEGMENTS]


def index_keys(fingerprints: np.ndarray) -> np.ndarray:
    """(n, 3): one key a fingerprint in each of the tables AB, AC, BC."""
    a, b, c = (decode(x).astype(np.int64) for x in _segments(fingerprints))
    return np.stack((a << 12 | b, 1 << 24 | a << 12 | c, 2 << 24 | b << 12 | c), axis=1)


def probe_keys(fingerprints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) of every key under which a fingerprint within three bits may stand in the index."""
    segments = _segments(fingerprints)
    near = [_near(x, bits) for x, (_, bits) in zip(segments, SEGMENTS)]
    own = [decode(x).astype(np.int64) for x in segments]
    rows, keys = [], []

    def put(table: int, left: np.ndarray, right: np.ndarray, which: np.ndarray) -> None:
        row, _ = np.nonzero(which)
        rows.append(row)
        keys.append((table << 24 | left << 12 | right)[which])

    (na, ma), (nb, mb), (nc, mc) = near
    n = len(fingerprints)
    both = (ma[:, :, None] & mb[:, None, :]).reshape(n, -1)
    put(0, np.repeat(na, 6, axis=1), np.tile(nb, (1, 6)), both)
    for table, x, y in ((1, 0, 2), (2, 1, 2)):
        (nx, mx), (ny, my) = near[x], near[y]
        put(table, np.repeat(own[x][:, None], 6, axis=1), ny, my)
        put(table, nx, np.repeat(own[y][:, None], 6, axis=1), mx & (nx != own[x][:, None]))
    return np.concatenate(rows), np.concatenate(keys)


def shingle_hashes(text: bytes, words: int, seed: int = 42) -> np.ndarray:
    """XXH64 of each run of ``words`` words of a lower-cased text, repeats included; the whole text where it is shorter."""
    parts = text.lower().split()  # bytes split at the six ASCII spaces and change A-Z only
    joined = b" ".join(parts)
    if len(parts) <= words:
        return np.array([xxhash.xxh64_intdigest(joined, seed)] if parts else [], np.uint64)
    ends = list(accumulate(map(len, parts), lambda x, n: x + 1 + n))
    starts = [0, *(e + 1 for e in ends)]
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(joined[a:b], seed) for a, b in zip(starts, ends[words - 1 :])), np.uint64, len(parts) - words + 1)


def fingerprint(hashes: np.ndarray) -> int:
    """Bits set in over half of the hashes; zero where there is none."""
    total = np.zeros(64, np.int64)
    for at in range(0, len(hashes), _SHINGLES_AT_ONCE):
        part = hashes[at : at + _SHINGLES_AT_ONCE]
        total += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.uint32)
    return int(np.packbits(total * 2 > len(hashes)).view("<u8")[0])


def fingerprints(docs: DataFrame, words: int = 3) -> DataFrame:
    """(doc_id, fp) of every row; null texts have fingerprint zero, repeated rows stay, other columns are not read."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in batches(it, 1 << 20):
            found = [fingerprint(shingle_hashes(x, words)) for x in byte_texts(table["text"])]
            yield pa.RecordBatch.from_arrays([table["doc_id"].combine_chunks(), pa.array(np.array(found, np.uint64).view(np.int64))], names=["doc_id", "fp"])

    bounded_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, fp long")


def links(distinct: DataFrame, most: int = 3) -> DataFrame:
    """Pairs (x, y), x < y, of fingerprints of ``distinct`` (fp) with at most ``most`` (3 or fewer) differing bits."""
    if most > 3:
        raise ValueError("these keys cover at most three differing bits")

    def index(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            fp = batch["fp"].to_numpy()
            keys = index_keys(fp.view(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(keys.reshape(-1)), pa.array(np.repeat(fp, 3))], names=["key", "x"])

    def probe(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            fp = batch["fp"].to_numpy()
            row, key = probe_keys(fp.view(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(fp[row])], names=["key", "y"])

    held, sought = distinct.mapInArrow(index, "key long, x long"), distinct.mapInArrow(probe, "key long, y long")
    near = (held["key"] == sought["key"]) & (F.col("x") < F.col("y")) & (F.bit_count(F.col("x").bitwiseXOR(F.col("y"))) <= most)
    return held.join(by_shuffle(sought), near).select("x", "y").distinct()


def simhash_components(docs: DataFrame, words: int = 3, most: int = 3) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id of every row of ``docs`` (doc_id, text).

    Fingerprints are the nodes, so copies are never paired; a component is named by its smallest doc_id, whatever
    ids its rows share with others. A null id names nothing and links like any other: its row gets the name of its
    component, null only if no row of that has an id. An empty table gives no row. A very long text is held whole by
    one worker, its shingles' digests in bounded parts.
    """
    scratch = Scratch(docs.sparkSession, "simhash")
    rows = scratch.keep(fingerprints(docs, words), "rows")
    nodes = scratch.keep(rows.groupBy("fp").agg(F.min("doc_id").alias("id")), "nodes")
    pairs = scratch.keep(links(nodes.select("fp"), most), "pairs")
    found = components(pairs.select(F.col("x").alias("a"), F.col("y").alias("b")), scratch).withColumnRenamed("node", "fp")
    linked = scratch.keep(nodes.join(by_shuffle(found), "fp", "left").select("fp", "id", F.coalesce("component", "fp").alias("root")), "linked")
    names = linked.groupBy("root").agg(F.min("id").alias("component_id"))
    named = linked.join(by_shuffle(names), "root").select("fp", "component_id")
    return rows.join(by_shuffle(named), "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op3_simhash_golay(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(documents(spark, sf_dir))
