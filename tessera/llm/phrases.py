"""Operator 11: phrases mined with counting quotient filters.

Words get numbers, and a run of two or three words is its words' numbers packed side by side. An invertible map
spreads the packed runs; the top bits of what comes out are the quotient, all other bits the remainder, so a filter
is a set of exact counters and not a sketch. Filters are sorted by what they hold: the filters of two tasks merge
like sorted lists, and a range of quotients is a shard of all of them.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from tessera.llm.common import _MIX, Scratch, Words, batches, bitmap, bounded_batches, byte_texts, documents, marked, mix64

LEAST, COVER, TOP = 10, 50, 2000
#: At most this many words, of at most so many bytes, are numbered and broadcast: 21 bits a word, three in 63 bits.
HEAD, HEAD_BYTES, _ID_BITS = 1 << 20, 64, 21
#: Bits of the bitmap that tells which other words may be frequent.
BITS = 27
#: Counters a task holds before it sends them, and runs of words a shard is planned for.
MOST, SHARD_RUNS = 1 << 21, 1 << 22
_BATCH = 4 << 20

# --- the invertible map -------------------------------------------------------------------------------------------

_A, _B = 0xD6E8FEB86659FD93, int(_MIX)
_A_BACK, _B_BACK = (np.uint64(pow(x, -1, 1 << 64)) for x in (_A, _B))


def unmix64(x: np.ndarray) -> np.ndarray:
    """What ``mix64`` made ``x`` of."""
    x = x ^ (x >> np.uint64(32))
    x = x * _B_BACK
    x = x ^ (x >> np.uint64(29)) ^ (x >> np.uint64(58))
    x = x * _A_BACK
    return x ^ (x >> np.uint64(32))


def _salt(keys: np.ndarray) -> np.ndarray:
    out = np.zeros(keys.shape[1], np.uint64)
    for row in keys[:0:-1]:
        out = mix64(row + out)
    return out


def permute(keys: np.ndarray) -> np.ndarray:
    """Keys (limbs, n): the first limb becomes a spread function of all, the others stay; ``restore`` undoes it."""
    return np.concatenate((mix64(keys[0] + _salt(keys))[None], keys[1:]))


def restore(keys: np.ndarray) -> np.ndarray:
    return np.concatenate(((unmix64(keys[0]) - _salt(keys))[None], keys[1:]))


# --- filters ------------------------------------------------------------------------------------------------------


def combined(keys: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys and the sums of their counts (one each if none are given)."""
    if len(keys) == 1 and counts is None:
        keys = np.sort(keys, axis=1)
    else:
        order = np.argsort(keys[0], kind="stable") if len(keys) == 1 else np.lexsort(keys[::-1])
        keys, counts = keys[:, order], None if counts is None else counts[order]
    n = keys.shape[1]
    first = np.flatnonzero(np.concatenate((np.ones(min(n, 1), bool), (keys[:, 1:] != keys[:, :-1]).any(0))))
    sums = np.diff(np.append(first, n)) if counts is None else np.add.reduceat(counts, first) if n else counts
    return keys[:, first], sums


_HEAD = struct.Struct("<BBBxIQ")
_ESCAPE = 255


def pack_filter(keys: np.ndarray, counts: np.ndarray, shard: int, shard_bits: int) -> bytes:
    """A filter of sorted permuted keys (limbs, n) whose top ``shard_bits`` bits are ``shard``.

    The quotient is the next ``q`` bits, about log2 n: a bit for each quotient that occurs and a bit for each slot
    that ends a quotient's run tell it. Remainders are whole bytes of the first limb and the other limbs. Counters
    take a byte; larger ones stand behind in order.
    """
    limbs, n = keys.shape
    whole = min(8, -(-max(0, 64 - shard_bits - max(n, 1).bit_length()) // 8))
    q = max(0, 64 - shard_bits - 8 * whole)
    quotient = (keys[0] >> np.uint64(8 * whole)).astype(np.int64) & ((1 << q) - 1) if whole < 8 else np.zeros(n, np.int64)
    occupied = np.zeros(1 << q, bool)
    occupied[quotient] = True
    ends = np.append(quotient[1:] != quotient[:-1], [True] * min(n, 1))
    low = keys[0].astype("<u8").view(np.uint8).reshape(n, 8)[:, :whole]
    small = np.minimum(counts, _ESCAPE).astype(np.uint8)
    more = counts[small == _ESCAPE]
    return b"".join((
        _HEAD.pack(limbs, whole, shard_bits, len(more), n), struct.pack("<QB", shard, q), np.packbits(occupied).tobytes(), np.packbits(ends).tobytes(),
        low.tobytes(), keys[1:].astype("<u8").tobytes(), small.tobytes(), more.astype("<i8").tobytes(),
    ))


def unpack_filter(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(sorted permuted keys, counts) of a filter."""
    limbs, whole, shard_bits, escaped, n = _HEAD.unpack_from(raw)
    shard, q = struct.unpack_from("<QB", raw, _HEAD.size)
    at = _HEAD.size + 9

    def take(kind: str, count: int) -> np.ndarray:
        nonlocal at
        out = np.frombuffer(raw, kind, count, at)
        at += out.nbytes
        return out

    occupied = np.flatnonzero(np.unpackbits(take("u1", -(-(1 << q) // 8)), count=1 << q))
    ends = np.unpackbits(take("u1", -(-n // 8)), count=n)
    quotient = occupied[np.cumsum(ends) - ends]
    first = np.zeros((n, 8), np.uint8)
    first[:, :whole] = take("u1", n * whole).reshape(n, whole)
    keys = np.empty((limbs, n), np.uint64)
    keys[0] = first.view("<u8").reshape(n)
    if whole < 8:
        keys[0] |= quotient.astype(np.uint64) << np.uint64(8 * whole)
    if shard_bits:
        keys[0] |= np.uint64(shard) << np.uint64(64 - shard_bits)
    keys[1:] = take("<u8", n * (limbs - 1)).reshape(limbs - 1, n)
    counts = take("u1", n).astype(np.int64)
    counts[counts == _ESCAPE] = take("<i8", escaped)
    return keys, counts


class Filter:
    """Sorted runs of counters that are merged when they have grown to ``most`` together."""

    def __init__(self, limbs: int, most: int = MOST) -> None:
        self.limbs, self.most = limbs, most
        self.fresh: list[np.ndarray] = []
        self.runs: list[tuple[np.ndarray, np.ndarray]] = []
        self.n_fresh = self.n = 0

    def add(self, keys: np.ndarray) -> None:
        """Counts packed keys (limbs, n) once each."""
        self.fresh.append(keys)
        self.n_fresh += keys.shape[1]
        if self.n_fresh >= self.most // 4:
            self._sort()

    def _sort(self) -> None:
        if self.n_fresh:
            self.add_run(*combined(permute(np.concatenate(self.fresh, 1))))
        self.fresh, self.n_fresh = [], 0

    def add_run(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.runs.append((keys, counts))
        self.n += keys.shape[1]
        # like sizes merge, so that every counter is merged a logarithm of times
        while len(self.runs) > 1 and self.runs[-2][0].shape[1] <= 2 * self.runs[-1][0].shape[1]:
            (a, x), (b, y) = self.runs.pop(), self.runs.pop()
            self.n -= a.shape[1] + b.shape[1]
            a, x = combined(np.concatenate((a, b), 1), np.concatenate((x, y)))
            self.runs.append((a, x))
            self.n += a.shape[1]

    @property
    def full(self) -> bool:
        return self.n >= self.most

    def take(self) -> tuple[np.ndarray, np.ndarray]:
        """All counters, sorted; the filter is empty then."""
        self._sort()
        keys, counts = np.empty((self.limbs, 0), np.uint64), np.empty(0, np.int64)
        if self.runs:
            keys, counts = (np.concatenate(x, -1) for x in zip(*self.runs))
            keys, counts = combined(keys, counts) if len(self.runs) > 1 else (keys, counts)
        self.runs, self.n = [], 0
        return keys, counts

    def shards(self, bits: int) -> Iterator[tuple[int, bytes]]:
        """(shard, filter) of all counters, by the top ``bits`` bits."""
        keys, counts = self.take()
        shard = keys[0] >> np.uint64(64 - bits) if bits else np.zeros(keys.shape[1], np.uint64)
        first = np.flatnonzero(np.concatenate((np.ones(min(len(shard), 1), bool), shard[1:] != shard[:-1])))
        for a, b in zip(first.tolist(), np.append(first[1:], len(shard)).tolist()):
            yield int(shard[a]), pack_filter(keys[:, a:b], counts[a:b], int(shard[a]), bits)


# --- words --------------------------------------------------------------------------------------------------------

_CUT = bytes(0x0A if chr(b) in ".,;:!?\n\v\f\r" else b for b in range(256))


class Pieces(Words):
    """Words of texts with ``joined`` (the next word follows in the same piece) and ``name`` (64 bits, of language and word)."""

    def __init__(self, texts: list[bytes], langs: list[str], salt: int) -> None:
        super().__init__([t.translate(_CUT) for t in texts])
        breaks = np.concatenate(([0], np.cumsum(self.data == 0x0A, dtype=np.int64)))
        self.joined = np.zeros(len(self.start), bool)
        self.joined[:-1] = (self.doc[1:] == self.doc[:-1]) & (breaks[self.start[1:]] == breaks[self.end[:-1]])
        distinct = {x: i for i, x in enumerate(dict.fromkeys(langs))}
        self.langs = list(distinct)
        self.lang = np.fromiter((distinct[x] for x in langs), np.int64, len(langs))[self.doc] if langs else np.empty(0, np.int64)
        of_lang = np.fromiter((xxh64_intdigest(x.encode(), salt) for x in self.langs), np.uint64, len(self.langs))
        self.name = mix64(self.hash ^ of_lang[self.lang])
        self.name[self.name == 0] = 1  # 0 stands for no word

    def distinct(self) -> tuple[np.ndarray, np.ndarray]:
        """(a place of every distinct word, how often it occurs); words that share a name by chance stand apart."""
        _, first, back, count = np.unique(self.name, return_index=True, return_inverse=True, return_counts=True)
        of = first[back]
        same = (self.low == self.low[of]) & (self.high == self.high[of]) & (self.size == self.size[of]) & (self.lang == self.lang[of])
        long_ = np.flatnonzero(same & (self.size > self.EXACT) & (of != np.arange(len(of))))
        for i in long_.tolist():
            j = of[i]
            same[i] = self.raw[self.start[i] : self.end[i]] == self.raw[self.start[j] : self.end[j]]
        odd = np.flatnonzero(~same)
        count = count - np.bincount(back[odd], minlength=len(first))
        return np.concatenate((first, odd)), np.concatenate((count, np.ones(len(odd), np.int64)))


def _texts(table: pa.Table) -> tuple[list[bytes], list[str]]:
    return byte_texts(table["text"]), [x if x is not None else "und" for x in table["lang"].to_pylist()]


def vocabulary(docs: DataFrame, scratch: Scratch, salts: int = 8) -> tuple[DataFrame, int]:
    """(lang, word, name, n) of all distinct words, and the salt with which no two of them share a name."""

    def run(it: Iterator[pa.RecordBatch], salt: int) -> Iterator[pa.RecordBatch]:
        for table in batches(it, _BATCH):
            words = Pieces(*_texts(table), salt)
            at, n = words.distinct()
            text = pa.array([words.raw[a:b] for a, b in zip(words.start[at].tolist(), words.end[at].tolist())], pa.binary()).cast(pa.string())
            lang = pa.array(words.langs, pa.string()).take(pa.array(words.lang[at]))
            yield pa.RecordBatch.from_arrays([lang, text, pa.array(words.name[at].view(np.int64)), pa.array(n)], names=["lang", "word", "name", "n"])

    for salt in range(salts):
        rows = docs.select("text", "lang").mapInArrow(lambda it, salt=salt: run(it, salt), "lang string, word string, name long, n long")
        out = scratch.keep(rows.groupBy("lang", "word", "name").agg(F.sum("n").alias("n")), f"words{salt}")
        if out.groupBy("name").count().where("count > 1").isEmpty():
            return out, salt
        scratch.drop(f"words{salt}")
    raise ValueError(f"{salts} ways to name the words all gave two of them one name")


@dataclass
class Numbered:
    """The most frequent words in the order of their names; a word's number is its place there, from 1."""

    name: np.ndarray
    count: np.ndarray
    lang: pa.Array
    word: pa.Array

    def find(self, names: np.ndarray) -> np.ndarray:
        """Numbers, 0 for a word that has none."""
        if not len(self.name):
            return np.zeros(len(names), np.uint64)
        at = np.minimum(np.searchsorted(self.name, names), len(self.name) - 1)
        return np.where(self.name[at] == names, at + 1, 0).astype(np.uint64)


def numbered(words: DataFrame, least: int, head: int) -> tuple[Numbered, DataFrame]:
    """(the numbered words, the other frequent words): from a count upward that at most ``head`` words reach."""
    frequent = words.where(F.col("n") >= least)
    short = frequent.where(F.octet_length("word") <= HEAD_BYTES)
    step = F.floor(8 * F.log2("n")).cast("int")  # at most 504 steps
    cut, total = 0, 0
    for row in sorted(short.groupBy(step.alias("step")).count().collect(), reverse=True):
        total += row["count"]
        if total > head:
            cut = row["step"] + 1
            break
    in_head = (step >= cut) & (F.octet_length("word") <= HEAD_BYTES)
    got = frequent.where(in_head).select("name", "n", "lang", "word").toArrow()
    name = got["name"].to_numpy().view(np.uint64)
    order = np.argsort(name)
    column = {c: got[c].combine_chunks().take(pa.array(order)) for c in ("n", "lang", "word")}
    return Numbered(name[order], column["n"].to_numpy(), column["lang"], column["word"]), frequent.where(~in_head)


# --- runs of words ------------------------------------------------------------------------------------------------


def count_runs(docs: DataFrame, head: Numbered, others: np.ndarray | None, salt: int, shard_bits: int, most: int = MOST) -> DataFrame:
    """(limbs, shard, filter): counters of all runs of two and three words that may all be frequent.

    A run of numbered words has one limb; a run with any other word has three, the names of its words. ``others``
    is the bitmap of those other words. A task sends its counters when it holds ``most``.
    """
    shift = np.uint64(_ID_BITS)
    shared = docs.sparkSession.sparkContext.broadcast((head, others))  # bounded by HEAD, HEAD_BYTES and BITS

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, others = shared.value
        short, long_ = Filter(1, most), Filter(3, most)

        def sent(of: Filter) -> Iterator[pa.RecordBatch]:
            for shard, payload in of.shards(shard_bits):
                yield pa.RecordBatch.from_arrays([pa.array([of.limbs], pa.int32()), pa.array([shard], pa.int64()), pa.array([payload], pa.binary())], names=["limbs", "shard", "filter"])

        for table in batches(it, _BATCH):
            words = Pieces(*_texts(table), salt)
            number = head.find(words.name)
            fit = number > 0
            if others is not None:
                fit |= marked(others, words.name)
            two = np.flatnonzero(fit[:-1] & fit[1:] & words.joined[:-1])
            more = np.append(fit[2:], False)[two] & words.joined[two + 1]
            three = two[more]
            if others is None:
                short.add((number[two] << shift + shift | number[two + 1] << shift)[None])
                short.add((number[three] << shift + shift | number[three + 1] << shift | number[three + 2])[None])
            else:
                none = np.zeros(len(two), np.int64)
                for at, third in ((two, none), (three, number[three + 2])):
                    whole = (number[at] > 0) & (number[at + 1] > 0) & ((third > 0) if third is not none else True)
                    a = at[whole]
                    short.add((number[a] << shift + shift | number[a + 1] << shift | third[whole].astype(np.uint64))[None])
                    b = at[~whole]
                    last = words.name[b + 2] if third is not none else np.zeros(len(b), np.uint64)
                    long_.add(np.stack((words.name[b], words.name[b + 1], last)))
            for of in (short, long_):
                if of.full:
                    yield from sent(of)
        yield from sent(short)
        yield from sent(long_)

    return docs.select("text", "lang").mapInArrow(run, "limbs int, shard long, filter binary")


_FOUND = "lang string, w1 string, w2 string, w3 string, n1 long, n2 long, n3 long, c1 long, c2 long, c3 long, a long"


def merge_runs(filters: DataFrame, head: Numbered, shard_bits: int, least: int) -> DataFrame:
    """Runs that occur ``least`` times: words, their names (n3 is 0 in runs of two), their counts, ``a``.

    The filters of a shard meet in one task and merge as they come; shards are many enough to hold ``SHARD_RUNS``
    runs each, however often a run occurs. Words and counts of runs with words that have no number are null here.
    """
    schema = pa.schema([(c.split()[0], pa.string() if c.endswith("string") else pa.int64()) for c in _FOUND.split(", ")])
    shared = filters.sparkSession.sparkContext.broadcast(head)
    mask = np.uint64((1 << _ID_BITS) - 1)

    def found(of: Filter) -> pa.RecordBatch:
        head = shared.value
        keys, counts = of.take()
        often = counts >= least
        keys, counts = restore(keys[:, often]), pa.array(counts[often])
        n = len(counts)
        if of.limbs == 3:
            names = [pa.array(x.view(np.int64)) for x in keys]
            return pa.RecordBatch.from_arrays([pa.nulls(n, pa.string())] * 4 + names + [pa.nulls(n, pa.int64())] * 3 + [counts], schema=schema)
        at = [((keys[0] >> np.uint64(k * _ID_BITS)) & mask).astype(np.int64) - 1 for k in (2, 1, 0)]
        index = [pa.array(x, mask=x < 0) for x in at]
        name = [pa.array(np.where(x < 0, 0, head.name[x].view(np.int64))) if len(head.name) else pa.array(x) for x in at]
        count = pa.array(head.count)
        return pa.RecordBatch.from_arrays([head.lang.take(index[0]), *(head.word.take(i) for i in index), *name, *(count.take(i) for i in index), counts], schema=schema)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: tuple[int, int] | None = None
        held: Filter | None = None
        for batch in it:
            for limbs, shard, payload in zip(batch["limbs"].to_pylist(), batch["shard"].to_pylist(), batch["filter"]):
                if (limbs, shard) != now:
                    if held:
                        yield found(held)
                    now, held = (limbs, shard), Filter(limbs)
                held.add_run(*unpack_filter(payload.as_py()))
        if held:
            yield found(held)

    dealt = filters.repartition(1 << shard_bits, "limbs", "shard").sortWithinPartitions("limbs", "shard")
    return dealt.mapInArrow(run, _FOUND)


def _score(a: Column, left: Column, right: Column) -> tuple[Column, Column, Column]:
    """floor(1000000 a a / (l r)), exact while a is below 3e15; with l and r."""
    wide = [x.cast("decimal(16,0)") for x in (a, left, right)]
    up, down = wide[0] * wide[0] * F.lit(1_000_000).cast("decimal(7,0)"), wide[1] * wide[2]
    return F.call_function("div", up, down), left, right


def mine_phrases(docs: DataFrame, least: int = LEAST, cover: int = COVER, top: int = TOP, head: int = HEAD, most: int = MOST, scratch: Scratch | None = None) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of two and three words of every language.

    ``docs`` has text and lang. A null text is empty, a null language is ``und``; an empty table gives no rows;
    repeated rows count each; other columns are not read. A very long text is held whole by one worker. Ties are
    settled by ``a``, then by the phrase's bytes. Words are numbered up to ``head``; runs with rarer words are
    counted by names of 64 bits that are shown to differ, so all counts are exact at any size. Raises ValueError
    should no naming of the words keep them apart (expected from about 1e10 distinct words).
    """
    if not 0 <= head < 1 << _ID_BITS:
        raise ValueError("words are numbered with 21 bits")
    spark = docs.sparkSession
    bounded_batches(spark)
    scratch = scratch or Scratch(spark, "phrases")
    words, salt = vocabulary(docs, scratch)
    by_lang = scratch.keep(words.groupBy("lang").agg(F.sum("n").alias("n")), "langs")
    total = by_lang.agg(F.sum("n")).first()[0] or 0
    numbers, rest = numbered(words, least, head)
    rarer = not rest.isEmpty()
    others = bitmap(rest, "name", BITS, scratch) if rarer else None
    bits = max(0, (2 * total // SHARD_RUNS).bit_length())
    found = scratch.keep(merge_runs(count_runs(docs, numbers, others, salt, bits, most), numbers, bits, least), "runs")
    if rarer:
        named = words.where(F.col("n") >= least)
        wide = found.where("lang is null").drop("lang", "w1", "w2", "w3", "c1", "c2", "c3")
        for k in (1, 2, 3):
            cols = [F.col("name").alias(f"n{k}"), F.col("word").alias(f"w{k}"), F.col("n").alias(f"c{k}")] + ([F.col("lang")] if k == 1 else [])
            wide = wide.join(named.select(*cols), f"n{k}", "left" if k == 3 else "inner")
        found = scratch.keep(found.where("lang is not null").unionByName(wide), "named")
    pairs = found.where("n3 = 0")
    firsts = pairs.select("n1", "n2", F.col("a").alias("f12"))
    lasts = pairs.select(F.col("n1").alias("n2"), F.col("n2").alias("n3"), F.col("a").alias("f23"))
    triples = found.where("n3 <> 0").join(firsts, ["n1", "n2"]).join(lasts, ["n2", "n3"])
    one, two = _score(F.col("a"), F.col("c1"), F.col("f23")), _score(F.col("a"), F.col("f12"), F.col("c3"))
    later = two[0] < one[0]
    triples = triples.select("lang", F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"), "a", *(F.when(later, y).otherwise(x).alias(c) for c, x, y in zip(("score", "l", "r"), one, two)))
    inside = found.where("n3 <> 0").select(F.explode(F.array(F.struct("n1", "n2"), F.struct(F.col("n2").alias("n1"), F.col("n3").alias("n2")))).alias("p"), "a")
    longest = inside.groupBy("p.n1", "p.n2").agg(F.max("a").alias("longer"))
    pairs = pairs.join(longest, ["n1", "n2"], "left").where(F.coalesce(100 * F.col("longer") < cover * F.col("a"), F.lit(True)))
    pairs = pairs.select("lang", F.concat_ws(" ", "w1", "w2").alias("phrase"), "a", *(x.alias(c) for c, x in zip(("score", "l", "r"), _score(F.col("a"), F.col("c1"), F.col("c2")))))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    both = pairs.unionByName(triples).withColumn("__part", F.pmod(F.xxhash64("phrase"), F.lit(64)))
    # a language's best are among the best of its parts
    best = both.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "__part").orderBy(*order))).where(F.col("rank") <= top)
    best = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    return best.join(by_lang, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op11_phrase_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mine_phrases(documents(spark, sf_dir))
