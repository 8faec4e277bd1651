"""Operator 2: text scoring by a probabilistic suffix tree.

A context is a run of up to ``depth`` words, an entry a context and the token after it; every entry that occurs
``LEAST`` times or more in training is learned, so the tree grows with the corpus and a text that occurs twice is
in it. No count is a share of the corpus: more text adds contexts and takes none away, but by the divergence test.

A context s has P_s(w) = max(c(s, w) - D, 0) / N(s) + l_s P_p(w), where p is s without its first word and l_s the
mass that discounting and entries left out free. It is kept if N(s) KL(P_s || P_p) beats half the logarithm of
N(s) for each of its entries; else P_s is P_p. A token is scored from the longest suffix of what stands before it.
The root is the smoothed unigram model over every word.

The logarithm of a token's probability is the root's and, for each context length, either ln(P_s / P_p) of an entry or
ln l_s of a kept context without one. So a text's score is a sum over its runs of words, each looked up on its
own: entries of kept contexts add ln(P_s / P_p) - ln l_s, kept contexts ln l_s wherever they occur. The most
frequent runs (``HOT`` of all tokens or more, so at most 1 / HOT a level) are broadcast, which also takes hot keys
out of the shuffle; all others meet the tree in shards of their hash, as packed blocks, and what a shard knows of the
texts goes on in one packed row for each part of the texts.

Entries are settled in shards too: blocks of them meet the shorter model by suffix, then all of a context by context.

A run can only be an entry if both runs that are shorter by one word are. A bitmap of 2 ** BITS bits tells which of
those may be, another which runs may be in the tree: they spare work, decide nothing, and pass more runs than needed
to the exact count or look-up once there are more entries than they have bits.

Words and runs are known by 64-bit hashes: two that share one (a chance of 2^-64 a pair) are taken for the same.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import Scratch, Words, batches, bounded_batches, byte_texts, crc_mod, documents, marked, mix64

LEAST, DISCOUNT, DEPTH, HOT, BITS = 2, 0.75, 2, 1e-6, 27
#: Bytes of text handled at once, rows packed before they leave a task, runs counted before they do, runs looked up in one shard.
_AT_ONCE, _HOLD, _RUNS, _SHARD = 1 << 19, 2_000_000, 1_000_000, 4_000_000
#: The end of a text, as a token's name; frequent words are named by their place in a table, others by a hash.
END, _TOP = np.uint64(1), np.uint64(1 << 63)
# The five primes of XXH64.
_P1, _P2, _P3, _P4, _P5 = (np.uint64(x) for x in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))


def _turn(x: np.ndarray, by: int) -> np.ndarray:
    return (x << np.uint64(by)) | (x >> np.uint64(64 - by))


def xxhash_long(x: np.ndarray, seed: np.ndarray) -> np.ndarray:
    """XXH64 of 8-byte numbers, as Spark's ``xxhash64`` chains it over columns (first seed 42)."""
    h = (seed + _P5 + np.uint64(8)) ^ (_turn(x * _P2, 31) * _P1)
    h = _turn(h, 27) * _P1 + _P4
    h = (h ^ (h >> np.uint64(33))) * _P2
    h = (h ^ (h >> np.uint64(29))) * _P3
    return h ^ (h >> np.uint64(32))


def tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, index of the text) of all words of all texts, each text followed by its end."""
    words = Words(texts)
    total = words.count + 1
    ends = np.cumsum(total)
    names = np.empty(int(ends[-1]), np.uint64)
    names[np.arange(len(words.hash)) + words.doc] = words.hash
    names[ends - 1] = END
    return names, np.repeat(np.arange(len(texts)), total)


class Table:
    """Values of keys, found by a few gathers: one key a cell, keys that share a cell go to a further, smaller layer."""

    def __init__(self, keys: np.ndarray, **values: np.ndarray) -> None:
        self.layers, size, cells = [], 0, np.empty(len(keys), np.int64)
        left = np.arange(len(keys))
        shift = 0
        while len(left):
            bits = int(2 * len(left)).bit_length()
            mask = np.uint64((1 << bits) - 1)
            cell = ((keys[left] >> np.uint64(shift)) & mask).astype(np.int64)
            held = (~np.arange(1 << bits, dtype=np.uint64) & mask) << np.uint64(shift)  # belongs to another cell
            held[cell] = keys[left]
            won = held[cell] == keys[left]
            cells[left[won]] = cell[won] + size
            self.layers.append((shift, mask, size, held))
            size, left, shift = size + (1 << bits), left[~won], (shift + 7) % 32
        self.values = {name: np.zeros(size, v.dtype) for name, v in values.items()}
        for name, v in values.items():
            self.values[name][cells] = v

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The cell of each key, or -1."""
        out = np.full(len(keys), -1)
        at = np.arange(len(keys))
        for shift, mask, offset, held in self.layers:
            cell = ((keys[at] >> np.uint64(shift)) & mask).astype(np.int64)
            hit = held[cell] == keys[at]
            out[at[hit]] = cell[hit] + offset
            at = at[~hit]
        return out


def _named(hashes: np.ndarray, hot: Table) -> tuple[np.ndarray, np.ndarray]:
    """(names, cells): small numbers for frequent words, 1 for the end, numbers with the top bit set for others."""
    cell = hot.find(hashes)
    return np.where(cell >= 0, cell.astype(np.uint64) + np.uint64(2), np.where(hashes == END, END, hashes | _TOP)), cell


def _places(doc: np.ndarray) -> np.ndarray:
    """Each token's place in its text."""
    first = np.flatnonzero(np.concatenate(([True], doc[1:] != doc[:-1])))
    return np.arange(len(doc)) - np.repeat(first, np.diff(np.concatenate((first, [len(doc)]))))


def _chain(name: np.ndarray, key: np.ndarray | None) -> np.ndarray:
    """Keys of the runs that end at each token, from those of the runs that are shorter by one (None: no token)."""
    return xxhash_long(name, np.full(len(name), 42, np.uint64) if key is None else np.concatenate((key[:1], key[:-1])))


def _word_rows(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (w1, n) of the tokens of texts, counted over some millions before they leave the task."""
    held: list[np.ndarray] = []

    def flush() -> pa.RecordBatch:
        key, n = np.unique(np.concatenate(held), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(n)], names=["w1", "n"])

    for table in batches(it, _AT_ONCE):
        held.append(tokens(byte_texts(table["text"]))[0])
        if sum(map(len, held)) >= _HOLD:
            yield flush()
            held = []
    if held:
        yield flush()


def _merged_key(run: list[np.ndarray]) -> np.ndarray:
    return reduce(lambda seed, x: xxhash_long(x, seed), run, np.full(len(run[0]), 42, np.uint64))


def _merged(run: list[np.ndarray], n: np.ndarray | None = None) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """(keys, runs, numbers) of the distinct runs, given by their first, second ... tokens."""
    key = _merged_key(run)
    order = np.argsort(key)
    key = key[order]
    first = np.flatnonzero(np.concatenate((np.ones(min(1, len(key)), bool), key[1:] != key[:-1])))
    if n is None:
        total = np.diff(np.append(first, len(key)))
    else:
        total = np.add.reduceat(n[order], first) if len(first) else n
    return key[first], [x[order[first]] for x in run], total


def _run_blocks(it: Iterator[pa.RecordBatch], length: int, hot: Table, sieve: np.ndarray | None, shards: int) -> Iterator[pa.RecordBatch]:
    """Packed blocks (shard, w1 .. wk, n) of the runs of ``length`` tokens whose shorter runs the sieve passes."""
    held: list[list[np.ndarray]] = []

    def flush() -> pa.RecordBatch:
        whole = [np.concatenate(x) for x in zip(*held)]
        held.clear()  # the largest of what a worker holds
        key, run, n = _merged(whole)
        del whole
        shard, order = _by_shard(key, shards)
        of, bounds = _stretches(shard[order])
        return pa.RecordBatch.from_arrays([pa.array(of), *(_binaries(x[order], bounds) for x in [*run, n])], names=["shard", *_columns(length), "n"])

    for table in batches(it, _AT_ONCE):
        hashes, doc = tokens(byte_texts(table["text"]))
        name = _named(hashes, hot)[0]
        good = _places(doc) >= length - 1
        if sieve is not None:
            key = reduce(lambda key, _: _chain(name, key), range(length - 1), None)
            may = marked(sieve, key)
            good[1:] &= may[1:] & may[:-1]
        last = np.flatnonzero(good)
        held.append([name[last - length + 1 + i] for i in range(length)])
        if sum(len(x[0]) for x in held) >= _RUNS:
            yield flush()
    if held:
        yield flush()


def _by_shard(key: np.ndarray, shards: int) -> tuple[np.ndarray, np.ndarray]:
    """(shard of each key, the stable order by it); numpy sorts short numbers by their digits."""
    shard = key % np.uint64(shards)
    return shard.astype(np.int32), np.argsort(shard.astype(np.uint16) if shards <= 1 << 16 else shard, kind="stable")


def _stretches(shard: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(shards, bounds) of the stretches of equal, sorted shards."""
    first = np.flatnonzero(np.concatenate(([True], shard[1:] != shard[:-1]))) if len(shard) else np.empty(0, np.int64)
    return shard[first], np.append(first, len(shard))


def _columns(length: int) -> list[str]:
    return [f"w{i + 1}" for i in range(length)]


def word_counts(train: DataFrame) -> DataFrame:
    """(w1, n) of all tokens of ``train`` (text), by their hashes."""
    return train.mapInArrow(_word_rows, "w1 long, n long").groupBy("w1").agg(F.sum("n").alias("n"))


def run_counts(train: DataFrame, length: int, shared: Broadcast, least: int, shards: int) -> DataFrame:
    """Packed blocks (shard of the suffix, keys, context, suffix, n) of the runs of ``length`` tokens of ``train`` (text) that occur ``least`` times or more.

    ``context`` and ``suffix`` are the keys of the run without its last and without its first token.
    ``shared``: the table of frequent words and the bitmap of the shorter runs, or None.
    """
    columns = [*_columns(length), "n"]
    blocks = train.mapInArrow(lambda it: _run_blocks(it, length, *shared.value, shards), ", ".join(["shard int", *(f"{c} binary" for c in columns)]))

    def add(table: pa.Table) -> pa.Table:
        key, run, n = _merged([_joined(table[c], np.uint64) for c in columns[:-1]], _joined(table["n"], np.int64))
        often = n >= least
        run = [x[often] for x in run]
        suffix = _merged_key(run[1:])
        return pa.Table.from_batches([_dealt(suffix, shards, keys=key[often], context=_merged_key(run[:-1]), suffix=suffix, n=n[often])])

    return blocks.groupBy("shard").applyInArrow(add, "shard int, keys binary, context binary, suffix binary, n binary")


#: What a block of a level holds: entries of runs, kept contexts, words of one token without and with a place in the table.
ENTRY, CONTEXT, RARE, FREQUENT = range(4)
_LEVEL = "kind int, shard int, keys binary, n binary, p binary, u binary"
_BELOW = "shard int, keys binary, context binary, n binary, below binary"
#: A context that occurs so often is settled by Spark's aggregates, not in a shard: at most one in so many tokens is, and
#: no other has more than half as many entries.
_WIDE = 1 << 21


def _dealt(by: np.ndarray, shards: int, **columns: np.ndarray) -> pa.RecordBatch:
    """Packed blocks (shard, columns), dealt by the keys ``by``."""
    shard, order = _by_shard(by, shards)
    of, bounds = _stretches(shard[order])
    return pa.RecordBatch.from_arrays([pa.array(of), *(_binaries(x[order], bounds) for x in columns.values())], names=["shard", *columns])


def _level(kind: int, key: np.ndarray, shards: int, n: np.ndarray, p: np.ndarray, u: np.ndarray) -> pa.RecordBatch:
    blocks = _dealt(key, shards, keys=key, n=n.astype(np.int64, copy=False), p=p, u=u)
    return pa.RecordBatch.from_arrays([pa.array(np.full(blocks.num_rows, kind, np.int32)), *blocks.columns], names=["kind", *blocks.schema.names])


def _held(it: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows by the ``_HOLD``, so that there are few blocks."""
    held: list[pa.RecordBatch] = []
    for batch in it:
        held.append(batch)
        if sum(x.num_rows for x in held) >= _HOLD:
            yield pa.Table.from_batches(held)
            held = []
    if held:
        yield pa.Table.from_batches(held)


def _word_level(it: Iterator[pa.RecordBatch], hot: Table, size: float, shards: int) -> Iterator[pa.RecordBatch]:
    """The first level, from rows (w1, n) of words by their hashes."""
    for table in _held(it):
        name, n = _named(table["w1"].to_numpy().view(np.uint64), hot)[0], table["n"].to_numpy()
        key, p, rare = _chain(name, None), (n + 0.5) / size, name >= _TOP
        for kind, of in ((RARE, rare), (FREQUENT, ~rare)):
            yield _level(kind, key[of], shards, n[of], p[of], np.zeros(int(of.sum())))


def _below(runs: pa.Table, shorter: pa.Table, wide: np.ndarray, shards: int) -> pa.Table:
    """The runs of one shard of suffixes, with what the shorter model says of them, dealt by context; those of ``wide`` contexts to shard -1."""
    key, context, suffix = (_joined(runs[c], np.uint64) for c in ("keys", "context", "suffix"))
    model = Table(_joined(shorter["keys"], np.uint64), p=_joined(shorter["p"], np.float64))
    at = model.find(suffix)
    met = at >= 0
    key, context, n, below = key[met], context[met], _joined(runs["n"], np.int64)[met], model.values["p"][at[met]]
    broad = np.isin(context, wide)

    def dealt(of: np.ndarray, by: np.ndarray) -> pa.RecordBatch:
        return _dealt(by, shards, keys=key[of], context=context[of], n=n[of], below=below[of])

    few = dealt(broad, np.zeros(int(broad.sum()), np.uint64))
    few = few.set_column(0, "shard", pa.array(np.full(few.num_rows, -1, np.int32)))
    return pa.Table.from_batches([dealt(~broad, context[~broad]), few])


def _settled(rows: pa.Table, shorter: pa.Table, discount: float, shards: int) -> pa.Table:
    """The model of the contexts of one shard, all entries of which are here: blocks of entries and of kept contexts."""
    context = _joined(rows["context"], np.uint64)
    order = np.argsort(context)
    context = context[order]
    key, n, below = _joined(rows["keys"], np.uint64)[order], _joined(rows["n"], np.int64)[order], _joined(rows["below"], np.float64)[order]
    first = _stretches(context)[1][:-1]
    entries = np.diff(np.append(first, len(context)))

    def sums(values: np.ndarray) -> np.ndarray:
        return np.add.reduceat(values, first) if len(first) else np.empty(0)

    counts = Table(_joined(shorter["keys"], np.uint64), n=_joined(shorter["n"], np.int64))
    total = counts.values["n"][counts.find(context[first])] if len(first) else np.empty(0)
    rest = np.maximum(1 - sums(n - discount) / total, 1e-12)
    own = (n - discount) / np.repeat(total, entries) + np.repeat(rest, entries) * below
    more, free = np.log(own / below), np.log(rest)
    kept = total * (sums(own * more) + rest * np.maximum(1 - sums(below), 0.0) * free) > 0.5 * entries * np.log(total)
    use = np.repeat(kept, entries)
    u = np.where(use, more - np.repeat(free, entries), 0.0)
    blocks = [
        _level(ENTRY, key, shards, n, np.where(use, own, below), u),
        _level(CONTEXT, context[first][kept], shards, total[kept], np.zeros(int(kept.sum())), free[kept]),
    ]
    return pa.Table.from_batches(blocks)


def _wide_rows(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in it:
        columns = [_joined(batch[c], kind) for c, kind in (("keys", np.int64), ("context", np.int64), ("n", np.int64), ("below", np.float64))]
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=["key", "context", "n", "below"])


def _packed(rows: DataFrame, kind: int, shards: int) -> DataFrame:
    """Rows (key, n, p, u) as blocks of a level."""

    def pack(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _held(it):
            yield _level(kind, table["key"].to_numpy().view(np.uint64), shards, *(table[c].to_numpy() for c in ("n", "p", "u")))

    return rows.select("key", "n", "p", "u").mapInArrow(pack, _LEVEL)


def _settle_wide(scratch: Scratch, rows: DataFrame, totals: DataFrame, length: int, discount: float, shards: int) -> DataFrame:
    """As ``_settled`` for the wide contexts, whose entries (key, context, n, below) stay where they are: only sums are shuffled, and ``totals`` (context, total) has a bound."""
    sums = rows.groupBy("context").agg(F.sum(F.col("n") - discount).alias("taken"), F.sum("below").alias("covered"), F.count(F.lit(1)).alias("entries"))
    sums = sums.join(F.broadcast(totals), "context").withColumn("rest", F.greatest(1 - F.col("taken") / F.col("total"), F.lit(1e-12)))
    sums = scratch.keep(sums, f"wide{length}")
    own = (F.col("n") - discount) / F.col("total") + F.col("rest") * F.col("below")
    rows = rows.join(F.broadcast(sums.select("context", "total", "rest")), "context").select("key", "context", "n", "below", own.alias("own"))
    gains = rows.groupBy("context").agg(F.sum(F.col("own") * F.log(F.col("own") / F.col("below"))).alias("gain"))
    free = F.col("rest") * F.greatest(1 - F.col("covered"), F.lit(0.0)) * F.log("rest")
    kept = sums.join(F.broadcast(gains), "context").where(F.col("total") * (F.col("gain") + free) > 0.5 * F.col("entries") * F.log("total"))
    kept = scratch.keep(kept.select(F.col("context").alias("key"), F.col("total").alias("n"), F.lit(0.0).alias("p"), F.log("rest").alias("u")), f"widekept{length}")
    rows = rows.join(F.broadcast(kept.select(F.col("key").alias("context"), F.col("u").alias("free"))), "context", "left")
    use = F.col("free").isNotNull()
    rows = rows.select(
        "key", "n", F.when(use, F.col("own")).otherwise(F.col("below")).alias("p"),
        F.when(use, F.log(F.col("own") / F.col("below")) - F.col("free")).otherwise(0.0).alias("u"),
    )
    return _packed(rows, ENTRY, shards).unionAll(_packed(kept, CONTEXT, shards))


def settle(scratch: Scratch, runs: DataFrame, shorter: DataFrame, length: int, discount: float, shards: int) -> DataFrame:
    """The level of ``length``, blocks of entries (n, p, u) and of kept contexts (n, u), from that of the next shorter runs.

    Entries meet the shorter model by their suffix, then their context's others, as packed blocks: a row for each costs
    every join and sum many times what numpy takes for it.
    """
    spark = scratch.spark
    shorter = shorter.where(F.col("kind") != CONTEXT)
    often = _often(shorter, _WIDE).toArrow()
    wide = np.sort(often["key"].to_numpy().view(np.uint64))
    met = runs.groupBy("shard").cogroup(shorter.select("shard", "keys", "p").groupBy("shard"))
    rows = scratch.keep(met.applyInArrow(lambda a, b: _below(a, b, wide, shards), _BELOW), f"below{length}")
    met = rows.where("shard >= 0").groupBy("shard").cogroup(shorter.select("shard", "keys", "n").groupBy("shard"))
    level = met.applyInArrow(lambda a, b: _settled(a, b, discount, shards), _LEVEL)
    if len(wide):
        totals = spark.createDataFrame(often.select(["key", "n"]).rename_columns(["context", "total"]))
        broad = rows.where("shard < 0").mapInArrow(_wide_rows, "key long, context long, n long, below double")
        level = level.unionAll(_settle_wide(scratch, broad, totals, length, discount, shards))
    level = scratch.keep(level, f"level{length}")
    scratch.drop(f"below{length}")
    return level


def _often(level: DataFrame, least: float) -> DataFrame:
    """Rows (key, n, u) of the blocks of a level, of what occurs ``least`` times or more."""

    def pick(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            key, n, u = (_joined(batch[c], kind) for c, kind in (("keys", np.int64), ("n", np.int64), ("u", np.float64)))
            of = n >= least
            yield pa.RecordBatch.from_arrays([pa.array(x[of]) for x in (key, n, u)], names=["key", "n", "u"])

    return level.select("keys", "n", "u").mapInArrow(pick, "key long, n long, u double")


def _state_rows(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (key, known, base, u) of what adds to a score, from blocks of levels."""
    for batch in it:
        key, n, u = (_joined(batch[c], kind) for c, kind in (("keys", np.int64), ("n", np.int64), ("u", np.float64)))
        kind = np.repeat(batch["kind"].to_numpy(), [len(x) // 8 for x in batch["keys"].to_pylist()])
        rare = kind == RARE
        of = rare | (kind == CONTEXT) | (u != 0)
        columns = [key, rare.astype(np.int8), np.where(rare, np.log((n + 0.5) / 0.5), 0.0), u]
        yield pa.RecordBatch.from_arrays([pa.array(x[of]) for x in columns], names=["key", *_STATE])


#: Bits of a piece of a bitmap.
_PIECE = 19


def _marks(it: Iterator[list[np.ndarray]]) -> Iterator[pa.RecordBatch]:
    """Rows (piece, low): the low bits of some millions of keys, as steps, by piece of the bitmap."""
    held: list[np.ndarray] = []

    def flush() -> pa.RecordBatch:
        low = np.sort((np.concatenate(held) & np.uint64((1 << BITS) - 1)).astype(np.int32))
        low = low[np.diff(low, prepend=np.int32(-1)) > 0]
        of, bounds = _stretches(low >> _PIECE)
        return pa.RecordBatch.from_arrays([pa.array(of), _planes(_steps(low, bounds), bounds)], names=["piece", "low"])

    for keys in it:
        held += keys
        if sum(map(len, held)) >= _HOLD:
            yield flush()
            held = []
    if held:
        yield flush()


def _sieve(blocks: DataFrame, read: Callable[[pa.RecordBatch], list[np.ndarray]], scratch: Scratch, name: str) -> np.ndarray:
    """``bitmap`` of the keys that ``read`` takes from packed blocks."""
    marks = blocks.mapInArrow(lambda it: _marks(read(batch) for batch in it), "piece int, low binary")

    def add(table: pa.Table) -> pa.Table:
        bits = np.zeros(1 << _PIECE, bool)
        for low in table["low"].to_pylist():
            bits[np.cumsum(_from_planes(low, np.int32)) & ((1 << _PIECE) - 1)] = True
        return pa.table({"piece": table["piece"].slice(0, 1), "mask": [np.packbits(bits, bitorder="little").tobytes()]})

    found = scratch.keep(marks.groupBy("piece").applyInArrow(add, "piece int, mask binary"), name).toArrow()
    out = np.zeros((1 << (BITS - _PIECE), 1 << (_PIECE - 3)), np.uint8)
    for piece, mask in zip(found["piece"].to_pylist(), found["mask"].to_pylist()):
        out[piece] = np.frombuffer(mask, np.uint8)
    return out.ravel().view(np.uint64)


def _level_keys(blocks: pa.RecordBatch) -> list[np.ndarray]:
    return [np.frombuffer(x, np.uint64) for x in blocks["keys"].to_pylist()]


def _binaries(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """One binary for each stretch of ``values`` between two bounds."""
    offsets = (bounds * values.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values))])


def _to_planes(values: np.ndarray) -> bytes:
    """The lowest byte of every number, then the next, and so on: what is alike in them shrinks to nothing in the shuffle."""
    return np.ascontiguousarray(values).view(np.uint8).reshape(-1, values.itemsize).T.tobytes()


def _from_planes(block: bytes, kind: type) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(block, np.uint8).reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


def _planes(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """As ``_binaries``, in planes."""
    return pa.array([_to_planes(values[a:b]) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())], pa.binary())


_DOC = np.dtype([("row", "<i8"), ("doc_id", "<i8"), ("null", "?"), ("n", "<i8"), ("known", "<i8"), ("base", "<f8"), ("u", "<f8")])
_BLOCK = "shard int, at long, keys binary, docs binary, rows binary"
_PART = "part int, shard int, own binary, row binary, u binary, rare binary, known binary, base binary"
_SUMS = "doc_id long, n long, known long, base double, u double"


class Scan:
    """Adds up what the broadcast tables know of each text and packs the other runs of words into blocks by shard."""

    def __init__(self, words: Table, runs: Table, sieve: np.ndarray, end: int, total: int, distinct: int, depth: int, shards: int) -> None:
        self.words, self.runs, self.sieve, self.end, self.depth, self.shards = words, runs, sieve, end, depth, shards
        self.size = total + 0.5 * (distinct + 1)

    def __call__(self, it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = TaskContext.get().partitionId() << 40
        for table in batches(it, _AT_ONCE):
            yield self.block(table, at)
            at += table.num_rows

    def block(self, table: pa.Table, at: int) -> pa.RecordBatch:
        hashes, doc = tokens(byte_texts(table["text"]))
        d, place = table.num_rows, _places(doc)
        name, cell = _named(hashes, self.words)
        n = np.where(cell >= 0, self.words.values["n"][cell] if len(self.words.layers) else 0, np.where(name == END, self.end, 0))
        u = np.zeros(d)
        key, keys, docs = None, [], []
        for before in range(self.depth + 1):  # a run of before + 1 tokens ends here
            key = _chain(name, key)
            ask = np.flatnonzero((place >= before) & ((name != END) | (before > 0)))
            found = self.runs.find(key[ask])
            if before == 0:
                found[name[ask] >= _TOP] = -1  # their number is looked up, too
            hit = found >= 0
            if hit.any():
                u += np.bincount(doc[ask[hit]], self.runs.values["u"][found[hit]], d)
            ask = ask[~hit]
            ask = ask[marked(self.sieve, key[ask])]
            keys.append(key[ask])
            docs.append(doc[ask])
        ids = table["doc_id"].combine_chunks()
        rows = np.zeros(d, _DOC)
        rows["row"], rows["doc_id"], rows["null"] = at + np.arange(d), ids.fill_null(0).to_numpy(zero_copy_only=False), ids.is_null().to_numpy(zero_copy_only=False)
        rows["n"], rows["known"] = np.bincount(doc, minlength=d), np.bincount(doc[n > 0], minlength=d)
        rows["base"], rows["u"] = np.bincount(doc, np.log((n + 0.5) / self.size), d), u
        key, doc = np.concatenate(keys), np.concatenate(docs).astype(np.int32)
        by_doc = np.argsort(doc, kind="stable")
        key, doc = key[by_doc], doc[by_doc]
        shard, order = _by_shard(key, self.shards)
        of, bounds = _stretches(shard[order])
        of = np.append(of, np.int32((at >> 40) % self.shards))  # the last block holds the texts' own sums
        own = np.append(np.zeros(len(of), np.int64), d)
        bounds = np.append(bounds, len(key))
        doc = doc[order]
        step = np.diff(doc, prepend=np.int32(0))  # texts rise within a block: zeros and ones, which shrink in the shuffle
        step[bounds[:-2]] = doc[bounds[:-2]]
        columns = [pa.array(of), pa.array(np.full(len(of), at)), _binaries(key[order], bounds), _planes(step, bounds), _binaries(rows, own)]
        return pa.RecordBatch.from_arrays(columns, names=["shard", "at", "keys", "docs", "rows"])


_STATE = {"known": np.int8, "base": np.float64, "u": np.float64}


def _state_blocks(it: Iterator[pa.RecordBatch], shards: int) -> Iterator[pa.RecordBatch]:
    """Rows (key, known, base, u) as packed blocks by shard: a row for each of millions costs the shuffle several times its bytes."""
    held: list[pa.RecordBatch] = []

    def flush() -> pa.RecordBatch:
        table = pa.Table.from_batches(held)
        key = table["key"].to_numpy().view(np.uint64)
        shard, order = _by_shard(key, shards)
        of, bounds = _stretches(shard[order])
        values = (_binaries(table[c].to_numpy().astype(kind)[order], bounds) for c, kind in _STATE.items())
        return pa.RecordBatch.from_arrays([pa.array(of), _binaries(key[order], bounds), *values], names=["shard", "keys", *_STATE])

    for batch in it:
        held.append(batch)
        if sum(x.num_rows for x in held) >= _HOLD:
            yield flush()
            held = []
    if held:
        yield flush()


def _small_states(it: Iterator[pa.RecordBatch], shards: int) -> Iterator[pa.RecordBatch]:
    """Blocks of states by shard, in the order of their keys: steps between these, without what the shard tells, take five bytes or six, not eight."""
    for batch in _state_blocks(it, shards):
        rows = []
        for block in batch.to_pylist():
            key = np.frombuffer(block["keys"], np.uint64) // np.uint64(shards)
            order = np.argsort(key)
            steps = np.diff(key[order], prepend=np.uint64(0))
            rows.append({"shard": block["shard"], "keys": _to_planes(steps), **{c: _to_planes(np.frombuffer(block[c], kind)[order]) for c, kind in _STATE.items()}})
        yield pa.RecordBatch.from_pylist(rows, pa.schema([("shard", pa.int32()), *((c, pa.binary()) for c in ("keys", *_STATE))]))


def _state_keys(blocks: pa.Table | pa.RecordBatch, shards: int) -> list[np.ndarray]:
    return [np.cumsum(_from_planes(x, np.uint64)) * np.uint64(shards) + np.uint64(shard) for x, shard in zip(blocks["keys"].to_pylist(), blocks["shard"].to_pylist())]


def _read_states(blocks: pa.Table, shards: int) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """(keys, values) of the blocks of one shard."""
    keys = _state_keys(blocks, shards)
    values = {c: [_from_planes(x, kind) for x in blocks[c].to_pylist()] for c, kind in _STATE.items()}
    return np.concatenate([np.empty(0, np.uint64), *keys]), {c: np.concatenate([np.empty(0, _STATE[c]), *v]) for c, v in values.items()}


def _numbers(blocks: list[bytes], kind: np.dtype | type) -> np.ndarray:
    return np.concatenate([np.empty(0, kind), *(np.frombuffer(x, kind) for x in blocks)])


def _joined(column: pa.ChunkedArray, kind: np.dtype | type) -> np.ndarray:
    return _numbers(column.to_pylist(), kind)


def _steps(rows: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Differences of rising numbers, from zero at the start of every stretch."""
    step = np.diff(rows, prepend=rows[:1])
    first = bounds[:-1][bounds[:-1] < bounds[1:]]
    step[first] = rows[first]
    return step


def _look_up(blocks: pa.Table, states: pa.Table, shards: int) -> pa.Table:
    """What the tree knows of the runs of one shard, added up by text, and the sums that came along.

    A row for each part of the texts, which are as many as shards: one for each text of a shard would be as many as texts
    times shards. All blocks of a text lie in its part. Sums of the tree are packed beside their texts, those of rare words apart as few texts have any.
    """
    key, values = _read_states(states, shards)
    key, place = np.unique(key, return_inverse=True)
    tree = Table(key, **{c: np.bincount(place, v, len(key)) for c, v in values.items()})
    ats = blocks["at"].to_numpy()
    part = (mix64(ats.astype(np.uint64)) % np.uint64(shards)).astype(np.int32)
    order = np.lexsort((ats, part))  # part by part, and texts rise within each
    ats, of = ats[order], part[order]

    def column(name: str) -> list[bytes]:
        cells = blocks[name].to_pylist()
        return [cells[i] for i in order.tolist()]

    found = tree.find(_numbers(column("keys"), np.uint64))
    docs = [np.cumsum(_from_planes(x, np.int32), dtype=np.int64) for x in column("docs")]
    sizes = np.array([int(x[-1]) + 1 if len(x) else 0 for x in docs], np.int64)
    starts = np.cumsum(sizes) - sizes  # the texts of all blocks in one count
    count = int(sizes.sum())
    text = np.concatenate([np.empty(0, np.int64), *(x + start for x, start in zip(docs, starts.tolist()))])
    hit = found >= 0
    text, found = text[hit], found[hit]
    known, base, u = (np.bincount(text, tree.values[c][found], count) for c in ("known", "base", "u"))
    row = np.arange(count) - np.repeat(starts - ats, sizes)
    rows = column("rows")
    held, own = np.repeat(of, sizes), np.repeat(of, np.array([len(x) // _DOC.itemsize for x in rows], np.int64))
    shown = np.unique(of)

    def bounds(of: np.ndarray) -> np.ndarray:
        return np.append(np.searchsorted(of, shown), len(of))

    some, rare = np.flatnonzero(u), np.flatnonzero(known)
    by_u, by_rare = bounds(held[some]), bounds(held[rare])
    columns = [
        pa.array(shown), pa.array(np.full(len(shown), blocks["shard"][0].as_py() if len(shown) else 0, np.int32)), _binaries(_numbers(rows, _DOC), bounds(own)),
        _planes(_steps(row[some], by_u), by_u), _binaries(u[some], by_u), _planes(_steps(row[rare], by_rare), by_rare), _planes(known[rare].astype(np.int64), by_rare), _binaries(base[rare], by_rare),
    ]
    return pa.Table.from_arrays(columns, names=["part", "shard", "own", "row", "u", "rare", "known", "base"])


def _add_up(part: pa.Table) -> pa.Table:
    """The sums of every text of a part, over all shards in their order."""
    part = part.sort_by("shard")
    own = _joined(part["own"], _DOC)
    own = own[np.argsort(own["row"])]
    texts = np.ascontiguousarray(own["row"])

    def total(rows: str, values: np.ndarray) -> np.ndarray:
        row = np.concatenate([np.cumsum(_from_planes(x, np.int64)) for x in part[rows].to_pylist()])
        return np.bincount(np.searchsorted(texts, row), values, len(own))

    known = total("rare", np.concatenate([_from_planes(x, np.int64) for x in part["known"].to_pylist()]))
    base, u = total("rare", _joined(part["base"], np.float64)), total("row", _joined(part["u"], np.float64))
    columns = [
        pa.array(own["doc_id"], mask=own["null"]), pa.array(own["n"]), pa.array(own["known"] + known.astype(np.int64)),
        pa.array(own["base"] + base), pa.array(own["u"] + u),
    ]
    return pa.Table.from_arrays(columns, names=["doc_id", "n", "known", "base", "u"])


def _table(rows: DataFrame, value: str) -> Table:
    """A broadcast table of (key, value), values of equal keys added. Only for rows whose number has a bound."""
    found = rows.toArrow()
    key, at = np.unique(found["key"].to_numpy().view(np.uint64), return_inverse=True)
    total = np.zeros(len(key), found[value].to_numpy().dtype)
    np.add.at(total, at, found[value].to_numpy())
    return Table(key, **{value: total})


def scored(docs: DataFrame, train: Column, depth: int = DEPTH, least: int = LEAST, discount: float = DISCOUNT, hot: float = HOT) -> DataFrame:
    """Every row of ``docs`` (doc_id, text) with n_tokens, n_known, train_tokens, base_score and score.

    Null and empty texts are their end alone; very long ones are read whole, in one Arrow batch each; rows that
    share an id are scored each; without training rows every token is unknown; an empty table gives no row; other
    columns are not read. ``hot`` changes what is broadcast, not the result.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    scratch = Scratch(spark, "scoring")
    learned = docs.where(train).select("text")
    words = scratch.keep(word_counts(learned), "words")
    total, distinct, end = (x or 0 for x in words.agg(F.sum("n"), F.count(F.lit(1)), F.sum(F.when(F.col("w1") == int(END), F.col("n")))).first())
    often = F.col("n") >= max(least, hot * total)  # at most 1 / hot rows a length
    frequent = _table(words.where(often & (F.col("w1") != int(END))).select(F.col("w1").alias("key"), "n"), "n")
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = (1 + size // (5 * _SHARD)) | 1  # a word and its space are about five bytes or more; odd, so that the low bits of a shard's keys differ
    shared = spark.sparkContext.broadcast(frequent)
    level = words.mapInArrow(lambda it: _word_level(it, shared.value, total + 0.5 * (distinct + 1), shards), _LEVEL)
    levels = [scratch.keep(level, "level1")]
    scratch.drop("words")
    shared.destroy()
    for length in range(2, depth + 2):
        sieve = _sieve(levels[-1].where(F.col("kind") != CONTEXT).select("keys"), _level_keys, scratch, f"sieve{length}") if length > 2 else None
        counting = spark.sparkContext.broadcast((frequent, sieve))
        levels.append(settle(scratch, run_counts(learned, length, counting, least, shards), levels[-1], length, discount, shards))
        counting.destroy()  # every executor has a copy on its disk; all that used it is written
    rows = reduce(DataFrame.unionAll, levels)
    runs = _table(_often(rows.where(F.col("kind") != RARE), max(least, hot * total)), "u")
    states = scratch.keep(rows.mapInArrow(lambda it: _small_states(_state_rows(it), shards), "shard int, keys binary, known binary, base binary, u binary"), "tree")
    scratch.drop(*(f"level{length}" for length in range(1, depth + 2)))
    sieve = _sieve(states.select("shard", "keys"), lambda blocks: _state_keys(blocks, shards), scratch, "sieve")

    scan = spark.sparkContext.broadcast(Scan(frequent, runs, sieve, end, total, distinct, depth, shards))
    blocks = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(lambda it: scan.value(it), _BLOCK)
    parts = blocks.groupBy("shard").cogroup(states.groupBy("shard")).applyInArrow(lambda a, b: _look_up(a, b, shards), _PART)
    rows = parts.groupBy("part").applyInArrow(_add_up, _SUMS)
    ten = float(np.log(10))
    return rows.select(
        "doc_id", F.col("n").alias("n_tokens"), F.col("known").alias("n_known"), F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base") / ten).alias("base_score"), ((F.col("base") + F.col("u")) / ten).alias("score"),
    )


def op2_suffix_tree_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = scored(documents(spark, sf_dir), crc_mod("doc_id", 5) != 1)
    return rows.select("doc_id", (crc_mod("doc_id", 5) == 1).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
