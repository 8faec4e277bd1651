"""Operator 1: token ids in binary files of patched frame-of-reference blocks.

Encoding keeps one table of encoded words per Python worker: the vocabulary file drops white space and never joins
letters over it, so a text's ids are the ids of its words one after another. The words of a batch are cut and
looked up all at once, as numbers that are their bytes. Texts that may hold a special token's string are encoded
whole.
"""

from __future__ import annotations

import codecs
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.common import _MIX, Scratch, Words, batches, bounded_batches, byte_texts, documents, mix64, partitions

END_ID = 2
TOKENIZER = "word_bpe_49k.json"
_MARK, _LETTER, _TAIL = np.zeros(256, bool), np.zeros(256, bool), np.zeros(256, bool)
_MARK[list(b".,!%&*$#?;:)")] = True
_LETTER[list(b"abcdefghijklmnopqrstuvwxyz")] = True
#: Second bytes of the letters from U+00C0 to U+00FF, whose first byte is 0xC3: all but the signs of times and division.
_TAIL[0x80:0xC0] = True
_TAIL[[0x97, 0xB7]] = False
#: The vocabulary writes a byte as a character of the same number, but for those that do not print.
_BYTES = "".join(chr(0x100 + 34 + b - 0x80 if 0x80 <= b <= 0xA0 else 0x100 + 67 if b == 0xAD else b) for b in range(256))
_JOINED = 512
#: How many words, and bytes of long words, an encoder remembers before it starts anew.
_MOST_WORDS, _MOST_LONG_BYTES = 400_000, 8 << 20


def _marks_ahead(data: np.ndarray) -> np.ndarray:
    """Where a mark stands behind a letter, or a letter behind a mark: the vocabulary's own splitter cuts there."""
    mark, letter = _MARK[data], _LETTER[data]
    latin = letter.copy()
    latin[1:] |= _TAIL[data[1:]] & (data[:-1] == 0xC3)
    out = np.zeros(len(data), bool)
    out[1:] = mark[1:] & latin[:-1] | letter[1:] & mark[:-1]
    return out


class WordTable:
    """Open addressing over words of at most ``Words.EXACT`` bytes, compared whole; longer ones in a dictionary."""

    def __init__(self, bits: int = 16) -> None:
        self.n, self.long_bytes = 0, 0
        self.long: dict[bytes, int] = {}
        self._room(bits)

    def _room(self, bits: int) -> None:
        self.mask = (1 << bits) - 1
        self.low, self.high = np.zeros(1 << bits, np.uint64), np.zeros(1 << bits, np.uint64)
        self.size, self.at = np.zeros(1 << bits, np.int32), np.full(1 << bits, -1, np.int32)

    def find(self, words: Words, rows: np.ndarray) -> np.ndarray:
        """The number of each word at ``rows``, or -1."""
        out = np.full(len(rows), -1)
        low, high, size = words.low[rows], words.high[rows], words.size[rows]
        slot = (words.hash[rows] & np.uint64(self.mask)).astype(np.int64)
        left = np.arange(len(rows))
        while len(left):
            at = self.at[slot]
            same = (self.low[slot] == low[left]) & (self.high[slot] == high[left]) & (self.size[slot] == size[left])
            out[left[same]] = at[same]
            on = np.flatnonzero(~same & (at >= 0))
            left, slot = left[on], (slot[on] + 1) & self.mask
        for i in np.flatnonzero(size > Words.EXACT).tolist():
            out[i] = self.long.get(words.raw[words.start[rows[i]] : words.end[rows[i]]], -1)
        return out

    def add(self, words: Words, rows: np.ndarray, hashes: np.ndarray) -> None:
        """Numbers the distinct new words at ``rows`` from ``n`` on."""
        if 2 * (self.n + len(rows)) > self.mask:
            held = np.flatnonzero(self.at >= 0)
            low, high, size, at = self.low[held], self.high[held], self.size[held], self.at[held]
            self._room((4 * (self.n + len(rows))).bit_length())
            self._put(low, high, size, at, mix64(low + mix64(high + size.astype(np.uint64) * _MIX)))
        number = self.n + np.arange(len(rows))
        self.n += len(rows)
        short = words.size[rows] <= Words.EXACT
        at = rows[short]
        self._put(words.low[at], words.high[at], words.size[at], number[short], hashes[short])
        for i, k in zip(rows[~short].tolist(), number[~short].tolist()):
            word = words.raw[words.start[i] : words.end[i]]
            self.long[word] = k
            self.long_bytes += len(word)

    def _put(self, low: np.ndarray, high: np.ndarray, size: np.ndarray, at: np.ndarray, hashes: np.ndarray) -> None:
        slot = (hashes & np.uint64(self.mask)).astype(np.int64)
        while len(slot):
            free = np.flatnonzero(self.at[slot] < 0)
            _, first = np.unique(slot[free], return_index=True)  # one word a slot and round
            won = free[first]
            to = slot[won]
            self.low[to], self.high[to], self.size[to], self.at[to] = low[won], high[won], size[won], at[won]
            rest = np.ones(len(slot), bool)
            rest[won] = False
            low, high, size, at = low[rest], high[rest], size[rest], at[rest]
            slot = (slot[rest] + 1) & self.mask


class Encoder:
    """Ids of texts by the ``tokenizers`` library, each distinct word encoded once while it is remembered."""

    held: dict[str, "Encoder"] = {}

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer, pre_tokenizers

        self.whole = Tokenizer.from_file(path)
        # the same model for words of lower-case letters, which need no normaliser and no splitter
        self.plain = Tokenizer(self.whole.model)
        self.plain.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        self.last = np.zeros(1 + max(self.whole.get_vocab().values()), bool)
        self.last[[i for x, i in self.whole.get_vocab().items() if x.endswith(self.whole.model.end_of_word_suffix)]] = True
        self.clear()

    @classmethod
    def of(cls, path: str) -> "Encoder":
        if path not in cls.held:
            cls.held[path] = cls(path)
        return cls.held[path]

    def clear(self) -> None:
        self.known = WordTable()
        self.flat, self.used = np.empty(1 << 16, np.uint16 if self.whole.get_vocab_size() < 1 << 16 else np.uint32), 0
        self.at, self.size = np.empty(1 << 14, np.int32), np.empty(1 << 14, np.int32)

    def _add(self, flat: np.ndarray, sizes: np.ndarray) -> None:
        n, total = self.known.n, len(flat)
        while self.used + total > len(self.flat):
            self.flat = np.concatenate((self.flat, np.empty_like(self.flat)))
        while n + len(sizes) > len(self.at):
            self.at, self.size = (np.concatenate((x, np.empty_like(x))) for x in (self.at, self.size))
        self.size[n : n + len(sizes)] = sizes
        self.at[n : n + len(sizes)] = self.used + np.cumsum(sizes) - sizes
        self.flat[self.used : self.used + total] = flat
        self.used += total

    def _learn(self, words: Words, rows: np.ndarray) -> None:
        """Encodes the words at ``rows``, one of each hash; words that share one come with the next call."""
        hashes, first = np.unique(words.hash[rows], return_index=True)
        rows = rows[first]
        texts = [words.raw[a:b] for a, b in zip(words.start[rows].tolist(), words.end[rows].tolist())]
        latin = _TAIL[words.data] & (np.concatenate(([0], words.data[:-1])) == 0xC3)
        good = np.cumsum(_LETTER[words.data] | latin | np.append(latin[1:], False), dtype=np.int32)
        plain = good[words.end[rows] - 1] - good[words.start[rows]] == words.size[rows] - 1
        plain &= _LETTER[words.data[words.start[rows]]] | (words.data[words.start[rows]] == 0xC3)
        some, other = np.flatnonzero(plain), np.flatnonzero(~plain)
        if len(some):
            joined = [b" ".join(texts[i] for i in some[at : at + _JOINED].tolist()) for at in range(0, len(some), _JOINED)]
            joined = [codecs.charmap_decode(x.decode().lower().encode(), "strict", _BYTES)[0] for x in joined]
            flat = np.concatenate([np.array(x.ids) for x in self.plain.encode_batch_fast(joined, add_special_tokens=False)])
            self._add(flat, np.diff(np.flatnonzero(self.last[flat]) + 1, prepend=0))
            self.known.add(words, rows[some], hashes[some])
        if len(other):
            ids = [x.ids for x in self.whole.encode_batch_fast([texts[i].decode() for i in other.tolist()], add_special_tokens=False)]
            self._add(np.array([i for x in ids for i in x]), np.fromiter(map(len, ids), np.int64, len(ids)))
            self.known.add(words, rows[other], hashes[other])

    def encode(self, texts: list[bytes], end_id: int = END_ID) -> tuple[np.ndarray, np.ndarray]:
        """All ids one text after another, each text's end id included, and the number of ids of each text."""
        if self.known.n > _MOST_WORDS or self.known.long_bytes > _MOST_LONG_BYTES or self.used > 8 * _MOST_WORDS:
            self.clear()
        special = [i for i, x in enumerate(texts) if b"<|" in x]
        if special:
            return self._encode_special(texts, special, end_id)
        words = Words(texts, ahead=_marks_ahead)
        index = self.known.find(words, np.arange(len(words.size)))
        while len(new := np.flatnonzero(index < 0)):
            self._learn(words, new)
            index[new] = self.known.find(words, new)
        size = self.size[index]
        past = np.cumsum(size)
        total = int(past[-1]) if len(past) else 0
        lengths = np.bincount(words.doc, size, len(texts)).astype(np.int64) + 1
        ids = np.full(total + len(texts), end_id, np.uint32)
        place = np.arange(total)
        ids[place + np.repeat(words.doc, size)] = self.flat[np.repeat(self.at[index] - (past - size), size) + place]
        return ids, lengths

    def _encode_special(self, texts: list[bytes], special: list[int], end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """Texts that may hold a special token's string are encoded whole and not remembered."""
        whole = np.zeros(len(texts), bool)
        whole[special] = True
        some, n = self.encode([x for x, w in zip(texts, whole) if not w], end_id)
        own = [self.whole.encode(texts[i].decode(), add_special_tokens=False).ids for i in special]
        lengths = np.empty(len(texts), np.int64)
        lengths[~whole], lengths[whole] = n, [len(x) + 1 for x in own]
        ids = np.empty(int(lengths.sum()), np.uint32)
        ids[np.repeat(~whole, lengths)] = some
        ids[np.repeat(whole, lengths)] = [i for x in own for i in (*x, end_id)]
        return ids, lengths


BLOCK = 128
_HEAD = struct.Struct("<4sIIQI")


def _packed(x: np.ndarray, w: int) -> np.ndarray:
    """Rows of 128 values of ``w`` bits as rows of 2 w 64-bit words."""
    columns = np.ascontiguousarray(x.T, np.uint64)
    out = np.zeros((2 * w, x.shape[0]), np.uint64)
    for i in range(BLOCK):
        word, bit = divmod(i * w, 64)
        out[word] |= columns[i] << np.uint64(bit)
        if bit + w > 64:
            out[word + 1] |= columns[i] >> np.uint64(64 - bit)
    return np.ascontiguousarray(out.T).astype("<u8")


def _unpacked(rows: np.ndarray, w: int) -> np.ndarray:
    words = np.ascontiguousarray(rows.T)
    out = np.empty((BLOCK, rows.shape[0]), np.uint64)
    for i in range(BLOCK):
        word, bit = divmod(i * w, 64)
        out[i] = words[word] >> np.uint64(bit)
        if bit + w > 64:
            out[i] |= words[word + 1] << np.uint64(64 - bit)
    return (out & np.uint64((1 << w) - 1)).T.astype(np.uint32)


def pack(doc_ids: np.ndarray, lengths: np.ndarray, ids: np.ndarray, percentile: float = 0.9, nulls: int = 0) -> bytes:
    """One segment: head, document table, block index, then the blocks. The first ``nulls`` documents have no id.

    A block is 128 ids less their minimum, packed at the width that holds ``percentile`` of them; wider ones
    stand in the block's exception list (position, difference) and their low bits stay in place as zero.
    """
    n = len(ids)
    blocks = -(-n // BLOCK)
    x = np.empty(blocks * BLOCK, np.uint32)
    x[:n] = ids
    x[n:] = ids[-1] if n else 0
    x = x.reshape(blocks, BLOCK)
    base = x.min(1) if blocks else np.empty(0, np.uint32)
    x = x - base[:, None]
    bits = np.frexp(x.astype(np.float64))[1].astype(np.uint8)
    cut = int(percentile * (BLOCK - 1))
    width = np.partition(bits, cut, 1)[:, cut] if blocks else np.empty(0, np.uint8)
    out = bits > width[:, None]
    count = out.sum(1).astype(np.uint8)
    row, place = np.nonzero(out)
    values = x[row, place]
    x[row, place] = 0
    starts = np.concatenate(([0], np.cumsum(width.astype(np.int64) * (BLOCK // 8))))
    body = np.empty(starts[-1], np.uint8)
    for w in map(int, np.unique(width)):
        if w:
            of = np.flatnonzero(width == w)
            body[starts[of][:, None] + np.arange(w * (BLOCK // 8))] = _packed(x[of], w).view(np.uint8)
    return b"".join(
        (
            _HEAD.pack(b"PFR2", len(doc_ids), blocks, n, nulls),
            doc_ids.astype("<i8").tobytes(),
            lengths.astype("<i8").tobytes(),
            starts.astype("<i8").tobytes(),
            base.astype("<u4").tobytes(),
            width.astype("u1").tobytes(),
            count.tobytes(),
            body.tobytes(),
            place.astype("u1").tobytes(),
            values.astype("<u4").tobytes(),
        )
    )


class Segment:
    """A segment that ``pack`` made: its document table, and ids by position through the block index."""

    def __init__(self, raw: bytes) -> None:
        magic, docs, self.blocks, self.n, self.nulls = _HEAD.unpack_from(raw)
        if magic != b"PFR2":
            raise ValueError("not a segment of token ids")
        at = _HEAD.size

        def take(kind: str, count: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(raw, kind, count, at)
            at += out.nbytes
            return out

        self.doc_ids, self.lengths, self.starts = take("<i8", docs), take("<i8", docs), take("<i8", self.blocks + 1)
        self.base, self.width, count = take("<u4", self.blocks), take("u1", self.blocks), take("u1", self.blocks)
        self.body = take("u1", int(self.starts[-1]))
        self.outliers = np.concatenate(([0], np.cumsum(count, dtype=np.int64)))
        self.place, self.values = take("u1", int(self.outliers[-1])), take("<u4", int(self.outliers[-1]))

    def ids(self, start: int = 0, stop: int | None = None) -> np.ndarray:
        """The ids at [start, stop); only the blocks that hold them are read."""
        stop = self.n if stop is None else min(stop, self.n)
        if start >= stop:
            return np.empty(0, np.uint32)
        a, b = start // BLOCK, -(-stop // BLOCK)
        width, starts = self.width[a:b], self.starts[a:b]
        x = np.zeros((b - a, BLOCK), np.uint32)
        for w in map(int, np.unique(width)):
            if w:
                of = np.flatnonzero(width == w)
                rows = self.body[starts[of][:, None] + np.arange(w * (BLOCK // 8))].view("<u8")
                x[of] = _unpacked(rows, w)
        lo, hi = self.outliers[a], self.outliers[b]
        x[np.repeat(np.arange(b - a), np.diff(self.outliers[a : b + 1])), self.place[lo:hi]] = self.values[lo:hi]
        return (x + self.base[a:b, None]).reshape(-1)[start - a * BLOCK : stop - a * BLOCK]

    def document(self, place: int) -> np.ndarray:
        """The ids of the document at ``place`` of the table, its end id included."""
        start = int(self.lengths[:place].sum())
        return self.ids(start, start + int(self.lengths[place]))


def unpack(segment: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(doc_ids, lengths, ids) of a segment."""
    s = Segment(segment)
    return s.doc_ids, s.lengths, s.ids()


SEGMENT_SCHEMA = "shard int, segment int, first_doc long, last_doc long, n_docs long, n_tokens long, payload binary"


def encode_segments(docs: DataFrame, tokenizer_path: str, segment_tokens: int = 1 << 18, percentile: float = 0.9) -> DataFrame:
    """Segments of packed ids of ``docs`` (doc_id, text) in ascending doc_id order.

    Nulls in ``text`` are empty texts; null ids come first and stay null; rows that share an id stay separate,
    ordered by text; an empty table gives no segment; other columns are not read. A document is never split over
    segments, so a segment can be read alone; a very long text is a segment of its own length.
    """
    bounded_batches(docs.sparkSession)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, shard, segment = Encoder.of(tokenizer_path), TaskContext.get().partitionId(), 0
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        size = 0

        def flush() -> pa.RecordBatch:
            d, n, x = (np.concatenate(y) for y in zip(*((d.filled(0), n, x) for d, n, x in held)))
            nulls = sum(int(np.ma.getmaskarray(y[0]).sum()) for y in held)
            first, last = (int(d[nulls]), int(d[-1])) if nulls < len(d) else (None, None)
            row = (shard, segment, first, last, len(d), len(x), pack(d, n, x, percentile, nulls))
            return pa.RecordBatch.from_pylist([dict(zip(("shard", "segment", "first_doc", "last_doc", "n_docs", "n_tokens", "payload"), row))], schema=schema)

        for table in batches(it, 1 << 20):
            ids, lengths = encoder.encode(byte_texts(table["text"]))
            doc = table["doc_id"].combine_chunks()
            held.append((np.ma.array(doc.fill_null(0).to_numpy(), mask=doc.is_null().to_numpy(zero_copy_only=False)), lengths, ids))
            size += len(ids)
            if size >= segment_tokens:
                yield flush()
                held, size, segment = [], 0, segment + 1
        if held:
            yield flush()

    schema = pa.schema([("shard", pa.int32()), ("segment", pa.int32()), ("first_doc", pa.int64()), ("last_doc", pa.int64()), ("n_docs", pa.int64()), ("n_tokens", pa.int64()), ("payload", pa.binary())])
    ordered = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        .repartitionByRange(partitions(docs.sparkSession), "doc_id")
        .sortWithinPartitions("doc_id", "text")
    )
    return ordered.mapInArrow(run, SEGMENT_SCHEMA)


def write_token_files(docs: DataFrame, path: str, tokenizer_path: str, **options: float) -> None:
    """Writes the segments under ``path``; Spark's commit keeps files of failed attempts out."""
    encode_segments(docs, tokenizer_path, **options).write.option("compression", "none").parquet(path)


def read_token_files(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """Rows (shard, segment, doc_id, at, n_tokens, ids_crc32[, ids]) in the files; ``at``: ids before it in its segment."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for shard, segment, payload in zip(*(batch[c].to_pylist() for c in ("shard", "segment", "payload"))):
                part = Segment(payload)
                lengths, ids = part.lengths, part.ids()
                raw, past = memoryview(ids.astype("<u4").tobytes()), np.cumsum(lengths)
                first = past - lengths
                crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(first.tolist(), past.tolist())]
                n = len(lengths)
                doc_ids = pa.array(part.doc_ids, mask=np.arange(n) < part.nulls)
                cols = [pa.array(np.full(n, shard, np.int32)), pa.array(np.full(n, segment, np.int32)), doc_ids, pa.array(np.arange(n)), pa.array(first), pa.array(lengths), pa.array(crc, pa.int64())]
                if with_ids:
                    cols.append(pa.ListArray.from_arrays(pa.array(np.concatenate(([0], past)).astype(np.int32)), pa.array(ids.astype(np.int32))))
                yield pa.RecordBatch.from_arrays(cols, names=names)

    names = ["shard", "segment", "doc_id", "place", "at", "n_tokens", "ids_crc32"] + ["ids"] * with_ids
    schema = "shard int, segment int, doc_id long, place long, at long, n_tokens long, ids_crc32 long" + ", ids array<int>" * with_ids
    bounded_batches(spark)
    return spark.read.parquet(path).select("shard", "segment", "payload").mapInArrow(run, schema)


def token_index(spark: SparkSession, path: str) -> DataFrame:
    """Per document of the files: doc_id, start, n_tokens, ids_crc32, shard, segment.

    Starts are prefix sums over segment totals: within a shard first, then over shards (one row each).
    """
    totals = spark.read.parquet(path).select("shard", "segment", "n_tokens")
    shards = totals.groupBy("shard").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = shards.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shard_start"))
    inside = Window.partitionBy("shard").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        totals.withColumn("segment_start", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
        .join(shards, "shard")
        .select("shard", "segment", (F.col("shard_start") + F.col("segment_start")).alias("base"))
    )
    return read_token_files(spark, path).join(starts, ["shard", "segment"]).select("doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32", "shard", "segment")


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    scratch = Scratch(spark, "tokens")
    write_token_files(documents(spark, sf_dir), scratch.path("files"), public_tokenizers.path(TOKENIZER))
    return token_index(spark, scratch.path("files"))
