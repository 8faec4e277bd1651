"""Operator 12: token counts with a whole-token shortcut.

Offline, the vocabulary file is read once and two things are shown from it. First, which two bytes stand side by
side in no piece: no merge ever joins over such a place, so a text may be cut there and the parts counted alone.
Second, which vocabulary strings the library itself encodes as one token: a part that is one of them counts one
without being merged. Every other part is merged by the library, once while a worker remembers it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from tessera.llm.common import _LOW, _MIX, batches, bounded_batches, byte_texts, documents, mix64
from tessera.llm.tokens import WordTable

MODEL = "piece_bpe_32k.model"
LIMIT = 4096
_SPACE_MARK = "▁"
#: How many parts, and bytes of long parts, a worker remembers before it starts anew.
_MOST_PARTS, _MOST_LONG_BYTES = 400_000, 8 << 20
_EXACT = 16


@dataclass(frozen=True)
class Proof:
    """What holds for a vocabulary. Its size is bounded by the vocabulary, whatever the corpus.

    ``glue``: 256 x 256, whether a merge may join over two bytes. ``single``: strings that are one token alone.
    ``lead``: tokens of the library's own opening, a line feed, which is cut off on both sides.
    """

    glue: np.ndarray
    single: tuple[bytes, ...]
    lead: int


@lru_cache(maxsize=4)
def prove(model_path: str) -> Proof:
    """Reads the vocabulary file. Raises ValueError for a model that changes texts before it merges, as then nothing is shown."""
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto()
    with open(model_path, "rb") as f:
        model.ParseFromString(f.read())
    kinds = sentencepiece_model_pb2.ModelProto.SentencePiece
    spec = model.normalizer_spec
    changes = spec.precompiled_charsmap or spec.remove_extra_whitespaces or not spec.add_dummy_prefix or not spec.escape_whitespaces
    if model.trainer_spec.model_type != sentencepiece_model_pb2.TrainerSpec.BPE or not model.trainer_spec.byte_fallback or changes or any(p.type in (kinds.USER_DEFINED, kinds.UNUSED) for p in model.pieces):
        raise ValueError(f"{model_path}: the shortcut is shown only for merging models that keep texts as they are")
    glue = np.zeros((256, 256), bool)
    glue[:, 0x80:0xC0] = True  # never inside a character
    strings = [p.piece.replace(_SPACE_MARK, " ").encode() for p in model.pieces if p.type == kinds.NORMAL]
    for x in strings:
        raw = np.frombuffer(x, np.uint8)
        glue[raw[:-1], raw[1:]] = True
    if glue[0x0A, :0x80].any() or glue[:, 0x0A].any():
        raise ValueError(f"{model_path}: a piece holds a line feed")
    library = sentencepiece.SentencePieceProcessor(model_file=model_path)
    lead = len(library.encode("\n"))
    alone = library.encode(["\n" + x.decode() for x in strings], num_threads=1)
    return Proof(glue, tuple(x for x, ids in zip(strings, alone) if len(ids) == lead + 1), lead)


class Parts:
    """Parts of texts, each as (start, end) in ``raw`` and as numbers that are its first 16 bytes; ``raw`` ends in 17 more bytes."""

    def __init__(self, raw: bytes, at: np.ndarray) -> None:
        self.raw, self.start, self.end = raw, at[:-1], at[1:]
        self.size = np.diff(at)
        eight = np.ndarray((len(raw) - 8,), "<u8", raw, strides=(1,))
        self.low = eight[self.start] & _LOW[np.minimum(self.size, 8)]
        self.high = eight[self.start + 8] & _LOW[np.clip(self.size - 8, 0, 8)]

    @classmethod
    def of(cls, strings: list[bytes]) -> "Parts":
        """Each string a part."""
        return cls(b"".join([*strings, bytes(_EXACT + 1)]), np.concatenate(([0], np.cumsum([len(x) for x in strings], dtype=np.int64))))

    @classmethod
    def cut(cls, texts: list[bytes], glue: np.ndarray) -> tuple["Parts", np.ndarray]:
        """All parts of the texts, and the index of each one's text."""
        # the library writes a space before a text that is not empty
        raw = b"".join([x for t in texts for x in ((b" ", t) if t else ())] + [bytes(_EXACT + 1)])
        padded = np.frombuffer(raw, np.uint8)
        n = len(padded) - _EXACT - 1
        sizes = np.fromiter((len(t) + bool(t) for t in texts), np.int64, len(texts))
        doc_start = np.cumsum(sizes) - sizes
        cut = np.zeros(n + 1, bool)
        cut[1:] = ~glue[padded[:n], padded[1 : n + 1]]
        cut[doc_start] = cut[n] = True
        parts = cls(raw, np.flatnonzero(cut))
        return parts, np.searchsorted(doc_start, parts.start, "right") - 1

    @cached_property
    def hash(self) -> np.ndarray:
        out = mix64(self.low + mix64(self.high + self.size.astype(np.uint64) * _MIX))
        long_ = np.flatnonzero(self.size > _EXACT)
        out[long_] = np.fromiter((xxh64_intdigest(self.raw[a:b]) for a, b in zip(self.start[long_].tolist(), self.end[long_].tolist())), np.uint64, len(long_))
        return out


class Counter:
    """Counts tokens of texts; ``merged`` and ``direct`` tell how many parts went which way."""

    held: dict[str, "Counter"] = {}

    def __init__(self, model_path: str, proof: Proof) -> None:
        import sentencepiece

        self.library, self.proof = sentencepiece.SentencePieceProcessor(model_file=model_path), proof
        self.merged = self.direct = 0
        self.clear()

    @classmethod
    def of(cls, model_path: str, proof: Proof) -> "Counter":
        if model_path not in cls.held:
            cls.held[model_path] = cls(model_path, proof)
        return cls.held[model_path]

    def clear(self) -> None:
        self.known = WordTable(18)
        self.tokens = np.empty(1 << 18, np.int64)
        single = Parts.of(list(self.proof.single))
        self._add(single, np.arange(len(single.size)), np.ones(len(single.size), np.int64))

    def _add(self, parts: Parts, rows: np.ndarray, tokens: np.ndarray) -> None:
        n = self.known.n
        while n + len(rows) > len(self.tokens):
            self.tokens = np.concatenate((self.tokens, np.empty_like(self.tokens)))
        self.tokens[n : n + len(rows)] = tokens
        self.known.add(parts, rows, parts.hash[rows])

    def count(self, texts: list[bytes]) -> np.ndarray:
        """Tokens of each text."""
        if self.known.n > _MOST_PARTS or self.known.long_bytes > _MOST_LONG_BYTES:
            self.clear()
        mark = _SPACE_MARK.encode()
        parts, doc = Parts.cut([t.replace(mark, b" ") if mark in t else t for t in texts], self.proof.glue)
        index = self.known.find(parts, np.arange(len(parts.size)))
        self.direct += int((index >= 0).sum())
        while len(new := np.flatnonzero(index < 0)):  # parts that share a hash come one after another
            _, first = np.unique(parts.hash[new], return_index=True)
            rows = new[first]
            strings = ["\n" + parts.raw[a:b].decode("utf-8", "replace") for a, b in zip(parts.start[rows].tolist(), parts.end[rows].tolist())]
            self.merged += len(rows)
            tokens = np.fromiter(map(len, self.library.encode(strings, num_threads=1)), np.int64, len(rows)) - self.proof.lead
            self._add(parts, rows, tokens)
            index[new] = self.known.find(parts, new)
        return np.bincount(doc, self.tokens[index], len(texts)).astype(np.int64)


def count_tokens(docs: DataFrame, model_path: str, limit: int = LIMIT) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every row of ``docs`` (doc_id, text); no shuffle.

    A null text counts as empty: no bytes, no tokens. Null and repeated ids stay as they are, a row each; an empty
    table gives no rows; other columns are not read, so clashing names do no harm. A very long text is held whole
    by one worker, as the library would, and its parts are merged alone. Control strings such as ``</s>`` in a text
    are text, as the library has it.
    """
    bounded_batches(docs.sparkSession)
    proof = prove(model_path)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter.of(model_path, proof)
        for table in batches(it):
            texts = byte_texts(table["text"])
            size = pa.array(np.fromiter(map(len, texts), np.int64, len(texts)))
            yield pa.RecordBatch.from_arrays([table["doc_id"].combine_chunks(), size, pa.array(counter.count(texts))], names=["doc_id", "n_bytes", "n_tokens"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    out = docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_bytes long, n_tokens long")
    return out.withColumn("over_limit", F.col("n_tokens") > limit)


def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return count_tokens(documents(spark, sf_dir), public_tokenizers.path(MODEL))
