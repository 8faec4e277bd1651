"""op2's levels are settled as packed blocks, not as a row for each entry, and wide contexts by sums alone, with the same model."""

import random

import numpy as np
import pytest

from tessera.llm import scoring
from tessera.llm.common import Scratch, bitmap, crc_mod


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(7)
    rows = [(i, " ".join(f"w{int(rng.paretovariate(0.7)) % 150}" for _ in range(150))) for i in range(80)]
    return spark.createDataFrame([*rows, (None, None), (200, rows[0][1])], "doc_id long, text string")


def _scores(docs):
    got = scoring.scored(docs, crc_mod("doc_id", 5) != 1).collect()
    return sorted((r.doc_id or -1, r.n_tokens, r.n_known, round(r.base_score, 6), round(r.score, 6)) for r in got)


def test_levels_are_blocks(docs, monkeypatch):
    keep, rows = Scratch.keep, {}

    def spied(self, df, name):
        out = keep(self, df, name)
        rows[name] = out.count()
        return out

    monkeypatch.setattr(Scratch, "keep", spied)
    _scores(docs)
    words = rows.pop("words")
    assert words > 100 and max(n for name, n in rows.items() if not name.startswith("sieve")) <= 64, rows  # thousands of entries
    assert max(rows.values()) <= 256


def test_wide_contexts_are_settled_alike(docs, monkeypatch):
    whole = _scores(docs)
    monkeypatch.setattr(scoring, "_SHARD", 200)
    assert _scores(docs) == whole
    used = []
    wide = scoring._settle_wide
    monkeypatch.setattr(scoring, "_settle_wide", lambda *a: used.append(a[3]) or wide(*a))
    monkeypatch.setattr(scoring, "_WIDE", 40)  # some contexts of one token and of two, not all
    assert _scores(docs) == whole and used == [2, 3]


def test_entries_of_wide_contexts_stay_out_of_the_shards():
    key = np.arange(1, 41, dtype=np.uint64)
    runs = scoring.pa.Table.from_batches([scoring._dealt(key % 3, 1, keys=key, context=key % 4, suffix=key % 3, n=key.astype(np.int64))])
    shorter = scoring.pa.table({"keys": [np.arange(3, dtype=np.uint64).tobytes()], "p": [np.array([0.1, 0.2, 0.3]).tobytes()]})
    blocks = scoring._below(runs, shorter, np.array([2], np.uint64), 5).to_pylist()
    found = {}
    for b in blocks:
        context = np.frombuffer(b["context"], np.uint64)
        assert set((context % 5).tolist()) == {b["shard"]} if b["shard"] >= 0 else set(context.tolist()) == {2}
        found |= zip(np.frombuffer(b["keys"], np.uint64).tolist(), np.frombuffer(b["below"]).tolist())
    assert found == {int(k): (0.1, 0.2, 0.3)[int(k) % 3] for k in key} and any(b["shard"] == -1 for b in blocks)


def test_sieve_is_the_bitmap(spark):
    key = np.random.default_rng(2).integers(-(1 << 63), 1 << 63, 5000)
    scratch = Scratch(spark, "test")
    rows = spark.createDataFrame([(int(k),) for k in key], "key long")
    blocks = spark.createDataFrame([(bytearray(x.tobytes()),) for x in np.split(key, 10)], "keys binary")
    got = scoring._sieve(blocks, scoring._level_keys, scratch, "sieve")
    assert np.array_equal(got, bitmap(rows, "key", scoring.BITS))
