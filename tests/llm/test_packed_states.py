"""op2's tree comes to the look-up as packed blocks, texts rise within a block of runs, and sums leave it packed by part."""

import numpy as np
import pyarrow as pa

from tessera.llm import scoring


def test_states_are_packed_by_shard():
    key = np.array([5, -1, 7, 5, 12], np.int64)
    batch = pa.record_batch({"key": key, "known": pa.array([0, 1, 0, 0, 0], pa.int32()), "base": [0.0, 2.5, 0.0, 0.0, 0.0], "u": [1.0, 0.0, 3.0, 4.0, 5.0]})
    found = set()
    blocks = list(scoring._state_blocks(iter([batch]), 3))
    assert sum(b.num_rows for b in blocks) <= 3  # a row a shard, not a state
    for row in pa.Table.from_batches(blocks).to_pylist():
        keys = np.frombuffer(row["keys"], np.uint64)
        assert set((keys % np.uint64(3)).tolist()) == {row["shard"]}
        found |= set(zip(keys.view(np.int64).tolist(), *(np.frombuffer(row[c], kind).tolist() for c, kind in scoring._STATE.items())))
    assert found == {(5, 0, 0.0, 1.0), (-1, 1, 2.5, 0.0), (7, 0, 0.0, 3.0), (5, 0, 0.0, 4.0), (12, 0, 0.0, 5.0)}


def _block(shard: int, at: int, runs: dict[int, list[int]], texts: int) -> list[dict]:
    """The rows of a scan's block: one of runs by text, one of the texts' own sums."""
    doc, key = (np.array(x) for x in zip(*((d, k) for d, ks in runs.items() for k in ks)))
    own = np.zeros(texts, scoring._DOC)
    own["row"], own["doc_id"], own["n"], own["base"] = at + np.arange(texts), 100 + at + np.arange(texts), 1, -1.0
    step = scoring._planes(np.diff(doc.astype(np.int32), prepend=np.int32(0)), np.array([0, len(doc)]))[0].as_py()
    runs_ = {"shard": shard, "at": at, "keys": key.astype(np.uint64).tobytes(), "docs": step, "rows": b""}
    return [runs_, {"shard": 0, "at": at, "keys": b"", "docs": b"", "rows": own.tobytes()}]


def test_sums_leave_the_look_up_packed_and_add_up():
    kinds = pa.schema([("shard", pa.int32()), ("at", pa.int64()), ("keys", pa.binary()), ("docs", pa.binary()), ("rows", pa.binary())])
    many, shards = 300, 2
    rows = [r for at in (0, 1 << 40, 5000) for shard in (0, 1) for r in _block(shard, at, {d: [2 * d + shard, 9000 + shard] for d in range(many)}, many)]
    rows = [r for i, r in enumerate(rows) if r["keys"] or i % 4 == 1]  # the own sums of a block come once
    state = {"key": np.concatenate((np.arange(600), [9000, 9001])), "known": np.array([1] + [0] * 599 + [0, 0], np.int8)}
    state["base"], state["u"] = np.where(state["known"] > 0, 7.0, 0.0), np.concatenate((np.arange(600) / 8, [0.0, 100.0]))
    found = []
    for shard in (0, 1):
        blocks = pa.Table.from_pylist([r for r in rows if r["shard"] == shard], kinds)
        mine = state["key"] % 2 == shard
        states = pa.Table.from_batches(scoring._small_states(iter([pa.record_batch({c: v[mine] for c, v in state.items()})]), shards))
        found.append(scoring._look_up(blocks, states, shards))
        assert found[-1].num_rows <= shards  # not a row for each text
    whole = pa.concat_tables(found)
    sums = [scoring._add_up(whole.filter(pa.array(np.asarray(whole["part"]) == p))) for p in set(whole["part"].to_pylist())]
    got = {r["doc_id"]: (r["n"], r["known"], r["base"], r["u"]) for r in pa.concat_tables(sums).to_pylist()}
    wanted = {100 + at + d: (1, int(d == 0), 6.0 if d == 0 else -1.0, 2 * d / 8 + (2 * d + 1) / 8 + 100) for at in (0, 1 << 40, 5000) for d in range(many)}
    assert got == wanted


def test_planes_are_read_as_they_were_written():
    values, bounds = np.array([0, 1, 300, -5, 1 << 20, 7], np.int64), np.array([0, 2, 2, 6])
    back = [scoring._from_planes(x, np.int64).tolist() for x in scoring._planes(values, bounds).to_pylist()]
    assert back == [[0, 1], [], [300, -5, 1 << 20, 7]]


def test_states_are_small_and_read_back():
    rng = np.random.default_rng(1)
    key = rng.integers(0, 1 << 64, 200_000, np.uint64)
    key[:3] = key[3:6]  # a context may also be an entry
    u = rng.normal(-3.0, 1.0, len(key))
    batch = pa.record_batch({"key": key.view(np.int64), "known": np.zeros(len(key), np.int32), "base": np.zeros(len(key)), "u": u})
    blocks = pa.Table.from_batches(scoring._small_states(iter([batch]), 40))
    packed = pa.compress(b"".join(x for c in ("keys", *scoring._STATE) for x in blocks[c].to_pylist()), codec="lz4", asbytes=True)
    assert len(packed) < 14.5 * len(key)  # 16 bytes without the order of keys and planes
    found = []
    for shard in range(40):
        keys, values = scoring._read_states(blocks.filter(pa.array(np.asarray(blocks["shard"]) == shard)), 40)
        assert not values["known"].any() and not values["base"].any()
        found += zip(keys.tolist(), values["u"].tolist())
    assert sorted(found) == sorted(zip(key.tolist(), u.tolist()))
