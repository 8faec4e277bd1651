"""Operators on groups, labels and weights, and the pipeline."""

import glob
import os
import random
from collections import Counter

import duckdb
import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from test_text_operators import awkward, nothing

from tessera.llm import exact, mixing, near, quality, simhash
from tessera.llm.common import Scratch
from tessera.llm.graph import components
from tessera.llm.queries import QUERIES, SQL

SF = "/root/testdata/sf0.001"


def test_golay_decodes_within_three_bits():
    rng = np.random.default_rng(1)
    words = rng.integers(0, 1 << 23, 2000).astype(np.uint32)
    index = simhash.decode(words)
    code = np.array([(int(i) << 11) | simhash._remainder(int(i) << 11) for i in index], np.uint32)
    assert all(simhash._remainder(int(c)) == 0 for c in code) and (np.bitwise_count(code ^ words) <= 3).all()


@given(st.integers(0, 2**64 - 1), st.sets(st.integers(0, 63), max_size=3))
@settings(max_examples=300, deadline=None)
def test_near_fingerprints_share_a_key(x, bits):
    y = x
    for b in bits:
        y ^= 1 << b
    held = set(simhash.index_keys(np.array([y], np.uint64))[0].tolist())
    assert held & set(simhash.probe_keys(np.array([x], np.uint64))[1].tolist())


def test_links_are_all_links(spark):
    rng = random.Random(4)
    seeds = [rng.getrandbits(64) for _ in range(20)]
    fps = {s ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(5))) for s in seeds for _ in range(15)}
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    got = {(r.x, r.y) for r in simhash.links(spark.createDataFrame([(f,) for f in signed], "fp long")).collect()}
    want = {(a, b) for a in signed for b in signed if a < b and ((a ^ b) & (2**64 - 1)).bit_count() <= 3}
    assert got == want and want


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 103), (101, 103), (102, 101), (7, 7)]
    got = components(spark.createDataFrame(edges, "a long, b long"), Scratch(spark, "t")).collect()
    assert {(r.node, r.component) for r in got} == {(i, 0) for i in range(41)} | {(i, 100) for i in range(100, 104)}


def test_simhash_of_awkward_rows(spark):
    got = Counter((r.doc_id, r.fingerprint, r.component_id) for r in simhash.simhash_components(awkward(spark)).collect())
    zero = "0" * 16
    assert got[(1, zero, 1)] == 1 and got[(2, zero, 1)] == 1
    assert sum(n for (d, _, c), n in got.items() if d == 3 and c == 3) == 2
    assert simhash.simhash_components(nothing(spark)).count() == 0


@given(st.lists(st.tuples(st.integers(0, 60), st.booleans()), max_size=300))
@settings(max_examples=60, deadline=None)
def test_cuckoo_index_is_a_dictionary(steps):
    import hashlib

    index, want = exact.CuckooIndex(2), {}
    for k, add in steps:
        d = hashlib.sha256(bytes([k])).digest()
        if add:
            index.put(d, [k])
            want[d] = [k]
        else:
            assert index.remove(d) == (want.pop(d, None) is not None)
    assert dict(index.items()) == want and index.live == len(want)
    assert all(index.maybe(d) for d in want)


def test_cuckoo_index_grows():
    import hashlib

    index = exact.CuckooIndex(2)
    keys = [hashlib.sha256(str(i).encode()).digest() for i in range(500)]
    for i, k in enumerate(keys):
        index.put(k, [i])
    assert index.resizes and all(index.get(k) == [i] for i, k in enumerate(keys))


def test_exact_copies(spark):
    docs = awkward(spark, (20, "A B c"), (21, "É"), (22, "é"))
    got = {(r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact.exact_duplicates(docs).collect()}
    assert {(3, 20, 3, False), (20, 20, 3, True), (21, 21, 1, True), (22, 22, 1, True), (1, 2, 2, False), (2, 2, 2, True), (None, None, 1, True)} <= got
    kept = exact.drop_exact(docs.where("doc_id <> 20 or doc_id is null"))
    assert kept.columns == docs.columns and sorted((r.doc_id or 0) for r in kept.collect()) == [0, 2, 3, 7, 8, 21, 22]
    assert exact.exact_duplicates(nothing(spark)).count() == 0


def test_index_takes_inserts_and_removes(spark):
    rows = lambda *x: spark.createDataFrame([(i, bytes([d]) * 32) for i, d in x], "doc_id long, digest binary")
    index = exact.live_digests(rows((1, 1), (2, 1), (3, 2)), 2)
    got = exact.update_index(index, rows((4, 1), (5, 3)), rows((3, 2), (9, 8)), 2).collect()
    assert {(r.keep_id, bytes(r.digest)[0], r.size) for r in got} == {(4, 1, 3), (5, 3, 1)}


def test_index_keeps_a_live_row_when_the_kept_one_is_removed(spark):
    rows = lambda *x: spark.createDataFrame([(i, bytes([d]) * 32) for i, d in x], "doc_id long, digest binary")
    live = rows((1, 1), (2, 1), (3, 2), (None, 3), (5, 4))
    inserts, removes = rows((4, 1), (None, 3), (7, 4)), rows((4, 1), (3, 2), (9, 4), (8, 6))
    got = exact.update_index(exact.live_digests(live, 2), inserts, removes, 2, live).collect()
    assert {(r.keep_id, bytes(r.digest)[0], r.size) for r in got} == {(2, 1, 2), (None, 3, 2), (7, 4, 2)}
    with pytest.raises(Exception, match="kept row"):
        exact.update_index(exact.live_digests(live, 2), inserts, removes, 2).collect()


def test_apportionment_gives_all_seats(spark):
    rng = random.Random(6)
    weights = [rng.randrange(1, 1000) for _ in range(30)]
    for seats in (0, 3, 17, 1000):
        rows = spark.createDataFrame([(0, i, float(w), seats) for i, w in enumerate(weights)], "g int, i int, w double, seats long")
        got = {r.i: r.quota for r in mixing.apportion(rows, ["g"], ["i"], "w", "seats").collect()}
        want = Counter(i for _, i in sorted(((-w / (2 * k + 1), i) for i, w in enumerate(weights) for k in range(seats)))[:seats])
        assert got == {i: want[i] for i in range(30)}


def test_mix(spark):
    docs = awkward(spark, *[(100 + i, "w " * (i % 50)) for i in range(300)])
    rows = mixing.mix(docs).collect()
    assert len(rows) == docs.count() and all(r.taken <= 3 * r.size for r in rows)
    by = {r.source: r for r in rows}
    for source, r in by.items():
        assert abs(sum(x.taken for x in rows if x.source == source) - r.target) <= mixing.BLOCK_WORDS
    again = mixing.mix(docs.repartition(3)).collect()
    assert Counter(map(tuple, rows)) == Counter(map(tuple, again))
    texts = mixing.mixed_texts(docs)
    assert texts.columns == docs.columns
    assert sum(len(r.text.split()) for r in texts.collect()) == sum(r.taken for r in rows)
    assert mixing.mix(nothing(spark)).count() == 0 and mixing.mixed_texts(nothing(spark)).count() == 0


def test_near_copies(spark):
    rng = random.Random(8)
    base = [[f"w{rng.randrange(5000)}" for _ in range(rng.randrange(40, 300))] for _ in range(40)]
    docs, at = [], 0
    for words in base:
        for copy in range(3):
            changed = list(words)
            for _ in range(copy * len(words) // 100):
                changed[rng.randrange(len(words))] = f"x{rng.random()}"
            docs.append((at, " ".join(changed) + " this passage stands in every text of all of them"))
            at += 1
    sets = [{tuple(x.split()[i : i + 5]) for i in range(len(x.split()) - 4)} for _, x in docs]
    parent = list(range(len(docs)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                parent[max(find(i), find(j))] = min(find(i), find(j))
    kept = {r.doc_id for r in near.drop_near(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert kept == {i for i in range(len(docs)) if find(i) == i} and len(kept) < len(docs)
    got = near.drop_near(awkward(spark)).collect()
    assert sorted((r.doc_id or 0) for r in got) == [0, 1, 3, 3, 7, 8]
    assert near.drop_near(nothing(spark)).count() == 0


@given(st.lists(st.lists(st.sampled_from("ab"), max_size=9), min_size=1, max_size=5))
@settings(max_examples=100, deadline=None)
def test_shingle_sets(texts):
    names: dict[tuple, int] = {}
    for got, text in zip(near.shingle_sets([" ".join(x).encode() for x in texts], repeats=True), texts, strict=True):
        want = [tuple(text[i : i + 5]) for i in range(max(1, len(text) - 4))] if text else []
        assert len(got) == len(want) and all(names.setdefault(w, g) == g for w, g in zip(want, got.tolist()))
    assert len(set(names.values())) == len(names)


def _texts_near(base, copies, rng):
    """A text of new words, and copies with 0.82 to 0.88 of similarity to it by independent edits."""
    words = [f"w{rng.random()}" for _ in range(base)]
    grams = lambda x: {tuple(x[i : i + 5]) for i in range(len(x) - 4)}
    out = [words]
    while len(out) <= copies:
        changed = list(words)
        for at in rng.sample(range(len(words)), rng.randrange(4, 8)):
            changed[at] = f"x{rng.random()}"
        both = len(grams(changed) & grams(words)) / len(grams(changed) | grams(words))
        if 0.82 <= both <= 0.88:
            out.append(changed)
    return [" ".join(x) for x in out]


def test_near_copies_of_one_text_that_are_not_near_each_other(spark):
    rng = random.Random(12)
    docs = [(1000 * k + i, x) for k in range(3) for i, x in enumerate(_texts_near(300, 60, rng))]
    got = near.drop_near(spark.createDataFrame(docs, "doc_id long, text string"))
    assert sorted(r.doc_id for r in got.collect()) == [0, 1000, 2000]


def test_near_copies_whose_least_hashes_differ(spark):
    rng = random.Random(5)
    words = [f"w{rng.random()}" for _ in range(600)]
    hashed = lambda x: near.shingle_sets([" ".join(x).encode()], repeats=True)[0]
    h = hashed(words)
    bar, changed = np.sort(h)[63], list(words)
    for at in sorted(range(10, 590), key=lambda i: -(h[i - 4 : i + 1] <= bar).sum()):
        if changed[at - 5 : at + 6] == words[at - 5 : at + 6]:
            tries = [f"x{rng.random()}" for _ in range(60)]
            changed[at] = max(tries, key=lambda x: (hashed(words[at - 4 : at] + [x] + words[at + 1 : at + 5]) <= bar).sum())
        if sum(x != y for x, y in zip(words, changed)) == 12:
            break
    a, b = np.unique(h), np.unique(hashed(changed))
    assert near.alike(a, b) >= 0.8 and len(np.intersect1d(a[:64], b[:64])) < 40
    got = near.drop_near(spark.createDataFrame([(1, " ".join(words)), (2, " ".join(changed))], "doc_id long, text string"))
    assert [r.doc_id for r in got.collect()] == [1]


def test_classifier_on_held_out_documents(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{x}.parquet") for x in ("documents", "labels"))
    rows = QUERIES["op9_attention_quality"](spark, "/root/testdata/sf0.01").join(labels, "doc_id").where("held_out").collect()
    assert rows and sum(r.predicted == r.quality for r in rows) >= 0.95 * len(rows)
    got = quality.scores(awkward(spark), quality.learn(docs, labels)).collect()
    assert all(0 <= r.score <= 1 for r in got) and len(got) == 7
    assert quality.learn(docs, labels.where("quality = 1")) == 1.0 and quality.learn(docs, labels.where("false")) == 0.5
    assert quality.scores(nothing(spark), 0.5).count() == 0


@pytest.mark.parametrize("name", sorted(SQL))
def test_sql(spark, name):
    con = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    want, got = con.execute(SQL[name]).df(), QUERIES[name](spark, SF).toPandas()
    rows = lambda d: sorted(tuple("null" if pd.isna(v) else f"{v:.9g}" if isinstance(v, float) else str(v) for v in r) for r in d[sorted(d.columns)].astype(object).itertuples(index=False))
    assert rows(got) == rows(want)
