"""Components whatever the nodes are called, the whole fingerprint query against a plain one, writers that lose their files."""

import random
import re

import numpy as np
import pytest
import xxhash

from tessera.llm import sharding, simhash
from tessera.llm.common import Scratch
from tessera.llm.graph import components


def plain(edges):
    to = {}

    def root(x):
        while to.setdefault(x, x) != x:
            x = to[x]
        return x

    for a, b in edges:
        x, y = root(a), root(b)
        to[max(x, y)] = min(x, y)
    return {x: root(x) for x in to}


def test_a_rising_chain_takes_few_rounds(spark):
    rounds: list[int] = []
    edges = spark.range(1000).selectExpr("id as a", "id + 1 as b")
    got = components(edges, Scratch(spark, "test"), rounds=rounds)
    assert {r.component for r in got.collect()} == {0} and got.count() == 1001 and rounds[0] <= 12


def test_components_are_those_of_plain_union(spark):
    rnd = random.Random(4)
    edges = [(rnd.randint(-200, 200), rnd.randint(-200, 200)) for _ in range(150)] + [(500, 500), (None, 3), (7, None)]
    got = components(spark.createDataFrame(edges, "a long, b long"), Scratch(spark, "test")).collect()
    want = plain([(a, b) for a, b in edges if a is not None and b is not None and a != b])
    assert {r.node: r.component for r in got} == want and len(got) == len(want)
    assert components(spark.createDataFrame([], "a long, b long"), Scratch(spark, "test")).collect() == []


def plain_fingerprint(text):
    words = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    grams = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) > 3 else [" ".join(words)] if words else []
    digests = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << bit for bit in range(64) if 2 * sum(d >> bit & 1 for d in digests) > len(digests))


def test_whole_query_against_a_plain_one(spark):
    rnd = random.Random(9)
    words = [f"w{i}" for i in range(300)]
    rows = [(1, None), (2, ""), (None, " \t"), (5, "a B"), (6, "A b"), (6, "C d e f"), (9, "É x É")]
    for i in range(40):
        text = rnd.choices(words, k=rnd.randint(1, 400))
        rows.append((100 + i, " ".join(text)))
        for j in range(rnd.randint(0, 3)):  # drifting versions, some under ids that others have too
            text = list(text)
            text[rnd.randrange(len(text))] = rnd.choice(words)
            rows.append((rnd.choice([None, 300 + 4 * i + j, 100 + i]), " ".join(text).upper()))
    fps = [plain_fingerprint(t) for _, t in rows]
    distinct = sorted(set(fps))
    linked = plain([(x, y) for i, x in enumerate(distinct) for y in distinct[i:] if (x ^ y).bit_count() <= 3])
    name = {}
    for (i, _), fp in zip(rows, fps):
        if i is not None:
            name[linked[fp]] = min(name.get(linked[fp], i), i)
    want = [(i, f"{fp:016x}", name.get(linked[fp])) for (i, _), fp in zip(rows, fps)]
    got = simhash.simhash_components(spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, fp long, node string")).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    assert len(set(linked.values())) < len(distinct) < len(rows)


def test_a_null_id_links_two_others(spark, monkeypatch):
    fp = {1: 0, None: 0b111, 9: 0b111111, 20: 0xFFFF << 20}
    rows = spark.createDataFrame([(i, x) for i, x in fp.items()] + [(9, np.uint64(0xFF << 50).view(np.int64).item())], "doc_id long, fp long")
    monkeypatch.setattr(simhash, "fingerprints", lambda docs, words: rows)
    got = simhash.simhash_components(rows).collect()
    assert sorted((str(r.doc_id), r.component_id) for r in got) == [("1", 1), ("20", 20), ("9", 1), ("9", 9), ("None", 1)]


def store(spark, path):
    return sharding.ShardStore(spark, f"file://{path}/store", target=1 << 20, least=1 << 10, fan_in=2)


def test_a_writer_whose_shards_were_expired_is_told(spark, tmp_path, monkeypatch):
    rows = spark.range(10).selectExpr("id as doc_id", "'x' as text")
    one = store(spark, tmp_path)
    one.append(rows)
    shards = one._shards

    def late(folder, *rest):
        other = store(spark, tmp_path)
        other.forget(-1)
        other.append(rows)
        other.expire()
        return shards(folder, *rest)

    monkeypatch.setattr(one, "_shards", late)
    with pytest.raises(sharding.LostShards):
        one.append(rows)
    assert store(spark, tmp_path).read().count() == 20


def test_a_lost_file_is_an_error_and_no_loop(spark, tmp_path):
    rows = spark.range(10).selectExpr("id as doc_id", "'x' as text").repartition(1)
    one = store(spark, tmp_path)
    for _ in range(2):
        one.append(rows)
    path = one.manifest().first().path
    one._fs().delete(spark._jvm.org.apache.hadoop.fs.Path(path), False)
    with pytest.raises(sharding.LostShards):
        one.compact()
