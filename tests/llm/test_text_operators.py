"""Operators that read texts, against brute force, with the awkward rows."""

import random
import re
import struct
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tessera.llm import packing, rules, scoring, sharding, suffix, tokens
from tessera.llm.common import Scratch, crc_mod

PATH = public_tokenizers.path(tokens.TOKENIZER)
WHOLE = Tokenizer.from_file(PATH)
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score int, key string, row int, size int"


def awkward(spark, *more):
    """Null and empty texts, a null id, repeated rows, a very long text; columns whose names the operators use too."""
    rows = [(1, None), (2, ""), (3, "a b c"), (3, "a b c"), (None, "x y"), (7, "Word! " * 30_000), (8, "été ’n it's <|endoftext|> A.B"), *more]
    return spark.createDataFrame([(i, x, "en" if i else None, None if i == 2 else "s", 0, 1, "k", 2, 3) for i, x in rows], SCHEMA)


def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@given(st.lists(st.text(st.sampled_from("aAbß .,'s\t\n!*#9éÉΣ|<>´́"), max_size=40), max_size=5))
@settings(max_examples=150, deadline=None)
def test_encoder_is_the_tokenizer(texts):
    ids, n = tokens.Encoder.of(PATH).encode([x.encode() for x in texts])
    want = [[*WHOLE.encode(x, add_special_tokens=False).ids, 2] for x in texts]
    assert ids.tolist() == [i for x in want for i in x] and n.tolist() == [len(x) for x in want]


@given(st.lists(st.lists(st.integers(0, 49_407), min_size=1, max_size=300), max_size=6))
@settings(max_examples=80, deadline=None)
def test_blocks_round_trip(docs):
    lengths = np.array([len(d) for d in docs], np.int64)
    flat = np.array([i for d in docs for i in d], np.uint32)
    a, b, c = tokens.unpack(tokens.pack(np.arange(len(docs)), lengths, flat))
    assert a.tolist() == list(range(len(docs))) and b.tolist() == lengths.tolist() and c.tolist() == flat.tolist()


@given(st.lists(st.integers(1, 700), min_size=1, max_size=6), st.integers(0, 5))
@settings(max_examples=60, deadline=None)
def test_block_index_finds_documents(lengths, seed):
    ids = np.random.default_rng(seed).zipf(1.3, sum(lengths)).clip(0, 49_407).astype(np.uint32)
    segment = tokens.Segment(tokens.pack(np.arange(len(lengths)), np.array(lengths), ids))
    ends = np.cumsum(lengths)
    assert all(segment.document(i).tolist() == ids[e - n : e].tolist() for i, (n, e) in enumerate(zip(lengths, ends)))


def test_words_are_cut_and_named():
    from tessera.llm.common import Words

    texts = ["a b", "", "Ab  aB\t", "x" * 40 + " " + "x" * 40 + "y", "aaaaaaaabbbbbbbbc aaaaaaaabbbbbbbb a\0 a"]
    w = Words([x.encode() for x in texts])
    want = [(i, x) for i, t in enumerate(texts) for x in re.findall(r"[^\x20\x09-\x0D]+", t.lower())]
    assert [(d, w.raw[a:b].decode()) for d, a, b in zip(w.doc, w.start, w.end)] == want
    names = dict(zip((x for _, x in want), w.hash.tolist()))
    assert len(set(names.values())) == len(names) and all(names[x] == h for (_, x), h in zip(want, w.hash.tolist()))
    # words whose running sums agree: a name must not be such a sum
    thue = [sum(map(int, bin(i)[2:])) % 2 for i in range(1024)]
    pair = Words(["".join("ab"[b ^ k] for b in thue).encode() for k in (0, 1)])
    assert pair.hash[0] != pair.hash[1]


def test_blocks_with_outliers():
    ids = np.array([5] * 500 + [49_407] + [6] * 30, np.uint32)
    packed = tokens.pack(np.array([1]), np.array([531]), ids)
    assert tokens.unpack(packed)[2].tolist() == ids.tolist() and len(packed) < 300


def test_token_files(spark):
    scratch = Scratch(spark, "t")
    docs = awkward(spark)
    tokens.write_token_files(docs, scratch.path("f"), PATH, segment_tokens=1000)
    got = sorted(tokens.token_index(spark, scratch.path("f")).collect(), key=lambda r: r.start)
    rows = sorted(((r.doc_id, r.text or "") for r in docs.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    at = 0
    for r, (doc, x) in zip(got, rows, strict=True):
        ids = [*WHOLE.encode(x, add_special_tokens=False).ids, 2]
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (doc, at, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids)))
        at += len(ids)
    assert len(tokens.read_token_files(spark, scratch.path("f"), with_ids=True).where("doc_id = 3").first().ids) == 4
    tokens.write_token_files(nothing(spark), scratch.path("g"), PATH)
    assert tokens.token_index(spark, scratch.path("g")).count() == 0


def test_cut_covers_a_length():
    for n in [1, 2, 63, 64, 65, 1000, 1365, 2048, 2049, 4095, 4096, 4097, 100_000]:
        parts = packing.cut(n)
        assert sum(x for x, _ in parts) == n and all(x * k <= 4096 for x, k in parts)


def test_packing(spark):
    docs = awkward(spark, *[(100 + i, "word " * (i * 37 % 900)) for i in range(200)])
    rows = packing.pack_documents(docs, PATH).toPandas()
    assert rows.length.sum() == sum(len(WHOLE.encode(r.text or "", add_special_tokens=False).ids) + 1 for r in docs.collect())
    for _, g in rows.sort_values("offset").groupby("sequence_id"):
        assert (g.offset == g.length.cumsum() - g.length).all() and g.length.sum() <= 4096
    assert rows.length.sum() > 0.97 * 4096 * (rows.sequence_id.nunique() - 1)
    assert packing.pack_documents(nothing(spark), PATH).count() == 0


def counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    runs = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    seen, covered = Counter(runs), set()
    for i, r in enumerate(runs):
        if seen[r] > 1:
            covered |= {i, i + 1, i + 2}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def test_rule_counts(spark):
    rng = random.Random(1)
    more = [(100 + i, "".join(rng.choice(["a", "b", "c ", " ", "\n", "#", "é", "\x0b"]) for _ in range(rng.randrange(400)))) for i in range(60)]
    docs = awkward(spark, *more)
    labels = spark.createDataFrame([(1, 1, 0), (100, None, 0), (101, 0, 0), (101, 1, 0)], "doc_id long, quality int, toxic int")
    got = rules.judge(docs, labels).collect()
    want = Counter((r.doc_id, counts(r.text or "")) for r in docs.collect())
    assert Counter((r.doc_id, (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)) for r in got) == want
    assert all(r.kept == (not r.base_failed) for r in got)  # too few labels to prove a cutoff
    assert rules.judge(nothing(spark), labels).count() == 0


@pytest.mark.parametrize("n,k,p", [(10, 0, 0.05), (300, 7, 0.05), (20_000, 150, 0.01)])
def test_binomial(spark, n, k, p):
    from math import exp, lgamma, log

    from pyspark.sql import functions as F

    got = spark.range(1).select(rules.binomial_log_cdf(F.lit(n).cast("long"), F.lit(k).cast("long"), p).alias("v")).first().v
    want = sum(exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * log(p) + (n - i) * log(1 - p)) for i in range(k + 1))
    assert abs(got - log(want)) < 1e-6


def test_cutoffs_are_learned_and_hold(spark):
    good = [(i, "plain words only " * 20 + str(i)) for i in range(700)]
    bad = [(1000 + i, "ba### wo*** " * 40 + str(i)) for i in range(40)]
    texts = [(i, " ".join(f"{w}{j * 7919 % 997}" for j, w in enumerate(x.split()))) for i, x in good + bad]
    docs = spark.createDataFrame([(i, x, "en") for i, x in texts], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, int(i < 1000), 0) for i, _ in texts], "doc_id long, quality int, toxic int")
    kept = {r.doc_id for r in rules.judge(docs, labels).where("kept").collect()}
    assert kept == {i for i, _ in good}


def brute_spans(docs, length):
    seen, out = set(), []
    for doc, text in docs:
        mask = bytearray(len(text))
        for p in range(len(text) - length + 1):
            w = text[p : p + length]
            if w in seen:
                mask[p : p + length] = b"\1" * length
            seen.add(w)
        out.append((doc, len(text), sum(mask), len(re.findall(rb"\x01+", bytes(mask))), bytes(x for x, m in zip(text, mask) if not m)))
    return out


@pytest.mark.parametrize("length", [12, 100])
def test_repeats(spark, length):
    rng = random.Random(length)
    parts = ["".join(rng.choice("ab cé") for _ in range(rng.randrange(1, 2 * length))) for _ in range(30)]
    docs = [(i, "".join(rng.choice(parts) for _ in range(rng.randrange(6)))) for i in range(120)] + [(500, "a" * 5000), (501, "ab" * 900), (502, None)]
    rows = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    seed = suffix.SEED_LENGTH
    suffix_seed = min(seed, length // 3)
    import tessera.llm.suffix as module

    was = module.repeated_spans
    module.repeated_spans = lambda d, s, n: was(d, s, n, suffix_seed, 20)
    try:
        got = {r.doc_id: r for r in suffix.remove_repeats(rows, length, with_text=True).collect()}
    finally:
        module.repeated_spans = was
    for doc, n, removed, spans, kept in brute_spans([(d, (x or "").encode()) for d, x in docs], length):
        r = got[doc]
        assert (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) == (n, removed, spans, kept)


def test_repeats_of_awkward_rows(spark):
    docs = awkward(spark, (9, "Word! " * 50))
    got = suffix.remove_repeats(docs).collect()
    assert len(got) == docs.count()
    by = {r.doc_id: r for r in got}
    assert by[9].n_removed == 300 and by[7].n_removed == 180_000 - 6 and by[1].n_bytes == 0
    assert suffix.remove_repeats(nothing(spark)).count() == 0


def test_pieces_of_long_texts_meet(monkeypatch):
    monkeypatch.setattr(suffix, "_CHUNK", 1000)
    text = bytes(random.Random(3).choice(b"abc ") for _ in range(5000))
    cut = suffix.text_runs([text])
    monkeypatch.setattr(suffix, "_CHUNK", 1 << 22)
    whole = suffix.text_runs([text])
    starts = lambda r: sorted((p, n) for a, b, n in zip(r["lo"], r["hi"], r["name"]) for p in range(a, b + 1))
    assert starts(cut) == starts(whole)


class PlainTree:
    """The model told word by word, from the definition alone."""

    def __init__(self, texts, depth):
        self.depth, self.counts = depth, [Counter(tuple(t[i : i + k]) for t in texts for i in range(len(t) - k + 1)) for k in range(1, depth + 2)]
        self.total, self.distinct = sum(self.counts[0].values()), len(self.counts[0])
        self.kept = {}
        for k in range(1, depth + 1):
            followers = {}
            for run, n in self.counts[k].items():
                if n >= 2:
                    followers.setdefault(run[:-1], {})[run[-1]] = n
            for context, after in followers.items():
                total = self.counts[k - 1][context]
                rest = 1 - sum(n - 0.75 for n in after.values()) / total
                below = {w: self.p(context[1:], w) for w in after}
                own = {w: (n - 0.75) / total + rest * below[w] for w, n in after.items()}
                gain = sum(own[w] * np.log(own[w] / below[w]) for w in after) + rest * max(0, 1 - sum(below.values())) * np.log(rest)
                if total * gain > 0.5 * len(after) * np.log(total):
                    self.kept[context] = rest, own

    def p(self, context, word):
        if not context:
            return (self.counts[0][(word,)] + 0.5) / (self.total + 0.5 * (self.distinct + 1))
        rest, own = self.kept.get(context, (1, {}))
        return own[word] if word in own else rest * self.p(context[1:], word)

    def score(self, text):
        return sum(np.log10(self.p(tuple(text[max(0, i - self.depth) : i]), w)) for i, w in enumerate(text))


@given(st.lists(st.integers(-(1 << 63), (1 << 63) - 1), unique=True, max_size=300), st.lists(st.integers(-(1 << 63), (1 << 63) - 1), max_size=20))
@settings(max_examples=60, deadline=None)
def test_table_finds_keys(keys, others):
    keys = np.array(keys, np.int64).view(np.uint64)
    table = scoring.Table(keys, n=np.arange(len(keys)))
    assert table.values["n"][table.find(keys)].tolist() == list(range(len(keys)))
    assert [x >= 0 for x in table.find(np.array(others, np.int64).view(np.uint64))] == [x in set(keys.view(np.int64).tolist()) for x in others]


def test_run_keys_are_those_of_spark(spark):
    rows = [(-5, 7), (1 << 62, -1), (0, 0)]
    want = [r[0] for r in spark.createDataFrame(rows, "a long, b long").selectExpr("xxhash64(a, b)").collect()]
    a, b = np.array(rows, np.int64).view(np.uint64).T
    assert scoring.xxhash_long(b, scoring.xxhash_long(a, np.full(3, 42, np.uint64))).view(np.int64).tolist() == want


@pytest.mark.parametrize(("depth", "hot", "shard"), [(2, 2e-6, 4_000_000), (3, 0.02, 500), (2, 2.0, 100)])
def test_scores(spark, monkeypatch, depth, hot, shard):
    monkeypatch.setattr(scoring, "_SHARD", shard)
    rng = random.Random(5)
    more = [(100 + i, " ".join(f"w{(i % 3) * 100 + (j * 3 + rng.randrange(2)) % 40}" for j in range(200))) for i in range(60)]
    twice = " ".join(f"rare{i}" for i in range(80))
    docs = awkward(spark, *more, (103, twice), (104, twice), (105, twice))  # 103 and 105 are learned
    got = scoring.scored(docs, crc_mod("doc_id", 5) != 1, depth=depth, hot=hot).collect()
    assert len(got) == docs.count()
    up = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
    words = lambda x: [*re.findall(rb"[^\x20\x09-\x0D]+", (x or "").encode().translate(up)), 1]
    rows = docs.collect()
    held_out = lambda i: zlib.crc32(str("" if i is None else i).encode()) % 5 == 1
    tree = PlainTree([words(r.text) for r in rows if not held_out(r.doc_id)], depth)
    train = {w: n for (w,), n in tree.counts[0].items()}
    base = lambda t: sum(np.log10(tree.p((), w)) for w in t)
    want = Counter((r.doc_id, len(t), sum(w in train for w in t), round(base(t), 3), round(tree.score(t), 3)) for r in rows for t in [words(r.text)])
    assert Counter((r.doc_id, r.n_tokens, r.n_known, round(r.base_score, 3), round(r.score, 3)) for r in got) == want
    held = [r for r in got if r.doc_id and r.doc_id >= 100 and held_out(r.doc_id)]
    assert sum(r.score for r in held) > sum(r.base_score for r in held) and all(r.train_tokens == tree.total for r in got)
    assert min(r.score - r.base_score for r in got if r.n_tokens == 81) > 80  # a text that occurs twice is learned


def test_scores_without_rows(spark):
    assert scoring.scored(nothing(spark), crc_mod("doc_id", 5) != 1).count() == 0
    assert {(r.n_known, r.score) for r in scoring.scored(awkward(spark), crc_mod("doc_id", 5) < 0).collect()} == {(0, 0.0)}


def test_rules_act_in_every_stratum_with_labels_enough(spark):
    rng = random.Random(3)
    words = lambda n: " ".join(f"w{rng.random()}" for _ in range(n))
    rows = []
    for lang, good, bad in (("en", 300, 30), ("fr", 300, 30), ("de", 20, 5)):
        rows += [(len(rows) + i, words(60), lang, 1) for i in range(good)]
        rows += [(len(rows) + i, words(60).replace(" ", "### "), lang, 0) for i in range(bad)]
    docs = spark.createDataFrame([r[:3] for r in rows], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(r[0], r[3], 0) for r in rows], "doc_id long, quality int, toxic int")
    kept = {r.doc_id for r in rules.judge(docs, labels).where("kept").collect()}
    # too few labels in the third stratum: nothing may be rejected there
    assert kept == {i for i, _, lang, good in rows if good or lang == "de"}
    noisy = spark.createDataFrame([(r[0], int(r[0] % 7 > 0 or r[3]), 0) for r in rows], "doc_id long, quality int, toxic int")
    got = rules.judge(docs, noisy).join(noisy, "doc_id").where("quality = 1").collect()
    assert sum(not r.kept for r in got) <= 0.05 * len(got)


def test_two_writers_lose_no_rows(spark, tmp_path, monkeypatch):
    one, two = (sharding.ShardStore(spark, f"file://{tmp_path}/s", target=1 << 20, least=1 << 10, fan_in=2) for _ in range(2))
    docs = awkward(spark).repartition(2)
    n = docs.count()
    one.append(docs)
    shards = one._shards

    def late(folder, version, id_column):
        """The other writer commits and cleans up while this one is about to commit."""
        monkeypatch.setattr(one, "_shards", shards)
        two.append(docs)
        two.settle()
        return shards(folder, version, id_column)

    monkeypatch.setattr(one, "_shards", late)
    one.append(docs)
    assert one.read().count() == 3 * n
    monkeypatch.setattr(one, "_shards", late)
    one.compact()
    assert one.read().count() == 4 * n
    folder = one._folder()
    docs.write.parquet(f"file://{tmp_path}/s/data/{folder}")
    one.expire()
    assert folder in one._names("data")
    one.forget(-1)
    one.expire()
    assert folder not in one._names("data") and one.read().count() == 4 * n


def test_shards_compact_and_versions_hold(spark, tmp_path):
    store = sharding.ShardStore(spark, f"file://{tmp_path}/s", target=1 << 20, least=1 << 10, fan_in=3)
    docs = awkward(spark).repartition(4)
    for _ in range(3):
        store.append(docs)
    assert store.versions() == [1, 2, 3] and store.read(2).count() == 2 * docs.count()
    before = store.manifest().count()
    version = store.settle()
    assert store.manifest().count() < before and store.versions() == [version]
    assert store.read().count() == 3 * docs.count() and store.read().columns == docs.columns
    with pytest.raises(sharding.Conflict):
        store._commit(store.manifest(), version, [])
    store.append(nothing(spark))
    assert store.read().count() == 3 * docs.count()
