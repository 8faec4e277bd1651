"""Operators 11 to 13 against brute force, with the awkward rows."""

import math
import random
import re
import zlib
from collections import Counter
from hashlib import sha256

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.llm import importance, phrases, token_counts
from tessera.llm.common import Scratch

PATH = public_tokenizers.path(token_counts.MODEL)
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PATH)
SCHEMA = "doc_id long, text string, lang string, n long, bucket long, a long, rank int, name long, __at int"


def awkward(spark, *more):
    """Null and empty texts, null ids and languages, repeated rows, a very long text; columns named like the operators' own."""
    rows = [(1, None, "en"), (2, "", None), (3, "a B, c", "en"), (3, "a B, c", "en"), (None, "x y", None), (7, "Word! " * 30_000, "und"), (8, "été <s>▁ </s>\n\t漢字 😀", "de"), *more]
    return spark.createDataFrame([(*r, 1, 2, 3, 4, 5, 6) for r in rows], SCHEMA)


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


# --- 12 -----------------------------------------------------------------------------------------------------------


@given(st.lists(st.lists(st.sampled_from(["a", "e", "the", " ", "  ", "\n", "\t", "▁", "é", "漢", "😀", ".", ",", "<s>", "</s>", "<0x0A>", "\0", "ing", "I'm", "\r\n", "0", "12", "x" * 20]), max_size=12), max_size=5))
@settings(max_examples=300, deadline=None)
def test_counts_are_the_librarys(pieces):
    texts = ["".join(x) for x in pieces]
    got = token_counts.Counter.of(PATH, token_counts.prove(PATH)).count([x.encode() for x in texts])
    assert got.tolist() == [len(LIBRARY.encode(x)) for x in texts]


def test_single_strings_are_proven():
    proof = token_counts.prove(PATH)
    assert len(proof.single) > 30_000 and len(set(proof.single)) == len(proof.single)
    for x in random.Random(1).sample(proof.single, 500):
        assert len(LIBRARY.encode("\n" + x.decode())) == proof.lead + 1


def test_known_parts_are_not_merged():
    counter = token_counts.Counter(PATH, token_counts.prove(PATH))
    counter.count([b"the house is on the hill"])
    assert counter.merged == 0 and counter.direct == 6
    counter.count([b"the zqxjkv is on the zqxjkv"])
    assert counter.merged == 1


def test_a_model_that_changes_texts_is_refused(tmp_path):
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto()
    model.ParseFromString(open(PATH, "rb").read())
    model.normalizer_spec.remove_extra_whitespaces = True
    (tmp_path / "m.model").write_bytes(model.SerializeToString())
    with pytest.raises(ValueError):
        token_counts.prove(str(tmp_path / "m.model"))


def test_token_counts_of_rows(spark):
    rows = awkward(spark)
    got = token_counts.count_tokens(rows, PATH).collect()
    want = [(r.doc_id, len((r.text or "").encode()), n := len(LIBRARY.encode(r.text or "")), n > 4096) for r in rows.collect()]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    assert token_counts.count_tokens(rows.limit(0), PATH).collect() == []


# --- 11 -----------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("limbs", [1, 3])
@pytest.mark.parametrize("bits", [0, 3, 16])
@pytest.mark.parametrize("n", [0, 1, 5, 3000])
def test_filters_hold_what_they_are_given(limbs, bits, n):
    rng = np.random.default_rng(n)
    keys = rng.integers(0, 2**63, (limbs, n)).astype(np.uint64)
    counts = np.where(rng.random(n) < 0.1, rng.integers(200, 10**12, n), rng.integers(1, 300, n))
    assert (phrases.restore(phrases.permute(keys)) == keys).all()
    spread, counts = phrases.combined(phrases.permute(keys), counts)
    back: list = []
    held = phrases.Filter(limbs)
    held.add_run(spread, counts)
    for _, raw in held.shards(bits):
        back.append(phrases.unpack_filter(raw))
    a, b = (np.concatenate(x, -1) for x in zip(*back)) if back else (spread[:, :0], counts[:0])
    assert (a == spread).all() and (b == counts).all()


@given(st.lists(st.lists(st.integers(0, 9), max_size=20), max_size=8), st.integers(4, 40))
@settings(max_examples=80, deadline=None)
def test_filters_count_and_merge(batches, most):
    total, merged = Counter(), phrases.Filter(1, most)
    for xs in batches:
        one = phrases.Filter(1, most)
        one.add(np.array([xs], np.uint64))
        for _, raw in one.shards(2):
            merged.add_run(*phrases.unpack_filter(raw))
        total.update(xs)
    keys, counts = merged.take()
    assert dict(zip(phrases.restore(keys)[0].tolist(), counts.tolist())) == total


def test_filters_are_compact():
    keys, counts = phrases.combined(phrases.permute(np.arange(1 << 16, dtype=np.uint64)[None]))
    assert len(phrases.pack_filter(keys, counts, 0, 0)) < 7.5 * (1 << 16)


def mined(rows, least, cover, top):
    """Every language's phrases by plain counting."""
    counts, n = {}, Counter()
    for text, lang in rows:
        lang = lang if lang is not None else "und"
        c = counts.setdefault(lang, Counter())
        for piece in re.split("[.,;:!?\n-\r]", lower(text)):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(w)
            c.update(tuple(w[i : i + k]) for k in (1, 2, 3) for i in range(len(w) - k + 1))
    out = []
    for lang, c in counts.items():
        found = {p: a for p, a in c.items() if len(p) > 1 and a >= least}
        best = []
        for p, a in found.items():
            if not any(len(q) > len(p) and 100 * b >= cover * a and p in (q[:-1], q[1:]) for q, b in found.items()):
                s, k = min((10**6 * a * a // (c[p[:k]] * c[p[k:]]), k) for k in range(1, len(p)))
                best.append((-s, -a, " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        out += [(lang, rank, p.decode(), -a, x, y, n[lang], -s) for rank, (s, a, p, x, y) in enumerate(sorted(best)[:top], 1)]
    return sorted(out)


@pytest.mark.parametrize("head, most", [(1 << 20, 1 << 22), (4, 64), (0, 1000)])
def test_phrases_are_those_of_plain_counting(spark, head, most):
    """With all, few and no words numbered: the runs of words without a number are counted by their names."""
    rnd = random.Random(head)
    words = ["a", "B", "the", "of", "new", "york", "city", "Ünder", "x" * 70, "x" * 70 + "y", "zz9", "q", "漢字"]
    rows = [(" ".join(rnd.choices(words, [9, 5, 9, 7, 4, 4, 3, 2, 2, 2, 1, 1, 1], k=rnd.randint(0, 60))).replace(" q ", rnd.choice([", ", "\n", " \t ", "; q "])), rnd.choice(["en", "de", None, "und"])) for _ in range(60)]
    rows += [(r.text, r.lang) for r in awkward(spark).collect()]
    df = spark.createDataFrame([(*r, 1, "w") for r in rows], "text string, lang string, n long, word string").repartition(3)
    got = phrases.mine_phrases(df, 3, 50, 30, head, most)
    assert sorted(map(tuple, got.collect())) == mined(rows, 3, 50, 30)
    assert phrases.mine_phrases(df.limit(0)).collect() == []


def test_scores_are_exact_beyond_64_bits(spark):
    rows = [(10**13 + 7, 10**13 + 9, 2 * 10**13 + 1), (3 * 10**12, 10**14 + 1, 3 * 10**12)]
    df = spark.createDataFrame(rows, "a long, l long, r long")
    got = df.select("a", "l", "r", phrases._score(df.a, df.l, df.r)[0].alias("s")).collect()
    assert all(x.s == 10**6 * x.a * x.a // (x.l * x.r) for x in got)


def test_words_of_one_name_are_seen(monkeypatch, spark):
    """Names that two words share are told from the words themselves, and another salt is tried."""
    made = phrases.Pieces.__init__

    def clash(self, texts, langs, salt):
        made(self, texts, langs, salt)
        if salt == 0:
            self.name = self.name * np.uint64(0) + np.uint64(5)

    monkeypatch.setattr(phrases.Pieces, "__init__", clash)
    words = phrases.Pieces([b"a b a c"], ["en"], 0)
    at, n = words.distinct()
    assert sorted(zip((words.raw[words.start[i] : words.end[i]] for i in at), n.tolist())) == [(b"a", 2), (b"b", 1), (b"c", 1)]


# --- 13 -----------------------------------------------------------------------------------------------------------


def runs(text, most):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))
    return [" ".join(w[i : i + n]) for n in range(1, most + 1) for i in range(len(w) - n + 1)], len(w)


@given(st.lists(st.one_of(st.none(), st.text(st.sampled_from("abZ09 é漢-_.\n\0"), max_size=30)), max_size=6), st.integers(1, 3))
@settings(max_examples=150, deadline=None)
def test_runs_are_hashed_by_text(texts, most):
    bucket, n, words = importance.features(pa.array(texts, pa.string()), most, 97)
    ends = np.cumsum(n)
    for i, text in enumerate(texts):
        want, w = runs(text, most)
        assert sorted(bucket[ends[i] - n[i] : ends[i]].tolist()) == sorted(zlib.crc32(x.encode()) % 97 for x in want) and words[i] == w


@pytest.mark.parametrize("most", [1, 2])
def test_resampling_is_the_plain_rule(spark, most):
    rnd = random.Random(most)
    more = [(i, " ".join(rnd.choices(["Red", "blue", "été", "x1", "y_z", "-"], k=rnd.randint(0, 60))), "en") for i in range(20, 140)]
    docs = awkward(spark, *more)
    target = spark.createDataFrame([("blue x1 " * 9,), (None,)], "text string")
    got = importance.resample(docs, target, most, 50, 7, 20, 10).collect()
    s, t = Counter(), Counter()
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    for c, texts in ((s, [x for _, x in rows]), (t, [r.text for r in target.collect()])):
        for x in texts:
            c.update(zlib.crc32(f.encode()) % 50 for f in runs(x, most)[0])
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (s.total() + 50) / ((s[b] + 1) * (t.total() + 50)))) for b in range(50)}
    want = []
    for i, x in rows:
        f, n = runs(x, most)
        h = int(sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[zlib.crc32(y.encode()) % 50] for y in f)
        want.append((i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), n >= 20))
    able = sorted((r for r in want if r[4]), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    place = {id(r): k for k, r in enumerate(able[: len(able) * 10 // 100], 1)}
    assert sorted(map(str, map(tuple, got))) == sorted(str((*r[:4], place.get(id(r)))) for r in want) and place


def test_resampling_of_nothing(spark):
    docs, target = awkward(spark), spark.createDataFrame([], "text string")
    assert importance.resample(docs.limit(0), target).collect() == []
    assert len(importance.resample(docs, target).collect()) == docs.count()


def test_ranks_go_on_over_ranges(spark):
    rows = spark.range(0, 1000, 1, 7).selectExpr("id", "id % 13 as score")
    got = importance.ranked(rows, [rows.score.desc(), rows.id.asc()], 400, Scratch(spark, "test"), "r").collect()
    want = {r.id: k for k, r in enumerate(sorted(got, key=lambda r: (-r.score, r.id)), 1)}
    assert all(r["rank"] == (want[r.id] if want[r.id] <= 400 else None) for r in got)
