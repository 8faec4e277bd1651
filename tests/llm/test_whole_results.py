"""Whole results against plain versions: passages of the classifier, packed pieces, every stage of the pipeline."""

import re
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from test_text_operators import WHOLE, awkward

import corpus_pipeline
from tessera.llm import packing, quality, tokens
from tessera.llm.common import Scratch
from tessera.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
WORD = re.compile(rb"[^\x20\x09-\x0D]+")
TEXTS = ["", " \n", "a", "One, two!! three|four 5% <b>", "same same same words same words same words again", "x y z " * 70 + "end?", "été 'n " * 40 + "#tag $5 &c * \n|"]


def plain_shares(text):
    """One list of shares a passage."""
    found = list(WORD.finditer(text))
    words = [m.group() for m in found]
    runs = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    again = [r in runs[:i] for i, r in enumerate(runs)] + [False, False]
    out = []
    for at in range(0, len(words), 64):
        own, spans = words[at : at + 64], found[at : at + 64]
        chars, n = text[spans[0].start() : spans[-1].end()], len(own)
        row = [sum(c in kind for c in chars) / len(chars) for kind in quality._CLASSES]
        row += [np.log(np.mean([len(w) for w in own])), sum(len(w) <= 3 for w in own) / n, sum(len(w) > 14 for w in own) / n, sum(w[-1:] in b"!?#*$%&|" for w in own) / n]
        row += [len(set(own)) / n, sum(i > 0 and words[i] == words[i - 1] for i in range(at, at + n)) / n, sum(again[at : at + n]) / n, n / 64, np.log1p(len(words)) / 8, 1]
        out.append(row)
    return out or [[0.0] * quality.N_FEATURES]


def test_passages_are_described_as_by_plain_counting():
    texts = [x.encode() for x in TEXTS]
    got, want = quality.passages(texts), [plain_shares(x) for x in texts]
    assert got.parts.tolist() == [len(x) for x in want]
    assert np.allclose(got.shares, [row for x in want for row in x], atol=1e-6)


def test_words_and_their_edges_have_one_bucket_wherever_they_stand():
    texts = [x.encode() for x in TEXTS]
    found = quality.passages(texts)
    words = [w for x in texts for w in WORD.findall(x)]
    assert found.sizes.sum() == len(found.buckets) == quality.EDGES * len(words) and found.sizes[0] == 0
    seen = [{}, {}, {}]
    for word, (whole, head, tail) in zip(words, found.buckets.reshape(-1, quality.EDGES).tolist(), strict=True):
        last = bytes(word[max(0, len(word) - k)] for k in (1, 2, 3))
        assert seen[0].setdefault(word, whole) == whole and seen[1].setdefault(word[:3], head) == head and seen[2].setdefault(last, tail) == tail
    bags = np.concatenate(list(found.bags()))
    at = np.cumsum(found.sizes) - found.sizes
    for bag, a, n in zip(bags, at, found.sizes):
        want = np.bincount(found.buckets[a : a + n], minlength=1 << quality.BUCKET_BITS) / max(n, 1)
        assert np.allclose(bag, want)


def test_gradient(monkeypatch):
    monkeypatch.setattr(quality, "BLOCK", 4)
    rng = np.random.default_rng(3)
    sizes = np.array([2, 0, 3, 1, 2, 2, 4, 0, 1])
    found = quality.Passages(rng.normal(size=(9, 5)), np.array([2, 3, 4]), rng.integers(510, 514, sizes.sum()), sizes)
    y, bags = np.array([0.0, 1.0, 1.0]), list(found.bags(float))
    model = quality.fit(found, y, width=4, rounds=2, dtype=float)
    loss = lambda: -np.mean(y * np.log(p := model.score(found, float)) + (1 - y) * np.log(1 - p))
    grads = model.gradient(found.shares, bags, found.parts, y, 0.0)
    assert np.abs(grads[7][510:514]).min() > 0 and not grads[7][:510].any()
    for i, grad in enumerate(grads):
        place = tuple(np.array(grad.shape) // 2)
        model.w[i] = np.array(model.w[i], float)
        model.w[i][place] += 1e-6
        up = loss()
        model.w[i][place] -= 2e-6
        assert abs((up - loss()) / 2e-6 - grad[place]) < 1e-4
        model.w[i][place] += 1e-6


def test_words_alone_tell_labels(spark):
    """Texts of equal shares that differ in their words only: shares alone could not tell them."""
    rng = np.random.default_rng(5)
    good, bad = (["lemon", "maple", "cedar", "olive"], ["melon", "pearl", "acorn", "viola"])
    text = lambda y: " ".join(rng.choice(good if y else bad, 100))
    rows = [(i, text(i % 2)) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(600)], "doc_id long, quality int")
    kept = {r.doc_id for r in quality.keep_good(docs, labels, 0.5).collect()}
    held = [i for i in range(600) if zlib.crc32(str(i).encode()) % 5 == 0]
    assert len(held) > 50 and all((i in kept) == bool(i % 2) for i in held)


def plain_ids(text):
    return [*WHOLE.encode(text or "", add_special_tokens=False).ids, 2]


def check_packed(rows, texts):
    """Pieces hold every id of every text once, under the checksums of those ids, in full places without gaps."""
    left = defaultdict(list)
    for doc, text in texts:
        left[doc].append(plain_ids(text))
    by_doc = defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
    assert by_doc.keys() == left.keys()
    for doc, pieces in by_doc.items():
        starts = defaultdict(list)
        for r in pieces:
            starts[(r.doc_tokens, r.start)].append(r)
        want, got = [], []
        for ids in left[doc]:
            at = 0
            while at < len(ids):
                r = starts[(len(ids), at)][0]
                want.append((at, r.length, zlib.crc32(np.array(ids[at : at + r.length], "<u4").tobytes())))
                at += r.length
        got = [(r.start, r.length, r.ids_crc32) for r in pieces]
        assert sorted(got) == sorted(want)
    places = defaultdict(list)
    for r in rows:
        places[r.sequence_id].append((r.offset, r.length))
    for held in places.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= 4096


def test_packed_pieces_are_those_of_the_tokenizer(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    check_packed(QUERIES["op5_harmonic_packing"](spark, SF).collect(), [(r.doc_id, r.text) for r in docs.collect()])
    odd = awkward(spark)
    check_packed(packing.pack_documents(odd, public_tokenizers.path(tokens.TOKENIZER)).collect(), [(r.doc_id, r.text) for r in odd.collect()])


def plain_near(texts):
    """The least id of each group of texts linked at 0.8 or more over sets of five-word shingles."""
    sets = {}
    for i, text in texts.items():
        words = [w.lower() for w in WORD.findall((text or "").encode())]
        sets[i] = {tuple(words[a : a + 5]) for a in range(max(1, len(words) - 4))} if words else set()
    group = {i: i for i in texts}

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in texts:
        for j in texts:
            if i < j and (len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])):
                a, b = sorted((root(i), root(j)))
                group[b] = a
    return {i for i in texts if group[i] == i}


def test_every_stage_of_the_pipeline(spark):
    """Each stage on what the one before kept, against a plain version; the whole run against the stages."""
    docs, scratch, by = spark.read.parquet(f"{SF}/documents.parquet"), Scratch(spark, "t"), {}
    columns, labels = docs.columns, spark.read.parquet(f"{SF}/labels.parquet")
    held = {"start": docs}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = held[name] = scratch.keep(stage(spark, docs, SF), name)
        assert docs.columns == columns
    by = {name: {r.doc_id: r for r in x.collect()} for name, x in held.items() if name != "mixing"}
    model = quality.learn(held["start"], labels)
    score = dict(zip(by["start"], model.score(quality.passages([(r.text or "").encode() for r in by["start"].values()]))))
    assert by["quality"].keys() == {i for i, s in score.items() if s >= quality.THRESHOLD}
    last = {}
    for i, r in sorted(by["quality"].items()):
        last[(r.text or "").encode().lower()] = i
    assert by["exact"].keys() == set(last.values())
    assert by["near"].keys() == plain_near({i: r.text for i, r in by["exact"].items()})
    words = lambda text: WORD.findall((text or "").encode())
    size = {i: len(words(r.text)) for i, r in by["near"].items()}
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(sorted({r.source for r in by["near"].values()}, key=lambda s: (s is None, s or "")))}
    own = {s: sum(n for i, n in size.items() if by["near"][i].source == s) for s in weight}
    target, full = {}, set()
    while True:
        share = (sum(own.values()) - sum(3 * own[s] for s in full)) / (sum(w for s, w in weight.items() if s not in full) or 1)
        target = {s: 3 * own[s] if s in full else share * w for s, w in weight.items()}
        over = {s for s in weight if s not in full and target[s] > 3 * own[s]}
        if not over:
            break
        full |= over
    taken, per = defaultdict(int), defaultdict(int)
    mixed = held["mixing"].collect()
    for r in mixed:
        n = len(words(r.text))
        taken[r.source] += n
        per[r.doc_id] += n
        whole = words(by["near"][r.doc_id].text)
        assert b" ".join(words(r.text)) in b" ".join(whole)
    from tessera.llm.mixing import BLOCK_WORDS

    assert all(abs(taken[s] - target[s]) <= BLOCK_WORDS for s in weight) and all(n <= 3 * size[i] for i, n in per.items())
    packed = corpus_pipeline.STAGES[-1][1](spark, held["mixing"], SF).collect()
    check_packed(packed, [(r.doc_id, r.text) for r in mixed])
    key = lambda r: (r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens)
    assert sorted(map(key, corpus_pipeline.run(spark, SF).collect())) == sorted(map(key, packed))
