"""The subsequence kernel against its definition, the folded machine against its landmarks, and held-out accuracy."""

import random
import zlib
from collections import defaultdict
from itertools import combinations

import numpy as np
import pytest

from weftgraph.llm import toxicity

DOCUMENTS = "doc_id long, text string, label int, toxic int, score double"


def brute_vector(word):
    out = defaultdict(float)
    for p in (3, 4):
        for at in combinations(range(len(word)), p):
            if at[-1] - at[0] < toxicity.REACH:
                out["".join(word[i] for i in at)] += toxicity.DECAY ** (at[-1] - at[0] + 1)
    return out


def brute_kernel(a, b):
    a, b = brute_vector(a), brute_vector(b)
    size = lambda x: sum(v * v for v in x.values()) ** 0.5 + 1e-12
    return sum(v * b.get(k, 0) for k, v in a.items()) / size(a) / size(b)


def marked(word):
    return f"\x01{word}\x02"


def test_kernel_is_that_of_shared_subsequences():
    words = [marked(w) for w in ("idiot", "i.d.i.o.t", "idxiot", "idiotisch", "aaaa", "a", "", "éüß日本", "moron", "abababab")]
    space = toxicity.Landmarks.of(words)
    kernel = space.matrix.T @ space.matrix
    for i, a in enumerate(words):
        for j, b in enumerate(words):
            assert kernel[i, j] == pytest.approx(brute_kernel(a, b), abs=1e-6)
    assert kernel[0, 1] > kernel[0, 8] and kernel[0, 2] > 0.2  # gaps and inserted characters cost little


def test_folded_machine_gives_the_decisions_in_the_landmarks_space():
    rng = np.random.default_rng(3)
    space = toxicity.Landmarks.of([marked(w) for w in ("idiot", "stupid", "house", "garden", "i-d-i-o-t")])
    w = rng.normal(size=6)
    weights, intercept = space.fold(w)
    x = toxicity.features_of([marked(w) for w in ("idiots", "gardener", "zzz", "i d i o t", "")])
    assert toxicity.project(x, weights) + intercept == pytest.approx(space.map(x) @ w)


def test_spans_and_sentences():
    found = toxicity.spans(["You i d i o t Sir. a b\n" + "x" * 40, "", "  ", "É a\tb c! End"])
    words = [w[1:-1] for w in found.words(np.arange(len(found.starts)))]
    assert words == ["you", "i d i o t", "sir.", "a", "b", "x" * 24, "x" * 24, "x" * 16, "é a\tb", "c!", "end"]
    assert found.text.tolist() == [0] * 8 + [3] * (len(words) - 8)
    assert len(set(found.sentence.tolist())) == 5
    assert found.sentence[4] != found.sentence[5]
    again = toxicity.spans(["you i d i o t"])
    assert set(again.keys.tolist()) <= set(found.keys.tolist())
    some = np.array([0, 1, 5, 7])
    a, b = toxicity.features(found, some), toxicity.features_of(found.words(some))
    assert (a.index == b.index).all() and (a.value == b.value).all()


def test_long_texts_are_read_in_pieces(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(toxicity, "LONG", 50)
    text = "word " * 100 + "y" * 300 + " end"
    read = [x for x in toxicity.pieces(pa.array([text, None, "", "short"]))]
    assert "".join(p for rows, texts in read for r, p in zip(rows, texts) if r == 0) == text
    assert [p for rows, texts in read for r, p in zip(rows, texts) if r] == ["short"]


def corpus(n, seed):
    rng = random.Random(seed)
    stems = ["stupid", "moron", "vequ", "lostra"]
    clean = ["".join(rng.choice(("ta", "re", "on", "the", "li", "me", "an", "go", "é")) for _ in range(rng.randint(1, 4))) for _ in range(300)]
    rows, labels = [], []
    for i in range(n):
        words = rng.choices(clean, k=rng.randint(5, 120))
        words = [w + rng.choice(("", "", "", ".", ",")) for w in words]
        toxic = int(rng.random() < 0.2)
        if toxic:
            for _ in range(rng.randint(1, 3)):
                words[rng.randrange(len(words))] = rng.choice(stems) + rng.choice(("", "ta", "on", "é", "li", "s"))
        rows.append((i, " ".join(words)))
        labels.append((i, toxic))
    return rows, labels


def frames(spark, rows, labels):
    docs = spark.createDataFrame([(i, t, 0, 1, 0.5) for i, t in rows], DOCUMENTS).repartition(4)
    return docs, spark.createDataFrame([(i, y, 1, "t") for i, y in labels], "doc_id long, toxic int, quality int, text string")


def test_held_out_accuracy_and_gapped_insults(spark):
    rows, labels = corpus(900, 5)
    more = [(10_000, None), (10_001, ""), (10_002, " \n\t"), (10_003, "the tareon s.t.u.p.i.d golian"), (10_004, "the tareon stu-pid golian me"), (10_005, "the m o r o n golian"), (10_006, "the tareon STUPID golian"), (10_007, "metaon " * 20_000), (10_008, "metaon " * 20_000 + "moron"), (None, "the moron"), (10_009, "x" * 100_000)]
    docs, marks = frames(spark, rows + more + rows[:20], labels + [(3, 0), (None, 1), (99_999, 1), (4, None)])
    got = toxicity.classify(docs, marks).collect()
    assert len(got) == len(rows) + len(more) + 20
    of = {r["doc_id"]: r for r in got}
    held = [(of[i]["predicted"], y) for i, y in labels if zlib.crc32(str(i).encode()) % 5 == 0]
    assert all(of[i]["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i, _ in labels)
    assert sum(a == b for a, b in held) >= 0.97 * len(held)
    assert [of[i]["predicted"] for i in range(10_000, 10_010)] == [0, 0, 0, 1, 1, 1, 1, 0, 1, 0]
    assert of[10_000]["score"] == of[10_001]["score"] == of[10_002]["score"] == 0.0 and all(0 <= r["score"] <= 1 for r in got)
    assert of[None]["predicted"] == 1 and not of[None]["held_out"] and of[10_008]["toxic_sentences"] == 1
    assert len({r["score"] for r in got if r["doc_id"] == 5}) == 1


def test_one_class_and_no_labels(spark):
    rows, _ = corpus(40, 6)
    rows.append((100, ""))
    for labels, score in (([], 0.0), ([(i, 0) for i in range(40)], 0.0), ([(i, 1) for i in range(40)], 1.0)):
        got = toxicity.classify(*frames(spark, rows, labels)).collect()
        assert {r["score"] for r in got if r["doc_id"] < 100} == {score} and [r["score"] for r in got if r["doc_id"] == 100] == [0.0]
    assert toxicity.classify(*frames(spark, [], [])).collect() == []
