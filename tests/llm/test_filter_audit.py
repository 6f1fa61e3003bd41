"""The filter audit against plain Python, with null languages and ids, repeats, several labels and ranges that are cut."""

import random
import re
from itertools import permutations

import numpy as np

from weftgraph.llm import filter_audit

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCUMENTS = "doc_id long, text string, lang string, part string, n int, same string, good boolean"


def brute(rows, labels):
    first = {}
    for i, t, _ in rows:
        if i is not None:
            first[t or ""] = min(first.get(t or "", i), i)
    says = lambda i, k: i is not None and any(j == i and (q, x)[k] == 1 for j, q, x in labels)
    judged = []
    for i, t, lang in rows:
        t = t or ""
        w = WORD.findall(t)
        fails = {
            "A": len(w) < 100,
            "B": 100 * len(set(w)) < 80 * len(w),
            "C": 100 * len(re.findall("[A-Z]", t)) > 10 * len(t),
            "D": bool(re.search("[#$%&*|]", t)),
            "E": i is not None and t in first and i > first[t],
        }
        judged.append((lang or "", fails, says(i, 0), says(i, 1)))
    out = []
    for part in {j[0] for j in judged}:
        docs = [j[1:] for j in judged if j[0] == part]
        shapley, lines = dict.fromkeys("ABCDE", 0), []
        for order in permutations("ABCDE"):
            left = docs
            for k, f in enumerate(order):
                gone = [d for d in left if d[0][f]]
                left = [d for d in left if not d[0][f]]
                shapley[f] += len(gone)
                fail = sum(d[0][f] for d in docs)
                alone = sum(d[0][f] and sum(d[0].values()) == 1 for d in docs)
                lines.append((f, [part, "".join(order), k + 1, len(left), len(gone), fail - len(gone), alone, sum(d[1] for d in gone), sum(d[2] for d in gone)]))
        out += [tuple(line + [shapley[f]]) for f, line in lines]
    return sorted(out)


def audit(spark, rows, labels):
    docs = spark.createDataFrame([(*r, "p", 1, "s", True) for r in rows], DOCUMENTS).repartition(3)
    labels = spark.createDataFrame([(*x, "t") for x in labels], "doc_id long, quality int, toxic int, text string")
    columns = "part filter_order step kept removed redundant unique_fails good_lost toxic_lost shapley".split()
    return sorted(tuple(r) for r in filter_audit.audit(docs, labels).select(*columns).collect())


def test_against_brute_force(spark, monkeypatch):
    rng = random.Random(6)
    word = lambda: rng.choice("abcdefghij") * rng.randint(1, 3) if rng.random() < 0.4 else "".join(rng.choices("abcdeXYé日", k=6))
    texts = [" ".join(word() for _ in range(rng.choice((3, 80, 99, 100, 101, 140)))) + rng.choice(("", "", " #", " x|y")) for _ in range(120)]
    texts += ["", " \n\t", "ABC " * 150, "a " * 5000, "é" * 3000]
    rows = [(i, rng.choice(texts + [None]), rng.choice(("en", "en", "de", None, ""))) for i in range(400)]
    rows += [(5, texts[0], "en"), (5, texts[0], "en"), (None, texts[0], "en"), (None, None, None), (None, "only here", "fr")]
    labels = [(i, rng.choice((0, 1, None)), rng.choice((0, 1, None))) for i in range(0, 420, 2)] + [(4, 1, 0), (4, 0, 1), (None, 1, 1)]
    monkeypatch.setattr(filter_audit, "RANGE", 37)
    assert audit(spark, rows, labels) == brute(rows, labels)


def test_empty_tables(spark):
    assert audit(spark, [], []) == []
    assert audit(spark, [(1, None, None)], []) == brute([(1, None, None)], [])


def test_merges_are_those_of_sets():
    rng = np.random.default_rng(1)
    for sizes in ((0, 5), (5, 0), (3, 900), (900, 3), (50, 50), (0, 0)):
        a, b = (np.sort(rng.choice(1000, n, replace=False)) for n in sizes)
        assert filter_audit.within(a, b).tolist() == [x in set(b.tolist()) for x in a.tolist()]
        assert filter_audit.union(a, b).tolist() == sorted({*a.tolist(), *b.tolist()})
