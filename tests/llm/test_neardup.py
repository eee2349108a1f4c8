"""ProbMinHash classes against brute force over all pairs, and its parts against their definitions."""

import random
from collections import Counter

import numpy as np
import pytest

from tickwatch.llm import neardup as nd

P = nd.NearDupParams()


def shingles(text, n=5):
    words = (text or "").lower().split()
    return Counter([tuple(words[i:i + n]) for i in range(len(words) - n + 1)] or ([tuple(words)] if words else []))


def jp(x, y):
    return sum(1 / sum(max(x[v] / x[u], y[v] / y[u]) for v in x.keys() | y.keys()) for u in x.keys() & y.keys())


def brute_classes(rows):
    """class of each row: smallest id over chains of pairs with J_P of 0.8 or more."""
    weights = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    near = []
    for i in range(len(rows)):
        for j in range(i):
            if weights[i] and weights[j]:
                s = jp(weights[i], weights[j])
                near.append(s)
                if s >= P.threshold:
                    parent[find(i)] = find(j)
    ids = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            ids[find(i)] = min(doc_id, ids.get(find(i), doc_id))
    return [doc_id if not weights[i] else ids.get(find(i)) for i, (doc_id, _) in enumerate(rows)]


def corpus(seed, base=12, words=60):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    texts = []
    for _ in range(base):
        words_ = rng.choices(vocabulary, k=words)
        texts.append(" ".join(words_))
        for _ in range(rng.randint(0, 6)):
            copy = list(words_)
            for _ in range(rng.randint(0, 3)):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            texts.append(" ".join(copy))
    return texts


def test_similarity_by_definition():
    rng = random.Random(1)
    for _ in range(200):
        x, y = (Counter({i: rng.randint(1, 4) for i in rng.sample(range(12), rng.randint(1, 9))}) for _ in range(2))
        a, b = ((np.array(sorted(c), np.uint64), np.array([c[k] for k in sorted(c)])) for c in (x, y))
        assert nd.similarity(a, b) == pytest.approx(jp(x, y))


def test_registers_agree_as_often_as_the_similarity():
    rng = np.random.default_rng(3)
    for n in (1, 4, 40, 700):
        element = rng.integers(1, 1 << 62, 2 * n).astype(np.uint64)
        a, b = np.sort(element[:n + n // 4]), np.sort(element[n // 4:n + n // 2])
        wa, wb = rng.integers(1, 4, len(a)), rng.integers(1, 4, len(b))
        got = nd.prob_min_hash(np.repeat([0, 1], [len(a), len(b)]), np.concatenate([a, b]), np.concatenate([wa, wb]), 2, 4000)
        assert (got[0] == got[1]).mean() == pytest.approx(nd.similarity((a, wa), (b, wb)), abs=0.04)
        assert (got != 0).all()


@pytest.mark.parametrize("seed", [1, 2])
def test_classes(spark, seed):
    texts = corpus(seed) + [None, "", "  \n", "one two", "One  two", "one three", "a b c d e", "x " * 400, "x " * 800, "long " * 5000 + "end"]
    rows = [(None if i % 11 == 5 else (i * 7) % 101, t) for i, t in enumerate(texts)]
    rows += rows[:2]
    docs = spark.createDataFrame([(i, t, n, "k") for n, (i, t) in enumerate(rows)], "doc_id long, text string, place int, key string")
    got = {r.place: r.class_id for r in nd.near_duplicates(docs, P).collect()}
    assert [got[i] for i in range(len(rows))] == brute_classes(rows)


def test_a_large_group_in_blocks(spark, monkeypatch):
    """A chain of texts in which only neighbours are alike needs the comparison in blocks."""
    monkeypatch.setattr(nd, "BLOCK", 8)
    rng = random.Random(9)
    vocabulary = [f"v{i}" for i in range(500)]
    words = rng.choices(vocabulary, k=80)
    texts = []
    for i in range(60):
        words = list(words)
        words[(i * 5) % 80] = rng.choice(vocabulary)
        texts.append(" ".join(words))
    rows = [(i, t) for i, t in enumerate(texts)]
    got = {r.doc_id: r.class_id for r in nd.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), P).collect()}
    assert [got[i] for i in range(60)] == brute_classes(rows)


def test_no_rows(spark):
    assert nd.near_duplicates(spark.createDataFrame([], "doc_id long, text string"), P).count() == 0


def test_query(spark):
    from tickwatch.llm.queries import QUERIES
    d = "/root/testdata/sf0.001"
    got = {r.doc_id: r.class_id for r in QUERIES["op3_near_duplicates"](spark, d).collect()}
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{d}/documents.parquet").collect()]
    sets = [(i, set(shingles(t))) for i, t in rows]
    for i, a in sets:
        for j, b in sets:
            if i < j and a and len(a & b) >= 0.9 * len(a | b):
                assert got[i] == got[j]
    assert len(set(got.values())) > 0.7 * len(got)
