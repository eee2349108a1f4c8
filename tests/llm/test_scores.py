"""Quality and toxicity: held-out accuracy, and the string kernel against a plain sum over triples."""

import itertools
import math
import random
import re

import numpy as np
import pyarrow.parquet as pq
import pytest

from tickwatch.llm import quality, toxicity
from tickwatch.llm.common import hash64, mix64

SF = "/root/testdata/sf0.1"


def split(label):
    """Texts and labels of sf0.1 by parity of the id: even ids to learn from, odd ones to test."""
    docs = pq.read_table(f"{SF}/documents.parquet").select(["doc_id", "text"]).to_pandas()
    rows = docs.merge(pq.read_table(f"{SF}/labels.parquet").to_pandas(), on="doc_id").sort_values("doc_id")
    return [(part["text"].fillna("").tolist(), part[label].to_numpy(float)) for part in (rows[rows.doc_id % 2 == 0], rows[rows.doc_id % 2 == 1])]


@pytest.fixture(scope="module")
def toxic():
    (texts, y), test = split("toxic")
    p = toxicity.ToxicityParams()
    return p, toxicity.train(texts, y, p), test


def test_quality_accuracy():
    (texts, y), (test, truth) = split("quality")
    p = quality.QualityParams()
    w, b = quality.train(texts, y, p)
    row, slot, x = quality.Features(p.bits).of(test)
    z = b + np.bincount(row, w[slot] * x, minlength=len(test))
    assert ((1 / (1 + np.exp(-z)) >= p.threshold) == truth).mean() > 0.97


def plain_features(text, bits):
    """Slots and weights of one text by their definition, word by word."""
    mix = lambda x: int(mix64(np.array([x], np.uint64))[0])
    pieces = [int(hash64([p])[0]) for w in text.split() for p in re.findall(r"\w+|[^\w\s]+", w)]
    marked = [int(quality.REPEATED) if i and pieces[i] == pieces[i - 1] else x for i, x in enumerate(pieces)]
    count = {}
    for slot in [mix(x) >> (64 - bits) for x in marked] + [mix((a * 3 + b) % 2**64) >> (64 - bits) for a, b in zip(marked, marked[1:])]:
        count[slot] = count.get(slot, 0) + 1
    x = {s: math.log(1 + n) for s, n in count.items()}
    norm = math.sqrt(sum(v * v for v in x.values()))
    return {s: v / norm for s, v in x.items()}


def test_quality_by_definition(spark):
    """FTRL-proximal and the sparse dot product written out for single coordinates."""
    rng = random.Random(4)
    words = ["good", "fine", "text", "###", "a1&", "x x", "x"]
    texts = [" ".join(rng.choices(words, k=rng.randint(0, 12))) for _ in range(60)]
    labels = [float("good" in t) for t in texts]
    p = quality.QualityParams(epochs=2)
    z, n = {}, {}

    def weight(i):
        if abs(z.get(i, 0.0)) <= p.l1:
            return 0.0
        return -(z[i] - math.copysign(p.l1, z[i])) / ((p.beta + math.sqrt(n[i])) / p.alpha + p.l2)

    for _ in range(p.epochs):
        for t, y in zip(texts, labels):
            x = {**plain_features(t, p.bits), "b": 1.0}
            w = {i: weight(i) for i in x}
            slip = 1 / (1 + math.exp(-sum(w[i] * v for i, v in x.items()))) - y
            for i, v in x.items():
                g = slip * v
                sigma = (math.sqrt(n.get(i, 0.0) + g * g) - math.sqrt(n.get(i, 0.0))) / p.alpha
                z[i], n[i] = z.get(i, 0.0) + g - sigma * w[i], n.get(i, 0.0) + g * g
    model = quality.train(texts, np.array(labels), p)
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    for r in quality.score(docs, model, p).collect():
        margin = weight("b") + sum(weight(i) * v for i, v in plain_features(texts[r.doc_id], p.bits).items())
        assert r.score == pytest.approx(1 / (1 + math.exp(-margin)), abs=1e-6)
        assert r.predicted == int(r.score >= p.threshold)


def text_margin(model, p, texts):
    cut = toxicity.Segments(p)
    row, _, segment = cut.of(texts)
    top = np.full(len(texts), toxicity.NONE)
    np.maximum.at(top, row, model.margins(list(cut.segments), p)[segment])
    return top


def test_toxicity_accuracy(toxic):
    p, model, (texts, y) = toxic
    found = model.probability(text_margin(model, p, texts)) >= 0.5
    assert (found == y).mean() > 0.93  # one label in twenty is wrong here
    assert found[y == 0].mean() < 0.005


def test_gapped_and_inserted(toxic):
    p, model, _ = toxic
    words = ["idiot", "moron", "stupid", "pathetic", "disgusting"]
    altered = [f"the {a} of" for w in words for a in (w, w.upper() + "!", "-".join(w), " ".join(w), w[:2] + "." + w[2:], w[0] + w)]
    found = model.probability(text_margin(model, p, altered)) >= 0.5
    assert found.mean() > 0.9
    assert not (model.probability(text_margin(model, p, ["the thin ation of", "", "a b", "x" * 90_000])) >= 0.5).any()


def test_split_by_one_space(toxic):
    p, model, (clean, y) = toxic
    words = ["idiot", "moron", "stupid", "pathetic", "disgusting"]
    cut = [f"the {w[:i]} {w[i:]} of" for w in words for i in (2, 3)] + ["so stu pid of", "a mo r on here", "the dis gus ting one"]
    assert (model.probability(text_margin(model, p, cut)) >= 0.5).mean() > 0.85


def test_neighbours_by_definition():
    """Two neighbours with a short one, or three short ones, within a sentence, joined without punctuation."""
    p = toxicity.ToxicityParams()
    texts = ["he is, an extraordinary id iot. So on & of", "", "ab", "abcd efgh ijkl", "a b", "x" * 30 + " ab cd"]
    cut = toxicity.Segments(p)
    plain = cut.of(texts, neighbours=False)
    row, sentence, segment = cut.of(texts)
    names = list(cut.segments)
    joined = [(int(r), names[s]) for r, s in zip(row[len(plain[0]):], segment[len(plain[0]):])]
    assert sorted(joined) == sorted([(0, "heis"), (0, "isan"), (0, "idiot"), (0, "soon"),
                                     (0, "heisan"), (5, "abcd")])
    assert len(set(sentence[row == 0])) == 2


def test_kernel_is_a_sum_over_triples():
    p = toxicity.ToxicityParams()
    rng = random.Random(2)

    def features(s):
        out = {}
        for i, j, k in itertools.combinations(range(len(s)), 3):
            if j - i <= p.gap + 1 and k - j <= p.gap + 1:
                out[s[i] + s[j] + s[k]] = out.get(s[i] + s[j] + s[k], 0) + p.decay ** (k - i - 2)
        norm = sum(v * v for v in out.values()) ** 0.5
        return {u: v / norm for u, v in out.items()}

    words = ["".join(rng.choices("abcd", k=rng.randint(3, 9))) for _ in range(30)]
    row, code, x = toxicity.triples(words, p)
    dense = np.zeros((len(words), 1 << 18))
    dense[row, code] = x
    kernel = dense @ dense.T
    for a, b in itertools.product(range(30), repeat=2):
        fa, fb = features(words[a]), features(words[b])
        assert kernel[a, b] == pytest.approx(sum(v * fb.get(u, 0) for u, v in fa.items()))


@pytest.mark.parametrize("scores", [lambda d, y: quality.quality_scores(d, y), lambda d, y: toxicity.toxicity_scores(d, y)])
def test_odd_rows(spark, scores):
    rows = [(1, "ab cd " * 40, 0.5), (1, "ab cd " * 40, 0.5), (None, None, 1.0), (2, "", 1.0), (3, "x" * 50_000, 0.0), (4, "a an idiot", 0.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score double")
    labels = spark.createDataFrame([(1, 1, 0), (1, 1, 0), (None, 0, 1), (2, None, None), (4, 0, 1)], "doc_id long, quality int, toxic int")
    out = scores(docs, labels).collect()
    assert len(out) == 6 and all(0 <= r.score <= 1 and r.predicted in (0, 1) for r in out)
    assert len({r.score for r in out if r.doc_id == 1}) == 1
    assert scores(docs, labels.limit(0)).count() == 6
    assert scores(docs.limit(0), labels).count() == 0
