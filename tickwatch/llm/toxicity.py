"""Toxicity: a support vector machine on a gappy subsequence string kernel with Nystrom landmarks.

A text is cut into sentences and these into segments: words without their punctuation, runs of
single characters joined, overlapping windows of very long words, and neighbours of which one is
short joined to one (two, or three short ones), as an insult may be split by spaces. The kernel of two segments
counts the character triples that both hold in order, each occurrence weighted by ``decay`` for
every character skipped (at most ``gap`` between two of the triple), scaled to 1 for equal
segments. So "id-iot", "i d i o t" and "idxiot" stay close to "idiot". Landmarks are segments of
the training sentences; the Nystrom map of the kernel to them feeds a linear machine with squared
hinge loss. As that machine is linear in the kernel's triples, it folds into one weight a triple,
and scoring is a sparse dot product.

Labels are of texts: every sentence of a clean text is a negative example, and of a toxic one at
least one sentence is positive, by its strongest segment (multiple-instance learning; segments
that are far commoner in toxic texts count as positive from the start). Joined neighbours are
learned as negatives only, so that a word beside an insult doesn't become one. A sentence scores as
its strongest segment, a text as its strongest sentence, mapped to 0..1 by a logistic curve fitted on
the training texts. Null and empty texts and texts without a segment of three
characters score as the weakest text. Rows are scored one by one, so repeated rows, null ids and
other columns pass through (columns named like the outputs are replaced).
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwatch.llm.common import (Numbering, csr_rows, flat_words, hash64, held_out, mix64, passed_on, ranges,
                                  text_slices)
from tickwatch.llm.quality import labelled_sample

NOT_ALNUM = re.compile(r"[\W_]+")
SENTENCE_END = (".", "!", "?")
NONE = -2.0  # margin of a text without any segment


@dataclass(frozen=True)
class ToxicityParams:
    decay: float = 0.5
    gap: int = 2
    window: int = 24  # longer words are cut into windows of this size, half overlapping
    short: int = 3  # most letters of a word that is joined with its neighbours
    joined: int = 12  # most letters of neighbours that are joined
    landmarks: int = 192
    negatives: int = 3000
    cost: float = 100.0
    rounds: int = 3
    sample_rows: int = 6000  # most labelled rows that are learned from
    sample_chars: int = 64_000_000  # most characters of theirs
    least_excess: float = 8.0  # standard errors by which a first witness must be commoner in toxic texts
    seed: int = 7


def symbols(segments: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Characters as numbers below 64 (letters and digits apart, others folded), and lengths."""
    lengths = np.fromiter(map(len, segments), np.int64, len(segments))
    cp = np.frombuffer("".join(segments).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    c = np.where((cp >= 97) & (cp <= 122), cp - 97, np.where((cp >= 48) & (cp <= 57), cp - 22, 36 + cp % 28))
    return c, lengths


def triples(segments: list[str], p: ToxicityParams) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Segment numbers, triples and weights, each segment scaled to length one; segments in order."""
    c, lengths = symbols(segments)
    owner = csr_rows(lengths)
    bits = (2 * p.gap).bit_length()  # for the characters skipped: sorting one number an occurrence needs no second array
    found = []
    for j in range(1, p.gap + 2):
        for k in range(j + 1, j + p.gap + 2):
            n = max(len(c) - k, 0)
            code = c[:n] << 12 | c[j:j + n] << 6 | c[k:k + n]
            found.append(((owner[:n] << 18 | code) << bits | k - 2)[owner[:n] == owner[k:k + n]])
    every = np.sort(np.concatenate(found))
    key = every >> bits
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.empty(0, np.int64)
    value = (p.decay ** np.arange(1 << bits))[every & (1 << bits) - 1]
    x = np.add.reduceat(value, first) if len(key) else value
    row, code = key[first] >> 18, key[first] & 0x3FFFF
    norm = np.sqrt(np.bincount(row, x * x, minlength=len(segments)))
    return row, code, x / norm[row]


class Segments:
    """The segments of words, of runs of single characters, and of short words joined with their neighbours."""

    def __init__(self, p: ToxicityParams):
        self.p = p
        self.words, self.segments = Numbering(), Numbering()
        self.flat, self.starts, self.lengths = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
        self.single, self.ends = np.empty(0, bool), np.empty(0, bool)
        self.plain: list[str] = []  # each word without its punctuation
        self.size = np.empty(0, np.int64)

    def cut(self, word: str) -> list[int]:
        if len(word) < 3:
            return []
        size = self.p.window
        if len(word) <= size:
            return [self.segments[word]]
        return [self.segments[word[max(0, min(a, len(word) - size)):][:size]] for a in range(0, len(word) - size // 2, size // 2)]

    def neighbours(self, ids: np.ndarray, sentence: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places and segments of two neighbours in a sentence of which one is short, and of three short ones."""
        size, short = self.size[ids], self.p.short
        some = size > 0
        small = some & (size <= short)
        beside = sentence[1:] == sentence[:-1]
        both = size[1:] + size[:-1]
        two = np.flatnonzero(beside & some[1:] & some[:-1] & (small[1:] | small[:-1]) & (both > short) & (both <= self.p.joined))
        three = np.flatnonzero(beside[1:] & beside[:-1] & small[2:] & small[1:-1] & small[:-2] & (both[1:] + size[:-2] > short))
        letters = lambda numbers: [self.plain[i] for i in numbers.tolist()]

        def pairs(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            """Distinct pairs of numbers, and the pair of each place."""
            each, at = np.unique(left << 31 | right, return_inverse=True)
            return each >> 31, each & (1 << 31) - 1, at

        a, b, at_two = pairs(ids[two], ids[two + 1])
        joined = self.segments.of(list(map("".join, zip(letters(a), letters(b)))))
        a, b, at_three = pairs(ids[three], ids[three + 1])
        ab, c, at_three = pairs(at_three, ids[three + 2])
        longer = self.segments.of(list(map("".join, zip(letters(a[ab]), letters(b[ab]), letters(c)))))
        return np.concatenate([two, three]), np.concatenate([joined[at_two], longer[at_three]])

    def of(self, texts: list[str], neighbours: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Text numbers, sentence numbers (all texts counted on) and segment numbers."""
        known = len(self.words)
        words, counts = flat_words([t.lower() for t in texts])
        ids = self.words.of(words)
        new = list(self.words)[known:]
        if new:
            plain = [w if w.isalnum() else NOT_ALNUM.sub("", w) for w in new]
            cut = [self.cut(w) for w in plain]
            lengths = np.fromiter(map(len, cut), np.int64, len(cut))
            self.starts = np.concatenate([self.starts, len(self.flat) + np.cumsum(lengths) - lengths])
            self.lengths = np.concatenate([self.lengths, lengths])
            self.flat = np.concatenate([self.flat, np.fromiter((s for x in cut for s in x), np.int64, int(lengths.sum()))])
            self.single = np.concatenate([self.single, np.fromiter((len(w) == 1 for w in new), bool, len(new))])
            self.ends = np.concatenate([self.ends, np.fromiter((w.endswith(SENTENCE_END) for w in new), bool, len(new))])
            self.plain += plain
            self.size = np.concatenate([self.size, np.fromiter(map(len, plain), np.int64, len(new))])
        row = csr_rows(counts)
        first = np.ones(len(row), bool)
        first[1:] = row[1:] != row[:-1]
        opens = first.copy()
        opens[1:] |= self.ends[ids][:-1]
        sentence = np.cumsum(opens) - 1
        n = self.lengths[ids]
        rows, sentences, segments = np.repeat(row, n), np.repeat(sentence, n), self.flat[ranges(self.starts[ids], n)]
        single = self.single[ids]
        if single.any():
            edge = np.flatnonzero(np.diff(np.concatenate([[False], single, [False]])) | np.concatenate([first, [True]]))
            spelled = [(a, b) for a, b in zip(edge, edge[1:]) if single[a] and b - a >= 3]
            cuts = [self.cut(NOT_ALNUM.sub("", "".join(words[a:b]))) for a, b in spelled]
            more = np.fromiter((s for x in cuts for s in x), np.int64)
            at = np.repeat(np.array([a for a, _ in spelled], np.int64), [len(x) for x in cuts]) if spelled else np.empty(0, np.int64)
            rows, sentences, segments = (np.concatenate(x) for x in ((rows, row[at]), (sentences, sentence[at]), (segments, more)))
        if neighbours and len(ids) > 2:
            at, more = self.neighbours(ids, sentence)
            rows, sentences, segments = (np.concatenate(x) for x in ((rows, row[at]), (sentences, sentence[at]), (segments, more)))
        return rows, sentences, segments


@dataclass(frozen=True)
class ToxicityModel:
    weights: np.ndarray  # of each triple
    intercept: float
    slope: float
    offset: float

    def margins(self, segments: list[str], p: ToxicityParams) -> np.ndarray:
        out = np.full(len(segments), self.intercept)
        for at in range(0, len(segments), 20_000):
            row, code, x = triples(segments[at:at + 20_000], p)
            part = out[at:at + 20_000]
            part += np.bincount(row, self.weights[code] * x, minlength=len(part))
        return out

    def probability(self, margin: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.offset, -35, 35)))


def dense(segments: list[str], p: ToxicityParams, folded: np.ndarray) -> np.ndarray:
    """Kernel values of segments (rows) and landmarks, whose triples are the rows of ``folded``."""
    out = np.zeros((len(segments), len(folded)))
    for at in range(0, len(segments), 2000):
        row, code, x = triples(segments[at:at + 2000], p)
        for m in range(len(folded)):
            out[at:at + 2000, m] = np.bincount(row, folded[m, code] * x, minlength=len(segments[at:at + 2000]))
    return out


def squared_hinge(z: np.ndarray, y: np.ndarray, weight: np.ndarray, cost: float) -> np.ndarray:
    """Linear machine with squared hinge loss, by finite Newton steps; the last column of z is the intercept's."""
    w = np.zeros(z.shape[1])
    ridge = np.eye(z.shape[1])
    ridge[-1, -1] = 1e-3
    for _ in range(30):
        active = y * (z @ w) < 1
        a = z[active] * weight[active, None]
        new = np.linalg.solve(ridge / cost + a.T @ z[active], a.T @ y[active])
        if np.allclose(new, w, atol=1e-9):
            break
        w = new
    return w


def distinct_texts(texts: list[str]) -> list[int]:
    """The first of the texts whose longer words agree in two minimum hashes: copies speak once."""
    kept = {}
    for i, text in enumerate(texts):
        h = hash64([w for w in dict.fromkeys(text.split()) if len(w) >= 7] or [text])
        kept.setdefault((int(h.min()), int(mix64(h).min())), i)
    return sorted(kept.values())


def train(texts: list[str], labels: np.ndarray, p: ToxicityParams) -> ToxicityModel:
    rng = np.random.default_rng(p.seed)
    once = distinct_texts(texts)
    texts, labels = [texts[i] for i in once], labels[once]
    cut = Segments(p)

    def held(neighbours: bool) -> np.ndarray:
        """Distinct pairs of a text and a segment."""
        pairs = [np.empty((2, 0), np.int64)]
        for at in range(0, len(texts), 256):
            row, _, segment = cut.of(texts[at:at + 256], neighbours)
            key = np.unique((row + at) << 40 | segment)
            pairs.append(np.stack([key >> 40, key & (1 << 40) - 1]))
        return np.concatenate(pairs, axis=1)

    doc, segment = held(neighbours=False)
    every_doc, every_segment = held(neighbours=True)
    names = np.array(list(cut.segments) or [""], dtype=object)
    toxic = labels[doc] > 0.5 if len(doc) else np.empty(0, bool)
    n_toxic = int((labels > 0.5).sum())
    inside = np.bincount(segment[toxic], minlength=len(names))
    outside = np.bincount(segment[~toxic], minlength=len(names))
    expected = (inside + outside) * n_toxic / max(len(labels), 1)
    excess = (inside - expected) / np.sqrt(expected + 1)
    if not (excess > p.least_excess).any() or n_toxic == len(labels):
        return ToxicityModel(np.zeros(1 << 18), -1.0, 1.0, float(np.log((n_toxic + 1) / (len(labels) - n_toxic + 1))))
    clean = np.flatnonzero(outside > 0)
    in_clean = np.unique(every_segment[labels[every_doc] <= 0.5])  # joined neighbours too

    def witnesses(strength: np.ndarray, least: float) -> np.ndarray:
        """The strongest segment of each toxic text, where it is strong at all; with repeats."""
        order = np.lexsort((segment[toxic], -strength[segment[toxic]], doc[toxic]))
        d, s = doc[toxic][order], segment[toxic][order]
        top = s[np.append(True, d[1:] != d[:-1])] if len(d) else s
        return top[strength[top] > least]

    strongest = np.argsort(-excess, kind="stable")
    seeds = strongest[excess[strongest] > p.least_excess][:p.landmarks // 2]

    def mapping(others: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Triples of the landmarks, and the inverse square root of their kernel."""
        landmarks = list(dict.fromkeys([*names[seeds], *names[others]]))
        row, code, x = triples(landmarks, p)
        folded = np.zeros((len(landmarks), 1 << 18), np.float32)
        folded[row, code] = x
        value, vector = np.linalg.eigh((folded @ folded.T).astype(float))
        return folded, vector / np.sqrt(np.maximum(value, 1e-4)) @ vector.T

    folded, root = mapping(rng.choice(clean, min(len(clean), p.landmarks - len(seeds)), replace=False))
    sure = np.flatnonzero((excess > p.least_excess) & (outside * 20 < inside))
    chosen = witnesses(excess, p.least_excess)
    hard = rng.choice(clean, min(len(clean), p.negatives), replace=False)
    margin = excess
    for _ in range(p.rounds):
        kinds, times = np.unique(np.concatenate([chosen, np.repeat(sure, inside[sure])]), return_counts=True)
        positives = list(names[kinds])
        varied = [(s[:i] + chr(97 + int(rng.integers(26))) + s[i:], t) for s, t in zip(positives, times) for i in range(1, len(s))]
        negatives = [s for s in dict.fromkeys(names[hard]) if s not in set(positives)]
        every = positives + [s for s, _ in varied] + negatives
        y = np.repeat([1.0, -1.0], [len(positives) + len(varied), len(negatives)])
        weight = np.concatenate([times.astype(float), [t / max(len(s), 1) for s, t in varied], np.ones(len(negatives))])
        weight[y > 0] *= len(negatives) / max(weight[y > 0].sum(), 1e-9)
        z = np.hstack([dense(every, p, folded) @ root, np.ones((len(every), 1))])
        w = squared_hinge(z, y, weight, p.cost)
        model = ToxicityModel((root @ w[:-1]) @ folded, float(w[-1]), 1.0, 0.0)
        margin = model.margins(list(names), p)
        found = witnesses(margin, 1.0)
        chosen = found if len(found) else chosen
        worst = in_clean[np.argsort(-margin[in_clean], kind="stable")][:2000]  # the clean segments that look most toxic
        hard = np.unique(np.concatenate([hard, worst]))
        if len(seeds) < p.landmarks:  # the next landmarks are half the hardest clean segments, half any
            some = (p.landmarks - len(seeds)) // 2
            folded, root = mapping(np.concatenate([worst[:some], rng.choice(clean, min(len(clean), some), replace=False)]))

    top = np.full(len(texts), NONE)
    np.maximum.at(top, every_doc, np.maximum(margin[every_segment], NONE))
    # the curve also sees each sure insult alone and with a character put in, as a text of its own
    alone = model.margins(list(names[sure]) + [s for s, _ in varied], p)
    slope, offset = logistic(np.concatenate([top, alone]), np.concatenate([labels, np.ones(len(alone))]))
    return ToxicityModel(model.weights, model.intercept, slope, offset)


def logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic curve of y over x, by Newton steps with a weak prior."""
    design, b = np.stack([x, np.ones_like(x)], 1), np.zeros(2)
    for _ in range(50):
        prob = 1 / (1 + np.exp(-np.clip(design @ b, -35, 35)))
        h = design.T @ (design * (prob * (1 - prob) + 1e-6)[:, None]) + 1e-3 * np.eye(2)
        step = np.linalg.solve(h, design.T @ (y - prob) - 1e-3 * b)
        b = b + step
        if np.abs(step).max() < 1e-9:
            break
    return float(b[0]), float(b[1])


def fit(sample: DataFrame, p: ToxicityParams = ToxicityParams()) -> ToxicityModel:
    """The model, learned in one task from a bounded sample (rank, doc_id, text, y)."""
    def in_one_task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = pd.concat([b[["rank", "doc_id", "text", "y"]] for b in batches] or [pd.DataFrame({"rank": [], "doc_id": [], "text": [], "y": []})])
        rows = rows.sort_values(["rank", "doc_id", "text"])
        m = train(rows["text"].tolist(), rows["y"].to_numpy(float), p)
        yield pd.DataFrame({"w": [m.weights.astype(np.float32).tobytes()], "b": [m.intercept], "slope": [m.slope], "at": [m.offset]})

    row = sample.repartition(1).mapInPandas(in_one_task, "w binary, b double, slope double, at double").collect()
    if not row:
        return train([], np.empty(0), p)
    return ToxicityModel(np.frombuffer(row[0].w, np.float32).astype(float), row[0].b, row[0].slope, row[0]["at"])


def score(docs: DataFrame, model: ToxicityModel, p: ToxicityParams = ToxicityParams()) -> DataFrame:
    """The columns of ``docs`` but ``text``, and score, predicted and the number of toxic sentences."""
    handle = docs.sparkSession.sparkContext.broadcast(model)
    keep = [c for c in docs.columns if c not in ("text", "score", "predicted", "n_toxic_sentences")]

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = handle.value
        cut, margin = Segments(p), np.empty(0)
        for batch in batches:
            top, hits = np.full(batch.num_rows, NONE), np.zeros(batch.num_rows, np.int64)
            for start, texts in text_slices(batch):
                if len(cut.words) > 400_000 or len(cut.segments) > 600_000:
                    cut, margin = Segments(p), np.empty(0)
                row, sentence, segment = cut.of(texts)
                margin = np.concatenate([margin, m.margins(list(cut.segments)[len(margin):], p)])
                value = np.maximum(margin[segment], NONE)
                np.maximum.at(top, row + start, value)
                bad = m.probability(value) >= 0.5
                once = np.unique(sentence[bad], return_index=True)[1]
                np.add.at(hits, row[bad][once] + start, 1)
            prob = m.probability(top)
            yield passed_on(batch.select(keep), {"score": pa.array(prob), "predicted": pa.array((prob >= 0.5).astype(np.int32)),
                                                 "n_toxic_sentences": pa.array(hits)})

    source = docs.select(*keep, "text")
    schema = source.drop("text").withColumns({"score": F.lit(0.0), "predicted": F.lit(0), "n_toxic_sentences": F.lit(0).cast("long")}).schema
    return source.mapInArrow(scored, schema)


def toxicity_scores(docs: DataFrame, labels: DataFrame, p: ToxicityParams = ToxicityParams()) -> DataFrame:
    """Fits on the labelled rows that are not held out (crc32 of the id mod 5 is 0) and scores every row."""
    learn = lambda c: ~held_out(c, 5, 0)
    return score(docs, fit(labelled_sample(docs, labels, "toxic", learn, p.sample_rows, p.sample_chars), p), p)
