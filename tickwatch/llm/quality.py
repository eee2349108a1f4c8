"""Quality classifier: hashed word n-grams, logistic regression by FTRL-proximal, sparse dot products.

``fit`` learns from a bounded sample of labelled rows in one task; ``score`` scores every
text where it lies, with no shuffle. A null text is the empty text: it has no features, so its
score is that of the intercept. Rows whose label is null are not learned from; repeated rows are
scored each on their own; extra columns pass through ``score`` untouched unless they have the
name of an output column, which the output replaces.
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
                                  sampled_texts, text_slices)

#: A word is cut into runs of word characters and runs of other characters.
PIECES = re.compile(r"\w+|[^\w\s]+")
REPEATED = np.uint64(0x9E3779B97F4A7C15)  # stands for a piece equal to the one before it


@dataclass(frozen=True)
class QualityParams:
    bits: int = 18
    sample_rows: int = 8000  # most labelled rows that are learned from
    sample_chars: int = 64_000_000  # most characters of theirs
    epochs: int = 3
    alpha: float = 0.5
    beta: float = 1.0
    l1: float = 0.05
    l2: float = 0.1
    threshold: float = 0.7


class Features:
    """Hashed unigrams and bigrams of texts with weights log(1 + count), each text scaled to length one."""

    def __init__(self, bits: int, keep: int = 400_000):
        self.shift, self.keep = np.uint64(64 - bits), keep
        self._reset()

    def _reset(self):
        self.words, self.hashes, self.starts, self.lengths = Numbering(), np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)

    def _learn(self, known: int) -> None:
        new = list(self.words)[known:]
        if not new:
            return
        pieces = [PIECES.findall(w) for w in new]
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        hashes = hash64([p for ps in pieces for p in ps])
        starts = len(self.hashes) + np.cumsum(lengths) - lengths
        self.hashes, self.starts, self.lengths = (np.concatenate(x) for x in (
            (self.hashes, hashes), (self.starts, starts), (self.lengths, lengths)))

    def of(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rows, features and weights; rows are in order."""
        if len(self.words) > self.keep:
            self._reset()
        known = len(self.words)
        words, counts = flat_words(texts)
        ids = self.words.of(words)
        self._learn(known)
        piece = self.hashes[ranges(self.starts[ids], self.lengths[ids])]
        row = np.repeat(csr_rows(counts), self.lengths[ids])
        follows = np.zeros(len(piece), bool)
        follows[1:] = row[1:] == row[:-1]
        same = follows.copy()
        same[1:] &= piece[1:] == piece[:-1]
        piece = np.where(same, REPEATED, piece)
        before = np.roll(piece, 1)
        with np.errstate(over="ignore"):
            pairs = mix64(before[follows] * np.uint64(3) + piece[follows])
        slot = np.concatenate([mix64(piece) >> self.shift, pairs >> self.shift])
        bits = np.uint64(64) - self.shift
        key, n = np.unique(np.concatenate([row, row[follows]]).astype(np.uint64) << bits | slot, return_counts=True)
        row, slot, x = (key >> bits).astype(np.int64), (key & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64), np.log1p(n)
        norm = np.sqrt(np.bincount(row, x * x, minlength=len(texts)))
        return row, slot, x / norm[row]


def train(texts: list[str], labels: np.ndarray, p: QualityParams) -> tuple[np.ndarray, float]:
    """Weights and intercept, by FTRL-proximal updates (McMahan et al. 2013) in the given order."""
    size = 1 << p.bits
    z, n = np.zeros(size + 1), np.zeros(size + 1)
    features, samples = Features(p.bits), []
    for at in range(0, len(texts), 256):
        part = texts[at:at + 256]
        row, slot, x = features.of(part)
        cut = np.searchsorted(row, np.arange(len(part) + 1))
        samples += [(np.append(slot[a:b], size), np.append(x[a:b], 1.0)) for a, b in zip(cut, cut[1:])]

    def weights(i):
        zi = z[i]
        w = -(zi - np.sign(zi) * p.l1) / ((p.beta + np.sqrt(n[i])) / p.alpha + p.l2)
        return np.where(np.abs(zi) <= p.l1, 0.0, w)

    for _ in range(p.epochs):
        for (i, x), y in zip(samples, labels):
            w = weights(i)
            g = (1 / (1 + np.exp(-np.clip(w @ x, -35, 35))) - y) * x
            sigma = (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / p.alpha
            z[i] += g - sigma * w
            n[i] += g * g
    w = weights(np.arange(size + 1))
    return w[:size].astype(np.float32), float(w[size])


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, learn_from, rows: int, chars: int) -> DataFrame:
    """(rank, doc_id, text, y) of at most ``rows`` labelled ids, those that hash lowest, within ``chars`` characters.

    An id with conflicting labels has the largest of them, one with several texts is learned from once.
    """
    chosen = (labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & learn_from(F.col("doc_id")))
              .groupBy("doc_id").agg(F.max(label).cast("double").alias("y"))
              .withColumn("rank", F.xxhash64(F.col("doc_id"), F.lit(17)))
              .orderBy("rank", "doc_id").limit(rows))
    return sampled_texts(docs, chosen, chars).select("rank", "doc_id", "text", "y")


def fit(sample: DataFrame, p: QualityParams = QualityParams()) -> tuple[np.ndarray, float]:
    """The model: 2^bits weights and an intercept, learned in one task from a bounded sample."""
    def in_one_task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = pd.concat([b[["rank", "doc_id", "text", "y"]] for b in batches] or
                         [pd.DataFrame({"rank": [], "doc_id": [], "text": [], "y": []})])
        rows = rows.sort_values(["rank", "doc_id", "text"])
        w, b = train(rows["text"].tolist(), rows["y"].to_numpy(float), p)
        yield pd.DataFrame({"w": [w.tobytes()], "b": [b]})

    # every row goes to one task, so an empty sample yields a model too
    row = sample.repartition(1).mapInPandas(in_one_task, "w binary, b double").collect()
    if not row:
        return np.zeros(1 << p.bits, np.float32), 0.0
    return np.frombuffer(row[0]["w"], np.float32), row[0]["b"]


def score(docs: DataFrame, model: tuple[np.ndarray, float], p: QualityParams = QualityParams()) -> DataFrame:
    """The columns of ``docs`` but ``text``, and ``score`` (0 to 1), ``predicted`` (1 from the threshold on)."""
    handle = docs.sparkSession.sparkContext.broadcast(model)
    keep = [c for c in docs.columns if c not in ("score", "predicted", "text")]

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (w, b), features = handle.value, Features(p.bits)
        w = w.astype(np.float64)
        for batch in batches:
            out = np.full(batch.num_rows, b)
            for start, texts in text_slices(batch):
                row, slot, x = features.of(texts)
                out[start:start + len(texts)] += np.bincount(row, w[slot] * x, minlength=len(texts))
            prob = 1 / (1 + np.exp(-np.clip(out, -35, 35)))
            yield passed_on(batch.select(keep), {"score": pa.array(prob), "predicted": pa.array((prob >= p.threshold).astype(np.int32))})

    source = docs.select(*keep, "text")
    schema = source.drop("text").withColumns({"score": F.lit(0.0), "predicted": F.lit(0)}).schema
    return source.mapInArrow(scored, schema)


def quality_scores(docs: DataFrame, labels: DataFrame, p: QualityParams = QualityParams()) -> DataFrame:
    """Fits on the labelled rows that are not held out (crc32 of the id mod 4 is 2) and scores every row."""
    learn = lambda c: ~held_out(c, 4, 2)
    model = fit(labelled_sample(docs, labels, "quality", learn, p.sample_rows, p.sample_chars), p)
    return score(docs, model, p)
