"""Secrets: fixed patterns, and strings that a Markov model of random characters explains best.

Two first-order character models are trained from labelled samples, one on random strings, one
on ordinary identifiers. A run of identifier characters, less what the patterns find in it, is cut
at ``/``, ``=``, ``_`` and ``-`` into pieces, and these are told apart as random and ordinary stretches
by the log-likelihood ratio a character over the threshold, at a cost for each change inside the
run. Stretches of enough random characters are reported as ``random``: a key at the end of a path
without the path, and what follows a pattern's finding in the same run.

The samples come from a bounded number of documents: values that the patterns find
(and generated strings over the usual key alphabets) are random, all other runs and their joins
as paths, with hyphens, in snake and camel case are ordinary. A repeated id is learned from once.

Null and empty texts have no spans. Rows are handled one by one, so repeated rows, null ids and
other columns pass through (a column named like the output is replaced). Places are code points,
ends exclusive.
"""

from __future__ import annotations

import random
import re
import string
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwatch.llm.common import passed_on, sampled_texts, text_slices

#: The kinds, in their order, with their patterns and least lengths.
BASE = ("assign", "access", "hex")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
KEYWORDS = ("password", "passwd", "secret", "token", "api")

PIECE = re.compile(r"[A-Za-z0-9+]+")
SYMBOLS = string.ascii_letters + string.digits + "+/_=-"
CODE = np.full(128, len(SYMBOLS), np.int64)
CODE[[ord(c) for c in SYMBOLS]] = np.arange(len(SYMBOLS))
START = len(SYMBOLS)

SPANS = "array<struct<kind:string,start:int,end:int>>"
SPANS_ARROW = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))


@dataclass(frozen=True)
class SecretParams:
    least_chars: int = 16
    threshold: float = 0.6  # log-likelihood ratio a character, in nats
    change: float = 6.0  # what a change between ordinary and random inside a run costs, in nats
    sample_docs: int = 2000  # most documents that the models are trained on
    sample_chars: int = 16_000_000  # most characters of theirs
    generated: int = 4000  # generated random strings in the sample
    seed: int = 11

    @property
    def run(self) -> re.Pattern:
        return re.compile(rf"[A-Za-z0-9+/_=-]{{{self.least_chars},}}")


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    """(start, order of kind, end, kind) of what the fixed patterns find."""
    found = []
    lower = text.lower()
    if any(k in lower for k in KEYWORDS) or not text.isascii():
        found += [(m.start(), 0, m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    return found + [(m.start(), 2, m.end(), "hex") for m in HEX.finditer(text)]


def free_runs(text: str, base: list[tuple[int, int, int, str]], run: re.Pattern) -> list[tuple[int, int]]:
    """Runs of identifier characters that overlap no finding of the patterns."""
    runs = [(m.start(), m.end()) for m in run.finditer(text)]
    return [r for r in runs if not any(b[0] < r[1] and r[0] < b[2] for b in base)] if base else runs


def free_parts(text: str, base: list[tuple[int, int, int, str]], p: SecretParams) -> list[tuple[int, int]]:
    """The stretches of runs that no finding of the patterns covers, where they are long enough."""
    out, at = [], 0
    base = sorted(base)
    for m in p.run.finditer(text):
        start = m.start()
        while at < len(base) and base[at][0] < m.end():
            out.append((start, base[at][0]))
            start = max(start, base[at][2])
            if start > m.end():
                break  # it also covers a part of the next run
            at += 1
        out.append((start, m.end()))
    return [(a, b) for a, b in out if b - a >= p.least_chars]


def transitions(samples: list[str]) -> np.ndarray:
    """Log-probabilities of a character after another (or at the start), add-half smoothed."""
    n = np.full((len(SYMBOLS) + 1, len(SYMBOLS)), 0.5)
    for s in samples:
        c = CODE[np.frombuffer(s.encode(), np.uint8)]
        np.add.at(n, (np.append(START, c[:-1]), c), 1)
    return np.log(n / n.sum(1, keepdims=True))


def train(texts: list[str], p: SecretParams) -> np.ndarray:
    """Log-likelihood ratios of each transition: random minus ordinary."""
    rng = random.Random(p.seed)
    keys, ordinary = [], []
    words = re.compile(r"[A-Za-z0-9+/_=-]+")
    for text in texts:
        base = base_spans(text)
        for start, _, end, kind in base:
            value = ASSIGN.fullmatch(text[start:end])[2] if kind == "assign" else text[start:end]
            if value.count(".") == 0:
                keys.append(value)
        ordinary += [text[a:b] for a, b in free_runs(text, base, words) if not text[a:b].isdigit()]
    for _ in range(len(ordinary) // 10):
        parts = rng.choices(ordinary, k=rng.randint(2, 4))
        joint = rng.choice(("_", "/", "-", ""))
        ordinary.append(joint.join(parts) if joint else "".join(x.capitalize() for x in parts))
    alphabets = (string.hexdigits[:16], string.ascii_letters + string.digits, string.ascii_uppercase + string.digits,
                 string.ascii_lowercase + string.digits, string.ascii_letters + string.digits + "+/", string.ascii_letters + string.digits + "-_")
    keys += ["".join(rng.choices(alphabets[i % len(alphabets)], k=rng.randint(p.least_chars, 64))) for i in range(p.generated)]
    return transitions(keys) - transitions(ordinary)


def ratios_of(runs: list[str], ratios: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The log-likelihood ratio of each character of the runs, all in one array, and where each run starts."""
    lengths = np.fromiter(map(len, runs), np.int64, len(runs))
    c = CODE[np.frombuffer("".join(runs).encode(), np.uint8)]
    before = np.roll(c, 1)
    starts = np.cumsum(lengths) - lengths
    before[starts] = START
    return ratios[before, c], starts


def ratio(runs: list[str], ratios: np.ndarray) -> np.ndarray:
    """Log-likelihood ratio a character of each run; runs of digits only count as no secret."""
    if not runs:
        return np.empty(0)
    each, starts = ratios_of(runs, ratios)
    out = np.add.reduceat(each, starts) / np.diff(np.append(starts, len(each)))
    digits = np.fromiter(map(str.isdigit, runs), bool, len(runs))
    return np.where(digits, -np.inf, out)


def stretches(run: str, over: np.ndarray, p: SecretParams) -> list[tuple[int, int]]:
    """The random stretches of a run; ``over`` is each character's ratio less the threshold.

    The best of all ways to call the pieces random or ordinary: random ones add up what they are over
    the threshold, each change inside the run costs ``change``. In linear time, piece by piece.
    """
    pieces = [(m.start(), m.end()) for m in PIECE.finditer(run)]
    total = np.concatenate([[0.0], np.cumsum(over)])
    ordinary, randomly, came = 0.0, 0.0, []
    for i, (start, end) in enumerate(pieces):
        # a stretch that goes on pays for the separators before the piece, one that begins doesn't
        on = randomly + (total[end] - total[pieces[i - 1][1]] if i else total[end] - total[start])
        new = ordinary + total[end] - total[start] - (p.change if i else 0.0)
        leave = randomly - p.change if i else -np.inf
        came.append((new > on, leave > ordinary))
        ordinary, randomly = max(ordinary, leave), max(on, new)
    out, state = [], randomly >= ordinary
    for i in range(len(pieces) - 1, -1, -1):
        if state:
            if not out or out[-1][0] != i + 1:
                out.append([i, i])
            out[-1][0] = i
            state = not came[i][0]
        else:
            state = came[i][1]
    found = []
    for first, last in reversed(out):
        a, b = pieces[first][0], pieces[last][1]
        if total[b] >= total[a] and not run[a:b].isdigit():
            b = b if run[b:].strip("=") else len(run)  # padding belongs to the key
            found.append((a, b))
    return [(a, b) for a, b in found if b - a >= p.least_chars]


def find(texts: list[str], ratios: np.ndarray, p: SecretParams) -> list[list[tuple[int, int, int, str]]]:
    """All spans of each text, by start, then kind."""
    found = [base_spans(t) for t in texts]
    runs = [(i, *r) for i, t in enumerate(texts) for r in free_parts(t, found[i], p)]
    if runs:
        values = [texts[i][a:b] for i, a, b in runs]
        each, starts = ratios_of(values, ratios)
        for (i, a, b), value, over in zip(runs, values, np.split(each - p.threshold, starts[1:])):
            found[i] += [(a + x, len(BASE), a + y, "random") for x, y in stretches(value, over, p)]
    return [sorted(x) for x in found]


def fit(docs: DataFrame, p: SecretParams = SecretParams()) -> np.ndarray:
    """The models' log ratios, trained in one task on the documents whose ids hash lowest."""
    chosen = (docs.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.lit(1).alias("n"))
              .select("doc_id", F.xxhash64("doc_id", F.lit(23)).alias("rank")).orderBy("rank", "doc_id").limit(p.sample_docs))
    sample = sampled_texts(docs, chosen, p.sample_chars)

    def in_one_task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = pd.concat([b[["rank", "doc_id", "text"]] for b in batches] or [pd.DataFrame({"rank": [], "doc_id": [], "text": []})])
        texts = rows.sort_values(["rank", "doc_id", "text"])["text"].tolist()
        yield pd.DataFrame({"ratios": [train(texts, p).tobytes()]})

    rows = sample.select("rank", "doc_id", "text").repartition(1).mapInPandas(in_one_task, "ratios binary").collect()
    flat = np.frombuffer(rows[0]["ratios"]) if rows else train([], p).ravel()
    return flat.reshape(len(SYMBOLS) + 1, len(SYMBOLS))


def scan(docs: DataFrame, ratios: np.ndarray, p: SecretParams = SecretParams(), redacted: str | None = None) -> DataFrame:
    """The columns of ``docs`` but ``text``, and ``spans``; with ``redacted`` the text too, spans replaced by it."""
    keep = [c for c in docs.columns if c not in ("text", "spans")]
    handle = docs.sparkSession.sparkContext.broadcast(ratios)

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans, texts = [], []
            for _, part in text_slices(batch):
                found = find(part, handle.value, p)
                spans += [[{"kind": k, "start": a, "end": b} for a, _, b, k in x] for x in found]
                if redacted is not None:
                    texts += [replaced(t, x, redacted) if x else t for t, x in zip(part, found)]
            more = {"spans": pa.array(spans, SPANS_ARROW)}
            if redacted is not None:
                null = batch.column("text").is_null().to_pylist()
                more["text"] = pa.array([None if n else t for t, n in zip(texts, null)], pa.string())
            yield passed_on(batch.select(keep), more)

    source = docs.select(*keep, "text")
    schema = source.drop("text").withColumn("spans", F.lit(None).cast(SPANS))
    if redacted is not None:
        schema = schema.withColumn("text", F.lit(None).cast("string"))
    return source.mapInArrow(scanned, schema.schema)


def replaced(text: str, spans: list[tuple[int, int, int, str]], by: str) -> str:
    """The text with each stretch of overlapping spans replaced."""
    out, at = [], 0
    for start, _, end, _ in spans:
        if start >= at:
            out += [text[at:start], by]
        at = max(at, end)
    return "".join([*out, text[at:]])
