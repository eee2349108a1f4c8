"""Quality rules: n-gram perplexity bands by language.

``ngram_model`` is a character n-gram model with modified Kneser-Ney smoothing (Chen and Goodman
1999), counted by Spark over every text: words are counted by language first, their n-grams next,
so the tables grow with the corpus but stay far smaller than it. With ``running`` n-grams run over
the text, its words with one border between them: a word holds the n-grams behind its border, a
joint (the last characters before a border and the first behind it) those that cross one.

A character here is a UTF-16 code unit (characters beyond U+FFFF are two), so that four of them fill
a long without folding, and the border is the space, which no word holds: two n-grams never share an
entry. Probabilities of the n-grams met and back-off weights of the contexts are kept in arrays of
each language sorted by the n-gram's number and looked up by binary search.

``rules`` measures every text: plain word, symbol and repetition counts, and the mean negative
log-probability of its words' characters. For each language the quartiles over all texts give an
upper and a lower band; a text outside them, or one that fails the plain rules, is not kept.

Null and empty texts have no words and so fail the plain rules. A null language is a language of
its own. Rows are measured each on its own, so repeated rows, null ids and other columns pass
through (columns named like the outputs are replaced).
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickwatch.llm.common import Numbering, csr_rows, mix64, passed_on, text_slices, written

#: The characters that count as symbols, and the limits of the plain rules.
SYMBOLS = "#*$%&|<>"
LEAST_WORDS = 50
MOST_REPEATED_PERCENT = 50

BITS = 16  # of a UTF-16 code unit in an n-gram's number
NO_LANGUAGE = "\1none"
COLUMNS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "nll", "kept")


@dataclass(frozen=True)
class PerplexityParams:
    order: int = 4  # at most 4, so that an n-gram fits a long
    #: Quartile distances beyond the quartiles that are still within the bands: Tukey's inner fences, which
    #: normal scores leave in 0.7 % of cases; of the labelled good documents of sf0.1 they reject 1.0 %.
    reach: float = 1.5
    running: bool = True  # n-grams cross the words' borders; else each word stands alone
    bins: int = 64  # of one unit of log-probability, for the quartiles


def language(docs: DataFrame) -> Column:
    return F.coalesce("lang", F.lit(NO_LANGUAGE)) if "lang" in docs.columns else F.lit(NO_LANGUAGE)


class Edges:
    """What of each word meets its neighbours: the numbers of its last and of its first characters."""

    def __init__(self, p: PerplexityParams):
        self.width = p.order - 2
        self.tails, self.heads = Numbering({" " * self.width: 0}), Numbering()
        self.tail, self.head = np.empty(0, np.int64), np.empty(0, np.int64)

    def add(self, words: list[bytes]) -> None:
        texts = [w.decode() for w in words]
        self.tail = np.append(self.tail, self.tails.of([(" " + t)[-self.width:] for t in texts]))
        self.head = np.append(self.head, self.heads.of([(t + " ")[:self.width] for t in texts]))

    def joints(self, ids: np.ndarray) -> np.ndarray:
        """A text's joints, one before each word: before the first one there are only borders."""
        return np.append(0, self.tail[ids])[:len(ids)] << 32 | self.head[ids]

    def units(self, joints: list[int]) -> list[bytes]:
        tails, heads = list(self.tails), list(self.heads)
        return [f"{tails[j >> 32]} {heads[j & 0xffffffff]}".encode() for j in joints]


def word_counts(docs: DataFrame, p: PerplexityParams) -> DataFrame:
    """(lang, word, n) over all texts; joints, which hold a space, are words too."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, tuple[Numbering, Edges, list[np.ndarray], Counter]] = {}

        def out() -> Iterator[pa.RecordBatch]:
            for lang, (number, edges, counts, joints) in held.items():
                words = list(number) + edges.units(list(joints))
                n = np.append(counts[0], np.fromiter(joints.values(), np.int64, len(joints)))
                for at in range(0, len(words), 50_000):
                    part = words[at:at + 50_000]
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(part)), pa.array(part, pa.binary()).cast(pa.string()), pa.array(n[at:at + 50_000])],
                                                     ["lang", "word", "n"])
            held.clear()

        for batch in batches:
            langs = batch.column("lang").to_pylist()
            for start, texts in text_slices(batch):
                split: dict[str, list[list[bytes]]] = {}
                for lang, text in zip(langs[start:], texts):
                    split.setdefault(lang, []).append(text.encode().split())
                for lang, own in split.items():
                    number, edges, counts, joints = held.setdefault(lang, (Numbering(), Edges(p), [np.empty(0, np.int64)], Counter()))
                    ids = [number.of(words) for words in own]
                    n = np.bincount(np.concatenate(ids), minlength=len(number))
                    n[:len(counts[0])] += counts[0]
                    counts[0] = n
                    if p.running:
                        edges.add(list(number)[len(edges.head):])
                        codes, times = np.unique(np.concatenate([edges.joints(x) for x in ids]), return_counts=True)
                        joints.update(dict(zip(codes.tolist(), times.tolist())))
                if sum(len(x[0]) + len(x[3]) for x in held.values()) > 300_000:
                    yield from out()
        yield from out()

    counted = docs.select(language(docs).alias("lang"), "text").mapInArrow(run, "lang string, word string, n long")
    return counted.groupBy("lang", "word").agg(F.sum("n").alias("n"))


def grams(words: list[bytes], p: PerplexityParams) -> tuple[np.ndarray, np.ndarray]:
    """The word number and the n-gram before and with each character of each word and its end, or of each joint's end.

    With ``running`` a word's first characters, which depend on the word before, belong to the joint.
    """
    order = p.order
    before = " " if p.running else " " * (order - 1)
    texts = [t if " " in t else f"{before}{t} " for t in (w.decode() for w in words)]
    units = "".join(texts).encode("utf-16-le")
    width = np.fromiter(map(len, texts), np.int64, len(texts))
    flat = np.frombuffer(units, np.uint16).astype(np.uint64)
    if len(flat) > width.sum():  # characters of two units
        width = np.fromiter((len(t.encode("utf-16-le")) // 2 for t in texts), np.int64, len(texts))
    code = np.zeros(len(flat), np.uint64)
    for back in range(order):
        code[back:] |= flat[:len(flat) - back] << np.uint64(BITS * back)
    code = code.view(np.int64)
    row = csr_rows(width)
    starts = np.cumsum(width) - width
    place = np.arange(len(flat)) - np.repeat(starts, width)
    whole = place >= order - 1
    if len(flat) > sum(map(len, texts)):
        # a joint's tail and head are characters; of their units only those count that the border's n-grams reach
        for i in np.flatnonzero(width > np.fromiter(map(len, texts), np.int64, len(texts))):
            if b" " in words[i]:
                border = len(texts[i][:order - 2].encode("utf-16-le")) // 2
                own = slice(starts[i], starts[i] + width[i])
                whole[own] = (place[own] > border) & (place[own] <= border + order - 2)
    return row[whole], code[whole]


def gram_counts(words: DataFrame, p: PerplexityParams) -> DataFrame:
    """(lang, k, code, c): counts of the longest n-grams, and of each shorter one the number of characters met before it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, lang = np.unique(np.array(batch.column("lang").to_pylist(), dtype=object), return_inverse=True)
            words = [w.encode() for w in batch.column("word").to_pylist()]
            n = batch.column("n").to_numpy()
            for at in range(0, len(words), 20_000):
                row, code = grams(words[at:at + 20_000], p)
                of, n_of = lang[at:at + 20_000][row], n[at:at + 20_000][row]
                order = np.lexsort((code, of))
                code, of, n_of = code[order], of[order], n_of[order]
                new = np.append(True, (code[1:] != code[:-1]) | (of[1:] != of[:-1]))
                yield pa.RecordBatch.from_arrays([pa.array(langs[of[new]].tolist(), pa.string()), pa.array(code[new]),
                                                  pa.array(np.add.reduceat(n_of, np.flatnonzero(new)))], ["lang", "code", "c"])

    top = words.mapInArrow(run, "lang string, code long, c long").groupBy("lang", "code").agg(F.sum("c").alias("c"))
    # each order is a table: the next shorter one comes from it, and the text is read once
    orders = [written(top.withColumn("k", F.lit(p.order)))]
    for k in range(p.order - 1, 0, -1):
        longer = orders[-1].select("lang", F.col("code").bitwiseAND(F.lit((1 << BITS * k) - 1)).alias("code"))
        orders.append(written(longer.groupBy("lang", "code").agg(F.count(F.lit(1)).alias("c")).withColumn("k", F.lit(k))))
    out = orders[0]
    for x in orders[1:]:
        out = out.unionByName(x)
    return out.select("lang", "k", "code", "c")


Entries = dict[str, tuple[np.ndarray, np.ndarray]]


def context_of(code: np.ndarray) -> np.ndarray:
    """The n-grams without their last character."""
    return (code.view(np.uint64) >> np.uint64(BITS)).view(np.int64)


def suffix_of(code: np.ndarray, k: int) -> np.ndarray:
    """The last k characters of the n-grams."""
    return code if BITS * k >= 64 else code & np.int64((1 << BITS * k) - 1)


@dataclass(frozen=True)
class NgramModel:
    """For each order and language the sorted n-grams met with their probabilities, and the contexts with their back-off weights."""
    prob: dict[int, Entries]
    gamma: dict[int, Entries]

    @classmethod
    def of(cls, alpha: dict[int, Entries], gamma: dict[int, Entries], order: int) -> "NgramModel":
        """From discounted probabilities: those of a shorter n-gram are added by the context's back-off weight."""
        model = cls({k: {} for k in range(1, order + 1)}, gamma)
        for k in range(1, order + 1):
            for lang, (code, w) in alpha[k].items():
                model.prob[k][lang] = code, (w + model.backed_off(lang, code, k)).astype(np.float32)
        return model

    def backed_off(self, lang: str, code: np.ndarray, k: int) -> np.ndarray:
        """The share of n-grams of order k that comes from the next shorter order."""
        return found(self.gamma[k].get(lang), context_of(code), 1.0) * self.probability(lang, suffix_of(code, k - 1), k - 1)

    def probability(self, lang: str, code: np.ndarray, k: int) -> np.ndarray:
        if k == 0:
            return np.full(len(code), 2.0 ** -BITS)
        out = found(self.prob[k].get(lang), code, 0.0)
        unseen = np.flatnonzero(out == 0.0)
        if len(unseen):
            out[unseen] = self.backed_off(lang, code[unseen], k)
        return out

    def nll(self, lang: str, words: list[bytes], p: PerplexityParams) -> np.ndarray:
        """Negative log-probability of each word with its end, or of each joint."""
        row, code = grams(words, p)
        prob = self.probability(lang, code, p.order)
        return np.bincount(row, -np.log(np.maximum(prob, 1e-12)), minlength=len(words))


def found(entries: tuple[np.ndarray, np.ndarray] | None, code: np.ndarray, default: float) -> np.ndarray:
    if not entries:
        return np.full(len(code), default)
    keys, values = entries
    at = np.minimum(np.searchsorted(keys, code), len(keys) - 1)
    return np.where(keys[at] == code, values[at].astype(float), default)


def ngram_model(docs: DataFrame, p: PerplexityParams = PerplexityParams()) -> NgramModel:
    """Counts all texts and keeps the smoothed weights of every n-gram and context."""
    counts = gram_counts(word_counts(docs, p), p)
    n = [F.coalesce(F.sum((F.col("c") == i).cast("double")), F.lit(0.0)).alias(f"n{i}") for i in (1, 2, 3, 4)]
    y = F.col("n1") / (F.col("n1") + 2 * F.col("n2"))

    def discount(i: int) -> Column:
        d = i - (i + 1) * y * F.col(f"n{i + 1}") / F.col(f"n{i}")
        usable = (F.col(f"n{i}") > 0) & (F.col("n1") > 0)
        return F.greatest(F.lit(0.1 * i), F.coalesce(F.when(usable, d), F.lit(0.5 * i))).alias(f"d{i}")

    # a row for each order of a language, written: small enough for Spark to broadcast by its true size
    discounts = written(counts.groupBy("lang", "k").agg(*n).select("lang", "k", *map(discount, (1, 2, 3))))
    with_d = counts.join(discounts, ["lang", "k"])
    with_d = with_d.withColumn("d", F.when(F.col("c") == 1, F.col("d1")).when(F.col("c") == 2, F.col("d2")).otherwise(F.col("d3")))
    with_d = with_d.withColumn("context", F.shiftrightunsigned("code", BITS))
    contexts = with_d.groupBy("lang", "k", "context").agg(F.sum("c").alias("total"), F.sum("d").alias("left"))
    alpha = (with_d.join(contexts, ["lang", "k", "context"])
             .select("lang", "k", "code", (F.greatest(F.col("c") - F.col("d"), F.lit(0.0)) / F.col("total")).alias("w")))
    gamma = contexts.select("lang", (-F.col("k")).alias("k"), F.col("context").alias("code"), F.least(F.col("left") / F.col("total"), F.lit(1.0)).alias("w"))

    # twelve bytes an entry; the entries are as many as the corpus has n-grams
    entries = written(alpha.unionByName(gamma).select("lang", "k", "code", F.col("w").cast("float").alias("w")))
    langs = sorted(r["lang"] for r in discounts.select("lang").distinct().collect())
    alphas, gammas = ({k: {} for k in range(1, p.order + 1)} for _ in range(2))
    for lang in langs:
        rows = entries.where(F.col("lang") == lang).select("k", "code", "w").toPandas()
        for k, part in rows.sort_values(["k", "code"]).groupby("k"):
            (alphas if k > 0 else gammas)[abs(k)][lang] = part["code"].to_numpy(np.int64), part["w"].to_numpy(np.float32)
    return NgramModel.of(alphas, gammas, p.order)


def base_measures(text: str, words: list[bytes], ids: np.ndarray) -> tuple[int, int, int]:
    """Symbols, lines equal to an earlier line, and words in three-word windows found twice or more."""
    symbols = sum(map(text.count, SYMBOLS))
    lines = [x for x in text.encode().split(b"\n") if x.split()]
    repeated = 0
    if len(ids) > 3:
        with np.errstate(over="ignore"):
            key = mix64(mix64(ids[:-2].astype(np.uint64) + np.uint64(1)) + ids[1:-1].astype(np.uint64))
            key = mix64(key + ids[2:].astype(np.uint64))
        _, at, n = np.unique(key, return_inverse=True, return_counts=True)
        again = n[at] > 1
        covered = np.zeros(len(ids), bool)
        for shift in range(3):
            covered[shift:len(ids) - 2 + shift] |= again
        repeated = int(covered.sum())
    return symbols, len(lines) - len(set(lines)), repeated


def measures(docs: DataFrame, model: NgramModel, p: PerplexityParams) -> DataFrame:
    """The columns of ``docs`` but ``text``, the plain counts, and ``nll``, the mean over the characters (null without words)."""
    keep = [c for c in docs.columns if c not in ("text", "__lang", *COLUMNS)]
    handle = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, tuple[Numbering, np.ndarray, np.ndarray]] = {}
        met: dict[str, tuple[Edges, Numbering, np.ndarray]] = {}
        for batch in batches:
            langs, out = batch.column("__lang").to_pylist(), []
            for start, texts in text_slices(batch):
                if sum(len(x[0]) for x in known.values()) > 300_000:
                    known.clear()
                    met.clear()
                split: dict[str, list[tuple[int, list[bytes]]]] = {}
                for i, text in enumerate(texts):
                    split.setdefault(langs[start + i], []).append((i, text.encode().split()))
                rows = [None] * len(texts)
                for lang, own in split.items():
                    number, nll, chars = known.get(lang) or (Numbering(), np.empty(0), np.empty(0, np.int64))
                    ids = [number.of(words) for _, words in own]
                    new = list(number)[len(nll):]
                    if new:
                        nll = np.concatenate([nll, handle.value.nll(lang, new, p)])
                        chars = np.concatenate([chars, np.fromiter((len(w.decode()) for w in new), np.int64, len(new))])
                    known[lang] = number, nll, chars
                    joint = [0.0] * len(ids)
                    if p.running:
                        edges, numbered, of_joint = met.get(lang) or (Edges(p), Numbering(), np.empty(0))
                        edges.add(new)
                        joints, of_text = np.unique(np.concatenate([edges.joints(at) for at in ids]), return_inverse=True)
                        which = numbered.of(joints.tolist())
                        if len(numbered) > len(of_joint):
                            of_joint = np.append(of_joint, handle.value.nll(lang, edges.units(list(numbered)[len(of_joint):]), p))
                        met[lang] = edges, numbered, of_joint
                        joint = np.bincount(csr_rows(np.array([len(at) for at in ids])), of_joint[which][of_text], minlength=len(ids))
                    for (i, words), at, between in zip(own, ids, joint):
                        n_chars = int(chars[at].sum())
                        mean = float(nll[at].sum() + between) / (n_chars + len(at)) if len(at) else None
                        rows[i] = (len(at), n_chars, *base_measures(texts[i], words, at), mean)
                out += rows
            columns = list(zip(*out)) or [()] * 6
            kinds = [pa.int64()] * 5 + [pa.float64()]
            names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "nll")
            yield passed_on(batch.drop_columns(["text"]), {k: pa.array(c, t) for k, c, t in zip(names, columns, kinds)})

    source = docs.select(*keep, language(docs).alias("__lang"), "text")
    zero = F.lit(0).cast("long")
    schema = source.drop("text").withColumns({**dict.fromkeys(("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"), zero), "nll": F.lit(None).cast("double")}).schema
    return source.mapInArrow(run, schema)


def bands(measured: DataFrame, p: PerplexityParams) -> DataFrame:
    """(__lang, low, high): for each language the quartiles of ``nll`` over all texts, from a histogram, and the bands beyond them."""
    bins = (measured.where("nll IS NOT NULL").groupBy("__lang", F.floor(F.col("nll") * p.bins).alias("bin"))
            .agg(F.count(F.lit(1)).alias("n")))
    # some hundred bins a language, whatever the number of texts
    each = bins.groupBy("__lang").agg(F.sort_array(F.collect_list(F.struct("bin", "n"))).alias("bins"), F.sum("n").alias("total"))

    def quartile(share: float) -> Column:
        reached = F.aggregate("bins", F.struct(F.lit(0).cast("long").alias("seen"), F.lit(None).cast("long").alias("bin")),
                              lambda acc, x: F.struct((acc["seen"] + x["n"]).alias("seen"),
                                                      F.coalesce(acc["bin"], F.when(acc["seen"] + x["n"] >= F.col("total") * share, x["bin"])).alias("bin")))
        return reached["bin"] / p.bins

    q = each.select("__lang", quartile(0.25).alias("q1"), (quartile(0.75) + 1 / p.bins).alias("q3"))
    far = p.reach * (F.col("q3") - F.col("q1"))
    return q.select("__lang", (F.col("q1") - far).alias("low"), (F.col("q3") + far).alias("high"))


def rules(docs: DataFrame, p: PerplexityParams = PerplexityParams()) -> DataFrame:
    """The columns of ``docs`` but ``text``, the plain counts, base_failed, nll (log of the perplexity) and kept."""
    measured = measures(docs, ngram_model(docs, p), p).checkpoint()
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words"))
    # one row a language: few, and small enough for Spark to broadcast after checking its size
    band = bands(measured, p).select(F.col("__lang").alias("__of"), F.col("low").alias("__low"), F.col("high").alias("__high"))
    out = measured.join(band, F.col("__lang") == F.col("__of"), "left").withColumn("base_failed", failed)
    within = F.coalesce(F.col("nll").between(F.col("__low"), F.col("__high")), F.lit(False))
    return out.withColumn("kept", ~F.col("base_failed") & within).drop("__lang", "__of", "__low", "__high")
