"""Plain counts, the smoothed model and the bands against brute force in plain Python."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tickwatch.llm import perplexity as px

P = px.PerplexityParams()


def plain_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = {i + j for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for j in range(3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(covered)


def texts():
    rng = random.Random(4)
    parts = ["the", "a", "é😀", "of", "***", "a|b", "<x>", " ", " ", "\n", "\t", "\x0b", " ", "\x85", "word", "\n\n", "the a of the a of"]
    return ["".join(rng.choices(parts, k=rng.randint(0, 150))) for _ in range(120)] + [None, "", "word " * 8000, "x" * 30_000, "\n \n"]


def units(text):
    """The text with each UTF-16 code unit as a character of its own."""
    return "".join(map(chr, np.frombuffer(text.encode("utf-16-le"), np.uint16)))


def brute_model(lang_texts, order=4):
    """Modified Kneser-Ney probabilities of n-grams of UTF-16 code units within padded words."""
    top = Counter()
    for text in lang_texts:
        for word in (text or "").encode().split():
            chars = "\1" * (order - 1) + units(word.decode()) + "\1"
            for i in range(order - 1, len(chars)):
                top[chars[i - order + 1:i + 1]] += 1
    counts = {order: top}
    for k in range(order - 1, 0, -1):
        counts[k] = Counter(g[1:] for g in counts[k + 1])
    discounts, totals, left = {}, defaultdict(int), defaultdict(float)
    for k, grams in counts.items():
        n = Counter(grams.values())
        y = n[1] / (n[1] + 2 * n[2]) if n[1] + 2 * n[2] else 0
        discounts[k] = [max(0.1 * i, i - (i + 1) * y * n[i + 1] / n[i]) if n[i] and n[1] else 0.5 * i for i in (1, 2, 3)]
        for g, c in grams.items():
            totals[g[:-1]] += c if len(g) == k else 0
            left[g[:-1]] += discounts[k][min(c, 3) - 1]

    def prob(gram):
        if not gram:
            return 2.0 ** -px.BITS
        k, context = len(gram), gram[:-1]
        lower = prob(gram[1:])
        if context not in totals:
            return lower
        c = counts[k][gram]
        d = discounts[k][min(c, 3) - 1] if c else 0
        return max(c - d, 0) / totals[context] + min(left[context] / totals[context], 1) * lower

    def nll(word):
        chars = "\1" * (order - 1) + units(word) + "\1"
        return -sum(math.log(prob(chars[i:i + order])) for i in range(len(chars) - order + 1))

    return nll


def test_against_brute_force(spark):
    rows = [(None if i == 3 else i, t, ["en", "de", None][i % 3], 0) for i, t in enumerate(texts())]
    docs = spark.createDataFrame(rows + rows[:2], "doc_id long, text string, lang string, kept int")
    p = px.PerplexityParams(running=False)
    got = px.rules(docs, p).collect()
    assert len(got) == len(rows) + 2
    models = {lang: brute_model([t for _, t, of, _ in rows + rows[:2] if of == lang]) for lang in ("en", "de", None)}
    by_id = {r.doc_id: r for r in got}
    nll = defaultdict(list)
    for doc_id, text, lang, _ in rows + rows[:2]:
        r, text = by_id[doc_id], text or ""
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == plain_counts(text), repr(text)
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        words = [w.decode() for w in text.encode().split()]
        if words:
            assert r.nll == pytest.approx(sum(map(models[lang], words)) / (r.word_chars + r.n_words), rel=1e-4)
            nll[lang].append(r.nll)
        else:
            assert r.nll is None and not r.kept
    for doc_id, _, lang, _ in rows:
        r = by_id[doc_id]
        if r.nll is not None:
            bins = sorted(math.floor(x * p.bins) for x in nll[lang])
            q1, q3 = (bins[math.ceil(len(bins) * s) - 1] / p.bins for s in (0.25, 0.75))
            q3 += 1 / p.bins
            assert r.kept == (not r.base_failed and q1 - p.reach * (q3 - q1) <= r.nll <= q3 + p.reach * (q3 - q1))


def test_no_rows(spark):
    assert px.rules(spark.createDataFrame([], "doc_id long, text string, lang string")).count() == 0


def test_junk_is_rejected_and_clean_text_kept(spark):
    from tickwatch.llm.queries import QUERIES
    d = "/root/testdata/sf0.01"
    out = QUERIES["op5_quality_rules"](spark, d).toPandas().merge(spark.read.parquet(f"{d}/labels.parquet").toPandas(), on="doc_id")
    sound = out[~out.base_failed]
    assert sound[sound.quality == 1].kept.mean() > 0.97
    assert out[out.quality == 0].kept.mean() < 0.7
    assert np.isfinite(sound.nll).all()


def test_unseen_ngrams_take_no_others_weight(spark):
    """The model is exact, and random letters stay far worse than the text."""
    rng = random.Random(8)
    known = ["".join(rng.choices("abcdefghijkl", k=6)) for _ in range(400)]
    docs = spark.createDataFrame([(1, " ".join(known), "en")], "doc_id long, text string, lang string")
    p = px.PerplexityParams(running=False)
    model, exact = px.ngram_model(docs, p), brute_model([" ".join(known)])
    unseen = ["".join(rng.choices("mnopqrstuvwxyz", k=6)) for _ in range(50)]
    got = model.nll("en", [w.encode() for w in known[:50]], p)
    assert got == pytest.approx([exact(w) for w in known[:50]], rel=1e-4)
    assert model.nll("en", [w.encode() for w in unseen], p).min() > 2 * got.max()


def test_running_text_against_brute_force(spark):
    rows = [(i, t, ["en", None][i % 2]) for i, t in enumerate(texts())]
    p = px.PerplexityParams(running=True)
    joined = {i: "\1".join(w.decode() for w in (t or "").encode().split()) for i, t, _ in rows}
    models = {lang: brute_model([joined[i] for i, _, of in rows if of == lang]) for lang in ("en", None)}
    got = px.rules(spark.createDataFrame(rows, "doc_id long, text string, lang string"), p).collect()
    assert len(got) == len(rows)
    for r in got:
        if joined[r.doc_id]:
            assert r.nll == pytest.approx(models[r.lang](joined[r.doc_id]) / (len(joined[r.doc_id]) + 1), rel=1e-4)
        else:
            assert r.nll is None and not r.kept


def test_shuffled_clean_text_scores_worse(spark):
    """By the query's own parameters."""
    rng = random.Random(3)
    rows = [r for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang", "text").collect() if r.lang == "en" and len(r.text or "") > 1500][:100]
    mixed = [(r.doc_id, r.lang, " ".join(rng.sample(r.text.split(), len(r.text.split())))) for r in rows]
    model = px.ngram_model(spark.createDataFrame([tuple(r) for r in rows], "doc_id long, lang string, text string"), px.PerplexityParams(running=True))
    nll = [{r.doc_id: r.nll for r in px.measures(spark.createDataFrame(x, "doc_id long, lang string, text string"), model, px.PerplexityParams(running=True)).collect()}
           for x in ([tuple(r) for r in rows], mixed)]
    assert np.mean([nll[1][i] > nll[0][i] for i in nll[0]]) > 0.95


def test_recall_of_junk_that_passes_the_plain_rules(spark):
    from tickwatch.llm.queries import QUERIES
    d = "/root/testdata/sf0.1"
    out = QUERIES["op5_quality_rules"](spark, d).toPandas().merge(spark.read.parquet(f"{d}/labels.parquet").toPandas(), on="doc_id")
    sound = out[~out.base_failed]
    assert sound[sound.quality == 1].kept.mean() > 0.985
    assert (~sound[sound.quality == 0].kept).mean() > 0.3


def test_characters_are_not_folded(spark):
    """Words of characters that differ by 2^15 or lie beyond U+FFFF have n-grams of their own; columns of any name pass."""
    from pyspark.sql import functions as F
    words = [chr(0x4E00 + i) + chr(0x8100 + i) + chr(0x1F600 + i) for i in range(60)]
    twins = [chr(0x4E00 + i ^ 0x8000) + chr(0x8100 + i ^ 0x8000) for i in range(60)]
    rows = [(1, " ".join(words), "x"), (2, " ".join(words), "x"), (3, "a" * 5, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    p = px.PerplexityParams(running=False)
    model = px.ngram_model(docs, p)
    exact = brute_model([t for _, t, _ in rows])
    for some in (words, twins):
        assert model.nll("x", [w.encode() for w in some], p) == pytest.approx([exact(w) for w in some], rel=1e-4)
    _, code = px.grams([w.encode() for w in words + twins], p)
    assert len(np.unique(code)) == 60 * 5 + 60 * 3
    named = docs.withColumns({c: F.lit(7) for c in ("low", "high", "k", "code", "d", "bin")})
    out = px.rules(named)
    assert [r["low"] + r["high"] + r["d"] for r in out.collect()] == [21] * 3
