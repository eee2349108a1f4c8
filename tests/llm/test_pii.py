"""Patterns against a plain scan, terms against a plain count; no Python in the plan."""

import hashlib
import math
import random
import re
from collections import defaultdict

from tickwatch.llm import pii
from pyspark.sql import functions as F

P = pii.PiiParams()
PLAIN = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
         ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")]


def holds(kind, found):
    digits = re.sub("[^0-9]", "", found)
    if kind == "ip":
        return all(int(x) <= 255 for x in found.split("."))
    if kind == "card":
        total = sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(digits[::-1]))
        return 14 <= len(digits) <= 19 and total % 10 == 0
    return kind == "email" or 10 <= len(digits) <= 15


def plain(text):
    found = [(m.start(), order, m.end(), kind) for order, (kind, pattern) in enumerate(PLAIN)
             for m in re.finditer(pattern, text or "") if holds(kind, m[0])]
    return sorted(found)


def test_patterns(spark):
    rng = random.Random(6)
    parts = ["a", "x.y", "@", "b.co", ".", "-", "%", " ", "1", "255", "256", "007", "4111 1111-1111 1111", "4111111111111112", "+1", "+49 (30) 123.456-78", "é😀",
             "10.0.0.1", "1.2.3.4.5.6.7.8", "\ue000", "\n", "a@b.co_c@d.e"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 14))) for _ in range(1500)]
    texts += [None, "", "1 " * 20_000, "a@b" + ".c" * 20_000, "9" * 30_000, "+" + "1(" * 9000, "a." * 20_000 + "@", "٣" * 16]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").select("doc_id", pii.base_spans(F.coalesce("text", F.lit(""))).alias("s")).collect()
    for r in rows:
        assert [(s.start, s.ord, s.end, s.kind) for s in r.s] == plain(texts[r.doc_id]), repr(texts[r.doc_id])[:200]


def corpus():
    rng = random.Random(2)
    common = [f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60)]
    rows = []
    for i in range(60):
        body = " ".join(rng.choices(common, k=30))
        if i < 6:
            body += f" Zyxalon mail a.b@c.de and quorven{'x' * (i % 2)} +49 30 1234 5678"
        if i in (20, 21):
            body += " quorven"
        rows.append((i, body))
    return rows + [(3, rows[3][1]), (None, None), (61, "")]


def test_terms_by_information(spark):
    rows = corpus()
    got = pii.scan(spark.createDataFrame([(*r, "s", "k") for r in rows], "doc_id long, text string, spans string, __key string"), P).collect()
    assert len(got) == len(rows)
    words = [set(re.findall(r"[^\W\d_]{3,}", (t or "").lower())) for _, t in rows]
    owners = defaultdict(set)
    for n, (_, t) in enumerate(rows):
        for start, _, end, kind in plain(t):
            owners[kind, t[start:end]].add(n)
    for n, (doc_id, t) in enumerate(rows):
        want = set()
        for e, own in owners.items():
            if n in own:
                for w in words[n]:
                    both = {m for m in own if w in words[m]}
                    df = sum(w in x for x in words)
                    s = len({rows[m][1] for m in both}) + (P.kin if e[0] == "email" and w in re.findall(r"[^\W\d_]{3,}", e[1].split("@")[0].lower()) else 0)
                    unknown = -math.log2(len(both) / df * s / (s + P.doubt))
                    if math.log2(len(rows) / len(own)) > P.unknown and unknown <= P.unknown:
                        want.add(w)
        base = plain(t)
        spans = sorted(base + [(m.start(), 4, m.end(), "term") for m in re.finditer(r"[^\W\d_]+", t or "") if m[0].lower() in want
                               and not any(b[0] < m.end() and m.start() < b[2] for b in base)])
        r = next(r for r in got if r.doc_id == doc_id)
        assert [(s.kind, s.start, s.end) for s in r.spans] == [(k, a, b) for a, _, b, k in spans]
        assert ("Zyxalon" in (t or "")) == any(t[s.start:s.end] == "Zyxalon" for s in r.spans)
        if r.spans:
            assert "a.b@c.de" not in r.sanitised and "Zyxalon" not in r.sanitised and "[EMAIL]" in r.sanitised
        else:
            assert r.sanitised is None


def test_no_rows(spark):
    assert pii.scan(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_query(spark):
    from tickwatch.llm.queries import QUERIES
    d = "/root/testdata/sf0.001"
    frame = QUERIES["op10_personal_data"](spark, d)
    assert "Python" not in frame._jdf.queryExecution().toString()
    got = {r.doc_id: r for r in frame.collect()}
    for r in spark.read.parquet(f"{d}/documents.parquet").collect():
        found = plain(r.text)
        g = got[r.doc_id]
        assert [g.n_email, g.n_ip, g.n_card, g.n_phone] == [sum(x[1] == k for x in found) for k in range(4)]
        assert g.base_sha256 == hashlib.sha256(",".join(f"{k}:{a}:{b}" for a, _, b, k in found).encode()).hexdigest()


def test_entities_of_any_frequency(spark):
    """Entities in one text only: the names in their addresses are terms, other words beside them aren't, however rare."""
    rows = [(i, f"plain words here number{'abcdefgh'[i % 8]}") for i in range(40)]
    rows += [(40, "plain words Quillon quillon.m@c.de here oncemet +49 30 1234 5678"), (41, "plain words Brandor t-brandor@z.de"), (41, "plain words Brandor t-brandor@z.de")]
    got = {r.doc_id: r for r in pii.scan(spark.createDataFrame(rows, "doc_id long, text string"), P).collect()}
    for n, name in ((40, "Quillon"), (41, "Brandor")):
        text = dict(rows)[n]
        assert [text[s.start:s.end] for s in got[n].spans if s.kind == "term"] == [name]
        assert name not in got[n].sanitised and "plain words" in got[n].sanitised
    assert not got[0].spans


def test_rare_words_are_not_personal(spark):
    """A rare ordinary word beside an entity, in one text or two, stays; so does the text around it."""
    rows = [(i, f"other vocabulary {'abcdefgh'[i % 8] * 3} entry") for i in range(3000)]
    rows += [(5000, "the quick parcel was misplaaced near the harbour, write to a.b@c.de"), (5001, "a harbour walk")]
    got = {r.doc_id: r for r in pii.scan(spark.createDataFrame(rows, "doc_id long, text string"), P).collect()}
    assert got[5000].sanitised == "the quick parcel was misplaaced near the harbour, write to [EMAIL]"
    assert not got[5001].spans


def test_planted_names_against_rare_words(spark):
    """Precision and recall on names planted beside their addresses, among rare ordinary words."""
    rng = random.Random(12)
    letters = "abcdefghijklmnopqrstuvwxyz"
    word = lambda k: "".join(rng.choices(letters, k=k))
    common, names = [word(6) for _ in range(200)], [word(9) for _ in range(60)]
    rows = [[*rng.choices(common, k=12)] for _ in range(2000)]
    for n, name in enumerate(names):  # each in one to five texts with its address, which names every second
        for i in rng.sample(range(1500), 1 + n % 5):
            rows[i] += [name, f"{name}.x@mail.com" if n % 2 else f"q{n}@mail.com"]
    rare = [word(8) for _ in range(1500)]
    for w in rare:  # ordinary words in one or two texts, beside entities or not
        for i in rng.sample(range(2000), rng.randint(1, 2)):
            rows[i].append(w)
    docs = spark.createDataFrame([(i, " ".join(x)) for i, x in enumerate(rows)], "doc_id long, text string")
    text = {i: " ".join(x) for i, x in enumerate(rows)}
    found = {text[r.doc_id][s.start:s.end] for r in pii.scan(docs, P).collect() for s in r.spans if s.kind == "term"}
    provable = {name for n, name in enumerate(names) if n % 2 or 1 + n % 5 >= 3}  # in the address, or in three texts with it
    assert len(found & set(names)) >= 0.95 * len(found)
    assert len(found & provable) >= 0.95 * len(provable)


def test_terms_away_from_their_entity(spark):
    """A term in eight texts of an entity and one without it discloses there too; the reverse of few and many doesn't."""
    rows = [(i, f"plain words here number{'abcdefgh'[i % 8]}") for i in range(4000)]
    rows += [(5000 + i, f"plain words Marvossa at a.b@c.de item{'abcdefgh'[i]}") for i in range(8)]
    rows += [(6000, "plain Marvossa words, MARVOSSA"), (6000, "plain Marvossa words, MARVOSSA"), (6001, "plain words at"), (6002, None)]
    got = pii.scan(spark.createDataFrame(rows, "doc_id long, text string"), P).collect()
    assert len(got) == len(rows)
    away = [r for r in got if r.doc_id == 6000]
    assert len(away) == 2
    for r in away:
        assert [(s.kind, s.start, s.end) for s in r.spans] == [("term", 6, 14), ("term", 22, 30)]
        assert r.sanitised == "plain [TERM] words, [TERM]"
    assert all(not r.spans and r.sanitised is None for r in got if r.doc_id < 5000 or r.doc_id > 6000)
