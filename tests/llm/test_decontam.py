"""Containment search against brute force and the registered SQL; no Python in the plan."""

import random

import pytest

from tickwatch.llm import decontam as dc

P = dc.DecontamParams()


def shingles(text):
    words = (text or "").lower().split(" ")
    words = [w for w in words if w]
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)} or ({tuple(words)} if words else set())


def brute(docs, items):
    out = set()
    for doc_id, text in docs:
        for item_id, item in items:
            q = shingles(item)
            if q and len(q & shingles(text)) / len(q) >= P.threshold:
                out.add((doc_id, item_id, len(q & shingles(text)), len(q)))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    items = [(i, " ".join(rng.choices(words, k=rng.choice([3, 6, 9, 20, 40])))) for i in range(25)]
    items += [(25, None), (26, ""), (27, items[3][1]), (None, items[4][1]), (3, items[5][1])]
    docs = []
    for i in range(80):
        body = rng.choices(words, k=rng.choice([0, 4, 30, 300, 6000]))
        for _ in range(rng.randint(0, 3)):
            item = (rng.choice(items)[1] or "").split()
            if len(item) > 15 and rng.random() < 0.5:
                item[rng.randrange(len(item))] = "changed"
            at = rng.randint(0, len(body))
            body[at:at] = item
        docs.append((None if i % 13 == 1 else i, " ".join(body).upper() if i % 5 == 0 else " ".join(body)))
    docs += docs[:3] + [(90, None), (91, ""), (92, "x " * 9000)]
    d = spark.createDataFrame([(*r, "k") for r in docs], "doc_id long, text string, key string")
    q = spark.createDataFrame([(*r, 1) for r in items], "item_id long, text string, n int")
    got = dc.contaminated(d, q, P).collect()
    assert {(r.doc_id, r.item_id, r.n_shared, r.n_shingles) for r in got} == brute(docs, items) and len(got) == len(brute(docs, items))
    dirty = {t for (_, t) in docs if any(shingles(i) and len(shingles(i) & shingles(t)) / len(shingles(i)) >= P.threshold for _, i in items)}
    left = dc.clean(d, q, P).collect()
    assert sorted(map(repr, ((r.doc_id, r.text, r.key) for r in left))) == sorted(repr((*r, "k")) for r in docs if r[1] not in dirty)


def test_no_rows(spark):
    d = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    q = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    assert dc.contaminated(d, q).count() == 1
    assert dc.contaminated(d.limit(0), q).count() == 0
    assert dc.contaminated(d, q.limit(0)).count() == 0
    assert dc.clean(d, q.limit(0)).count() == 1


def test_query_against_its_sql(spark):
    from oracle_compare import compare
    assert compare(spark, "/root/testdata/sf0.01", ["op4_decontamination"], verbose=False)["op4_decontamination"] is True
