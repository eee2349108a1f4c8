"""The pipeline's stages on sf0.001 and a small table, each against its own definition."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
D = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    import corpus_pipeline
    folder, docs, out = tmp_path_factory.mktemp("pipeline"), spark.read.parquet(f"{D}/documents.parquet"), {}
    out["documents"] = docs.collect()
    for name, f in corpus_pipeline.STAGES:
        f(spark, docs, D).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        out[name] = docs.collect()
    return out


def test_rows_only_go(stages):
    names = list(stages)
    for before, after in zip(names, names[1:]):
        assert {r.doc_id for r in stages[after]} <= {r.doc_id for r in stages[before]}
    assert [len(stages[x]) for x in names[3:]] == [len(stages["decontamination"])] * 3
    assert all(list(stages[x][0].asDict()) == list(stages["documents"][0].asDict()) for x in names[:-1])


def test_near_duplicates_keep_one_of_each_class(stages):
    from test_neardup import brute_classes
    rows = [(r.doc_id, r.text) for r in stages["quality"]]
    assert sorted(set(brute_classes(rows))) == sorted(r.doc_id for r in stages["near_duplicates"])


def test_decontamination(spark, stages):
    from test_decontam import brute
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{D}/benchmark.parquet").collect()]
    docs = [(r.doc_id, r.text) for r in stages["near_duplicates"]]
    assert {i for i, _ in docs} - {i for i, *_ in brute(docs, items)} == {r.doc_id for r in stages["decontamination"]}


def test_secrets_and_tokens(stages):
    import public_tokenizers
    import tiktoken
    from test_secrets import plain
    from tickwatch.llm import bpe
    was = {r.doc_id: r for r in stages["decontamination"]}
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")), special_tokens={})
    text = {r.doc_id: r.text for r in stages["secrets"]}
    for r in stages["secrets"]:
        assert not plain(r.text) and (r.text == was[r.doc_id].text or r.n_chars == len(r.text))
        assert ("[SECRET]" in r.text) or not plain(was[r.doc_id].text)
    for r in stages["bpe"]:
        assert r.ids == enc.encode_ordinary(text[r.doc_id]) and r.n_tokens == len(r.ids) and r.round_trip


def test_odd_rows(spark):
    import corpus_pipeline as cp
    rows = [(None, None, "en", "s", 0), (None, "same words here", "en", "s", 1), (1, "same words here", None, None, None), (1, "same words here", None, None, None), (2, "", "en", "s", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert sorted(map(repr, (tuple(r) for r in cp.drop_near_duplicates(spark, docs, D).collect()))) == sorted(map(repr, [rows[0], rows[2], rows[4]]))
    for stage in (cp.keep_quality, cp.drop_contaminated, cp.redact_secrets, cp.tokenise):
        assert stage(spark, docs.limit(0), D).count() == 0
        assert stage(spark, docs, D).count() <= 5


def test_one_row_of_each_class(spark):
    """Unlike texts of one id both stay; of a class the smallest id, then the smallest digest; the same on any partitioning."""
    import hashlib
    import corpus_pipeline as cp
    a, b, c = (" ".join(f"{x}{i}" for i in range(60)) for x in "abc")
    near = a + " more"
    rows = [(5, a, "en", "s", 1), (5, b, "en", "s", 1), (3, b, "en", "s", 1), (5, near, "en", "s", 1), (5, a, "de", "s", 1), (None, c, "en", "s", 1),
            (None, c, "en", "s", 1), (None, c + " more", "en", "s", 1), (None, None, "en", "s", 0), (7, " ", "en", "s", 1), (7, "", "en", "s", 0), (8, "", "en", "s", 0)]
    seen = set()
    for parts in (1, 3, 7):
        docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(parts)
        got = [tuple(r) for r in cp.drop_near_duplicates(spark, docs, D).collect()]
        seen.add(tuple(sorted(map(repr, got))))
        first = min((a, near), key=lambda t: hashlib.md5(t.encode()).hexdigest())
        unnamed = min((c, c + " more"), key=lambda t: hashlib.md5(t.encode()).hexdigest())
        blank = min((" ", ""), key=lambda t: hashlib.md5(t.encode()).hexdigest())
        assert sorted(map(repr, (r[:2] for r in got))) == sorted(map(repr, [(5, first), (3, b), (None, unnamed), (None, None), (7, blank), (8, "")]))
    assert len(seen) == 1


def test_a_column_named_key_stays(spark):
    from tickwatch.llm import neardup
    docs = spark.createDataFrame([(1, "a b c d e f", "k1"), (2, "a b c d e f", None)], "doc_id long, text string, key string")
    assert sorted(map(tuple, neardup.near_duplicates(docs).collect())) == [(1, "k1", 1), (2, None, 1)]
