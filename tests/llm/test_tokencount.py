"""Token counts by pre-token against the tokenizer library on whole texts."""

import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tickwatch.llm import tokencount

P = tokencount.TokenParams(public_tokenizers.path("word_bpe_49k.json"))
SMALL = tokencount.TokenParams(P.tokenizer_path, chunk_docs=7, chunk_tokens=60)


@pytest.fixture(scope="module")
def whole():
    return Tokenizer.from_file(P.tokenizer_path)


def texts():
    rng = random.Random(8)
    parts = ["The", "cat's", " ", "  ", "\n", "İSTANBUL", "ΣΑΣ", "é", "é", "ﬁ", "123", "<|endoftext|>", "<|startoftext|>", "<|end", "!!", "'ll", "世界", "😀", "\x1c", "\x85"]
    made = ["".join(rng.choices(parts, k=rng.randint(0, 40))) for _ in range(120)]
    return made + [None, "", "word " * 9000, "x" * 20_000, "\0special", "a", "a"]


@pytest.mark.parametrize("p", [P, SMALL])
def test_counts(spark, whole, p):
    docs = spark.createDataFrame([(None if i % 9 == 0 else i % 50, i, t, -1) for i, t in enumerate(texts())],
                                 "doc_id long, place int, text string, n_tokens int")
    got = {r.place: r for r in tokencount.token_counts(docs, p).collect()}
    assert len(got) == len(texts())
    for i, text in enumerate(texts()):
        n = len(whole.encode(text or "", add_special_tokens=False).ids)
        assert (got[i].n_tokens, got[i].n_bytes, got[i].over_limit) == (n, len((text or "").encode()), n > 2048), repr(text)
        assert got[i].doc_id == (None if i % 9 == 0 else i % 50)


def test_no_rows(spark):
    assert tokencount.token_counts(spark.createDataFrame([], "doc_id long, text string"), P).count() == 0


def test_every_character(whole):
    cutter, odd = tokencount.Cutter(P), []
    for start in range(0, 0x30000, 64):
        text = "".join(f"a{chr(c)}1{chr(c)} " for c in range(start, start + 64) if not 0xD800 <= c < 0xE000)
        want = [(token, a) for token, a in whole.pre_tokenizer.pre_tokenize_str(whole.normalizer.normalize_str(text))]
        if len(want) != len(cutter.of([text])[0]):
            odd.append(hex(start))
    assert not odd


def test_query(spark, whole):
    from tickwatch.llm.queries import QUERIES
    d = "/root/testdata/sf0.001"
    got = {r.doc_id: r for r in QUERIES["op1_token_counts"](spark, d).collect()}
    for r in spark.read.parquet(f"{d}/documents.parquet").collect():
        assert got[r.doc_id].n_tokens == len(whole.encode(r.text or "", add_special_tokens=False).ids)
