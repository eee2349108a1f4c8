"""Chunked encoding against the whole-text encoding of the tokenizer library, and the round trip."""

import hashlib
import random

import public_tokenizers
import pytest
import tiktoken

from tickwatch.llm import bpe

P = bpe.BpeParams(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
SMALL = bpe.BpeParams(P.ranks_path, P.pattern, chunk_chars=40, overlap_chars=12)


@pytest.fixture(scope="module")
def whole():
    return tiktoken.Encoding("own", pat_str=P.pattern, mergeable_ranks=bpe.read_ranks(P.ranks_path), special_tokens={})


def texts():
    rng = random.Random(5)
    alphabet = ["a", "b", " ", " ", "\n", "'s", "'", "7", "é", "ß", "世", "😀", "!", "\t", "word", "  ", "<|endoftext|>", "ﬁ", " "]
    made = ["".join(rng.choices(alphabet, k=rng.randint(0, 120))) for _ in range(150)]
    return made + [None, "", "x" * 500, " " * 300, "ab " * 200, "ab " * 200, "\n \n" * 90, "'" * 200]


@pytest.mark.parametrize("p", [P, SMALL])
def test_ids_and_bytes(spark, whole, p):
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts())], "doc_id long, text string, ids string")
    rows = bpe.decode(bpe.encode(docs, p), p).collect()
    assert len(rows) == docs.count()
    for r in rows:
        text = texts()[r.doc_id] or ""
        assert r.ids == whole.encode_ordinary(text), repr(text)
        assert bytes(r.decoded).decode() == text


def test_repeated_rows_null_ids_and_no_rows(spark):
    docs = spark.createDataFrame([(None, "ab cd " * 30), (None, "ab cd " * 30), (7, None)], "doc_id long, text string")
    assert bpe.encode(docs, SMALL).count() == 3
    assert bpe.decode(bpe.encode(docs.limit(0), SMALL), SMALL).count() == 0


def test_every_character_like_the_library(whole):
    encoder = bpe.Encoder(P)
    odd = []
    for start in range(0, 0x30000, 64):
        text = "".join(f"a{chr(c)}1{chr(c)} " for c in range(start, start + 64) if not 0xD800 <= c < 0xE000)
        ids, _ = encoder.of([text])
        if ids.tolist() != whole.encode_ordinary(text):
            odd.append(hex(start))
    assert not odd


def test_query(spark):
    from tickwatch.llm.queries import QUERIES
    d = "/root/testdata/sf0.001"
    got = {r.doc_id: r for r in QUERIES["op7_bpe_round_trip"](spark, d).collect()}
    enc = tiktoken.Encoding("own", pat_str=P.pattern, mergeable_ranks=bpe.read_ranks(P.ranks_path), special_tokens={})
    for r in spark.read.parquet(f"{d}/documents.parquet").collect():
        ids = enc.encode_ordinary(r.text or "")
        g = got[r.doc_id]
        assert (g.n_tokens, g.ids_sha256) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())
        assert g.decoded_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest()
