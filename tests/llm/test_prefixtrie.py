"""Prefix trie against brute force, with bands and blocks of few levels, and odd input."""

import hashlib
import math
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from tickwatch.llm.prefixtrie import TrieParams, prefix_trie, rebuilt, turns

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute(rows):
    own = {}
    for c, t, r, x in rows:
        if c is not None:
            own.setdefault(c, []).append((t is not None, t or 0, r or "", x or ""))

    def digest(v):
        return hashlib.sha256(f"{len(v[2].encode())}:{v[2]}{v[3]}".encode()).hexdigest()
    own = {c: [v[2:] for v in sorted(vs, key=lambda v: (v[0], v[1], digest(v)))] for c, vs in own.items()}
    built = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        built[c] = own.get(c - int(math.fmod(c, 20)), [])[:h] + ts[h:]
    members = {}
    for c, ts in built.items():
        for d in range(len(ts) + 1):
            members.setdefault(tuple(ts[:d]), []).append(c)
    children = {n: [] for n in members}
    for n in members:
        if n:
            children[n[:-1]].append(n)
    leaves, saved = {}, {}
    for n in sorted(members, key=len, reverse=True):
        words = len(re.findall(r"[^\x20\x09-\x0D]+", n[-1][1])) if n else 0
        leaves[n] = sum(leaves[k] for k in children[n]) if children[n] else 1
        saved[n] = (len(members[n]) - 1) * words + sum(saved[k] for k in children[n])
    out = []
    for n, ms in members.items():
        ids = ",".join(map(str, sorted(c for c in ms if len(built[c]) == len(n))))
        out.append((min(ms), len(n), min(members[n[:-1]]) if n else None, len(ms), len(children[n]), leaves[n], saved[n],
                    hashlib.sha256(ids.encode()).hexdigest()))
    return sorted(out, key=repr)


def trie(spark, rows, p):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    return sorted((tuple(r) for r in prefix_trie(rebuilt(turns(df, p)), p).select(COLUMNS).collect()), key=repr)


@pytest.mark.parametrize("band", [2, 3, 32])
def test_random_conversations(spark, band):
    """Shared beginnings, one deep chain, conversations without turns left, repeated rows, nulls."""
    rng = random.Random(band)
    rows = []
    for c in [*range(0, 45), 61, 63, -7, 1000]:
        for t in range(rng.choice([1, 1, 2, 3, 5, 8])):
            rows.append((c, rng.choice([t, t, None]), rng.choice(["user", "assistant", None]), rng.choice(["a", "b c", "", None, "é  d\n"])))
    rows += [(20, t, "user", "w") for t in range(70)] + [(23, t, "user", "w") for t in range(66)] + [(20, 5, "user", "w")]
    rows += [(None, 0, "user", "x")]
    assert trie(spark, rows, TrieParams(band=band, block_turns=5, part_rows=40)) == brute(rows)


def test_copies_of_one_conversation(spark):
    """A third of the conversations are one text; their ids are a long list at one node."""
    rows = [(c, t, "user", f"same {t}") for c in range(400) for t in range(3)] + [(c, 0, "user", f"t {c}") for c in range(400, 1000)]
    assert trie(spark, rows, TrieParams(part_rows=500)) == brute(rows)


def test_roles_and_texts_are_kept_apart(spark):
    rows = [(100, 0, "a", "bc"), (101, 0, "ab", "c"), (102, 0, "", "abc"), (103, 0, "1:a", "b")]
    assert trie(spark, rows, TrieParams()) == brute(rows)


def test_empty_table_long_text_and_clashing_columns(spark):
    assert trie(spark, [], TrieParams()) == []
    rows = [(1, 0, "user", "x " * 500_000), (2, 0, "user", "x " * 500_000)]
    assert trie(spark, rows, TrieParams()) == brute(rows)
    df = spark.createDataFrame([(5, 0, "user", "x")], SCHEMA)
    for name in ("place", "depth", "k0", "h", "digest", "_band", "n_own"):
        df = df.withColumn(name, F.lit(1))
    assert prefix_trie(rebuilt(turns(df))).count() == 1 + (zlib.crc32(b"5") % 4 == 0)


def test_query_equals_its_sql(spark):
    from tests.oracle_compare import compare
    assert compare(spark, "/root/testdata/sf0.01", ["op13_prefix_trie"], verbose=False) == {"op13_prefix_trie": True}
