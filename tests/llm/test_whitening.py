"""Whitening against a plain NumPy computation on all rows, and odd input."""

import math

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tickwatch.llm.whitening import WhiteningParams, by_component, weighted_covariance, whitened

SCHEMA = "vec_id long, embedding array<float>"


def grid(rows):
    out = []
    for i, v in rows:
        if v is not None and all(c is not None and math.isfinite(c) for c in v):
            out.append((i, tuple(math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v)))
    return out


def brute(rows, weights="one"):
    """vec_id, component -> (n, deviation, |whitened|, explained), of rows of one dimension."""
    kept = grid(rows)
    counts = {}
    for _, x in kept:
        counts[x] = counts.get(x, 0) + 1
    xs = list(counts)
    w = np.array([1 if weights == "one" else counts[x] for x in xs])
    n, s = int(w.sum()), [sum(int(wi) * x[j] for wi, x in zip(w, xs)) for j in range(len(xs[0]))]
    c = np.array([[(n * v - sj) / n for v, sj in zip(x, s)] for x in xs])
    cov = (c * w[:, None]).T @ c / n
    e, v = np.linalg.eigh(cov)
    e, v = e[::-1], v[:, ::-1]
    out = {}
    for i, x in kept:
        z = np.array([(n * a - sj) / n for a, sj in zip(x, s)])
        for k in range(min(16, len(s))):
            live = e[k] > e[0] * len(s) * 2.0 ** -52
            out.setdefault((i, k + 1), []).append((n, sum((n * a - sj) ** 2 for a, sj in zip(x, s)),
                                                   abs(z @ v[:, k]) / math.sqrt(e[k]) if live else None, e[k] / e.sum() if live else 0.0))
    return out


def check(df, want):
    got = {}
    for r in df.collect():
        got.setdefault((r["vec_id"], r["component"]), []).append(r)
        assert r["identity_error"] is None or r["identity_error"] < 1e-9
    assert got.keys() == want.keys()
    for key, expected in want.items():
        assert len(got[key]) == len(expected)
        for r, (n, dev, white, share) in zip(sorted(got[key], key=lambda r: r["deviation"]), sorted(expected, key=lambda e: e[1])):
            assert (r["n"], r["deviation"]) == (n, dev)
            assert (r["whitened"] is None) == (white is None) and (white is None or abs(abs(r["whitened"]) - white) < 1e-8 * (1 + white))
            assert abs(r["explained"] - share) < 1e-9


def test_query_equals_numpy(spark):
    from tickwatch.llm.queries import QUERIES
    sf = "/root/testdata/sf0.01"
    t = pq.read_table(f"{sf}/embeddings.parquet").to_pydict()
    check(QUERIES["op12_embedding_whitening"](spark, sf), brute(list(zip(t["vec_id"], t["embedding"]))))


@pytest.mark.parametrize("weights", ["one", "count"])
def test_copies_nulls_and_odd_entries(spark, weights):
    """Half of the rows are one vector; rows that aren't whole go; one dimension never varies."""
    rng = np.random.default_rng(3)
    rows = [(i, [*map(float, rng.normal(size=5)), 0.25]) for i in range(60)] + [(i, [0.5, -1.0, 2.0, 0.0, 1.0, 0.25]) for i in range(60, 130)]
    rows += [(5, rows[5][1]), (200, None), (201, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (202, [float("nan")] * 6), (203, [float("inf")] * 6), (204, [])]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("x", F.lit(1)).withColumn("d", F.lit(1)).withColumn("n", F.lit("a"))
    p = WhiteningParams(weights=weights)
    check(by_component(whitened(df, p)), brute([r for r in rows if r[1] != []], weights))


def test_dimensions_are_fitted_apart(spark):
    rng = np.random.default_rng(4)
    small = [(i, [float(v) for v in rng.normal(size=3)]) for i in range(30)]
    large = [(i, [float(v) for v in rng.normal(size=20)]) for i in range(100, 150)]
    df = by_component(whitened(spark.createDataFrame(small + large, SCHEMA)))
    check(df.where("vec_id < 100"), brute(small))
    check(df.where("vec_id >= 100"), brute(large))


def test_nothing_varies_and_huge_entries(spark):
    one = by_component(whitened(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], SCHEMA))).collect()
    assert [(r["n"], r["deviation"], r["whitened"], r["explained"], r["identity_error"]) for r in one] == [(1, 0, None, None, None)] * 4
    huge = whitened(spark.createDataFrame([(1, [3e38, 0.0]), (2, [-3e38, 1.0]), (3, [0.0, 0.5])], SCHEMA)).collect()
    # beyond a long where an entry is huge, exact where it isn't
    assert {r["vec_id"]: r["deviation"] is None for r in huge} == {1: True, 2: True, 3: False}
    assert by_component(whitened(spark.createDataFrame([], SCHEMA))).collect() == []


def test_covariance_is_exact_for_far_means(spark):
    """Entries around a million that vary by one: the centred product keeps all digits."""
    x = [[1_000_000 + i % 2, 1_000_000 + i % 3] for i in range(6)]
    df = spark.createDataFrame([(v, 1) for v in x], "x array<long>, weight long").repartition(3)
    m = weighted_covariance(df)[2]
    assert m.n == 6 and m.sums == [6_000_003, 6_000_006]
    assert np.abs(m.covariance - np.cov(np.array(x, float).T, bias=True)).max() < 1e-12
